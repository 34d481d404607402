"""Credentials in texts: candidates by pattern, false positives removed by a random forest. DataFrame functions only."""
from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwise.llm.shared import store

#: A run of at least so many of these characters is a candidate wherever it stands.
LEAST = 16
_RUN = f"[A-Za-z0-9+/_=-]{{{LEAST},}}"
#: Shorter values are candidates after a credential's name, in an address before its host, or by the prefix of a kind of key.
SHORTEST = 6
_NAME = r"(?i)(token|secret|passw(or)?d|passwort|passphrase|pwd|api[_-]?key|auth|bearer|credentials?|private[_-]?key|access[_-]?key|client[_-]?key|signing[_-]?key)"
_SIGN = r"(=>|:=|[=:])"
_ADDRESS = r"[A-Za-z][A-Za-z0-9+.-]*://[^\s:/@]*:([^\s@/]{3,})@"
#: Prefixes of well-known kinds of keys.
_PREFIX = r"(A3T[A-Z0-9]|AKIA|ASIA|AGPA|AIDA)[A-Z0-9]{12,}|gh[pousr]_[A-Za-z0-9]{20,}|github_pat_\w{20,}|glpat-[\w-]{16,}|xox[abeoprs]-[A-Za-z0-9-]{10,}|[sr]k_(live|test)_[A-Za-z0-9]{10,}|AIza[\w-]{20,}|ya29\.[\w-]{10,}|eyJ[\w-]{8,}\.[\w-]{4,}(\.[\w-]*)?|npm_[A-Za-z0-9]{20,}|SG\.[\w-]{10,}\.[\w-]{10,}"
#: What a text must have for a credential's name, or for a key shorter than a run, to be looked for.
_STEMS = ("token", "secret", "pass", "pwd", "api", "auth", "bearer", "credential", "private", "access", "client", "signing")
_SHORT_PREFIXES = ("xox", "ya29.", "sg.", "eyj")
#: A word of at least this share of the documents with text (and of two) is in the dictionary.
DICTIONARY = 0.002
#: At most so many documents lend their hashes to labelled findings; the forest sees about twenty rows of each.
TRAIN_DOCUMENTS = 2000
TREES, DEPTH = 40, 9
ACCEPT = 0.5
MARK = "[secret]"

_CREDENTIAL = r"(?i)(token|secret|passw|pwd|api.?key|apikey|auth|bearer|credential|private|access.?key|signing|client.?key)"
_DIGEST = r"(?i)(sha\d*|md5|hash|commit|checksum|digest|revision|etag|blob|uuid|guid|build|version|order|invoice|isbn|serial)"
_TRIAL = r"(?i)(test|example|sample|mock|fixture|demo|dummy)"

FEATURES = (
    "length digits uppers lowers symbols switches vowels hexadecimal variety coverage credential_before digest_before trial_near assigned quoted path_like trial_path letters_only digits_only "
    "key_prefix in_address placeholder"
).split()


def _around(words: Column, i: Column, k: int) -> Column:
    return F.coalesce(F.get(words, i + k), F.lit(""))


def _bare(word: Column) -> Column:
    """What quotes hold at a word's beginning; else the word without brackets and closing punctuation around it."""
    quoted = F.regexp_extract(word, r"^[(\[<{]*[\"'`]+([^\"'`]+)", 1)
    return F.when(quoted != "", quoted).otherwise(_trimmed(word))


def _trimmed(word: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(word, r"^[\"'`(\[<{]+", ""), r"[\"'`)\]>},;.]+$", "")


def candidates(docs: DataFrame, text: str, path: str | None) -> DataFrame:
    """(t1, t2, path, word, value, before, here, after): the distinct candidates of the distinct texts, with up to three words
    before and one after; ``here`` is the candidate's own word.

    Candidates are long runs, keys by their prefix, passwords in addresses, and what follows a credential's name and ``=`` or
    ``:``, in the same word or the next ones.
    """
    body, lower = F.col(text), F.lower(F.col(text))
    named = f"{_NAME}[\\w-]*[\"'`]?\\s*{_SIGN}\\s*\\S"
    # Plain searches come first: the patterns are tried on the few texts that can match.
    has = lambda words: reduce(lambda x, y: x | y, [lower.contains(w) for w in words])
    in_address = body.contains("://") & body.contains("@") & body.rlike(_ADDRESS)
    rows = docs.where(body.rlike(_RUN) | in_address | (has(_STEMS) & body.rlike(named)) | (has(_SHORT_PREFIXES) & body.rlike(_PREFIX)))
    rows = rows.select(body.alias("text"), *_key(text, path)).select("t1", "t2", "path", F.split("text", r"[\t\n\x0B\f\r ]+").alias("words"))
    words = F.col("words")
    sign_only, ends_so = rf"^{_SIGN}$", rf"{_NAME}[\w-]*[\"'`]?{_SIGN}$"
    inside = rf"{_NAME}[\w-]*[\"'`]?{_SIGN}[\"'`]*[^\s\"'`]{{{SHORTEST},}}"

    def chosen(i: Column) -> Column:
        w, one, two = F.get(words, i), _around(words, i, -1), _around(words, i, -2)
        alone = (F.length(w) >= 15) & w.rlike(f"{_RUN}|{_PREFIX}")
        assigned = (w.contains("=") | w.contains(":")) & (w.rlike(inside) | (w.contains("://") & w.rlike(_ADDRESS)))
        after_name = (one.endswith("=") | one.endswith(":") | one.endswith("=>")) & (one.rlike(ends_so) | (one.rlike(sign_only) & two.rlike(rf"{_NAME}[\w-]*[\"'`]?$")))
        return alone | assigned | after_name

    found = rows.select("*", F.explode(F.filter(F.sequence(F.lit(0), F.size("words") - 1), chosen)).alias("word"))
    i = F.col("word")
    before = F.concat_ws(" ", *[_around(words, i, -k) for k in (3, 2, 1)])
    some = found.select("t1", "t2", "path", "word", before.alias("before"), F.get("words", i).alias("here"), _around(words, i, 1).alias("after"))
    here = F.col("here")
    follows = F.col("before").rlike(rf"{_NAME}[\w-]*[\"'`]?\s*{_SIGN}$")
    values = F.concat(
        F.regexp_extract_all(here, F.lit(f"({_RUN})"), 1),
        F.regexp_extract_all(here, F.lit(f"({_PREFIX})"), 1),
        F.regexp_extract_all(here, F.lit(_ADDRESS), 1),
        F.transform(F.regexp_extract_all(here, F.lit(rf"{_NAME}[\w-]*[\"'`]?{_SIGN}[\"'`]*([^\s\"'`]+)"), 4), _bare),
        F.when(follows, F.array(_bare(here))).otherwise(F.array().cast("array<string>")),
    )
    each = some.select("*", F.explode(F.array_distinct(values)).alias("value"))
    return each.where((F.length("value") >= SHORTEST) | here.rlike(_ADDRESS)).where(F.length("value") >= 3).distinct()


def _key(text: str, path: str | None) -> list[Column]:
    body = F.coalesce(F.col(text), F.lit(""))
    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")
    return [F.xxhash64(body).alias("t1"), F.xxhash64(F.lit(17), F.reverse(body)).alias("t2"), where.alias("path")]


def dictionary(docs: DataFrame, text: str) -> DataFrame:
    """The letter trigrams of the words that a share ``DICTIONARY`` of the documents with text has; at most 26^3 rows."""
    full = docs.where(F.length(text) > 0)
    words = full.select(F.explode(F.array_distinct(F.split(F.lower(F.col(text)), "[^a-z]+"))).alias("w")).where(F.length("w") >= 3)
    least = F.greatest(F.lit(2.0), F.lit(DICTIONARY) * full.agg(F.count(F.lit(1))).scalar())
    often = words.groupBy("w").count().where(F.col("count") >= least)
    return often.select(F.explode(F.expr("transform(sequence(1, length(w) - 2), i -> substr(w, i, 3))")).alias("trigram")).distinct()


def labelled_findings(docs: DataFrame, text: str) -> DataFrame:
    """(path, before, here, after, value, label) made of hashes and words of up to ``TRAIN_DOCUMENTS`` documents.

    Random strings given to a credential's name, keys with a known prefix anywhere, passwords in addresses and short mixed
    passwords after a name are secrets; the same kinds of strings as digests, identifiers, numbers, long words, paths,
    and plain words or placeholders after a name are not.
    """
    # Only hashes and the first words of a text travel.
    first = F.slice(F.split(F.col(text), r"[^A-Za-z]+", 13), 1, 12)
    some = docs.where(F.length(text) > 0).select(F.sha1(text).alias("a"), F.sha2(text, 256).alias("b"), F.md5(text).alias("c"), first.alias("w"))
    some = some.distinct().orderBy("b").limit(TRAIN_DOCUMENTS)
    mixed = F.regexp_replace(F.base64(F.unhex("b")), "[^A-Za-z0-9]", "x")
    word = F.lower(F.substring(F.concat_ws("", F.slice("w", 1, 12)), 1, 16 + F.conv(F.substring("c", 1, 1), 16, 10).cast("int")))
    digits = F.substring(F.translate(F.concat("a", "b"), "abcdef", "123456"), 1, 16)
    mail = F.concat(F.lower(F.substring(F.concat_ws("", F.slice("w", 1, 4)), 1, 12)), F.lit("-mail-address"))
    pair = F.conv(F.substring("c", 2, 1), 16, 10).cast("int") % 4
    name = F.element_at(F.array(*[F.lit(x) for x in ("token", "api_key", "secret", "password")]), pair + 1)
    digest = F.element_at(F.array(*[F.lit(x) for x in ("sha1", "commit", "checksum", "uuid")]), pair + 1)
    letters = F.upper(F.translate(F.col("a"), "0189", "wxyz"))
    keys = F.element_at(
        F.array(F.concat(F.lit("AKIA"), F.substring(letters, 1, 16)), F.concat(F.lit("ghp_"), F.substring(mixed, 1, 36)), F.concat(F.lit("sk_live_"), F.substring(mixed, 1, 24)), F.concat(F.lit("xoxb-"), F.substring("a", 1, 11), F.lit("-"), F.substring(mixed, 1, 18))),
        pair + 1,
    )
    first_word = F.coalesce(F.get("w", F.lit(1)), F.lit("word"))
    mark = F.element_at(F.array(*[F.lit(x) for x in ("!", "&3!", "$7", "@#")]), pair + 1)
    short = F.concat(F.initcap(F.substring(first_word, 1, 5)), F.substring(digits, 1, 3), mark)  # a word with digits and a mark
    blend = F.concat(F.substring(mixed, 1, 7), mark)
    plain = F.lower(F.concat(first_word, F.lit("word")))
    gap = F.element_at(F.array(*[F.lit(x) for x in ("<password>", "********", "${SECRET_NAME}", "os.environ[key]")]), pair + 1)
    near = F.concat_ws(" ", F.get("w", F.lit(2)), F.get("w", F.lit(3)))

    def made(before: Column, here: Column, value: Column, label: int, path: str = "src") -> Column:
        return F.struct(F.lit(path).alias("path"), before.alias("before"), here.alias("here"), F.coalesce(F.get("w", F.lit(5)), F.lit("")).alias("after"), value.alias("value"), F.lit(label).cast("double").alias("label"))

    quote = F.lit('"')
    assigned = F.concat_ws(" ", F.get("w", F.lit(2)), name, F.lit("="))
    rows = [
        made(assigned, F.concat(quote, F.col("a"), quote), F.col("a"), 1),
        made(assigned, F.concat(quote, F.upper("a"), quote), F.upper("a"), 1),
        made(assigned, F.concat(quote, mixed, quote), mixed, 1),
        made(F.concat_ws(" ", near, F.concat(name, F.lit(":"))), F.col("c"), F.col("c"), 1),
        made(near, F.concat(F.upper(name), F.lit("="), mixed), mixed, 1),
        made(near, keys, keys, 1),
        made(assigned, F.concat(quote, keys, quote), keys, 1),
        made(assigned, F.concat(quote, short, quote), short, 1),
        made(near, F.concat(name, F.lit(":"), short), short, 1),
        made(F.concat_ws(" ", near, F.concat(name, F.lit("="))), blend, blend, 1),
        made(near, F.concat(F.lit("postgres://admin:"), blend, F.lit("@db.example.com/x")), blend, 1),
        made(near, F.concat(F.lit("https://user:"), short, F.lit("@host.example.com")), short, 1),
        made(assigned, F.concat(quote, gap, quote), _bare(gap), 0),
        made(F.concat_ws(" ", near, F.concat(name, F.lit(":"))), plain, plain, 0),
        made(assigned, plain, plain, 0),
        made(F.concat_ws(" ", near, digest), F.col("a"), F.col("a"), 0),
        made(F.concat_ws(" ", near, F.concat(digest, F.lit(":"))), F.concat(quote, F.col("b"), quote), F.col("b"), 0),
        made(near, word, word, 0),
        made(near, F.upper(word), F.upper(word), 0),
        made(near, F.initcap(word), F.initcap(word), 0),
        made(assigned, word, word, 0),
        made(near, F.concat(digits, F.lit(",")), digits, 0),
        made(near, F.concat(mail, F.lit("@example.com")), mail, 0),
        made(near, F.concat(F.lit("https://example.com/"), word), F.concat(F.lit("/"), word), 0),
        made(assigned, F.concat(quote, F.lit("example"), word, quote), F.concat(F.lit("example"), word), 0, "test"),
    ]
    return some.select(F.explode(F.array(*rows)).alias("r")).select("r.*").where(F.length("value") >= SHORTEST)


def with_features(found: DataFrame, trigrams: DataFrame) -> DataFrame:
    """Length, shares of character kinds, switches between kinds, dictionary coverage, path and neighbours; values of any length."""
    v, n = F.col("value"), F.greatest(F.length("value"), F.lit(1)).cast("double")
    share = lambda pattern: F.regexp_count(v, F.lit(pattern)) / n
    flag = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    values = found.select("value").distinct()
    parts = values.where(F.length("value") >= 3).select("value", F.explode(F.expr("transform(sequence(1, length(value) - 2), i -> lower(substr(value, i, 3)))")).alias("part"))
    covered = parts.join(F.broadcast(trigrams), F.col("part") == F.col("trigram")).groupBy("value").agg(F.count(F.lit(1)).alias("hits"))  # at most 17,576 rows
    known = found.join(covered.withColumnRenamed("value", "of"), v.eqNullSafe(F.col("of")), "left").drop("of")
    columns = {
        "length": n,
        "digits": share("[0-9]"),
        "uppers": share("[A-Z]"),
        "lowers": share("[a-z]"),
        "symbols": share("[^A-Za-z0-9]"),
        "switches": share("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])|[a-z](?=[A-Z])"),
        "vowels": share("(?i)[aeiou]"),
        "hexadecimal": flag(v.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        "variety": F.size(F.array_distinct(F.split(F.lower(v), ""))) / F.least(n, F.lit(64.0)),
        "coverage": F.coalesce(F.col("hits"), F.lit(0)) / F.greatest(n - 2, F.lit(1.0)),
        "credential_before": flag(F.concat_ws(" ", "before", F.expr("substring_index(here, value, 1)")).rlike(_CREDENTIAL)),
        "digest_before": flag(F.concat_ws(" ", "before", F.expr("substring_index(here, value, 1)")).rlike(_DIGEST)),
        "trial_near": flag(F.concat_ws(" ", "before", "here", "after").rlike(_TRIAL)),
        "assigned": flag(F.concat(F.col("before"), F.expr("substring_index(here, value, 1)")).rlike("[=:]\\W*$")),
        "quoted": flag(F.col("here").rlike("[\"'`]")),
        "path_like": flag(F.col("here").rlike("(https?://|www\\.|@|/.*/)")),
        "trial_path": flag(F.col("path").rlike(_TRIAL)),
        "letters_only": flag(v.rlike("^[A-Za-z_-]+$")),
        "digits_only": flag(v.rlike("^[0-9_-]+$")),
        "key_prefix": flag(v.rlike(f"^({_PREFIX})")),
        "in_address": flag(F.col("here").rlike(_ADDRESS)),
        "placeholder": flag(v.rlike(r"[<>{}\[\]()$]{2}|^\W+$|^[<${(\[]|environ|getenv|your|xxxx|\*\*\*")),
    }
    return known.withColumns(columns).drop("hits")


def findings(docs: DataFrame, text: str = "text", path: str | None = "source", labelled: DataFrame | None = None) -> DataFrame:
    """(t1, t2, path, word, value, probability) of the candidates that the forest takes for credentials.

    ``labelled`` (path, before, here, after, value, label) replaces the default labelled findings. t1 and t2 are hashes of
    the text; copies are judged once. Null and empty texts have no candidates; without labelled rows, or with labels of one
    kind only, nothing is found. The word number counts from 0.
    """
    trigrams = store(dictionary(docs, text), "dictionary")
    known = labelled_findings(docs, text) if labelled is None else labelled
    train = store(with_features(known, trigrams).select("label", *FEATURES), "labelled")
    found = with_features(store(candidates(docs, text, path), "candidates"), trigrams)
    if train.select("label").distinct().count() < 2:
        return found.where("false").select("t1", "t2", "path", "word", "value", F.lit(0.0).alias("probability"))
    put = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11, featureSubsetStrategy="sqrt").fit(put.transform(train))
    judged = forest.transform(put.transform(found)).withColumn("probability", F.get(vector_to_array("probability"), F.lit(1)))
    return judged.where(F.col("probability") >= ACCEPT).select("t1", "t2", "path", "word", "value", "probability")


def _met(docs: DataFrame, text: str, path: str | None, labelled: DataFrame | None) -> DataFrame:
    found = findings(docs, text, path, labelled)
    per = store(found.groupBy("t1", "t2", "path").agg(F.collect_set(F.struct("word", "value", "probability")).alias("found")), "secrets")
    rows = docs.select(F.struct(*docs.columns).alias("row"), *_key(text, path))
    return rows.join(per, ["t1", "t2", "path"], "left")


def scan(docs: DataFrame, text: str = "text", path: str | None = "source", labelled: DataFrame | None = None) -> DataFrame:
    """One row for each row of ``docs`` and secret in it: the columns of ``docs`` in a struct ``row``, word, value, probability."""
    return _met(docs, text, path, labelled).select("row", F.explode("found").alias("f")).select("row", "f.*")


def redact(docs: DataFrame, text: str = "text", path: str | None = "source", length: str | None = "n_chars", labelled: DataFrame | None = None) -> DataFrame:
    """``docs`` with every secret's string replaced by ``MARK``, and ``length`` (characters) adjusted where that was done."""
    met = _met(docs, text, path, labelled)
    values = F.array_sort(F.array_distinct(F.transform("found", lambda f: f["value"])), lambda a, b: F.length(b) - F.length(a))
    clean = F.aggregate(values, F.col(f"row.{text}"), lambda done, v: F.replace(done, v, F.lit(MARK)))
    out = met.withColumn("clean", F.when(F.col("found").isNotNull(), clean).otherwise(F.col(f"row.{text}")))
    size = F.when(F.col("found").isNotNull(), F.char_length("clean"))
    changed = {text: F.col("clean"), **({length: F.coalesce(size.cast(docs.schema[length].dataType), F.col(f"row.{length}"))} if length and length in docs.columns else {})}
    return out.select(*[changed.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns])
