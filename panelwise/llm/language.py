"""Language of documents by Bayesian fusion of text, declared language, address suffix and host priors."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwise.llm.shared import buffers, slices, store

#: A language must be declared by so many rows to be known.
MIN_ROWS = 5
#: Weight, in rows, of a parent's distribution in its child's prior: all hosts, then the domain, then the host.
PARENT_ROWS = 10.0
#: Counts added to every cell of P(declared | language) and P(suffix | language).
CELL = 0.5
#: Trigrams of a text that count as independent evidence; the mean over the whole text is scaled to this many at most.
EVIDENCE = 200
#: A document is accepted at this posterior probability.
ACCEPT = 0.5
#: Bytes of text whose trigrams are held at a time; they take about seventy times as many.
PIECE = 1 << 18
#: Prior of a text in no known language.
OTHER = 1e-3
_CODES = 1 << 16
_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def _mixed(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    code = ((a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA6B)) ^ (c * np.uint32(0xC2B2AE35))) * np.uint32(0x27D4EB2F)
    return (code >> np.uint32(16)).astype(np.int64)


def other_language(letters: np.ndarray, n: float) -> np.ndarray:
    """Log probability of each trigram in a text of no known language: the known letters (counts of bytes) in any order,
    smoothed like a language of ``n`` trigrams."""
    share = (letters + 0.5) / (letters + 0.5).sum()
    own = np.unique(_FOLD).astype(np.uint32)
    total = np.zeros(_CODES)
    for a in own:
        b, c = (x.ravel() for x in np.meshgrid(own, own))
        good = ((a != 32) | (b != 32)) & ((b != 32) | (c != 32))
        total += np.bincount(_mixed(np.full(good.sum(), a), b[good], c[good]), weights=share[a] * share[b[good]] * share[c[good]], minlength=_CODES)
    return np.log((n * total / total.sum() + 0.5) / (n + 0.5 * _CODES)).astype(np.float32)


def trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams of each text (letters folded, all else a space; not those with two spaces in a row) and the
    number of their text."""
    raw, offsets = buffers(column)
    b = _FOLD[raw].astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    code = _mixed(b[:-2], b[1:-1], b[2:])
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    good = (text[:-2] == text[2:]) & ((b[:-2] != 32) | (b[1:-1] != 32)) & ((b[1:-1] != 32) | (b[2:] != 32))
    return code[good], text[:-2][good]


def _count(languages: list[str]):
    place = {x: k for k, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages) + 1) * _CODES, dtype=np.int64)  # the last are the bytes of all languages
        for whole in batches:
            for batch in slices(whole):
                own = np.array([place.get(x, -1) for x in batch.column("declared").to_pylist()], dtype=np.int64)
                raw, offsets = buffers(batch.column("text"))
                b, known = _FOLD[raw], np.repeat(own >= 0, np.diff(offsets))
                known[1:] &= (b[1:] != 32) | (b[:-1] != 32)
                for a in range(0, len(b), PIECE):
                    total[-_CODES:][:256] += np.bincount(b[a : a + PIECE][known[a : a + PIECE]], minlength=256)
                row = 0
                for part in slices(batch, "text", PIECE):
                    code, text = trigrams(part.column("text"))
                    of = own[row + text]
                    total += np.bincount((of * _CODES + code)[of >= 0], minlength=len(total))
                    row += part.num_rows
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array((at // _CODES).astype(np.int32)), pa.array((at % _CODES).astype(np.int32)), pa.array(total[at])], names=["language", "code", "n"])

    return run


def _table(frame: pa.Table) -> pa.Table:
    logs = np.full(_CODES, 0.5)
    logs[frame.column("code").to_numpy()] += frame.column("n").to_numpy()
    return pa.table({"language": frame.column("language")[:1], "logs": pa.array([np.log(logs / logs.sum()).astype(np.float32).tobytes()])})


def text_scores(column: pa.Array, model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihood of each text in each language, scaled to at most ``EVIDENCE`` trigrams, and the trigrams."""
    code, text = trigrams(column)
    n = np.bincount(text, minlength=len(column))
    out = np.zeros((len(column), len(model)))
    for k, logs in enumerate(model):
        out[:, k] = np.bincount(text, weights=logs[code], minlength=len(column))
    return out * (np.minimum(n, EVIDENCE) / np.maximum(n, 1))[:, None], n


def _best(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", PIECE):
                scores, n = text_scores(batch.column("text"), sent.value)
                scores[:, -1] += np.log(OTHER)
                best = scores.argmax(axis=1)
                best = np.where((n > 0) & (best < scores.shape[1] - 1), best, -1)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("declared", "suffix", "host")], pa.array(best.astype(np.int32))], names=["declared", "suffix", "host", "language"])

    return run


def _fuse(sent, languages: list[str], column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, declared, suffix, everywhere = sent.value
        names = np.array([*languages, None], dtype=object)
        for whole in batches:
            texts = whole.column("row").field(whole.column("row").type.get_field_index(column))
            for batch in slices(whole.append_column("text", texts), "text", PIECE):
                scores, n = text_scores(batch.column("text"), model)
                if languages:
                    scores[:, -1] += np.log(OTHER)
                    for k, (d, s, p) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("declared", "suffix", "prior")))):
                        scores[k, :-1] += np.log(everywhere if p is None else np.array(p))
                        if d in declared:
                            scores[k] += declared[d]
                        if s in suffix:
                            scores[k] += suffix[s]
                    scores -= scores.max(axis=1, keepdims=True)
                    share = np.exp(scores)
                    share /= share.sum(axis=1, keepdims=True)
                    best = share.argmax(axis=1)
                    best = np.where((n > 0) & (best < len(languages)), best, -1)
                    chance = np.where(n > 0, share[:, :-1].max(axis=1), 0.0)
                else:
                    best, chance = np.full(len(n), -1), np.zeros(len(n))
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(names[best].tolist(), pa.string()), pa.array(chance), pa.array(chance >= ACCEPT)], names=["row", "language", "probability", "accepted"])

    return run


def _likelihoods(counts: dict[tuple[str, int], int], size: int) -> dict[str, np.ndarray]:
    """log P(value | language), smoothed, for each value."""
    values = sorted({v for v, _ in counts})
    cells = np.array([[counts.get((v, k), 0) + CELL for k in range(size)] for v in values]).reshape(len(values), size)
    return dict(zip(values, np.log(cells / cells.sum(axis=0))))


def identify(docs: DataFrame, declared: Column, host: Column, suffix: Column | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``language``, ``probability`` (posterior) and ``accepted``.

    Languages are those that ``MIN_ROWS`` rows declare (primary subtag, lower case). Text likelihoods are byte trigram
    counts of all rows that declare a language. Every row's best language by text alone is then counted by declared
    language, address suffix, domain and host; that gives P(declared | language), P(suffix | language) and the prior of
    each host, smoothed towards its domain (the host without its first label) and that towards all rows. The posterior
    multiplies all of them. One more hypothesis, with prior ``OTHER``, is a text of no known language, whose trigrams are the
    known letters in any order; where it wins, ``language`` is null and the row is not accepted. Null or unknown declarations, suffixes and hosts are no evidence. A text without letters,
    null included, has no language, probability 0 and is not accepted; without any known language none is. Ties go to
    the first language by name. Repeated rows count each time. Columns of these names in ``docs`` are replaced.

    One distribution per host (a table) meets the rows by a join; while it is small, rows are not shuffled. The driver
    gets a row per known language and per suffix that ``MIN_ROWS`` rows have.
    """
    keep = [c for c in docs.columns if c.lower() not in ("language", "probability", "accepted")]
    spark = docs.sparkSession
    tag = F.lower(F.regexp_extract(F.coalesce(declared.cast("string"), F.lit("")), r"^\s*([A-Za-z]+)", 1))
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text"), F.when(tag != "", tag).alias("declared"), F.lower(host.cast("string")).alias("host"), (F.lit(None).cast("string") if suffix is None else F.lower(suffix)).alias("suffix"))
    languages = sorted(r["declared"] for r in rows.where("declared IS NOT NULL").groupBy("declared").count().where(F.col("count") >= MIN_ROWS).select("declared").collect())
    size = len(languages)
    model = np.zeros((size + 1, _CODES), dtype=np.float32)
    counted = rows.select("text", "declared").mapInArrow(_count(languages), "language int, code int, n long").groupBy("language", "code").agg(F.sum("n").alias("n"))
    counted = store(counted, "trigrams")
    letters = np.zeros(256)
    for r in counted.where(F.col("language") == size).collect():
        letters[r["code"]] = r["n"]
    counted = counted.where(F.col("language") < size)
    least = min((r["n"] for r in counted.groupBy("language").agg(F.sum("n").alias("n")).collect()), default=0)
    model[size] = other_language(letters, least)
    for r in counted.groupBy("language").applyInArrow(_table, "language int, logs binary").collect():
        model[r["language"]] = np.frombuffer(r["logs"], dtype=np.float32)
    sent = spark.sparkContext.broadcast(model)
    best = rows.select("text", "declared", "suffix", "host").mapInArrow(_best(sent), "declared string, suffix string, host string, language int")
    counts = store(best.where("language >= 0").groupBy("declared", "suffix", "host", "language").agg(F.count(F.lit(1)).alias("n")), "language-counts")

    def cells(column: str) -> dict:
        by = counts.where(F.col(column).isNotNull()).groupBy(column, "language").agg(F.sum("n").alias("n"))
        often = by.groupBy(column).agg(F.sum("n").alias("of")).where(F.col("of") >= MIN_ROWS)
        return _likelihoods({(r[column], r["language"]): r["n"] for r in by.join(often, column).collect()}, size)

    total = {r["language"]: r["n"] for r in counts.groupBy("language").agg(F.sum("n").alias("n")).collect()}
    everywhere = np.array([total.get(k, 0) + 1.0 for k in range(size)])
    everywhere = everywhere / everywhere.sum() if size else everywhere

    def with_other(values: dict) -> dict:
        """No known language says nothing of a declaration or suffix: it has the mean of the languages."""
        return {v: np.append(logs, np.log((np.exp(logs) * everywhere).sum())) for v, logs in values.items()}

    evidence = spark.sparkContext.broadcast((model, with_other(cells("declared")), with_other(cells("suffix")), everywhere))

    hosts = counts.where("host IS NOT NULL").withColumn("domain", F.regexp_extract("host", r"^[^.]*\.(.*)$", 1))
    per = [F.sum(F.when(F.col("language") == k, F.col("n")).otherwise(0)).cast("double").alias(f"n{k}") for k in range(size)]
    by_host, by_domain = hosts.groupBy("host", "domain").agg(*per, F.lit(0)) if size else hosts.groupBy("host", "domain").count(), hosts.groupBy("domain").agg(*per, F.lit(0)) if size else hosts.groupBy("domain").count()
    all_ = F.array(*[F.lit(float(x)) for x in everywhere])

    def smooth(parent: Column) -> Column:
        own = [F.col(f"n{k}") for k in range(size)]
        of = sum(own, F.lit(0.0)) + PARENT_ROWS
        return F.array(*[(own[k] + PARENT_ROWS * F.get(parent, F.lit(k))) / of for k in range(size)])

    parents = by_domain.select("domain", F.when(F.col("domain") == "", all_).otherwise(smooth(all_)).alias("parent"))
    priors = store(by_host.join(parents, "domain").select("host", smooth(F.col("parent")).cast("array<double>").alias("prior")), "host-priors")
    ready = rows.select("row", "declared", "suffix", "host").join(priors, "host", "left").select("row", "declared", "suffix", "prior")
    schema = ready.select("row").schema.add("language", "string").add("probability", "double").add("accepted", "boolean")
    return ready.mapInArrow(_fuse(evidence, languages, text), schema).select("row.*", "language", "probability", "accepted")
