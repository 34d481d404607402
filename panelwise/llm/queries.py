"""The registered queries: each operator with production parameters over its whole table."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.llm import chat, decontaminate, html_wrapper, impact_search, jaccard, language, lattice, periodic, pieces, repeats, secrets, sharding, whitening
from panelwise.llm.shared import QUERIES, SQL, query, table  # noqa: F401

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


@query("op1_hypergeometric_sharding")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Null text counts as empty: size 16, CRC 0."""
    placed = sharding.shuffle_into_shards(table(spark, folder, "documents"), 40)
    text = F.coalesce("text", F.lit(""))
    return placed.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


_OP3_SQL = """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT r, vec_id, unnest(range(len(embedding))) AS i, unnest(embedding) AS x FROM v),
n AS (SELECT r, vec_id, i, CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM c),
s AS (
    SELECT q.r AS qr, q.vec_id AS query_id, d.r AS dr, d.vec_id, CAST(sum(q.x * d.x) AS BIGINT) AS score
    FROM n q JOIN n d ON q.i = d.i AND q.r <> d.r WHERE q.vec_id % 20 = 0 GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id, dr) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""


@query("op3_impact_ordered_topk", _OP3_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    vectors = impact_search.quantise(table(spark, folder, "embeddings"), "vec_id", "embedding")
    return impact_search.top_k(vectors, F.col("vec_id") % 20 == 0, 20)


@query("op5_wrapper_induction_text")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    found = html_wrapper.main_text(table(spark, folder, "pages"))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))


@query("op8_piece_prefix_table")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    coded = pieces.encode_and_decode(table(spark, folder, "documents").select("doc_id", "text"), PIECE_MODEL)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op2_suffix_tree_repeats")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    kept = repeats.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op7_count_vector_jaccard")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


@query("op4_block_max_decontamination")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each document and test item found in it; clean documents have none."""
    found = decontaminate.find_items(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    return found.select("doc_id", F.explode("findings").alias("f")).select("doc_id", "f.*")


@query("op9_subword_lattice_likelihood")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    scored = lattice.score_documents(table(spark, folder, "documents").select("doc_id", "text"), held_out, PIECE_MODEL)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op6_evidence_fusion_language")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Documents declare ``lang``, their host is ``source``; they have no address."""
    found = language.identify(table(spark, folder, "documents"), F.col("lang"), F.col("source"))
    return found.select("doc_id", F.col("lang").alias("declared"), "language", "probability", "accepted")


@query("page_languages")
def page_languages(spark: SparkSession, folder: str) -> DataFrame:
    """The same with all evidence: markup language, last label of the host, host and domain."""
    pages = table(spark, folder, "pages")
    markup = F.regexp_extract(F.coalesce("html", F.lit("")), r"(?i)<html[^>]*\slang\s*=\s*[\"']?([A-Za-z-]+)", 1)
    host = F.nullif(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z]+://([^/:?#]+)", 1), F.lit(""))
    bare = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"<[^>]*>", " ")
    found = language.identify(pages.select("page_id", "url", bare.alias("text"), markup.alias("markup"), host.alias("host")), F.col("markup"), F.col("host"), F.regexp_extract("host", r"([^.]+)$", 1))
    return found.select("page_id", "url", F.col("markup").alias("declared"), "language", "probability", "accepted")


@query("op10_random_forest_secrets")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each secret of a document; ``word`` counts the words of the text from 0."""
    found = secrets.scan(table(spark, folder, "documents"))
    return found.select("row.doc_id", "word", "value", F.round("probability", 4).alias("probability"))


def periodic_documents(docs: DataFrame) -> DataFrame:
    """doc_id and text; where h = crc32(doc_id) is divisible by 10, the words from a on repeat their first p."""
    text, word = F.coalesce("text", F.lit("")), r"[^\x20\x09-\x0D]+"
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", text.alias("text"), h.alias("h"), F.when(h % 10 == 0, F.regexp_extract_all(text, F.lit(word), F.lit(0))).alias("words"))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil((n - a) / p).cast("int")))
    altered = F.array_join(F.concat(F.slice("words", 1, a), F.slice(again, 1, n - a)), " ")
    return chosen.select("doc_id", F.when(n > 0, altered).otherwise(F.col("text")).alias("text"))


@query("op11_frequency_split_runs")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Null doc_id: the text as it is."""
    found = periodic.find_runs(periodic_documents(table(spark, folder, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    described = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    period = -F.col("top.shorter")
    return described.select(
        "doc_id",
        "n_runs",
        (-F.col("top.before")).alias("start"),
        F.col("top.length").alias("length"),
        period.alias("period"),
        F.floor(1000 * F.col("top.length") / period).alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


@query("op12_event_sourced_chat")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of one turn: by a hash of role and text. Null roles are empty, null conversations are one."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.element_at(F.array(F.lit("user"), F.lit("assistant")), (F.col("id") + 1).cast("int")).alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    log = chat.as_log(turns.unionByName(probe), "conv_id", "turn")
    pieces_ = chat.rebuild_and_render(log, "conv_id", ["of_turn", "of_tie", "of_row", "of_step"], ["turn", "tie", "row", "step"])
    return chat.read_back(pieces_, "conv_id")


@query("op13_exact_polynomial_whitening")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each usable vector and component."""
    found = whitening.whiten(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    w = "whitening."
    each = found.select("vec_id", f"{w}n", f"{w}deviation", f"{w}explained", f"{w}identity_error", F.posexplode(f"{w}whitened").alias("at", "whitened"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", F.element_at("explained", F.col("at") + 1).alias("explained"), "identity_error")
