"""A corpus pipeline over ``documents``: each stage reads what the one before it kept, from a table."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.llm import decontaminate, jaccard, language, pieces, secrets
from panelwise.llm.shared import store

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def accepted_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those without letters, or between languages, go."""
    return language.identify(docs, F.col("lang"), F.col("source")).where("accepted").select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share 0.8 of their five-word shingles, or are linked by such, the one with the smallest id.

    Documents without words, or in a group without any id, all stay. Of repeated rows one stays.
    """
    classed = jaccard.similar_documents(docs, size=5, percent=80)
    alone = (F.col("n_shingles") == 0) | F.col("component_id").isNull()
    first = classed.where(~alone & (F.col("doc_id") == F.col("component_id"))).dropDuplicates(["component_id"])
    return first.unionByName(classed.where(alone)).select(*COLUMNS)


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.find_items(docs, items).where(F.size("findings") == 0).select(*COLUMNS)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return secrets.redact(docs).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text; ``text`` is what the ids decode to."""
    coded = pieces.encode_and_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", F.col("decoded").alias("text"), "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language ID", accepted_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_test_items),
    ("secret scans", without_secrets),
    ("SentencePiece encoding and decoding", tokens),
]

#: No SQL expresses trained models and piece merges; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = store(docs, "stage")
    return docs
