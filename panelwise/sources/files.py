"""Reading and writing panels as files and catalog tables."""
from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelwise.operators.skew import col

#: Size of the files that ``write_sized`` aims at.
TARGET_FILE_BYTES = 100 * 1024 * 1024


def _folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders directly below ``root``; one listing call, no data is read."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(f.getPath().getName() for f in found if f.isDirectory())


def read_hive_years(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """Folders ``year=YYYY``: ``year`` comes from the folder and prunes the scan."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(root)


def read_numeric_years(spark: SparkSession, root: str, years: Sequence[int] | None = None, schema: StructType | None = None) -> DataFrame:
    """Folders named by year only. Each is a branch of a union with a constant ``year``, so a filter on it drops
    the other branches."""
    if years is None:
        years = [int(f) for f in _folders(spark, root) if f.isdigit()]
    if not years:
        raise ValueError(f"no year folders below {root}")
    reader = spark.read.schema(schema) if schema else spark.read
    parts = [reader.parquet(f"{root}/{y}").drop("year").withColumn("year", F.lit(int(y))) for y in years]
    return reduce(DataFrame.unionByName, parts)


def read_recursive(spark: SparkSession, root: str, year_from_path: str | None = None) -> DataFrame:
    """All Parquet files below ``root``. They must carry ``year``, unless the pattern takes it from the file path."""
    df = spark.read.option("recursiveFileLookup", True).parquet(root)
    if year_from_path:
        found = F.regexp_extract(F.col("_metadata.file_path"), year_from_path, 1)
        return df.withColumn("year", F.when(found != "", found).cast("int"))
    if "year" not in df.columns:
        raise ValueError("no 'year' column and no year folders")
    return df


def read_panel(spark: SparkSession, root: str) -> DataFrame:
    """A panel below ``root``: ``year=YYYY`` folders, numeric folders, or both; else files that carry ``year``."""
    folders = _folders(spark, root)
    hive = [f for f in folders if re.fullmatch(r"year=\d{4}", f)]
    numeric = [int(f) for f in folders if f.isdigit()]
    parts = []
    if hive:
        parts.append(spark.read.option("basePath", root).parquet(*[f"{root}/{f}" for f in hive]))
    if numeric:
        parts.append(read_numeric_years(spark, root, numeric))
    return reduce(DataFrame.unionByName, parts) if parts else read_recursive(spark, root)


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV by its suffix, Parquet otherwise (file or folder). CSV without a schema is read as strings."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.option("header", True).csv(path) if path.endswith(".csv") else reader.parquet(path)


def write_years(df: DataFrame, path: str, year: str = "year", mode: str = "overwrite") -> None:
    """One folder per year. Overwriting replaces the years that are in ``df`` and leaves the others.

    The rebalance hint gathers a year's rows into few files and splits large years over several tasks.
    """
    writer = df.hint("rebalance", col(year)).write.partitionBy(year).mode(mode)
    writer.option("partitionOverwriteMode", "dynamic").option("compression", "snappy").parquet(path)


def write_features(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Snappy Parquet, or CSV with a header; the format is the caller's choice."""
    if fmt == "parquet":
        df.write.mode(mode).option("compression", "snappy").parquet(path)
    elif fmt == "csv":
        df.write.mode(mode).option("header", True).csv(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def write_sized(df: DataFrame, path: str, target_bytes: int = TARGET_FILE_BYTES, mode: str = "overwrite") -> None:
    """Files of about ``target_bytes``: adaptive execution merges small and splits large partitions before writing."""
    with _setting(df.sparkSession, "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes)):
        df.hint("rebalance").write.mode(mode).parquet(path)


def load_warehouse_table(df: DataFrame, database: str, table: str, location: str | None = None) -> int:
    """Create the database if needed, replace the table by ``df`` and return its row count."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`" + (f" LOCATION '{location}'" if location else ""))
    df.write.mode("overwrite").format("parquet").saveAsTable(f"`{database}`.`{table}`")
    return spark.table(f"`{database}`.`{table}`").count()


def count_from_footers(spark: SparkSession, *paths: str) -> DataFrame:
    """``total_rows`` of Parquet files, from the row counts in their footers: the aggregate is pushed into the scan, which reads
    no column and returns one row a file."""
    with _settings(spark, _PUSHED):
        plan = _footer_counts(spark, paths)
        return spark.createDataFrame([(plan.first()[0],)], "total_rows bigint")


# Only the second version of the Parquet source takes aggregates.
_PUSHED = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text"}


def _footer_counts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.parquet(*paths).agg(F.count(F.lit(1)).alias("total_rows"))


@contextmanager
def _settings(spark: SparkSession, values: Mapping[str, str]):
    """Session settings for the time being."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
