"""Run log: parameters and metrics as a long, append-only table."""
from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "run_name string, kind string, seq int, key string, value string"


def run_rows(spark: SparkSession, run_name: str, params: Mapping[str, object], metrics: Sequence[Mapping[str, float]]) -> DataFrame:
    """Parameters (seq 0) and one group of rows per metric map, in call order."""
    rows = [(run_name, "param", 0, k, str(v)) for k, v in params.items()]
    for i, group in enumerate(metrics, start=1):
        rows += [(run_name, "metric", i, k, repr(float(v)) if not math.isnan(float(v)) else None) for k, v in group.items()]
    return spark.createDataFrame(rows, SCHEMA)


def metric_rows(metrics: DataFrame, run_name: str, seq: int, key: str, value: str) -> DataFrame:
    """Run-log rows from a metric DataFrame, without passing it through the driver."""
    return metrics.select(
        F.lit(run_name).alias("run_name"), F.lit("metric").alias("kind"), F.lit(seq).alias("seq"),
        F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value"),
    )


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Rows (run_name, seq, key, value double) of the logged metrics."""
    log = spark.read.schema(SCHEMA).parquet(path).filter(F.col("kind") == "metric")
    return log.select("run_name", "seq", "key", F.col("value").cast("double").alias("value"))
