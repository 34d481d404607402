"""Data-quality checks that return small tables."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from panelwise.operators.skew import col


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their ``copies``."""
    return df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def grain_is_unique(df: DataFrame, keys: Sequence[str]) -> bool:
    return duplicate_keys(df, keys).isEmpty()


def type_differences(df: DataFrame, expected: StructType) -> DataFrame:
    """Rows (column_name, expected, actual) where the types differ; null stands for an absent column."""
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = [*want, *[c for c in have if c not in want]]
    rows = [(c, want.get(c), have.get(c)) for c in names if want.get(c) != have.get(c)]
    return df.sparkSession.createDataFrame(rows, "column_name string, expected string, actual string")


def missing_and_infinite(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows (column, missing, infinite) in one pass; missing covers null and NaN."""
    kinds: Mapping[str, object] = {f.name: f.dataType for f in df.schema.fields}
    used = list(columns or df.columns)
    sums = []
    for i, c in enumerate(used):
        floating = isinstance(kinds[c], (DoubleType, FloatType))
        missing = col(c).isNull() | F.isnan(col(c)) if floating else col(c).isNull()
        infinite = col(c).isin(float("inf"), float("-inf")) if floating else F.lit(False)
        sums += [F.count_if(missing).alias(f"m{i}"), F.count_if(F.coalesce(infinite, F.lit(False))).alias(f"i{i}")]
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing"), F.col(f"i{i}").alias("infinite"))
        for i, c in enumerate(used)
    ]
    return df.agg(*sums).select(F.inline(F.array(*cells)))
