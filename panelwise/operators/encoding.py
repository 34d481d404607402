"""Encodings of categorical columns: one-hot, label codes, target means, capped categories."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwise.operators.panel import small_distinct
from panelwise.operators.skew import col, lookup
from panelwise.session import write_and_read

MAX_CATEGORIES = 50
#: A column of more values is not made into dummies unless ``max_categories`` says how many to keep.
MAX_COLUMNS = 10_000
OTHER, UNKNOWN = "other", "unknown"


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(col(column)).distinct()


def top_values(df: DataFrame, column: str, n: int = MAX_CATEGORIES) -> DataFrame:
    """The ``n`` most frequent non-null values, ties by value."""
    counts = df.filter(col(column).isNotNull()).groupBy(col(column)).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), col(column)).limit(n)


def cap_categories(df: DataFrame, column: str, n: int = MAX_CATEGORIES, other: str = OTHER, fit_on: DataFrame | None = None) -> DataFrame:
    """Values beyond the ``n`` most frequent become ``other``; null stays null. At most ``n`` rows are broadcast."""
    kept = top_values(df if fit_on is None else fit_on, column, n).select(col(column).alias("_kept"))
    joined = df.join(F.broadcast(kept), col(column) == F.col("_kept"), "left")
    value = F.when(col(column).isNull() | F.col("_kept").isNotNull(), col(column)).otherwise(F.lit(other))
    return joined.select(*[value.alias(c) if c == column else col(c) for c in df.columns])


def one_hot(df: DataFrame, columns: Sequence[str], max_categories: int | None = None, fit_on: DataFrame | None = None) -> DataFrame:
    """``{column}_{value}`` 0/1 columns for every non-null value, in value order; null gives all zeros. More than
    ``MAX_COLUMNS`` values are refused.

    With ``max_categories`` the rarer values of a column with more count together as ``{column}_other``, or
    ``other_``, ``other__`` and so on if a kept value already has that name.
    """
    source = df if fit_on is None else fit_on
    added: dict[str, Column] = {}
    for c in columns:
        if max_categories is None:
            values = small_distinct(source, c, MAX_COLUMNS)
            if values is None:
                raise ValueError(f"{c} has more than {MAX_COLUMNS} values; set max_categories")
        else:
            values = small_distinct(source, c, max_categories)
        if values is None:
            kept = sorted(r[0] for r in top_values(source, c, max_categories).collect())
            added |= {f"{c}_{v}": _is(c, v) for v in kept}
            other = OTHER
            while f"{c}_{other}" in added:
                other += "_"
            added[f"{c}_{other}"] = F.coalesce(~col(c).isin(kept), F.lit(False)).cast("int")
        else:
            added |= {f"{c}_{v}": _is(c, v) for v in values}
    return df.withColumns(added)


def _is(column: str, value: object) -> Column:
    return F.coalesce(col(column) == F.lit(value), F.lit(False)).cast("int")


def label_index(df: DataFrame, column: str) -> DataFrame:
    """Codes of the non-null values in value order, from 0: rows (column, code). Fitted once, then reused.

    The values are range-sorted into a stored table, whose files are consecutive ranges; a value's code is its place in
    its file plus the sizes of the files before it.
    """
    values = df.select(col(column)).filter(col(column).isNotNull()).distinct()
    stored = write_and_read(values.orderBy(col(column)), "label-index")
    stored = stored.select(col(column), F.col("_metadata.file_path").alias("_file"))
    files = stored.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"), F.min(col(column)).alias("_first"))
    earlier = W.partitionBy(F.lit(0)).orderBy("_first").rowsBetween(W.unboundedPreceding, -1)
    files = files.select("_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    # One row per written file, at most the number of shuffle partitions.
    placed = stored.join(F.broadcast(files), "_file")
    at = F.row_number().over(W.partitionBy("_file").orderBy(col(column)))
    return placed.select(col(column), (F.col("_before") + at - 1).cast("bigint").alias("code"))


def label_encode(df: DataFrame, column: str, index: DataFrame, out: str | None = None) -> DataFrame:
    """``{column}_encoded``: code of the value, -1 for null and for values the index lacks."""
    out = out or f"{column}_encoded"
    coded = lookup(df, index.withColumnRenamed("code", out), column)
    return coded.withColumn(out, F.coalesce(col(out), F.lit(-1).cast("bigint")))


def category_codes(df: DataFrame, indexes: Mapping[str, DataFrame]) -> DataFrame:
    """Each indexed column replaced by its code."""
    order = df.columns
    for c, index in indexes.items():
        df = label_encode(df, c, index, out="_code").drop(c).withColumnRenamed("_code", c)
    return df.select(*[col(c) for c in order])


def target_means(df: DataFrame, column: str, label: str) -> DataFrame:
    """Rows (column, target_mean): share of positives per value, null being a value of its own."""
    return df.groupBy(col(column)).agg(F.avg(col(label).cast("double")).alias("target_mean"))


def target_encode(df: DataFrame, train: DataFrame, column: str, label: str) -> DataFrame:
    """``{column}_target``: the value's share of positives in ``train``, the overall share for unseen values."""
    overall = train.agg(F.avg(col(label).cast("double"))).first()[0]
    out = f"{column}_target"
    coded = lookup(df, target_means(train, column, label).withColumnRenamed("target_mean", out), column)
    return coded.withColumn(out, F.coalesce(col(out), F.lit(overall)))


def fill_unknown(df: DataFrame, columns: Sequence[str], value: str = UNKNOWN) -> DataFrame:
    return df.na.fill(value, list(columns))
