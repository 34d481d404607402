"""Summary tables: prevalence, class balance, imputation values, log metrics."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwise.operators.ranking import exact_quantiles
from panelwise.operators.skew import col


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, 0 where the denominator is 0 or null."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator), F.lit(0.0))


def _prevalence(label: str) -> list[Column]:
    rows, positives = F.count(F.lit(1)), F.coalesce(F.sum(col(label).cast("bigint")), F.lit(0).cast("bigint"))
    return [rows.alias("total_rows"), positives.alias("positive_cases"), ratio(positives, rows).alias("prevalence")]


def prevalence(df: DataFrame, label: str) -> DataFrame:
    """One row: total_rows, positive_cases, prevalence (0 on no rows)."""
    return df.agg(*_prevalence(label))


def prevalence_by(df: DataFrame, label: str, period: str) -> DataFrame:
    return df.groupBy(col(period)).agg(*_prevalence(label))


def prevalence_rollup(df: DataFrame, label: str, period: str) -> DataFrame:
    """Per period and in total, in one pass; ``is_total`` marks the total row, whose period is null."""
    out = df.rollup(col(period)).agg(F.grouping(col(period)).cast("int").alias("is_total"), *_prevalence(label))
    return out


def majority_label(df: DataFrame, entity: str, label: str, out: str = "majority") -> DataFrame:
    """Per entity: 1 if more than half of its rows are positive, a tie gives 0."""
    majority = F.sum(col(label)) * 2 > F.count(F.lit(1))
    return df.groupBy(col(entity)).agg(F.coalesce(majority, F.lit(False)).cast("int").alias(out))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """One row: negatives, positives, positive_rate and neg_pos_ratio (divisor at least 1)."""
    positives, negatives = F.count_if(col(label) == 1), F.count_if(col(label) == 0)
    return df.agg(
        negatives.alias("negatives"),
        positives.alias("positives"),
        ratio(positives, F.count(F.lit(1))).alias("positive_rate"),
        (negatives / F.greatest(positives, F.lit(1))).alias("neg_pos_ratio"),
    )


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Rows (column, n_distinct) of non-null values.

    Values are made distinct as (column, value) pairs, map-side first, so that a frequent value is one row after
    the scan; ``approximate`` uses a sketch of fixed size instead.
    """
    if approximate:
        counted = df.agg(*[F.approx_count_distinct(col(c)).alias(c) for c in columns])
        cells = [F.struct(F.lit(c).alias("column"), col(c).alias("n_distinct")) for c in columns]
        return counted.select(F.inline(F.array(*cells)))
    cells = [F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in columns]
    pairs = df.select(F.inline(F.array(*cells))).distinct()
    return pairs.groupBy("column").agg(F.count("value").alias("n_distinct"))


def top_cardinality(df: DataFrame, columns: Sequence[str], k: int = 50, approximate: bool = False) -> DataFrame:
    """The ``k`` columns of most distinct values, ties by name; all of them where there are no more than ``k``."""
    return distinct_counts(df, columns, approximate).orderBy(F.desc("n_distinct"), "column").limit(k)


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (name, n, median), exact and interpolated."""
    return exact_quantiles(df, columns, {"median": 0.5})


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (name, mode): the most frequent non-null value as a string, the smallest on ties."""
    cells = [F.struct(F.lit(c).alias("name"), col(c).cast("string").alias("value")) for c in columns]
    counts = df.select(F.inline(F.array(*cells))).filter(F.col("value").isNotNull())
    counts = counts.groupBy("name", "value").agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy("name").agg(F.min(F.struct(-F.col("_n"), F.col("value")))["value"].alias("mode"))


def impute(df: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = ()) -> DataFrame:
    """Nulls and NaN become the median of a numeric, the mode of a categorical column ("0" if it has no value).

    The fitted values are one small row per column; the fill itself is a projection.
    """
    fill: dict[str, Column] = {}
    if numeric:
        found = {r["name"]: r["median"] for r in medians(df, numeric).collect()}
        for c in numeric:
            value = F.when(~F.isnan(col(c).cast("double")), col(c).cast("double"))
            fill[c] = F.coalesce(value, F.lit(found.get(c)).cast("double"))
    if categorical:
        found = {r["name"]: r["mode"] for r in modes(df, categorical).collect()}
        fill |= {c: F.coalesce(col(c), F.lit(found.get(c, "0"))) for c in categorical}
    return df.withColumns(fill)


def warehouse_summary(df: DataFrame, entity: str, period: str, value: str, label: str) -> DataFrame:
    """The statistics query of the warehouse table, in SQL."""
    return df.sparkSession.sql(
        f"""
        SELECT count(*) AS total_rows,
               count(DISTINCT `{entity}`) AS unique_entities,
               min(`{period}`) AS min_period,
               max(`{period}`) AS max_period,
               avg(`{value}`) AS avg_value,
               sum(CASE WHEN `{label}` = 1 THEN 1 ELSE 0 END) AS positive_cases
        FROM {{panel}}
        """,
        panel=df,
    )


def schema_rows(df: DataFrame) -> DataFrame:
    """Rows (position, column_name, data_type)."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def recent_predictions(log: DataFrame, ts: str, tiebreak: str, level: str, latency: str, last: int = 100) -> DataFrame:
    """Metrics over the ``last`` predictions: count, high-risk count and percent, mean latency to two decimals.

    Missing and zero latencies do not enter the mean; it is 0 if none is left.
    """
    recent = log.select(col(ts), col(tiebreak), col(level), col(latency)).orderBy(F.desc(ts), F.desc(tiebreak)).limit(last)
    high = F.count_if(col(level).isin("High", "Very High"))
    total = F.count(F.lit(1))
    return recent.agg(
        total.alias("total_predictions"),
        high.alias("high_risk_predictions"),
        (ratio(high, total) * 100).alias("high_risk_percentage"),
        F.round(F.coalesce(F.avg(F.when(col(latency) != 0, col(latency))), F.lit(0.0)), 2).alias("average_processing_time_ms"),
    )


def importance_summary(importances: DataFrame, column: str = "importance") -> DataFrame:
    """Mean and population deviation of feature importances."""
    return importances.agg(F.avg(col(column)).alias("importance_mean"), F.stddev_pop(col(column)).alias("importance_std"))


def top_features(importances: DataFrame, k: int, name: str = "feature", column: str = "importance") -> DataFrame:
    """The ``k`` most important features, ties by name."""
    return importances.orderBy(F.desc(column), col(name)).limit(k)


def row_count(df: DataFrame) -> DataFrame:
    """Row count; the scan reads no column."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"))
