"""Scaling, outlier flags, derived numeric columns and feature filters.

``fit_*`` runs one aggregation and returns a few numbers per column; applying them is a projection, so the same fit
serves training, test and streaming data.
"""
from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import combinations, combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwise.operators.aggregates import ratio
from panelwise.operators.ranking import exact_quantiles
from panelwise.operators.skew import col

VARIANCE_THRESHOLD, CORRELATION_THRESHOLD, IQR_FACTOR = 0.01, 0.95, 1.5

Fit = Mapping[str, tuple[float, float]]


def _fit_pairs(df: DataFrame, columns: Sequence[str], a, b) -> Fit:
    row = df.agg(*[x for c in columns for x in (a(col(c)).cast("double"), b(col(c)).cast("double"))]).first()
    return {c: (row[2 * i], row[2 * i + 1]) for i, c in enumerate(columns)}


def _apply(df: DataFrame, fit: Fit, suffix: str) -> DataFrame:
    """(value - center) / spread, the difference alone where the spread is 0."""
    added = {}
    for c, (center, spread) in fit.items():
        shifted = col(c) - F.lit(center)
        added[f"{c}{suffix}"] = shifted / F.lit(spread) if spread else shifted
    return df.withColumns(added)


def fit_standard(df: DataFrame, columns: Sequence[str]) -> Fit:
    """(mean, population deviation) per column."""
    return _fit_pairs(df, columns, F.avg, F.stddev_pop)


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> Fit:
    """(min, max - min) per column."""
    found = _fit_pairs(df, columns, F.min, F.max)
    return {c: (lo, hi - lo if hi is not None else None) for c, (lo, hi) in found.items()}


def fit_quartiles(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> dict[str, tuple[float, float, float]]:
    """(q1, median, q3) per column, exact and interpolated, or from a sketch if ``approximate``."""
    if approximate:
        row = df.agg(*[F.percentile_approx(col(c), [0.25, 0.5, 0.75], 10_000) for c in columns]).first()
        return {c: tuple(float(x) for x in row[i]) for i, c in enumerate(columns)}
    found = exact_quantiles(df, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return {r["name"]: (r["q1"], r["median"], r["q3"]) for r in found.collect()}


def fit_robust(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> Fit:
    """(median, q3 - q1) per column."""
    return {c: (m, q3 - q1) for c, (q1, m, q3) in fit_quartiles(df, columns, approximate).items()}


def scale(df: DataFrame, fit: Fit, suffix: str = "_scaled") -> DataFrame:
    return _apply(df, fit, suffix)


def flag_outliers(
    df: DataFrame, columns: Sequence[str], factor: float = IQR_FACTOR, approximate: bool = False, fit_on: DataFrame | None = None
) -> DataFrame:
    """``{column}_outlier``: 1 where the value lies more than ``factor`` x IQR outside the quartiles."""
    quartiles = fit_quartiles(df if fit_on is None else fit_on, columns, approximate)
    added = {}
    for c, (q1, _, q3) in quartiles.items():
        reach = factor * (q3 - q1)
        added[f"{c}_outlier"] = F.when((col(c) < q1 - reach) | (col(c) > q3 + reach), 1).otherwise(0)
    return df.withColumns(added)


def missing_indicators(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{c}_missing": col(c).isNull().cast("int") for c in columns})


def variances(df: DataFrame, columns: Sequence[str], threshold: float = VARIANCE_THRESHOLD) -> DataFrame:
    """Rows (column, variance, kept): population variance, kept if strictly above the threshold; one pass."""
    stats = df.agg(*[F.var_pop(col(c).cast("double")).alias(c) for c in columns])
    cells = [F.struct(F.lit(c).alias("column"), col(c).alias("variance"), (col(c) > threshold).alias("kept")) for c in columns]
    return stats.select(F.inline(F.array(*cells)))


def varying_columns(df: DataFrame, columns: Sequence[str], threshold: float = VARIANCE_THRESHOLD) -> list[str]:
    kept = {r["column"] for r in variances(df, columns, threshold).collect() if r["kept"]}
    return [c for c in columns if c in kept]


def _merge_moments(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    """Chan's rule for (n, mean of i, mean of j, squared deviations of i, of j, products of deviations), elementwise."""
    n = a[0] + b[0]
    w = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    di, dj = b[1] - a[1], b[2] - a[2]
    both = a[0] * w
    return [n, a[1] + di * w, a[2] + dj * w, a[3] + b[3] + di * di * both, a[4] + b[4] + dj * dj * both, a[5] + b[5] + di * dj * both]


def _pair_moments(x: np.ndarray) -> list[np.ndarray]:
    """Moments of every pair of columns over the rows where both have a value, by products of whole matrices."""
    known = ~np.isnan(x)
    count = np.maximum(known.sum(axis=0), 1)
    shift = np.where(known, x, 0.0).sum(axis=0) / count
    z, m = np.where(known, x - shift, 0.0), known.astype(np.float64)
    n, first = m.T @ m, z.T @ m  # first[i, j]: sum of i where j is known
    part = np.maximum(n, 1.0)
    mean = first / part
    square = (z * z).T @ m
    return [n, shift[:, None] + mean, shift[None, :] + mean.T, square - first * mean, (square - first * mean).T, z.T @ z - first * mean.T]


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (left, right, correlation) for every pair of columns, over the rows where both have a value that is a number.

    One pass: tasks multiply whole blocks of rows, and their matrices are merged a row at a time, so the plan has no
    expression per pair. Null for pairs of fewer than two such rows, or where a column has one value only.
    """
    k, names = len(columns), list(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = np.stack([np.asarray(batch.column(i).to_numpy(zero_copy_only=False), dtype=np.float64) for i in range(k)], axis=1)
            for at in range(0, len(x), 8192):
                here = _pair_moments(x[at : at + 8192])
                total = here if total is None else _merge_moments(total, here)
        if total is not None:
            moments = np.stack(total, axis=1)  # by column: its six rows of numbers
            yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array([m.ravel().tolist() for m in moments], pa.list_(pa.float64()))], names=["i", "moments"])

    def merge(rows: pa.Table) -> pa.Table:
        parts = sorted(r.as_py() for r in rows.column("moments"))  # sorted: the sums don't depend on the order of tasks
        total = None
        for p in parts:
            here = list(np.array(p).reshape(6, k))
            total = here if total is None else _merge_moments(total, here)
        i = rows.column("i")[0].as_py()
        n, mean_i, mean_j, a, b, both = total
        varies = (a > n * (1e-13 * mean_i) ** 2) & (b > n * (1e-13 * mean_j) ** 2)  # beyond the rounding of equal values
        value = np.divide(both, np.sqrt(np.abs(a * b)), out=np.full(k, np.nan), where=(n > 1) & varies)
        later = range(i + 1, k)
        return pa.table({"left": pa.array([names[i]] * len(later), pa.string()), "right": pa.array([names[j] for j in later], pa.string()), "correlation": pa.array([None if np.isnan(value[j]) else float(value[j]) for j in later], pa.float64())})

    parts = df.select(*[col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)]).mapInArrow(run, "i int, moments array<double>")
    return parts.groupBy("i").applyInArrow(merge, "left string, right string, correlation double")


def uncorrelated_columns(df: DataFrame, columns: Sequence[str], threshold: float = CORRELATION_THRESHOLD) -> list[str]:
    """Columns kept, in order, when each drops the later ones it correlates with beyond the threshold."""
    strong = {(r["left"], r["right"]) for r in correlations(df, columns).collect() if abs(r["correlation"] or 0.0) > threshold}
    kept: list[str] = []
    for c in columns:
        if not any((k, c) in strong for k in kept):
            kept.append(c)
    return kept


def interactions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``{a}_x_{b}`` for every pair of the given columns."""
    return df.withColumns({f"{a}_x_{b}": col(a) * col(b) for a, b in combinations(columns, 2)})


def polynomials(df: DataFrame, columns: Sequence[str], degree: int = 2) -> DataFrame:
    """Powers ``{a}_pow{d}`` up to the degree and, at each degree from 2, the products of different columns."""
    added: dict[str, Column] = {}
    for d in range(2, degree + 1):
        for combo in combinations_with_replacement(columns, d):
            value = col(combo[0])
            for c in combo[1:]:
                value = value * col(c)
            added[f"{combo[0]}_pow{d}" if len(set(combo)) == 1 else "_x_".join(combo)] = value
    return df.withColumns(added)


def period_confidence(df: DataFrame, period: str, out: str = "diagnostic_confidence") -> DataFrame:
    """(period - first) / (last - first), divisor 1 if all are equal. The range is one row, found once."""
    span = df.agg(F.struct(F.min(col(period)).alias("lo"), F.max(col(period)).alias("hi")).alias("s")).scalar()
    wide = df.withColumn("_s", span)
    width = F.when(F.col("_s.hi") == F.col("_s.lo"), F.lit(1)).otherwise(F.col("_s.hi") - F.col("_s.lo"))
    return wide.withColumn(out, (col(period) - F.col("_s.lo")).cast("double") / width).drop("_s")


def cumulative_risk(df: DataFrame, age: str, period: str, out: str = "cumulative_risk_factor", pivot: float = 65.0) -> DataFrame:
    """(age - pivot) * (period - first period) / 10."""
    first = df.agg(F.min(col(period))).scalar()
    return df.withColumn(out, (col(age) - pivot) * (col(period) - first) / 10)


def uncertainty_columns(df: DataFrame, age: str = "age", period: str = "year") -> DataFrame:
    """``diagnostic_confidence`` and ``cumulative_risk_factor``; without a period, 0.5 and (age - 65) / 10."""
    if period in df.columns:
        return cumulative_risk(period_confidence(df, period), age, period)
    return df.withColumns({"diagnostic_confidence": F.lit(0.5), "cumulative_risk_factor": (col(age) - 65.0) / 10})
