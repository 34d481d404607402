"""Evaluation of scored rows: ranking metrics, thresholds and time-window hits in one row."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwise.operators.evaluation import fallback_threshold, metrics_at, ranking_metrics, threshold_sweep, window_hits


def evaluate(df: DataFrame, entity: str, period: str, label: str, score: str, years: int = 1) -> DataFrame:
    """One row: auc, average_precision, both thresholds, metrics at the optimum and the time-window hit rate.

    The optimum (one number) is found first, because the later metrics depend on it.
    """
    thresholds = fallback_threshold(threshold_sweep(df, label, score))
    best = thresholds.first()
    at_best = metrics_at(df, label, score, best["optimal_threshold"]).drop("threshold")
    hits = window_hits(df, entity, period, label, score, best["optimal_threshold"], years)

    def only(row: DataFrame) -> Column:
        return row.select(F.struct("*")).scalar()

    return hits.select(
        only(ranking_metrics(df, label, score)).alias("_ranking"), only(at_best).alias("_at"), "*", *[F.lit(best[c]).alias(c) for c in thresholds.columns]
    ).select("_ranking.*", "_at.*", *hits.columns, *thresholds.columns)
