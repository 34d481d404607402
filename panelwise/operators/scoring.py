"""Batch scoring of valid records with a stored model or with the rule score."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.functions.rules import at_threshold, score_report, weighted_score
from panelwise.functions.validation import REQUEST_RANGES, split_valid
from panelwise.operators.learning import Trained, with_score
from panelwise.operators.projection import align
from panelwise.operators.skew import col


def score_with_model(df: DataFrame, trained: Trained, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns, score, 0/1 label at the stored threshold, and the risk report.

    Features are aligned to the model's list, so extra columns are ignored and missing ones get their default.
    """
    scored = with_score(trained.model, align(df, trained.features, keep))
    labelled = scored.withColumn("label", at_threshold("score", trained.threshold)).withColumns(score_report("score"))
    return labelled.select(*[col(c) for c in keep], "score", "label", "risk_level", "confidence", "prediction", "probability")


def score_with_rules(df: DataFrame, threshold: float) -> DataFrame:
    """The frame with the additive risk score, its label and its report; a projection only."""
    scored = df.withColumn("score", weighted_score())
    return scored.withColumn("label", at_threshold("score", threshold)).withColumns(score_report("score"))


def validate_and_score(df: DataFrame, threshold: float, rules=REQUEST_RANGES) -> tuple[DataFrame, DataFrame]:
    """(scored valid records, rejected records with their violations)."""
    valid, rejected = split_valid(df, rules)
    return score_with_rules(valid, threshold), rejected.withColumn("n_violations", F.size("violations"))


def prediction_log(scored: DataFrame, inputs: tuple[str, ...], version: str, elapsed_ms: float | None = None) -> DataFrame:
    """Log rows of scored records: id, time, inputs as a map, risk, level, confidence, version and mean latency.

    ``scored`` has the columns of ``score_with_model`` or ``score_with_rules`` next to ``inputs``; ``elapsed_ms`` is the time of the
    whole batch, shared out evenly. Ids tell rows of one batch apart.
    """
    names = [x for c in inputs for x in (F.lit(c), col(c).cast("string"))]
    latency = F.lit(None).cast("double") if elapsed_ms is None else F.lit(float(elapsed_ms)) / scored.agg(F.count(F.lit(1))).scalar()
    return scored.select(
        F.uuid().alias("prediction_id"), F.current_timestamp().alias("logged_at"), F.create_map(*names).alias("inputs"),
        F.col("score").alias("alzheimers_risk_probability"), "risk_level", "confidence", F.lit(version).alias("model_version"), latency.alias("processing_time_ms"),
    )
