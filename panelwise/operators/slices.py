"""Metrics per slice of the data, and fairness gaps between slices."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwise.operators.evaluation import _ranking_aggregates, valid
from panelwise.operators.ranking import running_totals
from panelwise.operators.skew import col

Slices = Mapping[str, Mapping[str, Column]]

AUC_GAP_ALERT, PARITY_ALERT = 0.1, 0.15


def default_slices() -> Slices:
    """Slices by age, gender and education; they overlap nowhere but leave gaps, e.g. between 65 and 66."""
    age, years = F.col("age"), F.col("education_years")
    # fixed values
    return {
        "age_groups": {
            "Young (50-65)": (age >= 50) & (age <= 65),
            "Middle (66-80)": (age >= 66) & (age <= 80),
            "Elderly (81+)": age >= 81,
        },
        "gender": {"Male": F.col("gender") == "M", "Female": F.col("gender") == "F"},
        "education": {
            "Low (<12 years)": years < 12,
            "Medium (12-16 years)": (years >= 12) & (years <= 16),
            "High (>16 years)": years > 16,
        },
    }


def slice_rows(df: DataFrame, label: str, score: str, slices: Slices) -> DataFrame:
    """One row (feature_type, slice, ordinal, label, score) per slice a row belongs to, from one scan."""
    tags = []
    for feature_type, members in slices.items():
        for ordinal, (name, condition) in enumerate(members.items()):
            tag = F.struct(F.lit(feature_type).alias("feature_type"), F.lit(name).alias("slice"), F.lit(ordinal).alias("ordinal"))
            tags.append(F.when(condition, tag))
    return df.select(col(label).alias("label"), col(score).cast("double").alias("score"), F.inline(F.array_compact(F.array(*tags))))


def slice_metrics(df: DataFrame, label: str, score: str, slices: Slices | None = None) -> DataFrame:
    """Per slice: sample_size, auc, average_precision, positive_rate, max_f1, prediction_mean, prediction_std.

    Everything comes from one (slice, score) histogram with running totals. Empty slices yield no row; AUC is null
    where a slice has one class only.
    """
    keys = ["feature_type", "slice", "ordinal"]
    slices = default_slices() if slices is None else slices
    tagged = slice_rows(valid(df, label, score), label, score, slices)
    hist = tagged.groupBy(*keys, "score").agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n"))
    hist = hist.withColumn("_sum", F.col("score") * (F.col("p") + F.col("n")))
    sums = {"cum_p": "p", "cum_n": "n", "_upto": "_sum"}
    ranked = running_totals(hist, sums, "score", group=keys, descending=True)
    weight = F.col("p") + F.col("n")
    total = F.col("cum_p_total") + F.col("cum_n_total")
    off = F.col("score") - F.col("_upto_total") / total
    precision = F.try_divide(F.col("cum_p").cast("double"), F.col("cum_p") + F.col("cum_n"))
    recall = F.coalesce(F.try_divide(F.col("cum_p").cast("double"), F.col("cum_p_total")), F.lit(0.0))
    return ranked.groupBy(*keys).agg(
        F.max(total).alias("sample_size"),
        *_ranking_aggregates(),
        F.max(F.col("cum_p_total") / total).alias("positive_rate"),
        F.max(2 * precision * recall / (precision + recall + 1e-8)).alias("max_f1"),
        F.max(F.col("_upto_total") / total).alias("prediction_mean"),
        F.sqrt(F.sum(off * off * weight / total)).alias("prediction_std"),
    )


def fairness(metrics: DataFrame) -> DataFrame:
    """Per feature type of at least two slices: spread of positive rates and of AUC between its slices."""
    parity = F.max("positive_rate") - F.min("positive_rate")
    odds = F.max("auc") - F.min("auc")
    spread = metrics.groupBy("feature_type").agg(
        F.count(F.lit(1)).alias("_slices"),
        parity.alias("demographic_parity_difference"),
        odds.alias("equalized_odds_difference"),
        odds.alias("auc_gap"),
        parity.alias("positive_rate_gap"),
    )
    return spread.filter("_slices >= 2").drop("_slices")


def gap_to_first(metrics: DataFrame) -> DataFrame:
    """Metrics with ``auc_gap_to_first``: AUC minus that of the feature type's first slice that has rows."""
    first = F.first("auc").over(W.partitionBy("feature_type").orderBy("ordinal"))
    return metrics.withColumn("auc_gap_to_first", F.col("auc") - first)


def fairness_alerts(gaps: DataFrame, auc_gap: float = AUC_GAP_ALERT, parity: float = PARITY_ALERT) -> DataFrame:
    """Rows (feature_type, alert, gap) where a spread exceeds its bound."""
    alerts = F.array_compact(
        F.array(
            F.when(F.col("auc_gap") > auc_gap, F.struct(F.lit("large AUC gap").alias("alert"), F.col("auc_gap").alias("gap"))),
            F.when(
                F.col("demographic_parity_difference") > parity,
                F.struct(F.lit("high demographic parity difference").alias("alert"), F.col("demographic_parity_difference").alias("gap")),
            ),
        )
    )
    return gaps.select("feature_type", F.inline(alerts))
