"""Evaluation of a scored binary label: threshold metrics, exact ranking metrics, time-window hits."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from panelwise.operators.aggregates import ratio
from panelwise.operators.ranking import running_totals
from panelwise.operators.skew import col

# fixed values: the sixteen doubles of the sweep 0.1, 0.15 .. 0.85 as float arithmetic yields them, since
# comparisons with a score are inclusive; and the coarse sweep of eight
THRESHOLDS = (
    0.1, 0.15000000000000002, 0.20000000000000004, 0.25000000000000006, 0.30000000000000004, 0.3500000000000001,
    0.40000000000000013, 0.45000000000000007, 0.5000000000000001, 0.5500000000000002, 0.6000000000000002,
    0.6500000000000001, 0.7000000000000002, 0.7500000000000002, 0.8000000000000002, 0.8500000000000002,
)
COARSE_THRESHOLDS = (0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6, 0.7000000000000001, 0.8)
RECALL_TARGET = 0.8
FP_COST, FN_COST = 1.0, 3.0


def valid(df: DataFrame, label: str, score: str) -> DataFrame:
    """The rows that evaluation counts: those with a label and a score that is a number. Every function below starts
    here, so all of them count the same rows; ``skipped`` says how many others there are."""
    return df.filter(_is_valid(label, score))


def skipped(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row ``skipped``: rows without a label or a usable score."""
    return df.agg(F.count_if(~_is_valid(label, score)).alias("skipped"))


def _is_valid(label: str, score: str) -> Column:
    return col(label).isNotNull() & col(score).isNotNull() & ~F.isnan(col(score).cast("double"))


def _metrics(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """accuracy, precision, recall, f1; every division by zero gives 0."""
    return {
        "accuracy": ratio(tp + tn, tp + fp + fn + tn),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
    }


def confusion(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """One row tn, fp, fn, tp at an inclusive threshold."""
    positive, predicted = col(label) == 1, col(score) >= threshold
    return valid(df, label, score).agg(
        F.count_if(~positive & ~predicted).alias("tn"),
        F.count_if(~positive & predicted).alias("fp"),
        F.count_if(positive & ~predicted).alias("fn"),
        F.count_if(positive & predicted).alias("tp"),
    )


def metrics_at(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """One row (threshold, accuracy, precision, recall, f1)."""
    c = confusion(df, label, score, threshold)
    metrics = _metrics(col("tp"), col("fp"), col("fn"), col("tn"))
    return c.select(F.lit(threshold).alias("threshold"), *[m.alias(name) for name, m in metrics.items()])


def threshold_sweep(df: DataFrame, label: str, score: str, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Rows (threshold, tp, fp, fn, tn, accuracy, precision, recall, f1), all thresholds from one pass."""
    positive = col(label) == 1
    sums = [F.count_if(positive).alias("_p"), F.count(F.lit(1)).alias("_n")]
    for i, t in enumerate(thresholds):
        sums.append(F.count_if(positive & (col(score) >= t)).alias(f"_tp{i}"))
        sums.append(F.count_if(~positive & (col(score) >= t)).alias(f"_fp{i}"))
    cells = [
        F.struct(F.lit(t).alias("threshold"), F.col(f"_tp{i}").alias("tp"), F.col(f"_fp{i}").alias("fp"))
        for i, t in enumerate(thresholds)
    ]
    rows = valid(df, label, score).agg(*sums).select("_p", "_n", F.inline(F.array(*cells)))
    rows = rows.select("threshold", "tp", "fp", (F.col("_p") - F.col("tp")).alias("fn"), (F.col("_n") - F.col("_p") - F.col("fp")).alias("tn"))
    return rows.withColumns(_metrics(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")))


def _first_by(score: Column) -> Column:
    """The threshold of the lowest ``score``, the lowest threshold on ties."""
    return F.min(F.struct(score.alias("_s"), F.col("threshold")))["threshold"]


def best_f1_threshold(sweep: DataFrame, fallback: float | None = 0.5) -> DataFrame:
    """One row (threshold, f1) of the best F1, the lowest threshold on ties.

    If every F1 is 0 the threshold is ``fallback``, or the lowest one where ``fallback`` is None.
    """
    best, top = _first_by(-F.col("f1")), F.max("f1")
    if fallback is not None:
        best = F.when(top > 0, best).otherwise(F.lit(fallback))
    return sweep.agg(best.alias("threshold"), top.alias("f1"))


def balanced_threshold(sweep: DataFrame, fallback: float = 0.5) -> DataFrame:
    """One row (threshold, balance): best harmonic mean of precision and recall, taken from those two."""
    p, r = F.col("precision"), F.col("recall")
    balance = ratio(2 * p * r, p + r)
    return sweep.agg(
        F.when(F.max(balance) > 0, _first_by(-balance)).otherwise(F.lit(fallback)).alias("threshold"), F.max(balance).alias("balance")
    )


def cost_threshold(sweep: DataFrame, fp_cost: float = FP_COST, fn_cost: float = FN_COST) -> DataFrame:
    """One row (threshold, cost) of the least ``fp * fp_cost + fn * fn_cost``, the lowest threshold on ties."""
    cost = F.col("fp") * fp_cost + F.col("fn") * fn_cost
    return sweep.agg(_first_by(cost).alias("threshold"), F.min(cost).alias("cost"))


def fallback_threshold(sweep: DataFrame, recall: float = RECALL_TARGET) -> DataFrame:
    """One row: optimum by F1, and the first threshold that reaches the recall (the optimum if none does)."""
    best = _first_by(-F.col("f1"))
    first = F.min(F.when(F.col("recall") >= recall, F.struct("threshold", "recall")))
    at_best = F.min(F.struct((-F.col("f1")).alias("_s"), F.col("threshold"), F.col("recall")))["recall"]
    return sweep.agg(
        best.alias("optimal_threshold"),
        F.max("f1").alias("optimal_f1"),
        F.coalesce(first["threshold"], best).alias("fallback_threshold"),
        F.coalesce(first["recall"], at_best).alias("fallback_recall"),
    )


# --- ranking ------------------------------------------------------------------------------------------------------


def score_histogram(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """Rows ([group,] score, p, n): positives and negatives per distinct score."""
    return valid(df, label, score).groupBy(*[col(g) for g in group], col(score).cast("double").alias("score")).agg(
        F.count_if(col(label) == 1).alias("p"), F.count_if(col(label) == 0).alias("n")
    )


def cumulative(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """The histogram with cum_p and cum_n, the counts at this or a higher score, and their totals per group."""
    hist = score_histogram(df, label, score, group)
    return running_totals(hist, {"cum_p": "p", "cum_n": "n"}, "score", group=group, descending=True)


def _ranking_aggregates() -> list[Column]:
    """AUC and average precision over (p, n, cum_p, cum_n); null where a class is missing.

    A negative is beaten by the positives above it and half of those level with it. Counts are combined as integers
    and divided once at the end for AUC.
    """
    p_total, n_total = F.max("cum_p_total"), F.max("cum_n_total")
    beaten = 2 * F.col("cum_p") - F.col("p")
    wins = F.sum(F.col("n").cast("decimal(19,0)") * beaten.cast("decimal(19,0)"))
    steps = F.sum(F.try_divide(F.col("p") * F.col("cum_p").cast("double"), F.col("cum_p") + F.col("cum_n")))
    auc = F.try_divide(wins.cast("double"), 2.0 * p_total.cast("double") * n_total.cast("double"))
    ap = F.when(p_total > 0, steps / p_total)
    return [auc.alias("auc"), ap.alias("average_precision")]


def ranking_metrics(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """([group,] auc, average_precision), exact with ties."""
    ranked = cumulative(df, label, score, group)
    return ranked.groupBy(*[col(g) for g in group]).agg(*_ranking_aggregates())


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """Rows (score, fpr, tpr), one per distinct score."""
    ranked = cumulative(df, label, score)
    fpr, tpr = ratio(F.col("cum_n"), F.col("cum_n_total")), ratio(F.col("cum_p"), F.col("cum_p_total"))
    return ranked.select("score", fpr.alias("fpr"), tpr.alias("tpr"))


def pr_points(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """Rows ([group,] score, precision, recall), one per distinct score."""
    ranked = cumulative(df, label, score, group)
    precision, recall = ratio(F.col("cum_p"), F.col("cum_p") + F.col("cum_n")), ratio(F.col("cum_p"), F.col("cum_p_total"))
    return ranked.select(*[col(g) for g in group], "score", precision.alias("precision"), recall.alias("recall"))


def max_f1(df: DataFrame, label: str, score: str, group: Sequence[str] = (), eps: float = 1e-8) -> DataFrame:
    """([group,] max_f1): best F1 on the precision-recall curve, ``eps`` in the divisor."""
    p, r = F.col("precision"), F.col("recall")
    curve = pr_points(df, label, score, group)
    return curve.groupBy(*[col(g) for g in group]).agg(F.max(2 * p * r / (p + r + eps)).alias("max_f1"))


# --- time window --------------------------------------------------------------------------------------------------


def _window_result(hits: Column, positives: Column) -> list[Column]:
    return [
        F.coalesce(positives, F.lit(0)).cast("bigint").alias("window_positive_predictions"),
        F.coalesce(hits, F.lit(0)).cast("bigint").alias("window_hits"),
        ratio(hits, positives).alias("window_accuracy"),
    ]


def window_hits(df: DataFrame, entity: str, period: str, label: str, score: str, threshold: float, years: int = 1) -> DataFrame:
    """One row: positive predictions, and how many have a true label of the same entity within +-``years``.

    Rows are first reduced to one per (entity, period), so an entity's window never exceeds its distinct periods. A row
    without a period is a prediction that nothing can confirm.
    """
    hit = F.max(F.when(col(period).isNotNull(), (col(label) == 1).cast("int")))
    cells = valid(df, label, score).groupBy(col(entity).alias("entity"), col(period).cast("bigint").alias("period")).agg(
        F.count_if(col(score) >= threshold).alias("predicted"), hit.alias("hit")
    )
    around = W.partitionBy("entity").orderBy("period").rangeBetween(-years, years)
    near = cells.select("predicted", F.coalesce(F.max("hit").over(around), F.lit(0)).alias("near"))
    return near.agg(*_window_result(F.sum(F.when(F.col("near") == 1, F.col("predicted"))), F.sum("predicted")))


def window_hits_by_join(
    df: DataFrame, entity: str, period: str, label: str, score: str, threshold: float, years: int = 1
) -> DataFrame:
    """``window_hits`` as an interval join: each labelled (entity, period) is spread over the periods it covers,
    which makes the interval an equality and each side distinct."""
    df = valid(df, label, score)
    covered = (
        df.filter((col(label) == 1) & col(period).isNotNull())
        .select(col(entity).alias("entity"), col(period).cast("bigint").alias("period"))
        .distinct()
        .select("entity", F.explode(F.sequence(F.col("period") - years, F.col("period") + years)).alias("period"))
        .distinct()
        .withColumn("near", F.lit(1))
    )
    predicted = (
        df.filter(col(score) >= threshold)
        .groupBy(col(entity).alias("entity"), col(period).cast("bigint").alias("period"))
        .agg(F.count(F.lit(1)).alias("predicted"))
    )
    joined = predicted.join(covered, ["entity", "period"], "left")
    return joined.agg(*_window_result(F.sum(F.when(F.col("near") == 1, F.col("predicted"))), F.sum("predicted")))


def evaluation_summary(df: DataFrame, label: str, score: str, n_features: int, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """One row: samples, features, positive rate, and the metrics at the best-F1 threshold of the sweep."""
    sweep = threshold_sweep(df, label, score, thresholds)
    best = F.min(F.struct((-F.col("f1")).alias("_s"), "threshold", "accuracy", "precision", "recall", "f1"))
    total, positives = F.max(F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")), F.max(F.col("tp") + F.col("fn"))
    picked = sweep.agg(best.alias("_b"), total.alias("n_samples"), ratio(positives, total).alias("positive_rate"))
    return picked.select(
        "n_samples",
        F.lit(n_features).alias("n_features"),
        "positive_rate",
        F.col("_b.threshold").alias("optimal_threshold"),
        *[F.col(f"_b.{m}").alias(f"optimal_{m}") for m in ("accuracy", "precision", "recall", "f1")],
    )
