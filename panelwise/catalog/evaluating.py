"""Evaluation of ``scored``: thresholds, ranking metrics, slices, fairness."""
from __future__ import annotations

from pyspark.sql import functions as F

from panelwise.catalog import query
from panelwise.catalog.fixtures import SCORED, rounded, scored
from panelwise.operators import evaluation as E
from panelwise.operators import slices as S
from panelwise.plans.evaluate import evaluate


def _values(thresholds):
    return "t AS (SELECT * FROM (VALUES " + ", ".join(f"({t!r}::DOUBLE)" for t in thresholds) + ") AS x(threshold))"


def _sweep(thresholds):
    return f"""{_values(thresholds)}, c AS (SELECT threshold, count(*) FILTER (label = 1 AND score >= threshold) AS tp, count(*) FILTER (label = 0 AND score >= threshold) AS fp,
    count(*) FILTER (label = 1 AND score < threshold) AS fn, count(*) FILTER (label = 0 AND score < threshold) AS tn FROM scored, t GROUP BY threshold),
  sweep AS (SELECT *, coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS "precision",
    coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM c)"""


_FULL, _COARSE = _sweep(E.THRESHOLDS), _sweep(E.COARSE_THRESHOLDS)
_M = 'round(accuracy, 6) AS accuracy, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1'


@query("d9_confusion", f"""
WITH {SCORED} SELECT count(*) FILTER (label = 0 AND score < 0.5) AS tn, count(*) FILTER (label = 0 AND score >= 0.5) AS fp,
  count(*) FILTER (label = 1 AND score < 0.5) AS fn, count(*) FILTER (label = 1 AND score >= 0.5) AS tp FROM scored""")
def _(spark, sf):
    return E.confusion(scored(spark, sf), "label", "score", 0.5)


@query("d10_metrics_at_threshold", f"WITH {SCORED}, {_sweep([0.5])} SELECT threshold, {_M} FROM sweep")
def _(spark, sf):
    return rounded(E.metrics_at(scored(spark, sf), "label", "score", 0.5))


@query("d16_threshold_sweep", f"WITH {SCORED}, {_FULL} SELECT round(threshold, 6) AS threshold, tp, fp, fn, tn, {_M} FROM sweep")
def _(spark, sf):
    return rounded(E.threshold_sweep(scored(spark, sf), "label", "score"))


@query("d16_coarse_sweep", f"WITH {SCORED}, {_COARSE} SELECT round(threshold, 6) AS threshold, tp, fp, fn, tn, {_M} FROM sweep")
def _(spark, sf):
    return rounded(E.threshold_sweep(scored(spark, sf), "label", "score", E.COARSE_THRESHOLDS))


@query("d17_best_f1_threshold", f"WITH {SCORED}, {_FULL} SELECT round(threshold, 6) AS threshold, round(f1, 6) AS f1 FROM sweep ORDER BY sweep.f1 DESC, sweep.threshold LIMIT 1")
def _(spark, sf):
    return rounded(E.best_f1_threshold(E.threshold_sweep(scored(spark, sf), "label", "score")))


@query("d18_balanced_threshold", f"""
WITH {SCORED}, {_FULL}, b AS (SELECT threshold, coalesce(2 * "precision" * recall / nullif("precision" + recall, 0), 0) AS balance FROM sweep)
SELECT round(threshold, 6) AS threshold, round(balance, 6) AS balance FROM b ORDER BY b.balance DESC, b.threshold LIMIT 1""")
def _(spark, sf):
    return rounded(E.balanced_threshold(E.threshold_sweep(scored(spark, sf), "label", "score")))


@query("d19_cost_threshold", f"WITH {SCORED}, {_FULL} SELECT round(threshold, 6) AS threshold, CAST(fp + 3 * fn AS DOUBLE) AS cost FROM sweep ORDER BY cost, sweep.threshold LIMIT 1")
def _(spark, sf):
    return rounded(E.cost_threshold(E.threshold_sweep(scored(spark, sf), "label", "score")))


_FALLBACK = """best AS (SELECT threshold, f1, recall FROM sweep ORDER BY f1 DESC, threshold LIMIT 1),
  reach AS (SELECT threshold, recall FROM sweep WHERE recall >= {r} ORDER BY threshold LIMIT 1),
  picked AS (SELECT best.threshold AS optimal_threshold, best.f1 AS optimal_f1, coalesce(reach.threshold, best.threshold) AS fallback_threshold,
    coalesce(reach.recall, best.recall) AS fallback_recall FROM best LEFT JOIN reach ON true)"""
_PICKED = "round(optimal_threshold, 6) AS optimal_threshold, round(optimal_f1, 6) AS optimal_f1, round(fallback_threshold, 6) AS fallback_threshold, round(fallback_recall, 6) AS fallback_recall"


@query("d20_fallback_threshold", f"WITH {SCORED}, {_FULL}, {_FALLBACK.format(r=0.8)} SELECT {_PICKED} FROM picked")
def _(spark, sf):
    return rounded(E.fallback_threshold(E.threshold_sweep(scored(spark, sf), "label", "score")))


_RANK = """h AS (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM scored GROUP BY score),
  r AS (SELECT *, sum(p) OVER (ORDER BY score DESC) AS cp, sum(n) OVER (ORDER BY score DESC) AS cn FROM h)"""


@query("d11_roc_auc", f"WITH {SCORED}, {_RANK} SELECT round(CAST(sum(n * (2 * cp - p)) AS DOUBLE) / (2.0::DOUBLE * sum(p) * sum(n)), 6) AS auc FROM r")
def _(spark, sf):
    return rounded(E.ranking_metrics(scored(spark, sf), "label", "score").select("auc"))


@query("d12_average_precision", f"WITH {SCORED}, {_RANK} SELECT round(sum(p * CAST(cp AS DOUBLE) / (cp + cn)) / sum(p), 6) AS average_precision FROM r")
def _(spark, sf):
    return rounded(E.ranking_metrics(scored(spark, sf), "label", "score").select("average_precision"))


@query("d13_roc_points", f"WITH {SCORED}, {_RANK} SELECT score, round(cn / (SELECT sum(n) FROM h), 6) AS fpr, round(cp / (SELECT sum(p) FROM h), 6) AS tpr FROM r")
def _(spark, sf):
    return rounded(E.roc_points(scored(spark, sf), "label", "score"))


@query("d14_pr_points", f'WITH {SCORED}, {_RANK} SELECT score, round(cp / (cp + cn), 6) AS "precision", round(cp / (SELECT sum(p) FROM h), 6) AS recall FROM r')
def _(spark, sf):
    return rounded(E.pr_points(scored(spark, sf), "label", "score"))


@query("d15_max_f1", f"""
WITH {SCORED}, {_RANK}, c AS (SELECT cp / (cp + cn) AS pr, cp / (SELECT sum(p) FROM h) AS re FROM r) SELECT round(max(2 * pr * re / (pr + re + 1e-8)), 6) AS max_f1 FROM c""")
def _(spark, sf):
    return rounded(E.max_f1(scored(spark, sf), "label", "score"))


@query("d11_roc_auc_distinct_scores", """
WITH s AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_extendedprice / 100000 AS score FROM lineitem),
  h AS (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM s GROUP BY score),
  r AS (SELECT *, sum(p) OVER (ORDER BY score DESC) AS cp, sum(n) OVER (ORDER BY score DESC) AS cn FROM h)
SELECT round(CAST(sum(n * (2 * cp - p)) AS DOUBLE) / (2.0::DOUBLE * sum(p) * sum(n)), 6) AS auc, round(sum(p * CAST(cp AS DOUBLE) / (cp + cn)) / sum(p), 6) AS average_precision FROM r""")
def ranking_of_lines(spark, sf):
    """Ranking metrics of every line item, nearly every score distinct."""
    from panelwise.catalog.fixtures import table

    lines = table(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"), (F.col("l_extendedprice") / 100000).alias("score")
    )
    return rounded(E.ranking_metrics(lines, "label", "score"))


_SLICES = f"""
{SCORED}, tagged AS (
  SELECT 'age_groups' AS feature_type, 'Young (50-65)' AS slice, 0 AS ordinal, label, score FROM scored WHERE age >= 50 AND age <= 65
  UNION ALL SELECT 'age_groups', 'Middle (66-80)', 1, label, score FROM scored WHERE age >= 66 AND age <= 80
  UNION ALL SELECT 'age_groups', 'Elderly (81+)', 2, label, score FROM scored WHERE age >= 81
  UNION ALL SELECT 'gender', 'Male', 0, label, score FROM scored WHERE gender = 'M' UNION ALL SELECT 'gender', 'Female', 1, label, score FROM scored WHERE gender = 'F'
  UNION ALL SELECT 'education', 'Low (<12 years)', 0, label, score FROM scored WHERE education_years < 12
  UNION ALL SELECT 'education', 'Medium (12-16 years)', 1, label, score FROM scored WHERE education_years BETWEEN 12 AND 16
  UNION ALL SELECT 'education', 'High (>16 years)', 2, label, score FROM scored WHERE education_years > 16),
h AS (SELECT feature_type, slice, ordinal, score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM tagged GROUP BY ALL),
r AS (SELECT *, sum(p) OVER w AS cp, sum(n) OVER w AS cn, sum(p) OVER (PARTITION BY feature_type, slice) AS tp FROM h WINDOW w AS (PARTITION BY feature_type, slice ORDER BY score DESC)),
ranked AS (SELECT feature_type, slice, CAST(sum(n * (2 * cp - p)) AS DOUBLE) / nullif(2.0::DOUBLE * sum(p) * sum(n), 0) AS auc, sum(p * CAST(cp AS DOUBLE) / (cp + cn)) / nullif(sum(p), 0) AS average_precision,
  max(2 * (cp / (cp + cn)) * (cp / tp) / (cp / (cp + cn) + cp / tp + 1e-8)) AS max_f1 FROM r GROUP BY ALL),
plain AS (SELECT feature_type, slice, ordinal, count(*) AS sample_size, avg(label) AS positive_rate, avg(score) AS prediction_mean, stddev_pop(score) AS prediction_std FROM tagged GROUP BY ALL),
metrics AS (SELECT * FROM plain JOIN ranked USING (feature_type, slice))"""
_SLICE_OUT = """feature_type, slice, ordinal, sample_size, round(auc, 6) AS auc, round(average_precision, 6) AS average_precision, round(positive_rate, 6) AS positive_rate,
  round(max_f1, 6) AS max_f1, round(prediction_mean, 6) AS prediction_mean, round(prediction_std, 6) AS prediction_std"""


@query("d21_slice_metrics", f"WITH {_SLICES} SELECT {_SLICE_OUT} FROM metrics")
def slice_metrics(spark, sf):
    return rounded(S.slice_metrics(scored(spark, sf), "label", "score"))


@query("d22_fairness_gaps", f"""
WITH {_SLICES} SELECT feature_type, round(max(positive_rate) - min(positive_rate), 6) AS demographic_parity_difference, round(max(auc) - min(auc), 6) AS equalized_odds_difference,
  round(max(auc) - min(auc), 6) AS auc_gap, round(max(positive_rate) - min(positive_rate), 6) AS positive_rate_gap FROM metrics GROUP BY feature_type HAVING count(*) >= 2""")
def _(spark, sf):
    return rounded(S.fairness(S.slice_metrics(scored(spark, sf), "label", "score")))


@query("d23_gap_to_first_slice", f"WITH {_SLICES} SELECT feature_type, slice, round(auc - first_value(auc) OVER (PARTITION BY feature_type ORDER BY ordinal), 6) AS auc_gap_to_first FROM metrics")
def _(spark, sf):
    gaps = S.gap_to_first(S.slice_metrics(scored(spark, sf), "label", "score"))
    return rounded(gaps.select("feature_type", "slice", "auc_gap_to_first"))


@query("d24_fairness_alerts", f"""
WITH {_SLICES}, g AS (SELECT feature_type, max(auc) - min(auc) AS auc_gap, max(positive_rate) - min(positive_rate) AS parity FROM metrics GROUP BY feature_type HAVING count(*) >= 2)
SELECT feature_type, 'large AUC gap' AS alert, round(auc_gap, 6) AS gap FROM g WHERE auc_gap > 0.001 UNION ALL SELECT feature_type, 'high demographic parity difference', round(parity, 6) FROM g WHERE parity > 0.005""")
def _(spark, sf):
    gaps = S.fairness(S.slice_metrics(scored(spark, sf), "label", "score"))
    return rounded(S.fairness_alerts(gaps, auc_gap=0.001, parity=0.005))


@query("d25_evaluation_summary", f"""
WITH {SCORED}, {_FULL} SELECT tp + fp + fn + tn AS n_samples, 18 AS n_features, round((tp + fn) / (tp + fp + fn + tn), 6) AS positive_rate, round(threshold, 6) AS optimal_threshold,
  round(accuracy, 6) AS optimal_accuracy, round("precision", 6) AS optimal_precision, round(recall, 6) AS optimal_recall, round(f1, 6) AS optimal_f1 FROM sweep ORDER BY sweep.f1 DESC, sweep.threshold LIMIT 1""")
def _(spark, sf):
    return rounded(E.evaluation_summary(scored(spark, sf), "label", "score", 18))


@query("evaluation_report", f"""
WITH {SCORED}, {_FULL}, {_RANK}, {_FALLBACK.format(r=0.8)},
near AS (SELECT score, max(label) OVER (PARTITION BY entity_id ORDER BY period RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS hit FROM scored),
w AS (SELECT count(*) AS window_positive_predictions, count(*) FILTER (hit = 1) AS window_hits FROM near, picked WHERE score >= optimal_threshold)
SELECT (SELECT round(CAST(sum(n * (2 * cp - p)) AS DOUBLE) / (2.0::DOUBLE * sum(p) * sum(n)), 6) FROM r) AS auc,
  (SELECT round(sum(p * CAST(cp AS DOUBLE) / (cp + cn)) / sum(p), 6) FROM r) AS average_precision, {_M}, window_positive_predictions, window_hits,
  round(coalesce(window_hits / nullif(window_positive_predictions, 0), 0), 6) AS window_accuracy, {_PICKED}
FROM picked, w, sweep WHERE sweep.threshold = picked.optimal_threshold""")
def evaluation_report(spark, sf):
    """The whole evaluation job in one row."""
    return rounded(evaluate(scored(spark, sf), "entity_id", "period", "label", "score"))
