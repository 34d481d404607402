import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from panelwise.catalog.fixtures import scored
from panelwise.operators import evaluation as E
from panelwise.operators import ranking
from panelwise.operators import slices as S
from panelwise.operators.ranking import exact_quantiles, running_totals
from tests.conftest import rows, same_rows

SCHEMA = "label int, score double"


def brute(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg)) if pos and neg else None
    ap, done = (0.0 if pos else None), 0
    for cut in sorted({s for _, s in pairs}, reverse=True):
        tp, n = sum(s >= cut for s in pos), sum(s >= cut for _, s in pairs)
        if pos:
            ap += (tp - done) / len(pos) * tp / n
        done = tp
    return auc, ap


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6).map(lambda i: i / 6)), min_size=1, max_size=40))
def test_ranking_against_brute_force(spark, pairs):
    r = E.ranking_metrics(spark.createDataFrame(pairs, SCHEMA), "label", "score").first()
    for got, want in zip(r, brute(pairs)):
        assert (got is None and want is None) or got == pytest.approx(want)


def test_auc_equals_spark_evaluator(spark, small):
    df = scored(spark, small).select(F.col("label").cast("double"), "score")
    want = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert E.ranking_metrics(df, "label", "score").first()["auc"] == pytest.approx(want)


@pytest.mark.parametrize("partitions,blocks", [(1, 2), (3, 5), (16, 64)])
def test_blocks_and_partitions_do_not_matter(spark, partitions, blocks):
    rng = np.random.default_rng(3)
    data = [(int(g), float(s), int(v)) for g, s, v in zip(rng.integers(0, 3, 900), rng.permutation(900) / 7, rng.integers(0, 9, 900))]
    df = spark.createDataFrame(data, "g int, s double, v int").repartition(partitions)
    want = {}
    for g in range(3):
        total = 0
        for _, s, v in sorted((d for d in data if d[0] == g), key=lambda d: -d[1]):
            total += v
            want[g, s] = total
    out = running_totals(df, {"c": "v"}, "s", group=["g"], descending=True)
    assert {(r["g"], r["s"]): r["c"] for r in out.collect()} == want
    assert {(r["g"], r["c_total"]) for r in out.collect()} == {(g, sum(v for h, _, v in data if h == g)) for g in range(3)}


def test_running_totals_with_leading_column(spark):
    df = spark.range(200).select((F.col("id") % 4).alias("lead"), (F.col("id") * 13 % 211).cast("double").alias("s"), F.lit(1).alias("one"))
    out = running_totals(df, {"at": "one"}, "s", leading=["lead"])
    ranked = sorted(out.collect(), key=lambda r: r["at"])
    assert [(r["lead"], r["s"]) for r in ranked] == sorted((r["lead"], r["s"]) for r in ranked)


def test_running_totals_of_many_groups(spark):
    df = spark.range(5000).select((F.col("id") % 2500).alias("g"), F.col("id").cast("double").alias("s"), F.lit(1).alias("one"))
    assert running_totals(df, {"at": "one"}, "s", group=["g"]).filter("at = 2 AND at_total = 2").count() == 2500


def test_one_rule_for_missing_scores_and_labels(spark):
    nan = float("nan")
    data = [("a", 2000, 1, 0.9), ("a", 2001, 0, None), ("a", 2001, 0, nan), ("b", 2000, None, 0.9), ("b", None, 1, 0.8), ("b", None, 0, 0.7), ("c", 2000, 0, 0.2), ("c", 2001, 1, nan)]
    df = spark.createDataFrame(data, "e string, y int, label int, score double")
    at = lambda c: tuple(c.select("tn", "fp", "fn", "tp").first())
    assert at(E.confusion(df, "label", "score", 0.5)) == at(E.threshold_sweep(df, "label", "score", [0.5])) == (1, 1, 0, 2)
    assert E.skipped(df, "label", "score").first()[0] == 4
    assert E.ranking_metrics(df, "label", "score").first()["auc"] == 1.0
    assert E.score_histogram(df, "label", "score").agg(F.sum("p"), F.sum("n")).first()[:] == (2, 2)
    hits = [tuple(f(df, "e", "y", "label", "score", 0.5, 1).first()) for f in (E.window_hits, E.window_hits_by_join)]
    assert hits[0] == hits[1] == (3, 1, 1 / 3)


def test_quantiles_interpolate_and_skip_missing(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, None), (3.0, float("nan")), (4.0, 7.0)], "a double, b double")
    out = {r["name"]: r for r in rows(exact_quantiles(df, ["a", "b"], {"q1": 0.25, "m": 0.5}))}
    assert (out["a"]["n"], out["a"]["q1"], out["a"]["m"]) == (4, 1.75, 2.5)
    assert (out["b"]["n"], out["b"]["m"]) == (2, 6.0)


def test_quantiles_of_many_values(spark):
    values = np.random.default_rng(1).normal(size=3000)
    out = exact_quantiles(spark.createDataFrame([(float(v),) for v in values], "x double"), ["x"], {"p": 0.9}).first()
    assert out["p"] == pytest.approx(np.quantile(values, 0.9))


def test_single_class_and_ties(spark):
    ones = spark.createDataFrame([(1, 0.3), (1, 0.7)], SCHEMA)
    assert E.ranking_metrics(ones, "label", "score").first()["auc"] is None
    assert E.ranking_metrics(ones, "label", "score").first()["average_precision"] == 1.0
    ties = spark.createDataFrame([(1, 0.5), (0, 0.5), (0, 0.5)], SCHEMA)
    assert tuple(E.ranking_metrics(ties, "label", "score").first()) == (0.5, pytest.approx(1 / 3))


def test_thresholds_as_float_steps():
    assert list(E.THRESHOLDS) == list(np.arange(0.1, 0.9, 0.05))
    assert list(E.COARSE_THRESHOLDS) == list(np.arange(0.1, 0.9, 0.1))


def test_zero_division_and_fallbacks(spark):
    zeros = spark.createDataFrame([(0, 0.0), (0, 0.05)], SCHEMA)
    sweep = E.threshold_sweep(zeros, "label", "score")
    assert {tuple(r[1:]) for r in sweep.select("threshold", "precision", "recall", "f1").collect()} == {(0.0, 0.0, 0.0)}
    assert E.best_f1_threshold(sweep).first()["threshold"] == 0.5
    assert E.best_f1_threshold(sweep, fallback=None).first()["threshold"] == 0.1
    assert E.balanced_threshold(sweep).first()["threshold"] == 0.5
    assert E.cost_threshold(sweep).first()["threshold"] == 0.1
    assert E.fallback_threshold(sweep).first()["fallback_threshold"] == 0.1


def test_sweep_matches_single_threshold(spark, small):
    df = scored(spark, small)
    at = {r["threshold"]: r for r in rows(E.threshold_sweep(df, "label", "score"))}
    for t in (0.1, 0.5000000000000001):
        one = E.metrics_at(df, "label", "score", t).first()
        assert all(at[t][m] == pytest.approx(one[m]) for m in ("accuracy", "precision", "recall", "f1"))


def test_recall_fallback_is_lowest_or_none(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.12), (1, 0.11), (0, 0.05)], SCHEMA)
    r = E.fallback_threshold(E.threshold_sweep(df, "label", "score")).first()
    assert (r["fallback_threshold"], r["fallback_recall"]) == (0.1, 1.0)


def test_window_hits(spark):
    data = [("a", 2020, 0, 0.9), ("a", 2021, 1, 0.1), ("a", 2023, 0, 0.9), ("b", 2020, 0, 0.9), ("b", 2020, 0, 0.8), ("c", 2020, 1, 0.9)]
    df = spark.createDataFrame(data, "e string, y int, label int, score double")
    for f in (E.window_hits, E.window_hits_by_join):
        assert tuple(f(df, "e", "y", "label", "score", 0.5, 1).first()) == (5, 2, 0.4)
        assert tuple(f(df, "e", "y", "label", "score", 0.5, 2).first()) == (5, 3, 0.6)
        assert tuple(f(df, "e", "y", "label", "score", 2.0, 1).first()) == (0, 0, 0.0)


def test_window_hits_agree(spark, small):
    df = scored(spark, small)
    for years in (0, 1, 3):
        args = (df, "entity_id", "period", "label", "score", 0.4, years)
        assert same_rows(E.window_hits(*args), E.window_hits_by_join(*args))


def test_slices_leave_gaps_and_one_class_has_no_auc(spark):
    data = [(65.5, "M", 10, 1, 0.5), (50.0, "M", 12, 0, 0.2), (65.0, "M", 16, 1, 0.9), (81.0, "F", 17, 1, 0.7)]
    df = spark.createDataFrame(data, "age double, gender string, education_years int, label int, score double")
    out = {(r["feature_type"], r["slice"]): r for r in rows(S.slice_metrics(df, "label", "score"))}
    assert out["age_groups", "Young (50-65)"]["sample_size"] == 2
    assert ("age_groups", "Middle (66-80)") not in out
    assert out["gender", "Female"]["auc"] is None
    young = out["age_groups", "Young (50-65)"]
    assert (young["auc"], young["prediction_mean"], round(young["prediction_std"], 6)) == (1.0, 0.55, 0.35)


def test_fairness_needs_two_slices(spark):
    df = spark.createDataFrame([(1, 0.5, "M"), (0, 0.4, "M")], "label int, score double, gender string")
    one = {"gender": {"Male": F.col("gender") == "M", "Female": F.col("gender") == "F"}}
    assert S.fairness(S.slice_metrics(df, "label", "score", one)).count() == 0


# --- quantiles --------------------------------------------------------------------------------------------------------


def _numbers(spark):
    x = F.col("id") * 7919 % 10007
    return spark.range(20_000).select(
        x.cast("double").alias("a"),
        F.when(x % 3 == 0, F.lit(5.0)).when(x % 3 == 1, F.lit(float("nan"))).when(x % 5 > 0, x / 7).alias("b"),
        (x % 2).cast("int").alias("c"),
        F.lit(None).cast("double").alias("d"),
        F.when(F.col("id") == 3, 1.5).alias("e"),
        F.when(x % 100 == 0, float("-inf")).when(x % 100 == 1, float("inf")).otherwise(x).alias("f"),
    )


@pytest.mark.parametrize("accuracy, bracket", [(10_000, 1_000_000), (40, 100), (4, 50)])
def test_quantiles_are_exact_whatever_the_sketch_says(spark, monkeypatch, accuracy, bracket):
    monkeypatch.setattr(ranking, "ACCURACY", accuracy)
    monkeypatch.setattr(ranking, "BRACKET", bracket)
    df = _numbers(spark)
    frame = df.toPandas().astype(float)
    probs = {"low": 0.0, "q1": 0.25, "m": 0.5, "odd": 0.333, "high": 1.0}
    got = {r["name"]: r for r in ranking.exact_quantiles(df.repartition(5), list("abcdef"), probs).collect()}
    assert set(got) == set("abcef")
    for c, r in got.items():
        values = np.sort(frame[c].dropna().to_numpy())
        assert r["n"] == len(values)
        for o, p in probs.items():
            place = p * (len(values) - 1)
            lo, hi = values[int(np.floor(place))], values[int(np.ceil(place))]
            want = lo if lo == hi else lo + (hi - lo) * (place - np.floor(place))
            assert r[o] == pytest.approx(want) or (np.isinf(lo) and (np.isnan(r[o]) or r[o] == lo))
    assert ranking.exact_quantiles(df.limit(0), ["a"], probs).count() == 0


def test_a_bracket_that_misses_is_opened(spark, monkeypatch):
    wrong = F.percentile_approx
    monkeypatch.setattr(ranking.F, "percentile_approx", lambda c, p, a: wrong(c, [1.0] * len(p), a) if len(p) < 60 else wrong(c, p, a))
    df = spark.range(1001).select(F.col("id").cast("double").alias("v"))
    assert ranking.exact_quantiles(df, ["v"], {"m": 0.5, "q": 0.1}).first()[2:] == (500.0, 100.0)
