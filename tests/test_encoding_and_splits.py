import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from panelwise.catalog.fixtures import panel
from panelwise.operators import aggregates as A
from panelwise.operators import encoding, quality, scaling, splits
from tests.conftest import rows, same_rows


@pytest.fixture(scope="module")
def words(spark):
    return spark.createDataFrame([(1, "b"), (2, "a b"), (3, None), (4, "c"), (5, "b")], "id int, w string")


def test_one_hot_names_nulls_and_cap(words):
    out = rows(encoding.one_hot(words, ["w"]), "id")
    assert list(out[0])[2:] == ["w_a b", "w_b", "w_c"]
    assert [(r["w_a b"], r["w_b"], r["w_c"]) for r in out] == [(0, 1, 0), (1, 0, 0), (0, 0, 0), (0, 0, 1), (0, 1, 0)]
    capped = rows(encoding.one_hot(words, ["w"], max_categories=1), "id")
    assert [(r["w_b"], r["w_other"]) for r in capped] == [(1, 0), (0, 1), (0, 0), (0, 1), (1, 0)]
    clash = words.na.replace("b", "other", "w")
    assert [(r["w_other"], r["w_other_"]) for r in rows(encoding.one_hot(clash, ["w"], max_categories=1), "id")] == [(1, 0), (0, 1), (0, 0), (0, 1), (1, 0)]


def test_label_codes(words, spark):
    index = encoding.label_index(words, "w")
    assert {(r["w"], r["code"]) for r in rows(index)} == {("a b", 0), ("b", 1), ("c", 2)}
    new = spark.createDataFrame([("c",), ("zz",), (None,)], "w string")
    assert [r["w_encoded"] for r in rows(encoding.label_encode(new, "w", index), "w")] == [2, -1, -1]


def test_many_label_codes_over_several_files(spark):
    df = spark.range(5000).select(F.format_string("v%05d", F.col("id") * 7 % 5000).alias("w"))
    index = encoding.label_index(df.repartition(7), "w")
    assert [r["code"] for r in rows(index, "w")] == list(range(5000))


def test_target_encoding_of_unseen_value(spark):
    train = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1)], "w string, y int")
    new = spark.createDataFrame([("a",), ("zz",)], "w string")
    for _ in range(1):
        out = rows(encoding.target_encode(new, train, "w", "y"), "w")
        assert [round(r["w_target"], 6) for r in out] == [0.5, round(2 / 3, 6)]


def test_cap_categories_keeps_null(words):
    assert [r["w"] for r in rows(encoding.cap_categories(words, "w", 1), "id")] == ["b", "other", None, "other", "b"]


def test_standard_scaling_uses_population_deviation(spark):
    df = spark.createDataFrame([(0.0, 5.0), (1.0, 5.0)], "x double, c double")
    out = rows(scaling.scale(df, scaling.fit_standard(df, ["x", "c"])), "x")
    assert [(r["x_scaled"], r["c_scaled"]) for r in out] == [(-1.0, 0.0), (1.0, 0.0)]


def test_variance_is_population_and_strict(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.2, 0.21)], "at double, above double")
    assert scaling.varying_columns(df, ["at", "above"], threshold=0.2**2 / 4) == ["above"]


def test_outliers_and_approximate_quartiles(spark):
    df = spark.createDataFrame([(float(x),) for x in [*range(20), 100]], "x double")
    for approximate in (False, True):
        out = scaling.flag_outliers(df, ["x"], approximate=approximate)
        assert [r["x"] for r in rows(out.filter("x_outlier = 1"))] == [100.0]


def test_uncorrelated_keeps_the_earlier(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 1.0), (3.0, 6.0, 4.0)], "a double, b double, c double")
    assert scaling.uncorrelated_columns(df, ["b", "a", "c"]) == ["b", "c"]


def test_polynomials(spark):
    df = spark.createDataFrame([(2.0, 3.0)], "a double, b double")
    r = rows(scaling.polynomials(df, ["a", "b"]))[0]
    assert (r["a_pow2"], r["a_x_b"], r["b_pow2"]) == (4.0, 6.0, 9.0)


def test_period_confidence_of_one_period(spark):
    df = spark.createDataFrame([(2020,), (2020,)], "y int")
    assert [r["diagnostic_confidence"] for r in rows(scaling.period_confidence(df, "y"))] == [0.0, 0.0]


# --- aggregates -------------------------------------------------------------------------------------------------------


def test_prevalence_of_nothing(spark):
    empty = spark.createDataFrame([], "y int")
    assert tuple(A.prevalence(empty, "y").first()) == (0, 0, 0.0)
    assert A.class_balance(empty, "y").first()["neg_pos_ratio"] == 0.0


def test_majority_tie_is_negative(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), ("b", 1), ("b", 0)], "e string, y int")
    assert {r["e"]: r["majority"] for r in rows(A.majority_label(df, "e", "y"))} == {"a": 0, "b": 1}


def test_mode_takes_smallest_of_ties_and_zero_of_none(spark):
    df = spark.createDataFrame([("b", None), ("a", None), (None, None)], "w string, n string")
    out = rows(A.impute(df, categorical=["w", "n"]))
    assert [(r["w"], r["n"]) for r in out] == [("b", "0"), ("a", "0"), ("a", "0")]


def test_median_imputation_fills_nan(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (float("nan"),)], "x double")
    assert [r["x"] for r in rows(A.impute(df, numeric=["x"]), "x")] == [1.0, 1.5, 1.5, 2.0]


def test_recent_predictions_skip_zero_latency(spark):
    log = spark.createDataFrame([(1, 1, "High", 10.0), (2, 2, "Low", 0.0), (3, 3, "Low", None)], "ts int, id int, l string, ms double")
    r = A.recent_predictions(log, "ts", "id", "l", "ms").first()
    assert (r["total_predictions"], r["high_risk_predictions"], r["average_processing_time_ms"]) == (3, 1, 10.0)
    assert A.recent_predictions(log, "ts", "id", "l", "ms", last=1).first()["average_processing_time_ms"] == 0.0


def test_importance_summary_and_schema_rows(spark):
    imp = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.0)], "feature string, importance double")
    assert [r["feature"] for r in A.top_features(imp, 2).collect()] == ["a", "b"]
    r = A.importance_summary(imp).first()
    assert round(r["importance_std"], 6) == round((1 / 18) ** 0.5, 6)
    assert [tuple(x) for x in A.schema_rows(imp).collect()] == [(0, "feature", "string"), (1, "importance", "double")]


def test_approximate_distinct_counts(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("a"))
    assert A.distinct_counts(df, ["a"], approximate=True).first()["n_distinct"] == 10


# --- quality ----------------------------------------------------------------------------------------------------------


def test_type_differences(spark):
    df = spark.createDataFrame([], "a int, b string, x int")
    want = StructType([StructField("a", LongType()), StructField("b", StringType()), StructField("c", IntegerType())])
    assert {tuple(r) for r in quality.type_differences(df, want).collect()} == {("a", "bigint", "int"), ("c", "int", None), ("x", None, "int")}


def test_grain(spark, small):
    p = panel(spark, small)
    assert quality.grain_is_unique(p, ["entity_id", "period"]) and not quality.grain_is_unique(p, ["entity_id"])


def test_missing_and_infinite(spark):
    df = spark.createDataFrame([(None,), (float("inf"),), (float("-inf"),), (float("nan"),), (1.0,)], "x double")
    assert tuple(quality.missing_and_infinite(df).first()) == ("x", 2, 2)


# --- splits -----------------------------------------------------------------------------------------------------------


def test_no_entity_in_two_splits(spark, small):
    p = splits.assign_split(panel(spark, small), "entity_id")
    assert p.groupBy("entity_id").agg(F.count_distinct("split").alias("n")).filter("n > 1").isEmpty()
    train, val, test = splits.split_frames(panel(spark, small), "entity_id")
    assert train.count() + val.count() + test.count() == p.count()


def test_split_shares_within_four_sigma(spark):
    n = 20_000
    shares = {r["split"]: r["n"] / n for r in splits.assign_split(spark.range(n), "id").groupBy("split").agg(F.count("*").alias("n")).collect()}
    for split, p in (("test", 0.2), ("val", 0.16), ("train", 0.64)):
        assert abs(shares[split] - p) < 4 * (p * (1 - p) / n) ** 0.5


def test_exact_split_meets_the_shares(spark, small):
    out = splits.exact_split(panel(spark, small), "entity_id", "label")
    counts = {}
    for r in out.groupBy("stratum", "split").count().collect():
        counts.setdefault(r["stratum"], {})[r["split"]] = r["count"]
    sizes = {k: sum(c.values()) for k, c in counts.items()}
    n = sum(sizes.values())
    test, val = (sum(c.get(s, 0) for c in counts.values()) for s in ("test", "val"))
    assert test == -(-n // 5) and val == -(-(n - test) // 5)
    for k, c in counts.items():
        assert abs(c["test"] - sizes[k] * test / n) < 1 and c["train"] >= 1
    again = splits.exact_split(panel(spark, small).repartition(11), "entity_id", "label")
    assert same_rows(out, again)


def test_small_classes_stay_in_train(spark):
    df = spark.range(40).select("id", F.when(F.col("id") == 7, 1).otherwise(0).alias("y"))
    out = {r["id"]: (r["stratum"], r["split"]) for r in splits.exact_split(df, "id", "y").collect()}
    assert out[7] == (1, "train") and len(out) == 40
    assert sum(s == "test" for _, s in out.values()) == 8 and sum(s == "val" for _, s in out.values()) == 7
    few = spark.createDataFrame([(i, y) for i, y in enumerate([0] * 11 + [1] * 3 + [1] * 2)], "id long, y int")
    splits_ = [r["split"] for r in splits.exact_split(few, "id", "y").collect()]
    assert (splits_.count("test"), splits_.count("val")) == (4, 3)
    one_class = splits.exact_split(spark.range(10).withColumn("y", F.lit(0)), "id", "y")
    assert one_class.filter("split = 'test'").count() == 2 and splits.exact_split(df.limit(0), "id", "y").count() == 0


def test_parts_by_largest_remainder(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 7), ("c", 1), ("d", 2)], "k string, n int")
    got = {r["k"]: r["part"] for r in splits.allot(sizes, "n", 0.25, "part").collect()}
    assert got == {"a": 3, "b": 2, "c": 0, "d": 0}  # quotas 2.5, 1.75, 0.25, 0.5 of 5 in all; a and d tie
    assert splits.allot(sizes, "n", 0.9, "part", spare=1).filter("part > n - 1").isEmpty()


def test_correlations_of_pairs_with_missing_values(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 6)) * [1, 10, 1e-3, 5, 2, 1] + [0, 1e6, 0, -40, 3, 0]
    x[:, 3] = x[:, 0] * 2 + x[:, 3]
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 5] = 0.1
    x[1:, 4] = np.nan  # one value
    names = list("abcdef")
    df = spark.createDataFrame([[None if v != v and i % 2 else float(v) for v in row] for i, row in enumerate(x)], ", ".join(f"{n} double" for n in names)).repartition(7)
    got = {(r["left"], r["right"]): r["correlation"] for r in scaling.correlations(df, names).collect()}
    assert len(got) == 15
    for i in range(6):
        for j in range(i + 1, 6):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if 4 in (i, j) or 5 in (i, j):
                assert got[names[i], names[j]] is None
            else:
                assert got[names[i], names[j]] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)
    assert "corr(" not in scaling.correlations(df, names)._jdf.queryExecution().optimizedPlan().toString()
    assert scaling.correlations(df.limit(0), names).filter("correlation IS NOT NULL").isEmpty()


def test_too_many_values_for_dummies_are_refused(words, monkeypatch):
    monkeypatch.setattr(encoding, "MAX_COLUMNS", 2)
    with pytest.raises(ValueError):
        encoding.one_hot(words, ["w"])
    assert "w_other" in encoding.one_hot(words, ["w"], max_categories=2).columns


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    assert splits.class_weights(df, "y") == {0: 4 / 6, 1: 2.0}
    assert splits.positive_weight(df, "y") == 3.0
    assert splits.positive_weight(df.filter("y = 0"), "y") == 3.0
