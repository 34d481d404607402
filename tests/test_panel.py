import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwise.catalog.fixtures import _rounded, rounded
from panelwise.operators import panel as P
from panelwise.operators import skew
from tests.conftest import rows, same_rows

SCHEMA = "e string, y int, v double"


@pytest.fixture(scope="module")
def gaps(spark):
    data = [("a", 2020, 1.0), ("a", 2021, 4.0), ("a", 2023, 10.0), ("b", 2022, 7.0), ("c", 2020, None), ("c", 2021, 3.0)]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def hot(spark):
    """One entity and the null entity hold most rows; several rows per (entity, year); copies of rows."""
    e = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, F.lit(None)).otherwise((F.col("id") % 40).cast("string"))
    return spark.range(3000).select(
        "id",
        e.alias("e"),
        (2015 + (F.col("id") * 7 % 10)).cast("int").alias("y"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * 37 % 101).cast("double")).alias("v"),
    )


def test_entity_stats_of_one_row(gaps):
    b = rows(P.entity_stats(gaps, "e", ["v"]).filter("e = 'b'"))[0]
    assert (b["v_patient_mean"], b["v_patient_min"], b["v_patient_max"], b["v_patient_std"]) == (7.0, 7.0, 7.0, None)
    assert rows(P.zero_fill_features(P.entity_stats(gaps, "e", ["v"]), P.feature_names(["v"])).filter("e = 'b'"))[0]["v_patient_std"] == 0.0


def test_rolling_counts_years_not_rows(gaps):
    out = {(r["e"], r["y"]): r for r in rows(P.rolling_years(gaps, "e", "y", ["v"], years=(2,)))}
    assert out["a", 2021]["v_rolling_mean_2y"] == 2.5
    assert out["a", 2023]["v_rolling_mean_2y"] == 10.0  # 2022 is missing
    assert out["a", 2023]["v_rolling_count_2y"] == 1
    assert out["c", 2020]["v_rolling_mean_2y"] is None and out["c", 2020]["v_rolling_count_2y"] == 0


def test_delta_needs_the_exact_year(gaps):
    out = {(r["e"], r["y"]): r for r in rows(P.year_deltas(gaps, "e", "y", ["v"]))}
    assert out["a", 2021]["v_delta_1y"] == 3.0
    assert out["a", 2023]["v_delta_1y"] == 0.0 and out["a", 2023]["v_delta_2y"] == 6.0
    assert out["c", 2021]["v_delta_1y"] == 0.0  # earlier value is null


@pytest.mark.parametrize(
    "op",
    [
        lambda d, **k: P.entity_stats(d, "e", ["v"], **k),
        lambda d, **k: P.rolling_years(d, "e", "y", ["v"], **k),
        lambda d, **k: P.year_deltas(d, "e", "y", ["v"], **k),
        lambda d, **k: P.panel_features(d, "e", "y", ["v"], rolling_columns=["v"], lags=(1, 2), **k),
    ],
    ids=["stats", "rolling", "deltas", "features"],
)
@pytest.mark.parametrize("frequent", [3, 1000])
def test_plan_for_frequent_entities_gives_the_same(hot, op, frequent, monkeypatch):
    monkeypatch.setattr(skew.attach, "__defaults__", (None, frequent))
    monkeypatch.setattr(skew.frequent_keys, "__defaults__", (frequent,))
    assert same_rows(op(hot), op(hot, windows=True))
    holes = hot.withColumn("y", F.when(F.col("id") % 5 > 0, F.col("y")))  # rows without a period
    assert same_rows(op(holes), op(holes, windows=True))


def test_attach_keeps_rows_without_a_match(spark):
    left = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "k string, a int")
    table = spark.createDataFrame([("x", 10, 5), (None, 30, 2)], "k string, b int, n int")
    want = [("x", 1, 10), ("y", 2, None), (None, 3, 30)]
    for k in (1, 100):
        for weight in ("n", None):
            used = table if weight else table.drop("n")
            got = [tuple(r) for r in skew.attach(left, used, "k", weight, k).collect()]
            assert sorted(got, key=repr) == sorted(want, key=repr)


def test_keep_members(hot, spark):
    members = spark.createDataFrame([("hot",), ("5",), ("absent",)], "e string")
    want = hot.filter("e IN ('hot', '5')")
    assert same_rows(skew.keep_members(hot, members, "e"), want)
    assert same_rows(skew.keep_members(hot, members.unionByName(members), "e"), want)


def test_row_order_of_frequent_entities(hot):
    w = W.partitionBy("e").orderBy("y", "id")
    assert same_rows(P.running_sum(hot, "e", "y", "id", "v", "s"), hot.withColumn("s", F.sum("v").over(w.rowsBetween(W.unboundedPreceding, 0))))
    near = w.rowsBetween(-2, 0)
    want = hot.select("*", F.avg("v").over(near).alias("v_rolling_mean"), F.max("v").over(near).alias("v_rolling_max"))
    assert same_rows(P.rolling_rows(hot, "e", "y", "id", ["v"]), want)


def test_only_generated_columns_are_filled(spark):
    df = spark.createDataFrame([(None, None)], "n_patient_visits double, v_patient_mean double")
    assert tuple(P.zero_fill_features(df, P.feature_names(["v"])).first()) == (None, 0.0)


def test_frequent_rows_are_not_shuffled(hot):
    plan = P.join_entity_table(hot, "e", ["v"])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in text and "strategy=broadcast" in text


def test_rows_of_a_frequent_entity_are_split(spark):
    """The join of features to rows cuts the partition of a frequent key into several tasks."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    rows_ = spark.range(60_000, numPartitions=8).select(F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 500).cast("string")).alias("e"), F.lit(2020).alias("y"), F.rand(3).alias("v"))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        wide = P.rolling_years(rows_, "e", "y", ["v"])
        assert len(wide.collect()) == 60_000
        assert "SortMergeJoin(skew=true)" in wide._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_panel_features_shuffle_cells_and_join_once(hot):
    plan = P.panel_features(hot, "e", "y", ["v"], rolling_columns=["v"], lags=(1, 2))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "Generate" not in plan


def test_moments_of_far_values_are_stable(spark):
    df = spark.createDataFrame([("a", 2020 + i % 3, 1e9 + i * 0.25) for i in range(30)], SCHEMA)
    assert same_rows(P.panel_features(df, "e", "y", ["v"], rolling_columns=["v"]), P.panel_features(df, "e", "y", ["v"], rolling_columns=["v"], windows=True), digits=4)


def test_densify(gaps):
    out = rows(P.densify(gaps, "e", "y", 2020, 2022), "e", "y")
    assert len(out) == 9
    assert [r["v"] for r in out if r["e"] == "a"] == [1.0, 4.0, None]


def test_new_entity_gets_its_own_values(spark, gaps):
    new = spark.createDataFrame([("z", 2024, 5.0), ("a", 2024, 13.0)], SCHEMA)
    out = {r["e"]: r for r in rows(P.new_rows_with_history(gaps, new, "e", "y", ["v"]))}
    z = out["z"]
    assert (z["v_patient_mean"], z["v_patient_std"], z["v_rolling_mean_3y"], z["v_delta_1y"]) == (5.0, 0.0, 5.0, 0.0)
    assert out["a"]["v_patient_mean"] == 7.0 and out["a"]["v_delta_1y"] == 3.0
    assert [r["e"] for r in rows(P.unseen_entities(new, gaps, "e"))] == ["z"]


def test_empty_panel(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert P.panel_features(empty, "e", "y", ["v"], rolling_columns=["v"], lags=(1,)).count() == 0
    assert P.panel_features(empty, "e", "y", ["v"], rolling_columns=["v"], lags=(1,), windows=True).count() == 0


def test_rounding_of_results_is_that_of_decimals(spark):
    """Ties, halves that no double has, signs of zero, large numbers and numbers that aren't; few of them reach decimals."""
    odd = [0.5, 1.0000005, 2.0000015, -2.0000015, 0.1234565, 1e-7, -1e-7, -0.0, 5e-7, 123456789.1234565, 1e15 + 0.3, 1e300, -1e300, float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(x,) for x in odd], "x double").unionByName(spark.range(20_000).select((F.rand(5) * 10 ** (F.col("id") % 9) - 40).alias("x")))
    got = df.select(F.round("x", 6).cast("string").alias("want"), _rounded(F.col("x"), 6).cast("string").alias("got"))
    assert got.filter(~F.col("want").eqNullSafe(F.col("got"))).collect() == []
    plan = rounded(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "rint" in plan.lower()
