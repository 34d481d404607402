from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from panelwise.catalog.fixtures import panel, requests_of, visits
from panelwise.functions.validation import Range
from panelwise.operators.learning import with_score
from panelwise.operators.panel import new_rows_with_history
from panelwise.operators.scoring import prediction_log, score_with_rules, validate_and_score
from panelwise.plans.featurize import run_featurize
from panelwise.plans.train import load_version, train, train_and_register
from panelwise.session import shared_path
from panelwise.sources import files, registry, runlog
from panelwise.streaming.features import EntityFeatures, stored_features, stream_features
from panelwise.streaming.monitoring import level_metrics, monitor_stream
from panelwise.streaming.scoring import score_stream
from tests.conftest import rows, same_rows

SCHEMA = "id int, year int, v double"


@pytest.fixture(scope="module")
def years(spark):
    return spark.createDataFrame([(1, 2021, 1.0), (2, 2021, 2.0), (1, 2022, 3.0), (3, 2023, None)], SCHEMA)


def test_hive_scan_prunes_years(spark, years, tmp_path):
    files.write_years(years, str(tmp_path / "p"))
    df = files.read_panel(spark, str(tmp_path / "p"))
    assert same_rows(df, years)
    plan = df.filter("year = 2022")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_numeric_and_mixed_folders(spark, years, tmp_path):
    root = str(tmp_path / "p")
    for y in (2021, 2022):
        years.filter(F.col("year") == y).drop("year").write.parquet(f"{root}/{y}")
    assert same_rows(files.read_panel(spark, root), years.filter("year < 2023"))
    pruned = files.read_numeric_years(spark, root).filter("year = 2022")._jdf.queryExecution().optimizedPlan().toString()
    assert pruned.count("Relation") == 1
    years.filter("year = 2023").drop("year").write.parquet(f"{root}/year=2023")
    assert same_rows(files.read_panel(spark, root), years)


def test_recursive_scan_needs_year(spark, years, tmp_path):
    years.write.parquet(str(tmp_path / "deep" / "er"))
    assert same_rows(files.read_panel(spark, str(tmp_path / "deep")), years)
    years.drop("year").write.parquet(str(tmp_path / "none" / "er"))
    with pytest.raises(ValueError):
        files.read_panel(spark, str(tmp_path / "none"))


def test_formats(spark, years, tmp_path):
    files.write_features(years, str(tmp_path / "t.csv"), "csv")
    assert same_rows(files.read_table(spark, str(tmp_path / "t.csv"), SCHEMA), years)
    files.write_features(years, str(tmp_path / "t"))
    assert same_rows(files.read_table(spark, str(tmp_path / "t")), years)
    with pytest.raises(ValueError):
        files.write_features(years, str(tmp_path / "x"), "orc?")


def test_sized_files(spark, tmp_path):
    df = spark.range(0, 200_000, 1, 16)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files.write_sized(df, str(tmp_path / "big"), 100 * 1024 * 1024)
    files.write_sized(df, str(tmp_path / "small"), 128 * 1024)
    count = lambda p: len(list((tmp_path / p).glob("*.parquet")))
    assert count("big") == 1 < count("small")
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before


def test_warehouse_table_is_replaced(spark, years):
    assert files.load_warehouse_table(years, "panelwise_test", "t") == 4
    assert files.load_warehouse_table(years.limit(1), "panelwise_test", "t") == 1
    spark.sql("DROP DATABASE panelwise_test CASCADE")


def test_shared_path_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    assert shared_path(spark, "x") != shared_path(spark, "x")
    assert shared_path(spark, "x").startswith(f"{root}/panelwise/{spark.sparkContext.applicationId}/x-")


def test_rows_are_counted_from_footers(spark, years, tmp_path):
    path = str(tmp_path / "counted")
    years.repartition(3).write.parquet(path)
    assert [tuple(r) for r in files.count_from_footers(spark, path).collect()] == [(years.count(),)]
    with files._settings(spark, files._PUSHED):
        plan = files._footer_counts(spark, [path])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    runlog.append(runlog.run_rows(spark, "r1", {"k": 3}, [{"auc": 0.5}, {"auc": 0.75, "f1": 1}]), path)
    runlog.append(runlog.run_rows(spark, "r2", {}, [{"auc": float("nan")}]), path)
    got = [tuple(r.values()) for r in rows(runlog.read_metrics(spark, path), "run_name", "seq", "key")]
    assert got == [("r1", 1, "auc", 0.5), ("r1", 2, "auc", 0.75), ("r1", 2, "f1", 1.0), ("r2", 1, "auc", None)]


def test_registry(spark, tmp_path):
    path = str(tmp_path / "registry")
    with pytest.raises(FileNotFoundError):
        registry.read_registry(spark, path)
    for i in range(12):
        row = spark.createDataFrame([("m", f"2024-01-{i + 1:02d}", i / 100, 0.5, 0.6)], "model_name string, created_at string, test_accuracy double, test_f1 double, test_auc double")
        registry.register(row, path)
    now = registry.read_registry(spark, path)
    assert now.count() == 10 and len(now.columns) == 33
    past = registry.history(now, "m").collect()
    assert past[0]["created_at"] == "2024-01-12" and past[-1]["created_at"] == "2024-01-03"
    assert registry.latest(now).first()["version"] == past[0]["version"]
    delta = registry.compare(now, "m", past[1]["version"], past[0]["version"]).first()
    assert (round(delta["accuracy_delta"], 6), delta["auc_delta"]) == (0.01, 0.0)
    with pytest.raises(ValueError):
        registry.compare(now, "m", past[0]["version"], "absent")


def test_registrations_at_one_time_all_land(spark, tmp_path):
    path = str(tmp_path / "registry")
    entry = lambda m: spark.createDataFrame([(m, "2024-01-01", 0.5, 0.5)], "model_name string, created_at string, test_accuracy double, test_f1 double")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: registry.register(entry(f"m{i}"), path), range(6)))
    assert sorted(r["model_name"] for r in registry.read_registry(spark, path).collect()) == [f"m{i}" for i in range(6)]


def test_readers_see_no_snapshot_without_a_marker(spark, tmp_path):
    path = str(tmp_path / "registry")
    entry = spark.createDataFrame([("m", "2024-01-01", 0.5, 0.5)], "model_name string, created_at string, test_accuracy double, test_f1 double")
    registry.register(entry, path)
    registry.with_version(entry.withColumn("model_name", F.lit("half"))).write.parquet(f"{path}/snapshot-half")
    assert [r["model_name"] for r in registry.read_registry(spark, path).collect()] == ["m"]
    assert not registry._commit(spark, path, 0, "snapshot-half")  # the number is taken
    assert [r["model_name"] for r in registry.read_registry(spark, path).collect()] == ["m"]


def test_featurize_job(spark, small, tmp_path):
    source, target = str(tmp_path / "raw"), str(tmp_path / "features")
    files.write_years(visits(spark, small), source)
    run_featurize(spark, source, target)
    out = files.read_panel(spark, target)
    assert out.count() == visits(spark, small).count() and "bmi_patient_std" in out.columns
    assert out.filter("bmi_patient_std IS NULL").isEmpty()


def test_training_job_registers_the_model(spark, small, tmp_path):
    data = visits(spark, small)
    metrics = train_and_register(data, "patient_id", ["age", "bmi", "hdl"], "alzheimers_diagnosis", str(tmp_path), "demo", categorical=["sex"], maxIter=3)
    assert metrics.count() == 2 * 3 * 6
    assert metrics.filter("value < 0 OR value > 1").isEmpty()
    row = registry.latest(registry.read_registry(spark, f"{tmp_path}/registry")).first()
    loaded = load_version(spark, str(tmp_path), "demo")
    assert row["model_name"] == "demo" and row["feature_names"] == loaded.features == ["age", "bmi", "hdl", "sex"]
    want = metrics.filter("model = 'boosted_trees' AND split = 'test' AND metric = 'roc_auc'").first()["value"]
    assert row["test_auc"] == want
    holes = data.withColumn("bmi", F.when(F.col("year") % 2 == 0, F.col("bmi")))
    train_and_register(holes, "patient_id", ["age", "bmi"], "alzheimers_diagnosis", str(tmp_path), "demo", maxIter=3)
    assert load_version(spark, str(tmp_path), "demo").features == ["age", "bmi"]
    assert load_version(spark, str(tmp_path), "demo", row["version"]).features == loaded.features
    assert with_score(load_version(spark, str(tmp_path), "demo").model, holes).filter("score IS NULL").isEmpty()
    assert load_version(spark, str(tmp_path), "demo", other="logistic_regression").name == "logistic_regression"
    with pytest.raises(ValueError):
        load_version(spark, str(tmp_path), "demo", "absent")


def test_training_with_uncertainty_columns(spark, small):
    data = visits(spark, small)
    for frame in (data, data.drop("year")):
        _, trained, report = train(frame, "patient_id", ["age", "bmi"], "alzheimers_diagnosis", ["sex"], uncertainty=True, maxIter=2)
        varies = ["cumulative_risk_factor"] if "year" not in frame.columns else ["diagnostic_confidence", "cumulative_risk_factor"]
        assert trained.features == ["age", "bmi", *varies, "sex"] and report["variance_selected"] == len(trained.features)


def test_prediction_log(spark, small):
    requests = requests_of(spark.read.parquet(f"{small}/orders.parquet")).limit(20)
    log = prediction_log(score_with_rules(requests, 0.35), ("age", "bmi"), "v1", elapsed_ms=40.0).collect()
    assert len({r["prediction_id"] for r in log}) == 20 and all(r["processing_time_ms"] == 2.0 and set(r["inputs"]) == {"age", "bmi"} for r in log)


def test_requests_against_all_rules(spark, small):
    requests = requests_of(spark.read.parquet(f"{small}/orders.parquet"))
    scored, rejected = validate_and_score(requests, 0.35)
    assert scored.count() + rejected.count() == requests.count() and not rejected.isEmpty() and not scored.isEmpty()
    fields = {v.split(":")[0] for r in rejected.collect() for v in r["violations"]}
    assert {"age", "num_encounters", "temperature"} <= fields


# --- streams ----------------------------------------------------------------------------------------------------------

RULES = (Range("age", 0, 120), Range("bmi", 10, 100))
REQUEST = "id int, age string, bmi double, systolic_bp double, glucose double"


def test_scored_stream_equals_batch(spark, tmp_path):
    first = spark.createDataFrame([(1, "70", 31.0, 150.0, 90.0), (2, "old", 25.0, 120.0, 90.0)], REQUEST)
    second = spark.createDataFrame([(3, "40", 5.0, 120.0, 90.0), (4, "66", 20.0, 120.0, 101.0)], REQUEST)
    inbox, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for part in (first, second):
        part.coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(first.schema).parquet(inbox)
        score_stream(stream, out, state, 0.35, RULES).awaitTermination()
    scored, rejected = validate_and_score(first.unionByName(second), 0.35, RULES)
    assert same_rows(spark.read.parquet(f"{out}/scored").drop("batch"), scored)
    assert same_rows(spark.read.parquet(f"{out}/rejected").drop("batch"), rejected)
    assert sorted(r["id"] for r in rejected.collect()) == [2, 3]


def test_streamed_features_equal_the_batch(spark, tmp_path):
    """Three files, the last after a restart from the checkpoint; one entity holds most rows, some rows have no period."""
    e = F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 9).cast("string"))
    y = F.when(F.col("id") % 13 > 0, (2015 + F.col("id") * 7 % 8).cast("int"))
    rows_ = spark.range(240).select("id", e.alias("e"), y.alias("y"), F.when(F.col("id") % 11 > 0, (F.col("id") * 37 % 101).cast("double")).alias("v"), (F.col("id") % 17).cast("double").alias("w"))
    parts = [rows_.filter(F.col("id") % 5 == 0), rows_.filter(F.col("id") % 5 == 1), rows_.filter(F.col("id") % 5 > 1)]
    inbox, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))

    def run():
        stream = spark.readStream.schema(rows_.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
        stream_features(stream, "e", "y", ["v", "w"], out, state).awaitTermination()

    for part in parts[:2]:
        part.coalesce(1).write.mode("append").parquet(inbox)
    run()
    parts[2].coalesce(1).write.mode("append").parquet(inbox)
    run()
    want, past = None, parts[0].limit(0)
    for part in parts:
        here = new_rows_with_history(past, part, "e", "y", ["v", "w"])
        want, past = here if want is None else want.unionByName(here), past.unionByName(part)
    assert same_rows(stored_features(spark, out), want)


def test_state_of_an_entity_is_read_and_written_once_a_batch():
    calls = []

    class State:
        kept = None

        def get(self):
            calls.append("get")
            return self.kept

        def update(self, value):
            calls.append("update")
            self.kept = value

    class Handle:
        def getValueState(self, *_):  # noqa: N802
            return State()

    feature = EntityFeatures(["e", "y", "v"], "y", ["v"], (1, 2), (1,))
    feature.init(Handle())
    first = [tuple(r) for r in feature.handleInputRows(("a",), iter([("a", 2020, 4.0), ("a", 2021, float("nan")), ("a", None, None)]), None)]
    assert calls == ["get", "update"] and first[1][:3] == ("a", 2021, None)
    assert first[1][3] == [4.0, 0.0, 4.0, 4.0, 0.0, 0.0, 0.0, 0.0, 0.0, 4.0, 0.0, 4.0, 4.0, 1.0, 0.0]
    (second,) = feature.handleInputRows(("a",), iter([("a", 2021, 8.0)]), None)
    assert calls == ["get", "update"] * 2 and second[3][-1] == 4.0 and [round(x, 6) for x in second[3][:4]] == [6.0, 2.828427, 4.0, 8.0]


def test_loads_of_the_streamed_panel_are_not_one_task(spark, small, monkeypatch):
    from pyspark.sql import DataFrame

    monkeypatch.setattr(DataFrame, "coalesce", lambda *_: pytest.fail("a load in one task"))
    assert queries()["j1_stream_features"](spark, small).count() == panel(spark, small).count()


def test_monitor_drops_rows_behind_the_watermark(spark, tmp_path):
    schema = "ts timestamp, level string, ms double"
    at = lambda *rows_: spark.createDataFrame(list(rows_), "ts string, level string, ms double").withColumn("ts", F.col("ts").cast("timestamp"))
    inbox, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    batches = [
        at(("2024-01-01 10:00:00", "High", 4.0), ("2024-01-01 11:00:00", "High", 0.0), ("2024-01-02 12:00:00", "Low", 1.0)),
        at(("2024-01-01 12:00:00", "High", 100.0), ("2024-01-02 13:00:00", "Low", 3.0), ("2024-01-04 00:00:00", "Low", 1.0)),
    ]
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(inbox)
        monitor_stream(spark.readStream.schema(schema).parquet(inbox), "ts", "level", "ms", out, state).awaitTermination()
    got = [(str(r["window_start"]), r["level"], r["predictions"], r["average_processing_time_ms"]) for r in rows(spark.read.parquet(out), "window_start")]
    # The late row of January 1 arrives after its window was closed.
    assert got == [("2024-01-01 00:00:00", "High", 2, 4.0), ("2024-01-02 00:00:00", "Low", 2, 2.0)]
    batch = level_metrics(batches[0], "ts", "level", "ms", "1 day")
    assert {(r["level"], r["predictions"]) for r in batch.collect()} == {("High", 2), ("Low", 1)}


def test_panel_fixture_has_gap_years(spark, small):
    p = panel(spark, small).groupBy("entity_id").agg((F.max("period") - F.min("period") + 1 - F.count("*")).alias("gap"))
    assert not p.filter("gap > 0").isEmpty()
