"""Readers, writers, run log, registry and streams: each query stores data derived from the tables and reads it back."""
from __future__ import annotations

from pyspark.sql import functions as F

from panelwise.catalog import query
from panelwise.catalog.fixtures import PANEL, PREDLOG, REGISTRY, REQUESTS, panel, predlog_of, registry, requests_of, rounded, table
from panelwise.catalog.panels import delta_sql, rolling_sql
from panelwise.catalog.rules import ALL_RANGES
from panelwise.operators import aggregates
from panelwise.operators.scoring import prediction_log, score_with_rules
from panelwise.session import shared_path, write_and_read
from panelwise.sources import files, registry as R, runlog
from panelwise.streaming.features import stored_features, stream_features
from panelwise.streaming.monitoring import monitor_stream
from panelwise.streaming.scoring import score_stream

_YEARS = f"WITH {PANEL} SELECT entity_id, period AS year, amt, label FROM panel"


def _by_year(spark, sf):
    return panel(spark, sf).select("entity_id", F.col("period").alias("year"), "amt", "label")


@query("a1_hive_year_scan", f"{_YEARS} WHERE period >= 1997")
def _(spark, sf):
    path = shared_path(spark, "hive-years")
    files.write_years(_by_year(spark, sf), path)
    return files.read_hive_years(spark, path).filter("year >= 1997")


@query("a2_numeric_year_scan", f"{_YEARS} WHERE period IN (1996, 1998)")
def _(spark, sf):
    path = shared_path(spark, "numeric-years")
    data = write_and_read(_by_year(spark, sf), "panel")
    for (year,) in data.select("year").distinct().collect():  # one folder per calendar year
        data.filter(F.col("year") == year).drop("year").write.parquet(f"{path}/{year}")
    return files.read_panel(spark, path).filter("year IN (1996, 1998)")


@query("a3_recursive_scan", f"WITH {PANEL} SELECT entity_id, period AS year, amt, label, seg FROM panel")
def _(spark, sf):
    path = shared_path(spark, "nested")
    p = panel(spark, sf).select("entity_id", F.col("period").alias("year"), "amt", "label", "seg", F.col("seg").alias("folder"))
    p.write.partitionBy("folder").parquet(path)
    return files.read_recursive(spark, path)


@query("a3_year_from_path", f"{_YEARS}")
def _(spark, sf):
    path = shared_path(spark, "hive-years")
    files.write_years(_by_year(spark, sf), path)
    return files.read_recursive(spark, path, year_from_path=r"year=(\d{4})/")


@query("a4_reader_by_suffix", _YEARS)
def _(spark, sf):
    path = shared_path(spark, "table") + ".csv"
    p = _by_year(spark, sf)
    files.write_features(p, path, "csv")
    return files.read_table(spark, path, p.schema)


@query("a6_year_overwrite", f"WITH {PANEL} SELECT entity_id, period AS year, CASE WHEN period = 1997 THEN -amt ELSE amt END AS amt, label FROM panel")
def _(spark, sf):
    path = shared_path(spark, "hive-years")
    p = _by_year(spark, sf)
    files.write_years(p, path)
    files.write_years(p.filter("year = 1997").withColumn("amt", -F.col("amt")), path)
    return files.read_hive_years(spark, path)


@query("a7_snappy_parquet", _YEARS)
def _(spark, sf):
    path = shared_path(spark, "features")
    files.write_features(_by_year(spark, sf), path)
    return files.read_table(spark, path)


@query("a8_sized_files", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def _(spark, sf):
    path = shared_path(spark, "sized")
    files.write_sized(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), path)
    return files.read_table(spark, path)


@query("a9_warehouse_table", f"WITH {PANEL} SELECT count(*) AS loaded, count(*) AS stored, min(period) AS min_year, max(period) AS max_year FROM panel")
def _(spark, sf):
    location = shared_path(spark, "warehouse")
    name = "panelwise_" + location.rsplit("-", 1)[1]
    loaded = files.load_warehouse_table(_by_year(spark, sf), name, "features", location)
    stored = spark.table(f"{name}.features")
    return stored.agg(
        F.lit(loaded).cast("bigint").alias("loaded"), F.count(F.lit(1)).alias("stored"), F.min("year").alias("min_year"), F.max("year").alias("max_year")
    )


@query("a10_run_log", f"""
WITH {PANEL} SELECT 'prevalence' AS run_name, CAST(1 AS INTEGER) AS seq, CAST(period AS VARCHAR) AS key, round(avg(label), 6) AS value FROM panel GROUP BY period
UNION ALL SELECT 'prevalence', 2, CAST(period AS VARCHAR), CAST(count(*) AS DOUBLE) FROM panel GROUP BY period""")
def _(spark, sf):
    path = shared_path(spark, "run-log")
    by = aggregates.prevalence_by(panel(spark, sf), "label", "period")
    runlog.append(runlog.run_rows(spark, "prevalence", {"label": "label"}, []), path)
    runlog.append(runlog.metric_rows(by, "prevalence", 1, "period", "prevalence"), path)
    runlog.append(runlog.metric_rows(by, "prevalence", 2, "period", "total_rows"), path)
    return rounded(runlog.read_metrics(spark, path))


# --- registry -------------------------------------------------------------------------------------------------------

_TOP = "ranked AS (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY created_at DESC, version DESC) AS rn FROM registry)"


@query("e6_newest_versions", f"WITH {REGISTRY}, {_TOP} SELECT model_name, version, created_at, test_accuracy, test_f1 FROM ranked WHERE rn <= 10")
def _(spark, sf):
    return R.newest(registry(spark, sf))


@query("g3_latest_version", f"WITH {REGISTRY}, {_TOP} SELECT model_name, version, created_at, test_accuracy, test_f1 FROM ranked WHERE rn = 1")
def _(spark, sf):
    return R.latest(registry(spark, sf))


@query("g3_model_history", f"WITH {REGISTRY} SELECT * FROM registry WHERE model_name = 'Brand#17'")
def _(spark, sf):
    return R.history(registry(spark, sf), "Brand#17")


@query("g3_list_models", f"WITH {REGISTRY} SELECT model_name, count(*) AS versions, max(created_at) AS created_at FROM registry GROUP BY model_name")
def _(spark, sf):
    return R.list_models(registry(spark, sf))


@query("f4_compare_versions", f"""
WITH {REGISTRY}, {_TOP} SELECT a.model_name, a.version AS version1, b.version AS version2, round(b.test_accuracy - a.test_accuracy, 6) AS accuracy_delta, round(b.test_f1 - a.test_f1, 6) AS f1_delta
FROM ranked a JOIN ranked b ON a.model_name = b.model_name AND a.rn = 2 AND b.rn = 1""")
def _(spark, sf):
    return rounded(R.compare_newest(registry(spark, sf)))


@query("m1_register_versions", f"""
WITH {REGISTRY}, {_TOP} SELECT model_name, substr(md5(printf('%s_%s_%.4f_%.4f', model_name, created_at, test_accuracy, test_f1)), 1, 8) AS version, created_at, test_accuracy, test_f1 FROM ranked WHERE rn <= 10""")
def _(spark, sf):
    path = shared_path(spark, "registry")
    rows = registry(spark, sf).drop("version")
    R.register(rows.filter("created_at < '000000000500'"), path)
    R.register(rows.filter("created_at >= '000000000500'"), path)
    return R.read_registry(spark, path).select("model_name", "version", "created_at", "test_accuracy", "test_f1")


# --- streams ----------------------------------------------------------------------------------------------------------

@query("j1_score_stream", f"""
WITH {REQUESTS}, s AS (SELECT *, CASE WHEN age > 65 THEN 3 ELSE 0 END + CASE WHEN bmi > 30 THEN 1 ELSE 0 END + CASE WHEN systolic_bp > 140 THEN 1 ELSE 0 END + CASE WHEN glucose > 100 THEN 1 ELSE 0 END AS tenths,
  concat_ws(',', {ALL_RANGES}) AS violations FROM requests)
SELECT id, CASE WHEN violations = '' THEN tenths / 10.0::DOUBLE END AS score, CASE WHEN violations = '' THEN CASE WHEN tenths >= 4 THEN 1 ELSE 0 END ELSE -1 END AS label, violations FROM s""")
def _(spark, sf):
    """All eighteen fields against their ranges."""
    out = shared_path(spark, "scored")
    orders = spark.readStream.schema(table(spark, sf, "orders").schema).parquet(f"{sf}/orders*.parquet")
    # 0.35 lies between two possible scores, so rounding of the sum cannot move a label.
    score_stream(requests_of(orders), out, shared_path(spark, "stream-state"), 0.35).awaitTermination()
    good = spark.read.parquet(f"{out}/scored").select("id", F.round("score", 6).alias("score"), "label", F.lit("").alias("violations"))
    bad = spark.read.parquet(f"{out}/rejected")
    return good.unionByName(
        bad.select("id", F.lit(None).cast("double").alias("score"), F.lit(-1).alias("label"), F.concat_ws(",", "violations").alias("violations"))
    )


@query("j1_prediction_log", f"""
WITH {REQUESTS}, s AS (SELECT id, CASE WHEN age > 65 THEN 3 ELSE 0 END + CASE WHEN bmi > 30 THEN 1 ELSE 0 END + CASE WHEN systolic_bp > 140 THEN 1 ELSE 0 END + CASE WHEN glucose > 100 THEN 1 ELSE 0 END AS tenths, age, bmi FROM requests)
SELECT CAST(id AS VARCHAR) AS id, CAST(age AS INTEGER) AS age, tenths / 10.0::DOUBLE AS alzheimers_risk_probability, 'rules-1' AS model_version FROM s""")
def _(spark, sf):
    """Log rows of scored requests, stored and read back."""
    scored = score_with_rules(requests_of(table(spark, sf, "orders")), 0.35)
    log = write_and_read(prediction_log(scored, ("id", "age", "bmi"), "rules-1"), "prediction-log")
    inputs = F.col("inputs")
    return log.select(inputs["id"].alias("id"), inputs["age"].cast("double").cast("int").alias("age"), F.round("alzheimers_risk_probability", 6).alias("alzheimers_risk_probability"), "model_version")


_PARTS = (1994, 1996)


def _cumulative_sql(c):
    over = "OVER (PARTITION BY entity_id ORDER BY part)"
    return f"round(avg({c}) {over}, 6) AS {c}_patient_mean, round(coalesce(stddev_samp({c}) {over}, 0), 6) AS {c}_patient_std, min({c}) {over} AS {c}_patient_min, max({c}) {over} AS {c}_patient_max"


@query("j1_stream_features", f"""
WITH {PANEL}, p AS (SELECT entity_id, period, amt, CASE WHEN period < {_PARTS[0]} THEN 0 WHEN period < {_PARTS[1]} THEN 1 ELSE 2 END AS part FROM panel)
SELECT entity_id, period, {_cumulative_sql('amt')}, {rolling_sql('amt')}, {delta_sql('amt')} FROM p""")
def _(spark, sf):
    """Rows that arrive in three loads; each has the features of what arrived with it or before."""
    inbox, out, state = shared_path(spark, "arriving"), shared_path(spark, "stream-features"), shared_path(spark, "stream-state")
    p = write_and_read(panel(spark, sf).select("entity_id", "period", "amt"), "panel")
    first, second = _PARTS
    for part in (F.col("period") < first, (F.col("period") >= first) & (F.col("period") < second), F.col("period") >= second):
        p.filter(part).write.mode("append").parquet(inbox)  # a load is what has arrived since the stream last ran, in any number of files
        stream = spark.readStream.schema(p.schema).parquet(inbox)
        stream_features(stream, "entity_id", "period", ["amt"], out, state).awaitTermination()
    return rounded(stored_features(spark, out).drop("amt"))


@query("j2_monitor_stream", f"""
WITH {PREDLOG}, w AS (SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, risk_level, count(*) AS predictions,
  round(coalesce(avg(processing_time_ms) FILTER (processing_time_ms <> 0), 0), 2) AS average_processing_time_ms FROM predlog GROUP BY ALL)
SELECT strftime(window_start, '%Y-%m-%d') AS day, risk_level, predictions, average_processing_time_ms FROM w WHERE window_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM predlog)""")
def _(spark, sf):
    out = shared_path(spark, "monitor")
    events = spark.readStream.schema(table(spark, sf, "events").schema).parquet(f"{sf}/events*.parquet")
    monitor_stream(predlog_of(events), "ts", "risk_level", "processing_time_ms", out, shared_path(spark, "stream-state")).awaitTermination()
    done = spark.read.parquet(out)
    return done.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "risk_level", "predictions", "average_processing_time_ms")
