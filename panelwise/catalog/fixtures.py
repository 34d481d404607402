"""Views over the shared tables in the shapes the operators expect, as DataFrames and as SQL of the same rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.operators.skew import col


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, as the checks compare values by hash."""
    doubles = {n for n, t in df.dtypes if t == "double"}
    return df.select(*[_rounded(col(c), digits).alias(c) if c in doubles else col(c) for c in df.columns])


def _rounded(value: Column, digits: int) -> Column:
    """``round`` of a double, which goes through decimals. Away from ties, and up to numbers whose product with the power of ten is
    off by far less than the distance to one, the nearest multiple is the same number; decimals decide the others."""
    scaled = value * 10.0**digits
    whole = F.rint(scaled)
    sure = (F.abs(scaled) < 1e12) & (F.abs(scaled - whole) < 0.499)
    return F.when(sure, whole / 10.0**digits + 0.0).otherwise(F.round(value, digits))


def _year(c: str) -> Column:
    return F.year(c).cast("int")


# --- panel: customer x year of orders -----------------------------------------------------------------------------
PANEL = """panel AS (
  SELECT o_custkey AS entity_id, CAST(year(o_orderdate) AS INTEGER) AS period, count(*) AS n_orders,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS amt,
         CASE WHEN o_custkey % 7 <> 0 THEN CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 END AS amt_n,
         min(o_orderpriority) AS prio, c_mktsegment AS seg,
         max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS label
  FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY o_custkey, CAST(year(o_orderdate) AS INTEGER), c_mktsegment)"""


def panel(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    grouped = joined.groupBy(F.col("o_custkey").alias("entity_id"), _year("o_orderdate").alias("period"), F.col("c_mktsegment").alias("seg"))
    amt = F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).cast("double") / 100
    wide = grouped.agg(
        F.count(F.lit(1)).alias("n_orders"),
        amt.alias("amt"),
        F.min("o_orderpriority").alias("prio"),
        F.max((F.col("o_orderstatus") == "F").cast("int")).alias("label"),
    )
    return wide.select(
        "entity_id", "period", "n_orders", "amt", F.when(F.col("entity_id") % 7 != 0, F.col("amt")).alias("amt_n"), "prio", "seg", "label"
    )


# --- visits: customer x year with the eighteen clinical columns ----------------------------------------------------
_VISIT = (
    ("bmi", "14 + CAST(o_orderkey % 300 AS DOUBLE) / 10"),
    ("systolic_bp", "CAST(80 + o_orderkey % 130 AS DOUBLE)"),
    ("diastolic_bp", "CAST(45 + o_orderkey % 80 AS DOUBLE)"),
    ("heart_rate", "CAST(50 + o_orderkey % 71 AS DOUBLE)"),
    ("temperature", "95 + CAST(o_orderkey % 80 AS DOUBLE) / 10"),
    ("glucose", "CAST(55 + o_orderkey % 160 AS DOUBLE)"),
    ("cholesterol_total", "CAST(120 + o_orderkey % 250 AS DOUBLE)"),
    ("hdl", "CAST(22 + o_orderkey % 75 AS DOUBLE)"),
    ("ldl", "CAST(35 + o_orderkey % 210 AS DOUBLE)"),
    ("triglycerides", "CAST(40 + o_orderkey % 500 AS DOUBLE)"),
    ("creatinine", "CAST(4 + o_orderkey % 25 AS DOUBLE) / 10"),
    ("hemoglobin", "CAST(80 + o_orderkey % 140 AS DOUBLE) / 10"),
    ("white_blood_cells", "CAST(20 + o_orderkey % 180 AS DOUBLE) / 10"),
    ("platelets", "CAST(60 + o_orderkey % 500 AS DOUBLE)"),
)
_SEX = "CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END"
_EDUCATION = (
    "CASE o_custkey % 6 WHEN 0 THEN 'High School' WHEN 1 THEN 'Some College' WHEN 2 THEN 'Bachelor''s' "
    "WHEN 3 THEN 'Master''s' WHEN 4 THEN 'PhD' END"
)
VISITS = (
    "visits AS (\n  SELECT o_custkey AS patient_id, CAST(year(o_orderdate) AS INTEGER) AS year,\n"
    f"         {_SEX} AS sex, {_EDUCATION} AS education_level,\n"
    "         CAST(18 + o_custkey % 60 + year(o_orderdate) - 1992 AS DOUBLE) AS age,\n"
    + "".join(f"         max({expr}) AS {name},\n" for name, expr in _VISIT)
    + "         count(*) AS num_encounters, max(o_orderkey % 7) AS num_medications, max(o_orderkey % 11) AS num_lab_tests,\n"
    "         max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS alzheimers_diagnosis\n"
    "  FROM orders GROUP BY o_custkey, year(o_orderdate))"
)


def visits(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    grouped = o.groupBy(F.col("o_custkey").alias("patient_id"), _year("o_orderdate").alias("year")).agg(
        *[F.max(F.expr(expr)).alias(name) for name, expr in _VISIT],
        F.count(F.lit(1)).alias("num_encounters"),
        F.max(F.col("o_orderkey") % 7).alias("num_medications"),
        F.max(F.col("o_orderkey") % 11).alias("num_lab_tests"),
        F.max((F.col("o_orderstatus") == "F").cast("int")).alias("alzheimers_diagnosis"),
    )
    return grouped.select(
        "patient_id",
        "year",
        F.expr(_SEX.replace("o_custkey", "patient_id")).alias("sex"),
        F.expr(_EDUCATION.replace("o_custkey", "patient_id").replace("''", "\\'")).alias("education_level"),
        (18 + F.col("patient_id") % 60 + F.col("year") - 1992).cast("double").alias("age"),
        *[name for name, _ in _VISIT],
        "num_encounters",
        "num_medications",
        "num_lab_tests",
        "alzheimers_diagnosis",
    )


# --- scored: one prediction per order -----------------------------------------------------------------------------
SCORED = """scored AS (
  SELECT o_orderkey AS id, o_custkey AS entity_id, CAST(year(o_orderdate) AS INTEGER) AS period,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
         CAST(((o_orderkey % 89) * 60 - ((o_orderkey % 89) * 60) % 89) / 89 + 25 * (CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS DOUBLE) / 100 AS score,
         40 + CAST(o_custkey % 56 AS DOUBLE) + CAST(o_orderkey % 2 AS DOUBLE) / 2 AS age,
         CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CAST(6 + o_custkey % 17 AS INTEGER) AS education_years
  FROM orders)"""


def scored(spark: SparkSession, sf: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    label = (F.col("o_orderstatus") == "F").cast("int")
    base = F.floor((k % 89) * 60 / 89)
    return table(spark, sf, "orders").select(
        k.alias("id"),
        c.alias("entity_id"),
        _year("o_orderdate").alias("period"),
        label.alias("label"),
        ((base + 25 * label).cast("double") / 100).alias("score"),
        (40 + (c % 56).cast("double") + (k % 2).cast("double") / 2).alias("age"),
        F.when(c % 2 == 0, "F").otherwise("M").alias("gender"),
        (6 + c % 17).cast("int").alias("education_years"),
    )


# --- vitals: one record per order ---------------------------------------------------------------------------------
VITALS = """vitals AS (
  SELECT o_orderkey AS id, CAST(18 + o_orderkey % 80 AS DOUBLE) AS age, 14 + CAST(o_orderkey % 300 AS DOUBLE) / 10 AS bmi,
         CAST(80 + o_orderkey % 130 AS DOUBLE) AS systolic_bp, CAST(45 + o_orderkey % 80 AS DOUBLE) AS diastolic_bp,
         CAST(55 + o_orderkey % 160 AS DOUBLE) AS glucose, CAST(120 + o_orderkey % 250 AS DOUBLE) AS cholesterol_total,
         CAST(22 + o_orderkey % 75 AS DOUBLE) AS hdl, CAST(35 + o_orderkey % 210 AS DOUBLE) AS ldl
  FROM orders)"""


def vitals_of(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return orders.select(
        k.alias("id"),
        (18 + k % 80).cast("double").alias("age"),
        (14 + (k % 300).cast("double") / 10).alias("bmi"),
        (80 + k % 130).cast("double").alias("systolic_bp"),
        (45 + k % 80).cast("double").alias("diastolic_bp"),
        (55 + k % 160).cast("double").alias("glucose"),
        (120 + k % 250).cast("double").alias("cholesterol_total"),
        (22 + k % 75).cast("double").alias("hdl"),
        (35 + k % 210).cast("double").alias("ldl"),
    )


def vitals(spark: SparkSession, sf: str) -> DataFrame:
    return vitals_of(table(spark, sf, "orders"))


# --- requests: one scoring request per order, with all eighteen fields ------------------------------------------------
_REQUEST = (
    ("age", "CAST(o_orderkey % 130 AS DOUBLE)"),
    *[(name, "30 + CAST(o_orderkey % 80 AS DOUBLE) / 5" if name == "temperature" else expr) for name, expr in _VISIT],
    ("num_encounters", "o_orderkey % 40 - 1"),
    ("num_medications", "o_orderkey % 7"),
    ("num_lab_tests", "o_orderkey % 11"),
)
REQUESTS = "requests AS (\n  SELECT o_orderkey AS id, " + ", ".join(f"{expr} AS {name}" for name, expr in _REQUEST) + "\n  FROM orders)"


def requests_of(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("o_orderkey").alias("id"), *[F.expr(expr).alias(name) for name, expr in _REQUEST])


# --- prediction log and registry ------------------------------------------------------------------------------------
PREDLOG = """predlog AS (
  SELECT event_id, ts, CASE event_type WHEN 'error' THEN 'Very High' WHEN 'purchase' THEN 'High' WHEN 'click' THEN 'Moderate'
         WHEN 'view' THEN 'Low' ELSE 'Very Low' END AS risk_level, value AS processing_time_ms
  FROM events)"""


def predlog_of(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    level = F.when(kind == "error", "Very High").when(kind == "purchase", "High").when(kind == "click", "Moderate").when(kind == "view", "Low")
    return events.select("event_id", "ts", level.otherwise("Very Low").alias("risk_level"), F.col("value").alias("processing_time_ms"))


def predlog(spark: SparkSession, sf: str) -> DataFrame:
    return predlog_of(table(spark, sf, "events"))


REGISTRY = """registry AS (
  SELECT p_brand AS model_name, lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS version,
         lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS created_at,
         CAST(CAST(round(p_retailprice * 100) AS BIGINT) % 10000 AS DOUBLE) / 10000 AS test_accuracy,
         CAST(p_size % 50 AS DOUBLE) / 50 AS test_f1
  FROM part)"""


def registry(spark: SparkSession, sf: str) -> DataFrame:
    key = F.lpad(F.col("p_partkey").cast("string"), 12, "0")
    return table(spark, sf, "part").select(
        F.col("p_brand").alias("model_name"),
        key.alias("version"),
        key.alias("created_at"),
        ((F.round(F.col("p_retailprice") * 100).cast("bigint") % 10000).cast("double") / 10000).alias("test_accuracy"),
        ((F.col("p_size") % 50).cast("double") / 50).alias("test_f1"),
    )
