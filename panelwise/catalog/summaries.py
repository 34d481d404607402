"""Aggregates, encoders, scalers, splits and quality checks."""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, StructField, StructType

from panelwise.catalog import query
from panelwise.catalog.fixtures import PANEL, PREDLOG, SCORED, VISITS, VITALS, panel, predlog, rounded, scored, table, visits, vitals
from panelwise.functions import validation
from panelwise.operators import aggregates as A
from panelwise.operators import encoding, quality, scaling, splits
from panelwise.operators.panel import NUMERIC_COLUMNS
from panelwise.operators.projection import numeric_and_categorical
from panelwise.sources.files import count_from_footers

_PREV = "count(*) AS total_rows, CAST(coalesce(sum(label), 0) AS BIGINT) AS positive_cases, round(coalesce(sum(label) / nullif(count(*), 0), 0), 6) AS prevalence"


@query("d1_prevalence", f"WITH {PANEL} SELECT {_PREV} FROM panel")
def _(spark, sf):
    return rounded(A.prevalence(panel(spark, sf), "label"))


@query("d2_prevalence_by_period", f"WITH {PANEL} SELECT period, {_PREV} FROM panel GROUP BY period")
def _(spark, sf):
    return rounded(A.prevalence_by(panel(spark, sf), "label", "period"))


@query("d1b_prevalence_rollup", f"WITH {PANEL} SELECT coalesce(CAST(period AS VARCHAR), 'all') AS period, CAST(grouping(period) AS INTEGER) AS is_total, {_PREV} FROM panel GROUP BY ROLLUP (period)")
def _(spark, sf):
    out = A.prevalence_rollup(panel(spark, sf), "label", "period")
    return rounded(out.withColumn("period", F.coalesce(F.col("period").cast("string"), F.lit("all"))))


@query("d3_majority_label", f"WITH {PANEL} SELECT entity_id, CASE WHEN sum(label) * 2 > count(*) THEN 1 ELSE 0 END AS majority FROM panel GROUP BY entity_id")
def _(spark, sf):
    return A.majority_label(panel(spark, sf), "entity_id", "label")


@query("d4_class_balance", f"""
WITH {PANEL} SELECT count(*) FILTER (label = 0) AS negatives, count(*) FILTER (label = 1) AS positives, round(count(*) FILTER (label = 1) / count(*), 6) AS positive_rate,
  round(count(*) FILTER (label = 0) / greatest(count(*) FILTER (label = 1), 1), 6) AS neg_pos_ratio FROM panel""")
def _(spark, sf):
    return rounded(A.class_balance(panel(spark, sf), "label"))


@query("d5_distinct_counts", f"""
WITH {PANEL} SELECT 'seg' AS "column", count(DISTINCT seg) AS n_distinct FROM panel UNION ALL SELECT 'prio', count(DISTINCT prio) FROM panel
UNION ALL SELECT 'amt_n', count(DISTINCT amt_n) FROM panel UNION ALL SELECT 'entity_id', count(DISTINCT entity_id) FROM panel""")
def _(spark, sf):
    return A.distinct_counts(panel(spark, sf), ["seg", "prio", "amt_n", "entity_id"])


@query("g2_top_cardinality", f"""
WITH {PANEL} SELECT * FROM (SELECT 'seg' AS "column", count(DISTINCT seg) AS n_distinct FROM panel UNION ALL SELECT 'prio', count(DISTINCT prio) FROM panel
UNION ALL SELECT 'period', count(DISTINCT period) FROM panel UNION ALL SELECT 'n_orders', count(DISTINCT n_orders) FROM panel) ORDER BY n_distinct DESC, "column" LIMIT 2""")
def _(spark, sf):
    return A.top_cardinality(panel(spark, sf), ["seg", "prio", "period", "n_orders"], 2)


@query("d6_median_imputation", f"WITH {PANEL} SELECT entity_id, period, round(coalesce(amt_n, (SELECT median(amt_n) FROM panel)), 6) AS amt_n FROM panel")
def _(spark, sf):
    return rounded(A.impute(panel(spark, sf).select("entity_id", "period", "amt_n"), numeric=["amt_n"]))


@query("d6_medians", """
SELECT 'l_quantity' AS name, count(l_quantity) AS n, round(median(l_quantity), 6) AS median FROM lineitem
UNION ALL SELECT 'l_extendedprice', count(l_extendedprice), round(median(l_extendedprice), 6) FROM lineitem""")
def _(spark, sf):
    return rounded(A.medians(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"]))


@query("d7_mode_imputation", f"""
WITH {PANEL}, p AS (SELECT entity_id, period, CASE WHEN entity_id % 5 <> 0 THEN seg END AS seg FROM panel),
m AS (SELECT seg FROM p WHERE seg IS NOT NULL GROUP BY seg ORDER BY count(*) DESC, seg LIMIT 1) SELECT entity_id, period, coalesce(seg, (SELECT seg FROM m)) AS seg FROM p""")
def _(spark, sf):
    p = panel(spark, sf).select("entity_id", "period", F.when(F.col("entity_id") % 5 != 0, F.col("seg")).alias("seg"))
    return A.impute(p, categorical=["seg"])


@query("d26_warehouse_summary", f"""
WITH {PANEL} SELECT count(*) AS total_rows, count(DISTINCT entity_id) AS unique_entities, min(period) AS min_period, max(period) AS max_period,
  round(avg(amt), 4) AS avg_value, CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS positive_cases FROM panel""")
def _(spark, sf):
    return rounded(A.warehouse_summary(panel(spark, sf), "entity_id", "period", "amt", "label"), 4)


@query("d28_recent_predictions", f"""
WITH {PREDLOG}, r AS (SELECT * FROM predlog ORDER BY ts DESC, event_id DESC LIMIT 100)
SELECT count(*) AS total_predictions, count(*) FILTER (risk_level IN ('High', 'Very High')) AS high_risk_predictions,
  round(100.0 * count(*) FILTER (risk_level IN ('High', 'Very High')) / count(*), 6) AS high_risk_percentage,
  round(coalesce(avg(processing_time_ms) FILTER (processing_time_ms <> 0), 0), 2) AS average_processing_time_ms FROM r""")
def _(spark, sf):
    return rounded(A.recent_predictions(predlog(spark, sf), "ts", "event_id", "risk_level", "processing_time_ms"))


@query("h2_distinct_values", f"WITH {PANEL} SELECT DISTINCT prio FROM panel")
def _(spark, sf):
    return encoding.distinct_values(panel(spark, sf), "prio")


# --- encoders -----------------------------------------------------------------------------------------------------


@query("i1_one_hot", f"""
WITH {PANEL} SELECT entity_id, period, CASE WHEN seg = 'AUTOMOBILE' THEN 1 ELSE 0 END AS "seg_AUTOMOBILE", CASE WHEN seg = 'BUILDING' THEN 1 ELSE 0 END AS "seg_BUILDING",
  CASE WHEN seg = 'FURNITURE' THEN 1 ELSE 0 END AS "seg_FURNITURE", CASE WHEN seg = 'HOUSEHOLD' THEN 1 ELSE 0 END AS "seg_HOUSEHOLD", CASE WHEN seg = 'MACHINERY' THEN 1 ELSE 0 END AS "seg_MACHINERY"
FROM (SELECT entity_id, period, CASE WHEN entity_id % 9 <> 0 THEN seg END AS seg FROM panel)""")
def _(spark, sf):
    p = panel(spark, sf).select("entity_id", "period", F.when(F.col("entity_id") % 9 != 0, F.col("seg")).alias("seg"))
    return encoding.one_hot(p, ["seg"]).drop("seg")


@query("i2_label_encode", f"""
WITH {PANEL}, m AS (SELECT prio, CAST(row_number() OVER (ORDER BY prio) - 1 AS BIGINT) AS code FROM (SELECT DISTINCT prio FROM panel WHERE period < 1996 AND prio <> '2-HIGH'))
SELECT entity_id, period, prio, coalesce(code, -1) AS prio_encoded FROM panel LEFT JOIN m USING (prio)""")
def _(spark, sf):
    p = panel(spark, sf).select("entity_id", "period", "prio")
    index = encoding.label_index(p.filter("period < 1996 AND prio <> '2-HIGH'"), "prio")
    return encoding.label_encode(p, "prio", index)


@query("i2_label_encode_many_values", """
WITH m AS (SELECT c_name, CAST(row_number() OVER (ORDER BY c_name) - 1 AS BIGINT) AS c_name_encoded FROM (SELECT DISTINCT c_name FROM customer))
SELECT c_custkey, c_name_encoded FROM customer JOIN m USING (c_name)""")
def _(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    index = encoding.label_index(c, "c_name")
    return encoding.label_encode(c, "c_name", index).drop("c_name")


@query("i3_category_codes", f"""
WITH {PANEL}, p AS (SELECT entity_id, period, CASE WHEN entity_id % 9 <> 0 THEN seg END AS seg, prio FROM panel)
SELECT entity_id, period, CASE WHEN seg IS NULL THEN -1 ELSE CAST(dense_rank() OVER (ORDER BY seg NULLS LAST) - 1 AS BIGINT) END AS seg, CAST(dense_rank() OVER (ORDER BY prio) - 1 AS BIGINT) AS prio FROM p""")
def _(spark, sf):
    p = panel(spark, sf).select("entity_id", "period", F.when(F.col("entity_id") % 9 != 0, F.col("seg")).alias("seg"), "prio")
    return encoding.category_codes(p, {c: encoding.label_index(p, c) for c in ("seg", "prio")})


@query("l8_target_encode", f"""
WITH {PANEL}, t AS (SELECT * FROM panel WHERE period < 1997 AND seg <> 'BUILDING'), m AS (SELECT seg, avg(label) AS v FROM t GROUP BY seg)
SELECT entity_id, period, seg, round(coalesce(v, (SELECT avg(label) FROM t)), 6) AS seg_target FROM panel LEFT JOIN m USING (seg)""")
def _(spark, sf):
    p = panel(spark, sf).select("entity_id", "period", "seg", "label")
    return rounded(encoding.target_encode(p, p.filter("period < 1997 AND seg <> 'BUILDING'"), "seg", "label").drop("label"))


@query("l11_capped_categories", """
WITH k AS (SELECT p_brand FROM part GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 5)
SELECT p_partkey, CASE WHEN p_brand IN (SELECT p_brand FROM k) THEN p_brand ELSE 'other' END AS p_brand FROM part""")
def _(spark, sf):
    return encoding.cap_categories(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_brand", 5)


# --- scalers, filters, outliers -------------------------------------------------------------------------------------


@query("i5_standard_scaling", f"WITH {PANEL} SELECT entity_id, period, round((amt - avg(amt) OVER ()) / stddev_pop(amt) OVER (), 6) AS amt_scaled FROM panel")
def _(spark, sf):
    p = panel(spark, sf).select("entity_id", "period", "amt")
    return rounded(scaling.scale(p, scaling.fit_standard(p, ["amt"])).drop("amt"))


@query("l7_minmax_scaling", f"WITH {PANEL} SELECT entity_id, period, round((amt - min(amt) OVER ()) / (max(amt) OVER () - min(amt) OVER ()), 6) AS amt_scaled FROM panel")
def _(spark, sf):
    p = panel(spark, sf).select("entity_id", "period", "amt")
    return rounded(scaling.scale(p, scaling.fit_minmax(p, ["amt"])).drop("amt"))


_Q = "s AS (SELECT quantile_cont(amt, 0.25) AS q1, median(amt) AS m, quantile_cont(amt, 0.75) AS q3 FROM panel)"


@query("l7_robust_scaling", f"WITH {PANEL}, {_Q} SELECT entity_id, period, round((amt - m) / (q3 - q1), 6) AS amt_scaled FROM panel, s")
def _(spark, sf):
    p = panel(spark, sf).select("entity_id", "period", "amt")
    return rounded(scaling.scale(p, scaling.fit_robust(p, ["amt"])).drop("amt"))


@query("l6_iqr_outliers", f"""
WITH {PANEL}, {_Q} SELECT entity_id, period, CASE WHEN amt < q1 - 1.5::DOUBLE * (q3 - q1) OR amt > q3 + 1.5::DOUBLE * (q3 - q1) THEN 1 ELSE 0 END AS amt_outlier FROM panel, s""")
def _(spark, sf):
    p = panel(spark, sf).select("entity_id", "period", "amt")
    return scaling.flag_outliers(p, ["amt"]).drop("amt")


@query("l5_missing_indicators", f"WITH {PANEL} SELECT entity_id, period, CASE WHEN amt IS NULL THEN 1 ELSE 0 END AS amt_missing, CASE WHEN amt_n IS NULL THEN 1 ELSE 0 END AS amt_n_missing FROM panel")
def _(spark, sf):
    p = panel(spark, sf).select("entity_id", "period", "amt", "amt_n")
    return scaling.missing_indicators(p, ["amt", "amt_n"]).drop("amt", "amt_n")


@query("i6_variance_filter", f"""
WITH {SCORED} SELECT 'score' AS "column", round(var_pop(score), 6) AS variance, var_pop(score) > 0.01 AS kept FROM scored
UNION ALL SELECT 'tiny', round(var_pop(score / 10), 6), var_pop(score / 10) > 0.01 FROM scored UNION ALL SELECT 'label', round(var_pop(label), 6), var_pop(label) > 0.01 FROM scored""")
def _(spark, sf):
    s = scored(spark, sf).withColumn("tiny", F.col("score") / 10)
    return rounded(scaling.variances(s, ["score", "tiny", "label"]))


@query("l9_correlations", f"""
WITH {VITALS} SELECT 'age' AS "left", 'bmi' AS "right", round(corr(age, bmi), 6) AS correlation FROM vitals UNION ALL SELECT 'age', 'age_months', round(corr(age, age * 12 + id % 2), 6) FROM vitals
UNION ALL SELECT 'bmi', 'age_months', round(corr(bmi, age * 12 + id % 2), 6) FROM vitals""")
def _(spark, sf):
    v = vitals(spark, sf).withColumn("age_months", F.col("age") * 12 + F.col("id") % 2)
    return rounded(scaling.correlations(v, ["age", "bmi", "age_months"]))


_ALL_PAIRS = [(a, b) for i, a in enumerate(NUMERIC_COLUMNS) for b in NUMERIC_COLUMNS[i + 1 :]]


@query("l9_all_correlations", f"WITH {VISITS}, c AS (SELECT " + ", ".join(f"corr({a}, {b}) AS r{i}" for i, (a, b) in enumerate(_ALL_PAIRS)) + " FROM visits) "
       + " UNION ALL ".join(f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", round(r{i}, 6) AS correlation FROM c" for i, (a, b) in enumerate(_ALL_PAIRS)))
def _(spark, sf):
    """All pairs of the eighteen columns."""
    return rounded(scaling.correlations(visits(spark, sf), NUMERIC_COLUMNS))


@query("l9_uncorrelated_frame", f"WITH {VITALS} SELECT id, age, bmi FROM vitals")
def _(spark, sf):
    v = vitals(spark, sf).withColumn("age_months", F.col("age") * 12 + F.col("id") % 2)
    return v.select("id", *scaling.uncorrelated_columns(v, ["age", "bmi", "age_months"]))


@query("l10_interactions", f"""
WITH {VITALS} SELECT id, round(age * bmi, 6) AS age_x_bmi, age * glucose AS age_x_glucose, round(bmi * glucose, 6) AS bmi_x_glucose, age * age AS age_pow2, round(bmi * bmi, 6) AS bmi_pow2 FROM vitals""")
def _(spark, sf):
    v = scaling.interactions(vitals(spark, sf).select("id", "age", "bmi", "glucose"), ["age", "bmi", "glucose"])
    v = scaling.polynomials(v, ["age"]).withColumns({"bmi_pow2": F.col("bmi") * F.col("bmi")})
    return rounded(v.drop("age", "bmi", "glucose"))


# --- splits and weights ---------------------------------------------------------------------------------------------

_U = "CAST('0x' || substr(md5(entity_id || '|42'), 1, 8) AS BIGINT) % 10000 / 10000.0::DOUBLE"


@query("i8_entity_split", f"""
WITH {PANEL} SELECT entity_id, period, CASE WHEN {_U} < 0.2::DOUBLE THEN 'test' WHEN {_U} < 0.2::DOUBLE + 0.8::DOUBLE * 0.2::DOUBLE THEN 'val' ELSE 'train' END AS split FROM panel""")
def _(spark, sf):
    return splits.assign_split(panel(spark, sf).select("entity_id", "period"), "entity_id")


@query("i8_exact_split", f"""
WITH {PANEL}, e AS (SELECT entity_id, CASE WHEN sum(label) * 2 > count(*) THEN 1 ELSE 0 END AS stratum FROM panel GROUP BY entity_id),
c AS (SELECT stratum, count(*) AS n FROM e GROUP BY stratum), c1 AS (SELECT *, ceil(sum(n) OVER () * 0.2) AS t, n * ceil(sum(n) OVER () * 0.2) / sum(n) OVER () AS q FROM c),
c2 AS (SELECT stratum, n, least(floor(q) + CASE WHEN row_number() OVER (ORDER BY q - floor(q) DESC, stratum) <= t - sum(floor(q)) OVER () THEN 1 ELSE 0 END, n - 1) AS test FROM c1),
c3 AS (SELECT *, n - test AS m, ceil(sum(n - test) OVER () * 0.2) AS t, (n - test) * ceil(sum(n - test) OVER () * 0.2) / sum(n - test) OVER () AS q FROM c2),
c4 AS (SELECT stratum, test, least(floor(q) + CASE WHEN row_number() OVER (ORDER BY q - floor(q) DESC, stratum) <= t - sum(floor(q)) OVER () THEN 1 ELSE 0 END, m - 1) AS val FROM c3),
r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY substr(md5(entity_id || '|42'), 1, 13)) AS place FROM e)
SELECT entity_id, stratum, CASE WHEN place <= test THEN 'test' WHEN place <= test + val THEN 'val' ELSE 'train' END AS split FROM r JOIN c4 USING (stratum)""")
def _(spark, sf):
    return splits.exact_split(panel(spark, sf), "entity_id", "label")


@query("i9_class_weights", f"""
WITH {PANEL} SELECT entity_id, period, round(CASE WHEN label = 1 THEN count(*) OVER () / (2.0 * sum(label) OVER ()) ELSE count(*) OVER () / (2.0 * sum(1 - label) OVER ()) END, 6) AS weight FROM panel""")
def _(spark, sf):
    return rounded(splits.with_class_weight(panel(spark, sf).select("entity_id", "period", "label"), "label").drop("label"))


# --- quality ----------------------------------------------------------------------------------------------------------


@query("a5_row_count", "SELECT count(*) AS total_rows FROM lineitem")
def _(spark, sf):
    return A.row_count(table(spark, sf, "lineitem"))


@query("a5_footer_count", "SELECT count(*) AS total_rows FROM orders")
def _(spark, sf):
    """From the footers; no column is read."""
    return count_from_footers(spark, f"{sf}/orders.parquet")


_KIND = "CASE WHEN column_type IN ('BIGINT', 'INTEGER', 'DOUBLE', 'FLOAT') OR column_type LIKE 'DECIMAL%' THEN 'numeric' ELSE 'categorical' END"


@query("b2_column_kinds", f"SELECT column_name, {_KIND} AS kind FROM (DESCRIBE SELECT * FROM lineitem)")
def _(spark, sf):
    numeric, categorical = numeric_and_categorical(table(spark, sf, "lineitem"))
    rows = [(c, "numeric") for c in numeric] + [(c, "categorical") for c in categorical]
    return spark.createDataFrame(rows, "column_name string, kind string")


_SPARK_TYPE = "CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END"


@query("d27_schema_rows", f"SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name, {_SPARK_TYPE} AS data_type FROM (DESCRIBE SELECT * FROM customer)")
def _(spark, sf):
    return A.schema_rows(table(spark, sf, "customer"))


@query("d29_importance_summary", """
WITH i AS (SELECT o_orderpriority, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM orders) AS importance FROM orders GROUP BY ALL)
SELECT round(avg(importance), 6) AS importance_mean, round(stddev_pop(importance), 6) AS importance_std FROM i""")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    share = orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).withColumn("importance", F.col("n") / orders.agg(F.count(F.lit(1))).scalar())
    return rounded(A.importance_summary(share))


@query("l2_type_differences", """
SELECT * FROM (VALUES ('c_acctbal', 'decimal(12,2)', (SELECT lower(column_type) FROM (DESCRIBE SELECT * FROM customer) WHERE column_name = 'c_acctbal')),
  ('c_since', 'date', NULL), ('c_mktsegment', NULL, 'string')) AS t("column_name", expected, actual)""")
def _(spark, sf):
    customer = table(spark, sf, "customer")
    fields = [f for f in customer.schema.fields if f.name not in ("c_acctbal", "c_mktsegment")]
    expected = StructType([*fields, StructField("c_acctbal", DecimalType(12, 2)), StructField("c_since", DateType())])
    return quality.type_differences(customer, expected)


@query("l1_duplicate_keys", "SELECT o_custkey, o_orderdate, count(*) AS copies FROM orders GROUP BY ALL HAVING count(*) > 1")
def _(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "orders"), ["o_custkey", "o_orderdate"])


_RANGE_COUNTS = " UNION ALL ".join(
    f"SELECT '{r.field}' AS field, count({r.field}) AS checked, count(*) FILTER ({r.field} < {r.lo} OR {r.field} > {r.hi}) AS violations FROM v" for r in validation.CLINICAL_RANGES
)


@query("l3_clinical_ranges", f"WITH {VISITS}, v AS (SELECT * REPLACE (bmi * 1.5 AS bmi) FROM visits) {_RANGE_COUNTS}")
def _(spark, sf):
    """All fifteen ranges; the body-mass index is moved so that its upper bound is passed."""
    return validation.range_violation_counts(visits(spark, sf).withColumn("bmi", F.col("bmi") * 1.5))


@query("l4_missing_and_infinite", f"""
WITH {PANEL}, p AS (SELECT entity_id, CASE WHEN entity_id % 11 = 0 THEN 'inf'::DOUBLE WHEN entity_id % 11 = 1 THEN 'nan'::DOUBLE ELSE amt_n END AS amt_n, prio FROM panel)
SELECT 'entity_id' AS "column", count(*) FILTER (entity_id IS NULL) AS missing, 0::BIGINT AS infinite FROM p
UNION ALL SELECT 'amt_n', count(*) FILTER (amt_n IS NULL OR isnan(amt_n)), count(*) FILTER (isinf(amt_n)) FROM p UNION ALL SELECT 'prio', count(*) FILTER (prio IS NULL), 0 FROM p""")
def _(spark, sf):
    k = F.col("entity_id") % 11
    odd = F.when(k == 0, F.lit(float("inf"))).when(k == 1, F.lit(float("nan"))).otherwise(F.col("amt_n"))
    return quality.missing_and_infinite(panel(spark, sf).select("entity_id", odd.alias("amt_n"), "prio"))
