"""Projections, filters, rules and units (records of ``vitals``, ``visits`` and ``scored``)."""
from __future__ import annotations

from pyspark.sql import functions as F

from panelwise.catalog import query
from panelwise.catalog.fixtures import PANEL, REGISTRY, SCORED, VISITS, VITALS, panel, registry, rounded, scored, visits, vitals
from panelwise.functions import identity, rules, units, validation
from panelwise.operators import projection, scaling

_IN = [r for r in validation.REQUEST_RANGES if r.field in ("age", "bmi", "systolic_bp", "diastolic_bp", "glucose", "cholesterol_total", "hdl", "ldl")]


@query("b1_exclude_columns", f"WITH {PANEL} SELECT n_orders, amt, amt_n, prio, seg FROM panel")
def _(spark, sf):
    return projection.exclude(panel(spark, sf), ("entity_id", "period", "label"))


@query("b3_align_features", f"WITH {VITALS} SELECT id, glucose, CAST(0 AS DOUBLE) AS creatinine, bmi, CAST(0 AS DOUBLE) AS visits FROM vitals")
def _(spark, sf):
    return projection.align(vitals(spark, sf), ["glucose", "creatinine", "bmi", "visits"], keep=["id"], default=0.0)


@query("b3b_defaults_by_name", f"""
WITH {VITALS} SELECT id, age AS dosage_index, age AS year, bmi AS bmi_delta_1y, systolic_bp AS systolic_bp_mean,
  diastolic_bp AS bp_min, glucose AS glucose_std, CAST(0 AS DOUBLE) AS hdl_std, CAST(0 AS DOUBLE) AS "region_Ohio" FROM vitals""")
def _(spark, sf):
    wanted = ["dosage_index", "year", "bmi_delta_1y", "systolic_bp_mean", "bp_min", "glucose_std", "hdl_std", "region_Ohio"]
    return projection.align(vitals(spark, sf), wanted, keep=["id"])


@query("b4_rename_request_fields", f"WITH {VISITS} SELECT patient_id, year, num_encounters, num_medications, num_lab_tests, systolic_bp, diastolic_bp FROM visits")
def _(spark, sf):
    back = {new: old for old, new in projection.REQUEST_NAMES.items()}
    sent = visits(spark, sf).select("patient_id", "year", *back).withColumnsRenamed(back)
    return projection.rename(sent)


@query("b6_threshold_predicate", f"WITH {SCORED} SELECT id, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted FROM scored")
def _(spark, sf):
    return scored(spark, sf).select("id", rules.at_threshold("score", 0.5).alias("predicted"))


@query("b7_range_validation", f"""
WITH {VITALS} SELECT id, concat_ws(',', CASE WHEN age < 0 OR age > 120 THEN 'age:range' END, CASE WHEN bmi < 10 OR bmi > 100 THEN 'bmi:range' END,
  CASE WHEN systolic_bp < 50 OR systolic_bp > 300 THEN 'systolic_bp:range' END, CASE WHEN diastolic_bp < 30 OR diastolic_bp > 200 THEN 'diastolic_bp:range' END,
  CASE WHEN glucose < 20 OR glucose > 1000 THEN 'glucose:range' END, CASE WHEN cholesterol_total < 50 OR cholesterol_total > 500 THEN 'cholesterol_total:range' END,
  CASE WHEN hdl < 10 OR hdl > 200 THEN 'hdl:range' END, CASE WHEN ldl < 10 OR ldl > 300 THEN 'ldl:range' END) AS violations
FROM (SELECT id, age * 1.5 AS age, bmi * 2.5 AS bmi, systolic_bp, diastolic_bp, glucose, cholesterol_total * 1.5 AS cholesterol_total, hdl, ldl * 1.4 AS ldl FROM vitals)""")
def _(spark, sf):
    v = vitals(spark, sf).withColumns(
        {"age": F.col("age") * 1.5, "bmi": F.col("bmi") * 2.5, "cholesterol_total": F.col("cholesterol_total") * 1.5, "ldl": F.col("ldl") * 1.4}
    )
    return validation.check(v, _IN).select("id", F.concat_ws(",", "violations").alias("violations"))


ALL_RANGES = ", ".join(
    f"CASE WHEN {r.field} < {r.lo} {f'OR {r.field} > {r.hi}' if r.hi is not None else ''} THEN '{r.field}:range' END" for r in validation.REQUEST_RANGES
)


@query("b7_all_ranges", f"WITH {VISITS} SELECT patient_id, year, concat_ws(',', {ALL_RANGES}) AS violations FROM (SELECT * REPLACE (bmi * 2.5 AS bmi, ldl * 1.4 AS ldl) FROM visits)")
def _(spark, sf):
    """All eighteen request fields."""
    v = visits(spark, sf).withColumns({"bmi": F.col("bmi") * 2.5, "ldl": F.col("ldl") * 1.4})
    return validation.check(v).select("patient_id", "year", F.concat_ws(",", "violations").alias("violations"))


@query("b8_required_fields", f"""
WITH {VITALS} SELECT id, concat_ws(',', CASE WHEN id % 5 = 0 THEN 'age:missing' WHEN id % 5 = 1 THEN 'age:type' END, 'heart_rate:missing') AS violations FROM vitals""")
def _(spark, sf):
    raw = F.when(F.col("id") % 5 == 0, F.lit(None)).when(F.col("id") % 5 == 1, F.lit("old")).otherwise(F.col("age").cast("string"))
    sent = vitals(spark, sf).withColumn("age", raw)
    fields = [r for r in validation.REQUEST_RANGES if r.field in ("age", "heart_rate")]
    return validation.check(sent, fields).select("id", F.concat_ws(",", "violations").alias("violations"))


@query("b9_preview", f"WITH {VITALS} SELECT id, age, bmi FROM vitals ORDER BY bmi, id LIMIT 100")
def _(spark, sf):
    return projection.preview(vitals(spark, sf).select("id", "age", "bmi"), 100, ["bmi", "id"])


_FLAGS = """
  CASE WHEN bmi < 18.5 THEN 1 ELSE 0 END AS underweight, CASE WHEN bmi >= 18.5 AND bmi < 25 THEN 1 ELSE 0 END AS normal_weight,
  CASE WHEN bmi >= 25 AND bmi < 30 THEN 1 ELSE 0 END AS overweight, CASE WHEN bmi >= 30 THEN 1 ELSE 0 END AS obese,
  CASE WHEN systolic_bp >= 140 THEN 1 ELSE 0 END AS high_systolic, CASE WHEN diastolic_bp >= 90 THEN 1 ELSE 0 END AS high_diastolic,
  CASE WHEN glucose >= 126 THEN 1 ELSE 0 END AS high_glucose, CASE WHEN glucose >= 100 AND glucose < 126 THEN 1 ELSE 0 END AS prediabetic,
  CASE WHEN cholesterol_total >= 240 THEN 1 ELSE 0 END AS high_cholesterol, CASE WHEN hdl < 40 THEN 1 ELSE 0 END AS low_hdl,
  CASE WHEN ldl >= 160 THEN 1 ELSE 0 END AS high_ldl, CASE WHEN age >= 65 THEN 1 ELSE 0 END AS elderly,
  CASE WHEN age >= 45 AND age < 65 THEN 1 ELSE 0 END AS middle_aged"""
_RISK = """CASE WHEN bmi >= 30 THEN 1 ELSE 0 END + CASE WHEN systolic_bp >= 140 THEN 1 ELSE 0 END
  + CASE WHEN glucose >= 126 THEN 1 ELSE 0 END + CASE WHEN age >= 65 THEN 1 ELSE 0 END AS risk_score"""


@query("c1_band_flags", f"WITH {VITALS} SELECT id, {_FLAGS} FROM vitals")
def _(spark, sf):
    flags = [b.out for b in rules.CLINICAL_BANDS]
    return rules.band_flags(vitals(spark, sf)).select("id", *flags)


@query("c2_risk_score", f"WITH {VITALS} SELECT id, {_RISK} FROM vitals")
def _(spark, sf):
    return vitals(spark, sf).select("id", rules.risk_score().alias("risk_score"))


@query("c3_right_closed_bins", f"""
WITH {VITALS} SELECT id, CASE WHEN bmi > 0 AND bmi <= 18.5 THEN 'underweight' WHEN bmi > 18.5 AND bmi <= 25 THEN 'normal'
    WHEN bmi > 25 AND bmi <= 30 THEN 'overweight' WHEN bmi > 30 AND bmi <= 100 THEN 'obese' END AS bmi_category,
  CASE WHEN a > 0 AND a <= 50 THEN 'young' WHEN a > 50 AND a <= 65 THEN 'middle' WHEN a > 65 AND a <= 80 THEN 'senior'
    WHEN a > 80 AND a <= 100 THEN 'elderly' END AS age_group
FROM (SELECT id, bmi, age + 10 AS a FROM vitals)""")
def _(spark, sf):
    v = vitals(spark, sf).withColumn("age", F.col("age") + 10)
    return v.select(
        "id", rules.right_closed_bins("bmi", *rules.BMI_BINS).alias("bmi_category"), rules.right_closed_bins("age", *rules.AGE_BINS).alias("age_group")
    )


@query("c4_age_group_indicators", f"""
WITH {VITALS} SELECT id, CASE WHEN age < 50 THEN 1 ELSE 0 END AS age_group_young, CASE WHEN age >= 50 AND age < 65 THEN 1 ELSE 0 END AS age_group_middle,
  CASE WHEN age >= 65 AND age < 80 THEN 1 ELSE 0 END AS age_group_senior, CASE WHEN age >= 80 THEN 1 ELSE 0 END AS age_group_elderly FROM vitals""")
def _(spark, sf):
    groups = rules.group_indicators("age", "age_group", *rules.AGE_GROUPS)
    return vitals(spark, sf).select("id", *[c.alias(n) for n, c in groups.items()])


@query("c5_additive_score", f"""
WITH {VITALS} SELECT id, round(CASE WHEN age > 65 THEN 0.3 ELSE 0 END::DOUBLE + CASE WHEN bmi > 30 THEN 0.1 ELSE 0 END::DOUBLE
  + CASE WHEN systolic_bp > 140 THEN 0.1 ELSE 0 END::DOUBLE + CASE WHEN glucose > 100 THEN 0.1 ELSE 0 END::DOUBLE, 6) AS score FROM vitals""")
def _(spark, sf):
    return rounded(vitals(spark, sf).select("id", rules.weighted_score().alias("score")))


@query("c6_risk_tiers", f"""
WITH {SCORED} SELECT id, CASE WHEN score >= 0.8 THEN 'Very High' WHEN score >= 0.6 THEN 'High' WHEN score >= 0.4 THEN 'Moderate' WHEN score >= 0.2 THEN 'Low' ELSE 'Very Low' END AS risk_level,
  CASE WHEN greatest(score, 1 - score) >= 0.9 THEN 'Very High' WHEN greatest(score, 1 - score) >= 0.8 THEN 'High' WHEN greatest(score, 1 - score) >= 0.7 THEN 'Moderate' ELSE 'Low' END AS confidence,
  CASE WHEN score > 0.5 THEN 'High Risk' ELSE 'Low Risk' END AS prediction
FROM scored""")
def _(spark, sf):
    report = rules.score_report("score")
    return scored(spark, sf).select("id", *[report[n].alias(n) for n in ("risk_level", "confidence", "prediction")])


@query("c7_rounded_probability", f"WITH {SCORED} SELECT id, round(score / 3, 4) AS probability FROM scored")
def _(spark, sf):
    s = scored(spark, sf).withColumn("score", F.col("score") / 3)
    return s.select("id", rules.score_report("score")["probability"].alias("probability"))


@query("c8_derived_fill", f"""
WITH {VITALS} SELECT id, ldl + hdl + 40 AS cholesterol_total, CAST(150 AS DOUBLE) AS triglycerides, CAST(7 AS DOUBLE) AS white_blood_cells,
  CAST(250 AS DOUBLE) AS platelets FROM vitals""")
def _(spark, sf):
    v = vitals(spark, sf).select("id", "ldl", "hdl")
    return rules.fill_missing_columns(v, rules.lab_defaults()).drop("ldl", "hdl")


@query("c9_unit_conversion", f"""
WITH {VITALS} SELECT id, round(glucose / CAST(18.018 AS DOUBLE), 6) AS glucose_mmol, round(systolic_bp / 7.5, 6) AS systolic_kpa,
  round(hdl * CAST(38.67 AS DOUBLE), 6) AS hdl_from_mmol, round(age / (CAST(1 AS DOUBLE) / 12), 6) AS age_months, bmi FROM vitals""")
def _(spark, sf):
    c = units.convert
    return rounded(
        vitals(spark, sf).select(
            "id",
            c(F.col("glucose"), "glucose", "mg/dL", "mmol/L").alias("glucose_mmol"),
            c(F.col("systolic_bp"), "systolic_bp", "mmHg", "kPa").alias("systolic_kpa"),
            c(F.col("hdl"), "hdl_cholesterol", "mmol/L", "mg/dL").alias("hdl_from_mmol"),
            c(F.col("age"), "age", "years", "months").alias("age_months"),
            c(F.col("bmi"), "bmi", "kg/m²", "kg/m²").alias("bmi"),
        )
    )


@query("c9_unit_conversion_by_row", f"""
WITH {VITALS} SELECT id, field, unit, round(value * CASE WHEN unit = 'mmol/L' AND field = 'glucose' THEN CAST(18.018 AS DOUBLE) WHEN unit = 'kPa' AND field = 'systolic_bp' THEN 7.5
   WHEN unit IN ('mg/dL', 'mmHg') THEN 1 END, 6) AS std_value
FROM (SELECT id, 'glucose' AS field, CASE WHEN id % 3 = 0 THEN 'mmol/L' WHEN id % 3 = 1 THEN 'mg/dL' ELSE 'stone' END AS unit, glucose AS value FROM vitals
  UNION ALL SELECT id, 'systolic_bp', CASE WHEN id % 2 = 0 THEN 'kPa' ELSE 'mmHg' END, systolic_bp FROM vitals)""")
def _(spark, sf):
    v, k = vitals(spark, sf), F.col("id")
    g = F.when(k % 3 == 0, "mmol/L").when(k % 3 == 1, "mg/dL").otherwise("stone")
    s = F.when(k % 2 == 0, "kPa").otherwise("mmHg")
    cell = lambda f, u: F.struct(F.lit(f).alias("field"), u.alias("unit"), F.col(f).alias("value"))
    long = v.select("id", F.inline(F.array(cell("glucose", g), cell("systolic_bp", s))))
    return rounded(units.convert_rows(long, "value", "field", "unit").drop("value"))


@query("c10_standardise_frame", f"""
WITH {VITALS} SELECT id, round(glucose * CAST(18.018 AS DOUBLE), 6) AS glucose, round(cholesterol_total * CAST(38.67 AS DOUBLE), 6) AS cholesterol_total,
  CASE WHEN id % 4 <> 0 THEN round(systolic_bp * 7.5, 6) END AS systolic_bp FROM vitals""")
def _(spark, sf):
    v = vitals(spark, sf).select("id", "glucose", "cholesterol_total", F.when(F.col("id") % 4 != 0, F.col("systolic_bp")).alias("systolic_bp"))
    return rounded(units.standardize(v, {"glucose": "mmol/L", "cholesterol_total": "mmol/L", "systolic_bp": "kPa", "absent": "kPa"}))


@query("c11_out_of_range_values", f"""
WITH {VITALS} SELECT field, id, value, round(std_value, 6) AS std_value FROM (
  SELECT 'glucose' AS field, id, glucose AS value, glucose * CAST(18.018 AS DOUBLE) AS std_value, 20 AS lo, 1000 AS hi FROM vitals
  UNION ALL SELECT 'hdl', id, hdl, hdl, 10, 200 FROM vitals
  UNION ALL SELECT 'diastolic_bp', id, diastolic_bp, diastolic_bp * 7.5, 30, 200 FROM vitals
  UNION ALL SELECT 'bmi', id, bmi, bmi, 10, 80 FROM vitals) WHERE std_value < lo OR std_value > hi""")
def _(spark, sf):
    mapping = {"glucose": "mmol/L", "hdl": "mg/dL", "diastolic_bp": "kPa", "bmi": "kg/m²"}
    return rounded(units.out_of_range(vitals(spark, sf), "id", mapping))


@query("c12_period_confidence", f"""
WITH {PANEL} SELECT entity_id, period, round(CAST(period - (SELECT min(period) FROM panel) AS DOUBLE) / (SELECT CASE WHEN max(period) = min(period) THEN 1 ELSE max(period) - min(period) END FROM panel), 6) AS diagnostic_confidence FROM panel""")
def _(spark, sf):
    return rounded(scaling.period_confidence(panel(spark, sf).select("entity_id", "period"), "period"))


@query("c13_cumulative_risk", f"""
WITH {VISITS} SELECT patient_id, year, round((age - 65) * (year - (SELECT min(year) FROM visits)) / 10, 6) AS cumulative_risk_factor FROM visits""")
def _(spark, sf):
    v = visits(spark, sf).select("patient_id", "year", "age")
    return rounded(scaling.cumulative_risk(v, "age", "year").drop("age"))


@query("c14_clamp", f"""
WITH {VITALS} SELECT id, CASE WHEN id % 6 <> 0 THEN least(greatest(bmi, 16), 40) END AS bmi, least(greatest(systolic_bp * 1.2, 90), 220) AS systolic_bp FROM vitals""")
def _(spark, sf):
    return vitals(spark, sf).select(
        "id",
        rules.clamp(F.when(F.col("id") % 6 != 0, F.col("bmi")), 16.0, 40.0).alias("bmi"),
        rules.clamp(F.col("systolic_bp") * 1.2, 90.0, 220.0).alias("systolic_bp"),
    )


@query("c15_scaled_logistic", f"""
WITH {VITALS} SELECT id, round(1 / (1 + exp(-(age / 100 - 0.5) * 4)), 6) AS p, round(least(0.95, 1 / (1 + exp(-(age / 100 - 0.5) * 4)) * 0.4 * 5), 6) AS scaled FROM vitals""")
def _(spark, sf):
    x = F.col("age") / 100
    return rounded(vitals(spark, sf).select("id", rules.logistic(x, 4.0, 0.5).alias("p"), rules.scaled_logistic(x, 4.0, 0.5, 0.4 * 5, 0.95).alias("scaled")))


@query("c16_risk_factor_share", f"""
WITH {VISITS} SELECT patient_id, year, round(CAST((age > 65)::INT + (age > 75)::INT + (age > 85)::INT + coalesce(education_level IN ('High School', 'Some College'), false)::INT
  + (bmi > 30)::INT + (systolic_bp > 140)::INT + (glucose > 126)::INT + (cholesterol_total > 240)::INT + (sex = 'F')::INT AS DOUBLE) / 9, 6) AS risk_share FROM visits""")
def _(spark, sf):
    return rounded(visits(spark, sf).select("patient_id", "year", rules.share_true(rules.risk_factor_conditions()).alias("risk_share")))


@query("c17_ids_and_names", f"""
WITH {PANEL} SELECT entity_id, period, printf('P%06d', entity_id) AS patient_id, CAST(regexp_extract('year=' || period, '^year=(\\d{{4}})$', 1) AS INTEGER) AS year,
  concat_ws(' | ', seg, 'logistic_regression+boosted_trees', n_orders || 'feat', 'seed_42') AS run_name FROM panel""")
def _(spark, sf):
    p = panel(spark, sf)
    return p.select(
        "entity_id",
        "period",
        identity.padded_id(F.col("entity_id")).alias("patient_id"),
        identity.year_of_folder(F.concat(F.lit("year="), F.col("period").cast("string"))).alias("year"),
        identity.run_name(F.col("seg"), ["logistic_regression", "boosted_trees"], F.col("n_orders"), F.lit("seed_42")).alias("run_name"),
    )


@query("c18_version_key", f"""
WITH {REGISTRY} SELECT model_name, created_at, substr(md5(printf('%s_%s_%.4f_%.4f', model_name, created_at, test_accuracy, test_f1)), 1, 8) AS version FROM registry""")
def _(spark, sf):
    key = identity.version_key(F.col("model_name"), F.col("created_at"), F.col("test_accuracy"), F.col("test_f1"))
    return registry(spark, sf).select("model_name", "created_at", key.alias("version"))


@query("c19_group_null_fill", f"""
WITH {PANEL} SELECT entity_id, period, coalesce(amt_n, 0) AS amt_n, coalesce(CASE WHEN entity_id % 4 <> 1 THEN seg END, 'unknown') AS seg FROM panel""")
def _(spark, sf):
    p = panel(spark, sf).select("entity_id", "period", "amt_n", F.when(F.col("entity_id") % 4 != 1, F.col("seg")).alias("seg"))
    return rules.fill_nulls(p, [(["amt_n"], 0.0), (["seg"], "unknown")])


@query("h4_side_by_side", f"WITH {PANEL} SELECT entity_id, period, amt, CASE WHEN seg = 'BUILDING' THEN 1 ELSE 0 END AS seg_building, CASE WHEN label = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS p1, CASE WHEN label = 1 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS p0 FROM panel")
def _(spark, sf):
    p, one = panel(spark, sf), F.col("label").cast("double")
    numeric = {c: F.col(c) for c in ("entity_id", "period", "amt")}
    return projection.side_by_side(p, numeric, {"seg_building": (F.col("seg") == "BUILDING").cast("int")}, {"p0": 1 - one, "p1": one})
