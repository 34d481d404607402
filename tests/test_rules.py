import pytest
from pyspark.sql import functions as F

from panelwise.functions import identity, rules, units, validation
from panelwise.functions.frames import map_frames
from panelwise.operators import projection
from tests.conftest import rows, same_rows


def frame(spark, column, values):
    return spark.createDataFrame([(v,) for v in values], f"{column} double")


def test_band_edges(spark):
    out = rows(rules.band_flags(frame(spark, "bmi", [18.4, 18.5, 25.0, 30.0, None]), rules.CLINICAL_BANDS[:4]))
    flags = [[r[b.out] for b in rules.CLINICAL_BANDS[:4]] for r in out]
    assert flags == [[1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1], [0, 0, 0, 0]]


@pytest.mark.parametrize(
    "flag,column,values,want",
    [
        ("high_systolic", "systolic_bp", [139.9, 140.0], [0, 1]),
        ("prediabetic", "glucose", [99.9, 100.0, 125.9, 126.0], [0, 1, 1, 0]),
        ("high_glucose", "glucose", [125.9, 126.0], [0, 1]),
        ("low_hdl", "hdl", [39.9, 40.0], [1, 0]),
        ("middle_aged", "age", [44.9, 45.0, 64.9, 65.0], [0, 1, 1, 0]),
        ("elderly", "age", [64.9, 65.0], [0, 1]),
    ],
)
def test_more_band_edges(spark, flag, column, values, want):
    band = next(b for b in rules.CLINICAL_BANDS if b.out == flag)
    assert [r[flag] for r in rows(rules.band_flags(frame(spark, column, values), [band]))] == want


def test_nan_is_null_before_rules(spark):
    df = rules.nan_to_null(frame(spark, "bmi", [float("nan"), 31.0]))
    assert [r["obese"] for r in rows(rules.band_flags(df, [rules.CLINICAL_BANDS[3]]))] == [0, 1]


def test_right_closed_bins(spark):
    df = frame(spark, "bmi", [0.0, 18.5, 18.6, 30.0, 100.0, 100.1])
    out = df.select(rules.right_closed_bins("bmi", *rules.BMI_BINS).alias("b"))
    assert [r["b"] for r in rows(out)] == [None, "underweight", "normal", "overweight", "obese", None]


def test_age_groups(spark):
    df = frame(spark, "age", [49.9, 50.0, 65.0, 80.0, None])
    out = df.select(rules.left_closed_group("age", *rules.AGE_GROUPS).alias("g"))
    assert [r["g"] for r in rows(out)] == ["young", "middle", "senior", "elderly", None]


def test_tiers_are_inclusive_and_verdict_is_strict(spark):
    out = rows(frame(spark, "p", [0.8, 0.79, 0.5, 0.2, 0.1]).select(*[c.alias(n) for n, c in rules.score_report("p").items()]))
    assert [r["risk_level"] for r in out] == ["Very High", "High", "Moderate", "Low", "Very Low"]
    assert [r["confidence"] for r in out] == ["High", "Moderate", "Low", "High", "Very High"]
    assert [r["prediction"] for r in out] == ["High Risk", "High Risk", "Low Risk", "Low Risk", "Low Risk"]


def test_additive_score_is_strict(spark):
    df = spark.createDataFrame([(65.0, 30.0, 140.0, 100.0), (66.0, 31.0, 141.0, 101.0)], "age double, bmi double, systolic_bp double, glucose double")
    assert [round(r["s"], 6) for r in rows(df.select(rules.weighted_score().alias("s")))] == [0.0, 0.6]


def test_clamp_keeps_null(spark):
    assert [r["c"] for r in rows(frame(spark, "x", [None, 1.0, 9.0]).select(rules.clamp(F.col("x"), 2.0, 5.0).alias("c")))] == [None, 2.0, 5.0]


def test_fill_missing_columns_leaves_present_ones(spark):
    df = spark.createDataFrame([(100.0, 50.0, 1.0)], "ldl double, hdl double, platelets double")
    r = rows(rules.fill_missing_columns(df, rules.lab_defaults()))[0]
    assert (r["cholesterol_total"], r["triglycerides"], r["platelets"]) == (190.0, 150.0, 1.0)


def test_ids(spark):
    df = spark.createDataFrame([(42, "year=2021"), (1234567, "2021")], "n int, f string")
    out = rows(df.select(identity.padded_id(F.col("n")).alias("id"), identity.year_of_folder(F.col("f")).alias("y")))
    assert [(r["id"], r["y"]) for r in out] == [("P000042", 2021), ("P1234567", None)]


def test_version_key(spark):
    import hashlib

    df = spark.createDataFrame([("m", "2024-01-01T00:00:00", 0.9, 0.85)], "m string, t string, a double, f double")
    want = hashlib.md5(b"m_2024-01-01T00:00:00_0.9000_0.8500").hexdigest()[:8]
    assert rows(df.select(identity.version_key(F.col("m"), F.col("t"), F.col("a"), F.col("f")).alias("v")))[0]["v"] == want


# --- units ------------------------------------------------------------------------------------------------------------


def test_unit_errors():
    for field, unit in (("glucose", "stone"), ("shoe", "cm")):
        with pytest.raises(ValueError):
            units.factor(field, unit)
    assert units.factor("glucose", "mg/dL") is None


def test_unit_conversion_between_units(spark):
    out = rows(frame(spark, "h", [2.0]).select(units.convert(F.col("h"), "height", "m", "inches").alias("x")))
    assert round(out[0]["x"], 6) == round(200 / 2.54, 6)


def test_out_of_range_skips_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, 19.0), (3, 20.0), (4, 1001.0)], "id int, glucose double")
    out = rows(units.out_of_range(df, "id", {"glucose": "mg/dL"}), "id")
    assert [(r["field"], r["id"]) for r in out] == [("glucose", 2), ("glucose", 4)]


# --- validation -------------------------------------------------------------------------------------------------------

# Every value on the lower or upper bound of its range.
GOOD = {r.field: r.lo if k % 2 or r.hi is None else r.hi for k, r in enumerate(validation.REQUEST_RANGES)}
GOOD = {k: int(v) if k.startswith("num_") else float(v) for k, v in GOOD.items()}


def requests(spark, *changes):
    data = [tuple(None if {**GOOD, **c}[k] is None else str({**GOOD, **c}[k]) for k in GOOD) for c in changes]
    return spark.createDataFrame(data, ", ".join(f"{k} string" for k in GOOD))


def test_requests(spark):
    df = requests(spark, {}, {"age": "old"}, {"age": None}, {"age": 120.0}, {"age": 120.1}, {"num_encounters": 2.5}, {"temperature": 98.6, "hdl": "nan"})
    got = [r["violations"] for r in rows(validation.check(df))]
    assert got == [[], ["age:type"], ["age:missing"], [], ["age:range"], ["num_encounters:type"], ["temperature:range", "hdl:type"]]
    valid, rejected = validation.split_valid(df)
    assert (valid.count(), rejected.count()) == (2, 5)
    assert dict(valid.dtypes)["age"] == "double" and dict(valid.dtypes)["num_encounters"] == "int"


def test_missing_columns_and_no_requests(spark):
    df = requests(spark, {}).drop("age", "platelets")
    assert rows(validation.check(df))[0]["violations"] == ["age:missing", "platelets:missing"]
    assert rows(validation.check(df, required=False))[0]["violations"] == []
    valid, rejected = validation.split_valid(requests(spark, {}).limit(0))
    assert valid.count() == 0 and rejected.count() == 0


# --- projection -------------------------------------------------------------------------------------------------------


def test_column_types(spark):
    df = spark.createDataFrame([], "a int, b float, c string, d double, e boolean, f bigint")
    assert projection.numeric_and_categorical(df) == (["a", "b", "d", "f"], ["c", "e"])
    assert projection.exclude(df, ("a", "zz")).columns == ["b", "c", "d", "e", "f"]
    assert projection.feature_gap(df, ["f", "x", "a"]) == (["f", "a"], ["x"])


def test_defaults_by_name(spark):
    df = spark.createDataFrame([(70.0, 28.0, 150.0)], "age double, bmi double, systolic_bp double")
    wanted = ["age", "age_x", "bmi_delta_1y", "systolic_bp_std", "bp_y", "blood_z", "glucose_q", "hdl_std", "other col"]
    r = rows(projection.align(df, wanted))[0]
    assert list(r) == wanted
    assert list(r.values()) == [70.0, 70.0, 28.0, 150.0, 80.0, 80.0, 100.0, 0.0, 0.0]


def test_map_frames_is_independent_of_batches(spark):
    df = spark.range(100)

    def double(frame, by):
        frame["x"] = frame["id"] * by
        return frame

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert same_rows(map_frames(df, double, "id bigint, x bigint", by=2), df.withColumn("x", F.col("id") * 2))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_chunks_have_the_asked_size(spark):
    df = spark.range(100, numPartitions=3)

    def sizes(frame):
        frame["n"] = len(frame)
        return frame

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "9")
    try:
        for size, largest in ((1, {1}), (4, {4}), (1000, {33, 34})):
            out = map_frames(df, sizes, "id bigint, n bigint", size).collect()
            assert sorted(r["id"] for r in out) == list(range(100)) and {r["n"] for r in out} >= largest and max(r["n"] for r in out) <= size
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    with pytest.raises(ValueError):
        map_frames(df, sizes, "id bigint, n bigint", 0)
