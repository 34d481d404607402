"""Range, type and presence checks of records."""
from __future__ import annotations

from collections.abc import Collection, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwise.operators.skew import col


class Range(NamedTuple):
    """Inclusive bounds of a field; an open side is None."""

    field: str
    lo: float | None
    hi: float | None
    whole: bool = False


# --- fixed values -----------------------------------------------------------------------------------------------
REQUEST_RANGES = (
    Range("age", 0, 120),
    Range("bmi", 10, 100),
    Range("systolic_bp", 50, 300),
    Range("diastolic_bp", 30, 200),
    Range("heart_rate", 30, 200),
    Range("temperature", 35, 42),
    Range("glucose", 20, 1000),
    Range("cholesterol_total", 50, 500),
    Range("hdl", 10, 200),
    Range("ldl", 10, 300),
    Range("triglycerides", 10, 1000),
    Range("creatinine", 0.1, 20),
    Range("hemoglobin", 5, 25),
    Range("white_blood_cells", 1, 50),
    Range("platelets", 50, 1000),
    Range("num_encounters", 0, None, whole=True),
    Range("num_medications", 0, None, whole=True),
    Range("num_lab_tests", 0, None, whole=True),
)
CLINICAL_RANGES = (
    Range("age", 0, 120),
    Range("bmi", 10, 60),
    Range("systolic_bp", 50, 300),
    Range("diastolic_bp", 30, 200),
    Range("heart_rate", 30, 200),
    Range("temperature", 90, 110),
    Range("glucose", 20, 600),
    Range("cholesterol_total", 50, 800),
    Range("hdl", 10, 150),
    Range("ldl", 20, 400),
    Range("triglycerides", 10, 1000),
    Range("creatinine", 0.1, 10),
    Range("hemoglobin", 5, 25),
    Range("white_blood_cells", 1, 50),
    Range("platelets", 10, 1000),
)
# ----------------------------------------------------------------------------------------------------------------


def outside(value: Column, rule: Range) -> Column:
    bad = F.lit(False)
    if rule.lo is not None:
        bad = bad | (value < float(rule.lo))
    if rule.hi is not None:
        bad = bad | (value > float(rule.hi))
    return bad


def violations(rules: Sequence[Range], columns: Collection[str], required: bool = True) -> Column:
    """``array<string>`` of ``field:reason``; reasons are missing, type (not a number, not whole) and range.

    With ``required=False`` a null field is no violation.
    """
    found = []
    for rule in rules:
        if rule.field not in columns:
            if required:
                found.append(F.lit(f"{rule.field}:missing"))
            continue
        raw = col(rule.field)
        value = raw.try_cast("double")
        wrong = value.isNull() | F.isnan(value)
        if rule.whole:
            wrong = wrong | (value != F.floor(value))
        check = F.when(raw.isNull(), F.lit(f"{rule.field}:missing") if required else F.lit(None).cast("string"))
        check = check.when(wrong, F.lit(f"{rule.field}:type"))
        found.append(check.when(outside(value, rule), F.lit(f"{rule.field}:range")))
    if not found:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*found))


def check(df: DataFrame, rules: Sequence[Range] = REQUEST_RANGES, required: bool = True) -> DataFrame:
    """The frame with its ``violations``."""
    return df.withColumn("violations", violations(rules, df.columns, required))


def split_valid(df: DataFrame, rules: Sequence[Range] = REQUEST_RANGES, required: bool = True) -> tuple[DataFrame, DataFrame]:
    """(valid rows typed as numbers, rejected rows with their violations)."""
    checked = check(df, rules, required)
    kinds = {r.field: "int" if r.whole else "double" for r in rules}
    valid = checked.filter(F.size("violations") == 0).select(
        *[col(c).cast("double").cast(kinds[c]).alias(c) if c in kinds else col(c) for c in df.columns]
    )
    return valid, checked.filter(F.size("violations") > 0)


def range_violation_counts(df: DataFrame, rules: Sequence[Range] = CLINICAL_RANGES) -> DataFrame:
    """Rows (field, checked, violations), one per ruled column of the frame, in one pass."""
    used = [r for r in rules if r.field in df.columns]
    sums = []
    for r in used:
        sums.append(F.count(col(r.field)).alias(f"{r.field}_n"))
        sums.append(F.count_if(outside(col(r.field).cast("double"), r)).alias(f"{r.field}_bad"))
    cells = [
        F.struct(F.lit(r.field).alias("field"), col(f"{r.field}_n").alias("checked"), col(f"{r.field}_bad").alias("violations"))
        for r in used
    ]
    return df.agg(*sums).select(F.inline(F.array(*cells)))
