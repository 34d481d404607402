"""Declarative column rules: band flags, bins, weighted scores, tiers and small scalar expressions.

Every function returns Columns or a frame with Columns added in one projection; nothing here shuffles. The clinical
tables at the top are defaults, any other table of the same shape can be passed.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwise.operators.skew import col


class Band(NamedTuple):
    """Flag ``out`` is 1 where lo <= column < hi; an open side is None."""

    out: str
    column: str
    lo: float | None = None
    hi: float | None = None


class Weighted(NamedTuple):
    """Adds ``weight`` where ``column`` compares to ``cut`` by ``op`` (one of > >= < <=)."""

    column: str
    op: str
    cut: float
    weight: float


# --- fixed values -----------------------------------------------------------------------------------------------
CLINICAL_BANDS = (
    Band("underweight", "bmi", hi=18.5),
    Band("normal_weight", "bmi", 18.5, 25.0),
    Band("overweight", "bmi", 25.0, 30.0),
    Band("obese", "bmi", 30.0),
    Band("high_systolic", "systolic_bp", 140.0),
    Band("high_diastolic", "diastolic_bp", 90.0),
    Band("high_glucose", "glucose", 126.0),
    Band("prediabetic", "glucose", 100.0, 126.0),
    Band("high_cholesterol", "cholesterol_total", 240.0),
    Band("low_hdl", "hdl", hi=40.0),
    Band("high_ldl", "ldl", 160.0),
    Band("elderly", "age", 65.0),
    Band("middle_aged", "age", 45.0, 65.0),
)
RISK_SCORE_FLAGS = ("obese", "high_systolic", "high_glucose", "elderly")
BMI_BINS = ((0.0, 18.5, 25.0, 30.0, 100.0), ("underweight", "normal", "overweight", "obese"))
AGE_BINS = ((0.0, 50.0, 65.0, 80.0, 100.0), ("young", "middle", "senior", "elderly"))
AGE_GROUPS = ((50.0, 65.0, 80.0), ("young", "middle", "senior", "elderly"))
FALLBACK_SCORE = (
    Weighted("age", ">", 65.0, 0.3),
    Weighted("bmi", ">", 30.0, 0.1),
    Weighted("systolic_bp", ">", 140.0, 0.1),
    Weighted("glucose", ">", 100.0, 0.1),
)
RISK_TIERS = ((0.8, "Very High"), (0.6, "High"), (0.4, "Moderate"), (0.2, "Low"))
RISK_TIER_ELSE = "Very Low"
CONFIDENCE_TIERS = ((0.9, "Very High"), (0.8, "High"), (0.7, "Moderate"))
CONFIDENCE_ELSE = "Low"
LOW_EDUCATION = ("High School", "Some College")
# ----------------------------------------------------------------------------------------------------------------


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes null in every floating column. NaN orders above all numbers, so rules must not see it."""
    floating = {name for name, kind in df.dtypes if kind in ("double", "float")}
    return df.select(*[F.when(~F.isnan(col(c)), col(c)).alias(c) if c in floating else col(c) for c in df.columns])


def in_band(band: Band) -> Column:
    """1 inside the band, 0 outside or null."""
    value, inside = col(band.column), F.lit(True)
    if band.lo is not None:
        inside = inside & (value >= band.lo)
    if band.hi is not None:
        inside = inside & (value < band.hi)
    return F.when(inside, 1).otherwise(0)


def band_flags(df: DataFrame, bands: Sequence[Band] = CLINICAL_BANDS) -> DataFrame:
    return df.withColumns({b.out: in_band(b) for b in bands})


def risk_score(bands: Sequence[Band] = CLINICAL_BANDS, flags: Sequence[str] = RISK_SCORE_FLAGS) -> Column:
    """How many of the named flags are set."""
    total = F.lit(0)
    for band in bands:
        if band.out in flags:
            total = total + in_band(band)
    return total


def right_closed_bins(column: str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the bin (edge, next edge] that holds the value; null outside all bins."""
    value, out = col(column), None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        hit = (value > lo) & (value <= hi)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def left_closed_group(column: str, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """First label whose cut exceeds the value, the last label beyond all cuts, null for null."""
    value = col(column)
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for cut, label in zip(cuts, labels):
        out = out.when(value < cut, label)
    return out.otherwise(labels[-1])


def group_indicators(column: str, prefix: str, cuts: Sequence[float], labels: Sequence[str]) -> dict[str, Column]:
    """``prefix_label`` 0/1 columns of ``left_closed_group``."""
    group = left_closed_group(column, cuts, labels)
    return {f"{prefix}_{label}": F.coalesce((group == label).cast("int"), F.lit(0)) for label in labels}


def _compare(column: str, op: str, cut: float) -> Column:
    value = col(column)
    return {">": value > cut, ">=": value >= cut, "<": value < cut, "<=": value <= cut}[op]


def weighted_score(rules: Sequence[Weighted] = FALLBACK_SCORE) -> Column:
    """Sum of the weights of the rules that hold, in rule order; a null comparison adds nothing."""
    total = F.lit(0.0)
    for rule in rules:
        total = total + F.when(_compare(rule.column, rule.op, rule.cut), rule.weight).otherwise(0.0)
    return total


def tier(value: Column, cuts: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first cut the value reaches (inclusive); cuts run downwards."""
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for cut, label in cuts:
        out = out.when(value >= cut, label)
    return out.otherwise(otherwise)


def score_report(score: str) -> dict[str, Column]:
    """Risk level, confidence, verdict and the probability rounded to four digits."""
    p = col(score)
    return {
        "risk_level": tier(p, RISK_TIERS, RISK_TIER_ELSE),
        "confidence": tier(F.greatest(p, 1 - p), CONFIDENCE_TIERS, CONFIDENCE_ELSE),
        "prediction": F.when(p > 0.5, "High Risk").otherwise("Low Risk"),
        "probability": F.round(p, 4),
    }


def at_threshold(score: str, threshold: float) -> Column:
    """1 or 0; a score that is no number has no label."""
    return F.when(~F.isnan(col(score).cast("double")), (col(score) >= threshold).cast("int"))


def fill_missing_columns(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Add each column that is absent, computed by its expression; columns that are there stay as they are."""
    return df.withColumns({name: expr for name, expr in defaults.items() if name not in df.columns})


def lab_defaults() -> dict[str, Column]:
    """Stand-ins for lab values a request does not carry."""
    # fixed values
    return {
        "cholesterol_total": F.col("ldl") + F.col("hdl") + 40.0,
        "triglycerides": F.lit(150.0),
        "white_blood_cells": F.lit(7.0),
        "platelets": F.lit(250.0),
    }


def fill_nulls(df: DataFrame, groups: Sequence[tuple[Sequence[str], object]]) -> DataFrame:
    """Constant null fill per column group."""
    return df.na.fill({c: value for columns, value in groups for c in columns})


def clamp(value: Column, lo: float, hi: float) -> Column:
    """Value limited to [lo, hi]; null stays null (greatest and least would skip it)."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(lo)), F.lit(hi)))


def logistic(value: Column, steepness: float, center: float) -> Column:
    return 1.0 / (1.0 + F.exp(-(value - center) * steepness))


def scaled_logistic(value: Column, steepness: float, center: float, scale: float, cap: float) -> Column:
    """Logistic curve times ``scale``, at most ``cap``; null stays null."""
    return F.when(value.isNotNull(), F.least(F.lit(cap), logistic(value, steepness, center) * scale))


def share_true(conditions: Sequence[Column]) -> Column:
    """Fraction of the conditions that hold; null counts as not."""
    total = F.lit(0)
    for condition in conditions:
        total = total + F.coalesce(condition.cast("int"), F.lit(0))
    return total / F.lit(float(len(conditions)))


def risk_factor_conditions() -> list[Column]:
    """The nine risk factors whose share is the base risk."""
    # fixed values
    return [
        F.col("age") > 65,
        F.col("age") > 75,
        F.col("age") > 85,
        F.col("education_level").isin(*LOW_EDUCATION),
        F.col("bmi") > 30,
        F.col("systolic_bp") > 140,
        F.col("glucose") > 126,
        F.col("cholesterol_total") > 240,
        F.col("sex") == "F",
    ]
