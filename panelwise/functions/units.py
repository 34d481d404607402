"""Clinical units: conversion, standardisation and range checks as Column arithmetic."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwise.operators.skew import col

# --- fixed values: field -> (standard unit, {unit: factor to the standard unit}, lowest, highest) -----------------
UNITS: dict[str, tuple[str, dict[str, float], float, float]] = {
    "glucose": ("mg/dL", {"mmol/L": 18.018}, 20.0, 1000.0),
    "total_cholesterol": ("mg/dL", {"mmol/L": 38.67}, 50.0, 1000.0),
    "hdl_cholesterol": ("mg/dL", {"mmol/L": 38.67}, 10.0, 200.0),
    "ldl_cholesterol": ("mg/dL", {"mmol/L": 38.67}, 10.0, 500.0),
    "systolic_bp": ("mmHg", {"kPa": 7.5}, 50.0, 300.0),
    "diastolic_bp": ("mmHg", {"kPa": 7.5}, 30.0, 200.0),
    "height": ("cm", {"inches": 2.54, "m": 100.0}, 50.0, 250.0),
    "weight": ("kg", {"lbs": 0.453592}, 10.0, 300.0),
    "bmi": ("kg/m²", {}, 10.0, 80.0),
    "age": ("years", {"months": 1 / 12}, 0.0, 150.0),
}
#: Panel column -> unit-table field, where the two are named differently.
PANEL_FIELDS = {"cholesterol_total": "total_cholesterol", "hdl": "hdl_cholesterol", "ldl": "ldl_cholesterol"}
# ----------------------------------------------------------------------------------------------------------------


def factor(field: str, unit: str) -> float | None:
    """Factor to the standard unit, None if the unit is the standard one; unknown names raise ValueError."""
    if field not in UNITS:
        raise ValueError(f"unknown field {field!r}, known: {sorted(UNITS)}")
    standard, factors, _, _ = UNITS[field]
    if unit == standard:
        return None
    if unit not in factors:
        raise ValueError(f"unknown unit {unit!r} for {field!r}, known: {[standard, *factors]}")
    return factors[unit]


def convert(value: Column, field: str, from_unit: str, to_unit: str) -> Column:
    """Value of ``field`` in ``to_unit``: multiply into the standard unit, divide out of it."""
    into, out_of = factor(field, from_unit), factor(field, to_unit)
    if into is not None:
        value = value * into
    return value if out_of is None else value / out_of


def _used(df: DataFrame, units: Mapping[str, str], fields: Mapping[str, str]) -> list[tuple[str, str, str]]:
    """(column, field, unit) of the mapped columns that the frame has and the unit table knows."""
    found = [(c, fields.get(c, c), unit) for c, unit in units.items() if c in df.columns]
    return [entry for entry in found if entry[1] in UNITS]


def standardize(df: DataFrame, units: Mapping[str, str], fields: Mapping[str, str] = PANEL_FIELDS) -> DataFrame:
    """Every column named in ``units`` turned to its standard unit in one projection; nulls stay."""
    return df.withColumns({c: convert(col(c), f, unit, UNITS[f][0]) for c, f, unit in _used(df, units, fields)})


def out_of_range(df: DataFrame, key: str, units: Mapping[str, str], fields: Mapping[str, str] = PANEL_FIELDS) -> DataFrame:
    """Rows (field, key, value, std_value), one per value that leaves its field's range in the standard unit."""
    cells = [
        F.struct(
            F.lit(c).alias("field"),
            col(c).cast("double").alias("value"),
            convert(col(c).cast("double"), f, unit, UNITS[f][0]).alias("std_value"),
            F.lit(UNITS[f][2]).alias("lo"),
            F.lit(UNITS[f][3]).alias("hi"),
        )
        for c, f, unit in _used(df, units, fields)
    ]
    bad = F.filter(F.array(*cells), lambda x: (x["std_value"] < x["lo"]) | (x["std_value"] > x["hi"]))
    return df.select(col(key), F.inline(bad)).select("field", col(key), "value", "std_value")


def unit_table(df: DataFrame) -> DataFrame:
    """The unit table as rows (field, unit, factor_to_standard, min_value, max_value)."""
    rows = []
    for field, (standard, factors, lo, hi) in UNITS.items():
        rows += [(field, unit, f, lo, hi) for unit, f in {standard: 1.0, **factors}.items()]
    return df.sparkSession.createDataFrame(
        rows, "field string, unit string, factor_to_standard double, min_value double, max_value double"
    )


def convert_rows(df: DataFrame, value: str, field: str, unit: str) -> DataFrame:
    """Long rows that carry field and unit as columns: adds ``std_value``, null where the pair is unknown.

    The unit table is fixed (about twenty rows), so its broadcast cannot grow with the data.
    """
    table = unit_table(df).select(F.col("field").alias("_field"), F.col("unit").alias("_unit"), "factor_to_standard")
    joined = df.join(F.broadcast(table), (col(field) == F.col("_field")) & (col(unit) == F.col("_unit")), "left")
    return joined.select(*[col(c) for c in df.columns], (col(value) * F.col("factor_to_standard")).alias("std_value"))
