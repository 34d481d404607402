"""Column selection, renaming and alignment to a model's feature list."""
from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from panelwise.operators.skew import col

# --- fixed values -----------------------------------------------------------------------------------------------
NOT_FEATURES = ("patient_id", "year", "alzheimers_diagnosis")
REQUEST_NAMES = {
    "bp_sys": "systolic_bp",
    "bp_dia": "diastolic_bp",
    "visits_count": "num_encounters",
    "meds_count": "num_medications",
    "labs_count": "num_lab_tests",
}
# ----------------------------------------------------------------------------------------------------------------


def exclude(df: DataFrame, columns: Collection[str] = NOT_FEATURES) -> DataFrame:
    """All columns but the named ones; names the frame lacks are ignored."""
    return df.select(*[col(c) for c in df.columns if c not in columns])


def numeric_and_categorical(df: DataFrame) -> tuple[list[str], list[str]]:
    """Column names by type, each list in frame order."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return numeric, [c for c in df.columns if c not in numeric]


def feature_gap(df: DataFrame, features: Sequence[str]) -> tuple[list[str], list[str]]:
    """(features the frame has, features it lacks), in feature order."""
    return [f for f in features if f in df.columns], [f for f in features if f not in df.columns]


def default_by_name(feature: str, columns: Collection[str]) -> Column:
    """Value of a missing feature, guessed from its name; the first matching rule wins.

    A rule that stands for a source column takes it if the frame has it and a constant otherwise.
    """

    def source(name: str, constant: float) -> Column:
        return col(name).cast("double") if name in columns else F.lit(constant)

    # fixed values
    pressure = ("systolic_bp", 120.0) if "systolic" in feature else ("diastolic_bp", 80.0)
    rules = (
        (("age", "year"), ("age", 65.0)),
        (("bmi",), ("bmi", 25.0)),
        (("bp", "blood"), pressure),
        (("glucose",), ("glucose", 100.0)),
    )
    for parts, default in rules:
        if any(part in feature for part in parts):
            return source(*default)
    return F.lit(0.0)


def align(df: DataFrame, features: Sequence[str], keep: Sequence[str] = (), default: float | None = None) -> DataFrame:
    """Exactly ``keep`` + ``features`` in that order: extra columns dropped, missing ones added.

    A missing feature takes ``default``, or ``default_by_name`` where that is None.
    """

    def filled(name: str) -> Column:
        if name in df.columns:
            return col(name)
        value = default_by_name(name, df.columns) if default is None else F.lit(default)
        return value.alias(name)

    return df.select(*[col(c) for c in keep], *[filled(f) for f in features])


def rename(df: DataFrame, mapping: Mapping[str, str] = REQUEST_NAMES) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in mapping.items() if old in df.columns})


def side_by_side(df: DataFrame, *blocks: Mapping[str, Column]) -> DataFrame:
    """Blocks of columns of the same rows next to each other: one projection, never matched by position."""
    return df.select(*[c.alias(name) for block in blocks for name, c in block.items()])


def preview(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in the given order."""
    return df.orderBy(*[col(c) for c in order]).limit(n)
