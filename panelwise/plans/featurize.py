"""Raw panel to feature table."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from panelwise.functions.rules import CLINICAL_BANDS, band_flags, nan_to_null, risk_score
from panelwise.operators.encoding import fill_unknown, one_hot
from panelwise.operators.panel import NUMERIC_COLUMNS, feature_names, panel_features, zero_fill_features
from panelwise.sources.files import read_panel, write_years


def featurize(
    df: DataFrame,
    entity: str = "patient_id",
    period: str = "year",
    columns: Sequence[str] = NUMERIC_COLUMNS,
    rolling_columns: Sequence[str] = (),
    lags: Sequence[int] = (),
    categorical: Sequence[str] = (),
    max_categories: int | None = None,
    windows: bool = False,
) -> DataFrame:
    """Entity statistics, optional rolling and change features, band flags, risk score, optional dummies; nulls of
    features filled with 0, of categoricals with "unknown"."""
    clean = nan_to_null(df)
    wide = panel_features(clean, entity, period, columns, rolling_columns=rolling_columns, lags=lags, windows=windows)
    bands = [b for b in CLINICAL_BANDS if b.column in clean.columns]
    wide = band_flags(wide, bands).withColumn("risk_score", risk_score(bands))
    if categorical:
        wide = fill_unknown(one_hot(wide, categorical, max_categories, fit_on=clean), categorical)
    return zero_fill_features(wide, feature_names(columns, rolling_columns=rolling_columns, lags=lags))


def run_featurize(spark: SparkSession, source: str, target: str, **kw) -> None:
    """Read the panel, featurize it and write it by year."""
    write_years(featurize(read_panel(spark, source), **kw), target)
