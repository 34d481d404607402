"""Ids, run names and version keys as Column expressions."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def padded_id(number: Column, prefix: str = "P", width: int = 6) -> Column:
    """``P000042``; numbers wider than ``width`` keep all their digits."""
    return F.format_string(f"{prefix}%0{width}d", number)


def year_of_folder(path: Column) -> Column:
    """The year of a folder name ``year=YYYY``, null for any other name."""
    found = F.regexp_extract(path, r"^year=(\d{4})$", 1)
    return F.when(found != "", found.cast("int"))


def run_name(description: Column, models: Sequence[str], features: Column, suffix: Column) -> Column:
    """``description | a+b | Nfeat | suffix``."""
    return F.concat_ws(" | ", description, F.lit("+".join(models)), F.concat(features.cast("string"), F.lit("feat")), suffix)


def version_key(name: Column, created_at: Column, accuracy: Column, f1: Column) -> Column:
    """First 8 hex digits of the MD5 of name, timestamp and the two metrics at four decimals."""
    return F.substring(F.md5(F.format_string("%s_%s_%.4f_%.4f", name, created_at, accuracy, f1)), 1, 8)
