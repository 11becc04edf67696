"""Null and NaN rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankframe.spec import MISSING_CATEGORY


def clean_numeric(value: Column) -> Column:
    """Null and NaN become 0, the result is a 32-bit float."""
    number = value.cast("double")
    return F.coalesce(F.nanvl(number, F.lit(0.0)), F.lit(0.0)).cast("float")


def clean_category(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(MISSING_CATEGORY))


def label_target(label: Column) -> Column:
    """1 for true, 0 for false and for null."""
    return F.when(label, F.lit(1)).otherwise(F.lit(0))


def clean_target(target: Column) -> Column:
    return F.coalesce(target, F.lit(0)).cast("float")
