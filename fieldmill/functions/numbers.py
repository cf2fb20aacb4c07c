"""Rounded shares and means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percentage(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` rounded half up to one decimal; 0 when there is no whole."""
    share = F.try_divide(F.lit(100.0).cast("double") * part.cast("double"), whole.cast("double"))
    return F.coalesce(F.round(share, 1), F.lit(0.0)).cast("double")


def mean(total: Column, count: Column) -> Column:
    """``total / count`` rounded half up to one decimal; 0 when there is nothing to count."""
    ratio = F.try_divide(total.cast("double"), count.cast("double"))
    return F.coalesce(F.round(ratio, 1), F.lit(0.0)).cast("double")
