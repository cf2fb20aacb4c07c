"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def last_value_by(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Per key, the value with the greatest ``order`` (numeric); ties go to the greater value.

    Rows collapse to one per (keys, value) first.  That step keeps only a number in its buffer, so
    it is a hash aggregate with a map-side part, and a key with very many rows costs no task more
    than its distinct values.
    """
    distinct = df.groupBy(*keys, value).agg(F.max(order).alias("_order"))
    return distinct.groupBy(*keys).agg(
        F.max_by(value, F.struct(F.col("_order"), F.col(value))).alias(value)
    )
