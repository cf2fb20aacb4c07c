"""Row-wise operators on streams.

Page parsing, enrichment with a static mapping and refinement look at one row at a time, so the
batch functions accept a streaming DataFrame as they are.  Nothing here keeps state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldmill.operators.pages import page_fields, parse_bodies
from fieldmill.operators.refine import value_rows


def stream_values(spark: SparkSession, path: str) -> DataFrame:
    """Value rows of landed pages (Parquet ``entity, body``) as files arrive under ``path``."""
    pages = spark.readStream.schema("entity string, body string").parquet(path)
    return value_rows(page_fields(parse_bodies(pages)))
