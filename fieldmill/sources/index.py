"""The stored entity index: one row per slug, other URLs as rows beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmill.schemas import ENTITY_INDEX, INDEX_ROW


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Index rows as ``write_url_index`` stores them below ``path``."""
    return spark.read.schema(INDEX_ROW).json(f"{path}/entities")


def read_other_urls(spark: SparkSession, path: str) -> DataFrame:
    """``slug, url`` rows of the addresses without a column of their own, in no order."""
    return spark.read.schema("slug string, url string").json(f"{path}/other")


def index_rows(docs: DataFrame) -> DataFrame:
    """Index rows of nested index documents (column ``entities``), whose other URLs are an array."""
    urls = docs.select(F.explode("entities").alias("_e")).select("_e.slug", "_e.urls.*")
    count = F.coalesce(F.size("other"), F.lit(0)).cast("bigint")
    return urls.withColumn("other_count", F.greatest(count, F.lit(0).cast("bigint"))).drop("other")


def read_index_documents(spark: SparkSession, path: str) -> DataFrame:
    """Index rows of a nested index file, or of a directory of them."""
    return index_rows(spark.read.schema(ENTITY_INDEX).option("multiLine", True).json(path))


def filter_index(index: DataFrame, slugs: list[str] | DataFrame | None = None) -> DataFrame:
    """Entities to fetch: all, those of a list, or those of a table with a column ``slug``."""
    if slugs is None:
        return index
    if isinstance(slugs, DataFrame):
        return index.join(slugs.select("slug"), "slug", "left_semi")
    return index.filter(F.col("slug").isin(list(slugs)))
