"""Category enrichment: a left join of field rows with the category mapping, and its statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.functions.numbers import percentage


def require_mapping(mapping: DataFrame) -> DataFrame:
    """Fail early when there is no mapping to enrich with (an action)."""
    if mapping.isEmpty():
        raise ValueError("the category mapping is empty")
    return mapping


def enrich_fields(fields: DataFrame, mapping: DataFrame) -> DataFrame:
    """Add ``category`` by ``database_id``; no match or no id gives null.

    An id that ``mapping`` has several times takes its greatest category, so fields never multiply
    (``read_mapping`` and ``extract_mapping`` have settled which one is last before).  The join
    strategy is left to AQE, which knows the size of the shuffled mapping.  Where fields are shuffled
    too, rows without an id get scattered keys that match nothing, and a hot id is split by the skew
    join, which left joins support.
    """
    fields = fields.drop("category")
    mapping = mapping.groupBy(F.col("database_id").alias("_id")).agg(
        F.max("category").alias("category")
    )
    scattered = F.concat(F.lit("\u0000"), F.xxhash64("entity", "pos").cast("string"))
    joined = fields.withColumn("_key", F.coalesce("database_id", scattered)).join(
        mapping, F.col("_key") == F.col("_id"), "left"
    )
    return joined.drop("_key", "_id")


def enrichment_stats(fields: DataFrame) -> DataFrame:
    """Per entity: fields, fields with a category, coverage in percent."""
    counts = fields.groupBy("entity").agg(
        F.count(F.lit(1)).alias("total_fields"),
        F.count_if(F.col("category") != "").alias("fields_with_categories"),
    )
    return counts.withColumn(
        "category_coverage_percentage",
        percentage(F.col("fields_with_categories"), F.col("total_fields")),
    )


def enrichment_summary(stats: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """One row over ``enrichment_stats``; ``failed`` holds the entities that could not be read."""
    summary = stats.agg(
        F.count(F.lit(1)).alias("successful_entities"),
        F.coalesce(F.sum("total_fields"), F.lit(0)).alias("total_fields_processed"),
        F.coalesce(F.sum("fields_with_categories"), F.lit(0)).alias(
            "total_fields_with_categories"
        ),
    )
    n_failed = F.lit(0).cast("bigint")
    if failed is not None:
        n_failed = failed.agg(F.count(F.lit(1))).scalar()
    return summary.withColumn("failed_entities", n_failed).select(
        (F.col("successful_entities") + F.col("failed_entities")).alias("total_entities"),
        "successful_entities",
        "failed_entities",
        "total_fields_processed",
        "total_fields_with_categories",
        percentage(
            F.col("total_fields_with_categories"), F.col("total_fields_processed")
        ).alias("category_coverage_percentage"),
    )
