"""Flat export: filters, the ten-column long table, and its one-row summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.functions import text as X


def filter_fields(
    fields: DataFrame,
    entities: Sequence[str] | DataFrame | None = None,
    categories: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the given entities and categories; a null category matches no filter.

    A list becomes an ``IN`` filter that reaches the scan; a DataFrame with a column ``entity``
    becomes a semi join.
    """
    if isinstance(entities, DataFrame):
        fields = fields.join(entities.select("entity"), "entity", "left_semi")
    elif entities:
        fields = fields.filter(F.col("entity").isin(list(entities)))
    if categories:
        fields = fields.filter(F.col("category").isin(list(categories)))
    return fields


def export_rows(leaves: DataFrame, with_year: bool = False) -> DataFrame:
    """The long table, from ``value_rows`` (raw text) or ``leaf_rows`` (refined table)."""
    name = F.col("entity_name") if "entity_name" in leaves.columns else F.col("entity")
    columns = [
        name.alias("Entity"),
        F.col("entity").alias("Entity Slug"),
        F.col("name").alias("Field Name"),
        F.col("database_id").alias("Database ID"),
        F.coalesce("category", F.lit("Unknown")).alias("Category"),
        F.col("structure_type").alias("Structure Type"),
        F.when(F.col("structure_type") == X.SIMPLE, "-").otherwise(F.col("key")).alias("Key"),
        F.col("value").alias("Value"),
        F.col("order").alias("Order"),
        F.coalesce("has_ranking", F.lit(False)).alias("Has Ranking"),
    ]
    if with_year:
        columns.append(F.col("year").alias("Year"))
    return leaves.select(*columns)


def leaf_count(refined: DataFrame) -> DataFrame:
    """Add ``n_leaves``: how many export rows a refined field gives."""
    first = F.get("values", F.lit(0))
    n = F.when(
        F.col("structure_type") == X.KEY_WITH_SUB_VALUES, F.coalesce(F.size(first["sub_values"]), F.lit(0))
    ).otherwise(F.size("values"))
    return refined.withColumn("n_leaves", n)


def export_summary(
    refined: DataFrame,
    snapshot_date: str | None = None,
    entities: Sequence[str] = (),
    categories: Sequence[str] = (),
) -> DataFrame:
    """One row of totals over the filtered refined fields, those without a value included.

    Rows are counted from array sizes; nothing is exploded for it.
    """
    per_entity = (
        leaf_count(refined)
        .groupBy("entity")
        .agg(F.count(F.lit(1)).alias("fields"), F.sum("n_leaves").alias("rows"))
    )
    totals = per_entity.agg(
        F.count(F.lit(1)).alias("total_entities"),
        F.coalesce(F.sum("fields"), F.lit(0)).alias("total_fields"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
    )
    return totals.select(
        F.lit(snapshot_date or "N/A").alias("snapshot_date"),
        "*",
        F.lit(", ".join(entities) or "All entities").alias("entities_filter"),
        F.lit(", ".join(categories) or "All categories").alias("categories_filter"),
    )
