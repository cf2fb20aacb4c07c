"""Field catalog: what fields exist, how many entities have them, and which lack them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.functions.numbers import mean, percentage


def field_info(fields: DataFrame) -> DataFrame:
    """The columns the catalog needs, text reduced to its length; unnamed fields are ignored."""
    return fields.filter(F.col("name") != "").select(
        "entity",
        "pos",
        "name",
        "database_id",
        "category",
        F.coalesce("has_ranking", F.lit(False)).alias("has_ranking"),
        F.coalesce(F.char_length("data"), F.lit(0)).alias("data_length"),
    )


def field_registry(fields: DataFrame) -> DataFrame:
    """One row per field name: first-seen attributes, entities, occurrences, text lengths.

    One scan in three steps: rows collapse to (name, entity, attributes) with numbers only, so the
    map side is a hash aggregate; these to (name, entity), which makes the entity count exact; these
    to the name.  Keys hold the entity until little is left, so a name held by every entity is not a
    hot key.  First seen means smallest (entity, pos).
    """
    info = field_info(fields)
    attributes = ["database_id", "category", "has_ranking"]
    lengths = [
        F.min("min_length").alias("min_length"),
        F.max("max_length").alias("max_length"),
        F.sum("_sum_length").alias("_sum_length"),
    ]
    variants = info.groupBy("name", "entity", *attributes).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("data_length").alias("min_length"),
        F.max("data_length").alias("max_length"),
        F.sum("data_length").alias("_sum_length"),
        F.min("pos").alias("pos"),
    )
    pairs = variants.groupBy("name", "entity").agg(
        F.sum("n").alias("n"),
        *lengths,
        F.min(F.struct("pos", *attributes)).alias("_first"),
    )
    registry = pairs.groupBy("name").agg(
        F.count(F.lit(1)).alias("n_entities"),
        F.sum("n").alias("n_occurrences"),
        *lengths,
        F.min_by("_first", F.struct("entity", "_first.pos")).alias("_first"),
    )
    return registry.select(
        "name",
        *(F.col(f"_first.{a}").alias(a) for a in attributes),
        "n_entities",
        "n_occurrences",
        "min_length",
        "max_length",
        mean(F.col("_sum_length"), F.col("n_occurrences")).alias("avg_length"),
    )


def field_entities(fields: DataFrame) -> DataFrame:
    """The entities that have each field, as rows."""
    return field_info(fields).select("name", "entity").distinct()


def entity_total(fields: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """One row with the number of entities: of ``entities`` if given, else of ``fields``."""
    source = fields if entities is None else entities
    return source.select("entity").distinct().agg(F.count(F.lit(1)).alias("n"))


# fixed values: band names
UNIVERSAL, COMMON, RARE = "universal", "common", "rare"


def coverage(registry: DataFrame, total: DataFrame) -> DataFrame:
    """Add ``total_entities``, ``coverage_percentage`` and ``coverage_band``.

    ``total`` is a one-row, one-column DataFrame.  Bands use the counts, not the rounded share.
    """
    n, whole = F.col("n_entities"), F.col("total_entities")
    band = F.when(n >= whole, UNIVERSAL).when(n * 2 >= whole, COMMON).otherwise(RARE)
    return (
        registry.withColumn("total_entities", total.scalar())
        .withColumn("coverage_percentage", percentage(n, whole))
        .withColumn("coverage_band", band)
    )


def field_catalog(fields: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """``field_registry`` with coverage."""
    return coverage(field_registry(fields), entity_total(fields, entities))


def category_summary(catalog: DataFrame) -> DataFrame:
    """Per category: number of fields and mean of their rounded coverage."""
    # rounded shares are multiples of 0.1, so summing them as tenths is exact in any order
    tenths = F.round(F.col("coverage_percentage") * 10).cast("bigint")
    return (
        catalog.groupBy(F.coalesce("category", F.lit("Unknown")).alias("category"))
        .agg(F.count(F.lit(1)).alias("field_count"), F.sum(tenths).alias("_tenths"))
        .select(
            "category",
            "field_count",
            mean(F.col("_tenths") / 10, F.col("field_count")).alias("avg_coverage"),
        )
    )


def coverage_bands(catalog: DataFrame) -> DataFrame:
    """One row with the number of fields per band."""
    return catalog.agg(
        *[
            F.count_if(F.col("coverage_band") == band).alias(f"{band}_fields")
            for band in (UNIVERSAL, COMMON, RARE)
        ]
    )


def missing_counts(catalog: DataFrame) -> DataFrame:
    """Per field, how many entities lack it."""
    return catalog.select(
        "name", (F.col("total_entities") - F.col("n_entities")).alias("missing_entities")
    )


#: names per bucket in ``missing_entities``
NAMES_PER_BUCKET = 1_000


def missing_entities(
    fields: DataFrame,
    entities: DataFrame | None = None,
    names_per_bucket: int = NAMES_PER_BUCKET,
) -> DataFrame:
    """The (entity, name) pairs where the entity lacks the field.

    Names are hashed into buckets of about ``names_per_bucket``.  Per entity and bucket the names
    that are present are subtracted from the bucket's names, so only the missing pairs are ever
    produced and every array stays small however many names there are.
    """
    info = field_info(fields).select("entity", "name")
    everyone = (fields if entities is None else entities).select("entity").distinct()
    names = info.select("name").distinct()
    n_buckets = names.agg(
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / names_per_bucket)).cast("int")
    )
    bucket = F.pmod(F.xxhash64("name"), n_buckets.scalar()).cast("int")
    bucket_names = names.groupBy(bucket.alias("bucket")).agg(F.collect_list("name").alias("names"))
    present = info.groupBy("entity", bucket.alias("bucket")).agg(
        F.collect_set("name").alias("present")
    )
    slots = everyone.select(
        "entity", F.explode(F.sequence(F.lit(0), n_buckets.scalar() - 1)).alias("bucket")
    )
    return (
        slots.join(present, ["entity", "bucket"], "left")
        .join(bucket_names, "bucket")
        .select(
            "entity",
            F.explode(
                F.when(F.col("present").isNull(), F.col("names")).otherwise(
                    F.array_except("names", "present")
                )
            ).alias("name"),
        )
    )
