"""Multi-value profile and separator census."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.functions.numbers import mean, percentage
from fieldmill.functions.text import BREAK


def multi_value_profile(refined: DataFrame) -> DataFrame:
    """Per field name: occurrences, multi-valued share, and the spread of the value count.

    ``typical_value_count`` is the most frequent count, the smallest one on ties.  Rows collapse to
    one per (name, count) before anything is grouped by name, so a name that holds most of the
    table costs as little as any other.
    """
    counted = refined.select(
        "name",
        F.size("values").alias("n_values"),
        F.col("is_multi_valued").cast("int").alias("multi"),
    )
    histogram = counted.groupBy("name", "n_values").agg(
        F.count(F.lit(1)).alias("n"), F.sum("multi").alias("multi")
    )
    by_name = histogram.groupBy("name").agg(
        F.sum("n").alias("entities_analyzed"),
        F.sum("multi").alias("multi_valued_count"),
        F.sum(F.col("n") * F.col("n_values")).alias("_values"),
        F.min("n_values").alias("min_value_count"),
        F.max("n_values").alias("max_value_count"),
        F.max_by("n_values", F.struct(F.col("n"), -F.col("n_values"))).alias(
            "typical_value_count"
        ),
    )
    return by_name.select(
        "name",
        "entities_analyzed",
        "multi_valued_count",
        (F.col("entities_analyzed") - F.col("multi_valued_count")).alias("single_valued_count"),
        percentage(F.col("multi_valued_count"), F.col("entities_analyzed")).alias(
            "multi_valued_percentage"
        ),
        mean(F.col("_values"), F.col("entities_analyzed")).alias("avg_value_count"),
        "min_value_count",
        "max_value_count",
        "typical_value_count",
    )


def multi_value_summary(profile: DataFrame) -> DataFrame:
    """One row over ``multi_value_profile``."""
    totals = profile.agg(
        F.coalesce(F.sum("entities_analyzed"), F.lit(0)).alias("total_fields_analyzed"),
        F.coalesce(F.sum("multi_valued_count"), F.lit(0)).alias("multi_valued_occurrences"),
        F.coalesce(F.sum("single_valued_count"), F.lit(0)).alias("single_valued_occurrences"),
    )
    return totals.withColumn(
        "multi_value_percentage",
        percentage(F.col("multi_valued_occurrences"), F.col("total_fields_analyzed")),
    )


def top_multi_valued(profile: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` fields with the greatest multi-valued share; the name decides ties."""
    return (
        profile.filter(F.col("multi_valued_count") > 0)
        .select(
            F.col("name").alias("field_name"),
            "multi_valued_percentage",
            F.col("avg_value_count").alias("avg_values"),
        )
        .orderBy(F.desc("multi_valued_percentage"), "field_name")
        .limit(n)
    )


# fixed values: the counted spellings
SEPARATORS = {
    "br": "<br>",
    "br_slash": "<br/>",
    "br_space_slash": "<br />",
    "upper_br": "<BR>",
    "upper_br_slash": "<BR/>",
    "upper_br_space_slash": "<BR />",
}


def separator_census(fields: DataFrame) -> DataFrame:
    """One row with the occurrences of each exact break spelling and of all breaks.

    One pass of one pattern over the text; the spellings are disjoint, any other one (mixed case,
    odd spacing) counts in ``other``.
    """
    tags = fields.select(F.explode(F.regexp_extract_all("data", F.lit(BREAK), F.lit(0))).alias("tag"))
    counts = tags.agg(
        *[F.count_if(F.col("tag") == tag).alias(name) for name, tag in SEPARATORS.items()],
        F.count(F.lit(1)).alias("total"),
    )
    known = sum((F.col(name) for name in SEPARATORS), F.lit(0))
    return counts.withColumn("other", F.col("total") - known)
