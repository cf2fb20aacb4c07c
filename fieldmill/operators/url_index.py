"""Index of entity URLs: one row per entity with a column per page type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.functions import urls as U


def entity_urls(
    urls: DataFrame, base_url: str, prefix: str, section: str = "countries"
) -> DataFrame:
    """``slug, type, url, pos`` of the entity pages in ``urls`` (columns ``url, pos``).

    ``url`` becomes the address of the page document.  Other addresses and deeper paths go.
    """
    parts = F.struct(
        U.slug_and_type(U.url_path(F.col("url")), prefix, section).alias("p"),
        U.page_data_url(F.col("url"), base_url, prefix).alias("url"),
    )
    # Later filters on slug or type would be pushed into the projection and repeat its patterns; a
    # one-element generator keeps them above it.
    return (
        urls.filter(U.is_entity_url(F.col("url"), prefix, section))
        .select("pos", F.explode(F.array(parts)).alias("_u"))
        .select("_u.p.slug", "_u.p.type", "_u.url", "pos")
        .filter(F.col("slug").isNotNull())
    )


def _collapsed(pages: DataFrame) -> DataFrame:
    """One row per (slug, type, url); every type without an own column counts as ``other``."""
    kind = F.when(F.col("type").isin(list(U.INDEXED_TYPES)), F.col("type")).otherwise("other")
    return pages.groupBy("slug", kind.alias("type"), "url").agg(
        F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos")
    )


def url_index(pages: DataFrame) -> DataFrame:
    """One row per slug: the last URL of each indexed type and the number of other URLs."""
    rows = _collapsed(pages)

    def last(kind: str):
        own = F.col("type") == kind
        return F.max_by(F.when(own, F.col("url")), F.when(own, F.col("last_pos"))).alias(kind)

    return rows.groupBy("slug").agg(
        *[last(kind) for kind in U.INDEXED_TYPES],
        F.count_if(F.col("type") == "other").alias("other_count"),
    )


def other_urls(pages: DataFrame) -> DataFrame:
    """The distinct other URLs of each slug as rows, with the position each was first seen at."""
    return (
        _collapsed(pages)
        .filter(F.col("type") == "other")
        .select("slug", "url", F.col("first_pos").alias("pos"))
    )


def url_type_counts(index: DataFrame) -> DataFrame:
    """One row: entities per page type, other URLs, and totals (``main`` counts once always)."""
    n = F.count(F.lit(1))
    typed = {kind: F.count(kind) for kind in U.INDEXED_TYPES}
    other = F.coalesce(F.sum("other_count"), F.lit(0))
    extra = sum((typed[k] for k in U.INDEXED_TYPES if k != "main"), F.lit(0))
    return index.agg(
        n.alias("total_entities"),
        (n + extra + other).alias("total_urls"),
        *[count.alias(kind) for kind, count in typed.items()],
        other.alias("other"),
    )
