"""The batch steps.  ``root`` holds one table per stage, all partitioned by snapshot date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmill.operators import catalog as C
from fieldmill.operators import enrich as E
from fieldmill.operators import export as X
from fieldmill.operators import pages as P
from fieldmill.operators import profile as M
from fieldmill.operators import refine as R
from fieldmill.operators import runs as L
from fieldmill.operators.diff import field_diff
from fieldmill.operators.url_index import entity_urls
from fieldmill.sinks import tables as S
from fieldmill.sources.mapping import extract_mapping, preferred_pages
from fieldmill.sources.sitemap import read_sitemap
from fieldmill.sources.snapshots import find_snapshot, read_snapshot, resolve_snapshot


def discover_entities(
    spark: SparkSession,
    sitemap_path: str,
    output: str,
    base_url: str,
    prefix: str,
    section: str = "countries",
) -> None:
    """Sitemap files to the stored URL index."""
    pages = entity_urls(read_sitemap(spark, sitemap_path), base_url, prefix, section)
    S.write_url_index(pages, output, sitemap_path)


def discover_mapping(pages: DataFrame, output: str) -> None:
    """Category pages ``priority, page_no, body`` to the stored mapping, one row per id."""
    mapping = E.require_mapping(extract_mapping(preferred_pages(pages)))
    mapping.write.mode("overwrite").parquet(output)


def land_snapshot(
    spark: SparkSession, pages: DataFrame, root: str, snapshot: str | None = None
) -> str:
    """Parse landed pages into the ``raw`` table and write the run's log and metadata."""
    date, started = S.run_date(snapshot), dt.datetime.now(dt.timezone.utc)
    S.write_outcomes(P.landed_rows(pages), root, "outcome", (P.RAW, P.QUARANTINE), date)
    log = run_log(
        spark,
        find_snapshot(spark, f"{root}/raw", date),
        find_snapshot(spark, f"{root}/quarantine", date),
    )
    S.write_snapshot(L.log_entries(log), f"{root}/scrape_log", date)
    ended = dt.datetime.now(dt.timezone.utc)
    metadata = L.run_metadata(log).select(
        F.lit(date).alias("snapshot_date"),
        F.lit(started).alias("started_at"),
        F.lit(ended).alias("ended_at"),
        F.lit((ended - started).total_seconds()).alias("duration_seconds"),
        "*",
    )
    S.write_report(metadata, f"{root}/reports/{date}/metadata")
    S.write_report(L.failed_entities(log), f"{root}/reports/{date}/failed_entities")
    return date


LOG = (
    "slug string, success boolean, scraped_at string, source_url string, duration_seconds double,"
    " error string, error_details string, n_fields int, n_assets int"
)


def run_log(
    spark: SparkSession, raw: DataFrame | None, failed: DataFrame | None = None
) -> DataFrame:
    """The log of a landing run: one row per entity, landed or quarantined; either may be missing."""
    log = spark.createDataFrame([], LOG)
    nothing = lambda kind: F.lit(None).cast(kind)
    if raw is not None:
        landed = raw.select(
            F.col("entity").alias("slug"),
            F.lit(True).alias("success"),
            F.col("scraped_at"),
            "source_url",
            nothing("double").alias("duration_seconds"),
            nothing("string").alias("error"),
            nothing("string").alias("error_details"),
            F.size("data.fields").alias("n_fields"),
            L.asset_count(F.col("data.assets")).alias("n_assets"),
        )
        log = log.unionByName(landed)
    if failed is not None:
        lost = failed.select(
            F.col("entity").alias("slug"),
            F.lit(False).alias("success"),
            nothing("string").alias("scraped_at"),
            "source_url",
            nothing("double").alias("duration_seconds"),
            F.lit("parse_failed").alias("error"),
            F.col("error").alias("error_details"),
            nothing("int").alias("n_fields"),
            nothing("int").alias("n_assets"),
        )
        log = log.unionByName(lost)
    return log


def _store(rows: DataFrame, table: str, date: str, entities: Sequence[str] | None) -> None:
    """``rows`` as the snapshot, or in place of the chosen entities' rows if there is one already."""
    if entities and find_snapshot(rows.sparkSession, table, date) is not None:
        S.replace_entities(rows, table, date, entities)
    else:
        S.write_entities(rows, table, date)


def refine_snapshot(
    spark: SparkSession,
    root: str,
    mapping: DataFrame,
    snapshot: str | None = None,
    entities: Sequence[str] | None = None,
    steps: Sequence[str] = ("categories", "multi-value"),
) -> str:
    """``raw`` to ``enriched`` to ``refined``, with the statistics and profile reports.

    With ``entities`` only these are done anew; the snapshots keep what they hold of the others, and
    the reports cover all.
    """
    date = resolve_snapshot(spark, f"{root}/raw", snapshot)
    reports = f"{root}/reports/{date}"
    if "categories" in steps:
        raw = R.explode_fields(read_snapshot(spark, f"{root}/raw", date, entities))
        enriched = E.enrich_fields(raw, E.require_mapping(mapping))
        _store(enriched, f"{root}/enriched", date, entities)
        stats = E.enrichment_stats(read_snapshot(spark, f"{root}/enriched", date))
        S.write_report(E.enrichment_summary(stats), f"{reports}/category_report")
    if "multi-value" in steps:
        enriched = read_snapshot(spark, f"{root}/enriched", date)
        chosen = read_snapshot(spark, f"{root}/enriched", date, entities).drop("snapshot_date")
        _store(R.refine_fields(chosen), f"{root}/refined", date, entities)
        refined = read_snapshot(spark, f"{root}/refined", date)
        profile = M.multi_value_profile(refined)
        S.write_report(profile, f"{reports}/multi_value_by_field")
        stored = spark.read.schema(profile.schema).json(f"{reports}/multi_value_by_field")
        S.write_report(M.multi_value_summary(stored), f"{reports}/multi_value_summary")
        S.write_report(M.top_multi_valued(stored), f"{reports}/multi_value_top")
        S.write_report(M.separator_census(enriched), f"{reports}/separators")
        S.write_report(
            R.refinement_summary(R.refinement_stats(refined)), f"{reports}/refinement_summary"
        )
    return date


def catalog_snapshot(spark: SparkSession, root: str, snapshot: str | None = None) -> str:
    """Field catalog, category summary and coverage bands of an enriched snapshot."""
    date = resolve_snapshot(spark, f"{root}/enriched", snapshot)
    enriched = read_snapshot(spark, f"{root}/enriched", date)
    reports = f"{root}/reports/{date}"
    catalog = C.field_catalog(enriched)
    S.write_report(catalog, f"{reports}/field_catalog")
    stored = spark.read.schema(catalog.schema).json(f"{reports}/field_catalog")
    S.write_report(C.category_summary(stored), f"{reports}/catalog_categories")
    S.write_report(C.coverage_bands(stored), f"{reports}/coverage_bands")
    S.write_report(C.missing_counts(stored), f"{reports}/missing_counts")
    return date


def export_snapshot(
    spark: SparkSession,
    root: str,
    output: str,
    snapshot: str | None = None,
    entities: Sequence[str] | None = None,
    categories: Sequence[str] | None = None,
    with_year: bool = False,
    fmt: str = "parquet",
) -> str:
    """The long table of a refined snapshot; filters that leave nothing are an error."""
    date = resolve_snapshot(spark, f"{root}/refined", snapshot)
    refined = X.filter_fields(
        read_snapshot(spark, f"{root}/refined", date), entities, categories
    )
    if refined.isEmpty():
        raise ValueError("the filters leave no field to export")
    rows = X.export_rows(R.leaf_rows(refined), with_year)
    summary = X.export_summary(refined, date, entities or (), categories or ())
    S.write_export(rows, summary, output, fmt)
    return date


def compare_snapshots(spark: SparkSession, root: str, old: str, new: str) -> DataFrame:
    """Changes of the values of two refined snapshots; only fields that changed are shuffled."""
    sides = [read_snapshot(spark, f"{root}/refined", d) for d in (old, new)]
    return field_diff(*sides, R.leaf_rows, ("structure_type", "values"))
