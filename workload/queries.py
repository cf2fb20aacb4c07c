"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmill.functions import dates as D
from fieldmill.functions import markup as K
from fieldmill.functions import text as X
from fieldmill.functions import urls as U
from fieldmill.functions import years as Y
from fieldmill.operators import catalog as C
from fieldmill.operators import diff as S
from fieldmill.operators import enrich as E
from fieldmill.operators import export as O
from fieldmill.operators import pages as P
from fieldmill.operators import profile as M
from fieldmill.operators import quality as Q
from fieldmill.operators import refine as R
from fieldmill.operators import runs as L
from fieldmill.operators import url_index as I
from fieldmill.plans import runs
from fieldmill.schemas import EXPORT_COLUMNS
from fieldmill.sinks.tables import (
    replace_entities,
    write_entities,
    write_export,
    write_in_order,
    write_url_index,
)
from fieldmill.sources import mapping as CM
from fieldmill.sources.documents import read_documents
from fieldmill.sources.export import read_export
from fieldmill.sources.index import filter_index, read_index
from fieldmill.sources.sitemap import sitemap_quarantine as quarantined_sitemaps
from fieldmill.sources.sitemap import sitemap_urls
from fieldmill.sources.snapshots import latest_snapshot, read_in_order, read_snapshot
from workload.files import scratch
from workload.inputs import DATE_TEXT, URL_BASE, URL_PREFIX, derived, spread, table, tasks_for

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _refined(spark, sf_dir) -> DataFrame:
    return R.refine_fields(derived(spark, sf_dir, "fields"))


def _counted(spark, sf_dir) -> DataFrame:
    """Refined fields for queries that only count values."""
    return R.refine_fields(derived(spark, sf_dir, "fields"), years=False)


def _text_fields(spark, sf_dir) -> DataFrame:
    """Documents as fields: every line of the text is one value."""
    return spread(table(spark, sf_dir, "documents"), "documents").select(
        "doc_id", F.replace("text", F.lit("\n"), F.lit("<br>")).alias("data")
    )


# ---- splitting and structure -------------------------------------------------------------------


@query
def values_by_year(spark, sf_dir):
    """Flagship: refine every field and count its values by structure type and year."""
    rows = R.value_rows(derived(spark, sf_dir, "fields"))
    return rows.groupBy("structure_type", "year").agg(
        F.count(F.lit(1)).alias("n_values"), F.count("key").alias("n_keyed")
    )


@query
def split_documents(spark, sf_dir):
    return _text_fields(spark, sf_dir).select(
        "doc_id", F.posexplode(X.split_values(F.col("data"))).alias("ord", "value")
    )


@query
def split_pages(spark, sf_dir):
    return spread(table(spark, sf_dir, "pages"), "pages").select(
        "page_id", F.posexplode(X.split_values(F.col("html"))).alias("ord", "value")
    )


@query
def has_breaks(spark, sf_dir):
    fields = derived(spark, sf_dir, "fields")
    return fields.groupBy("name").agg(
        F.count_if(X.has_breaks(F.col("data"))).alias("with_breaks"),
        F.count(F.lit(1)).alias("n"),
    )


@query
def structure_types(spark, sf_dir):
    return _refined(spark, sf_dir).select(
        "entity",
        "pos",
        "structure_type",
        "is_multi_valued",
        F.size("values").cast("bigint").alias("n_values"),
    )


@query
def value_rows(spark, sf_dir):
    rows = R.value_rows(derived(spark, sf_dir, "fields"))
    return rows.select("entity", "pos", "structure_type", "key", "value", "order", "year")


def _leaves_of(spark, sf_dir, kind):
    # the nested form, exploded again: the oracle checks both forms
    leaves = R.leaf_rows(_refined(spark, sf_dir)).filter(F.col("structure_type") == kind)
    return leaves.select("entity", "pos", "key", "value", "order", "year")


@query
def simple_values(spark, sf_dir):
    return _leaves_of(spark, sf_dir, X.SIMPLE).drop("key")


@query
def kv_pairs(spark, sf_dir):
    return _leaves_of(spark, sf_dir, X.KEY_VALUE_PAIRS)


@query
def kv_notes(spark, sf_dir):
    return _leaves_of(spark, sf_dir, X.KEY_VALUE_PAIRS_WITH_NOTES)


@query
def sub_values(spark, sf_dir):
    return _leaves_of(spark, sf_dir, X.KEY_WITH_SUB_VALUES)


def _nested(spark, sf_dir, name):
    rows = R.value_rows(derived(spark, sf_dir, name))
    return rows.select("entity", "pos", "key", "value", "order", "year")


@query
def kv_nested(spark, sf_dir):
    return _nested(spark, sf_dir, "nested_pairs")


@query
def kv_notes_nested(spark, sf_dir):
    return _nested(spark, sf_dir, "nested_notes")


@query
def sub_nested(spark, sf_dir):
    return _nested(spark, sf_dir, "nested_sub")


@query
def text_cleanup(spark, sf_dir):
    text = F.concat(F.lit("  "), F.replace("text", F.lit(" "), F.lit(" \t ")), F.lit(":: \n"))
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        X.strip(text).alias("stripped"),
        X.strip_colons(text).alias("no_colons"),
        X.collapse_whitespace(text).alias("collapsed"),
    )


@query
def entity_decoding(spark, sf_dir):
    return spread(table(spark, sf_dir, "pages"), "pages").select(
        "page_id", X.decode_entities(F.col("html")).alias("html")
    )


@query
def entity_decoding_full(spark, sf_dir):
    return derived(spark, sf_dir, "encoded_texts").select(
        "doc_id", K.decode_references(F.col("encoded")).alias("text")
    )


# ---- years and dates -----------------------------------------------------------------------------


@query
def year_extract(spark, sf_dir):
    data = F.col("data")
    return derived(spark, sf_dir, "fields").select(
        "entity",
        "pos",
        Y.year_tag(data, max_years=None).alias("first_year"),
        Y.is_data_point(data).alias("is_data_point"),
        Y.year_tag(data).alias("year"),
        Y.year_tag(data, max_length=60, max_years=2).alias("year_of_two"),
    )


@query
def date_normalize(spark, sf_dir):
    dated = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderdate", f"{DATE_TEXT} AS date_text"
    )
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    return dated.select(
        "o_orderkey",
        D.normalize_date(F.col("date_text")).alias("updated"),
        D.normalize_date(iso).alias("iso_as_year"),
        D.normalize_date(iso, iso_first=True).alias("iso_kept"),
    )


# ---- enrichment ----------------------------------------------------------------------------------


def _enriched(spark, sf_dir):
    return E.enrich_fields(derived(spark, sf_dir, "fields"), derived(spark, sf_dir, "mapping"))


@query
def category_enrich(spark, sf_dir):
    return _enriched(spark, sf_dir).select("entity", "pos", "database_id", "category")


@query
def category_enrich_shuffled(spark, sf_dir):
    joined = E.enrich_fields(
        derived(spark, sf_dir, "fields").hint("merge"), derived(spark, sf_dir, "mapping")
    )
    return joined.select("entity", "pos", "database_id", "category")


@query
def category_enrich_repeated(spark, sf_dir):
    """Ids that the mapping has twice do not multiply fields."""
    once = derived(spark, sf_dir, "mapping")
    twice = once.union(once.select("database_id", F.concat(F.lit("Z"), "category")))
    joined = E.enrich_fields(derived(spark, sf_dir, "fields"), twice)
    return joined.select("entity", "pos", "database_id", "category")


@query
def enrich_stats(spark, sf_dir):
    return E.enrichment_stats(_enriched(spark, sf_dir))


@query
def enrich_summary(spark, sf_dir):
    return E.enrichment_summary(E.enrichment_stats(_enriched(spark, sf_dir)))


# ---- refined documents ---------------------------------------------------------------------------


@query
def refined_documents(spark, sf_dir):
    """Parse, refine in place, and flatten the nested documents for comparison."""
    docs = R.refine_documents(P.parse_pages(_landed(spark, sf_dir)))
    return docs.select(
        "entity", "source_file", "statistics.*", F.posexplode_outer("data.fields").alias("idx", "f")
    ).filter(F.col("idx").isNotNull()).select(
        "entity",
        "source_file",
        "total_fields",
        "multi_valued_fields",
        "single_valued_fields",
        "idx",
        F.col("f.name").alias("name"),
        F.col("f.is_multi_valued").alias("is_multi_valued"),
        F.array_join(F.col("f.values.value"), "|").alias("value_list"),
        F.get(F.col("f.values.year"), F.lit(0)).alias("first_year"),
    )


@query
def refinement_stats(spark, sf_dir):
    return R.refinement_stats(_counted(spark, sf_dir))


@query
def refinement_summary(spark, sf_dir):
    return R.refinement_summary(R.refinement_stats(_counted(spark, sf_dir)))


# ---- profiles --------------------------------------------------------------------------------------


@query
def multi_value_profile(spark, sf_dir):
    return M.multi_value_profile(_counted(spark, sf_dir))


@query
def multi_value_summary(spark, sf_dir):
    return M.multi_value_summary(M.multi_value_profile(_counted(spark, sf_dir)))


@query
def multi_value_top(spark, sf_dir):
    return M.top_multi_valued(M.multi_value_profile(_counted(spark, sf_dir)))


@query
def separator_census(spark, sf_dir):
    return M.separator_census(derived(spark, sf_dir, "fields"))


@query
def separator_census_pages(spark, sf_dir):
    return M.separator_census(spread(table(spark, sf_dir, "pages"), "pages").select(F.col("html").alias("data")))


# ---- catalog -----------------------------------------------------------------------------------------


def _catalog(spark, sf_dir):
    return C.field_catalog(derived(spark, sf_dir, "user_fields"))


@query
def field_catalog(spark, sf_dir):
    return _catalog(spark, sf_dir)


@query
def field_catalog_lines(spark, sf_dir):
    """The catalog over the larger table, where an entity has a field once at most."""
    return C.field_catalog(derived(spark, sf_dir, "fields")).drop("database_id")


@query
def field_entities(spark, sf_dir):
    return C.field_entities(derived(spark, sf_dir, "user_fields"))


@query
def category_summary(spark, sf_dir):
    return C.category_summary(_catalog(spark, sf_dir))


@query
def coverage_bands(spark, sf_dir):
    return C.coverage_bands(_catalog(spark, sf_dir))


@query
def missing_counts(spark, sf_dir):
    return C.missing_counts(_catalog(spark, sf_dir))


@query
def missing_entities(spark, sf_dir):
    return C.missing_entities(derived(spark, sf_dir, "user_fields"))


# ---- export ------------------------------------------------------------------------------------------

_EXPORT_CATEGORIES = ["category 1", "category 2", "category 3"]


def _export(rows, with_year=False):
    # plain names for the comparison; the writer keeps the header as it is
    return rows.select(*[F.col(c).alias(c.lower().replace(" ", "_")) for c in rows.columns])


@query
def export_rows(spark, sf_dir):
    leaves = R.value_rows(derived(spark, sf_dir, "fields"))
    return _export(O.export_rows(leaves, with_year=True))


@query
def export_files(spark, sf_dir):
    """The export as CSV and as Parquet files by category, read back; quotes and line feeds stay."""
    fields = derived(spark, sf_dir, "quoted_fields")
    rows = O.export_rows(R.value_rows(fields))
    summary = O.export_summary(R.refine_fields(fields.withColumn("media", F.lit(None))), "2025-01-01")
    parts = []
    for fmt in ("csv", "parquet"):
        folder = scratch(spark, f"export-{fmt}")
        write_export(rows, summary, folder, fmt)
        stored = read_export(spark, folder, fmt, ["Unknown", "part, de", "part, fr", "part, en"])
        parts.append(_export(stored.select(*EXPORT_COLUMNS)).withColumn("format", F.lit(fmt)))
    return parts[0].unionByName(parts[1])


@query
def export_filtered(spark, sf_dir):
    customers = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    wanted = customers.select(F.col("o_orderkey").cast("string").alias("entity"))
    fields = O.filter_fields(derived(spark, sf_dir, "fields"), wanted, _EXPORT_CATEGORIES)
    return _export(O.export_rows(R.value_rows(fields, years=False)))


@query
def export_refined(spark, sf_dir):
    refined = O.filter_fields(_refined(spark, sf_dir), None, _EXPORT_CATEGORIES)
    return _export(O.export_rows(R.leaf_rows(refined)))


@query
def export_summary(spark, sf_dir):
    refined = O.filter_fields(_counted(spark, sf_dir), None, _EXPORT_CATEGORIES)
    return O.export_summary(refined, "2025-01-01", (), _EXPORT_CATEGORIES)


# ---- pages -------------------------------------------------------------------------------------------


def _landed(spark, sf_dir):
    return derived(spark, sf_dir, "landed").withColumn("scraped_at", F.lit("2025-01-01"))


def _parsed(spark, sf_dir):
    return P.parse_bodies(_landed(spark, sf_dir))


@query
def json_project(spark, sf_dir):
    doc = F.try_parse_json("props")
    return table(spark, sf_dir, "events").select(
        "event_id",
        P.member(doc, "k", "bigint").alias("k"),
        P.member(doc, "k.z").alias("deep"),
        P.member_or(doc, "missing", F.lit("default")).alias("missing"),
    )


@query
def page_kinds(spark, sf_dir):
    landed = derived(spark, sf_dir, "landed").select(
        "entity", F.try_parse_json("body").alias("doc")
    )
    return landed.select(
        "entity", P.is_valid_page(F.col("doc")).alias("is_valid"), P.page_kind(F.col("doc")).alias("kind")
    )


@query
def page_metadata(spark, sf_dir):
    return P.page_metadata(_parsed(spark, sf_dir))


@query
def page_assets(spark, sf_dir):
    assets = P.page_assets(_parsed(spark, sf_dir))
    return assets.select(
        "entity",
        F.col("flag.url").alias("flag_url"),
        F.col("flag.width").cast("bigint").alias("flag_width"),
        F.col("map").isNull().alias("no_map"),
        F.col("locator_map").isNull().alias("no_locator_map"),
        F.size("images").cast("bigint").alias("n_images"),
        F.array_join(F.col("images.alt_text"), "|").alias("alt_texts"),
        L.asset_count(F.struct("flag", "map", "locator_map", "images")).cast("bigint").alias("n_assets"),
    )


@query
def page_fields(spark, sf_dir):
    fields = P.page_fields(_parsed(spark, sf_dir))
    return fields.select(
        "entity",
        "pos",
        "name",
        "data",
        "database_id",
        F.array_join("subfields", "|").alias("subfields"),
        "has_ranking",
        F.size("media").cast("bigint").alias("n_media"),
        F.array_join(F.col("media.url"), "|").alias("media_urls"),
    )


@query
def page_quarantine(spark, sf_dir):
    return P.quarantine(_parsed(spark, sf_dir))


@query
def raw_documents(spark, sf_dir):
    docs = P.parse_pages(_landed(spark, sf_dir))
    return docs.select(
        "entity",
        "scraped_at",
        "scrape_success",
        F.col("data.metadata.name").alias("name"),
        F.col("data.metadata.error").alias("error"),
        F.col("data.metadata.field_count").cast("bigint").alias("field_count"),
        F.size("data.fields").cast("bigint").alias("n_fields"),
    )


@query
def document_files(spark, sf_dir):
    """Documents as lines of JSON files, some cut short, read back with the broken ones told apart."""
    folder = scratch(spark, "documents")
    docs = P.parse_pages(_landed(spark, sf_dir)).filter("scrape_success")
    line = F.to_json(F.struct(*docs.columns))
    number = F.substring("entity", 2, 20).cast("bigint")
    cut_short = F.when(number % 13 == 1, F.substring(line, 1, 40)).otherwise(line)
    docs.select(cut_short.alias("value")).write.option("compression", "gzip").text(f"{folder}/part.json")
    read = read_documents(spark, f"{folder}/part.json", multi_line=False, name_filter="part-*")
    return read.select(
        F.coalesce("entity", F.regexp_extract("_corrupt_record", '"entity":"([^"]*)', 1)).alias("entity"),
        F.col("_corrupt_record").isNotNull().alias("is_broken"),
        "is_valid",
        F.when(F.col("is_valid"), F.size("data.fields")).cast("bigint").alias("n_fields"),
    )


def _landing(spark, sf_dir) -> str:
    root = scratch(spark, "landing")
    runs.land_snapshot(spark, _landed(spark, sf_dir), root, "2025-01-01")
    return root


@query
def landing_run(spark, sf_dir):
    """A whole landing run, and what its two tables hold afterwards."""
    root = _landing(spark, sf_dir)
    raw = read_snapshot(spark, f"{root}/raw", "latest").select(
        "entity", F.lit("raw").alias("stored_in"), F.size("data.fields").cast("bigint").alias("n_fields")
    )
    broken = read_snapshot(spark, f"{root}/quarantine", "2025-01-01").select(
        "entity", F.lit("quarantine").alias("stored_in"), F.lit(None).cast("bigint").alias("n_fields")
    )
    return raw.unionByName(broken)


@query
def landing_report(spark, sf_dir):
    """The stored report of the same run."""
    report = spark.read.json(f"{_landing(spark, sf_dir)}/reports/2025-01-01/metadata")
    return report.select("snapshot_date", "total_entities", "successful", "failed", "total_fields")


@query
def exploded_fields(spark, sf_dir):
    fields = R.explode_fields(P.parse_pages(_landed(spark, sf_dir)))
    return fields.select("entity", "entity_name", "pos", "name", "data", "database_id")


# ---- URLs --------------------------------------------------------------------------------------------


@query
def url_filter(spark, sf_dir):
    urls = derived(spark, sf_dir, "site_urls")
    return urls.filter(U.is_entity_url(F.col("url"), URL_PREFIX))


@query
def url_parse(spark, sf_dir):
    urls = derived(spark, sf_dir, "site_urls")
    parts = U.slug_and_type(U.url_path(F.col("url")), URL_PREFIX)
    return urls.select("pos", parts.alias("p")).select("pos", "p.slug", "p.type")


@query
def url_paths(spark, sf_dir):
    return spread(table(spark, sf_dir, "pages"), "pages").select(
        "page_id",
        U.url_path(F.col("url")).alias("path"),
        U.page_data_url(F.col("url"), URL_BASE, "/en").alias("page_data_url"),
    )


def _entity_urls(spark, sf_dir):
    return I.entity_urls(derived(spark, sf_dir, "site_urls"), URL_BASE, URL_PREFIX)


@query
def url_index(spark, sf_dir):
    return I.url_index(_entity_urls(spark, sf_dir))


@query
def url_other(spark, sf_dir):
    return I.other_urls(_entity_urls(spark, sf_dir))


@query
def url_types(spark, sf_dir):
    return I.url_type_counts(I.url_index(_entity_urls(spark, sf_dir)))


@query
def sitemap_scan(spark, sf_dir):
    return sitemap_urls(derived(spark, sf_dir, "sitemaps")).select("doc_no", "url", "pos")


@query
def sitemap_mixed(spark, sf_dir):
    return sitemap_urls(derived(spark, sf_dir, "mixed_sitemaps"))


@query
def sitemap_quarantine(spark, sf_dir):
    broken = quarantined_sitemaps(derived(spark, sf_dir, "mixed_sitemaps"))
    return broken.select("doc_no", "error")


@query
def index_order(spark, sf_dir):
    """The stored index in its order: the number that a slug's row has, file after file."""
    folder = scratch(spark, "index")
    write_in_order(I.url_index(_entity_urls(spark, sf_dir)), folder, "slug")
    return read_in_order(spark, folder).select("slug", "other_count", "place")


@query
def index_files(spark, sf_dir):
    """The stored URL index, written and read back as a later step reads it."""
    folder = scratch(spark, "url-index")
    write_url_index(_entity_urls(spark, sf_dir), folder, "sitemap.xml")
    return read_index(spark, folder)


@query
def index_load(spark, sf_dir):
    """Index rows filtered by a table of wanted slugs."""
    wanted = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 0)
    slugs = wanted.select(F.concat(F.lit("c"), F.col("c_custkey")).alias("slug"))
    rows = filter_index(I.url_index(_entity_urls(spark, sf_dir)), slugs)
    return rows.select("slug", "main", "flag", F.col("other_count").alias("n_other"))


# ---- mapping -----------------------------------------------------------------------------------------


@query
def mapping_load(spark, sf_dir):
    docs = derived(spark, sf_dir, "mapping_all").select(
        F.create_map("database_id", "category").alias("mapping")
    )
    return CM.mapping_rows(docs)


@query
def mapping_extract(spark, sf_dir):
    return CM.extract_mapping(derived(spark, sf_dir, "category_pages"))


@query
def mapping_fallback(spark, sf_dir):
    pages = CM.preferred_pages(derived(spark, sf_dir, "category_pages"))
    return pages.select("page_no", "priority")


# ---- snapshots ---------------------------------------------------------------------------------------


@query
def snapshot_latest(spark, sf_dir):
    return latest_snapshot(derived(spark, sf_dir, "order_snapshots"))


def _sides(spark, sf_dir):
    """Two states of the values of every line: as shipped, and with some lines changed.

    Fields are dealt by entity and name, so the slots of a field meet before it is turned into values.
    """
    fields = derived(spark, sf_dir, "fields", by=("{entity}", "CAST({pos} AS STRING)"))
    rows = R.value_rows(fields, years=False)
    keyed = rows.select("entity", F.col("pos").cast("string").alias("name"), "key", "order", "value")
    old = keyed.filter("NOT (key = 'price')  OR key IS NULL OR name NOT LIKE '%7'")
    new = keyed.filter("NOT (key = 'quantity') OR key IS NULL OR name NOT LIKE '%3'").withColumn(
        "value",
        F.when(F.col("name").like("%5"), F.upper("value"))
        .when(F.col("name").like("%1") & F.col("key").isNull(), F.lit(None))
        .otherwise(F.col("value")),
    )
    return old, new


def _diff(spark, sf_dir):
    # both sides lie in the same parts, which grow with the table: no value row is moved
    return S.snapshot_diff(*_sides(spark, sf_dir))


@query
def snapshot_diff(spark, sf_dir):
    return _diff(spark, sf_dir)


@query
def snapshot_diff_summary(spark, sf_dir):
    return S.diff_summary(_diff(spark, sf_dir))


@query
def snapshot_diff_fields(spark, sf_dir):
    """Two snapshots with few changes: contents are compared by hashes before any value is."""
    sides = [derived(spark, sf_dir, name) for name in ("earlier_fields", "later_fields")]
    tasks = tasks_for(table(spark, sf_dir, "lineitem"))
    return S.field_diff(*sides, lambda fields: R.value_rows(fields, years=False), ("data",), tasks=tasks)


@query
def snapshot_dated(spark, sf_dir):
    """Monthly partitions written as files, two of them read: an asked date and the newest."""
    orders, folder = derived(spark, sf_dir, "order_snapshots"), scratch(spark, "snapshots")
    orders.hint("rebalance", "snapshot_date").write.partitionBy("snapshot_date").parquet(folder)
    asked = read_snapshot(spark, folder, "1995-03-01").withColumn("asked", F.lit("1995-03-01"))
    newest = latest_snapshot(spark.read.parquet(folder)).withColumn("asked", F.lit("latest"))
    return asked.unionByName(newest)


@query
def snapshot_replace(spark, sf_dir):
    """One entity of a stored snapshot refined anew, and the whole snapshot read back."""
    table, date = scratch(spark, "refined"), "2025-01-01"
    stored = derived(spark, sf_dir, "fields").select("entity", "pos", "category")
    write_entities(stored, table, date)
    chosen = ["1", "2", "none"]
    again = stored.filter(F.col("entity") == "1").withColumn("category", F.lit("new"))
    replace_entities(again, table, date, chosen)
    return read_snapshot(spark, table, date).drop("snapshot_date")


# ---- quality and runs --------------------------------------------------------------------------------


@query
def quality_rules(spark, sf_dir):
    """Rules over refined fields, some of them spoiled first."""
    spoiled = _counted(spark, sf_dir).select(
        F.when(F.col("pos") % 11 != 0, F.col("entity")).alias("entity"),
        "pos",
        F.when(F.col("pos") % 13 != 0, F.col("structure_type")).otherwise("odd").alias("structure_type"),
        (F.col("is_multi_valued") | (F.col("pos") % 17 == 0)).alias("is_multi_valued"),
        F.when(F.col("pos") % 19 != 0, F.col("values")).alias("values"),
    )
    return Q.violation_counts(Q.with_violations(spoiled))


@query
def raw_validation(spark, sf_dir):
    docs = P.parse_pages(_landed(spark, sf_dir))
    fields = F.transform(
        F.col("data.fields"),
        lambda f: F.struct(F.when(f["database_id"] != "3", f["name"]).alias("name")),
    )
    checked = docs.select("entity", F.when(F.col("scrape_success"), fields).alias("fields"))
    return checked.select("entity", Q.is_valid_raw(F.col("fields")).alias("is_valid"))


def _log(spark, sf_dir):
    fetches = derived(spark, sf_dir, "fetches")
    outcome = L.fetch_outcome(
        F.col("source_url"),
        F.col("body_ok"),
        F.col("parsed_ok"),
        F.col("exception_kind") == "timeout",
    )
    return fetches.withColumn("outcome", outcome).select(
        "slug",
        (F.col("outcome") == "success").alias("success"),
        F.lit("2025-01-01").alias("scraped_at"),
        "source_url",
        F.lit(1.5).alias("duration_seconds"),
        F.when(F.col("outcome") != "success", F.col("outcome")).alias("error"),
        F.when(~F.col("body_ok"), L.error_class(F.col("http_status"), F.col("exception_kind"))).alias(
            "error_details"
        ),
        "n_fields",
        "n_assets",
    )


@query
def fetch_errors(spark, sf_dir):
    fetches = derived(spark, sf_dir, "fetches")
    return fetches.select(
        "slug", L.error_class(F.col("http_status"), F.col("exception_kind")).alias("error_class")
    )


@query
def fetch_outcomes(spark, sf_dir):
    return _log(spark, sf_dir).select("slug", "success", "error")


@query
def scrape_log(spark, sf_dir):
    return L.log_entries(_log(spark, sf_dir))


@query
def run_metadata(spark, sf_dir):
    return L.run_metadata(_log(spark, sf_dir))


@query
def failure_counts(spark, sf_dir):
    return L.failure_counts(_log(spark, sf_dir))


@query
def failed_entities(spark, sf_dir):
    return L.failed_entities(_log(spark, sf_dir))


@query
def first_failures(spark, sf_dir):
    return L.first_failures(_log(spark, sf_dir))
