"""Sitemaps: URL sets and sitemap indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmill.functions.binding import let

_ROW = "loc string"
_BAD = "_corrupt_record"
_DOCUMENT = f"url array<struct<{_ROW.replace(' ', ':')}>>, sitemap array<struct<{_ROW.replace(' ', ':')}>>, {_BAD} string"
# the name of the root element, behind declarations, comments and white space
_ROOT = r"(?s)^\s*(?:<[?!].*?>\s*)*<([A-Za-z][\w.:-]*)"
#: each document gets its own range of positions, so order within one is kept
_POSITIONS_PER_FILE = 1 << 33


def parse_sitemaps(docs: DataFrame) -> DataFrame:
    """``doc_no, xml, urls, error`` of sitemap documents ``doc_no, xml``, each parsed once.

    ``error`` is null, ``empty``, ``unreadable`` (broken XML) or ``not a sitemap``; a document with an error
    has no URLs and never stops the others.
    """
    root = F.regexp_extract("xml", _ROOT, 1)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    parsed = F.struct(F.from_xml("xml", _DOCUMENT, options).alias("x"), root.alias("root"))

    def read(p: Column) -> Column:
        error = (
            F.when(p["x"].isNull() | (p["x"][_BAD] == ""), "empty")
            .when(p["x"][_BAD].isNotNull(), "unreadable")
            .when(~p["root"].isin("urlset", "sitemapindex"), "not a sitemap")
        )
        listed = F.when(p["root"] == "sitemapindex", p["x"]["sitemap"]).otherwise(p["x"]["url"])
        found = F.filter(F.transform(listed, lambda u: u["loc"]), lambda u: u.isNotNull())
        urls = F.coalesce(F.when(error.isNull(), found), F.array().cast("array<string>"))
        return F.struct(urls.alias("urls"), error.alias("error"))

    return docs.select("doc_no", "xml", let(parsed, read).alias("_read")).select("doc_no", "xml", "_read.*")


def sitemap_urls(docs: DataFrame) -> DataFrame:
    """``doc_no, url, pos`` of the documents that ``parse_sitemaps`` can read.

    ``pos`` orders the URLs: documents by ``doc_no``, then place within the document.  An index's
    child sitemaps are listed, not followed: once landed they are documents like any other.
    """
    return parse_sitemaps(docs).select("doc_no", F.posexplode("urls").alias("_at", "url")).select(
        "doc_no",
        "url",
        (F.col("doc_no") * F.lit(_POSITIONS_PER_FILE) + F.col("_at")).alias("pos"),
    )


def sitemap_quarantine(docs: DataFrame) -> DataFrame:
    """``doc_no, error, xml`` of the documents that ``parse_sitemaps`` can't read."""
    return parse_sitemaps(docs).filter(F.col("error").isNotNull()).select("doc_no", "error", "xml")


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    """``url, pos`` of sitemap files, read element by element, for files of any size.

    ``pos`` is (file, start of the input split, number within the task): it follows file names and
    places in a file however files are split and packed.
    """
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )

    def elements(tag: str) -> DataFrame:
        return (
            spark.read.format("xml")
            .schema(_ROW)
            .option("rowTag", tag)
            .load(path)
            .select(F.col("loc").alias("url"), place.alias("pos"))
        )

    return elements("url").unionByName(elements("sitemap")).filter(F.col("url").isNotNull())
