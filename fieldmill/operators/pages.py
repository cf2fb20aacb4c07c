"""Landed page documents: validation, metadata, assets and field rows.

A body is parsed once into a VARIANT; everything else reads paths from it.  A body that is no JSON,
or JSON of another shape, gives nulls and an ``is_valid`` of false, never a failed task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmill.functions.dates import normalize_date
from fieldmill.schemas import IMAGE, IMAGES, MEDIA, RAW_FIELD

# fixed value: error text of a page that fails validation
PAGE_ERROR = "Invalid JSON structure"
# fixed values: texts of a JSON scalar or container that count as false
_FALSY = ("", "false", "null", "0", "0.0", "[]", "{}")


def member(doc: Column, path: str, kind: str = "string") -> Column:
    """Value at a dotted path such as ``result.data.name`` or ``fieldLabel[0].rank``.

    Null when any step is absent or of another shape.
    """
    return F.try_variant_get(doc, f"$.{path}", kind)


def member_or(doc: Column, path: str, default: Column, kind: str = "string") -> Column:
    """As ``member`` with a default for an absent path; a present null stays null."""
    node = F.try_variant_get(doc, f"$.{path}", "variant")
    return F.when(node.isNull(), default).otherwise(member(doc, path, kind))


def _has_key(doc: Column, path: str) -> Column:
    # a JSON null is a VARIANT value, only an absent key gives SQL null
    return F.try_variant_get(doc, f"$.{path}", "variant").isNotNull()


def is_valid_page(doc: Column) -> Column:
    """True when ``result.data`` is an object with a key ``country`` or ``fields``."""
    return _has_key(doc, "result.data.country") | _has_key(doc, "result.data.fields")


def page_kind(doc: Column) -> Column:
    """``entity``, ``category`` or ``invalid``: what a landed document holds."""

    def kind(at: str) -> Column:
        entity = _has_key(doc, f"{at}.country") | _has_key(doc, f"{at}.fields")
        return F.when(entity, "entity").when(_has_key(doc, f"{at}.allLaunchpadCategory"), "category")

    found = F.when(_has_key(doc, "result"), kind("result.data")).otherwise(kind("data"))
    return F.coalesce(found, F.lit("invalid"))


def _labels(node: Column) -> Column:
    labels = F.transform(member(node, "subfields", "array<variant>"), lambda s: member(s, "label"))
    kept = F.filter(labels, lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(kept, F.array().cast("array<string>"))


def _has_ranking(node: Column) -> Column:
    rank = member(node, "fieldLabel[0].rank")
    return F.coalesce(~rank.isin(list(_FALSY)), F.lit(False))


def _media(node: Column) -> Column:
    items = F.transform(
        member(node, "media", "array<variant>"),
        lambda m: F.struct(
            member(m, "type").alias("type"),
            member(m, "label").alias("label"),
            member(m, "altText").alias("alt_text"),
            member(m, "caption").alias("caption"),
            member(m, "localFile.publicURL").alias("url"),
        ),
    )
    kept = F.filter(items, lambda m: (m["type"] != "") & (m["url"] != ""))
    return F.coalesce(kept, F.array().cast(f"array<{MEDIA}>"))


_SHARP = "childImageSharp.gatsbyImageData"


def _image_members(doc: Column, at: str = "") -> list[Column]:
    return [
        member(doc, f"{at}{_SHARP}.images.fallback.src").alias("url"),
        member(doc, f"{at}{_SHARP}.width", "int").alias("width"),
        member(doc, f"{at}{_SHARP}.height", "int").alias("height"),
    ]


def image_asset(doc: Column, path: str) -> Column:
    """``struct<url, width, height>`` of an image node; null without a URL."""
    url, width, height = _image_members(doc, f"{path}.")
    return F.when(
        member(doc, f"{path}.{_SHARP}.images.fallback.src") != "", F.struct(url, width, height)
    ).cast(IMAGE)


def image_list(doc: Column, path: str) -> Column:
    """The images of a list that have a URL."""
    items = F.transform(
        member(doc, path, "array<variant>"),
        lambda m: F.struct(
            member(m, "altText").alias("alt_text"),
            member(m, "caption").alias("caption"),
            *_image_members(m),
        ),
    )
    kept = F.filter(items, lambda m: m["url"] != "")
    return F.coalesce(kept, F.array().cast(IMAGES))


def _is_object(node: Column) -> Column:
    # reading a member is cheap and settles nearly all nodes
    return _has_key(node, "name") | F.try_variant_get(
        node, "$", "map<string,variant>"
    ).isNotNull()


def _nodes(doc: Column) -> Column:
    return member(doc, "result.data.fields.nodes", "array<variant>")


def _field_members(node: Column) -> list[Column]:
    return [
        member(node, "name").alias("name"),
        member(node, "data").alias("data"),
        member(node, "fieldLabel[0].databaseId").alias("database_id"),
        _labels(node).alias("subfields"),
        _has_ranking(node).alias("has_ranking"),
        _media(node).alias("media"),
    ]


def parse_bodies(pages: DataFrame) -> DataFrame:
    """Add ``doc`` (VARIANT) and ``is_valid`` to pages with a ``body``."""
    doc = F.col("doc")
    return pages.withColumn("doc", F.try_parse_json("body")).withColumn(
        "is_valid", is_valid_page(doc)
    )


def _rows_where(parsed: DataFrame, condition: Column, *columns) -> DataFrame:
    """``columns`` of the rows that meet ``condition`` on the parsed document.

    A filter would be pushed down and parse every body once more; a generator of one row or none
    stays above the parse.
    """
    row = F.explode_outer(F.when(condition, F.array(F.struct(*columns)))).alias("_row")
    return parsed.select(row).filter(F.col("_row").isNotNull()).select("_row.*")


def page_metadata(parsed: DataFrame, iso_first: bool = False) -> DataFrame:
    """Name, region, update date and field count per valid page."""
    doc = F.col("doc")
    return _rows_where(
        parsed,
        F.col("is_valid"),
        "entity",
        member(doc, "result.data.country.name").alias("name"),
        member(doc, "result.data.country.region").alias("region"),
        normalize_date(member(doc, "result.data.country.updated"), iso_first).alias("updated"),
        F.coalesce(F.size(_nodes(doc)), F.lit(0)).alias("field_count"),
    )


def page_assets(parsed: DataFrame) -> DataFrame:
    """Flag, map, locator map and images per valid page."""
    doc = F.col("doc")
    return _rows_where(
        parsed,
        F.col("is_valid"),
        "entity",
        image_asset(doc, "result.data.country.flag").alias("flag"),
        image_asset(doc, "result.data.country.map").alias("map"),
        image_asset(doc, "result.data.country.locatorMap").alias("locator_map"),
        image_list(doc, "result.data.country.images").alias("images"),
    )


def page_fields(parsed: DataFrame) -> DataFrame:
    """One row per field node of valid pages; ``data`` stays byte for byte as it was.

    ``pos`` is the place in the node list.  A node that is no object is dropped, alone.
    """
    node = F.col("_node")
    return (
        # no filter on is_valid: pushed down, it would parse every body twice
        parsed.select(
            "entity",
            F.posexplode(F.when(F.col("is_valid"), _nodes(F.col("doc")))).alias("pos", "_node"),
        )
        .filter(_is_object(node))
        .select("entity", "pos", *_field_members(node))
    )


def quarantine(parsed: DataFrame) -> DataFrame:
    """Invalid pages with their raw body and the error."""
    return _rows_where(
        parsed,
        ~F.col("is_valid"),
        "entity",
        "source_url",
        "body",
        F.lit(PAGE_ERROR).alias("error"),
    )


#: what becomes of a landed page
RAW, QUARANTINE = "raw", "quarantine"


def parse_pages(pages: DataFrame, iso_first: bool = False) -> DataFrame:
    """Landed pages ``entity, source_url, scraped_at, body`` to nested raw documents.

    Invalid pages keep a row with ``metadata.error``, no assets and no fields.  No shuffle: the
    field array is built inside the row.
    """
    return landed_rows(pages, iso_first).drop("error", "body", "outcome")


def landed_rows(pages: DataFrame, iso_first: bool = False) -> DataFrame:
    """``parse_pages`` with ``outcome`` (raw or quarantine), and the error and body of invalid pages.

    So one parse serves both tables.
    """
    doc, ok = F.col("doc"), F.col("is_valid")
    nothing = F.lit(None).cast("string")
    metadata = F.struct(
        member(doc, "result.data.country.name").alias("name"),
        member(doc, "result.data.country.region").alias("region"),
        normalize_date(member(doc, "result.data.country.updated"), iso_first).alias("updated"),
        F.when(ok, F.coalesce(F.size(_nodes(doc)), F.lit(0))).alias("field_count"),
        F.col("scraped_at").cast("string").alias("scraped_at"),
        F.col("source_url").alias("source_url"),
        F.when(~ok, PAGE_ERROR).alias("error"),
    )
    assets = F.struct(
        image_asset(doc, "result.data.country.flag").alias("flag"),
        image_asset(doc, "result.data.country.map").alias("map"),
        image_asset(doc, "result.data.country.locatorMap").alias("locator_map"),
        image_list(doc, "result.data.country.images").alias("images"),
    )

    def raw_field(node: Column) -> Column:
        name, data, database_id, subfields, has_ranking, media = _field_members(node)
        return F.struct(
            name, data, database_id, nothing.alias("category"), subfields, has_ranking, media
        )

    raw_fields = F.transform(F.filter(_nodes(doc), _is_object), raw_field)
    empty = F.array().cast(f"array<{RAW_FIELD}>")
    return parse_bodies(pages).select(
        "entity",
        F.col("scraped_at").cast("string").alias("scraped_at"),
        "source_url",
        ok.alias("scrape_success"),
        F.struct(
            metadata.alias("metadata"),
            assets.alias("assets"),
            F.coalesce(F.when(ok, raw_fields), empty).alias("fields"),
        ).alias("data"),
        F.when(~ok, PAGE_ERROR).alias("error"),
        F.when(~ok, F.col("body")).alias("body"),
        F.when(ok, RAW).otherwise(QUARANTINE).alias("outcome"),
    )
