"""Entity URLs: path, entity filter, slug and type, address of the page document.

``prefix`` is the site's base path, for instance ``/almanac``; ``section`` the path segment that
holds the entities.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: path segments that are renamed, and the types that have their own index column
TYPE_NAMES = {
    "factsheets": "factsheet",
    "locator-map": "locator_map",
    "travel-facts": "travel_facts",
}
INDEXED_TYPES = ("main", "factsheet", "images", "flag", "map", "locator_map")
PAGE_DATA_PATTERN = "/page-data{path}/page-data.json"


def url_path(url: Column) -> Column:
    """Path of an absolute URL (query, fragment and last-segment parameters removed)."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    path = F.regexp_replace(path, ";[^/]*$", "")
    return F.when(url.startswith("http"), path).otherwise(url)


def is_entity_url(url: Column, prefix: str, section: str = "countries") -> Column:
    """True when the path is ``prefix/section/<slug>`` or anything below it."""
    pattern = f"^{re.escape(prefix)}/{re.escape(section)}/[^/]+(?:/.*)?$"
    return F.coalesce(url_path(url).rlike(pattern), F.lit(False))


def slug_and_type(path: Column, prefix: str, section: str = "countries") -> Column:
    """``struct<slug, type>``, both null when the path is deeper or elsewhere."""
    clean = F.replace(path, F.lit(prefix), F.lit("")) if prefix else path
    pattern = f"^/{re.escape(section)}/([^/]+)(?:/([^/]+))?/?$"
    slug = F.nullif(F.regexp_extract(clean, pattern, 1), F.lit(""))
    # a path without a type gets '' here, one that does not match as well
    segment = F.regexp_extract(clean, pattern, 2)
    names = F.create_map(*[F.lit(x) for pair in {"": "main", **TYPE_NAMES}.items() for x in pair])
    kind = F.coalesce(F.try_element_at(names, segment), segment)
    return F.struct(slug.alias("slug"), F.when(slug.isNotNull(), kind).alias("type"))


def page_data_url(
    url: Column, base_url: str, prefix: str, pattern: str = PAGE_DATA_PATTERN
) -> Column:
    """Address of the JSON document behind a web page."""
    path = url_path(url)
    if prefix:
        path = F.replace(path, F.lit(prefix), F.lit(""))
    path = F.rtrim(path, F.lit("/"))
    head, tail = pattern.split("{path}")
    return F.concat(F.lit(base_url + head), path, F.lit(tail))
