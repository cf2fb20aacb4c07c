"""Field, page, URL and log shaped inputs derived from the tables.

Each input is a projection of one table, without a shuffle, so it grows with its table and has no
hot group.  The expressions are SQL text that Spark and DuckDB both accept: the two engines start
from the same bytes, everything after that is written twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_YEAR = "CAST(year(l_shipdate) AS STRING)"
QUANTITY = (
    "CAST(CAST(l_quantity AS BIGINT) AS STRING) || ' units (' || " + _YEAR + " || "
    "CASE WHEN l_returnflag = 'A' THEN ' est.)' ELSE ')' END"
)
PRICE = "'price  ' || CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) || ' USD'"
_DISCOUNT = (
    "CAST(CAST(round(l_discount * 100) AS BIGINT) AS STRING) || '% off (' || " + _YEAR + " || "
    "') and (' || CAST(year(l_shipdate) + 1 AS STRING) || ' est.)'"
)
_LONG = "repeat('x', 113 + l_linenumber % 2) || ' (2024)'"

_SIMPLE = (
    f"'  ' || {QUANTITY}"
    f" || CASE WHEN l_linenumber > 1 THEN '<br>' || {PRICE} ELSE '' END"
    f" || CASE WHEN l_linenumber > 3 THEN '<br /><BR/> ' || {_DISCOUNT} || '<Br >' ELSE '' END"
    f" || CASE WHEN l_linenumber > 4 THEN '<br/>' || {_LONG} ELSE '' END"
)
_PAIRS = (
    f"'lost<br><strong>quantity:</strong> ' || {QUANTITY}"
    f" || '<br><br><strong>price::</strong> ' || {PRICE} || '<br>net'"
    " || CASE WHEN l_linenumber % 3 = 0 THEN '<strong>empty:</strong><br>' ELSE '' END"
    f" || '<br><STRONG>Discount</STRONG>  ' || {_DISCOUNT} || ' <em>max</em>'"
)
_WRAPPED = (
    f"'<p><strong>quantity:</strong> ' || {QUANTITY} || '</p><p><strong>price:</strong> '"
    f" || {PRICE} || '</p><p>tail</p>'"
)
_NOTES = (
    f"'<strong>quantity:</strong> ' || {QUANTITY} || '<br><b>note:</b> rush  order<br>'"
    f" || '<strong>price:</strong> ' || {PRICE} || '<br><strong>none:</strong> '"
    f" || CASE WHEN l_linenumber > 3 THEN '<br><b>Note: </b>last<br/>' || {_YEAR} ELSE '' END"
)
_SUB = (
    "'<strong>Line ' || CAST(l_linenumber AS STRING) || ':</strong><br>' || "
    f"{QUANTITY} || '<br/> <br>' || {PRICE}"
    f" || CASE WHEN l_linenumber > 3 THEN '<br />' || {_DISCOUNT} ELSE '' END"
)

FIELDS = {
    "entity": "CAST(l_orderkey AS STRING)",
    "pos": "l_partkey * 10 + l_linenumber",
    "name": "'field ' || CAST(l_partkey % 97 AS STRING)",
    "database_id": "CASE WHEN l_linenumber <> 7 THEN CAST(l_partkey AS STRING) END",
    "category": "CASE WHEN l_partkey % 5 <> 0 THEN 'category ' || CAST(l_partkey % 13 AS STRING) END",
    "has_ranking": "l_partkey % 3 = 0",
    "data": (
        "CASE WHEN l_partkey % 101 = 0 THEN NULL"
        " WHEN l_partkey % 103 = 0 THEN '<br> <br/>'"
        f" WHEN l_orderkey % 4 = 0 THEN {_SIMPLE}"
        f" WHEN l_orderkey % 4 = 1 AND l_linenumber = 7 THEN {_WRAPPED}"
        f" WHEN l_orderkey % 4 = 1 THEN {_PAIRS}"
        f" WHEN l_orderkey % 4 = 2 THEN {_NOTES}"
        f" ELSE {_SUB} END"
    ),
}

# keyed text in wrappers of all kinds: two pairs each, told apart by the part number
NESTED_PAIRS = (
    f"'<p><strong>quantity:</strong> ' || {QUANTITY} || ' <span>a <em>b</em></span></p><p>tail</p>'"
    f" || '<p><strong>price:</strong> ' || {PRICE} || '</p>'",
    f"'<h3><strong>quantity:</strong> ' || {QUANTITY} || '</h3>tail<h3><strong>price:</strong> '"
    f" || {PRICE} || '</h3>'",
    f"'<b><strong>quantity:</strong></b> ' || {QUANTITY} || '<b><strong>price:</strong> ' || {PRICE} || '</b>'",
    f"'<section><strong>quantity:</strong> ' || {QUANTITY} || '<strong>price:</strong> ' || {PRICE}"
    " || '</section>after'",
    f"'<strong>quantity:</strong> ' || {QUANTITY} || ' <div><strong>price:</strong> ' || {PRICE} || '</div> end'",
    f"'<div><strong>quantity:</strong> ' || {QUANTITY} || ' <i>x</div><strong>price:</strong> ' || {PRICE}"
    " || '</em> y'",
    f"'<table><tr><td><strong>quantity:</strong></td><td>' || {QUANTITY} || '</td></tr><tr><td>'"
    f" || '<strong>price:</strong> ' || {PRICE} || '</td></tr></table>'",
)
NESTED_NOTES = (
    f"'<div><strong>quantity:</strong> ' || {QUANTITY} || '<br><b>note:</b> rush  order<hr>'"
    f" || '<strong>price:</strong> ' || {PRICE} || '</div> z'",
    f"'<p><strong>quantity:</strong> ' || {QUANTITY} || '</p><p><b>note:</b> low <i>stock</i></p>'"
    f" || '<p><strong>price:</strong> ' || {PRICE} || '</p>'",
    f"'<strong>quantity:</strong> ' || {QUANTITY} || ' <ul><li><b>note:</b> in list</li></ul><br>'"
    f" || '<strong>price:</strong> ' || {PRICE}",
    f"'<p><strong>quantity:</strong> ' || {QUANTITY} || ' <b>big</b> box<b>Note: </b>last</p>'"
    f" || '<p><b>note:</b> </p><p><strong>price:</strong> ' || {PRICE} || '</p>'",
)
NESTED_SUB = (
    f"'<section><strong>Line <u>' || CAST(l_linenumber AS STRING) || '</u>:</strong> ' || {QUANTITY}"
    f" || '<br/>' || {PRICE} || ' <i>x<br>y</i></section>after'",
    f"'<ul><li><strong>Line ' || CAST(l_linenumber AS STRING) || '</strong>' || {QUANTITY}"
    f" || '</p></li><li>' || {PRICE} || '</li></ul>'",
)


def _nested(texts: tuple[str, ...]) -> dict[str, str]:
    cases = "".join(f" WHEN {k} THEN {text}" for k, text in enumerate(texts))
    return {
        "entity": "CAST(l_orderkey AS STRING)",
        "pos": "l_partkey * 10 + l_linenumber",
        "data": f"CASE l_partkey % {len(texts)}{cases} END",
        "media": "CAST(NULL AS STRING)",
    }


#: texts with character references: every letter beyond ASCII by name or number, and references of references
ENCODED_TEXTS = {
    "doc_id": "doc_id",
    "encoded": (
        "replace(replace(replace(replace(replace(replace(replace(replace(replace(text, '&', '&amp;'),"
        " '<', '&lt;'), 'é', '&eacute;'), 'ü', '&#252;'), 'ß', '&#xDF;'), 'ä', '&#x000e4;'), 'ç', '&ccedil;'),"
        " ' the ', ' &#8212;the&#X1F600; '), ', ', '&nbsp;&amp;lt;&#128;&bogus; ')"
    ),
}

#: fields of users: an event type with a bucket of its property; coverage differs by bucket
USER_FIELDS = {
    "entity": "CAST(user_id AS STRING)",
    "pos": "event_id",
    "name": (
        "event_type || CASE WHEN length(props) % 2 = 0 AND event_id % 100 = 0 THEN ' c'"
        " WHEN event_id % 50 = 1 THEN ' b' WHEN event_id % 40 = 2 THEN '' ELSE ' a' END"
    ),
    "database_id": "CAST(event_id % 7 AS STRING)",
    "category": "CASE WHEN event_type <> 'error' THEN upper(event_type) END",
    "has_ranking": "value > 100",
    "data": "CASE WHEN event_id % 11 <> 0 THEN props END",
}

PAIRS_MAPPING = {
    "database_id": "CAST(p_partkey AS STRING)",
    "category": "p_type",
}
MAPPING_FILTER = "p_type <> 'PROMO'"

_MONTH = (
    "CASE month(o_orderdate) WHEN 1 THEN 'January' WHEN 2 THEN 'February' WHEN 3 THEN 'March'"
    " WHEN 4 THEN 'April' WHEN 5 THEN 'May' WHEN 6 THEN 'June' WHEN 7 THEN 'July'"
    " WHEN 8 THEN 'August' WHEN 9 THEN 'September' WHEN 10 THEN 'October'"
    " WHEN 11 THEN 'November' ELSE 'december' END"
)
_DAY = "CAST(day(o_orderdate) AS STRING)"
_OYEAR = "CAST(year(o_orderdate) AS STRING)"
DATE_TEXT = (
    f"CASE o_orderkey % 8 WHEN 0 THEN {_MONTH} || ' ' || {_DAY} || ', ' || {_OYEAR}"
    f" WHEN 1 THEN '  ' || {_DAY} || ' ' || {_MONTH} || ' ' || {_OYEAR} || ' '"
    f" WHEN 2 THEN {_MONTH} || ' ' || {_OYEAR}"
    f" WHEN 3 THEN {_OYEAR}"
    f" WHEN 4 THEN 'updated: ' || {_MONTH} || ' ' || {_DAY} || ', ' || {_OYEAR}"
    f" WHEN 5 THEN 'soon' WHEN 6 THEN ''"
    f" ELSE 'Smarch ' || {_DAY} || ', ' || {_OYEAR} END"
)

_K = "CAST(o_orderkey AS STRING)"
_SRC = "CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING)"
_SHARP = (
    "'{\"childImageSharp\":{\"gatsbyImageData\":{\"images\":{\"fallback\":{\"src\":\"/i/' || "
    + _K
    + " || '.png\"}},\"width\":' || CAST(o_custkey AS STRING) || ',\"height\":90}}'"
)
_BODY = (
    "'{\"result\":{\"data\":{\"country\":{\"name\":\"Entity ' || "
    + _K
    + " || '\",\"region\":\"' || o_orderpriority || '\",\"updated\":\"' || "
    + f"({DATE_TEXT})"
    + " || '\",\"flag\":' || "
    + _SHARP
    + " || '},\"map\":null,\"locatorMap\":{\"childImageSharp\":null},\"images\":[' || "
    + _SHARP
    + " || ',\"altText\":\"alt ' || "
    + _K
    + " || '\"},{\"caption\":\"no url\"}]},\"fields\":{\"nodes\":['"
    # a complete node, numeric id, truthy rank, one usable medium
    + " || '{\"name\":\"Status\",\"data\":\"a<br>' || o_orderstatus || '\",\"fieldLabel\":"
    "[{\"databaseId\":' || CAST(o_custkey % 50 AS STRING) || ',\"rank\":\"1\"}],\"subfields\":"
    "[{\"label\":\"x\"},{\"label\":\"\"},{\"label\":\"' || o_orderstatus || '\"}],\"media\":"
    "[{\"type\":\"img\",\"label\":\"m\",\"localFile\":{\"publicURL\":\"/m/' || "
    + _K
    + " || '\"}},{\"type\":\"img\",\"localFile\":null}]},'"
    # a node that is no object
    " || CASE WHEN o_orderkey % 3 = 0 THEN '7,' ELSE '' END"
    # text id, falsy rank, nothing else
    " || '{\"name\":\"Price\",\"data\":\"' || "
    + _SRC
    + " || ' USD (' || "
    + _OYEAR
    + " || ')\",\"fieldLabel\":[{\"databaseId\":\"p' || CAST(o_custkey % 9 AS STRING) || "
    "'\",\"rank\":false}],\"subfields\":null}'"
    " || CASE WHEN o_orderkey % 5 = 0 THEN ',{\"name\":\"Bare\",\"data\":null}' ELSE '' END"
    " || ']}}}}'"
)
PAGES = {
    "entity": "'e' || " + _K,
    "source_url": "'https://h.example/page-data/' || " + _K + " || '.json'",
    "body": (
        "CASE o_orderkey % 17 WHEN 3 THEN '{\"result\":[1]}' WHEN 5 THEN '{broken'"
        " WHEN 7 THEN '{\"result\":{\"data\":{\"z\":1}}}'"
        " WHEN 9 THEN '{\"data\":{\"allLaunchpadCategory\":{\"nodes\":[]}}}'"
        f" ELSE {_BODY} END"
    ),
}

URL_PREFIX = "/site"
URL_BASE = "https://h.example/site"
SITE_URLS = {
    "pos": "o_orderkey",
    "url": (
        "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'https://h.example' END"
        " || CASE WHEN o_orderkey % 11 = 10 THEN '/site/references/c' ELSE '/site/countries/c' END"
        " || CAST(o_custkey AS STRING) || CASE o_orderkey % 11 WHEN 0 THEN '' WHEN 1 THEN '/flag/'"
        " WHEN 2 THEN '/map' WHEN 3 THEN '/locator-map/' WHEN 4 THEN '/factsheets'"
        " WHEN 5 THEN '/travel-facts/' WHEN 6 THEN '/images' WHEN 7 THEN '/a/b/'"
        " WHEN 8 THEN '/extra-' || CAST(o_orderkey % 5 AS STRING) ELSE '/' END"
        " || CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 13 = 0 THEN '?page=2#top' ELSE '' END"
    ),
}

SITEMAPS = {
    "doc_no": "c_custkey",
    "xml": (
        "CASE WHEN c_custkey % 4 = 0 THEN"
        " '<sitemapindex xmlns=\"http://www.sitemaps.org/schemas/sitemap/0.9\"><sitemap><loc>"
        "https://h.example/sitemap-' || CAST(c_custkey AS STRING) || '.xml</loc></sitemap>"
        "</sitemapindex>'"
        " ELSE '<urlset xmlns=\"http://www.sitemaps.org/schemas/sitemap/0.9\"><url><loc>"
        "https://h.example/site/countries/c' || CAST(c_custkey AS STRING) || '</loc></url>'"
        " || CASE WHEN c_custkey % 4 <> 1 THEN '<url><lastmod>2024</lastmod><loc>"
        "https://h.example/site/countries/c' || CAST(c_custkey AS STRING) || '/' ||"
        " lower(c_mktsegment) || '</loc></url>' ELSE '' END || '</urlset>' END"
    ),
}

#: the same with documents that are broken, of another kind, blank or absent among them
MIXED_SITEMAPS = {
    "doc_no": "c_custkey",
    "xml": (
        f"CASE c_custkey % 11 WHEN 1 THEN substr({SITEMAPS['xml']}, 1, 100) WHEN 4 THEN 'no markup'"
        " WHEN 6 THEN '' WHEN 8 THEN NULL WHEN 9 THEN '<html><url><loc>x</loc></url></html>'"
        f" ELSE '<?xml version=\"1.0\"?>' || {SITEMAPS['xml']} END"
    ),
}

#: fields whose names and texts hold quotes, commas and line feeds
QUOTED_FIELDS = {
    "entity": "CAST(doc_id AS STRING)",
    "name": "'say \"' || lang || '\", ' || source",
    "database_id": "CAST(doc_id % 7 AS STRING)",
    "category": "CASE WHEN doc_id % 5 <> 0 THEN 'part, ' || lang END",
    "has_ranking": "doc_id % 2 = 0",
    "data": (
        "CASE WHEN doc_id % 2 = 0 THEN 'a \"quoted\" one' || chr(10) || 'two, three' || CAST(n_chars AS STRING)"
        " || '<br>' || source ELSE '<strong>k \"' || lang || '\":</strong> x' || CAST(n_chars AS STRING)"
        " || '<strong>\"\":</strong> ,y' END"
    ),
}

#: fields of lines in a later snapshot: some changed, some gone; those that only it has are in both tables
LATER_FIELDS = FIELDS | {
    "data": f"CASE WHEN l_partkey % 50 = 7 THEN replace({FIELDS['data']}, 'units', 'pieces') ELSE {FIELDS['data']} END",
}

CATEGORY_PAGES = {
    "page_no": "CAST(doc_id % 100 AS BIGINT) * 100000000 + doc_id",
    "priority": "CASE WHEN doc_id < 40 THEN 1 ELSE 2 + doc_id % 2 END",
    "body": (
        "CASE WHEN doc_id < 40 THEN '{\"z\":1}' ELSE"
        " '{\"data\":{\"allLaunchpadCategory\":{\"nodes\":[{\"name\":\"' || source || "
        "'\",\"fieldLabels\":[{\"databaseId\":' || CAST(n_chars % 400 AS STRING) || "
        "'},{\"databaseId\":\"' || CAST(doc_id % 300 AS STRING) || '\"}]},{\"name\":\"\","
        "\"fieldLabels\":[{\"databaseId\":1}]},{\"name\":\"' || lang || '\",\"fieldLabels\":"
        "[{\"databaseId\":' || CAST(doc_id % 500 AS STRING) || '},{\"databaseId\":null}]}]}}}' END"
    ),
}

FETCH_LOG = {
    "slug": "'u' || CAST(event_id AS STRING)",
    "source_url": "CASE WHEN event_id % 23 <> 0 THEN 'https://h.example/' || event_type END",
    "http_status": (
        "CASE WHEN event_id % 5 = 0 THEN CASE WHEN value < 5 THEN 404 WHEN value < 20 THEN 500"
        " + CAST(floor(value) AS INT) WHEN value < 40 THEN 403 WHEN value < 80 THEN 200 END"
        " ELSE 200 END"
    ),
    "exception_kind": (
        "CASE WHEN event_id % 5 = 0 AND value >= 40 THEN CASE event_type WHEN 'error' THEN 'timeout'"
        " WHEN 'click' THEN 'connection' WHEN 'view' THEN 'json_decode' WHEN 'signup' THEN 'http'"
        " END END"
    ),
    "body_ok": "event_id % 5 <> 0",
    "parsed_ok": "event_id % 7 <> 0",
    "n_fields": "CAST(length(props) * 3 AS INT)",
    "n_assets": "CAST(event_id % 5 AS INT)",
}

ORDER_SNAPSHOTS = {
    "snapshot_date": "CAST(date_trunc('month', o_orderdate) AS DATE)",
    "o_orderkey": "o_orderkey",
    "o_orderstatus": "o_orderstatus",
}

_TABLE_OF = {
    "fields": ("lineitem", FIELDS, None),
    "nested_pairs": ("lineitem", _nested(NESTED_PAIRS), None),
    "nested_notes": ("lineitem", _nested(NESTED_NOTES), None),
    "nested_sub": ("lineitem", _nested(NESTED_SUB), None),
    "encoded_texts": ("documents", ENCODED_TEXTS, None),
    "user_fields": ("events", USER_FIELDS, None),
    "mapping": ("part", PAIRS_MAPPING, MAPPING_FILTER),
    "mapping_all": ("part", PAIRS_MAPPING, None),
    "landed": ("orders", PAGES, None),
    "site_urls": ("orders", SITE_URLS, None),
    "sitemaps": ("customer", SITEMAPS, None),
    "mixed_sitemaps": ("customer", MIXED_SITEMAPS, None),
    "quoted_fields": ("documents", QUOTED_FIELDS, None),
    "earlier_fields": ("lineitem", FIELDS, "l_partkey % 50 <> 9"),
    "later_fields": ("lineitem", LATER_FIELDS, "l_partkey % 50 <> 8"),
    "category_pages": ("documents", CATEGORY_PAGES, None),
    "fetches": ("events", FETCH_LOG, None),
    "order_snapshots": ("orders", ORDER_SNAPSHOTS, None),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_ROW_KEYS = {
    "lineitem": ["l_orderkey", "l_partkey", "l_linenumber"],
    "orders": ["o_orderkey"],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "pages": ["page_id"],
    "part": ["p_partkey"],
    "customer": ["c_custkey"],
}


#: bytes of table files whose rows one task works on: 100,000 to 300,000 lines or orders
TASK_BYTES = 2 << 20


def tasks_for(df: DataFrame) -> int:
    """Tasks for the rows of a table just read: by the size of its files, and one per core at least."""
    n_bytes = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-int(str(n_bytes)) // TASK_BYTES))


def spread(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Deal rows over as many tasks as the size of the table asks for.

    The text work is the cost here, not the scan.  Splits of the scan do not tell how rows are dealt: a row
    group is read by one task, however many splits its file has, and a split has up to 128 MB.  So only a
    table of at least as many files as tasks keeps its partitions.  Rows are dealt by their unique key, which
    unlike a round robin needs no sort to be repeatable.

    With ``by``, expressions in place of that key, rows that agree in them always meet in one task.
    """
    tasks = tasks_for(df)
    if by:
        return df.repartition(tasks, *[F.expr(expr) for expr in by])
    if df.rdd.getNumPartitions() >= tasks and len(df.inputFiles()) >= tasks:
        return df
    return df.repartition(tasks, *_ROW_KEYS[name])


def _outlined(expr: str) -> str:
    # long expressions stay out of the generated method, see fieldmill.functions.binding
    return f"get(transform(array(0), _ -> {expr}), 0)" if len(expr) > 500 else expr


def derived(spark: SparkSession, sf_dir: str, name: str, by: Sequence[str] = ()) -> DataFrame:
    """One of the inputs above as a DataFrame; its rows are dealt ``by`` expressions with ``{column}`` in them."""
    source, columns, condition = _TABLE_OF[name]
    df = spread(table(spark, sf_dir, source), source, [expr.format(**columns) for expr in by])
    if condition:
        df = df.where(condition)
    return df.selectExpr(*[f"{_outlined(expr)} AS {alias}" for alias, expr in columns.items()])


def derived_sql(name: str) -> str:
    """The same input as a SELECT."""
    source, columns, condition = _TABLE_OF[name]
    select = ", ".join(f"{expr} AS {alias}" for alias, expr in columns.items())
    where = f" WHERE {condition}" if condition else ""
    return f"SELECT {select} FROM {source}{where}"
