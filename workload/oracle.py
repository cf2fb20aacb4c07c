"""DuckDB SQL for every query, written independently of the Spark code."""

from __future__ import annotations

from workload import inputs
from workload.inputs import DATE_TEXT, URL_BASE, URL_PREFIX, derived_sql

ORACLE: dict[str, str] = {}

_BR = r"(?i)<br\s*/?>"
_NOTE = r"(?i)<b>[^<]*note:[^<]*</b>"
_YEAR = r"\([0-9]{4}( est\.)?\)"


def _parts(text: str) -> str:
    return (
        f"list_filter(list_transform(string_split_regex(coalesce({text}, ''), '{_BR}'),"
        " lambda x: trim(x)), lambda x: x <> '')"
    )


def _key(text: str) -> str:
    return f"trim(rtrim(trim({text}), ':'))"


def _flat(text: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace({text}, '{_BR}', ' ', 'g'), '\\s+', ' ', 'g'))"
    )


def _year(value: str) -> str:
    return (
        f"CASE WHEN len(regexp_extract_all({value}, '{_YEAR}')) = 1 AND length({value}) <= 120"
        f" THEN regexp_extract({value}, '\\(([0-9]{{4}})( est\\.)?\\)', 1) END"
    )


def _kinds(source: str) -> str:
    return f"""
kinds AS (
  SELECT *, CASE WHEN n_strong = 0 THEN 'simple' WHEN n_strong = 1 THEN 'key_with_sub_values'
    WHEN regexp_matches(data, '(?i)<b>note:</b>') THEN 'key_value_pairs_with_notes'
    ELSE 'key_value_pairs' END AS structure_type
  FROM (SELECT *, len(regexp_extract_all(coalesce(data, ''), '(?i)<strong>.*?</strong>')) AS n_strong
        FROM ({source}))
)"""


_PAIR_KINDS = "('key_value_pairs', 'key_value_pairs_with_notes')"
_LEAVES = f"""
simple_parts AS (
  SELECT *, {_parts("data")} AS parts FROM kinds WHERE structure_type = 'simple'
), sub_parts AS (
  SELECT *, {_parts("regexp_replace(data, '(?is)^.*?<strong[^>]*>.*?</strong>', '')")} AS parts,
    {_key("regexp_extract(data, '(?is)<strong[^>]*>(.*?)</strong>', 1)")} AS k
  FROM kinds WHERE structure_type = 'key_with_sub_values'
), segs AS (
  SELECT *, string_split_regex(data, '(?i)<strong[^>]*>')[2:] AS ss,
    string_split_regex(data, '{_NOTE}')[2:] AS ns
  FROM kinds WHERE structure_type IN {_PAIR_KINDS}
), pair_rows AS (
  SELECT *, unnest(ss) AS seg, generate_subscripts(ss, 1) - 1 AS ord FROM segs
), pairs AS (
  SELECT *, {_key("regexp_extract(seg, '(?is)^(.*?)</strong>', 1)")} AS k,
    {_flat("regexp_replace(regexp_replace(regexp_replace(seg, '(?is)^.*?</strong>', ''), '(?is)</p>.*$', ''), '(?is)<b>[^<]*note:[^<]*</b>.*$', '')")} AS v
  FROM pair_rows
), note_rows AS (
  SELECT *, unnest(ns) AS seg, generate_subscripts(ns, 1) - 1 + len(ss) AS ord FROM segs
  WHERE structure_type = 'key_value_pairs_with_notes'
), notes AS (
  SELECT *, 'note' AS k, {_flat("regexp_replace(seg, '(?is)<strong.*$', '')")} AS v FROM note_rows
), untagged AS (
  SELECT entity, pos, name, database_id, category, has_ranking, structure_type, NULL AS key,
    unnest(parts) AS value, generate_subscripts(parts, 1) - 1 AS "order" FROM simple_parts
  UNION ALL
  SELECT entity, pos, name, database_id, category, has_ranking, structure_type, k,
    unnest(parts), generate_subscripts(parts, 1) - 1 FROM sub_parts
  UNION ALL
  SELECT entity, pos, name, database_id, category, has_ranking, structure_type, k, v, ord
  FROM pairs WHERE k <> '' AND v <> ''
  UNION ALL
  SELECT entity, pos, name, database_id, category, has_ranking, structure_type, k, v, ord
  FROM notes WHERE v <> ''
), leaves AS (SELECT *, {_year("value")} AS year FROM untagged)
"""


def _leaf_sql(source: str = "SELECT * FROM fields") -> str:
    return f"WITH fields AS ({derived_sql('fields')}), {_kinds(source)}, {_LEAVES}"


# values per field, and the flag
_REFINED = (
    _leaf_sql()
    + """
, counts AS (
  SELECT entity, pos, name, count(*) AS n FROM leaves GROUP BY ALL
), dup AS (
  SELECT entity, pos, name, count(*) AS d FROM fields GROUP BY ALL
), refined AS (
  SELECT k.entity, k.pos, k.name, k.category, k.database_id, k.structure_type,
    CAST(coalesce(c.n, 0) / d.d AS BIGINT) AS n_leaves,
    CASE WHEN k.structure_type = 'key_with_sub_values' THEN 1
      ELSE CAST(coalesce(c.n, 0) / d.d AS BIGINT) END AS n_values,
    CASE k.structure_type WHEN 'key_value_pairs' THEN true
      WHEN 'simple' THEN coalesce(c.n, 0) / d.d > 1 ELSE false END AS is_multi_valued
  FROM kinds k JOIN dup d USING (entity, pos, name) LEFT JOIN counts c USING (entity, pos, name)
)
"""
)


def _pct(part: str, whole: str) -> str:
    return (
        f"CASE WHEN {whole} = 0 THEN 0.0 ELSE"
        f" round(100.0::DOUBLE * CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE), 1) END"
    )


ORACLE["values_by_year"] = (
    _leaf_sql()
    + "SELECT structure_type, year, count(*) AS n_values, count(key) AS n_keyed FROM leaves"
    " GROUP BY ALL"
)
ORACLE["split_documents"] = f"""
SELECT doc_id, unnest(p) AS value, generate_subscripts(p, 1) - 1 AS ord
FROM (SELECT doc_id, {_parts("replace(text, chr(10), '<br>')")} AS p FROM documents)"""
# pages hold line feeds as well, which a plain trim would leave on
ORACLE["split_pages"] = rf"""
SELECT page_id, unnest(p) AS value, generate_subscripts(p, 1) - 1 AS ord
FROM (SELECT page_id, list_filter(list_transform(string_split_regex(html, '{_BR}'),
  lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS p FROM pages)"""
ORACLE["has_breaks"] = f"""
SELECT name, count(*) FILTER (WHERE regexp_matches(data, '{_BR}')) AS with_breaks, count(*) AS n
FROM ({derived_sql("fields")}) GROUP BY name"""
ORACLE["structure_types"] = (
    _REFINED + "SELECT entity, pos, structure_type, is_multi_valued, n_values FROM refined"
)
ORACLE["value_rows"] = (
    _leaf_sql()
    + 'SELECT entity, pos, structure_type, key, value, "order", year FROM leaves'
)
for _name, _kind, _cols in (
    ("simple_values", "simple", ""),
    ("kv_pairs", "key_value_pairs", "key, "),
    ("kv_notes", "key_value_pairs_with_notes", "key, "),
    ("sub_values", "key_with_sub_values", "key, "),
):
    ORACLE[_name] = (
        _leaf_sql()
        + f'SELECT entity, pos, {_cols}value, "order", year FROM leaves WHERE structure_type = \'{_kind}\''
    )


def _nested_sql(name: str, n_cases: int, rows: list[tuple[int, str, str, int]]) -> str:
    """The pairs that each kind of text was made of, without looking at the text."""
    source = f"SELECT * FROM lineitem WHERE l_partkey % {n_cases}"
    pairs = " UNION ALL ".join(
        f"SELECT l_orderkey, l_partkey, l_linenumber, {key} AS key, {value} AS value, {order} AS ord"
        f" FROM ({source} = {case})"
        for case, key, value, order in rows
    )
    return (
        f"SELECT CAST(l_orderkey AS VARCHAR) AS entity, l_partkey * 10 + l_linenumber AS pos, key, value,"
        f' ord AS "order", {_year("value")} AS year FROM ({pairs})'
    )


_Q, _P = inputs.QUANTITY, f"replace({inputs.PRICE}, '  ', ' ')"
_KQ, _KP, _KN = "'quantity'", "'price'", "'note'"
ORACLE["kv_nested"] = _nested_sql(
    "nested_pairs",
    7,
    [
        (0, _KQ, f"{_Q} || ' <span>a <em>b</em></span>'", 0),
        (1, _KQ, _Q, 0),
        (3, _KQ, _Q, 0),
        (4, _KQ, f"{_Q} || ' <div><strong>price:</strong> ' || {_P} || '</div> end'", 0),
        (5, _KQ, f"{_Q} || ' <i>x</i>'", 0),
        *((case, _KP, _P, 1) for case in (0, 1, 2, 3, 4, 6)),
        (5, _KP, f"{_P} || ' y'", 1),
    ],
)
ORACLE["kv_notes_nested"] = _nested_sql(
    "nested_notes",
    4,
    [
        (0, _KQ, _Q, 0),
        (1, _KQ, _Q, 0),
        (2, _KQ, f"{_Q} || ' <ul><li><b>note:</b> in list</li></ul>'", 0),
        (3, _KQ, f"{_Q} || ' <b>big</b> box'", 0),
        *((case, _KP, _P, 1) for case in range(4)),
        (0, _KN, "'rush order<hr>'", 2),
        (1, _KN, "'low <i>stock</i>'", 2),
        (2, _KN, "'in list'", 2),
        (3, _KN, "'last'", 2),
    ],
)
_LINE = "'Line ' || CAST(l_linenumber AS VARCHAR)"
ORACLE["sub_nested"] = _nested_sql(
    "nested_sub",
    2,
    [
        (0, _LINE, _Q, 0),
        (0, _LINE, f"{inputs.PRICE} || ' <i>x'", 1),
        (0, _LINE, "'y</i>'", 2),
        (1, _LINE, _Q, 0),
    ],
)
ORACLE["text_cleanup"] = r"""
SELECT conv_id, turn, s AS stripped,
  regexp_replace(rtrim(s, ':'), '\s+$', '') AS no_colons,
  regexp_replace(s, '\s+', ' ', 'g') AS collapsed
FROM (SELECT conv_id, turn, regexp_replace('  ' || replace(text, ' ', ' ' || chr(9) || ' ') || ':: '
  || chr(10), '^\s+|\s+$', '', 'g') AS s FROM conversations)"""
ORACLE["entity_decoding"] = """
SELECT page_id, replace(replace(replace(replace(replace(replace(html, '&nbsp;', ' '), '&lt;', '<'),
  '&gt;', '>'), '&quot;', '"'), '&apos;', chr(39)), '&amp;', '&') AS html FROM pages"""

# the letters are back, and what was a reference to a reference is one
ORACLE["entity_decoding_full"] = """
SELECT doc_id, replace(replace(text, ' the ', ' ' || chr(8212) || 'the' || chr(128512) || ' '), ', ',
  chr(160) || '&lt;' || chr(8364) || '&bogus; ') AS text FROM documents"""
ORACLE["year_extract"] = rf"""
SELECT entity, pos, first_year, coalesce(data <> '' AND NOT (n > 1 OR (n = 1 AND len > 120)), false)
    AS is_data_point,
  CASE WHEN n = 1 AND len <= 120 THEN first_year END AS year,
  CASE WHEN n <= 2 AND NOT (n = 1 AND len > 60) THEN first_year END AS year_of_two
FROM (SELECT *, coalesce(len(regexp_extract_all(data, '{_YEAR}')), 0) AS n,
    coalesce(length(data), 0) AS len,
    coalesce(nullif(regexp_extract(data, '\(([0-9]{{4}}) est\.\)', 1), ''),
      nullif(regexp_extract(data, '\(([0-9]{{4}})\)', 1), '')) AS first_year
  FROM ({derived_sql("fields")}))"""
ORACLE["date_normalize"] = f"""
SELECT o_orderkey, CASE o_orderkey % 8
    WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 2 THEN strftime(o_orderdate, '%Y-%m-01') WHEN 3 THEN strftime(o_orderdate, '%Y-01-01')
    WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 5 THEN 'soon' WHEN 6 THEN NULL
    ELSE strftime(o_orderdate, '%Y-01-01') END AS updated,
  strftime(o_orderdate, '%Y-01-01') AS iso_as_year, strftime(o_orderdate, '%Y-%m-%d') AS iso_kept
FROM orders"""

_ENRICHED = (
    f"WITH mapping AS ({derived_sql('mapping')}), enriched AS (SELECT f.entity, f.pos,"
    f" f.database_id, m.category FROM ({derived_sql('fields')}) f LEFT JOIN mapping m"
    " ON f.database_id = m.database_id) "
)
ORACLE["category_enrich"] = _ENRICHED + "SELECT entity, pos, database_id, category FROM enriched"
ORACLE["category_enrich_shuffled"] = ORACLE["category_enrich"]
ORACLE["category_enrich_repeated"] = (
    _ENRICHED + "SELECT entity, pos, database_id, 'Z' || category AS category FROM enriched"
)
ORACLE["enrich_stats"] = (
    _ENRICHED
    + "SELECT entity, count(*) AS total_fields, count(category) AS fields_with_categories, "
    + _pct("count(category)", "count(*)")
    + " AS category_coverage_percentage FROM enriched GROUP BY entity"
)
ORACLE["enrich_summary"] = (
    _ENRICHED
    + "SELECT count(DISTINCT entity) AS total_entities, count(DISTINCT entity) AS successful_entities,"
    " CAST(0 AS BIGINT) AS failed_entities, count(*) AS total_fields_processed,"
    " count(category) AS total_fields_with_categories, "
    + _pct("count(category)", "count(*)")
    + " AS category_coverage_percentage FROM enriched"
)

# pages: what the generated documents say, straight from the table
_PAGE = f"""
WITH pages_in AS ({derived_sql("landed")}), o AS (
  SELECT *, 'e' || CAST(o_orderkey AS VARCHAR) AS entity, o_orderkey % 17 AS m,
    ({DATE_TEXT}) AS date_text, CAST(o_orderkey AS VARCHAR) AS k,
    CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS junk,
    CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS bare FROM orders
), good AS (SELECT * FROM o WHERE m NOT IN (3, 5, 7, 9)
), f AS (
  SELECT entity, o_orderkey, 0 AS pos, 0 AS idx, 'Status' AS name, 'a<br>' || o_orderstatus AS data,
    CAST(o_custkey % 50 AS VARCHAR) AS database_id, 'x|' || o_orderstatus AS subfields,
    true AS has_ranking, 1 AS n_media, '/m/' || k AS media_urls FROM good
  UNION ALL
  SELECT entity, o_orderkey, 1 + junk, 1, 'Price', CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR)
    || ' USD (' || CAST(year(o_orderdate) AS VARCHAR) || ')', 'p' || CAST(o_custkey % 9 AS VARCHAR),
    '', false, 0, '' FROM good
  UNION ALL
  SELECT entity, o_orderkey, 2 + junk, 2, 'Bare', NULL, NULL, '', false, 0, '' FROM good WHERE bare = 1
) """
ORACLE["refined_documents"] = (
    _PAGE
    + """SELECT entity, 'raw/' || entity || '.json' AS source_file, 2 + bare AS total_fields,
  1 AS multi_valued_fields, 1 + bare AS single_valued_fields, idx, name,
  name = 'Status' AS is_multi_valued, coalesce(replace(data, '<br>', '|'), '') AS value_list,
  CASE WHEN name = 'Price' THEN regexp_extract(data, '([0-9]{4})\\)', 1) END AS first_year
FROM f JOIN (SELECT entity, bare FROM good) USING (entity)
UNION ALL
SELECT entity, 'raw/' || entity || '.json', 0, 0, 0, NULL, NULL, NULL, NULL, NULL FROM o WHERE false"""
)
ORACLE["refinement_stats"] = (
    _REFINED
    + "SELECT entity, count(*) AS total_fields, count(*) FILTER (WHERE is_multi_valued)"
    " AS multi_valued_fields, count(*) FILTER (WHERE NOT is_multi_valued) AS single_valued_fields"
    " FROM refined GROUP BY entity"
)
ORACLE["refinement_summary"] = (
    _REFINED
    + "SELECT count(DISTINCT entity) AS total_entities, count(DISTINCT entity) AS successful_entities,"
    " CAST(0 AS BIGINT) AS failed_entities, count(*) AS total_fields_processed,"
    " count(*) FILTER (WHERE is_multi_valued) AS total_multi_valued_fields, 100.0::DOUBLE AS success_rate, "
    + _pct("count(*) FILTER (WHERE is_multi_valued)", "count(*)")
    + " AS multi_value_rate FROM refined"
)

_PROFILE = (
    _REFINED
    + """, modes AS (
  SELECT name, n_values FROM (
    SELECT name, n_values, row_number() OVER (PARTITION BY name ORDER BY count(*) DESC, n_values) AS rn
    FROM refined GROUP BY name, n_values) WHERE rn = 1
), profile AS (
  SELECT name, count(*) AS entities_analyzed, count(*) FILTER (WHERE is_multi_valued) AS multi_valued_count,
    count(*) FILTER (WHERE NOT is_multi_valued) AS single_valued_count, """
    + _pct("count(*) FILTER (WHERE is_multi_valued)", "count(*)")
    + """ AS multi_valued_percentage,
    round(CAST(sum(n_values) AS DOUBLE) / count(*), 1) AS avg_value_count,
    CAST(min(n_values) AS INTEGER) AS min_value_count, CAST(max(n_values) AS INTEGER) AS max_value_count,
    CAST(any_value(m.n_values) AS INTEGER) AS typical_value_count
  FROM (SELECT * FROM refined) JOIN (SELECT name, n_values AS mode_n FROM modes) q USING (name)
    JOIN modes m USING (name) GROUP BY name
) """
).replace("sum(n_values)", "sum(refined.n_values)").replace(
    "min(n_values)", "min(refined.n_values)"
).replace("max(n_values)", "max(refined.n_values)").replace(
    "FROM (SELECT * FROM refined) JOIN (SELECT name, n_values AS mode_n FROM modes) q USING (name)\n    JOIN modes m USING (name)",
    "FROM refined JOIN modes m USING (name)",
)
ORACLE["multi_value_profile"] = _PROFILE + "SELECT * FROM profile"
ORACLE["multi_value_summary"] = (
    _REFINED
    + "SELECT count(*) AS total_fields_analyzed, count(*) FILTER (WHERE is_multi_valued)"
    " AS multi_valued_occurrences, count(*) FILTER (WHERE NOT is_multi_valued)"
    " AS single_valued_occurrences, "
    + _pct("count(*) FILTER (WHERE is_multi_valued)", "count(*)")
    + " AS multi_value_percentage FROM refined"
)
ORACLE["multi_value_top"] = (
    _PROFILE
    + "SELECT name AS field_name, multi_valued_percentage, avg_value_count AS avg_values FROM profile"
    " WHERE multi_valued_count > 0 ORDER BY multi_valued_percentage DESC, field_name LIMIT 20"
)


def _census(source: str) -> str:
    # summed before subtracting, since sums come as a wider type
    spelled = {
        "br": "<br>",
        "br_slash": "<br/>",
        "br_space_slash": "<br />",
        "upper_br": "<BR>",
        "upper_br_slash": "<BR/>",
        "upper_br_space_slash": "<BR />",
    }
    sums = ", ".join(
        f"CAST(sum((length(t) - length(replace(t, '{tag}', ''))) / {len(tag)}) AS BIGINT) AS {name}"
        for name, tag in spelled.items()
    )
    total = f"CAST(sum(len(regexp_extract_all(t, '{_BR}'))) AS BIGINT)"
    known = " + ".join(spelled)
    return (
        f"SELECT *, total - ({known}) AS other FROM (SELECT {sums}, {total} AS total"
        f" FROM (SELECT coalesce(data, '') AS t FROM ({source})))"
    )


ORACLE["separator_census"] = _census(derived_sql("fields"))
ORACLE["separator_census_pages"] = _census("SELECT html AS data FROM pages")


def _catalog(source: str) -> str:
    return f"""
WITH info AS (
  SELECT *, coalesce(length(data), 0) AS len FROM ({source}) WHERE name <> ''
), total AS (SELECT count(DISTINCT entity) AS t FROM info), firsts AS (
  SELECT * FROM (SELECT name, database_id, category, has_ranking,
    row_number() OVER (PARTITION BY name ORDER BY entity, pos) AS rn FROM info) WHERE rn = 1
), catalog AS (
  SELECT i.name, f.database_id, f.category, f.has_ranking, count(DISTINCT entity) AS n_entities,
    count(*) AS n_occurrences, CAST(min(len) AS INTEGER) AS min_length,
    CAST(max(len) AS INTEGER) AS max_length, round(CAST(sum(len) AS DOUBLE) / count(*), 1) AS avg_length,
    t AS total_entities, {_pct("count(DISTINCT entity)", "t")} AS coverage_percentage,
    CASE WHEN count(DISTINCT entity) >= t THEN 'universal' WHEN 2 * count(DISTINCT entity) >= t
      THEN 'common' ELSE 'rare' END AS coverage_band
  FROM info i JOIN firsts f ON i.name = f.name CROSS JOIN total
  GROUP BY i.name, f.database_id, f.category, f.has_ranking, t
) """


_USER_CATALOG = _catalog(derived_sql("user_fields"))
ORACLE["field_catalog"] = _USER_CATALOG + "SELECT * FROM catalog"
ORACLE["field_catalog_lines"] = (
    _catalog(derived_sql("fields")) + "SELECT * EXCLUDE (database_id) FROM catalog"
)
ORACLE["field_entities"] = (
    f"SELECT DISTINCT name, entity FROM ({derived_sql('user_fields')}) WHERE name <> ''"
)
ORACLE["category_summary"] = (
    _USER_CATALOG
    + "SELECT coalesce(category, 'Unknown') AS category, count(*) AS field_count,"
    " round(CAST(sum(CAST(round(coverage_percentage * 10) AS BIGINT)) AS DOUBLE) / 10 / count(*), 1)"
    " AS avg_coverage FROM catalog GROUP BY 1"
)
ORACLE["coverage_bands"] = (
    _USER_CATALOG
    + "SELECT "
    + ", ".join(
        f"count(*) FILTER (WHERE coverage_band = '{b}') AS {b}_fields"
        for b in ("universal", "common", "rare")
    )
    + " FROM catalog"
)
ORACLE["missing_counts"] = (
    _USER_CATALOG + "SELECT name, total_entities - n_entities AS missing_entities FROM catalog"
)
ORACLE["missing_entities"] = (
    f"WITH f AS ({derived_sql('user_fields')}) SELECT e.entity, n.name FROM"
    " (SELECT DISTINCT entity FROM f) e, (SELECT DISTINCT name FROM f) n"
    " EXCEPT SELECT entity, name FROM f"
)

_EXPORT = """SELECT entity AS entity, entity AS entity_slug, name AS field_name, database_id,
  coalesce(category, 'Unknown') AS category, structure_type,
  CASE WHEN structure_type = 'simple' THEN '-' ELSE key END AS key, value, "order", has_ranking"""
_WANTED = "category IN ('category 1', 'category 2', 'category 3')"
ORACLE["export_rows"] = _leaf_sql() + _EXPORT + ", year FROM leaves"
_QUOTED = f"""
WITH q AS (SELECT * FROM ({derived_sql("quoted_fields")}) JOIN documents ON entity = CAST(doc_id AS VARCHAR)
), leaves AS (
  SELECT *, 'simple' AS structure_type, NULL AS key, unnest(['a "quoted" one' || chr(10) || 'two, three'
    || CAST(n_chars AS VARCHAR), source]) AS value, unnest([0, 1]) AS "order" FROM q WHERE doc_id % 2 = 0
  UNION ALL SELECT *, 'key_value_pairs', unnest(['k "' || lang || '"', '""']),
    unnest(['x' || CAST(n_chars AS VARCHAR), ',y']), unnest([0, 1]) FROM q WHERE doc_id % 2 = 1
) """
ORACLE["export_files"] = (
    _QUOTED
    + _EXPORT
    + ", format FROM leaves, (VALUES ('csv'), ('parquet')) AS f(format)"
    " WHERE category IS NULL OR category IN ('part, de', 'part, fr', 'part, en')"
)
ORACLE["export_filtered"] = (
    _leaf_sql()
    + _EXPORT
    + f" FROM leaves WHERE {_WANTED} AND CAST(entity AS BIGINT) IN"
    " (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"
)
ORACLE["export_refined"] = _leaf_sql() + _EXPORT + f" FROM leaves WHERE {_WANTED}"
ORACLE["export_summary"] = (
    _REFINED
    + "SELECT '2025-01-01' AS snapshot_date, count(DISTINCT entity) AS total_entities,"
    " count(*) AS total_fields, CAST(sum(n_leaves) AS BIGINT) AS total_rows, 'All entities' AS"
    " entities_filter, 'category 1, category 2, category 3' AS categories_filter FROM refined"
    f" WHERE {_WANTED}"
)

ORACLE["json_project"] = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  json_extract_string(props, '$.k.z') AS deep, 'default' AS missing FROM events"""
ORACLE["page_kinds"] = (
    _PAGE
    + "SELECT entity, m NOT IN (3, 5, 7, 9) AS is_valid, CASE WHEN m = 9 THEN 'category'"
    " WHEN m IN (3, 5, 7) THEN 'invalid' ELSE 'entity' END AS kind FROM o"
)
ORACLE["page_metadata"] = (
    _PAGE
    + """SELECT entity, 'Entity ' || k AS name, o_orderpriority AS region, d.updated AS updated,
  2 + junk + bare AS field_count FROM good JOIN ("""
    + ORACLE["date_normalize"]
    + ") d USING (o_orderkey)"
)
ORACLE["page_assets"] = (
    _PAGE
    + """SELECT entity, '/i/' || k || '.png' AS flag_url, o_custkey AS flag_width, true AS no_map,
  true AS no_locator_map, 1 AS n_images, 'alt ' || k AS alt_texts, 2 AS n_assets FROM good"""
)
ORACLE["page_fields"] = (
    _PAGE
    + "SELECT entity, pos, name, data, database_id, subfields, has_ranking, n_media, media_urls FROM f"
)
ORACLE["page_quarantine"] = (
    _PAGE
    + "SELECT entity, source_url, body, 'Invalid JSON structure' AS error FROM pages_in"
    " WHERE entity NOT IN (SELECT entity FROM good)"
)
ORACLE["raw_documents"] = (
    _PAGE
    + """SELECT entity, '2025-01-01' AS scraped_at, m NOT IN (3, 5, 7, 9) AS scrape_success,
  CASE WHEN m NOT IN (3, 5, 7, 9) THEN 'Entity ' || k END AS name,
  CASE WHEN m IN (3, 5, 7, 9) THEN 'Invalid JSON structure' END AS error,
  CASE WHEN m NOT IN (3, 5, 7, 9) THEN 2 + junk + bare END AS field_count,
  CASE WHEN m NOT IN (3, 5, 7, 9) THEN 2 + bare ELSE 0 END AS n_fields FROM o"""
)
ORACLE["document_files"] = (
    _PAGE
    + """SELECT entity, o_orderkey % 13 = 1 AS is_broken, o_orderkey % 13 <> 1 AS is_valid,
  CASE WHEN o_orderkey % 13 <> 1 THEN 2 + bare END AS n_fields FROM good"""
)
ORACLE["landing_run"] = (
    _PAGE
    + """SELECT entity, CASE WHEN m IN (3, 5, 7, 9) THEN 'quarantine' ELSE 'raw' END AS stored_in,
  CASE WHEN m NOT IN (3, 5, 7, 9) THEN 2 + bare END AS n_fields FROM o"""
)
ORACLE["landing_report"] = (
    _PAGE
    + """SELECT '2025-01-01' AS snapshot_date, count(*) AS total_entities,
  count(*) FILTER (WHERE m NOT IN (3, 5, 7, 9)) AS successful,
  count(*) FILTER (WHERE m IN (3, 5, 7, 9)) AS failed,
  CAST(sum(2 + bare) FILTER (WHERE m NOT IN (3, 5, 7, 9)) AS BIGINT) AS total_fields FROM o"""
)
ORACLE["exploded_fields"] = (
    _PAGE
    + "SELECT entity, 'Entity ' || o_orderkey AS entity_name, idx AS pos, name, data, database_id FROM f"
)

_SITE = f"""
WITH urls AS ({derived_sql("site_urls")}), paths AS (
  SELECT pos, url, CASE WHEN starts_with(url, 'http')
    THEN regexp_replace(regexp_extract(url, '^https?://[^/]*([^?#]*)', 1), ';[^/]*$', '')
    ELSE url END AS path FROM urls
), parsed AS (
  SELECT *, replace(path, '{URL_PREFIX}', '') AS clean,
    regexp_matches(path, '^{URL_PREFIX}/countries/[^/]+(/.*)?$') AS is_entity FROM paths
), typed AS (
  SELECT *, nullif(regexp_extract(clean, '^/countries/([^/]+)(/([^/]+))?/?$', 1), '') AS slug,
    nullif(regexp_extract(clean, '^/countries/([^/]+)(/([^/]+))?/?$', 3), '') AS seg FROM parsed
), named AS (
  SELECT *, CASE WHEN slug IS NULL THEN NULL WHEN seg IS NULL THEN 'main' WHEN seg = 'factsheets'
    THEN 'factsheet' WHEN seg = 'locator-map' THEN 'locator_map' WHEN seg = 'travel-facts'
    THEN 'travel_facts' ELSE seg END AS type,
    '{URL_BASE}/page-data' || rtrim(clean, '/') || '/page-data.json' AS page_url FROM typed
), ent AS (SELECT slug, type, page_url, pos FROM named WHERE is_entity AND slug IS NOT NULL
), others AS (
  SELECT slug, page_url AS url, min(pos) AS pos FROM ent WHERE type NOT IN
    ('main', 'factsheet', 'images', 'flag', 'map', 'locator_map') GROUP BY ALL
), idx AS (
  SELECT slug, arg_max(page_url, pos) FILTER (WHERE type = 'main') AS main,
    arg_max(page_url, pos) FILTER (WHERE type = 'factsheet') AS factsheet,
    arg_max(page_url, pos) FILTER (WHERE type = 'images') AS images,
    arg_max(page_url, pos) FILTER (WHERE type = 'flag') AS flag,
    arg_max(page_url, pos) FILTER (WHERE type = 'map') AS map,
    arg_max(page_url, pos) FILTER (WHERE type = 'locator_map') AS locator_map
  FROM ent GROUP BY slug
), full_idx AS (
  SELECT idx.*, coalesce(n, 0) AS other_count, coalesce(o, '') AS other FROM idx LEFT JOIN
    (SELECT slug, count(*) AS n, string_agg(url, '|' ORDER BY pos) AS o FROM others GROUP BY slug)
    USING (slug)
) """
ORACLE["url_filter"] = _SITE + "SELECT pos, url FROM named WHERE is_entity"
ORACLE["url_parse"] = _SITE + "SELECT pos, slug, type FROM named"
ORACLE["url_paths"] = rf"""
SELECT page_id, path, '{URL_BASE}/page-data' || rtrim(replace(path, '/en', ''), '/')
  || '/page-data.json' AS page_data_url
FROM (SELECT page_id, regexp_extract(url, '^https?://[^/]*([^?#]*)', 1) AS path FROM pages)"""
ORACLE["url_index"] = _SITE + "SELECT * EXCLUDE (other) FROM full_idx"
ORACLE["index_files"] = ORACLE["url_index"]
ORACLE["url_other"] = _SITE + "SELECT slug, url, pos FROM others"
_TYPES = ("main", "factsheet", "images", "flag", "map", "locator_map")
ORACLE["url_types"] = (
    _SITE
    + "SELECT count(*) AS total_entities, CAST(count(*) + "
    + " + ".join(f"count({t})" for t in _TYPES if t != "main")
    + " + sum(other_count) AS BIGINT) AS total_urls, "
    + ", ".join(f"count({t}) AS {t}" for t in _TYPES)
    + ", CAST(sum(other_count) AS BIGINT) AS other FROM full_idx"
)
ORACLE["sitemap_scan"] = f"""
SELECT doc_no, url, doc_no * 8589934592 + i AS pos FROM (
  SELECT doc_no, unnest(locs) AS url, generate_subscripts(locs, 1) - 1 AS i FROM (
    SELECT doc_no, regexp_extract_all(xml, '<loc>([^<]*)</loc>', 1) AS locs
    FROM ({derived_sql("sitemaps")})))"""
_MIXED = f"SELECT * FROM ({derived_sql('mixed_sitemaps')})"
ORACLE["sitemap_mixed"] = f"""
SELECT doc_no, url, doc_no * 8589934592 + i AS pos FROM (
  SELECT doc_no, unnest(locs) AS url, generate_subscripts(locs, 1) - 1 AS i FROM (
    SELECT doc_no, regexp_extract_all(xml, '<loc>([^<]*)</loc>', 1) AS locs
    FROM ({_MIXED} WHERE doc_no % 11 NOT IN (1, 4, 6, 8, 9))))"""
ORACLE["sitemap_quarantine"] = """
SELECT c_custkey AS doc_no, CASE WHEN c_custkey % 11 IN (1, 4) THEN 'unreadable'
  WHEN c_custkey % 11 = 9 THEN 'not a sitemap' ELSE 'empty' END AS error
FROM customer WHERE c_custkey % 11 IN (1, 4, 6, 8, 9)"""
ORACLE["index_order"] = (
    _SITE + "SELECT slug, other_count, row_number() OVER (ORDER BY slug) - 1 AS place FROM full_idx"
)
ORACLE["index_load"] = (
    _SITE
    + "SELECT slug, main, flag, other_count AS n_other FROM full_idx WHERE slug IN"
    " (SELECT 'c' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 0)"
)

ORACLE["mapping_load"] = derived_sql("mapping_all")
ORACLE["mapping_extract"] = """
WITH p AS (SELECT *, CAST(doc_id % 100 AS BIGINT) * 100000000 + doc_id AS page_no FROM documents
  WHERE doc_id >= 40), labels_in AS (
  SELECT page_no, 0 AS node_no, 0 AS label_no, source AS category, CAST(n_chars % 400 AS VARCHAR) AS id FROM p
  UNION ALL SELECT page_no, 0, 1, source, CAST(doc_id % 300 AS VARCHAR) FROM p
  UNION ALL SELECT page_no, 2, 0, lang, CAST(doc_id % 500 AS VARCHAR) FROM p
)
SELECT id AS database_id, arg_max(category, (page_no * 10 + node_no) * 10 + label_no) AS category
FROM labels_in WHERE category <> '' AND id <> '0' GROUP BY id"""
ORACLE["mapping_fallback"] = """
SELECT CAST(doc_id % 100 AS BIGINT) * 100000000 + doc_id AS page_no, 2 + doc_id % 2 AS priority
FROM documents WHERE doc_id >= 40 AND 2 + doc_id % 2 = 2"""

ORACLE["snapshot_latest"] = (
    f"WITH s AS ({derived_sql('order_snapshots')}) SELECT * FROM s WHERE snapshot_date ="
    " (SELECT max(snapshot_date) FROM s)"
)
_DIFF = (
    _leaf_sql()
    + """, base AS (
  SELECT entity, CAST(pos AS VARCHAR) AS name, key, "order", value FROM leaves
), a AS (
  SELECT * FROM base WHERE NOT (key = 'price') OR key IS NULL OR name NOT LIKE '%7'
), b AS (
  SELECT entity, name, key, "order", CASE WHEN name LIKE '%5' THEN upper(value)
    WHEN name LIKE '%1' AND key IS NULL THEN NULL ELSE value END AS value FROM base
  WHERE NOT (key = 'quantity') OR key IS NULL OR name NOT LIKE '%3'
), c AS (
  SELECT entity, name, key, "order", value, sum(o) AS o, sum(n) AS n FROM (
    SELECT *, 1 AS o, 0 AS n FROM a UNION ALL SELECT *, 0, 1 FROM b) GROUP BY ALL
), s AS (
  SELECT *, sum(o) OVER w AS olds, sum(n) OVER w AS news, count(*) OVER w AS kinds,
    max(CASE WHEN o > 0 THEN value END) OVER w AS ov, max(CASE WHEN n > 0 THEN value END) OVER w AS nv
  FROM c WINDOW w AS (PARTITION BY entity, name, key, "order")
), diff AS (
  SELECT DISTINCT entity, name, key, "order", ov AS old_value, nv AS new_value,
    CASE WHEN olds = 0 THEN 'added' WHEN news = 0 THEN 'removed' WHEN kinds = 1 THEN 'unchanged'
      ELSE 'changed' END AS status, CAST(1 AS BIGINT) AS copies
  FROM s WHERE olds <= 1 AND news <= 1
  UNION ALL
  SELECT entity, name, key, "order", value, value, 'unchanged', CAST(least(o, n) AS BIGINT)
  FROM s WHERE (olds > 1 OR news > 1) AND least(o, n) > 0
  UNION ALL
  SELECT entity, name, key, "order", value, NULL, 'removed', CAST(o - n AS BIGINT)
  FROM s WHERE (olds > 1 OR news > 1) AND o > n
  UNION ALL
  SELECT entity, name, key, "order", NULL, value, 'added', CAST(n - o AS BIGINT)
  FROM s WHERE (olds > 1 OR news > 1) AND n > o
) """
)
ORACLE["snapshot_diff"] = _DIFF + "SELECT * FROM diff"
ORACLE["snapshot_diff_summary"] = (
    _DIFF + "SELECT status, CAST(sum(copies) AS BIGINT) AS n_values FROM diff GROUP BY status"
)

# the rows of earlier and later fields, of which only the texts of some parts differ
_PART_OF = "CAST(pos AS BIGINT) // 10 % 50"
ORACLE["snapshot_diff_fields"] = (
    _DIFF.replace("CAST(pos AS VARCHAR) AS name", "name, pos")
    .replace("WHERE NOT (key = 'price') OR key IS NULL OR name NOT LIKE '%7'", f"WHERE {_PART_OF} <> 9")
    .replace("WHERE NOT (key = 'quantity') OR key IS NULL OR name NOT LIKE '%3'", f"WHERE {_PART_OF} <> 8")
    .replace(
        "CASE WHEN name LIKE '%5' THEN upper(value)\n    WHEN name LIKE '%1' AND key IS NULL THEN NULL ELSE value END",
        f"CASE WHEN {_PART_OF} = 7 THEN replace(value, 'units', 'pieces') ELSE value END",
    )
    .replace("SELECT *, 1 AS o, 0 AS n FROM a", 'SELECT entity, name, key, "order", value, 1 AS o, 0 AS n FROM a')
    .replace("UNION ALL SELECT *, 0, 1 FROM b", 'UNION ALL SELECT entity, name, key, "order", value, 0, 1 FROM b')
    + "SELECT * FROM diff"
)
ORACLE["snapshot_dated"] = (
    f"WITH s AS ({derived_sql('order_snapshots')}) SELECT *, '1995-03-01' AS asked FROM s"
    " WHERE snapshot_date = DATE '1995-03-01' UNION ALL SELECT *, 'latest' FROM s"
    " WHERE snapshot_date = (SELECT max(snapshot_date) FROM s)"
)
ORACLE["snapshot_replace"] = f"""
SELECT entity, pos, CASE WHEN entity = '1' THEN 'new' ELSE category END AS category
FROM ({derived_sql("fields")}) WHERE entity <> '2'"""

ORACLE["quality_rules"] = (
    _REFINED
    + """, spoiled AS (
  SELECT pos % 11 = 0 AS no_entity, pos % 13 = 0 AS odd, is_multi_valued OR pos % 17 = 0 AS multi,
    pos % 19 = 0 AS gone, structure_type AS st, n_values AS n FROM refined
), rules AS (
  SELECT 'missing_entity' AS rule FROM spoiled WHERE no_entity
  UNION ALL SELECT 'unknown_structure_type' FROM spoiled WHERE odd
  UNION ALL SELECT 'missing_values' FROM spoiled WHERE gone
  UNION ALL SELECT 'value_without_value' FROM spoiled WHERE NOT gone AND odd AND st = 'key_with_sub_values'
  UNION ALL SELECT 'multi_with_fewer_than_two' FROM spoiled WHERE NOT gone AND multi AND n < 2
  UNION ALL SELECT 'empty_values' FROM spoiled WHERE NOT gone AND n = 0
)
SELECT rule, count(*) AS n_fields FROM rules GROUP BY rule"""
)
ORACLE["raw_validation"] = (
    _PAGE
    + "SELECT entity, m NOT IN (3, 5, 7, 9) AND bare = 0 AND o_custkey % 50 <> 3 AS is_valid FROM o"
)

_LOG = f"""
WITH log AS (
  SELECT *, CASE WHEN source_url IS NULL THEN 'no_main_url' WHEN exception_kind = 'timeout'
    THEN 'unexpected_error' WHEN NOT body_ok THEN 'fetch_failed' WHEN NOT parsed_ok THEN 'parse_failed'
    END AS error,
    CASE WHEN http_status = 404 THEN 'not_found' WHEN http_status >= 500 AND http_status < 600
    THEN 'server_error' WHEN http_status >= 400 AND http_status < 500 THEN 'client_error'
    WHEN exception_kind = 'timeout' THEN 'timeout' WHEN exception_kind = 'connection' THEN 'network_error'
    WHEN exception_kind = 'json_decode' THEN 'json_parse_error' WHEN exception_kind = 'http'
    THEN 'client_error' ELSE 'unknown' END AS error_class
  FROM ({derived_sql("fetches")})
) """
ORACLE["fetch_errors"] = _LOG + "SELECT slug, error_class FROM log"
ORACLE["fetch_outcomes"] = _LOG + "SELECT slug, error IS NULL AS success, error FROM log"
ORACLE["scrape_log"] = (
    _LOG
    + """SELECT slug AS entity, '2025-01-01' AS timestamp,
  CASE WHEN error IS NULL THEN 'success' ELSE 'failed' END AS status, 1.5::DOUBLE AS duration_seconds,
  source_url, error, CASE WHEN error IS NOT NULL THEN CASE WHEN NOT body_ok THEN error_class ELSE '' END END
    AS error_details, CASE WHEN error IS NULL THEN n_fields END AS fields_count FROM log"""
)
ORACLE["run_metadata"] = (
    _LOG
    + f"""SELECT count(*) AS total_entities, count(*) FILTER (WHERE error IS NULL) AS successful,
  count(error) AS failed,
  CAST(count(*) FILTER (WHERE error IS NULL) AS DOUBLE) / count(*) AS success_rate,
  {_pct("count(*) FILTER (WHERE error IS NULL)", "count(*)")} AS success_percentage,
  CAST(sum(n_fields) FILTER (WHERE error IS NULL) AS BIGINT) AS total_fields,
  CAST(sum(n_fields) FILTER (WHERE error IS NULL) AS DOUBLE) / count(*) FILTER (WHERE error IS NULL)
    AS avg_fields_per_entity,
  CAST(floor(CAST(sum(n_fields) FILTER (WHERE error IS NULL) AS DOUBLE)
    / count(*) FILTER (WHERE error IS NULL)) AS BIGINT) AS avg_fields_whole,
  CAST(sum(n_assets) FILTER (WHERE error IS NULL) AS BIGINT) AS total_assets FROM log"""
)
ORACLE["failure_counts"] = (
    _LOG + "SELECT error, count(*) AS n_entities FROM log WHERE error IS NOT NULL GROUP BY error"
)
ORACLE["failed_entities"] = _LOG + "SELECT slug AS entity, error FROM log WHERE error IS NOT NULL"
ORACLE["first_failures"] = (
    _LOG
    + "SELECT slug AS entity, error FROM log WHERE error IS NOT NULL ORDER BY slug, error LIMIT 10"
)
