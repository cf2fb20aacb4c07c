"""Operators on small fixtures."""

import pytest
from pyspark.sql import functions as F

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
from fieldmill.functions import urls as U
from workload.inputs import derived

FIELD = "entity string, pos int, name string, database_id string, category string, has_ranking boolean, data string"


def fields(spark, rows):
    return spark.createDataFrame(rows, FIELD)


def sample(spark):
    return fields(
        spark,
        [
            ("a", 0, "Area", "1", "Geo", False, "1 km (2001)<br>2 km"),
            ("a", 1, "Site", "2", None, True, "<strong>s</strong><br>x<br>y<br>z"),
            ("b", 0, "Area", "1", "Geo", False, "3"),
            ("b", 1, "Money", "3", "Eco", False, "<strong>r:</strong> 1<br><strong>s:</strong> 2<br><b>note:</b> n"),
            ("c", 0, "Area", "1", "Geo", False, None),
            ("c", 1, "", "9", None, False, "unnamed"),
        ],
    )


@pytest.mark.parametrize("hint", ["merge", "broadcast"])
def test_enrichment(spark, hint):
    rows = fields(spark, [("e", i, "n", d, "old", False, "") for i, d in enumerate(["341", "9", None])])
    mapping = spark.createDataFrame([("341", "P")], "database_id string, category string")
    got = E.enrich_fields(rows.hint("merge") if hint == "merge" else rows, mapping)
    assert [r.category for r in got.orderBy("pos").collect()] == ["P", None, None]
    stats = E.enrichment_stats(got)
    assert stats.first().category_coverage_percentage == 33.3
    failed = spark.createDataFrame([("x",)], "entity string")
    summary = E.enrichment_summary(stats, failed).first()
    assert (summary.total_entities, summary.failed_entities) == (2, 1)
    with pytest.raises(ValueError):
        E.require_mapping(mapping.limit(0))


def test_profile_mode_takes_smallest_on_ties(spark):
    rows = spark.createDataFrame(
        [("f", [0] * n, n > 1) for n in (3, 3, 1, 1, 7)],
        "name string, values array<int>, is_multi_valued boolean",
    )
    p = M.multi_value_profile(rows).first()
    assert (p.typical_value_count, p.min_value_count, p.max_value_count) == (1, 1, 7)
    assert (p.avg_value_count, p.multi_valued_percentage) == (3.0, 60.0)
    assert p.multi_valued_count + p.single_valued_count == p.entities_analyzed


def test_separator_census_is_disjoint(spark):
    rows = spark.createDataFrame([("a<br>b<br/>c<br />d<BR>",), (None,), ("x<Br>",)], "data string")
    c = M.separator_census(rows).first().asDict()
    assert (c["br"], c["br_slash"], c["br_space_slash"], c["upper_br"]) == (1, 1, 1, 1)
    assert (c["total"], c["other"]) == (5, 1)


def test_coverage_counts_entities_once(spark):
    rows = [("a", 0, "f"), ("a", 1, "f"), ("b", 0, "f"), ("c", 0, "g")]
    df = fields(spark, [(e, p, n, "1", None, False, "x") for e, p, n in rows])
    got = {r.name: r for r in C.field_catalog(df).collect()}
    assert got["f"].coverage_percentage == 66.7 and got["f"].n_occurrences == 3
    assert got["f"].coverage_band == "common" and got["g"].coverage_band == "rare"


def test_band_uses_counts_not_rounded_share(spark):
    registry = spark.createDataFrame([("f", 2999), ("g", 3000), ("h", 1)], "name string, n_entities long")
    got = {r.name: r for r in C.coverage(registry, spark.createDataFrame([(3000,)], "n long")).collect()}
    assert got["f"].coverage_percentage == 100.0 and got["f"].coverage_band == "common"
    assert got["g"].coverage_band == "universal"
    assert sum(C.coverage_bands(C.coverage(registry, spark.createDataFrame([(3000,)], "n long"))).first()) == 3


def test_first_seen_attributes(spark):
    df = fields(spark, [("b", 0, "f", "2", "B", True, ""), ("a", 5, "f", "1", "A", False, ""), ("a", 3, "f", "0", None, True, "")])
    r = C.field_registry(df).first()
    assert (r.database_id, r.category, r.has_ranking) == ("0", None, True)


@pytest.mark.parametrize("per_bucket", [1, 2, 1000])
def test_missing_entities_in_any_number_of_buckets(spark, per_bucket):
    df = sample(spark)
    everyone = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "entity string")
    got = {tuple(r) for r in C.missing_entities(df, everyone, per_bucket).collect()}
    have = {("a", "Area"), ("a", "Site"), ("b", "Area"), ("b", "Money"), ("c", "Area")}
    assert got == {(e, n) for e in "abcd" for n in ("Area", "Site", "Money")} - have


def test_leaf_rows_equal_the_sum_of_leaves(spark):
    refined = R.refine_fields(sample(spark))
    leaves = R.leaf_rows(refined)
    summary = O.export_summary(refined).first()
    assert summary.total_rows == leaves.count() == 2 + 3 + 1 + 3 + 0 + 1
    assert (summary.total_entities, summary.total_fields) == (3, 6)
    orders = {(r.name, r.value): r.order for r in leaves.collect()}
    assert orders[("Site", "z")] == 2 and orders[("Money", "n")] == 2


def test_export_header_and_filters(spark):
    rows = O.export_rows(R.value_rows(O.filter_fields(sample(spark), ["a", "b"], ["Geo"])), with_year=True)
    assert rows.columns[:3] == ["Entity", "Entity Slug", "Field Name"] and rows.columns[-1] == "Year"
    got = sorted((r["Entity"], r["Key"], r["Value"], r["Year"]) for r in rows.collect())
    assert got == [("a", "-", "1 km (2001)", "2001"), ("a", "-", "2 km", None), ("b", "-", "3", None)]


def test_documents_refined_in_place_equal_exploded_rows(spark, sf_dir):
    pages = derived(spark, sf_dir, "landed").withColumn("scraped_at", F.lit("2025-01-01"))
    docs = P.parse_pages(pages)
    nested = R.refine_documents(docs).select("entity", F.explode("data.fields").alias("f"))
    flat = R.refine_fields(R.explode_fields(docs))
    cols = ["name", "database_id", "structure_type", "is_multi_valued", "values"]
    a = nested.select("entity", *[F.to_json(F.struct(f"f.{c}")).alias(c) for c in cols])
    b = flat.select("entity", *[F.to_json(F.struct(c)).alias(c) for c in cols])
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert "Exchange" not in R.refine_documents(P.parse_pages(
        spark.createDataFrame([("e", "u", "s", "{}")], "entity string, source_url string, scraped_at string, body string")
    ))._jdf.queryExecution().executedPlan().toString()


def test_page_validation(spark):
    bodies = ["{broken", '{"result":[1]}', '{"result":{"data":{"z":1}}}', None, '{"result":{"data":{"country":null}}}', '{"data":{"fields":1}}']
    df = spark.createDataFrame([(str(i), "u", b) for i, b in enumerate(bodies)], "entity string, source_url string, body string")
    parsed = P.parse_bodies(df)
    assert [r.is_valid for r in parsed.orderBy("entity").collect()] == [False] * 4 + [True, False]
    kinds = parsed.select("entity", P.page_kind(F.col("doc")).alias("k")).orderBy("entity")
    assert [r.k for r in kinds.collect()] == ["invalid"] * 4 + ["entity", "entity"]
    assert {r.body for r in P.quarantine(parsed).collect()} == {*bodies[:4], bodies[5]}


def test_page_nodes_are_isolated(spark):
    body = (
        '{"result":{"data":{"country":{"name":"X","updated":"May 2024"},"fields":{"nodes":[7,'
        '{"name":"a","data":" <b>é</b>\\n","fieldLabel":[{"databaseId":341,"rank":{"x":1}}],'
        '"subfields":[{"label":"l"},{"label":null},3],"media":[{"type":"t","localFile":null},'
        '{"type":"t","localFile":{"publicURL":"/u"}},{"type":"","localFile":{"publicURL":"/v"}}]},'
        '{"fieldLabel":"odd","subfields":"odd","media":null}]}}}}'
    )
    df = spark.createDataFrame([("x", "u", "t", body)], "entity string, source_url string, scraped_at string, body string")
    a, b = P.page_fields(P.parse_bodies(df)).orderBy("pos").collect()
    assert (a.pos, a.data, a.database_id, a.has_ranking, a.subfields) == (1, " <b>é</b>\n", "341", True, ["l"])
    assert [m.url for m in a.media] == ["/u"]
    assert (b.pos, b.name, b.database_id, b.has_ranking, b.subfields, b.media) == (2, None, None, False, [], [])
    doc = P.parse_pages(df).first()
    assert doc.data.metadata.field_count == 3 and doc.data.metadata.updated == "2024-05-01"
    assert len(doc.data.fields) == 2


def test_urls(spark):
    p = "/almanac"
    paths = ["/countries/france/", "/countries/france/locator-map/", "/countries/france/factsheets", "/countries/france/travel-facts/", "/countries/france/a/b/", "/references/"]
    df = spark.createDataFrame([(i, p + x) for i, x in enumerate(paths)], "i int, url string")
    got = df.select("i", U.is_entity_url(F.col("url"), p).alias("ok"), U.slug_and_type(F.col("url"), p).alias("s")).orderBy("i").collect()
    assert [r.ok for r in got] == [True] * 5 + [False]
    assert [(r.s.slug, r.s.type) for r in got] == [("france", "main"), ("france", "locator_map"), ("france", "factsheet"), ("france", "travel_facts"), (None, None), (None, None)]
    one = spark.createDataFrame([("https://h/almanac/countries/france/?q=1#x",)], "url string")
    assert one.select(U.page_data_url(F.col("url"), "B", p)).first()[0] == "B/page-data/countries/france/page-data.json"


def test_url_index_last_wins_and_others_keep_order(spark):
    urls = ["/countries/a", "/countries/a/zoo", "/countries/a/b1", "/countries/a/zoo/", "/countries/a/", "/countries/b/flag"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "pos long, url string")
    pages = I.entity_urls(df, "B", "")
    rows = {r.slug: r for r in I.url_index(pages).collect()}
    others = [(r.slug, r.url) for r in I.other_urls(pages).orderBy("slug", "pos").collect()]
    assert others == [("a", f"B/page-data/countries/a/{x}/page-data.json") for x in ("zoo", "b1")]
    assert (rows["a"].other_count, rows["b"].main, rows["b"].other_count) == (2, None, 0)
    counts = I.url_type_counts(I.url_index(pages)).first()
    assert (counts.total_entities, counts.total_urls, counts.main, counts.flag, counts.other) == (2, 5, 1, 1, 2)


def test_diff(spark):
    schema = "entity string, name string, key string, `order` int, value string"
    side = lambda rows: spark.createDataFrame([("e", n, None, 0, v) for n, v in rows], schema)
    old, new = side([("1", "x"), ("2", None), ("3", "z")]), side([("1", "y"), ("2", None), ("4", "q")])
    got = {r.name: r.status for r in S.snapshot_diff(old, new).collect()}
    assert got == {"1": "changed", "2": "unchanged", "3": "removed", "4": "added"}
    assert {r.status for r in S.snapshot_diff(old, old).collect()} == {"unchanged"}
    twice = side([("1", "x"), ("1", "x"), ("1", "w")])
    bag = sorted((r.status, r.copies) for r in S.snapshot_diff(twice, side([("1", "x"), ("1", "v")])).collect())
    assert bag == [("added", 1), ("removed", 1), ("removed", 1), ("unchanged", 1)]


def test_quality_rules_accept_refined_output(spark):
    checked = Q.with_violations(R.refine_fields(sample(spark)))
    assert {v for r in checked.collect() for v in r.violations} == {"empty_values"}
    raw = spark.createDataFrame([(1, [("a",), ("b",)]), (2, [(None,)]), (3, None), (4, [("a",)] * 3 + [(None,)])], "i int, f array<struct<name:string>>")
    assert [r.v for r in raw.select("i", Q.is_valid_raw(F.col("f")).alias("v")).orderBy("i").collect()] == [True, False, False, True]


def test_fetch_classes(spark):
    cases = [(404, None, "not_found"), (503, None, "server_error"), (403, "timeout", "client_error"), (None, "timeout", "timeout"), (None, "connection", "network_error"), (200, "json_decode", "json_parse_error"), (None, "http", "client_error"), (None, None, "unknown")]
    df = spark.createDataFrame([(i, s, e) for i, (s, e, _) in enumerate(cases)], "i int, s int, e string")
    got = df.select("i", L.error_class(F.col("s"), F.col("e")).alias("c")).orderBy("i").collect()
    assert [r.c for r in got] == [c for *_, c in cases]


def test_same_result_for_any_number_of_shuffle_partitions(spark, sf_dir):
    def profile(n):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            rows = M.multi_value_profile(R.refine_fields(derived(spark, sf_dir, "fields"))).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        return sorted(map(tuple, rows))

    assert profile("1") == profile("64")


def test_one_parse_per_body(spark):
    bodies = spark.createDataFrame([("e", "u", "s", "{}")], "entity string, source_url string, scraped_at string, body string")
    parsed = P.parse_bodies(bodies)
    for frame in (P.page_metadata(parsed), P.page_assets(parsed), P.page_fields(parsed), P.quarantine(parsed), P.parse_pages(bodies)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.lower().count("parse_json") + plan.lower().count("parsejson") == 1, plan


def test_diff_shuffles_twice_and_joins_nothing(spark):
    side = spark.createDataFrame([("e", "n", "k", 0, "v")], "entity string, name string, key string, `order` int, value string")
    plan = S.snapshot_diff(side, side)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def test_counting_needs_no_years(spark):
    rows = fields(spark, [("e", 0, "n", None, None, False, "a (2001)<br>b")])
    full, lean = R.refine_fields(rows), R.refine_fields(rows, years=False)
    assert full.schema == lean.schema
    assert "[0-9]{4}" not in lean._jdf.queryExecution().optimizedPlan().toString()
    assert [len(d.first()["values"]) for d in (full, lean)] == [2, 2]


def test_field_diff_equals_the_diff_of_all_values(spark):
    from fieldmill.operators.refine import value_rows

    def side(rows):
        frame = spark.createDataFrame(rows, "entity string, name string, data string, media string")
        return frame.repartition(3)

    text = "<strong>a:</strong> 1<br><strong>b:</strong> 2"
    same = [(f"e{i}", f"n{i % 4}", f"v{i}<br>w", None) for i in range(40)] + [("p", "q", text, None)]
    old = same + [("x", "gone", "1", None), ("x", "edited", "1<br>2", None), ("x", "twice", "1", None), ("x", "twice", "1", None)]
    old += [(None, "n", "1", None), ("y", None, None, None), ("z", "n", None, None)]
    new = same + [("x", "come", "1", None), ("x", "edited", "1<br>3", None), ("x", "twice", "1", None), ("x", "twice", "2", None)]
    new += [(None, "n", "2", None), ("y", None, "1", None), ("z", "n", None, None)]
    for a, b in ((old, new), (new, old), (old, old), (old, old[:0] or same[:1])):
        got = S.field_diff(side(a), side(b), value_rows, ("data",)).collect()
        want = S.snapshot_diff(value_rows(side(a)), value_rows(side(b))).collect()
        assert sorted(map(str, got)) == sorted(map(str, want))
    changed = S.changed_fields(side(old), side(new), ("data",)).count()
    assert changed == 6  # gone, come, edited, twice and the two with a null


def test_field_diff_shuffles_hashes_and_changed_fields_only(spark):
    from fieldmill.operators.refine import value_rows

    side = spark.createDataFrame([("e", "n", "x", None)], "entity string, name string, data string, media string")
    plan = S.field_diff(side, side, value_rows, ("data",))._jdf.queryExecution().optimizedPlan().toString()
    union = plan.splitlines()
    same = "\n".join(union[1 : next(i for i, line in enumerate(union) if i > 1 and line.startswith("+- "))])
    # the branch of unchanged fields: one anti join with the hashes, no aggregate of values above it
    assert "LeftAnti" in same and same.index("LeftAnti") < same.index("Aggregate")
    assert "Window" not in same


def test_snapshot_diff_moves_rows_once(spark):
    side = "entity string, name string, key string, order int, value string"
    old = spark.createDataFrame([("a", "f", None, 0, "1"), ("a", "f", None, 1, "x"), ("b", "f", "k", 0, None)], side)
    new = spark.createDataFrame([("a", "f", None, 0, "2"), ("a", "f", None, 1, "x"), ("b", "f", "k", 0, None)] * 2, side)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        diff = S.snapshot_diff(old, new, tasks=5)
        plan = diff._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        assert diff.rdd.getNumPartitions() == 5
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted((r.entity, r.order, r.status, r.copies) for r in diff.collect()) == [
        ("a", 0, "added", 2),
        ("a", 0, "removed", 1),
        ("a", 1, "added", 1),
        ("a", 1, "unchanged", 1),
        ("b", 0, "added", 1),
        ("b", 0, "unchanged", 1),
    ]


def test_snapshot_diff_query_moves_fields_but_no_values(spark, tmp_path):
    import duckdb

    from workload.compare import difference
    from workload.queries import QUERIES

    # lines with and without keys, some of them twice
    con, path = duckdb.connect(), tmp_path / "lineitem.parquet"
    lines = """
SELECT CASE WHEN i % 11 <> 5 THEN i // 3 END AS l_orderkey, CASE WHEN i % 13 <> 6 THEN i * 37 % 211 END AS l_partkey,
  CAST(i % 7 + 1 AS INT) AS l_linenumber, CAST(i % 50 AS DOUBLE) AS l_quantity, i * 1.5::DOUBLE AS l_extendedprice,
  CASE WHEN i % 17 <> 8 THEN (i % 10) / 100.0::DOUBLE END AS l_discount, substr('AN', 1 + i % 2, 1) AS l_returnflag,
  TIMESTAMP '1994-03-01' + to_days(CAST(i AS INT)) AS l_shipdate FROM range(400) r(i)"""
    con.execute(f"COPY ({lines} UNION ALL {lines} WHERE i % 4 = 1) TO '{path}' (FORMAT parquet)")
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{path}'")
    plan = QUERIES["snapshot_diff"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    compared, sides = plan.split("Union", 1)
    assert "Exchange" not in compared
    # a side's one exchange is below all that reads its text
    assert sides.count("Exchange") == 2 and sides.index("Generate") < sides.index("Exchange")
    for name in ("snapshot_diff", "snapshot_diff_summary"):
        assert difference(spark, con, name, str(tmp_path)) is None
    seen = {(r.status, r.copies > 1) for r in QUERIES["snapshot_diff"](spark, str(tmp_path)).collect()}
    assert {status for status, _ in seen} == {"added", "removed", "changed", "unchanged"} and ("unchanged", True) in seen
