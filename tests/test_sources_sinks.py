"""Readers, writers and whole runs over files the tests write themselves."""

import json

import pytest
from pyspark.sql import functions as F

from fieldmill.operators import pages as P
from fieldmill.operators.enrich import enrich_fields
from fieldmill.plans import runs
from fieldmill.sinks import tables as S
from fieldmill.sources import documents, mapping, sitemap, snapshots
from fieldmill.sources.export import read_export
from fieldmill.sources.index import filter_index, read_index, read_index_documents, read_other_urls
from fieldmill.streaming import stream_values


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def page(name, data, extra=""):
    node = {"name": name, "data": data, "fieldLabel": [{"databaseId": 5}], "subfields": [], "media": []}
    return json.dumps({"result": {"data": {"country": {"name": "N " + extra}, "fields": {"nodes": [node]}}}})


def test_documents_with_a_broken_file(spark, tmp_path):
    good = {"entity": "a", "scrape_success": True, "data": {"fields": [{"name": "f", "data": "x"}]}}
    write(tmp_path / "a.json", json.dumps(good, indent=1))
    write(tmp_path / "b.json", "{broken")
    write(tmp_path / "c.json", '{"data": {"fields": [{"data": "no name"}]}}')
    write(tmp_path / ".hidden.json", "{}")
    docs = documents.read_documents(spark, str(tmp_path))
    assert [r.file_entity for r in documents.valid_documents(docs).collect()] == ["a"]
    bad = {r.entity: r for r in documents.invalid_documents(docs).collect()}
    assert set(bad) == {"b", "c"} and bad["b"].body == "{broken" and bad["b"].error == "unreadable"


def test_mapping_file(spark, tmp_path):
    write(tmp_path / "m.json", json.dumps({"metadata": {"total_fields": 2}, "mapping": {"1": "A", "2": "B"}}))
    rows = mapping.read_mapping(spark, str(tmp_path / "m.json"))
    assert {tuple(r) for r in rows.collect()} == {("1", "A"), ("2", "B")}
    assert mapping.read_mapping(spark, str(tmp_path / "absent.json")).isEmpty()
    write(tmp_path / "n.json", json.dumps({"mapping": {"2": "C"}}))
    both = mapping.read_mapping(spark, str(tmp_path))
    assert {tuple(r) for r in both.collect()} == {("1", "A"), ("2", "C")}
    fields = spark.createDataFrame([("e", 0, "2"), ("e", 1, None)], "entity string, pos int, database_id string")
    twice = both.union(spark.createDataFrame([("2", "B")], both.schema))
    assert [r.category for r in enrich_fields(fields, twice).orderBy("pos").collect()] == ["C", None]


def test_mapping_last_node_wins_and_fallback(spark):
    def body(*nodes):
        return json.dumps({"data": {"allLaunchpadCategory": {"nodes": [{"name": n, "fieldLabels": [{"databaseId": i} for i in ids]} for n, ids in nodes]}}})

    rows = [(1, 0, '{"z": 1}'), (2, 1, body(("A", [1, 2, None, 0]), ("", [3]), ("B", ["1"]))), (3, 2, body(("C", [9])))]
    pages = spark.createDataFrame(rows, "priority int, page_no long, body string")
    chosen = mapping.preferred_pages(pages)
    assert {tuple(r) for r in mapping.extract_mapping(chosen).collect()} == {("1", "B"), ("2", "A")}


SITEMAP = '<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">{}</urlset>'


def test_sitemap_files_and_index(spark, tmp_path):
    urls = ["https://h/s/countries/a/", "https://h/s/countries/a/flag/", "https://h/s/about/", "https://h/s/countries/b/"]
    write(tmp_path / "in" / "s.xml", SITEMAP.format("".join(f"<url><loc>{u}</loc></url>" for u in urls)))
    write(tmp_path / "in" / "i.xml", '<sitemapindex><sitemap><loc>https://h/child.xml</loc></sitemap></sitemapindex>')
    got = {r.url for r in sitemap.read_sitemap(spark, str(tmp_path / "in")).collect()}
    assert got == {*urls, "https://h/child.xml"}
    runs.discover_entities(spark, str(tmp_path / "in"), str(tmp_path / "out"), "https://h/s", "/s")
    index = read_index(spark, str(tmp_path / "out"))
    assert [(r.slug, r.other_count) for r in index.orderBy("slug").collect()] == [("a", 0), ("b", 0)]
    assert [r.slug for r in filter_index(index, ["b"]).collect()] == ["b"]
    assert read_other_urls(spark, str(tmp_path / "out")).isEmpty()
    meta = spark.read.json(str(tmp_path / "out" / "metadata")).first()
    assert (meta.total_entities, meta.total_urls, meta.flag) == (2, 3, 1)
    assert meta.sitemap_url == str(tmp_path / "in")


@pytest.mark.parametrize("split", ["400b", "128m"])
def test_sitemap_order_follows_files_not_splits(spark, tmp_path, split):
    links = lambda us: "".join(f"<url><loc>https://h/s/countries/{u}</loc></url>" for u in us)
    write(tmp_path / "a.xml", SITEMAP.format(links(["x/?1", "x/?2"])))
    write(tmp_path / "b.xml", "<sitemapindex><sitemap><loc>https://h/c.xml</loc></sitemap></sitemapindex>")
    write(tmp_path / "c.xml", SITEMAP.format(links([f"x/?{k}" for k in range(3, 40)])))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = [r.url for r in sitemap.read_sitemap(spark, str(tmp_path)).orderBy("pos").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [f"https://h/s/countries/x/?{k}" for k in range(1, 40)]
    assert got == [*want[:2], "https://h/c.xml", *want[2:]]


def test_broken_sitemaps_do_not_stop_the_others(spark):
    url = "<url><loc>{}</loc></url>"
    cases = [
        (SITEMAP.format(url.format("a&amp;b") + "<url/>" + url.format("<![CDATA[ c ]]>")), ["a&b", "c"], None),
        ("<!-- x --><sitemapindex><sitemap><loc>d</loc></sitemap></sitemapindex>", ["d"], None),
        (SITEMAP.format(""), [], None),
        (SITEMAP.format(url.format("e"))[:-12], [], "unreadable"),
        ("no markup", [], "unreadable"),
        ("<html><url><loc>q</loc></url></html>", [], "not a sitemap"),
        ("", [], "empty"),
        (None, [], "empty"),
    ]
    docs = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "doc_no long, xml string")
    read = sitemap.parse_sitemaps(docs.repartition(3)).orderBy("doc_no").collect()
    assert [(r.urls, r.error) for r in read] == [c[1:] for c in cases]
    assert [r.url for r in sitemap.sitemap_urls(docs).orderBy("pos").collect()] == ["a&b", "c", "d"]
    assert sitemap.sitemap_quarantine(docs).count() == 5
    assert sitemap.sitemap_urls(docs.limit(0)).count() == 0


def files_below(path):
    return {str(f): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_replacing_few_entities_leaves_other_files_alone(spark, tmp_path):
    table = str(tmp_path / "t")
    df = spark.range(10_000).selectExpr("CAST(id AS STRING) AS entity", "id AS v")
    S.write_entities(df, table, "2025-01-01")
    before = files_below(tmp_path)
    S.replace_entities(df.where("id = 77").withColumn("v", F.lit(-1)), table, "2025-01-01", ["77"])
    after = files_below(tmp_path)
    bucket = snapshots.buckets_of(spark, ["77"])
    changed = {f for f in before.keys() | after.keys() if before.get(f) != after.get(f)}
    assert changed and all(f"entity_bucket={bucket[0]}/" in f for f in changed)
    rows = snapshots.read_snapshot(spark, table)
    assert rows.count() == 10_000 and rows.where("v = -1").collect()[0].entity == "77"
    # an entity without rows goes, a bucket without rows too
    small = str(tmp_path / "s")
    S.write_entities(df.where("id < 2"), small, "2025-01-01")
    S.replace_entities(df.limit(0), small, "2025-01-01", ["1", "absent"])
    assert [r.entity for r in snapshots.read_snapshot(spark, small).collect()] == ["0"]
    # only the asked entities' buckets are read
    asked = snapshots.read_snapshot(spark, table, entities=["77", "78"])
    assert asked.count() == 2 and len(asked.inputFiles()) <= 64
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "entity_bucket" in plan.split("PartitionFilters:")[1].split("]")[0]
    S.write_entities(df.limit(0), table, "2025-01-01")
    assert snapshots.list_snapshots(spark, table) == []


def test_one_partition_of_a_dated_table_is_read(spark, tmp_path):
    table = str(tmp_path / "t")
    for month in range(1, 7):
        S.write_snapshot(spark.range(month), table, f"2025-0{month}-01")
    newest = snapshots.latest_snapshot(spark.read.parquet(table))
    assert newest.count() == 6
    newest.collect()
    scans = [node for node in leaves(newest._jdf.queryExecution().executedPlan()) if "FileSourceScan" in node.getClass().getName()]
    read = [node.metrics().get("numPartitions").get().value() for node in scans if node.metrics().contains("numPartitions")]
    assert 1 in read
    assert len(snapshots.read_snapshot(spark, table, "2025-03-01").inputFiles()) <= 8


def leaves(plan):
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    if "QueryStageExec" in plan.getClass().getSimpleName():
        plan = plan.plan()
    found = [plan]
    children = plan.children()
    for i in range(children.size()):
        found += leaves(children.apply(i))
    return found


def test_order_of_stored_rows(spark, tmp_path):
    rows = spark.range(1000).selectExpr("CAST(pmod(id * 7919, 1000) AS STRING) AS slug").repartition(5)
    S.write_in_order(rows, str(tmp_path / "i"), "slug")
    read = {r.slug: r.place for r in snapshots.read_in_order(spark, str(tmp_path / "i")).collect()}
    assert [s for s, _ in sorted(read.items(), key=lambda x: x[1])] == sorted(read)
    assert sorted(read.values()) == list(range(1000))


def test_export_files_keep_quotes_and_header(spark, tmp_path):
    header = ["Entity", "Category", "Key", "Value", "Order", "Has Ranking"]
    data = [('a "b", c', "x, y", None, 'l1\nl2 "q"\\', 0, True), ("d", "Unknown", "", "e", 1, False)]
    rows = spark.createDataFrame(data, "a string, b string, c string, d string, e int, f boolean").toDF(*header)
    for fmt in ("csv", "parquet"):
        S.write_export(rows, rows.groupBy().count(), str(tmp_path / fmt), fmt)
        read = read_export(spark, str(tmp_path / fmt), fmt)
        assert read.columns == header and read.dtypes == rows.dtypes
        # a CSV file can't tell an empty text from none
        same = lambda r: tuple(v or None if isinstance(v, str) else v for v in r)
        assert sorted(map(same, read.collect()), key=str) == sorted(map(same, data), key=str)
        one = read_export(spark, str(tmp_path / fmt), fmt, ["x, y"])
        assert one.count() == 1
        filters = one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters:")[1]
        assert "x, y" in filters.split("PushedFilters")[0]


def test_index_file(spark, tmp_path):
    entity = {"slug": "a", "urls": {"main": "u", "other": ["v"]}}
    write(tmp_path / "i.json", json.dumps({"entities": [entity, {"slug": "b", "urls": {}}]}))
    rows = read_index_documents(spark, str(tmp_path / "i.json"))
    assert [r.other_count for r in rows.orderBy("slug").collect()] == [1, 0]
    assert filter_index(rows, ["a"]).first().main == "u" and filter_index(rows).count() == 2


def test_snapshots(spark, tmp_path):
    table = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        snapshots.resolve_snapshot(spark, table)
    for date, n in (("2025-01-01", 3), ("2025-02-01", 5), ("2025-01-01", 4)):
        S.write_snapshot(spark.range(n), table, date)
    assert snapshots.list_snapshots(spark, table) == ["2025-01-01", "2025-02-01"]
    assert snapshots.read_snapshot(spark, table).count() == 5
    assert snapshots.read_snapshot(spark, table, "2025-01-01").count() == 4
    assert snapshots.latest_snapshot(spark.read.parquet(table)).count() == 5
    for bad, error in (("2025-1-1", ValueError), ("2025-03-01", FileNotFoundError)):
        with pytest.raises(error):
            snapshots.read_snapshot(spark, table, bad)


def test_runs_end_to_end(spark, tmp_path):
    root, landed = str(tmp_path / "root"), tmp_path / "landed"
    write(landed / "a.json", page("Area", "1 km (2001)<br>2 km", "a"))
    write(landed / "b.json", page("Area", "<strong>x</strong><br>p<br>q", "b"))
    write(landed / "c.json", '{"result": 1}')
    pages = documents.read_landed_pages(spark, str(landed))
    dim = spark.createDataFrame([("5", "Geo")], "database_id string, category string")

    assert runs.land_snapshot(spark, pages, root, "2025-01-01") == "2025-01-01"
    meta = spark.read.json(f"{root}/reports/2025-01-01/metadata").first()
    assert (meta.total_entities, meta.successful, meta.failed, meta.total_fields) == (3, 2, 1, 2)
    runs.refine_snapshot(spark, root, dim)
    top = spark.read.json(f"{root}/reports/2025-01-01/multi_value_top").first()
    assert (top.field_name, top.multi_valued_percentage) == ("Area", 50.0)
    runs.catalog_snapshot(spark, root)
    bands = spark.read.json(f"{root}/reports/2025-01-01/coverage_bands").first()
    assert bands.universal_fields == 1
    runs.export_snapshot(spark, root, str(tmp_path / "x"), categories=["Geo"], with_year=True)
    rows = spark.read.parquet(str(tmp_path / "x" / "fields"))
    assert rows.count() == 4 and {r.Category for r in rows.collect()} == {"Geo"}
    runs.export_snapshot(spark, root, str(tmp_path / "csv"), entities=["a"], fmt="csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv" / "fields")).count() == 2
    with pytest.raises(ValueError):
        runs.export_snapshot(spark, root, str(tmp_path / "y"), categories=["none"])

    write(landed / "a.json", page("Area", "1 km (2001)<br>3 km", "a"))
    runs.land_snapshot(spark, documents.read_landed_pages(spark, str(landed)), root, "2025-02-01")
    runs.refine_snapshot(spark, root, dim, "2025-02-01")
    runs.refine_snapshot(spark, root, dim, "2025-02-01", entities=["a"])
    for table in ("enriched", "refined"):
        kept = snapshots.read_snapshot(spark, f"{root}/{table}", "2025-02-01")
        assert sorted(r.entity for r in kept.collect()) == ["a", "b"]
    other = spark.createDataFrame([("5", "Other")], dim.schema)
    runs.refine_snapshot(spark, root, other, "2025-02-01", entities=["a"])
    kept = snapshots.read_snapshot(spark, f"{root}/refined", "2025-02-01")
    assert {r.entity: r.category for r in kept.collect()} == {"a": "Other", "b": "Geo"}
    runs.refine_snapshot(spark, root, dim, "2025-02-01", entities=["a"])
    diff = runs.compare_snapshots(spark, root, "2025-01-01", "2025-02-01")
    assert sorted(r.status for r in diff.collect()) == ["changed", "unchanged", "unchanged", "unchanged"]


def test_landing_again(spark, tmp_path):
    root = str(tmp_path / "root")

    def land(date, *bodies):
        rows = [(f"e{i}", "u", b) for i, b in enumerate(bodies)]
        pages = spark.createDataFrame(rows, "entity string, source_url string, body string")
        pages = pages.withColumn("scraped_at", F.lit("t"))
        assert runs.land_snapshot(spark, pages, root, date) == date
        meta = spark.read.json(f"{root}/reports/{date}/metadata").first()
        assert meta.snapshot_date == date and meta.duration_seconds >= 0
        return meta.total_entities, meta.failed

    assert land("2025-01-01", page("f", "x"), page("f", "y"), "{bad") == (3, 1)
    assert land("2025-01-01", page("f", "x"), page("f", "y")) == (2, 0)
    assert land("2025-02-01", "{bad", "[]") == (2, 2)
    assert snapshots.list_snapshots(spark, f"{root}/raw") == ["2025-01-01"]
    assert spark.read.json(f"{root}/reports/2025-01-01/metadata").first().failed == 0
    assert land("2025-01-01", "{bad") == (1, 1)
    assert snapshots.list_snapshots(spark, f"{root}/raw") == []


def test_landing_parses_each_page_once(spark, tmp_path):
    rows = [(f"e{i}", "u", page("f", "x") if i % 3 else "{bad") for i in range(30)]
    pages = spark.createDataFrame(rows, "entity string, source_url string, body string")
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            calls.add(len(batch))
            yield batch

    pages = pages.withColumn("scraped_at", F.lit("t"))
    pages = pages.mapInPandas(counted, pages.schema)
    root = str(tmp_path / "root")
    runs.land_snapshot(spark, pages, root, "2025-01-01")
    assert calls.value == 30  # the pages were read, and so parsed, once in the whole run
    plan = P.landed_rows(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parse_json") == plan.lower().count("parse_json(body") <= 1
    raw = snapshots.read_snapshot(spark, f"{root}/raw").collect()
    assert len(raw) == 20 and all(r.scrape_success and r.body is None for r in raw)
    bad = snapshots.read_snapshot(spark, f"{root}/quarantine").collect()
    assert {(r.body, r.error) for r in bad} == {("{bad", P.PAGE_ERROR)} and len(bad) == 10
    assert not [f for f in (tmp_path / "root").iterdir() if f.name.startswith("_landing")]


def test_stream_gives_the_batch_result(spark, tmp_path):
    df = spark.createDataFrame([("a", page("f", "x<br>y (2020)")), ("b", "{bad")], "entity string, body string")
    df.write.parquet(str(tmp_path / "in"))
    query = (
        stream_values(spark, str(tmp_path / "in"))
        .writeStream.format("memory")
        .queryName("stream_out")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    got = sorted((r.value, r.year) for r in spark.table("stream_out").collect())
    assert got == [("x", None), ("y (2020)", "2020")]


def test_quarantine_keeps_the_body(spark):
    df = spark.createDataFrame([("a", "u", "{bad")], "entity string, source_url string, body string")
    assert P.quarantine(P.parse_bodies(df)).select(F.col("body")).first()[0] == "{bad"
