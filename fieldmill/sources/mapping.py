"""The category mapping: stored file, category pages, and the choice between several pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmill.operators.joins import last_value_by
from fieldmill.operators.pages import member, page_kind
from fieldmill.schemas import CATEGORY_MAPPING


def mapping_rows(docs: DataFrame) -> DataFrame:
    """``database_id, category`` rows of stored mapping documents (column ``mapping``)."""
    return docs.select(F.explode("mapping").alias("database_id", "category"))


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Stored mapping files as a two-column dimension; a missing file is an empty one.

    Of an id that comes several times the last wins, by file name and then place in the file.
    """
    try:
        docs = spark.read.schema(CATEGORY_MAPPING).option("multiLine", True).json(path)
    except Exception as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], "database_id string, category string")
    placed = docs.select(
        F.input_file_name().alias("_file"),
        F.posexplode("mapping").alias("_at", "database_id", "category"),
    )
    last = F.max_by("category", F.struct("_file", "_at"))
    return placed.groupBy("database_id").agg(last.alias("category"))


def _category_nodes(doc: Column) -> Column:
    # the page may be wrapped in ``result`` or not
    return F.coalesce(
        member(doc, "data.allLaunchpadCategory.nodes", "array<variant>"),
        member(doc, "result.data.allLaunchpadCategory.nodes", "array<variant>"),
    )


def extract_mapping(pages: DataFrame) -> DataFrame:
    """``database_id, category`` from category pages ``page_no, body``.

    Blank names and falsy ids are skipped; where an id comes twice the later place wins, in the
    order page, category node, label.
    """
    nodes = pages.select(
        "page_no",
        F.posexplode(_category_nodes(F.try_parse_json("body"))).alias("node_no", "_node"),
    )
    labels = nodes.select(
        "page_no",
        "node_no",
        member(F.col("_node"), "name").alias("category"),
        F.posexplode(member(F.col("_node"), "fieldLabels", "array<variant>")).alias(
            "label_no", "_label"
        ),
    ).select(
        "page_no",
        "node_no",
        "label_no",
        "category",
        member(F.col("_label"), "databaseId").alias("database_id"),
    )
    usable = (F.col("category") != "") & ~F.col("database_id").isin("", "0", "false", "null")
    # the place as one number, so that finding the last place needs no sort
    billion = F.lit(10**9).cast("decimal(38,0)")
    node_place = F.col("page_no").cast("decimal(38,0)") * billion + F.col("node_no")
    place = node_place * billion + F.col("label_no")
    placed = labels.filter(usable).select(
        "database_id", "category", place.cast("decimal(38,0)").alias("_place")
    )
    return last_value_by(placed, ["database_id"], "category", "_place")


def preferred_pages(pages: DataFrame) -> DataFrame:
    """Of category pages ``priority, body`` those of the smallest priority with a usable page."""
    checked = pages.withColumn("_kind", page_kind(F.try_parse_json("body")))
    usable = checked.filter(F.col("_kind") != "invalid")
    best = usable.agg(F.min("priority").alias("priority"))
    return usable.filter(F.col("priority") == best.scalar()).drop("_kind")
