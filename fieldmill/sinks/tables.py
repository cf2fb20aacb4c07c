"""Snapshot tables, reports, the URL index and the flat export."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fieldmill.operators.url_index import other_urls, url_index, url_type_counts
from fieldmill.sources.export import CATEGORY_PART
from fieldmill.sources.snapshots import (
    BUCKET,
    ENTITY_BUCKETS,
    PARTITION,
    buckets_of,
    entity_bucket,
    parse_snapshot_date,
)



def run_date(snapshot: str | None = None) -> str:
    """The date of a run: the given one, or today in UTC.  Ask once and pass it to every write."""
    day = parse_snapshot_date(snapshot) if snapshot else dt.datetime.now(dt.timezone.utc).date()
    return day.isoformat()


def with_snapshot_date(df: DataFrame, snapshot: str | None = None) -> DataFrame:
    """Add the partition column: the given date, or today in UTC."""
    return df.withColumn(PARTITION, F.lit(parse_snapshot_date(run_date(snapshot))))


def _folder(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _delete(spark: SparkSession, folder: str) -> None:
    files, path = _folder(spark, folder)
    files.delete(path, True)


def _names(spark: SparkSession, folder: str) -> set[str]:
    """What lies in a folder, hidden files and marks apart; nothing if there is none."""
    files, path = _folder(spark, folder)
    names = {s.getPath().getName() for s in files.listStatus(path)} if files.exists(path) else set()
    return {name for name in names if name[0] not in "._"}


def _delete_if_empty(spark: SparkSession, folder: str) -> None:
    if not _names(spark, folder):
        _delete(spark, folder)


def write_snapshot(df: DataFrame, table: str, snapshot: str | None = None) -> None:
    """Replace one snapshot of ``table``; the others stay.  Without rows the snapshot goes.

    The output committer makes the partition visible only when all of it is written.
    """
    date, written = run_date(snapshot), Observation()
    (
        with_snapshot_date(df, date)
        .observe(written, F.count(F.lit(1)).alias("n"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
        .parquet(table)
    )
    if not written.get["n"]:  # an overwrite by partition leaves one alone that gets no rows
        _delete(df.sparkSession, f"{table}/{PARTITION}={date}")


def write_outcomes(df: DataFrame, root: str, column: str, outcomes: Sequence[str], snapshot: str) -> None:
    """One pass over ``df`` into a table below ``root`` for each of ``outcomes``, the values of ``column``.

    Rows are written beside the tables first; each table's snapshot is then replaced by its folder.  An
    outcome without rows clears its snapshot.  A run that ends in between can be run again.
    """
    spark, staged = df.sparkSession, f"{root}/_landing-{uuid.uuid4().hex}"
    df.write.partitionBy(column).parquet(staged)
    for outcome in outcomes:
        place = f"{root}/{outcome}/{PARTITION}={snapshot}"
        _delete(spark, place)
        files, new = _folder(spark, f"{staged}/{column}={outcome}")
        if files.exists(new):
            target = _folder(spark, place)[1]
            files.mkdirs(target.getParent())
            if not files.rename(new, target):
                raise OSError(f"{new} can't be moved to {target}")
    _delete(spark, staged)


def with_bucket(df: DataFrame, buckets: int = ENTITY_BUCKETS) -> DataFrame:
    """Add the second partition column, a bucket of the entity."""
    return df.withColumn(BUCKET, entity_bucket(F.col("entity"), buckets))


def write_entities(df: DataFrame, table: str, snapshot: str | None = None) -> None:
    """Replace one snapshot of a table of entities, stored in buckets of entities.

    Rows are rebalanced by bucket: no task writes into many buckets, and a bucket with most rows is split.
    """
    path = f"{table}/{PARTITION}={run_date(snapshot)}"
    bucketed = with_bucket(df).hint("rebalance", BUCKET)
    bucketed.write.mode("overwrite").partitionBy(BUCKET).parquet(path)
    _delete_if_empty(df.sparkSession, path)


def replace_entities(
    df: DataFrame, table: str, snapshot: str, entities: Sequence[str]
) -> None:
    """Put ``df``, rows of some ``entities``, in the place of what a snapshot holds of them.

    Only the buckets of these entities are read and written again; all other files stay as they are.  An
    entity without rows in ``df`` goes.
    """
    spark, path = df.sparkSession, f"{table}/{PARTITION}={snapshot}"
    touched = buckets_of(spark, entities)
    before = (
        spark.read.option("basePath", path).parquet(path)
        .filter(F.col(BUCKET).isin(touched) & ~F.col("entity").isin(list(entities)))
    )
    chosen = with_bucket(df.filter(F.col("entity").isin(list(entities))))
    folders = [f"{path}/{BUCKET}={bucket}" for bucket in touched]
    files = [_names(spark, folder) for folder in folders]
    (
        before.unionByName(chosen.select(*before.columns))
        .hint("rebalance", BUCKET)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET)
        .parquet(path)
    )
    for folder, names in zip(folders, files, strict=True):
        if names & _names(spark, folder):
            _delete(spark, folder)  # an overwrite by partition leaves one alone that gets no rows
    _delete_if_empty(spark, path)


def write_documents(df: DataFrame, path: str, compress: bool = True) -> None:
    """Nested documents as JSON lines, gzipped by default."""
    options = {"compression": "gzip"} if compress else {}
    df.write.mode("overwrite").options(**options).json(path)


def write_report(df: DataFrame, path: str) -> None:
    """A report table as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_url_index(pages: DataFrame, path: str, sitemap_url: str | None = None) -> None:
    """The URL index: one row per slug, sorted, below ``path/entities``; its other URLs in first-seen
    order below ``path/other``; counts, sitemap address and time in ``path/metadata``."""
    index = url_index(pages)
    index.orderBy("slug").write.mode("overwrite").json(f"{path}/entities")
    others = other_urls(pages).orderBy("slug", "pos").select("slug", "url")
    others.write.mode("overwrite").json(f"{path}/other")
    url_type_counts(index).select(
        F.current_timestamp().alias("scraped_at"),
        F.lit(sitemap_url).cast("string").alias("sitemap_url"),
        "*",
    ).write.mode("overwrite").json(f"{path}/metadata")


def write_in_order(df: DataFrame, path: str, *keys: str) -> None:
    """``df`` as Parquet files in the order of ``keys``, file after file and row after row."""
    df.orderBy(*keys).write.mode("overwrite").parquet(path)


def write_export(rows: DataFrame, summary: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The long table below ``path/fields`` by category, the summary row in ``path/summary``.

    Rows are rebalanced by category first: categories do not scatter into small files, and a
    category with most of the rows is split over several tasks and files.
    """
    # partitioned by a copy, so that every file keeps the whole header
    by_category = rows.withColumn(CATEGORY_PART, F.col("Category")).hint("rebalance", CATEGORY_PART)
    writer = by_category.write.mode("overwrite").partitionBy(CATEGORY_PART)
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(f"{path}/fields")
    else:
        writer.format(fmt).save(f"{path}/fields")
    summary.write.mode("overwrite").json(f"{path}/summary")
