"""Dated snapshots: tables below one root, partitioned by ``snapshot_date``."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PARTITION = "snapshot_date"
#: tables of entities have a second partition column
BUCKET = "entity_bucket"
ENTITY_BUCKETS = 32


def entity_bucket(entity: Column, buckets: int = ENTITY_BUCKETS) -> Column:
    """The bucket that an entity's rows are stored in."""
    return F.pmod(F.xxhash64(entity), F.lit(buckets)).cast("int")


def buckets_of(spark: SparkSession, entities: Sequence[str]) -> list[int]:
    """The buckets of a list of entities."""
    rows = spark.createDataFrame([(e,) for e in entities], "entity string")
    return [r[0] for r in rows.select(entity_bucket(F.col("entity"))).distinct().collect()]


def parse_snapshot_date(text: str) -> dt.date:
    """A ``YYYY-MM-DD`` argument; anything else is an error."""
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        raise ValueError(f"snapshot date must look like YYYY-MM-DD: {text!r}")
    return dt.date.fromisoformat(text)


def list_snapshots(spark: SparkSession, table: str) -> list[str]:
    """Dates of a table's partitions, oldest first, from a directory listing (no data is read)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(table)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    head = f"{PARTITION}="
    return sorted(n[len(head) :] for n in names if n.startswith(head))


def resolve_snapshot(spark: SparkSession, table: str, snapshot: str | None = None) -> str:
    """Date of the asked snapshot, ``None`` or ``latest`` meaning the newest; missing is an error."""
    if snapshot is not None and snapshot != "latest":
        parse_snapshot_date(snapshot)
    dates = list_snapshots(spark, table)
    if not dates:
        raise FileNotFoundError(f"no snapshots in {table}")
    if snapshot is None or snapshot == "latest":
        return dates[-1]
    if snapshot not in dates:
        raise FileNotFoundError(f"no snapshot {snapshot} in {table}")
    return snapshot


def read_snapshot(
    spark: SparkSession,
    table: str,
    snapshot: str | None = None,
    entities: Sequence[str] | None = None,
) -> DataFrame:
    """One snapshot of a table; only the folder of its partition is listed.

    With ``entities`` only their rows; of a table in buckets only these entities' buckets are read.
    """
    date = resolve_snapshot(spark, table, snapshot)
    df = spark.read.option("basePath", table).parquet(f"{table}/{PARTITION}={date}")
    if entities:
        df = df.filter(F.col("entity").isin(list(entities)))
        if BUCKET in df.columns:
            df = df.filter(F.col(BUCKET).isin(buckets_of(spark, entities)))
    return df.drop(BUCKET)


def read_in_order(spark: SparkSession, path: str) -> DataFrame:
    """The rows of Parquet files with ``place``, their number from 0 in the order of files and rows.

    Offsets come from one count a file; no row is sorted.
    """
    rows = spark.read.parquet(path).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    sizes = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_file", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return (
        rows.join(F.broadcast(offsets), "_file")  # a row for each file
        .withColumn("place", F.col("_offset") + F.col("_row"))
        .drop("_file", "_row", "_offset")
    )


def find_snapshot(spark: SparkSession, table: str, date: str) -> DataFrame | None:
    """A snapshot that may be missing, as nothing was left to write."""
    return read_snapshot(spark, table, date) if date in list_snapshots(spark, table) else None


def latest_snapshot(df: DataFrame, column: str = PARTITION) -> DataFrame:
    """The rows of the greatest ``column`` of any table.

    The greatest value is a scalar subquery; on a partition column it prunes partitions at run time.
    """
    newest = df.agg(F.max(column))
    return df.filter(F.col(column) == newest.scalar())
