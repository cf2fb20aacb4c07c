"""Reading the input tables and cutting lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which the driver and all executors see.

    Only a local session may name none (tests); it gets a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        if context._jsc.sc().getCheckpointDir().isEmpty():
            context.setCheckpointDir(named)
        return named
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="fieldmill-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, so later steps survive a lost executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
