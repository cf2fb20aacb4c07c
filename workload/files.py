"""Folders for queries that write files and read them back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors see: below ``spark.checkpoint.dir``.

    Only a local session may lack that setting; it gets a temporary folder.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not shared and not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
    return f"{(shared or tempfile.mkdtemp(prefix='workload-')).rstrip('/')}/{name}-{uuid.uuid4().hex}"
