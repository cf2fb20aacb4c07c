"""Entity documents and landed pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmill.operators.quality import is_valid_raw
from fieldmill.schemas import RAW_DOCUMENT

_BAD = "_corrupt_record"


def read_documents(
    spark: SparkSession, path: str, multi_line: bool = True, name_filter: str = "[!._]*.json*"
) -> DataFrame:
    """Entity documents under ``path``: ``entity, file_entity, is_valid, …, _corrupt_record``.

    One document per file with ``multi_line``, else one per line; the latter is splittable and the
    better layout for many documents.  A broken file or line is one row with its raw text and
    ``is_valid`` false.  ``file_entity`` is the file name without its extension.
    """
    docs = (
        spark.read.schema(f"{RAW_DOCUMENT}, {_BAD} string")
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BAD)
        .option("pathGlobFilter", name_filter)
        .json(path)
    )
    file_name = F.col("_metadata.file_name")
    return docs.select(
        "*",
        F.regexp_extract(file_name, r"^(.*?)\.json(?:l|\.gz)?$", 1).alias("file_entity"),
        (F.col(_BAD).isNull() & is_valid_raw(F.col("data.fields"))).alias("is_valid"),
    )


def valid_documents(docs: DataFrame) -> DataFrame:
    return docs.filter("is_valid").drop(_BAD, "is_valid")


def invalid_documents(docs: DataFrame) -> DataFrame:
    """What ``read_documents`` could not use, by file, with the raw text if it was no JSON."""
    return docs.filter(~F.col("is_valid")).select(
        F.col("file_entity").alias("entity"),
        F.when(F.col(_BAD).isNotNull(), "unreadable").otherwise("invalid structure").alias("error"),
        F.col(_BAD).alias("body"),
    )


def read_landed_pages(spark: SparkSession, path: str, source_url: str | None = None) -> DataFrame:
    """Fetched page documents, one JSON text per file: ``entity, source_url, scraped_at, body``."""
    return (
        spark.read.option("wholetext", True)
        .text(path)
        .select(
            F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.json)?$", 1).alias("entity"),
            F.coalesce(F.lit(source_url), F.col("_metadata.file_path")).alias("source_url"),
            F.col("_metadata.file_modification_time").alias("scraped_at"),
            F.col("value").alias("body"),
        )
    )
