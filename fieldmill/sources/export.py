"""The stored flat export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: the column that the export is partitioned by, a copy of the category
CATEGORY_PART = "category_part"
#: types of the columns that aren't text
_TYPES = {"Order": "int", "Has Ranking": "boolean"}


def read_export(
    spark: SparkSession, path: str, fmt: str = "parquet", categories: Sequence[str] | None = None
) -> DataFrame:
    """The rows that ``write_export`` stored below ``path``; with ``categories`` only their folders are read.

    CSV fields keep their quotes and line feeds; types come from the header's names.
    """
    stored = f"{path}/fields"
    if fmt == "csv":
        reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
        rows = reader.option("nullValue", "").option("emptyValue", "").csv(stored)
        rows = rows.withColumns(
            {c: F.col(f"`{c}`").cast(kind) for c, kind in _TYPES.items() if c in rows.columns}
        )
    else:
        rows = spark.read.format(fmt).load(stored)
    if categories:
        rows = rows.filter(F.col(CATEGORY_PART).isin(list(categories)))
    return rows.drop(CATEGORY_PART)
