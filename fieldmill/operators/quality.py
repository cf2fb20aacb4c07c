"""Validation rules for raw and refined records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmill.functions import text as X


def is_valid_raw(fields: Column) -> Column:
    """True when there is a field array whose first three fields have names."""
    return F.coalesce(
        F.forall(F.slice(fields, 1, 3), lambda f: f.isNotNull() & f["name"].isNotNull()),
        F.lit(False),
    )


def refined_rules() -> dict[str, Column]:
    """Rule name to the condition under which a refined field breaks it.

    Each structure type is checked against its own shape: a key with sub-values has no value of
    its own, and pairs with notes are single-valued whatever their number.
    """
    kind, values, multi = F.col("structure_type"), F.col("values"), F.col("is_multi_valued")
    n = F.size("values")
    sub = kind == X.KEY_WITH_SUB_VALUES
    return {
        "missing_entity": F.coalesce(F.col("entity").cast("string") == "", F.lit(True)),
        "unknown_structure_type": ~F.coalesce(kind.isin(list(X.STRUCTURE_TYPES)), F.lit(False)),
        "missing_values": values.isNull(),
        "value_without_order": F.exists(values, lambda v: v["order"].isNull()),
        "value_without_value": ~sub & F.exists(values, lambda v: v["value"].isNull()),
        "value_without_sub_values": sub & F.exists(values, lambda v: v["sub_values"].isNull()),
        "multi_with_fewer_than_two": multi & (n < 2),
        "single_with_several": (kind == X.SIMPLE) & ~multi & (n > 1),
        "empty_values": n == 0,
    }


def with_violations(refined: DataFrame) -> DataFrame:
    """Add ``violations``, the names of the broken rules (``empty_values`` is only a warning)."""
    broken = [F.when(cond, F.lit(name)) for name, cond in refined_rules().items()]
    return refined.withColumn("violations", F.array_compact(F.array(*broken)))


def violation_counts(checked: DataFrame) -> DataFrame:
    """Fields per broken rule."""
    return (
        checked.select(F.explode_outer("violations").alias("rule"))
        .filter(F.col("rule").isNotNull())
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("n_fields"))
    )
