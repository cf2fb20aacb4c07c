"""Changes between two snapshots of a keyed value table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: what identifies a value within a snapshot
SLOT = ("entity", "name", "key", "order")


def snapshot_diff(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str] = SLOT,
    value: str = "value",
    tasks: int | None = None,
) -> DataFrame:
    """``keys, old_value, new_value, status, copies``; null keys and null values compare equal.

    Both sides are stacked and counted per (keys, value) instead of joined: repeated rows collapse
    map-side and never multiply.  One more exchange brings a slot together, and everything about it
    comes from windows on that one sort.  A slot with at most one row per side is added, removed,
    changed or unchanged.  A slot with repeats is compared as a bag: equal values are unchanged, what
    is left over is removed or added, and ``copies`` says how often.

    With ``tasks`` all rows are moved once, by their keys into that many parts, and both counted and
    compared there.  Where few rows repeat within a side this moves half as much, and a number that
    grows with the snapshots keeps a part's sort in memory.

    Sides that both lie in as many parts by the same of the keys need no ``tasks``: no row is moved, as the
    union keeps their partitioning.  Fields dealt by entity and name before they are turned into values
    give such sides, and moving fields takes a fraction of what moving their values does.
    """
    keys = list(keys)

    def side(df: DataFrame, is_new: int) -> DataFrame:
        return df.select(
            *keys,
            F.col(value).alias("_value"),
            F.lit(is_new == 1).alias("_is_new"),
        )

    rows = side(old, 0).unionByName(side(new, 1))
    if tasks:
        rows = rows.repartition(tasks, *keys)
    counts = rows.groupBy(*keys, "_value").agg(
        F.count_if(~F.col("_is_new")).alias("_o"), F.count_if("_is_new").alias("_n")
    )
    in_old, in_new = F.col("_o") > 0, F.col("_n") > 0
    slot = Window.partitionBy(*keys)
    slots = counts.withColumns(
        {
            "_olds": F.sum("_o").over(slot),
            "_news": F.sum("_n").over(slot),
            "_distinct": F.count(F.lit(1)).over(slot),
            "_old": F.max(F.when(in_old, F.col("_value"))).over(slot),
            "_new": F.max(F.when(in_new, F.col("_value"))).over(slot),
        }
    )
    status = (
        F.when(F.col("_olds") == 0, "added")
        .when(F.col("_news") == 0, "removed")
        .when(F.col("_distinct") == 1, "unchanged")
        .otherwise("changed")
    )
    # of a changed slot's two values the new one speaks for it
    speaks = in_new | (F.col("_news") == 0)
    once = F.lit(1).cast("bigint")
    single = _outcome(F.col("_old"), F.col("_new"), status, F.when(speaks, once).otherwise(0))
    both = F.least("_o", "_n")
    nothing = F.lit(None).cast(counts.schema["_value"].dataType)
    repeated = [
        _outcome(F.col("_value"), F.col("_value"), F.lit("unchanged"), both),
        _outcome(F.col("_value"), nothing, F.lit("removed"), F.col("_o") - both),
        _outcome(nothing, F.col("_value"), F.lit("added"), F.col("_n") - both),
    ]
    repeats = (F.col("_olds") > 1) | (F.col("_news") > 1)
    outcomes = F.when(repeats, F.array(*repeated)).otherwise(F.array(single))
    return (
        slots.select(*keys, F.explode_outer(outcomes).alias("_out"))
        .select(*keys, "_out.*")
        .filter(F.col("copies") > 0)
    )


def _outcome(old_value: Column, new_value: Column, status: Column, copies: Column) -> Column:
    return F.struct(
        old_value.alias("old_value"),
        new_value.alias("new_value"),
        status.alias("status"),
        copies.cast("bigint").alias("copies"),
    )


#: what a field is known by in a snapshot
UNIT = ("entity", "name")


def changed_fields(
    old: DataFrame, new: DataFrame, content: Sequence[str], unit: Sequence[str] = UNIT
) -> DataFrame:
    """``_unit``: hashes of the fields that a comparison of their contents has to look at.

    Only hashes are shuffled: of the unit, and of ``content``, which can be nested.  A field is left out if
    it occurs once in each snapshot with the same content hash, so a change is overlooked with a chance of
    2**-64.  Units whose hashes are the same, and repeated ones, are always looked at.
    """

    def side(df: DataFrame, is_new: int) -> DataFrame:
        digest = F.xxhash64(*content)
        return df.select(
            F.xxhash64(*unit).alias("_unit"),
            F.when(F.lit(is_new == 0), digest).alias("_o"),
            F.when(F.lit(is_new == 1), digest).alias("_n"),
        )

    found = side(old, 0).unionByName(side(new, 1)).groupBy("_unit").agg(
        F.count("_o").alias("_olds"),
        F.count("_n").alias("_news"),
        F.max("_o").alias("_old"),
        F.max("_n").alias("_new"),
    )
    same = (F.col("_olds") == 1) & (F.col("_news") == 1) & (F.col("_old") == F.col("_new"))
    return found.filter(~F.coalesce(same, F.lit(False))).select("_unit")


def field_diff(
    old: DataFrame,
    new: DataFrame,
    rows: Callable[[DataFrame], DataFrame],
    content: Sequence[str],
    unit: Sequence[str] = UNIT,
    keys: Sequence[str] = SLOT,
    value: str = "value",
    tasks: int | None = None,
) -> DataFrame:
    """``snapshot_diff`` of ``rows(old)`` and ``rows(new)``, where both have one row per field.

    Contents are compared by their hashes first.  Only fields that changed are turned into value rows on
    both sides and compared; the others give their rows from the new side, in place.  ``rows`` must depend
    on ``unit`` and ``content`` only, and give no slot twice for one field.
    """
    changed = changed_fields(old, new, content, unit)
    unit_hash = F.xxhash64(*unit)

    def chosen(df: DataFrame, how: str) -> DataFrame:
        # AQE broadcasts the hashes if they are few by their measured size
        return rows(df.withColumn("_unit", unit_hash).join(changed, "_unit", how).drop("_unit"))

    same = chosen(new, "left_anti").select(
        *keys,
        F.col(value).alias("old_value"),
        F.col(value).alias("new_value"),
        F.lit("unchanged").alias("status"),
        F.lit(1).cast("bigint").alias("copies"),
    )
    compared = snapshot_diff(chosen(old, "left_semi"), chosen(new, "left_semi"), keys, value, tasks)
    return same.unionByName(compared)


def diff_summary(diff: DataFrame) -> DataFrame:
    """Values per status."""
    return diff.groupBy("status").agg(F.sum("copies").alias("n_values"))
