"""Connected components by alternating large and small stars."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.llm.tables import cut

LINKS_PER_TASK = 200_000
MIN_TASKS = 4


def _with_minimum(sides: DataFrame) -> DataFrame:
    """Each (u, v) with the least node next to u, u itself included.

    The minimum has a map-side part and comes back by a join, which AQE splits for a node with very
    many neighbours; no neighbour list is ever built.
    """
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return sides.join(least, "u")


def _forest(edges: DataFrame) -> DataFrame:
    """Of the edges (u, v) of each partition as many as it takes to reach the same nodes: every node with
    the least one it is tied to there.  A partition holds about ``LINKS_PER_TASK`` edges."""

    def run(batches):
        least: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := least.setdefault(x, x)) != x:
                least[x] = least[up]
                x = up
            return x

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(u), root(v)
                if a != b:
                    least[max(a, b)] = min(a, b)
        tied = [(x, r) for x in list(least) if (r := root(x)) != x]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in tied], pa.int64()), pa.array([r for _, r in tied], pa.int64())],
            names=["u", "v"],
        )

    return edges.mapInArrow(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of nodes to (node, component_id), the least node that can be reached.

    Nodes without an edge do not appear.  Loops, repeated and reversed edges are allowed; nulls are
    ignored.  The number of rounds grows with the logarithm of the longest chain.
    """
    edges = cut(
        edges.where("a is not null and b is not null and a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    # links are narrow: few tasks for few of them, as each task of a shuffle leaves files behind
    parts = max(MIN_TASKS, edges.count() // LINKS_PER_TASK)
    # what a task holds is joined there first, so that fewer rows take fewer rounds
    edges = _forest(edges.coalesce(parts))
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").coalesce(parts).distinct().coalesce(parts)
        small = _with_minimum(large)
        edges = cut(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small.select("u", F.col("m").alias("v")))
            .where("u != v")
            .coalesce(parts)
            .distinct()
            .coalesce(parts)
        )
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component_id"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component_id")).distinct()
    return nodes.union(roots)
