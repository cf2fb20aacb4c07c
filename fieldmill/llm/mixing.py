"""Mixing sources to target weights by Pfair scheduling.

Each source is a stream of blocks of about equal size.  With a target weight w, block i of a source
(from 0) is released at floor(i / w) and due at ceil((i + 1) / w); of the released blocks the one due
earliest takes the next place of the mix.  As the weights add up to 1, every block meets its window,
so at any place each source is less than one block away from its share.

Weights are rational numbers and never rounded, so this holds however long the mix is.  The places are
computed once, for blocks and not for rows: a place takes a few microseconds, and 8 bytes are kept for
each block of about 256,000 characters.  The mix lasts until the source that is largest for its weight
is used up; a smaller source starts over until then, as often as its weight asks for.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice
from math import inf, lcm

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmill.llm.tables import cut

#: characters of a block; a text longer than that makes its block longer
BLOCK_CHARS = 1 << 18
#: default weights follow the size of a source to this power
FLATTEN = 0.7
#: documents that are numbered together
BUCKET_DOCUMENTS = 20_000


def shares(weights: dict[str, float], period: int) -> dict[str, int]:
    """Whole shares that add up to ``period``, at least one each, by largest remainder."""
    if len(weights) > period:
        raise ValueError(f"{len(weights)} sources need a period of at least as many places")
    if any(not w > 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    total = sum(weights.values())
    beyond = {s: max(0.0, w / total * period - 1) for s, w in weights.items()}
    scale = (period - len(weights)) / sum(beyond.values()) if any(beyond.values()) else 0.0
    out = {s: 1 + int(x * scale) for s, x in beyond.items()}
    by_rest = sorted(weights, key=lambda s: (int(beyond[s] * scale) - beyond[s] * scale, s))
    for k in range(period - sum(out.values()) if weights else 0):
        out[by_rest[k % len(by_rest)]] += 1
    return out


def turns(weights: dict[str, float]) -> Iterator[tuple[str, int]]:
    """The endless mix, earliest deadline first: (source, block of the source) for each place."""
    if any(not 0 < w < inf for w in weights.values()):
        raise ValueError("weights must be positive")
    exact = {s: Fraction(w) for s, w in weights.items()}
    unit = lcm(*(w.denominator for w in exact.values()))
    whole = {s: int(w * unit) for s, w in exact.items()}
    total = sum(whole.values())
    coming = [(0, s, 0) for s in whole]
    heapq.heapify(coming)
    ready, place = [], 0
    while whole:
        while coming[0][0] <= place:
            _, source, i = coming[0]
            n = whole[source]
            heapq.heappush(ready, (-(-(i + 1) * total // n), source, i))
            heapq.heapreplace(coming, ((i + 1) * total // n, source, i + 1))
        _, source, i = heapq.heappop(ready)
        yield source, i
        place += 1


def schedule(parts: dict[str, int]) -> list[tuple[str, int, int]]:
    """One period of whole shares: (source, block of the period, place)."""
    period = sum(parts.values())
    return [(s, i, place) for place, (s, i) in enumerate(islice(turns(parts), period))]


def _first_places(weights: dict[str, float], blocks: dict[str, int]):
    """The place of each block of each source, and how many places each has till all have had one."""
    places = {s: array("q") for s in blocks}
    given = dict.fromkeys(blocks, 0)
    left = sum(blocks.values())
    for place, (source, i) in enumerate(turns(weights)):
        given[source] = i + 1
        if i < blocks[source]:
            places[source].append(place)
            left -= 1
            if not left:
                break
    return places, given


def _key(source: Column) -> Column:
    """The source as a string that is never null and tells null from every name."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    period: int | None = None,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with block, place and repeats.

    ``block`` counts the blocks of a source from 0, ``place`` is the first place of the block in the
    mix, and ``repeats`` says how often the block comes in it, at least once (time e, from 0, is that
    of block ``block + e * blocks of the source``).  Every row comes back once.  ``weights`` are
    relative targets by source; a source that they do not name, or any without them, weighs its number of
    blocks to the power of 0.7.  A null source is a source of its own.  A null or empty text takes no
    room in its block; repeated rows each take theirs; an empty input gives no rows; columns named
    like the new ones are replaced.  More sources than places of a period are an error.

    A source's running totals come in two levels, inside hash buckets and over their sums, so no task
    sees a whole source, and rows with their texts are shuffled once.
    """
    docs = docs.drop("block", "place", "repeats")
    buckets = max(1, -(-docs.count() // BUCKET_DOCUMENTS))
    order = F.xxhash64("doc_id", "text")
    sized = docs.withColumns(
        {
            "_key": _key(F.col("source")),
            "_size": F.coalesce(F.length("text"), F.lit(0)).cast("long"),
            "_order": order,
            "_bucket": F.pmod(order, F.lit(buckets)),
        }
    )
    sums = cut(sized.groupBy("_key", "_bucket").agg(F.sum("_size").alias("_sum")))
    totals = sums.groupBy("_key").agg(F.sum("_sum").alias("chars")).collect()
    blocks = {r["_key"]: max(1, -(-r["chars"] // block_chars)) for r in totals}
    named = {"null" if s is None else f"={s}": w for s, w in (weights or {}).items()}
    target = {s: named.get(s, n**FLATTEN) for s, n in blocks.items()}
    if period is not None:
        target = shares(target, period)
    # the mix ends with the last block that has not been in it before
    places, given = _first_places(target, blocks)
    spark = docs.sparkSession
    names, counts = list(blocks), np.array(list(blocks.values()), np.int64)
    of = np.repeat(np.arange(len(names)), counts)
    number = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.concatenate([np.zeros(0, np.int64), *(np.asarray(places[s], np.int64) for s in names)])
    plan = spark.createDataFrame(
        pa.table({"_number": of, "block": number, "place": at}),
        "_number long, block long, place long",
    )
    facts = spark.createDataFrame(
        [(s, k, blocks[s], given[s]) for k, s in enumerate(names)],
        "_key string, _number long, _blocks long, _given long",
    )

    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    earlier = before.partitionBy("_key").orderBy("_bucket")
    ahead = sums.select(
        "_key", "_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_ahead")
    )
    within = before.partitionBy("_key", "_bucket").orderBy("_order", "doc_id")
    start = F.col("_ahead") + F.coalesce(F.col("_inside"), F.lit(0))
    # the tables hold a row for each source and each block
    placed = (
        sized.withColumn("_inside", F.sum("_size").over(within))
        .join(ahead, ["_key", "_bucket"])
        .join(F.broadcast(facts), "_key")
        .withColumn(
            "block",
            F.least(F.floor(start / F.lit(block_chars)).cast("long"), F.col("_blocks") - 1),
        )
        .join(F.broadcast(plan), ["_number", "block"])
    )
    repeats = F.floor((F.col("_given") - 1 - F.col("block")) / F.col("_blocks")).cast("long") + 1
    return placed.select(*docs.columns, "block", "place", repeats.alias("repeats"))
