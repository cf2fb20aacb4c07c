"""Near-duplicate documents by HyperMinHash registers, banding and exact verification.

Each distinct shingle hash falls into one of 128 buckets.  A bucket's register keeps of its smallest
hash only the number of leading zeros and the ten bits after them: 16 bits, zero for an empty bucket.
Four neighbouring registers are one band, so a band is one 64-bit number and 32 bands are a whole
sketch.  Two documents at similarity s share a given band with a chance of at least s**4, so a pair
at the threshold of 0.75 shares none of 32 bands with a chance under one in 180,000, if it has shingles
in most bands; a band without any says nothing and is skipped.  In short texts few bands decide (sets
of four and three shingles share none with a chance of one in 32,768), so sets of up to 20 shingles also
meet by their least shingles: two at the threshold have one of the first n - ceil(0.75 n) + 1 in common.

Copies with the same shingle set are one class from the start.  In every band bucket the members
are first compared with the least one only, after the corrected estimate from the sketches, which
settles most groups of near copies in linearly many comparisons.  In buckets that then still hold
different components, the sketches of all members are compared; what is tied by plausible links is a
cluster, whose blocks are compared exactly.  Neither step makes a row for each pair.  All links are
confirmed on full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmill.llm.graph import components
from fieldmill.llm.tables import cut
from fieldmill.llm.words import U, mix, slices, word_block

SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 75
BUCKET_BITS = 7
MANTISSA_BITS = 10
BANDS = 32
#: standard deviations of the estimate allowed below the threshold before a pair is dropped
MARGIN = 6.5
#: sets of up to so many shingles meet by single shingles as well
SHORT_SHINGLES = 20
#: bounds of a block of a cluster whose documents are compared with each other
BLOCK_DOCUMENTS = 1000
#: members of a bucket whose sketches one task compares
BLOCK_MEMBERS = 4000
BLOCK_SHINGLES = 400_000
#: up to so many ids (8 bytes each) are broadcast to pick documents without a shuffle of their texts
MAX_BROADCAST_IDS = 2_000_000
#: constant of the published collision estimate (fixed value)
COLLISION_CONSTANT = 0.169919487159739

SKETCH = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, least array<long>"


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order."""
    for low, high in slices(texts):
        block = word_block(texts[low:high])
        at, grams = block.gram_hashes(SHINGLE_WORDS)
        doc = block.doc[at]
        order = np.lexsort((grams, doc))
        doc, grams = doc[order], grams[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])
        doc, grams = doc[new], grams[new]
        bounds = np.searchsorted(doc, np.arange(high - low + 1))
        for i in range(high - low):
            found = grams[bounds[i] : bounds[i + 1]]
            yield found if len(found) else block.sequence_hash(i)


def registers(found: np.ndarray) -> np.ndarray:
    """The 128 registers of a sorted set of hashes."""
    out = np.zeros(1 << BUCKET_BITS, np.uint16)
    if len(found):
        bucket = (found >> U(64 - BUCKET_BITS)).astype(np.int64)
        least = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        rest = found[least] << U(BUCKET_BITS) | U(1 << (BUCKET_BITS - 1))
        zeros = (64 - np.frexp(rest.astype(np.float64))[1]).astype(np.int64)
        zeros = np.maximum(zeros, 0)
        mantissa = (rest << (zeros + 1).astype(U)) >> U(64 - MANTISSA_BITS)
        out[bucket[least]] = ((zeros + 1) << MANTISSA_BITS | mantissa.astype(np.int64)).astype(
            np.uint16
        )
    return out


def similarity_estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray):
    """Per row of registers: estimated Jaccard similarity, corrected for chance equality, and the
    number of registers that it rests on."""
    used = ((a != 0) | (b != 0)).sum(1)
    equal = ((a == b) & (a != 0)).sum(1)
    ratio = np.maximum(n, m) / np.maximum(1, np.minimum(n, m))
    chance = (
        COLLISION_CONSTANT * 2.0 ** (BUCKET_BITS - MANTISSA_BITS) * 4 * ratio / (1 + ratio) ** 2
    )
    return np.maximum(0, equal - chance) / np.maximum(1, used), used


def sketches(docs: DataFrame) -> DataFrame:
    """One row per document: set size, two hashes of the whole set, and the sketch."""

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            n, a, b, bands, least = [], [], [], [], []
            for found in shingle_sets(texts):
                n.append(len(found))
                a.append(int(mix(found ^ U(0x5851F42D4C957F2D)).sum(dtype=U).astype(np.int64)))
                b.append(int(mix(found ^ U(0x14057B7EF767814F)).sum(dtype=U).astype(np.int64)))
                bands.append(registers(found).view(np.int64))
                first = len(found) + 1 + -len(found) * THRESHOLD_PERCENT // 100
                least.append(found[:first].view(np.int64).tolist() if len(found) <= SHORT_SHINGLES else [])
            flat = np.concatenate(bands) if bands else np.zeros(0, np.int64)
            offsets = np.arange(len(n) + 1, dtype=np.int32) * BANDS
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(n, pa.int64()),
                    pa.array(a, pa.int64()),
                    pa.array(b, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    pa.array(least, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "least"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, SKETCH)


def _sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, shingles) of the documents in ``ids`` (doc_id)."""

    def run(batches):
        for batch in batches:
            found = list(shingle_sets(batch.column(1).to_pylist()))
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            flat = np.concatenate([*found, np.zeros(0, U)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["doc_id", "shingles"],
            )

    if ids.count() <= MAX_BROADCAST_IDS:
        ids = F.broadcast(ids)  # else texts have to be shuffled
    chosen = docs.select(F.col("doc_id").cast("long"), "text").join(ids, "doc_id", "left_semi")
    return chosen.mapInArrow(run, "doc_id long, shingles array<long>")


def _is_link(common: Column, n: Column, m: Column) -> Column:
    return 100 * common >= THRESHOLD_PERCENT * (n + m - common)


def _verified(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of ``pairs`` (a, b) whose full sets reach the threshold."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where(_is_link(common, F.size("sa"), F.size("sb")))
        .select("a", "b")
    )


def _may_reach(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Rows whose estimated similarity is not far below the threshold."""
    guess, used = similarity_estimate(a, b, n, m)
    slack = MARGIN * np.sqrt(0.25 / np.maximum(1, used))
    return guess + slack >= THRESHOLD_PERCENT / 100


def _register_rows(column) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).view(np.uint16).reshape(-1, 1 << BUCKET_BITS)


def _plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of ``pairs`` (a, b) that may reach the threshold by their sketches."""
    a = classes.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("bands").alias("ba"))
    b = classes.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("bands").alias("bb"))

    def run(batches):
        for batch in batches:
            x, y = _register_rows(batch.column("ba")), _register_rows(batch.column("bb"))
            n, m = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array(_may_reach(x, y, n, m)))

    return pairs.join(a, "a").join(b, "b").mapInArrow(run, "a long, b long")


def _dealt(members: DataFrame, group: list[str], blocks: Column) -> DataFrame:
    """``members`` (rep, ...) of groups in blocks: a row for each pair of blocks (low, high) that its
    own block is part of.  A group of one block is one pair."""
    sizes = members.groupBy(*group).agg(F.ceil(blocks).alias("_blocks"))
    own, other = F.col("own"), F.col("_other")
    return (
        members.join(sizes, group)
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("_blocks")))
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
        .withColumns({"low": F.least(own, other), "high": F.greatest(own, other)})
        .drop("_blocks", "_other")
    )


def _clusters(open_: DataFrame, held: DataFrame) -> DataFrame:
    """(rep, cluster): members of ``open_`` (rep, comp, band, key) tied by plausible links.

    All pairs of a bucket are looked at in numpy, block by block; what comes out is not the pairs but
    for each member that has any the least member tied to it.
    """
    dealt = _dealt(open_, ["band", "key"], F.count("*") / F.lit(BLOCK_MEMBERS)).join(held, "rep")
    group = ["band", "key", "low", "high"]

    def run(batches):
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if kept is not None and kept.num_rows:
                table = pa.concat_tables([kept, table])
            columns = [table.column(c).to_numpy() for c in group]
            new = np.ones(table.num_rows, bool)
            for c in columns:
                new[1:] &= c[1:] == c[:-1]
            new[1:] = ~new[1:]
            last = int(np.flatnonzero(new)[-1]) if len(new) else 0
            kept = table.slice(last)
            if last:
                yield ties(table.slice(0, last), np.cumsum(new[:last]))
        if kept is not None and kept.num_rows:
            yield ties(kept, np.zeros(kept.num_rows))

    def ties(table, groups):
        rep, comp, n = (table.column(c).to_numpy() for c in ("rep", "comp", "n"))
        own, low, high = (table.column(c).to_numpy() for c in ("own", "low", "high"))
        registers = _register_rows(table.column("bands"))
        root = np.arange(len(rep))
        at, step = root, 1
        while True:
            at = at[at + step < len(rep)]
            at = at[groups[at] == groups[at + step]]
            if not len(at):
                break
            i, j = at, at + step
            new = (comp[i] != comp[j]) & (root[i] != root[j])
            new &= (low[i] == high[i]) | (own[i] != own[j])
            new &= 100 * np.minimum(n[i], n[j]) >= THRESHOLD_PERCENT * np.maximum(n[i], n[j])
            i, j = i[new], j[new]
            new = _may_reach(registers[i], registers[j], n[i], n[j])
            i, j = i[new], j[new]
            while len(i):
                a, b = root[i], root[j]
                apart = a != b
                i, j, a, b = i[apart], j[apart], a[apart], b[apart]
                np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
                while not np.array_equal(root, root[root]):
                    root = root[root]
            step += 1
        tied = np.flatnonzero(root != np.arange(len(rep)))
        return pa.RecordBatch.from_arrays(
            [pa.array(rep[root[tied]]), pa.array(rep[tied])], names=["a", "b"]
        )

    edges = dealt.repartition(*group).sortWithinPartitions(*group).mapInArrow(run, "a long, b long")
    return components(edges).select(F.col("node").alias("rep"), F.col("component_id").alias("cluster"))


def _links_in_clusters(sets: DataFrame, members: DataFrame) -> DataFrame:
    """Links (a, b) between different components of ``members`` (rep, n, comp, cluster).

    A cluster is dealt into blocks of bounded size, each pair of blocks is one task's work, and inside
    it all common shingles are counted at once.  A task hands on no more links than it takes to join
    its components.
    """
    documents, shingles = F.lit(BLOCK_DOCUMENTS), F.lit(BLOCK_SHINGLES)
    blocks = F.greatest(F.count("*") / documents, F.sum("n") / shingles)
    dealt = _dealt(members, ["cluster"], blocks).withColumnRenamed("rep", "doc_id")
    return (
        dealt.join(sets, "doc_id")
        .groupBy("cluster", "low", "high")
        .applyInArrow(_joining_links, "a long, b long")
    )


def _joining_links(table: pa.Table) -> pa.Table:
    names, comps, own = (table.column(c).to_numpy() for c in ("doc_id", "comp", "own"))
    lists = table.column("shingles").combine_chunks()
    sizes = np.diff(np.asarray(lists.offsets))
    doc = np.repeat(np.arange(len(names)), sizes)
    _, column, times = np.unique(
        lists.flatten().to_numpy(), return_inverse=True, return_counts=True
    )
    shared = times[column] > 1
    doc, column = doc[shared], column[shared]
    order = np.argsort(column, kind="stable")
    doc, column = doc[order], column[order]
    column = np.cumsum(np.append(False, column[1:] != column[:-1]))[: len(column)]
    common = np.zeros((len(names), len(names)), np.float32)
    width = 4096
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (low, low + width))
        part = np.zeros((len(names), width), np.float32)
        part[doc[a:b], column[a:b] - low] = 1
        common += part @ part.T
    total = sizes[:, None] + sizes[None, :]
    links = (100 * common >= THRESHOLD_PERCENT * (total - common)) & (comps[:, None] != comps)
    if table.column("low")[0] != table.column("high")[0]:
        links &= own[:, None] != own
    parent = {c: c for c in comps.tolist()}

    def root(c):
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    found = []
    for i, j in np.argwhere(np.triu(links)).tolist():
        a, b = root(int(comps[i])), root(int(comps[j]))
        if a != b:
            parent[a] = b
            found.append((int(names[i]), int(names[j])))
    return pa.table(
        {
            "a": pa.array([x for x, _ in found], pa.int64()),
            "b": pa.array([y for _, y in found], pa.int64()),
        }
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document (doc_id, text): doc_id, n_shingles, component_id, kept, n_copies.

    Two documents are linked when 100 * common shingles >= 75 * all shingles; ``component_id`` is the
    least doc_id that can be reached, ``kept`` says that it is the document's own, and ``n_copies``
    counts the documents with the very same shingle set.  A text with fewer than five words is one
    shingle; a null, empty or blank text has none and is linked with nothing.  A row without a doc_id
    gets itself alone: a null component, kept.  Rows that share a doc_id are one document and stay
    together; an input without rows gives no rows; other columns are ignored.
    """
    sketch = cut(sketches(docs))
    keys = ["set_a", "set_b", "n_shingles"]
    real = sketch.where("doc_id is not null and n_shingles > 0")
    classes = real.groupBy(*keys).agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_copies"))
    classes = cut(classes)
    held = (
        classes.select("rep", F.col("n_shingles").alias("n"), "set_a", "set_b")
        .join(
            real.select(F.col("doc_id").alias("rep"), "set_a", "set_b", "bands", "least"),
            ["rep", "set_a", "set_b"],
        )
        .select("rep", "n", "bands", "least")
    )
    held = cut(held)
    bucket = ["band", "key"]
    members = held.select("rep", "n", F.posexplode("bands").alias("band", "key")).where("key != 0")
    singles = held.select("rep", "n", F.lit(BANDS).alias("band"), F.explode("least").alias("key"))
    members, held = members.union(singles), held.drop("least")
    centres = members.groupBy(*bucket).agg(F.min("rep").alias("centre"), F.count("*").alias("m"))
    starred = members.join(centres.where("m > 1"), bucket)
    starred = cut(starred.select("rep", "n", "band", "key", "centre"))
    first = (
        starred.where("rep != centre")
        .select(F.col("centre").alias("a"), F.col("rep").alias("b"))
        .distinct()
    )
    sets = cut(_sets(docs, cut(starred.select(F.col("rep").alias("doc_id")).distinct())))
    links = cut(_verified(sets, _plausible(first, held)).distinct())
    joined = cut(components(links).withColumnRenamed("node", "rep"))

    placed = starred.join(joined, "rep", "left").select(
        "rep", "n", *bucket, F.coalesce("component_id", "rep").alias("comp")
    )
    split = placed.groupBy(*bucket).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    open_ = placed.join(split.where("lo != hi").select(*bucket), bucket)
    tied = _clusters(open_.select("rep", "comp", *bucket), held)
    members = cut(placed.select("rep", "n", "comp").distinct().join(tied, "rep"))
    more = _links_in_clusters(sets, members)
    # the new links tie components that are known already
    known = members.select("rep", "comp").distinct()
    between = more.join(known.toDF("a", "ca"), "a").join(known.toDF("b", "cb"), "b")
    merged = components(between.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    own = F.coalesce("component_id", "rep")
    named = (
        classes.join(joined, "rep", "left")
        .withColumn("node", own)
        .drop("component_id")
        .join(merged, "node", "left")
        .select(*keys, F.coalesce("component_id", "node").alias("component_id"), "n_copies")
    )
    placed = sketch.join(named, keys, "left")
    ids = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return placed.select(
        "doc_id",
        "n_shingles",
        ids.alias("component_id"),
        F.coalesce(F.col("doc_id") == ids, F.lit(True)).alias("kept"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without the near copies: of each component the least doc_id stays."""
    gone = near_duplicates(docs).where(~F.col("kept")).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti")
