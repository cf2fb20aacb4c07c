"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns.  The sequence is known by the sum of hashes of its turns with
their places: two 64-bit sums, so that of a million million nodes two get the same with a chance under
1 in 10**14.  Running sums within a conversation give the nodes on its path.

Totals over subtrees come from rounds of two steps.  Compress: nodes with one child form chains; each
learns the chain's end and the weights up to there by pointer jumping, the end then takes the place of the
chain.  Rake: leaves give their weights to their parents and go.  Every round leaves at most half of the
nodes, however deep or wide the tree is.  Then the rounds are undone from the last to the first: a chain's
node has its own weights and the total of the end.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.llm.scans import running_sums
from fieldmill.llm.tables import cut

HEAD = 64  # code points of a text that order turns of one number
BLOCK_BITS = 14  # conversations whose ids differ in these bits only are hashed as one piece of text
NODES_PER_TASK = 200_000
MIN_TASKS = 4


def numbered(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, code, bytes``: turns by place from 1, a digest of role and text, the text's UTF-8 size.

    Turns go by ``turn``, nulls first; equal numbers by role, the first 64 code points of the text, then the
    digest; equal rows are turns of their own.  A null role or text counts as empty, a row without a
    ``conv_id`` belongs to no conversation.  Other columns are not read; an empty table gives an empty one.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.substring(text, 1, HEAD).alias("head"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(" "), role, text), 256)).alias("code"),
        F.octet_length(text).cast("long").alias("bytes"),
        F.lit(1).cast("long").alias("pos"),
    )
    placed = running_sums(turns, "conv_id", ["turn", "role", "head", "code"], ["pos"])
    return placed.select("conv_id", "pos", "code", "bytes")


def with_shared_starts(turns: DataFrame, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt (turns, conversations): the first turns come from the conversation of the next lower
    multiple of 5, as many as the id's CRC-32 modulo 9 says; ``conversations`` is ``conv_id, length``."""
    base = F.col("conv_id") - F.col("conv_id") % 5
    starts = conversations.select(F.col("conv_id").alias("base"), F.col("length").alias("offered"))
    plan = (
        conversations.withColumn("base", base)
        .withColumn("skip", F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9)
        .join(starts, "base", "left")
        .withColumn("taken", F.least("skip", F.coalesce("offered", F.lit(0))))
        .withColumn("rebuilt", F.col("taken") + F.greatest(F.lit(0), F.col("length") - F.col("skip")))
    )
    own = (
        turns.join(plan.where("length > skip").select("conv_id", "skip", "taken"), "conv_id")
        .where("pos > skip")
        .select("conv_id", (F.col("pos") - F.col("skip") + F.col("taken")).alias("pos"), "code", "bytes")
    )
    lent = (
        turns.where("pos <= 8 AND conv_id % 5 = 0")
        .withColumnRenamed("conv_id", "base")
        .join(plan.where("taken > 0").select("base", "conv_id", "taken"), "base")
        .where("pos <= taken")
        .select("conv_id", "pos", "code", "bytes")
    )
    return own.union(lent), plan.select("conv_id", F.col("rebuilt").alias("length"))


def lengths(turns: DataFrame) -> DataFrame:
    """``conv_id, length`` of conversations with at least one turn."""
    return turns.groupBy("conv_id").agg(F.max("pos").alias("length"))


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of all conversations.

    ``turns`` is ``conv_id, pos, code, bytes`` as ``numbered`` gives it, ``conversations`` is
    ``conv_id, length`` with every conversation once, turnless ones too.  Returns ``conv_id`` (least
    member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``; without
    conversations there are no nodes.
    """
    hashed = turns.select(
        "conv_id",
        F.col("pos").cast("long").alias("depth"),
        "bytes",
        F.xxhash64("code", "pos").alias("path_a"),
        F.xxhash64("pos", "code").alias("path_b"),
    )
    paths = running_sums(hashed, "conv_id", ["depth"], ["path_a", "path_b"])
    nodes = paths.groupBy("path_a", "path_b").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.count("*").alias("n_convs"),
        F.max("bytes").alias("bytes"),
        F.max("path_a_before").alias("up_a"),
        F.max("path_b_before").alias("up_b"),
    )
    none = F.lit(0).cast("long")
    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).select(
        none.alias("path_a"),
        none.alias("path_b"),
        "conv_id",
        none.alias("depth"),
        "n_convs",
        none.alias("bytes"),
        F.lit(None).cast("long").alias("up_a"),
        F.lit(None).cast("long").alias("up_b"),
    )
    nodes = cut(
        nodes.unionByName(root.where("n_convs > 0")).withColumn("node", F.monotonically_increasing_id())
    )
    parents = nodes.select(
        F.col("path_a").alias("up_a"),
        F.col("path_b").alias("up_b"),
        F.col("node").alias("parent"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    linked = cut(nodes.join(parents, ["up_a", "up_b"], "left").drop("up_a", "up_b"))
    children = linked.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).count()
    tree = cut(
        linked.join(children, "node", "left")
        .withColumn("n_children", F.coalesce("count", none))
        .withColumn("leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes"))
        .drop("count")
    )
    totals = subtree_sums(tree.select("node", "parent", "leaves", "saved"), ["leaves", "saved"])
    return (
        tree.drop("leaves", "saved")
        .join(totals, "node")
        .join(_ends(paths, conversations), ["path_a", "path_b"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def _ends(paths: DataFrame, conversations: DataFrame) -> DataFrame:
    """``path_a, path_b, ends_sha256``: digest of the ids of the conversations that end at a node.

    Ids are joined in blocks of bounded size first, so that a task that hashes the ids of a node where very
    many conversations end reads few rows, one after the other.
    """
    none = F.lit(0).cast("long")
    last = conversations.select("conv_id", F.col("length").cast("long").alias("depth"))
    ends = (
        paths.join(last.where("depth > 0"), ["conv_id", "depth"])
        .select("path_a", "path_b", "conv_id")
        .union(last.where("depth = 0").select(none, none, "conv_id"))
    )
    listed = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    blocks = ends.groupBy(
        "path_a", "path_b", F.shiftright("conv_id", BLOCK_BITS).alias("block")
    ).agg(F.array_join(listed, ",").alias("ids"))

    def run(batches):
        node = digest = None
        for batch in batches:
            out: dict[str, list] = {"path_a": [], "path_b": [], "ends_sha256": []}
            for a, b, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)), strict=True):
                if node == (a, b):
                    digest.update(b"," + ids.encode())
                    continue
                if node:
                    _put(out, node, digest)
                node, digest = (a, b), hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_pydict(out, schema=schema)
        if node:
            out = {"path_a": [], "path_b": [], "ends_sha256": []}
            _put(out, node, digest)
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema(
        [("path_a", pa.int64()), ("path_b", pa.int64()), ("ends_sha256", pa.string())]
    )
    return (
        blocks.repartition("path_a", "path_b")
        .sortWithinPartitions("path_a", "path_b", "block")
        .mapInArrow(run, "path_a long, path_b long, ends_sha256 string")
    )


def _put(out: dict[str, list], node: tuple[int, int], digest) -> None:
    for name, value in zip(out, (*node, digest.hexdigest()), strict=True):
        out[name].append(value)


def _sized(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in few partitions when it has few rows, as every task of a shuffle leaves files behind."""
    return df.coalesce(max(MIN_TASKS, rows // NODES_PER_TASK))


def subtree_sums(tree: DataFrame, weights: list[str]) -> DataFrame:
    """``node`` and, for each of ``weights``, the sum over the node's subtree.

    ``tree`` has unique long ``node`` and the ``parent``, null for a root; several roots are allowed.
    """
    live = tree.select("node", "parent", *weights)
    raked: list[DataFrame] = []
    chains: list[DataFrame | None] = []
    size = live.count()
    while size:
        kids = live.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node"))
        kids = kids.agg(F.count("*").alias("n"), F.min("node").alias("only"))
        state = cut(_sized(live.join(kids, "node", "left"), size))
        chain_size = state.where("n = 1").count()
        rest = state.where("n IS NULL OR n > 1").select("node", "parent", "n", *weights)
        given = []
        if chain_size:
            chain = _compress(state.where("n = 1").drop("n"), weights, chain_size)
            chains.append(chain.select("node", "end", *weights))
            # the top is the one node of its chain that isn't the child of another
            inner = state.where("n = 1").select(F.col("only").alias("node"))
            tops = chain.join(inner, "node", "left_anti")
            above = tops.select(
                F.col("end").alias("node"), F.col("parent").alias("top_parent"), F.lit(True).alias("ends")
            )
            rest = rest.join(above, "node", "left").withColumn(
                "parent", F.when(F.col("ends"), F.col("top_parent")).otherwise(F.col("parent"))
            )
            rest = cut(_sized(rest.drop("top_parent", "ends"), size))
            given.append(tops.select("parent", *weights))
        else:
            chains.append(None)
        leaves = rest.where("n IS NULL")
        raked.append(leaves.select("node", *weights))
        given.append(leaves.select("parent", *weights))
        gift = given[0] if len(given) == 1 else given[0].union(given[1])
        gift = gift.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node"))
        gift = gift.agg(*(F.sum(w).alias(f"{w}_more") for w in weights))
        live = rest.where("n > 1").drop("n").join(gift, "node", "left")
        for w in weights:
            live = live.withColumn(w, F.col(w) + F.coalesce(f"{w}_more", F.lit(0))).drop(f"{w}_more")
        live = cut(_sized(live, size))
        size = live.count()
    return _expand(tree, raked, chains, weights)


def _compress(chain: DataFrame, weights: list[str], size: int) -> DataFrame:
    """``node, parent, end, weights``: the first node below the chain, and the weights down to there.

    Each node jumps over the one it points at, and over twice as many in the next round; those that point at
    the end are done and stay as they are, so no two nodes ever point at the same one in a join.
    """
    more = chain.select(F.col("node").alias("only"), F.lit(False).alias("done"))
    first = chain.join(more, "only", "left").select(
        "node", "parent", F.col("only").alias("end"), F.coalesce("done", F.lit(True)).alias("done"), *weights
    )
    first = cut(_sized(first, size))
    done, active = [first.where("done")], first.where("NOT done")
    while not active.isEmpty():
        known = active
        for part in done:
            known = known.union(part)
        jump = known.select(
            F.col("node").alias("end"),
            F.col("end").alias("to"),
            F.col("done").alias("arrives"),
            *(F.col(w).alias(f"{w}_more") for w in weights),
        )
        moved = active.drop("done").join(jump, "end").select(
            "node",
            "parent",
            F.col("to").alias("end"),
            F.col("arrives").alias("done"),
            *((F.col(w) + F.col(f"{w}_more")).alias(w) for w in weights),
        )
        moved = cut(_sized(moved, size))
        done.append(moved.where("done"))
        active = moved.where("NOT done")
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return cut(_sized(out.drop("done"), size))


def _expand(
    tree: DataFrame, raked: list[DataFrame], chains: list[DataFrame | None], weights: list[str]
) -> DataFrame:
    known = tree.select("node", *weights).limit(0)
    for leaves, chain in zip(reversed(raked), reversed(chains), strict=True):
        known = known.union(leaves)
        if chain is not None:
            end = known.select(F.col("node").alias("end"), *(F.col(w).alias(f"{w}_more") for w in weights))
            back = chain.join(end, "end").select(
                "node", *((F.col(w) + F.col(f"{w}_more")).alias(w) for w in weights)
            )
            known = known.union(cut(back))
    return known
