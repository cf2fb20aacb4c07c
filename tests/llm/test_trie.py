"""The prefix trie and its tree contraction against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from fieldmill.llm import trie
from fieldmill.llm.queries import op11_prefix_trie
from fieldmill.llm.scans import running_sums
from fieldmill.llm.tables import table

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_trie(conversations):
    """Rows of ``prefix_trie`` for a dict of id to turns."""
    members, children = defaultdict(list), defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    out, leaves, saved = [], {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in children[path]) if children[path] else 1
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        saved[path] = own + sum(saved[k] for k in children[path])
        ends = ",".join(str(c) for c in sorted(members[path]) if len(conversations[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append(
            (min(members[path]), len(path), parent, len(members[path]), len(children[path]), leaves[path])
            + (saved[path], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out)


def by_id(rows):
    found = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            found[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(role, text) for _, _, role, text in sorted(turns)] for c, turns in found.items()}


def rebuilt(conversations):
    out = {}
    for c, own in conversations.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = conversations.get(base, [])[:h] + own[h:]
    return out


def result(frame):
    turns = trie.numbered(frame)
    return sorted(map(tuple, trie.prefix_trie(turns, trie.lengths(turns)).collect()))


@pytest.fixture
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_query_equals_brute_force(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()
    assert sorted(map(tuple, op11_prefix_trie(spark, sf_dir).collect())) == brute_trie(rebuilt(by_id(rows)))


def test_odd_conversations(spark, many_partitions):
    chosen = random.Random(3)
    rows = [(c, t, chosen.choice("ab"), chosen.choice(["x", "é", ""])) for c in range(-6, 25) for t in range(c % 7)]
    rows += [(40, t, "user", f"t{t // 3}") for t in range(60)]  # one conversation with most turns
    rows += [(45, t, "user", f"t{t // 3}") for t in range(70)]
    rows += [(50, None, None, None), (50, None, "b", "z"), (50, 1, "a", None), (50, 1, "a", ""), (50, 1, "a", "q")]
    rows += [(51, 2, "r", "same"), (51, 2, "r", "same"), (51, 1, "r", "x" * 100 + "b"), (51, 1, "r", "x" * 64)]
    rows += [(None, 1, "r", "lost"), (60, 3, "user", "long " * 50_000)]
    chosen.shuffle(rows)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for name in ("node", "parent", "depth", "pos", "code", "bytes", "length", "path_a"):
        frame = frame.selectExpr("*", f"'x' AS {name}")
    plain = by_id(rows)
    assert result(frame) == brute_trie(plain)
    turns = trie.numbered(frame)
    shared = trie.prefix_trie(*trie.with_shared_starts(turns, trie.lengths(turns)))
    assert sorted(map(tuple, shared.collect())) == brute_trie(rebuilt(plain))


def test_empty_table_and_turnless_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert result(empty) == []
    turns = trie.numbered(spark.createDataFrame([(1, 0, "a", "x")], SCHEMA))
    listed = spark.createDataFrame([(1, 1), (-2, 0), (9, 0)], "conv_id long, length long")
    got = sorted(map(tuple, trie.prefix_trie(turns, listed).collect()))
    assert got == brute_trie({1: [("a", "x")], -2: [], 9: []})


def test_running_sums_over_partitions(spark, many_partitions):
    rows = [(k, i, (-1) ** i * (k % 3 + 1) * (1 << 61)) for k, n in enumerate((1, 500, 3, 0, 40)) for i in range(n)]
    frame = spark.createDataFrame(rows, "k long, i long, v long").repartition(7)
    total, want = defaultdict(int), {}
    for k, i, v in rows:
        before = total[k]
        total[k] += v
        want[k, i] = tuple((x + (1 << 63)) % (1 << 64) - (1 << 63) for x in (total[k], before))
    got = running_sums(frame, "k", ["i"], ["v"])
    assert got.rdd.getNumPartitions() > 3
    assert {(r.k, r.i): (r.v, r.v_before) for r in got.collect()} == want


@pytest.mark.parametrize("kind", ["chain", "star", "random", "brooms"])
def test_contraction_of_trees(spark, kind):
    chosen = random.Random(kind)
    n = 130
    up = {
        "chain": lambda i: i - 1,
        "star": lambda i: 0,
        "random": lambda i: chosen.randrange(i),
        "brooms": lambda i: i - 1 if i % 11 else max(0, i - 30),
    }[kind]
    parent = {0: None, **{i: up(i) for i in range(1, n)}, n: None, n + 1: n}
    weight = {i: chosen.randrange(100) for i in parent}
    want = dict(weight)
    for i in sorted(parent, reverse=True):
        if parent[i] is not None:
            want[parent[i]] += want[i]
    rows = [(i, parent[i], weight[i], 1) for i in parent]
    tree = spark.createDataFrame(rows, "node long, parent long, w long, one long")
    got = trie.subtree_sums(tree, ["w", "one"]).collect()
    assert {r.node: r.w for r in got} == want and len(got) == n + 2
    assert trie.subtree_sums(tree.limit(0), ["w"]).count() == 0
