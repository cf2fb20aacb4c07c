"""Repeated passages found with a sparse suffix array.

A passage is a window of 50 words; it is a repeat when the same words stand earlier, in a document
with a smaller doc_id or further up in the same one.  Suffixes are kept only at positions chosen by
their content: of any 21 neighbouring positions the one whose next 30 words hash lowest (the first of
equals).  A window of 50 words spans exactly 21 such positions, so equal windows always keep the
suffix at the same place.  Suffixes whose first 30 words occur once cannot be in a repeat and go.

The others get 20 words of context to the left and right.  Sorted by first 30 words and right
context, each is compared with its neighbours: the common words to the right come from the order, and
the match is extended to the left.  What is matched less than 50 words this way may still meet a more
distant partner, longer on the left and shorter on the right; such windows, one for each of the 21
places of a suffix in them, are settled by sorting them by their whole content.  The earliest
occurrence of each window is looked up in the same order, so exactly the later ones are repeats.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.llm.tables import cut
from fieldmill.llm.words import U, mix, slices, word_block

WINDOW_WORDS = 50
SEED_WORDS = 30
#: words between two chosen suffixes at most, less one; also the context on either side
CONTEXT_WORDS = WINDOW_WORDS - SEED_WORDS
#: suffixes with the same first words that one task takes together; more are grouped by window
MAX_GROUP = 100_000

SPANS = "doc_id long, start_word long, end_word long, source_doc_id long, source_start long"


def _chosen(grams: np.ndarray, width: int) -> np.ndarray:
    """Places of the least value, the first of equals, of every ``width`` neighbours."""
    n = len(grams)
    if n < width:
        return np.zeros(0, np.int64)
    best = np.arange(n)
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(grams[right] < grams[left], right, left)
        reach += step
    return np.unique(best)


def suffixes(docs: DataFrame) -> DataFrame:
    """(seed, doc_id, pos) of the kept suffixes; ``seed`` hashes the first 30 words."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            texts = batch.column(1).to_pylist()
            for low, high in slices(texts):
                block = word_block(texts[low:high])
                at, grams = block.gram_hashes(SEED_WORDS)
                bounds = np.searchsorted(at, block.first)
                seeds, names, places = [], [], []
                for i in range(high - low):
                    a, b = bounds[i], bounds[i + 1]
                    own = _chosen(grams[a:b], CONTEXT_WORDS + 1)
                    if len(own):
                        seeds.append(grams[a:b][own])
                        names.append(np.full(len(own), ids[low + i]))
                        places.append(own)
                if seeds:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(seeds).view(np.int64)),
                            pa.array(np.concatenate(names).astype(np.int64)),
                            pa.array(np.concatenate(places).astype(np.int32)),
                        ],
                        names=["seed", "doc_id", "pos"],
                    )

    return docs.mapInArrow(run, "seed long, doc_id long, pos int")


def _with_context(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """Rows (seed, doc_id, pos, n, before, after): hashes of the words on either side of the seed.

    ``before`` is read leftwards.  Beyond the ends of a text stands a value that equals no other.
    """
    wanted = repeated.groupBy("doc_id").agg(
        F.collect_list(F.struct("pos", "seed", "n")).alias("wanted")
    )
    joined = docs.join(wanted, "doc_id").select("doc_id", "text", "wanted")

    def run(batches):
        for batch in batches:
            texts, ids = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            lists = batch.column(2)
            flat, offsets = lists.flatten(), np.asarray(lists.offsets) - lists.offsets[0].as_py()
            pos_all = flat.field(0).to_numpy(zero_copy_only=False)
            for low, high in slices(texts):
                block = word_block(texts[low:high])
                small = (block.hash >> U(32)).astype(np.uint32)
                for i in range(low, high):
                    own = slice(offsets[i], offsets[i + 1])
                    pos = pos_all[own].astype(np.int64)
                    words = small[block.first[i - low] : block.first[i - low + 1]]
                    # distinct values outside the text: they depend on document and place
                    edge = mix(
                        np.arange(2 * CONTEXT_WORDS, dtype=U) + U(ids[i] % (1 << 64)) * U(64)
                    )
                    padded = np.concatenate(
                        [
                            (edge[:CONTEXT_WORDS] >> U(32)).astype(np.uint32),
                            words,
                            (edge[CONTEXT_WORDS:] >> U(32)).astype(np.uint32),
                        ]
                    )
                    reach = np.arange(CONTEXT_WORDS)
                    before = padded[pos[:, None] + CONTEXT_WORDS - 1 - reach]
                    after = padded[pos[:, None] + CONTEXT_WORDS + SEED_WORDS + reach]
                    left = np.minimum(pos, CONTEXT_WORDS).astype(np.int32)
                    right = np.minimum(len(words) - SEED_WORDS - pos, CONTEXT_WORDS)
                    n = len(pos)
                    yield pa.RecordBatch.from_arrays(
                        [
                            flat.field(1)[own],
                            pa.array(np.full(n, ids[i], np.int64)),
                            pa.array(pos.astype(np.int32)),
                            flat.field(2)[own],
                            pa.array([x.tobytes() for x in before.astype(">u4")], pa.binary()),
                            pa.array([x.tobytes() for x in after.astype(">u4")], pa.binary()),
                            pa.array(left),
                            pa.array(right.astype(np.int32)),
                        ],
                        names=["seed", "doc_id", "pos", "n", "before", "after", "left", "right"],
                    )

    return joined.mapInArrow(
        run,
        "seed long, doc_id long, pos int, n long, before binary, after binary, left int, right int",
    )


def _prefix_hashes(context: np.ndarray) -> np.ndarray:
    """Column j hashes the first j words of each row."""
    out = np.zeros((len(context), CONTEXT_WORDS + 1), U)
    for j in range(CONTEXT_WORDS):
        out[:, j + 1] = mix(out[:, j] * U(0x9E3779B97F4A7C15) + context[:, j] + U(1))
    return out


def _window_keys(seed, before, after, place):
    """The hash of the window that has ``place`` words before the seed."""
    return mix(seed + mix(before[:, place]) + mix(after[:, CONTEXT_WORDS - place] + U(7)))


def _settle(seed, doc, pos, before, after, left, right) -> pd.DataFrame:
    """Repeats among suffixes sorted by (seed, after): all of each seed are here."""
    same = seed[1:] == seed[:-1]
    equal_right = np.cumprod(after[1:] == after[:-1], axis=1).sum(1) * same
    equal_left = np.cumprod(before[1:] == before[:-1], axis=1).sum(1) * same
    long_enough = equal_left + equal_right >= CONTEXT_WORDS
    matched = np.append(False, long_enough) | np.append(long_enough, False)
    # a group of two is settled by its one comparison; in larger ones a distant partner may fit
    starts = np.flatnonzero(np.append(True, ~same))
    size = np.diff(np.append(starts, len(seed)))
    group = np.repeat(np.arange(len(starts)), size)
    live = matched | (np.repeat(size, size) > 2)
    live &= (left + right) >= CONTEXT_WORDS
    rows = np.flatnonzero(live)
    out = []
    if len(rows):
        ahead, behind = _prefix_hashes(before[rows]), _prefix_hashes(after[rows])
        for place in range(CONTEXT_WORDS + 1):
            fits = np.flatnonzero((left[rows] >= place) & (right[rows] >= CONTEXT_WORDS - place))
            if not len(fits):
                continue
            at = rows[fits]
            key = _window_keys(seed[at], ahead[fits], behind[fits], place)
            order = np.lexsort((pos[at], doc[at], key))
            key, at = key[order], at[order]
            new = np.append(True, key[1:] != key[:-1])
            head = np.flatnonzero(new)[np.cumsum(new) - 1]
            later = np.flatnonzero(~new & ((doc[at] != doc[at[head]]) | (pos[at] != pos[at[head]])))
            a, b = at[later], at[head[later]]
            out.append(np.stack([doc[a], pos[a] - place, doc[b], pos[b] - place]))
    found = np.concatenate(out, 1) if out else np.zeros((4, 0), np.int64)
    return pd.DataFrame(
        {
            "doc_id": found[0],
            "start_word": found[1],
            "source_doc_id": found[2],
            "source_start": found[3],
        }
    )


WINDOWS = "doc_id long, start_word long, source_doc_id long, source_start long"


def _compare_sorted(rows: DataFrame) -> DataFrame:
    """Repeated windows among suffixes with few enough equals to meet in one task."""

    def unpack(column):
        raw = np.frombuffer(b"".join(column), ">u4").astype(U)
        return raw.reshape(-1, CONTEXT_WORDS)

    def run(frames):
        held = None
        for frame in frames:
            if held is not None:
                frame = pd.concat([held, frame], ignore_index=True)
            seed = frame["seed"].to_numpy()
            last = np.searchsorted(seed, seed[-1]) if len(seed) else 0
            held = frame.iloc[last:]
            if last:
                yield settle(frame.iloc[:last])
        if held is not None and len(held):
            yield settle(held)

    def settle(frame):
        return _settle(
            frame["seed"].to_numpy().view(U),
            frame["doc_id"].to_numpy(),
            frame["pos"].to_numpy().astype(np.int64),
            unpack(frame["before"]),
            unpack(frame["after"]),
            frame["left"].to_numpy(),
            frame["right"].to_numpy(),
        )

    return (
        rows.repartition("seed")
        .sortWithinPartitions("seed", "after", "doc_id", "pos")
        .mapInPandas(run, WINDOWS)
    )


def _compare_by_window(rows: DataFrame) -> DataFrame:
    """Repeated windows of very frequent seeds: one row per window, the earliest by aggregation."""

    def run(batches):
        for batch in batches:
            seed = batch.column(0).to_numpy(zero_copy_only=False).view(U)
            doc = batch.column(1).to_numpy(zero_copy_only=False)
            pos = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            context = [
                np.frombuffer(b"".join(batch.column(k).to_pylist()), ">u4")
                .astype(U)
                .reshape(-1, CONTEXT_WORDS)
                for k in (4, 5)
            ]
            left, right = (batch.column(k).to_numpy(zero_copy_only=False) for k in (6, 7))
            ahead, behind = (_prefix_hashes(c) for c in context)
            for place in range(CONTEXT_WORDS + 1):
                fits = (left >= place) & (right >= CONTEXT_WORDS - place)
                key = _window_keys(seed[fits], ahead[fits], behind[fits], place)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.view(np.int64)),
                        pa.array(doc[fits]),
                        pa.array(pos[fits] - place),
                    ],
                    names=["key", "doc_id", "start_word"],
                )

    windows = rows.mapInArrow(run, "key long, doc_id long, start_word long")
    least = windows.groupBy("key").agg(
        F.min(F.struct("doc_id", "start_word")).alias("source"), F.count("*").alias("n")
    )
    return (
        windows.join(least.where("n > 1").select("key", "source"), "key")
        .where("struct(doc_id, start_word) != source")
        .select(
            "doc_id",
            "start_word",
            F.col("source.doc_id").alias("source_doc_id"),
            F.col("source.start_word").alias("source_start"),
        )
    )


def _merge(windows: DataFrame) -> DataFrame:
    """Neighbouring repeated windows with the same shift to their source become one span."""

    def run(frames):
        held = None
        for frame in frames:
            if held is not None:
                frame = pd.concat([held, frame], ignore_index=True)
            doc = frame["doc_id"].to_numpy()
            last = np.searchsorted(doc, doc[-1]) if len(doc) else 0
            held = frame.iloc[last:]
            if last:
                yield spans(frame.iloc[:last])
        if held is not None and len(held):
            yield spans(held)

    def spans(frame):
        frame = frame.drop_duplicates()
        doc, start = frame["doc_id"].to_numpy(), frame["start_word"].to_numpy()
        source = frame["source_doc_id"].to_numpy()
        shift = frame["source_start"].to_numpy() - start
        order = np.lexsort((start, shift, source, doc))
        doc, start, source, shift = doc[order], start[order], source[order], shift[order]
        new = np.ones(len(doc), bool)
        new[1:] = (
            (doc[1:] != doc[:-1])
            | (source[1:] != source[:-1])
            | (shift[1:] != shift[:-1])
            | (start[1:] > start[:-1] + WINDOW_WORDS)
        )
        first = np.flatnonzero(new)
        final = np.append(first[1:], len(doc)) - 1
        return pd.DataFrame(
            {
                "doc_id": doc[first],
                "start_word": start[first],
                "end_word": start[final] + WINDOW_WORDS,
                "source_doc_id": source[first],
                "source_start": start[first] + shift[first],
            }
        )

    return windows.repartition("doc_id").sortWithinPartitions("doc_id").mapInPandas(run, SPANS)


def _numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with ``_row``, which tells texts apart and orders them, and its ``_row, doc_id`` where it
    isn't the doc_id itself.

    The doc_id does as long as no two texts share one; then numbers are dealt by doc_id and text hash.
    Only hashes of the texts are shuffled.
    """
    own = F.col("doc_id").cast("long")
    hashed = docs.where("doc_id is not null and text is not null")
    hashed = hashed.select(own.alias("_id"), F.xxhash64("text").alias("_hash"))
    pairs = hashed.groupBy("_id").agg(F.min("_hash").alias("low"), F.max("_hash").alias("high"))
    if pairs.where("low != high").isEmpty():
        return docs.withColumn("_row", own), None
    numbers = cut(
        hashed.distinct().orderBy("_id", "_hash").withColumn("_row", F.monotonically_increasing_id())
    )
    keyed = docs.withColumns({"_id": own, "_hash": F.xxhash64("text")})
    dealt = keyed.join(numbers, ["_id", "_hash"], "left").drop("_id", "_hash")
    return dealt.select(*docs.columns, "_row"), numbers.select("_row", F.col("_id").alias("doc_id"))


def _spans(numbered: DataFrame, max_group: int) -> DataFrame:
    """``repeated_spans`` with ``_row`` in the place of doc_id."""
    docs = numbered.select(F.col("_row").alias("doc_id"), "text").where(
        "doc_id is not null and text is not null"
    )
    kept = cut(suffixes(docs))
    # written out, so that the join reads plain shuffles and AQE can split a very frequent seed
    often = cut(kept.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1"))
    rows = cut(_with_context(docs, kept.join(often, "seed")))
    found = _compare_sorted(rows.where(F.col("n") <= max_group)).union(
        _compare_by_window(rows.where(F.col("n") > max_group))
    )
    return _merge(found)


def repeated_spans(docs: DataFrame, max_group: int = MAX_GROUP) -> DataFrame:
    """Spans of words that stand earlier already: doc_id, start_word, end_word (exclusive),
    source_doc_id, source_start.

    Every word of a span lies in a window of 50 words that occurs at the source first; a word may lie
    in spans of several sources.  Words are lowered (A-Z) and counted from 0.  Null, empty and short
    texts have no spans, and rows without a doc_id take no part.  Different texts with the same doc_id
    are documents of their own, in the order of their hashes; equal rows are one.  An empty table gives
    no spans.  Other columns are ignored.
    """
    numbered, names = _numbered(docs.select("doc_id", "text"))
    spans = _spans(numbered, max_group)
    if names is None:
        return spans
    source = names.toDF("source_doc_id", "_source")
    spans = spans.withColumnRenamed("doc_id", "_row").join(names, "_row").join(source, "source_doc_id")
    return spans.select(
        "doc_id", "start_word", "end_word", F.col("_source").alias("source_doc_id"), "source_start"
    )


def drop_repeats(docs: DataFrame, max_group: int = MAX_GROUP) -> DataFrame:
    """``docs`` with every repeated span cut out of its text, and n_chars set anew where cut.

    The first occurrence of each passage stays.  A text that consists of repeats becomes empty; its
    row stays.  Rows without repeats are unchanged, as are those without a doc_id or text.  Different
    texts with the same doc_id are cut each by its own spans; equal rows are cut alike.  An empty table
    stays empty, and other columns stay as they are.
    """
    numbered, _ = _numbered(docs)
    cuts = (
        _spans(numbered, max_group)
        .groupBy(F.col("doc_id").alias("_row"))
        .agg(F.collect_set(F.struct("start_word", "end_word")).alias("_cuts"))
    )
    columns = docs.columns

    def run(batches):
        for batch in batches:
            texts, cuts = batch.column("text").to_pylist(), batch.column("_cuts").to_pylist()
            left = [t if not c else without(t, c) for t, c in zip(texts, cuts, strict=True)]
            out = {name: batch.column(name) for name in columns}
            out["text"] = pa.array(left, pa.string())
            if "n_chars" in out:
                own = out["n_chars"].to_pylist()
                out["n_chars"] = pa.array(
                    [len(t) if c else n for t, c, n in zip(left, cuts, own, strict=True)],
                    out["n_chars"].type,
                )
            yield pa.RecordBatch.from_arrays(list(out.values()), names=columns)

    def without(text, cuts):
        block = word_block([text])
        keep, at = [], 0
        for low, high in sorted((c["start_word"], c["end_word"]) for c in cuts):
            begin, end = block.start[low], block.start[high] if high < len(block.start) else None
            if begin > at:
                keep.append(block.data[at:begin])
            at = max(at, len(block.data) if end is None else end)
        keep.append(block.data[at:])
        return b"".join(keep).decode("utf-8", "surrogatepass")

    return numbered.join(cuts, "_row", "left").drop("_row").mapInArrow(run, docs.schema)
