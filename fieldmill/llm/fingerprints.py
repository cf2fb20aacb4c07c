"""Homomorphic multiset fingerprints of documents.

A text is the multiset of its paragraphs (lines).  Each paragraph is hashed into a wide vector, and the
vectors of all paragraphs are summed lane by lane modulo powers of two.  Sums do not depend on the
order, and a paragraph is inserted or deleted by adding or subtracting its vector.  There are two kinds
of lanes:

* 16 lanes modulo 2**64, each a full hash of the paragraph: 1,024 bits that differ for different
  multisets;
* 128 lanes modulo 2**32, in which the paragraph's word triples count with signs: each triple adds 1
  or -1 in one lane.  The cosine of these lanes follows the share of common triples and is near zero for
  unrelated texts.

The number of line breaks and the order of paragraphs are not part of a multiset, so two texts with
the same lines in another order have the same fingerprint.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.llm.words import U, mix, slices, word_block

EXACT_LANES = 16
SKETCH_LANES = 128
TRIPLE = 3
#: about so many documents are one range of doc_id, as long as that makes no more ranges than the limit
RANGE_DOCUMENTS = 4_000
MAX_RANGES = 20_000
_BEFORE_ALL = -(1 << 63)

PRINTS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double"
)


def _digest(paragraph: str) -> bytes:
    return hashlib.blake2b(paragraph.encode("utf-8", "surrogatepass"), digest_size=8).digest()


def vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The (exact, sketch) lane sums of each text."""
    exact = np.zeros((len(texts), EXACT_LANES), U)
    sketch = np.zeros((len(texts), SKETCH_LANES), np.uint32)
    salts = mix(np.arange(EXACT_LANES, dtype=U) + U(0x51ED2701))
    for low, high in slices(texts):
        # a paragraph is a text of its own here; ``owner`` tells whose it is
        lines = [t.split("\n") for t in texts[low:high]]
        owner = np.repeat(np.arange(low, high), [len(x) for x in lines])
        flat = [p for own in lines for p in own]
        hashes = np.frombuffer(b"".join(map(_digest, flat)), U)
        first = np.cumsum([0] + [len(x) for x in lines[:-1]])
        exact[low:high] = np.add.reduceat(mix(hashes[:, None] + salts), first, axis=0)
        block = word_block(flat)
        lanes, signs, whose = [], [], []
        for size in (1, TRIPLE):
            at, grams = block.gram_hashes(size)
            lanes.append((grams >> U(57)).astype(np.int64))
            signs.append(np.where(grams & U(1), 1, -1))
            whose.append(owner[block.doc[at]])
            if size == 1:  # single words only stand in for paragraphs too short for a triple
                short = np.diff(block.first)[block.doc[at]] < TRIPLE
                lanes[0], signs[0], whose[0] = (x[0][short] for x in (lanes, signs, whose))
        cell = np.concatenate(whose) * SKETCH_LANES + np.concatenate(lanes)
        base = low * SKETCH_LANES
        sums = np.bincount(
            cell - base, np.concatenate(signs), (high - low) * SKETCH_LANES
        ).astype(np.int64)
        sketch[low:high] = sums.reshape(-1, SKETCH_LANES).astype(np.uint32)
    return exact, sketch


def combined(a, b, sign: int = 1):
    """The vectors of a multiset to which another one is added (or taken from it with -1)."""
    if sign > 0:
        return a[0] + b[0], a[1] + b[1]
    return a[0] - b[0], a[1] - b[1]


def to_string(exact: np.ndarray, sketch: np.ndarray) -> str:
    return base64.b64encode(exact.astype("<u8").tobytes() + sketch.astype("<u4").tobytes()).decode()


def likeness(a, b) -> np.ndarray:
    """Row by row from 0 to 1: 1 for equal fingerprints, else the cosine of the sketch lanes."""
    same = (a[0] == b[0]).all(1) & (a[1] == b[1]).all(1)
    x, y = (v[1].astype(np.int32).astype(np.float64) for v in (a, b))
    size = np.sqrt((x * x).sum(1) * (y * y).sum(1))
    cosine = (x * y).sum(1) / np.where(size > 0, size, 1)
    return np.where(same, 1.0, np.clip(cosine, 0.0, 1.0))


def edited(text: str, following: str) -> str:
    """``text`` whose last half is replaced by as many first code points of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _in_ranges(docs: DataFrame) -> DataFrame:
    """``docs`` (at, doc_id, text) with its range of ``at``, and the first row of each range once more
    behind the range before (``head``); the first range counts as next to the last."""
    parts = min(MAX_RANGES, max(1, docs.count() // RANGE_DOCUMENTS))
    steps = [k / parts for k in range(1, parts)]
    found = docs.approxQuantile("at", steps, 0.1 / parts) if steps else []
    bounds = np.unique(np.array(found, np.float64).astype(np.int64))

    @F.pandas_udf("int")
    def range_of(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, at.to_numpy(), "right"))

    ranged = docs.withColumn("range", range_of("at"))
    firsts = ranged.groupBy("range").agg(F.min("at").alias("at")).orderBy("range").collect()
    before = [(firsts[k]["at"], firsts[k - 1]["range"]) for k in range(len(firsts))]
    heads = docs.sparkSession.createDataFrame(before, "at long, range int")
    # one row for each range, so at most MAX_RANGES
    again = docs.join(F.broadcast(heads), "at").select(
        "at", "doc_id", "text", "range", F.lit(True).alias("head")
    )
    return ranged.withColumn("head", F.lit(False)).unionByName(again)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next.

    The edited text is the text with its last half replaced by the start of the next document's, in
    ascending order of doc_id (the first one's after the last).  Null texts are empty.  Rows that
    share a doc_id follow in the order of their texts, and rows without one come first; a single row
    is its own next.  An empty input gives no rows; other columns are ignored.

    Documents are dealt into ranges of doc_id and sorted inside them, so texts are shuffled once.
    """
    docs = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_BEFORE_ALL)).alias("at"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = ["range", "head", "at", "text"]

    def run(batches):
        held: list = []
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in ("range", "head", "doc_id", "text")]
            rows = held + list(zip(*columns, strict=True))
            done = []
            for k in range(len(rows) - 1):
                if not rows[k][1]:
                    done.append((rows[k][2], rows[k][3], rows[k + 1][3]))
            held = rows[-1:]
            for low, high in slices([text for _, text, _ in done]):
                yield prints(done[low:high])

    def prints(rows):
        texts = [text for _, text, _ in rows]
        changed = [edited(text, following) for _, text, following in rows]
        # the next of a row is the row after it, but not at the end of a range or of these rows
        last = [k for k in range(len(rows)) if k + 1 == len(rows) or rows[k][2] is not texts[k + 1]]
        own = vectors(texts)
        coming = tuple(np.roll(v, -1, axis=0) for v in own)
        for v, x in zip(coming, vectors([rows[k][2] for k in last]), strict=True):
            v[last] = x
        other = vectors(changed)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
        kinds += (pa.float64(), pa.float64())
        columns = [
            [doc_id for doc_id, _, _ in rows],
            [len(t) for t in texts],
            [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
            [to_string(e, s) for e, s in zip(*own, strict=True)],
            [to_string(e, s) for e, s in zip(*other, strict=True)],
            likeness(own, other),
            likeness(own, coming),
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=[part.split()[0] for part in PRINTS.split(", ")],
        )

    return (
        _in_ranges(docs)
        .repartition("range")
        .sortWithinPartitions(*order)
        .select("range", "head", "doc_id", "text")
        .mapInArrow(run, PRINTS)
    )
