"""A linear toxicity classifier on character n-grams scaled by naive Bayes log-count ratios.

Runs of four to six characters of the lowered text, with ASCII signs and white space as spaces, are
hashed into 2**20 features, of which a text has each or not.  A feature's log-count ratio compares how often it occurs in toxic and in other
training texts.  The features with the strongest evidence become the columns of a logistic
regression whose inputs are these ratios.  Counting, featurizing and scoring run in Spark tasks; the
driver sees the selected features and, for the fit, the sparse rows of the bounded sample.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmill.llm.words import slices

GRAM_SIZES = (4, 5, 6)
FEATURE_BITS = 20
#: at most about so many labelled texts are used for fitting, chosen by a hash of doc_id
MAX_TRAINING_ROWS = 40_000
#: at most so many features enter the regression
MAX_FEATURES = 6_000
#: an n-gram counts as evidence from so many training texts on
MIN_TEXTS = 4
SMOOTHING = 0.5
THRESHOLD = 0.3
PENALTY = 2.0
_PIECE = 1 << 19
#: characters featurized at once
_BLOCK = 1 << 18

#: letters and digits of ASCII stay, all else of it is a space
_PLAIN = np.array([c if chr(c).isalnum() else 32 for c in range(128)], np.uint32)


def _grams(texts: list[str | None], wanted: np.ndarray | None = None):
    """Distinct (text number, feature) of the texts, sorted; only features with ``wanted`` >= 0."""
    lowered = [(t or "").lower() for t in texts]
    points = np.frombuffer(" \n ".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(points < 128, _PLAIN[points & np.uint32(127)], points)
    starts = np.cumsum([0] + [len(t) + 3 for t in lowered])
    docs, features = [], []
    for n in GRAM_SIZES:
        m = len(points) - n + 1
        if m <= 0:
            continue
        h = np.full(m, np.uint32(0x9E3779B1 * n % (1 << 32)), np.uint32)
        for j in range(n):
            h *= np.uint32(0x01000193)
            h ^= points[j : j + m]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        h *= np.uint32(0x297A2D39)
        h >>= np.uint32(32 - FEATURE_BITS)
        at = np.arange(m) if wanted is None else np.flatnonzero(wanted[h] >= 0)
        doc = np.searchsorted(starts, at, "right") - 1
        whole = at + n <= starts[doc + 1] - 1
        docs.append(doc[whole])
        features.append(h[at[whole]].astype(np.int64))
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = np.unique(np.concatenate(docs) << FEATURE_BITS | np.concatenate(features))
    return both >> FEATURE_BITS, both & ((1 << FEATURE_BITS) - 1)


@dataclass
class Model:
    """``column[feature]`` is its place in ``weights`` or -1; ``weights`` hold ratio times slope."""

    column: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        for low, high in slices(texts, _BLOCK):
            doc, feature = _grams(texts[low:high], self.column)
            total = np.bincount(doc, self.weights[self.column[feature]], high - low)
            out[low:high] = 1 / (1 + np.exp(-np.clip(total + self.bias, -30, 30)))
        return out


def _logistic(rows, cols, ratios, labels, penalty, steps=10, inner=15):
    """Slopes and bias of an L2-regularised logistic regression, by truncated Newton steps.

    Text ``rows[k]`` has feature ``cols[k]``, whose input is its ratio.  Products go over pieces of
    these arrays, so that only the narrow arrays themselves take memory.
    """
    n, n_cols = len(labels), len(ratios)
    pieces = [slice(k, k + _PIECE) for k in range(0, len(rows), _PIECE)]

    def times(x):
        scaled, out = ratios * x[:-1], np.zeros(n)
        for piece in pieces:
            out += np.bincount(rows[piece], scaled[cols[piece]], n)
        return out + x[-1]

    def back(x):
        out = np.zeros(n_cols)
        for piece in pieces:
            out += np.bincount(cols[piece], x[rows[piece]], n_cols)
        return np.append(ratios * out, x.sum())

    pull = np.append(np.full(n_cols, float(penalty)), 1e-6)
    share = (labels.sum() + 0.5) / (n + 1)
    at = np.append(np.zeros(n_cols), np.log(share / (1 - share)))

    def loss(x):
        margin = times(x)
        return float((np.logaddexp(0, margin) - labels * margin).sum() + (pull * x * x).sum() / 2)

    now = loss(at)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(times(at), -30, 30)))
        bend = p * (1 - p)
        left = -(back(p - labels) + pull * at)
        move, way, size = np.zeros_like(at), left.copy(), float(left @ left)
        for _ in range(inner):
            if size < 1e-10:
                break
            curve = back(bend * times(way)) + pull * way
            pace = size / float(way @ curve)
            move += pace * way
            left -= pace * curve
            size, old = float(left @ left), size
            way = left + size / old * way
        length = 1.0
        while length > 1e-3 and loss(at + length * move) > now:
            length /= 2
        at = at + length * move
        before, now = now, loss(at)
        if before - now < 1e-5 * abs(before):
            break
    return at[:-1], float(at[-1])


def fit(labelled: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> Model:
    """Learn from (doc_id, text, toxic).

    Rows without a label are left out.  Without any row, or with one class only, the model has no
    features and scores the smoothed share of toxic rows.
    """
    labelled = labelled.where("toxic is not null").select(
        "doc_id", "text", (F.col("toxic") == 1).cast("int").alias("toxic")
    )
    count = labelled.count()
    if count > max_rows:
        share = int(max_rows / count * 1_000_000)
        labelled = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share)
    tasks = 8  # few, as each hands over counts for nearly all features
    sample = labelled.repartition(tasks, F.xxhash64("doc_id", F.lit(9)))

    def count_grams(batches):
        size = 1 << FEATURE_BITS
        seen = np.zeros((2, size), np.int64)
        texts_seen = np.zeros(2, np.int64)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            labels = np.array(batch.column(2).to_pylist(), np.int64)
            texts_seen += np.bincount(labels, minlength=2)
            for low, high in slices(texts, _BLOCK):
                doc, feature = _grams(texts[low:high])
                label = labels[low:high][doc]
                for k in (0, 1):
                    seen[k] += np.bincount(feature[label == k], minlength=size)
        found = np.flatnonzero(seen.sum(0))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(found, -1)),
                pa.array(np.append(seen[1][found], texts_seen[1])),
                pa.array(np.append(seen[0][found], texts_seen[0])),
            ],
            names=["feature", "toxic", "clean"],
        )

    counts = (
        sample.mapInArrow(count_grams, "feature long, toxic long, clean long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    counts = counts.persist()
    totals = counts.where("feature < 0").first()
    toxic, clean = (totals["toxic"], totals["clean"]) if totals else (0, 0)
    a, b = F.col("toxic") + F.lit(SMOOTHING), F.col("clean") + F.lit(SMOOTHING)
    ratio = F.log(a / F.lit(toxic + 2 * SMOOTHING)) - F.log(b / F.lit(clean + 2 * SMOOTHING))
    chosen = (
        counts.where((F.col("feature") >= 0) & (F.col("toxic") + F.col("clean") >= MIN_TEXTS))
        .select("feature", ratio.alias("ratio"), F.sqrt(a * b / (a + b)).alias("weight"))
        .orderBy(F.desc(F.abs(F.col("ratio") * F.col("weight"))), "feature")
        .limit(MAX_FEATURES)
        .toPandas()
    )
    counts.unpersist()
    column = np.full(1 << FEATURE_BITS, -1, np.int32)
    prior = float(np.log((toxic + SMOOTHING) / (clean + SMOOTHING)))
    if not toxic or not clean or not len(chosen):
        return Model(column, np.zeros(0), prior)
    features, ratios = chosen["feature"].to_numpy(), chosen["ratio"].to_numpy()
    column[features] = np.arange(len(features))

    def to_columns(batches):
        for batch in batches:
            texts, found = batch.column(1).to_pylist(), []
            for low, high in slices(texts, _BLOCK):
                doc, feature = _grams(texts[low:high], column)
                bounds = np.searchsorted(doc, np.arange(high - low + 1))
                places = column[feature].astype(np.int16)
                found += [places[bounds[i] : bounds[i + 1]].tobytes() for i in range(high - low)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array(found, pa.binary())], names=["toxic", "places"]
            )

    held = sample.mapInArrow(to_columns, "toxic int, places binary").toArrow()
    places = [np.frombuffer(x, np.int16) for x in held.column("places").to_pylist()]
    labels = held.column("toxic").to_numpy().astype(float)
    cols = np.concatenate(places)
    rows = np.repeat(np.arange(len(places), dtype=np.int32), [len(x) for x in places])
    slope, bias = _logistic(rows, cols, ratios, labels, PENALTY)
    return Model(column, slope * ratios, bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score): one row per row of ``docs`` (doc_id, text); a null text scores as empty."""

    def run(batches):
        for batch in batches:
            found = model.scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found)], names=["doc_id", "score"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, score double"
    )


def is_held_out(doc_id: Column) -> Column:
    """Rows never learned from: remainder 2 of crc32 of the id's text by 4.  A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))


def train_on(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the labelled documents outside the held-out fold."""
    marks = labels.where(~is_held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")
    )
    return fit(docs.select("doc_id", "text").join(marks, "doc_id"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1), predicted (1 from 0.3 on).

    Learns from ``labels`` (doc_id, toxic) outside the held-out fold.  Null and empty texts get the
    model's score of an empty text; a null doc_id is held out; repeated rows are scored alike; an
    empty ``docs`` gives no rows and an empty ``labels`` scores all alike; other columns are ignored.
    """
    return score(docs, train_on(docs, labels)).select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, training: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those that score 0.3 or more by what ``training`` and ``labels`` teach."""
    model = train_on(training, labels)

    def run(batches):
        for batch in batches:
            found = model.scores(batch.column("text").to_pylist())
            yield batch.filter(pa.array(found < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
