"""Whitening of embeddings by spectrum slicing.

The covariance of all vectors is summed over the tasks.  Its eigenvalues are then found one by one: the
signs in an LDLᵀ factorization of ``V - shift`` count the eigenvalues above the shift, so halving
intervals by such counts isolates each; Rayleigh quotient iteration from there converges cubically; counts
on both sides of the result certify its number.  Eigenvalues that no shift can part are one cluster, whose
vectors are made orthogonal to each other.

Entries enter as whole numbers ``floor(64 * c) + 1000000``, so sums and deviations are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: the scale and the offset of the whole numbers
SCALE, OFFSET = 64.0, 1_000_000
COMPONENTS = 32
LARGEST = 2.0**60  # greatest size of a scaled entry, so that differences stay within a long
ROWS = 4096  # rows that a task expands at once
#: eigenvalues below this share of the greatest are rounding: such a component can't be whitened
RANK = 1e-12
_NEAR = 64 * np.finfo(float).eps  # shifts closer than this, relative to the norm, aren't told apart
_ALPHA = (1 + 17**0.5) / 8  # fixed value: the bound that limits growth in this pivoting


def inertia(matrix: np.ndarray, shift: float) -> int:
    """The number of eigenvalues above ``shift``: positive ones of D in an LDLᵀ of ``matrix - shift``.

    Pivots are single entries or 2 by 2 blocks, chosen by columns so that factors stay bounded.
    """
    a = matrix - shift * np.eye(len(matrix))
    k, n, positive = 0, len(a), 0
    while k < n:
        column = np.abs(a[k + 1 :, k])
        size, r, most = 1, k, 0.0
        if len(column):
            r = k + 1 + int(column.argmax())
            most = column[r - k - 1]
        if most > 0 and abs(a[k, k]) < _ALPHA * most:
            beside = np.abs(a[r, k:])
            beside[r - k] = 0
            widest = beside.max()
            if abs(a[k, k]) * widest >= _ALPHA * most**2:
                r = k
            elif abs(a[r, r]) < _ALPHA * widest:
                size = 2
        else:
            r = k
        to = k + size - 1
        if r != to:
            a[[to, r]] = a[[r, to]]
            a[:, [to, r]] = a[:, [r, to]]
        rest = slice(k + size, n)
        if size == 1:
            pivot = a[k, k]
            positive += pivot > 0
            if pivot != 0:
                a[rest, rest] -= np.outer(a[rest, k], a[k, rest] / pivot)
        else:
            positive += 1  # such a block has one eigenvalue of each sign
            block = a[k : k + 2, k : k + 2]
            det = block[0, 0] * block[1, 1] - block[0, 1] ** 2
            turned = np.array([[block[1, 1], -block[0, 1]], [-block[0, 1], block[0, 0]]]) / det
            a[rest, rest] -= a[rest, k : k + 2] @ turned @ a[k : k + 2, rest]
        k += size
    return int(positive)


@dataclass(frozen=True)
class Spectrum:
    """Leading eigenvalues (falling) with their unit vectors as columns."""

    values: np.ndarray
    vectors: np.ndarray


def _slices(v: np.ndarray, wanted: int) -> list[tuple[float, float, int, int]]:
    """(low, high, first, last): intervals that hold eigenvalues number first to last and no other.

    An interval is cut until it holds one eigenvalue, and is short against its distance from the next
    ones, or until its ends can't be told apart.
    """
    norm = float(np.abs(v).sum(1).max()) or 1.0
    top, bottom = norm * (1 + 1e-9), -norm * (1 + 1e-9)
    open_ = [(bottom, top, len(v), 0)]  # eigenvalues above the low and the high end
    done = []
    while open_:
        low, high, above_low, above_high = open_.pop()
        if above_low == above_high or above_high >= wanted:
            continue
        if high - low <= _NEAR * norm:
            done.append((low, high, above_high + 1, above_low))
            continue
        if above_low - above_high == 1 and high - low <= 1e-6 * norm:
            done.append((low, high, above_high + 1, above_low))
            continue
        middle = (low + high) / 2
        above = inertia(v, middle)
        open_.append((low, middle, above_low, above))
        open_.append((middle, high, above, above_high))
    return sorted(done, key=lambda x: x[2])


def _iterate(v: np.ndarray, start: float, basis: np.ndarray, seed: int) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration, orthogonal to ``basis``."""
    x = np.random.default_rng(seed).standard_normal(len(v))
    shift, eye = start, np.eye(len(v))
    norm = np.abs(v).sum(1).max()
    for step in range(30):
        try:
            y = np.linalg.solve(v - shift * eye, x)
        except np.linalg.LinAlgError:
            y = np.linalg.solve(v - (shift + _NEAR * norm) * eye, x)
        for _ in range(2):
            y -= basis @ (basis.T @ y)
        x = y / np.linalg.norm(y)
        image = v @ x
        if step < 2:
            continue  # the first steps keep the shift, and so the eigenvalue aimed at
        shift = float(x @ image)
        if np.linalg.norm(image - shift * x) <= 4 * np.finfo(float).eps * norm:
            break
    return float(x @ (v @ x)), x


def leading_spectrum(v: np.ndarray, wanted: int = COMPONENTS) -> Spectrum:
    """The ``wanted`` greatest eigenvalues of a symmetric matrix with their vectors.

    Of a vector and its opposite the one whose largest entry is positive is given.  Raises an error if
    the counts beside a result don't confirm its number.
    """
    n = len(v)
    wanted = min(wanted, n)
    values: list[float] = []
    vectors = np.zeros((n, 0))
    norm = float(np.abs(v).sum(1).max()) or 1.0
    for low, high, first, last in _slices(v, wanted):
        cluster = np.zeros((n, 0))
        found = []
        for number in range(first, last + 1):
            near = vectors[:, [k for k, e in enumerate(values) if e - high < 1e-3 * norm]]
            value, x = _iterate(v, (low + high) / 2, np.hstack([near, cluster]), number)
            cluster = np.hstack([cluster, x[:, None]])
            found.append(value)
        slack = 8 * _NEAR * norm
        if min(found) < low - slack or max(found) > high + slack:
            raise ArithmeticError("an iteration left its interval")
        if inertia(v, max(found) + slack) > first - 1 or inertia(v, min(found) - slack) < last:
            raise ArithmeticError("counts don't confirm the number of an eigenvalue")
        order = np.argsort(found)[::-1]
        values += [found[k] for k in order]
        vectors = np.hstack([vectors, cluster[:, order]])
    vectors = vectors[:, :wanted]
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return Spectrum(np.array(values[:wanted]), vectors * sign)


def _matrices(batches, d: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, whole numbers) of a batch in parts of bounded size."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part.column(0), part.column(1).flatten().to_numpy().reshape(-1, d)


def whole_vectors(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key, x``: vectors with finite entries only, as whole numbers.

    A null or empty vector and one with a null or non-finite entry is dropped.  Entries whose number
    passes ``LARGEST`` count as that.
    """
    entries = F.col(vector)
    odd = F.exists(
        entries,
        lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")),
    )

    def number(c):
        scaled = F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), c.cast("double") * SCALE))
        return F.floor(scaled).cast("long") + F.lit(OFFSET)

    return embeddings.where((F.size(entries) > 0) & ~odd).select(
        F.col(key).alias("key"), F.transform(entries, number).alias("x")
    )


def _usual_length(vectors: DataFrame) -> tuple[int, int] | None:
    """(length, rows) of the most common length, the greatest of ties; None without vectors."""
    sizes = vectors.groupBy(F.size("x").alias("d")).count()
    found = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return (found["d"], found["count"]) if found else None


def _column_sums(vectors: DataFrame, d: int) -> list[int]:
    """The exact sum of each dimension: partial sums a task, then as decimals."""

    def run(batches):
        total = [0] * d
        for _, x in _matrices(batches, d):
            high, low = np.divmod(x, 1 << 31)  # sums of the halves stay within a long
            for k, (a, b) in enumerate(zip(high.sum(0).tolist(), low.sum(0).tolist(), strict=True)):
                total[k] += (a << 31) + b
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(d), pa.int32()), pa.array(map(str, total), pa.string())],
            names=["k", "total"],
        )

    parts = vectors.mapInArrow(run, "k int, total string")
    sums = parts.groupBy("k").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    return [int(r["total"]) for r in sums.orderBy("k").collect()]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``x - sums / n``: the whole part of the mean goes off exactly, the rest as a double."""
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(float) - part


def _second_moment(rows: DataFrame, d: int, width: int, vectors_of) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``y`` and of ``y yᵀ`` over ``vectors_of(x)``, each of the given width."""

    def run(batches):
        first, second = np.zeros(width), np.zeros((width, width))
        for _, x in _matrices(batches, d):
            y = vectors_of(x)
            first += y.sum(0)
            second += y.T @ y
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(-1, width, dtype=np.int32)),
                pa.array([first.tolist(), *second.tolist()], pa.list_(pa.float64())),
            ],
            names=["i", "entries"],
        )

    parts = rows.mapInArrow(run, "i int, entries array<double>")
    # one row for each line of the matrix and task: its size doesn't depend on the number of vectors
    sums = (
        parts.select("i", F.posexplode("entries").alias("j", "v"))
        .groupBy("i", "j")
        .agg(F.sum("v").alias("v"))
        .collect()
    )
    out = np.zeros((width + 1, width))
    for i, j, value in sums:
        out[i + 1, j] = value
    return out[0], out[1:]


def whiten(
    embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per vector and component: its whitened coordinate, with measures of the fit.

    ``key, component, n, deviation, whitened, explained, identity_error``; ``deviation`` is an exact
    decimal, null from 10**38 on.  All vectors fit the covariance, repeated rows each time, and rows without a key too; those
    that ``whole_vectors`` drops, or whose length isn't the most common one, get no row.  A component whose
    variance is zero up to rounding has none either, so a table without vectors, or with equal vectors
    only, gives no rows.  Other columns are not read.  The driver holds the covariance, whose size is the
    square of the dimension.
    """
    spark = embeddings.sparkSession
    kind = embeddings.schema[key].dataType.simpleString()
    schema = (
        f"key {kind}, component int, n long, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double"
    )
    vectors = whole_vectors(embeddings, key, vector)
    usual = _usual_length(vectors)
    if usual is None:
        return spark.createDataFrame([], schema).withColumnRenamed("key", key)
    d, n = usual
    vectors = vectors.where(F.size("x") == d)
    sums = _column_sums(vectors, d)
    _, squares = _second_moment(vectors, d, d, lambda x: _centred(x, n, sums))
    covariance = squares / n
    covariance = (covariance + covariance.T) / 2
    spectrum = leading_spectrum(covariance, components)
    keep = spectrum.values > RANK * max(spectrum.values.max(), 0)
    values, basis = spectrum.values[keep], spectrum.vectors[:, keep]
    if not len(values):
        return spark.createDataFrame([], schema).withColumnRenamed("key", key)
    explained = values / covariance.trace()
    onto = basis / np.sqrt(values)
    width = len(values)

    def project(x: np.ndarray) -> np.ndarray:
        return _centred(x, n, sums) @ onto

    first, second = _second_moment(vectors, d, width, project)
    mean = first / n
    error = float(np.abs(second / n - np.outer(mean, mean) - np.eye(width)).max())

    def run(batches):
        for ids, x in _matrices(batches, d):
            rows, at = len(x), pa.array(np.repeat(np.arange(len(x)), width))
            exact = [str(v) if v < 10**38 else None for v in _deviations(x, n, sums)]
            deviation = pa.array(exact, pa.string()).cast(pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(at),
                    pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * width, n, np.int64)),
                    deviation.take(at),
                    pa.array(project(x).ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * width, error)),
                ],
                names=[c.split(" ")[0] for c in schema.split(", ")],
            )

    return vectors.mapInArrow(run, schema).withColumnRenamed("key", key)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """The exact sum of ``(n * x - sum)²`` of each row."""
    low, high = int(x.min()), int(x.max())
    far = max(max(abs(n * low - s), abs(n * high - s)) for s in sums)
    if far * far * len(sums) < 1 << 63:
        return ((x * n - np.array(sums, np.int64)) ** 2).sum(1).tolist()
    return [
        sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()
    ]
