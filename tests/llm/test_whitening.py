"""Whitening against a full eigendecomposition."""

import numpy as np
import pytest

from fieldmill.llm import whitening as W
from fieldmill.llm.queries import op13_whitening
from fieldmill.llm.tables import table

SCHEMA = "vec_id long, embedding array<float>"


def matrices():
    rng = np.random.default_rng(0)
    a = rng.standard_normal((40, 40))
    q, _ = np.linalg.qr(a)
    near = q @ np.diag([7, 7, 7, 7 + 1e-9, *[3] * 20, *rng.random(16)]) @ q.T
    return {
        "random": a @ a.T,
        "indefinite": (a + a.T) / 2,
        "clusters": (near + near.T) / 2,
        "repeated": np.diag([5.0] * 10 + [1.0] * 30),
        "rank": a[:, :5] @ a[:, :5].T,
        "zero": np.zeros((40, 40)),
        "zero diagonal": np.kron(np.eye(20), [[0, 1], [1, 0]]),
        "one": np.array([[3.0]]),
    }


@pytest.mark.parametrize("name", matrices())
def test_spectrum_equals_a_full_decomposition(name):
    v = matrices()[name]
    found = W.leading_spectrum(v, 32)
    want = np.sort(np.linalg.eigvalsh(v))[::-1][:32]
    size = max(1.0, np.abs(want).max())
    assert np.abs(found.values - want).max() < 1e-11 * size
    k = len(want)
    assert np.abs(found.vectors.T @ found.vectors - np.eye(k)).max() < 1e-10
    assert np.abs(v @ found.vectors - found.vectors * found.values).max() < 1e-10 * size


def test_inertia_counts_eigenvalues_above_a_shift():
    for v in matrices().values():
        values = np.linalg.eigvalsh(v)
        for shift in (-1.3, -0.4, 0.123, 0.77, 2.5, 6.9, 40.0):
            if np.abs(values - shift).min() > 1e-6:
                assert W.inertia(v, shift) == (values > shift).sum()


def expected(rows):
    x = np.array([np.floor(np.array(v, np.float64) * 64) for _, v in rows]) + 1_000_000
    z = x - x.mean(0)
    values, vectors = np.linalg.eigh(z.T @ z / len(x))
    whole = x.astype(np.int64)
    deviation = ((len(x) * whole - whole.sum(0)) ** 2).sum(1)
    return z @ vectors[:, ::-1][:, :32], values[::-1], deviation


def check(found, rows, n_components):
    projected, values, deviation = expected(rows)
    assert len(found) == len(rows) * n_components
    got = np.zeros((len(rows), n_components))
    place = {vec_id: i for i, (vec_id, _) in enumerate(rows)}
    for r in found:
        i = place[r.vec_id]
        got[i, r.component - 1] = r.whitened
        assert r.n == len(rows) and int(r.deviation) == deviation[i] and r.identity_error < 1e-8
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-9
    want = projected[:, :n_components] / np.sqrt(values[:n_components])
    sign = np.sign((got * want).sum(0))
    assert np.abs(got * sign - want).max() < 1e-6


def test_query_equals_numpy(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf_dir, "embeddings").orderBy("vec_id").collect()]
    found = op13_whitening(spark, sf_dir)
    assert dict(found.dtypes)["deviation"] == "bigint"
    check(found.collect(), rows, 32)


def test_odd_vectors(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.standard_normal(5).astype(np.float32).tolist()) for i in range(60)]
    bad = [(100, None), (101, []), (102, [1.0, None, 0.0, 0.0, 0.0]), (103, [float("nan")] * 5)]
    bad += [(104, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (105, [1.0, 2.0]), (106, [1.0] * 6)]
    frame = spark.createDataFrame(good + bad, SCHEMA).repartition(4)
    for name in ("x", "component", "key", "n", "whitened"):
        frame = frame.selectExpr("*", f"'x' AS {name}")
    check(W.whiten(frame).collect(), good, 5)
    # repeated rows and rows without an id fit the covariance each time
    twice = spark.createDataFrame([*good, *good, (None, good[0][1])], SCHEMA)
    found = W.whiten(twice).collect()
    assert len(found) == 121 * 5 and {r.n for r in found} == {121}
    assert sum(r.vec_id is None for r in found) == 5


def test_tables_without_variance(spark):
    def rows(vectors):
        return W.whiten(spark.createDataFrame(list(enumerate(vectors)), SCHEMA)).collect()

    assert W.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert rows([None, []]) == [] == rows([[1.0, 2.0]] * 7)
    flat = rows([[float(i), float(2 * i), 1.0] for i in range(9)])
    assert {r.component for r in flat} == {1} and abs(flat[0].explained - 1) < 1e-9
    huge = rows([[3e38, 0.0], [-3e38, 1.0], [0.0, 5.0]])
    assert len(huge) >= 3 and np.isfinite([r.whitened for r in huge]).all()
