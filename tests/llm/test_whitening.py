import random

import numpy as np
import pytest

from kinfold.llm import whitening
from kinfold.llm.queries import op11_embedding_whitening
from kinfold.llm.whitening import covariance_parts, principal, products, scatter, whiten

SCHEMA = "vec_id long, embedding array<double>"


def expected(vectors, k=8):
    """(n, deviations, coordinates, shares) of equally long vectors, with Python integers and numpy."""
    x = [[int(np.floor(1024.0 * c)) + 100000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    u = [[n * r[j] - sums[j] for j in range(d)] for r in x]
    centred = np.array(u, dtype=np.float64) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(k, int((values > values.sum() * 1e-12).sum()))
    return n, [sum(c * c for c in r) for r in u], centred @ axes[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def check(rows, ids, vectors):
    n, deviation, coordinates, shares = expected(vectors)
    by = {(r.vec_id, r.component): r for r in rows}
    assert len(by) == len(rows) == len(ids) * coordinates.shape[1]
    got = np.array([[by[i, c + 1].whitened for c in range(coordinates.shape[1])] for i in ids])
    assert np.allclose(got, coordinates * np.sign((got * coordinates).sum(axis=0)), atol=1e-8)
    assert [by[i, 1].deviation for i in ids] == deviation and {r.n for r in rows} == {n}
    assert np.allclose([by[ids[0], c + 1].explained for c in range(len(shares))], shares, rtol=1e-9)
    cov = got.T @ got / n - np.eye(got.shape[1])
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and abs(rows[0].identity_error - np.abs(cov).max()) < 1e-9 and rows[0].identity_error < 1e-4


def test_query_against_numpy(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    check(op11_embedding_whitening(spark, sf).collect(), [r.vec_id for r in rows], [r.embedding for r in rows])


@pytest.mark.parametrize("scale", [1, 1 << 20, 1 << 35])
def test_scatter_is_exact(scale):
    rng = np.random.default_rng(scale)
    y = rng.integers(0, scale * 50, size=(200, 5)) // np.array([1, 7, 1, 1000, 1])
    y[:, 2] = 0
    widths = [int(v).bit_length() for v in y.max(axis=0)]
    got = scatter(y, widths)
    want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) if j >= i else 0 for j in range(5)] for i in range(5)]
    assert got.tolist() == want


def test_products_over_blocks_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(500, 6)) * np.array([1, 1, 10, 0, 0.001, 5])
    rows = whitening.integer_rows(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], SCHEMA).repartition(3), "vec_id", "embedding")
    known = whitening.bounds(rows)
    n, sums, lo, hi = known[6]
    x = np.floor(1024 * vectors).astype(np.int64) + 100000
    assert (n, sums, lo, hi) == (500, x.sum(axis=0).tolist(), x.min(axis=0).tolist(), x.max(axis=0).tolist())
    y = (x - x.min(axis=0)).astype(object)
    assert (products(rows, known)[6] == np.triu((y.T @ y).astype(object))).all()


def test_eigenvectors_with_a_wide_spread():
    """Eigenvalues over 12 orders of magnitude: the small ones keep their digits."""
    rng = random.Random(1)
    x = [[rng.randint(-10 ** 9, 10 ** 9), rng.randint(-1000, 1000), rng.randint(-3, 3)] for _ in range(400)]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    product = np.array([[sum(r[i] * r[j] for r in x) for j in range(3)] for i in range(3)], dtype=object)
    values, axes = principal(covariance_parts(n, sums, [0, 0, 0], product))
    u = np.array([[n * c - s for c, s in zip(r, sums)] for r in x], dtype=np.longdouble)
    w = u @ (axes / np.sqrt(values))
    assert np.abs(w.T @ w / n - np.eye(3)).max() < 1e-9


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [rng.normal(size=4).tolist() for _ in range(30)]
    rows = list(enumerate(good)) + [(50, None), (51, [1.0, None, 2.0, 3.0]), (52, [float("nan")] * 4), (53, [float("inf"), 0.0, 0.0, 0.0]), (54, [])]
    pair = [[1.0, 2.0], [3.0, 1.0], [1.0, 2.0]]
    df = spark.createDataFrame(rows + list(zip((60, 61, 62), pair)) + [(70, [1.0, 2.0, 3.0])], SCHEMA).selectExpr("*", "vec_id as id", "vec_id as n", "vec_id as component", "vec_id as d")
    got = whiten(df).collect()
    check([r for r in got if r.vec_id < 50], list(range(30)), good)
    check([r for r in got if r.vec_id >= 50], [60, 61, 62], pair)  # another length: a fit list of its own, of rank 1
    assert whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whiten(spark.createDataFrame([(1, [2.0, 2.0]), (None, [2.0, 2.0])], SCHEMA)).count() == 0  # no variance
    twice = whiten(spark.createDataFrame([(None, [1.0, 0.0]), (None, [0.0, 0.0]), (7, [0.0, 3.0])], SCHEMA)).collect()
    assert len(twice) == 6 and {r.n for r in twice} == {3}
    with pytest.raises(Exception, match="beyond 2"):
        whiten(spark.createDataFrame([(1, [1e300])], SCHEMA)).count()


def test_deviation_that_is_no_long(spark):
    got = whiten(spark.createDataFrame([(i, [c, 1.0]) for i, c in enumerate((1e12, -1e12, 3.0))], SCHEMA)).collect()
    u = [[3 * x - s for x, s in zip(r, (100000 * 3 + 3072, 303072))] for r in ((1024 * 10 ** 12 + 100000, 101024), (-1024 * 10 ** 12 + 100000, 101024), (103072, 101024))]
    want = {i: sum(c * c for c in r) for i, r in enumerate(u)}
    assert {r.vec_id: r.deviation for r in got} == {i: v if v < 1 << 63 else None for i, v in want.items()}
    assert {r.identity_error < 1e-4 for r in got} == {True}
