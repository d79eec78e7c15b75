import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.llm.ann import centres, nearest, nearest_centres, rotation, scan_list, unit

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=50, k=5):
    """query id -> [(vec_id, score)] over all pairs, in double precision."""
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in good:
        if q % every == 0:
            s = [(-float(np.dot(x, y) / math.sqrt(np.dot(x, x)) / math.sqrt(np.dot(y, y))), i) for i, y in good if i != q]
            out[q] = [(i, -d) for d, i in sorted(s)[:k]]
    return out


def answers(df, **options):
    out = {}
    for r in nearest(df, **options).collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: [x[1:] for x in sorted(v)] for q, v in out.items()}


def test_recall_against_all_pairs(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want, got = brute(rows), answers(df)
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    x = {i: np.array(v, dtype=np.float64) for i, v in rows}
    for q, found in got.items():
        for i, s in found:
            assert abs(s - np.dot(x[q], x[i]) / np.linalg.norm(x[q]) / np.linalg.norm(x[i])) < 1e-12
        assert found == sorted(found, key=lambda p: (-p[1], p[0]))


def test_odd_rows_and_ties(spark):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (7, [2.0, 0.0]), (3, [1.0, 0.0]), (9, None), (11, [0.0, 0.0]), (12, [None, 1.0]), (13, [float("nan"), 1.0]),
            (14, [float("inf"), 1.0]), (100, [0.0, -3.0]), (15, [1.0, 1.0]), (16, []), (-50, [0.5, 0.1]), (150, None), (17, [1e-30, 1e-30]), (18, [3e30, 0.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).withColumn("qid", F.lit(1)).withColumn("v", F.lit(2))
    got, want = answers(df), brute(rows)
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-12)


def test_few_vectors_copies_and_empty(spark):
    assert answers(spark.createDataFrame([], SCHEMA)) == {}
    assert answers(spark.createDataFrame([(0, [1.0], 0)], SCHEMA)) == {}
    assert answers(spark.createDataFrame([(0, [1.0], 0), (0, [1.0], 0), (4, [2.0], 0)], SCHEMA)) == {0: [(4, 1.0)]}
    copies = [(i, [1.0, 2.0], 0) for i in range(400)] + [(400, [2.0, 1.0], 0)]
    got = answers(spark.createDataFrame(copies, SCHEMA))
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[350]] == [0, 1, 2, 3, 4] and [i for i, _ in got[400]] == [0, 1, 2, 3, 4]


def test_each_length_is_searched_by_itself(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=4 if i % 3 else 7).tolist()) for i in range(200)] + [(1000, [1.0]), (1050, [-2.0, 1.0])]
    got = answers(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA))
    want = {}
    for d in (1, 2, 4, 7):
        want |= brute([(i, v) for i, v in rows if len(v) == d])
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items() if v}


@pytest.mark.parametrize("n", [3000, 15_000])
def test_recall_on_clusters_at_two_sizes(spark, n):
    rng = np.random.default_rng(n)
    centre = rng.normal(size=(40, 24))
    x = (centre[rng.integers(0, 40, n)] + 0.4 * rng.normal(size=(n, 24))).astype(np.float32)
    got = answers(spark.createDataFrame([(i, v, 0) for i, v in enumerate(x.tolist())], SCHEMA))
    unit_x = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, n, 50):
        s = unit_x @ unit_x[q]
        s[q] = -2
        hits += len({i for i, _ in got[q]} & set(np.argsort(-s)[:5].tolist()))
    assert hits >= 0.9 * 5 * len(range(0, n, 50))


@pytest.mark.parametrize("width", [2.1, 50.0])
def test_scan_gives_up_few_neighbours(width):
    rng = np.random.default_rng(1)
    x = unit(rng.standard_normal((3000, 32))) @ rotation(32)
    blocks = [np.ascontiguousarray(x[:, a:a + 8]) for a in range(0, 32, 8)]
    hits = 0
    for q in unit(rng.standard_normal((50, 32))):
        true = np.argsort(((x - q) ** 2).sum(axis=1))[:6]
        hits += len(set(scan_list(q, blocks, 6, width).tolist()) & set(true.tolist()))
    assert hits >= 0.97 * 300 if width < 10 else hits == 300


def test_centres_of_few_vectors():
    x = unit(np.array([[1.0, 0.0], [1.0, 0.0], [0.0, 1.0]]))
    c = centres(x, 3)
    assert np.isfinite(c).all() and nearest_centres(c, x, len(c)).shape == (3, 3)
