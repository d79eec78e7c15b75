"""AGG16-AGG18 against brute force: KS D, rank-sum W, type-7 quantiles, box whiskers.

Small limits force several rounds of bins, and tables of bins that do not pass through the driver.
"""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.operators import stats
from kinfold.operators.stats import box_numbers, compare_groups, quantiles, two_sample


def _brute(xa, xb):
    xa, xb = sorted(xa), sorted(xb)
    na, nb = len(xa), len(xb)
    d = max(abs(sum(x <= v for x in xa) / na - sum(x <= v for x in xb) / nb) for v in set(xa + xb))
    pooled = sorted(xa + xb)
    rank = {}
    for v in set(pooled):
        first = pooled.index(v) + 1
        cnt = pooled.count(v)
        rank[v] = first + (cnt - 1) / 2
    w = sum(rank[x] for x in xa) - na * (na + 1) / 2
    ties = sum(pooled.count(v) ** 3 - pooled.count(v) for v in set(pooled))
    n = na + nb
    sigma = math.sqrt(na * nb / 12 * ((n + 1) - ties / (n * (n - 1))))
    c = w - na * nb / 2
    z = (c - math.copysign(0.5, c) if c != 0 else 0.0) / sigma
    p = math.erfc(abs(z) / math.sqrt(2))
    zk = math.sqrt(na * nb / n) * d
    pk = 1.0 if zk < 0.2 else min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * zk * zk)
                                                        for k in range(1, 101))))
    return d, w, p, pk, float(np.median(xa)), float(np.median(xb))


@pytest.fixture(params=[{}, {"COUNTED_ROWS": 2, "SUB_BINS": 3, "BINS_PER_OCTAVE": 1}, {"COUNTED_ROWS": 4, "LOCAL_ROWS": 0}])
def limits(request, monkeypatch):
    for name, value in request.param.items():
        monkeypatch.setattr(stats, name, value)


def test_two_sample_against_brute_force(spark, limits):
    rnd = random.Random(11)
    rows = []
    for metric, gen in (("ties", lambda: float(rnd.randint(1, 9))), ("cont", lambda: rnd.gauss(0, 1)),
                        ("shift", lambda: rnd.expovariate(1.0))):
        for g in ("a", "b", "z"):
            for _ in range(rnd.randint(30, 60)):
                v = gen() + (0.7 if (metric == "shift" and g == "b") else 0.0)
                rows.append((metric, g, v))
        rows.append((metric, "a", None))  # a NULL value counts as a row, not as a value
    df = spark.createDataFrame(rows, "metric string, grp string, value double")
    got = {r.metric: r for r in two_sample(df, "grp", "a", "b", "value", ["metric"], exact=False).collect()}
    for metric in ("ties", "cont", "shift"):
        xa = [v for m, g, v in rows if m == metric and g == "a" and v is not None]
        xb = [v for m, g, v in rows if m == metric and g == "b" and v is not None]
        d, w, p, pk, ma, mb = _brute(xa, xb)
        r = got[metric]
        assert r.rows_a == len(xa) + 1 and r.n_a == len(xa) and r.n_b == len(xb)
        assert r.ks_statistic == pytest.approx(d, abs=1e-12)
        assert r.wilcox_statistic == pytest.approx(w, abs=1e-9)
        assert r.wilcox_p == pytest.approx(p, rel=1e-9)
        assert r.ks_p == pytest.approx(pk, abs=1e-9)
        assert (r.median_a, r.median_b) == pytest.approx((ma, mb))
        assert r.mean_a == pytest.approx(sum(xa) / len(xa))
        assert 0 <= r.ks_statistic <= 1


def test_box_numbers(spark, limits):
    rnd = random.Random(5)
    vals = {"x": [rnd.gauss(10, 2) for _ in range(101)] + [40.0, -25.0], "y": [1.0, 2.0, 2.0, 3.0], "z": [7.0]}
    df = spark.createDataFrame([(k, v) for k, vs in vals.items() for v in vs] + [("x", None)], "k string, v double")
    got = {r.k: r for r in box_numbers(df, ["k"], "v").collect()}
    for k, vs in vals.items():
        q1, med, q3 = np.percentile(vs, [25, 50, 75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = [v for v in vs if lo <= v <= hi]
        r = got[k]
        assert (r.n, r.q1, r.median, r.q3) == (len(vs), pytest.approx(q1), pytest.approx(med), pytest.approx(q3))
        assert (r.lower_whisker, r.upper_whisker) == (min(inside), max(inside))
        assert r.n_outliers == len(vs) - len(inside)
    assert got["x"].n_outliers >= 2


def test_compare_groups_text(spark):
    rows = [(2021, 60.0, 30.0), (2021, 62.0, 35.0), (2021, 61.0, None), (2025, 58.0, 40.0), (2025, 57.0, 45.0),
            (2025, 59.0, 42.0), (2023, 99.0, 99.0)]
    df = spark.createDataFrame(rows, "year int, resting_hr double, rmssd_detail double")
    from kinfold.operators.stats import METRIC_LABELS
    out = {r.metric: r for r in compare_groups(df, "year", 2021, 2025, ["resting_hr", "rmssd_detail"],
                                               labels=METRIC_LABELS).collect()}
    hr = out["Resting Heart Rate (bpm)"]
    assert (hr.rows_a, hr.rows_b, hr.median_diff, hr.mean_diff) == (3, 3, -3.0, -3.0)
    assert hr.annotation_text.startswith("Diff Median: -3.0 | Diff Mean: -3.0\nKS: p = ")
    assert hr.ks_significance in ("***", "**", "*", "†", "ns")
    rm = out["RMSSD Detail (ms)"]
    assert (rm.rows_a, rm.n_a) == (3, 2) and rm.y_pos == pytest.approx(45.0 * 1.05)


def test_degenerate_samples(spark):
    rows = [("ties", "a", 1.0), ("ties", "a", 1.0), ("ties", "b", 1.0), ("one_side", "a", 2.0), ("one_side", "b", None)]
    df = spark.createDataFrame(rows, "metric string, grp string, value double")
    got = {r.metric: r for r in two_sample(df, "grp", "a", "b", "value", ["metric"]).collect()}
    assert got["ties"].ks_statistic == 0.0 and got["ties"].wilcox_p is None and got["ties"].ks_p == 1.0
    one = got["one_side"]
    assert (one.rows_a, one.rows_b, one.n_a, one.n_b) == (1, 1, 1, 0)
    assert one.mean_b is None and one.median_b is None and one.ks_statistic is None and one.wilcox_p is None


def test_normal_tail(spark):
    from kinfold.functions.statfns import two_sided_normal_p_sql
    zs = [0.0, 0.1, -1.0, 1.96, 2.82, 2.83, -3.5, 5.0, 8.0, 9.0, 20.0, 37.0]
    got = spark.createDataFrame([(z,) for z in zs], "z double").selectExpr("z", f"{two_sided_normal_p_sql('z')} AS p").collect()
    for r in got:
        assert r.p == pytest.approx(math.erfc(abs(r.z) / math.sqrt(2)), rel=1e-11)
    # stored values of the tail
    assert {r.z: r.p for r in got}[8.0] == pytest.approx(1.2441921148543573e-15, rel=1e-11)
    assert {r.z: r.p for r in got}[9.0] == pytest.approx(2.2571768119076845e-19, rel=1e-11)


def _shapes(n=20_000):
    rng = np.random.default_rng(3)
    outliers = rng.random(n)
    outliers[:2] = 1e6, 1e12
    low = rng.random(n)
    low[0] = -1e15
    return {"lognormal": rng.lognormal(0, 5, n), "pareto": 1 / rng.random(n) ** 2, "uniform": rng.random(n), "outliers": outliers,
            "low": low, "shifted": 1.7e9 + rng.random(n) * 1e4, "equal": np.full(n, 3.0), "infinite": np.concatenate([rng.random(n - 2), [np.inf, -np.inf]])}


def _histogram(df):
    return df.groupBy(stats.magnitude_bin(F.col("v")).alias("bin")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))


def test_no_bin_holds_much_of_a_group(spark):
    """The windows of the cumulative counts: the fullest bin, cut again, holds a few per cent of a group's different values."""
    for name, x in _shapes().items():
        df = spark.createDataFrame([(float(v),) for v in set(x.tolist())], "v double")
        cut = df.withColumn("bin", stats.magnitude_bin(F.col("v"))).join(_histogram(df), "bin")
        parts = cut.groupBy("bin", stats.width_bin(F.col("v"), F.col("lo"), F.col("hi")).alias("sub")).count()
        assert parts.agg(F.max("count")).first()[0] <= max(1, 0.03 * df.count()), name


def test_quantiles_of_any_shape(spark, limits):
    shapes = {k: v[:400] if k != "infinite" else v[-400:] for k, v in _shapes().items()}
    df = spark.createDataFrame([(k, float(v)) for k, x in shapes.items() for v in x] + [("uniform", None), ("none", None), ("uniform", float("nan"))], "k string, v double")
    got = {r.k: r for r in quantiles(df, ["k"], "v", [0, 0.25, 0.5, 1], ["lo", "q1", "med", "hi"]).collect()}
    assert "none" not in got
    for k, x in shapes.items():
        r = got[k]
        assert r.n == 400 and (r.lo, r.hi) == (x.min(), x.max())
        assert (r.q1, r.med) == pytest.approx(tuple(np.percentile(x, [25, 50])), rel=1e-12)


def test_cumulative_counts_equal_running_counts(spark, limits):
    vals = [float(i) / 7 for i in range(-100, 300)] + [1e9, -1e9] + [5.0] * 30
    rows = spark.createDataFrame([("g", i % 3 == 0, v) for i, v in enumerate(vals)], "grp string, __a boolean, v double")
    hist = rows.groupBy("grp", stats.magnitude_bin(F.col("v")).alias("bin")).agg(
        F.count_if("__a").alias("n_a"), F.count_if(~F.col("__a")).alias("n_b"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    got = {r.v: (r.c_a, r.c_b, r.cum_a, r.cum_b) for r in stats.cumulative_counts(rows, ["grp"], hist).collect()}
    ab = [[v for i, v in enumerate(vals) if (i % 3 == 0) == side] for side in (True, False)]
    assert got == {v: (*(x.count(v) for x in ab), *(sum(y <= v for y in x) for x in ab)) for v in set(vals)}


def _permuted(xa, xb):
    """Exact two-sided p of the rank sum and of KS: over all ways to deal the pooled values to the samples."""
    pooled, na = sorted(xa + xb), len(xa)
    low = {}
    for i, v in enumerate(pooled):
        low.setdefault(v, []).append(i + 1)
    mean_rank = [sum(low[v]) / len(low[v]) for v in pooled]

    def figures(chosen):
        w = sum(mean_rank[i] for i in chosen) - na * (na + 1) / 2
        a, b = [pooled[i] for i in chosen], [pooled[i] for i in range(len(pooled)) if i not in chosen]
        return w, max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in low)
    first, used = [], set()
    for v in xa:  # one way to see the given samples
        i = next(i for i, x in enumerate(pooled) if x == v and i not in used)
        used.add(i)
        first.append(i)
    w, d = figures(set(first))
    draws = [figures(set(c)) for c in itertools.combinations(range(len(pooled)), na)]
    tail = min(sum(x <= w for x, _ in draws), sum(x >= w for x, _ in draws)) / len(draws)
    return min(1.0, 2 * tail), sum(x >= d - 1e-9 for _, x in draws) / len(draws)


def test_exact_p_against_all_permutations(spark):
    rnd, rows, want = random.Random(2), [], {}
    for k, (na, nb) in enumerate(((1, 1), (1, 5), (4, 4), (3, 7), (6, 5), (7, 2), (6, 6), (5, 6))):
        for ties in (False, True):
            draw = (lambda: float(rnd.randint(1, 5))) if ties else (lambda: rnd.random())
            xa, xb = [draw() for _ in range(na)], [draw() + 0.2 * (k % 2) * (not ties) for _ in range(nb)]
            name = f"{na} {nb} {ties} {k}"
            want[name] = (*_permuted(xa, xb), len(set(xa + xb)) == na + nb)
            rows += [(name, "a", v) for v in xa] + [(name, "b", v) for v in xb]
    df = spark.createDataFrame(rows, "metric string, grp string, value double")
    for r in two_sample(df, "grp", "a", "b").collect():
        w, ks, distinct = want[r.metric]
        assert r.ks_p == pytest.approx(ks, abs=1e-12), r.metric
        assert not distinct or r.wilcox_p == pytest.approx(w, abs=1e-12), r.metric


def test_exact_p_of_stored_examples(spark):
    """Values printed in R's help pages and tables of the two tests."""
    x = [0.80, 0.83, 1.89, 1.04, 1.45, 1.38, 1.91, 1.64, 0.73, 1.46]
    y = [1.15, 0.88, 0.90, 0.74, 1.21]
    df = spark.createDataFrame([("m", "x", v) for v in x] + [("m", "y", v) for v in y], "metric string, grp string, value double")
    r = two_sample(df, "grp", "x", "y").first()
    assert (r.wilcox_statistic, round(r.wilcox_p, 4)) == (35.0, 0.2544)  # help page of the rank-sum test: one-sided 0.1272
    apart = [("z", "x", float(i)) for i in range(20)] + [("z", "y", 100.0 + i) for i in range(20)]
    r = two_sample(spark.createDataFrame(apart, "metric string, grp string, value double"), "grp", "x", "y").first()
    assert r.wilcox_p == pytest.approx(2 / math.comb(40, 20), rel=1e-12) and r.ks_p == pytest.approx(2 / math.comb(40, 20), rel=1e-9)


def test_exact_rule(spark):
    """R's rule: rank sum below 50 values a side without ties, KS below 10000 pairs; ``exact`` overrides it."""
    rnd = random.Random(8)
    sizes = {"small": (49, 49), "long side": (49, 50), "pairs": (100, 99), "large": (100, 100)}
    rows = [(k, s, rnd.random() + (s == "b") * 0.1) for k, (a, b) in sizes.items() for s, n in (("a", a), ("b", b)) for _ in range(n)]
    df = spark.createDataFrame(rows, "metric string, grp string, value double")
    default, never = ({r.metric: r for r in two_sample(df, "grp", "a", "b", exact=e).collect()} for e in (None, False))
    assert {k for k in sizes if default[k].wilcox_p != never[k].wilcox_p} == {"small"}
    assert {k for k in sizes if default[k].ks_p != never[k].ks_p} == {"small", "long side", "pairs"}
    always = two_sample(df.where("metric = 'long side'"), "grp", "a", "b", exact=True).first()
    assert always.wilcox_p != never["long side"].wilcox_p and always.wilcox_p == pytest.approx(never["long side"].wilcox_p, abs=0.01)
    for k in ("small", "pairs"):
        assert default[k].ks_p == pytest.approx(never[k].ks_p, abs=0.08)


def _outline(x, points=512):
    """A Gaussian kernel density without a grid, at the outline's points."""
    x = np.array(x)
    sd, iqr = x.std(ddof=1), np.subtract(*np.percentile(x, [75, 25]))
    bw = 0.9 * next(s for s in (min(sd, iqr / 1.34), sd, abs(x[0]), 1.0) if s) * len(x) ** -0.2
    at = np.linspace(x.min() - 3 * bw, x.max() + 3 * bw, points)
    return bw, at, np.exp(-0.5 * ((at[:, None] - x) / bw) ** 2).mean(axis=1) / (bw * math.sqrt(2 * math.pi))


def test_violin_density(spark):
    rnd = random.Random(6)
    groups = {"a": [rnd.gauss(60, 5) for _ in range(300)], "b": [rnd.expovariate(0.1) for _ in range(80)], "two": [1.0, 4.0],
              "equal": [3.0] * 7, "zero": [0.0] * 4, "mostly": [2.0] * 9 + [5.0]}
    rows = [(k, v) for k, x in groups.items() for v in x] + [("one", 1.0), ("a", None), ("a", float("nan")), ("b", float("inf")), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").withColumn("point", F.lit(1))
    out = stats.violin_density(df, ["k"], "v").orderBy("k", "point").collect()
    assert {r.k for r in out} == set(groups)
    peak = 0
    for k, x in groups.items():
        bw, at, density = _outline(x)
        got = [r for r in out if r.k == k]
        peak = max(peak, max(r.density for r in got))
        assert len(got) == 512 and {r.n for r in got} == {len(x)} and got[0].bw == pytest.approx(bw)
        assert [r.y for r in got] == pytest.approx(at.tolist())
        assert np.abs(np.array([r.density for r in got]) - density).max() < 0.01 * density.max()  # the grid's own error
        assert sum(r.density for r in got) * (at[1] - at[0]) == pytest.approx(1, abs=0.01)
    assert all(r.width == pytest.approx(r.density / peak) for r in out)
    assert stats.violin_density(df.where("k = 'one'"), ["k"], "v").count() == 0
