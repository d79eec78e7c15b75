"""Properties of SURVEY section 5 checked on generated inputs (hypothesis, few examples: each is a Spark job)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinfold.operators.joins import join_by
from kinfold.operators.people import process_compensation
from kinfold.operators.scoring import first_per_group
from kinfold.operators.stats import two_sample

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-500, 5000)), min_size=1, max_size=30),
       st.sampled_from([50, 100, 150]))
def test_total_equals_points_when_no_tickets(spark, points, rate):
    df = spark.createDataFrame([(None if p is None else str(p), t) for p, t in zip(points, ["0", None] * 30)],
                               "compensation_points string, compensation_tickets string")
    for r, p in zip(process_compensation(df, pts_to_tix=rate).collect(), points):
        assert r.total_points == p
        assert r.compensation_tickets >= 0


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["p", "q", None]), st.integers(0, 3),
                          st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 10_000)), min_size=1, max_size=25,
                unique_by=lambda r: r[3]))
def test_first_per_group_idempotent(spark, rows):
    df = spark.createDataFrame([(p, k, None if t is None else dt.datetime(2025, 1, 1, t), f"r{i:05d}")
                                for p, k, t, i in rows], "p string, k int, t timestamp_ntz, id string")
    order = [F.col("t").isNull(), F.col("t"), F.col("id")]
    once = first_per_group(df, ["p", "k"], order)
    twice = first_per_group(once, ["p", "k"], order)
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(map(tuple, twice.collect()), key=repr)
    assert once.count() == df.select("p", "k").distinct().count()


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=20),
       st.lists(st.one_of(st.none(), st.integers(2, 6)), max_size=20))
def test_full_join_covers_both_sides(spark, lk, rk):
    left = spark.createDataFrame([(k, i) for i, k in enumerate(lk)], "k int, a int")
    right = spark.createDataFrame([(k, i) for i, k in enumerate(rk)], "k int, b int")
    out = join_by(left, right, ["k"], how="full")
    n = out.count()
    assert n >= len(lk) and n >= len(rk)
    assert out.where(F.col("a").isNotNull()).select("a").distinct().count() == len(lk)
    assert out.where(F.col("b").isNotNull()).select("b").distinct().count() == len(rk)


@SETTINGS
@given(st.lists(st.integers(0, 6), min_size=3, max_size=30), st.lists(st.integers(0, 6), min_size=3, max_size=30))
def test_rank_sums_add_up(spark, xa, xb):
    rows = [("m", "a", float(v)) for v in xa] + [("m", "b", float(v)) for v in xb]
    df = spark.createDataFrame(rows, "metric string, g string, value double")
    ab = two_sample(df, "g", "a", "b", "value").first()
    ba = two_sample(df, "g", "b", "a", "value").first()
    assert ab.wilcox_statistic + ba.wilcox_statistic == len(xa) * len(xb)
    assert 0.0 <= ab.ks_statistic <= 1.0 and ab.ks_statistic == ba.ks_statistic
    assert ab.wilcox_p is None or abs(ab.wilcox_p - ba.wilcox_p) < 1e-12
