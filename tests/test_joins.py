"""JN1-JN5: NULL-matching keys, suffixes, and the split full join against a native one."""

import random

from pyspark.sql import functions as F

from kinfold.operators.joins import checked_broadcast, fold_join, join_by


def test_null_safe_full_join(spark):
    # FIXTURES 2.7
    left = spark.createDataFrame([(1, 10), (None, 11)], "k int, a int")
    right = spark.createDataFrame([(1, 20), (2, 21), (None, 22)], "k int, b int")
    got = sorted(join_by(left, right, ["k"], how="full").collect(), key=lambda r: (r.k is None, r.k or 0))
    assert [tuple(r) for r in got] == [(1, 10, 20), (2, None, 21), (None, 11, 22)]


def test_suffixes_and_renamed_key(spark):
    left = spark.createDataFrame([("m1", 1.0, "x")], "pid string, v double, w string")
    right = spark.createDataFrame([("m1", 2.0, "p1")], "mid string, v double, patient string")
    out = join_by(left, right, {"pid": "mid"}, how="left", suffix=("", "_pt"))
    assert out.columns == ["pid", "v", "w", "v_pt", "patient"]
    assert tuple(out.first()) == ("m1", 1.0, "x", 2.0, "p1")


def test_split_full_join_matches_native(spark):
    rnd = random.Random(3)
    lrows = [(rnd.choice([None, 1, 2, 3, 4]), i) for i in range(60)]
    rrows = [(rnd.choice([None, 2, 3, 5, 6]), 100 + i) for i in range(40)]
    left = spark.createDataFrame(lrows, "k int, a int")
    right = spark.createDataFrame(rrows, "k int, b int")
    ours = sorted(tuple(r) for r in join_by(left, right, ["k"], how="full").fillna(-1).collect())
    native = (left.alias("l").join(right.alias("r"), F.col("l.k").eqNullSafe(F.col("r.k")), "full")
              .select(F.coalesce("l.k", "r.k").alias("k"), "a", "b").fillna(-1).collect())
    assert ours == sorted(tuple(r) for r in native)


def test_fold_join_three_way(spark):
    a = spark.createDataFrame([(1, 1.0)], "d int, x double")
    b = spark.createDataFrame([(1, 2.0), (2, 3.0)], "d int, x double")
    c = spark.createDataFrame([(3, 4.0)], "d int, x double")
    out = fold_join([a, b, c], ["d"], how="full")
    assert out.columns == ["d", "x.x", "x.y", "x"]
    assert out.count() == 3
    assert fold_join([a, b, c], ["d"], how="inner").count() == 0
    assert fold_join([b, a], ["d"], how="left").count() == 2


def test_checked_broadcast(spark):
    small = spark.range(5)
    assert "ResolvedHint" in small.join(checked_broadcast(small, 10), "id")._jdf.queryExecution().analyzed().toString()
    assert checked_broadcast(small, 3) is small


def test_reshape_helpers(spark):
    from kinfold.operators.reshape import distinct_in_order, drop_range, numeric_columns, relocate
    df = spark.createDataFrame([(1, "a", 2.0, "x", 5)], "a int, b string, c double, d string, e int")
    assert drop_range(df, "b", "d").columns == ["a", "e"]
    assert drop_range(df, "d", "b").columns == ["a", "e"]
    assert relocate(df, ["d", "a"]).columns == ["d", "a", "b", "c", "e"]
    assert numeric_columns(df) == ["a", "c", "e"]
    seq = spark.createDataFrame([(3, "y"), (1, "x"), (2, "y"), (4, "z")], "pos int, v string")
    assert [r.v for r in distinct_in_order(seq, "v", "pos").collect()] == ["x", "y", "z"]


def test_local_copy_is_bounded_by_rows_and_bytes(spark):
    from kinfold.operators.joins import local_copy

    def is_local(df):
        return "Range (" not in df._jdf.queryExecution().optimizedPlan().toString()
    df = spark.range(1000).selectExpr("id", "array(id, NULL) AS a", "named_struct('x', id, 'y', 'é') AS s", "cast(NULL AS string) AS n")
    for rows, size, want in ((1000, 1 << 20, True), (999, 1 << 20, False), (1000, 1000, False)):
        out = local_copy(df, rows, size)
        assert is_local(out) == want and out.schema == df.schema
        assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    assert local_copy(df.limit(0), 10).count() == 0 and is_local(local_copy(df.limit(0), 10))
