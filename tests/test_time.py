"""DAT1-DAT12 (FIXTURES 2.4), and independence from the session time zone."""

import datetime as dt

from pyspark.sql import functions as F

from kinfold.functions import (floor_time, format_refresh, last_refresh, local_date, months_since, phase_label,
                               text_to_instant)


def _ts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "t timestamp_ntz")


def test_local_date(spark):
    r = _ts(spark, [dt.datetime(2025, 7, 29, 3, 30)]).select(local_date("t").alias("d")).first()
    assert r.d == dt.date(2025, 7, 28)


def test_phase(spark):
    df = spark.createDataFrame([(0,), (88,), (89,), (None,)], "days int")
    d0 = F.lit("2025-01-01").cast("date")
    got = df.select(phase_label(months_since(F.date_add(d0, F.col("days")), d0)).alias("p")).collect()
    assert [r.p for r in got] == ["BL", "BL", "QT", None]


def test_refresh(spark):
    cases = [(dt.datetime(2025, 7, 29, 9, 0, 0), dt.datetime(2025, 7, 28, 9, 0)),
             (dt.datetime(2025, 7, 29, 9, 0, 1), dt.datetime(2025, 7, 29, 9, 0)),
             (dt.datetime(2025, 3, 9, 9, 30), dt.datetime(2025, 3, 9, 9, 0)),
             (dt.datetime(2025, 1, 10, 3, 0), dt.datetime(2025, 1, 9, 10, 0))]
    got = _ts(spark, [c[0] for c in cases]).select(last_refresh("t").alias("r")).collect()
    assert [g.r for g in got] == [c[1] for c in cases]
    text = _ts(spark, [cases[1][0]]).select(format_refresh(last_refresh("t")).alias("x")).first().x
    assert text == "Last updated: 2025-07-29 05:00:00 America/New_York"


def test_text_instants(spark):
    df = spark.createDataFrame([("2024-01-01T03:30:07.5Z",), ("2024-07-29T03:30:00+02:00",), ("2024-07-29 03:30:00",),
                                ("",), ("n/a",), (None,)], "s string")
    got = [r.t for r in df.select(text_to_instant("s").alias("t")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 3, 30, 7, 500000), dt.datetime(2024, 7, 29, 1, 30),
                   dt.datetime(2024, 7, 29, 3, 30), None, None, None]


def test_session_zone_does_not_matter(spark):
    df = spark.createDataFrame([("2024-03-10T06:59:59Z", dt.datetime(2024, 3, 10, 6, 59, 59)),
                                ("2023-11-05T05:30:00+00:00", dt.datetime(2023, 11, 5, 5, 30))],
                               "s string, t timestamp_ntz")
    q = df.select(text_to_instant("s").alias("i"), local_date("t").alias("d"), last_refresh("t").alias("r"),
                  floor_time(F.col("t"), "hour").alias("h"), format_refresh(last_refresh("t")).alias("x"))
    before = q.collect()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("Asia/Kolkata", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert q.collect() == before, zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
