"""Incremental ingestion: each run picks up only new files; output matches the batch reader."""

import datetime as dt
import os
import tempfile

import pytest

from kinfold.sources import load_resting_hr
from kinfold.streaming import align_stream, hrv_stream, ingest_available, read_daily, refresh_daily
from kinfold.streaming import wearables
from test_sources import _detail, _summary, _write


def test_incremental_runs(spark):
    root = tempfile.mkdtemp(prefix="kinfold-stream-src-")
    out = tempfile.mkdtemp(prefix="kinfold-stream-out-")
    ck = tempfile.mkdtemp(prefix="kinfold-stream-ck-")
    d = dt.date(2025, 7, 1)
    _detail(root, d, 3)
    _summary(root, d)
    ingest_available(hrv_stream(spark, root, "detail"), os.path.join(out, "detail"), "detail_t",
                     os.path.join(ck, "detail"))
    assert spark.read.parquet(os.path.join(out, "detail")).count() == 3
    _detail(root, d + dt.timedelta(days=1), 2)  # the next day's export arrives
    ingest_available(hrv_stream(spark, root, "detail"), os.path.join(out, "detail"), "detail_t",
                     os.path.join(ck, "detail"))
    rows = spark.read.parquet(os.path.join(out, "detail")).collect()
    assert len(rows) == 5  # nothing read twice
    assert sorted({r.file_date for r in rows}) == [d, d + dt.timedelta(days=1)]
    assert {r.timestamp.date() for r in rows} == {d, d + dt.timedelta(days=1)}
    ingest_available(hrv_stream(spark, root, "summary"), os.path.join(out, "summary"), "summary_t",
                     os.path.join(ck, "summary"))
    s = spark.read.parquet(os.path.join(out, "summary")).first()
    assert s.file_date == d + dt.timedelta(days=1) and s.rmssd == 30.5


def test_stray_names_and_impossible_dates_are_passed_over(spark):
    root, out, ck = (tempfile.mkdtemp(prefix=f"kinfold-stray-{x}-") for x in ("src", "out", "ck"))
    folder = os.path.join(root, "Heart Rate Variability")
    d = dt.date(2025, 7, 1)
    _detail(root, d, 2)
    for name in (f"Heart Rate Variability Details - {d} - copy.csv", "Heart Rate Variability Details - 2025-02-30.csv"):
        with open(os.path.join(folder, name), "w") as fh:
            fh.write("timestamp,rmssd,coverage,low_frequency,high_frequency\n2025-07-01T00:00:00,1,1,1,1\n")
    for _ in range(2):
        ingest_available(hrv_stream(spark, root, "detail"), out, "stray_t", ck)
        assert spark.read.parquet(out).count() == 2


def test_a_late_summary_still_meets_its_day(spark):
    root, out, ck = (tempfile.mkdtemp(prefix=f"kinfold-align-{x}-") for x in ("src", "out", "ck"))
    d = [dt.date(2025, 7, 1) + dt.timedelta(days=i) for i in range(12)]

    def run():
        stream = align_stream(hrv_stream(spark, root, "detail"), hrv_stream(spark, root, "summary"), delay="3 days")
        ingest_available(stream, out, "align_t", ck)
        rows = spark.read.parquet(out).collect() if any(f.endswith(".parquet") for _, _, fs in os.walk(out) for f in fs) else []
        return sorted((r.file_date, r.rmssd_detail, r.rmssd_summary) for r in rows)
    _detail(root, d[1], 2)
    _summary(root, d[0])
    _detail(root, d[2], 1)
    assert run() == [(d[1], 40.0, 30.5), (d[1], 41.0, 30.5)]  # the second day waits for its summary
    _summary(root, d[1])
    _summary(root, d[1], name=f"Copy of Daily Heart Rate Variability Summary - 2025-07-({d[1].day:02d}).csv")
    _detail(root, d[3], 1)
    first = [(d[1], 40.0, 30.5), (d[1], 41.0, 30.5), (d[2], 40.0, 30.5)]
    assert run() == first  # it came in the next run, and its copy does not count
    assert run() == first  # nothing twice
    _detail(root, d[11], 1)
    _summary(root, d[10])
    run()
    _summary(root, d[9])  # newer days move the watermark on: the day without a summary comes out
    done = run()
    assert [r for r in done if r[0] != d[3]] == [*first, (d[11], 40.0, 30.5)]
    assert [r[1:] for r in done if r[0] == d[3]] == [(40.0, None)]


def test_refresh_of_files_that_are_rewritten(spark, monkeypatch):
    root, target = (tempfile.mkdtemp(prefix=f"kinfold-daily-{x}-") for x in ("src", "out"))

    def export(*lines):
        _write(root, "Physical Activity_GoogleData/daily_resting_heart_rate.csv", "timestamp,beats per minute\n" + "".join(f"2025-07-{d:02d}T00:00:00Z,{v}\n" for d, v in lines))

    def refresh():
        return refresh_daily(load_resting_hr(spark, "2025-07-01", "2025-07-31", root), target)

    def held():
        return sorted((r.file_date.day, r.resting_hr) for r in read_daily(spark, target).collect())
    assert read_daily(spark, target) is None
    export((1, 55), (2, 56))
    assert refresh() == 1 and held() == [(1, 55.0), (2, 56.0)]
    assert refresh() == 1  # nothing new
    export((2, 57), (3, 58), (3, 59))  # one day corrected, one new (twice), one no longer exported
    real = spark.createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")) if "version int" in a else real(*a[1:], **k))
    with pytest.raises(RuntimeError):
        refresh()
    monkeypatch.undo()
    assert held() == [(1, 55.0), (2, 56.0)] and wearables.daily_versions(spark, target) == 1  # the failed run changed nothing
    assert refresh() == 2 and held() == [(1, 55.0), (2, 57.0), (3, 59.0)]
    assert sorted((r.file_date.day, r.resting_hr) for r in read_daily(spark, target, 1).collect()) == [(1, 55.0), (2, 56.0)]


def test_refresh_by_owner(spark):
    target = tempfile.mkdtemp(prefix="kinfold-owners-")
    schema = "owner string, file_date date, v double"
    d = dt.date(2025, 7, 1)
    assert refresh_daily(spark.createDataFrame([("a", d, 1.0), ("b", d, 2.0), (None, d, 3.0)], schema), target, ["owner", "file_date"]) == 1
    assert refresh_daily(spark.createDataFrame([("a", d, None), (None, d, 4.0)], schema), target, ["owner", "file_date"]) == 2
    assert sorted(map(tuple, read_daily(spark, target).collect()), key=str) == sorted([("a", d, None), ("b", d, 2.0), (None, d, 4.0)], key=str)
    assert refresh_daily(spark.createDataFrame([], schema), target, ["owner", "file_date"]) == 2
