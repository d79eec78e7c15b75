"""SRC1-SRC9 on files written to a fresh temporary folder (FIXTURES 2.8)."""

import datetime as dt
import json
import os
import re
import tempfile

import pytest
from pyspark.sql import Observation

from kinfold.sources import wearables
from kinfold.sources.envelope import PARTICIPANT_SCHEMA, decode_envelope
from kinfold.sources.headered import csv_rows, read_by_header
from kinfold.sources.wearables import DAILY_OWNER_PATTERN, OWNER_PATTERN
from kinfold.sources import (hrv_file_index, load_hrv, load_readiness, load_resting_hr, read_dictionary,
                             read_participants, read_surveys)

HRV = "Heart Rate Variability"


def _write(root, rel, text):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def _summary(root, day, rows=1, name=None):
    y, m, d = day.isoformat().split("-")
    body = "timestamp,rmssd,nremhr,entropy\n" + "".join(f"{day}T00:00:00,{30 + i}.5,55.0,2.1\n" for i in range(rows))
    _write(root, f"{HRV}/{name or f'Daily Heart Rate Variability Summary - {y}-{m}-({d}).csv'}", body)


def _detail(root, day, rows):
    body = "timestamp,rmssd,coverage,low_frequency,high_frequency\n"
    body += "".join(f"{day}T00:{5 * i:02d}:00,{40 + i}.0,0.9,100.0,50.0\n" for i in range(rows))
    _write(root, f"{HRV}/Heart Rate Variability Details - {day}.csv", body)


@pytest.fixture(scope="module")
def export_root():
    root = tempfile.mkdtemp(prefix="kinfold-export-")
    d = dt.date(2025, 7, 1)
    days = [d + dt.timedelta(days=i) for i in range(8)]
    # day1: detail(3) + summary(day0)      -> 3 rows, summary repeated
    _summary(root, days[0]); _detail(root, days[1], 3)
    # day2: detail(2) only                 -> 2 rows, summary NULL
    _detail(root, days[2], 2)
    # day4: summary(day3) only             -> no rows (1 with summary_only)
    _summary(root, days[3])
    # day5: detail header only + summary   -> 1 row, detail NULL
    _detail(root, days[5], 0); _summary(root, days[4])
    # day7: two summaries for day6 + detail -> as if the summary were missing
    _summary(root, days[6]); _summary(root, days[6], name=f"Copy of Daily Heart Rate Variability Summary - "
                                                       f"2025-07-({days[6].day:02d}).csv")
    _detail(root, days[7], 1)
    _write(root, f"{HRV}/notes.txt", "not a csv")
    _write(root, "Physical Activity_GoogleData/daily_resting_heart_rate.csv",
           "timestamp,beats per minute\n2025-07-01T00:00:00Z,55.5\n2025-07-02T00:00:00Z,56.0\n2025-08-02T00:00:00Z,60\n")
    _write(root, "Physical Activity_GoogleData/daily_readiness.csv",
           "timestamp,type,sleep readiness,heart rate variability readiness,resting heart rate readiness,score\n"
           "2025-07-02,HIGH,LOW,HIGH,MEDIUM,81\n2025-09-02,LOW,LOW,LOW,LOW,20\n")
    return root, days


def test_index(spark, export_root):
    root, days = export_root
    idx = {r.file_date: r for r in hrv_file_index(spark, days[0], days[7], root).collect()}
    assert sorted(idx) == [days[1], days[2], days[4], days[5], days[7]]
    assert idx[days[1]].summary_file.endswith("07-(01).csv") and idx[days[1]].detail_file.endswith("07-02.csv")
    assert idx[days[2]].summary_file is None
    assert idx[days[7]].summary_file is None  # two candidates count as missing
    every = hrv_file_index(spark, days[0], days[7], root, force_all_dates=True).collect()
    assert len(every) == 8
    with pytest.raises(ValueError):
        hrv_file_index(spark, days[7], days[0], root)


def test_load_hrv(spark, export_root):
    root, days = export_root
    rows = load_hrv(spark, days[0], days[7], root).collect()
    per_day = {}
    for r in rows:
        per_day.setdefault(r.file_date, []).append(r)
    assert sorted(per_day) == [days[1], days[2], days[5], days[7]]
    assert len(per_day[days[1]]) == 3 and {r.rmssd_summary for r in per_day[days[1]]} == {30.5}
    assert len(per_day[days[2]]) == 2 and all(r.rmssd_summary is None for r in per_day[days[2]])
    assert len(per_day[days[5]]) == 1 and per_day[days[5]][0].rmssd_detail is None
    assert per_day[days[5]][0].rmssd_summary == 30.5
    assert per_day[days[7]][0].rmssd_summary is None
    assert per_day[days[1]][0].timestamp_detail.date() == days[1]
    only = {r.file_date: r for r in load_hrv(spark, days[0], days[7], root, summary_only=True).collect()}
    assert sorted(only) == [days[1], days[2], days[4], days[5], days[7]]
    assert only[days[2]].rmssd is None and only[days[4]].rmssd == 30.5
    forced = load_hrv(spark, days[0], days[7], root, force_missing_detail=True)
    assert forced.where(f"file_date = '{days[4]}'").count() == 1


def test_daily_files(spark, export_root):
    root, _ = export_root
    rhr = load_resting_hr(spark, "2025-07-01", "2025-07-31", root).collect()
    assert [(r.file_date, r.resting_hr) for r in rhr] == [(dt.date(2025, 7, 1), 55.5), (dt.date(2025, 7, 2), 56.0)]
    rd = load_readiness(spark, "2025-07-01", "2025-07-31", root).collect()
    assert len(rd) == 1 and rd[0].daily_readiness_cat == "HIGH" and rd[0].daily_readiness_score == 81.0
    missing = tempfile.mkdtemp(prefix="kinfold-empty-")
    with pytest.warns(UserWarning):
        assert load_resting_hr(spark, "2025-07-01", "2025-07-31", missing).count() == 0
    with pytest.warns(UserWarning):
        assert hrv_file_index(spark, "2025-07-01", "2025-07-02", missing).count() == 0
    with pytest.warns(UserWarning):
        assert load_hrv(spark, "2025-07-01", "2025-07-02", missing).count() == 0


def test_envelope(spark):
    root = tempfile.mkdtemp(prefix="kinfold-json-")
    _write(root, "p/page1.json", json.dumps({"data": {"data": [
        {"_id": "1", "patient_id": "AB_1_1", "mdh_participant_id": "m1", "enrolled": True, "has_vitiligo": 1},
        {"_id": "2", "patient_id": "AB_1_2", "compensation_points": "120"}]}}, indent=2))
    _write(root, "p/page2.json", json.dumps({"data": {"data": []}}))
    _write(root, "s/page1.json", json.dumps({"data": {"data": [{"id": "r1", "answers": "[\"a\",\"b\"]"}]}}))
    people = read_participants(spark, os.path.join(root, "p"))
    assert people.count() == 2 and len(people.columns) == 17
    assert read_surveys(spark, os.path.join(root, "s")).first().answers == '["a","b"]'
    _write(root, "dict.csv", "surveyname,surveyversion,stepidentifier,resultidentifier,survey_type,survey_topic,"
                             "step_readable,questiontext,answerformat,answerchoices\n"
                             'gen,1,s1,q1,BL,general health,S1,"Where is it?\n\n*Select all*",text,"a, b"\n')
    d = read_dictionary(spark, os.path.join(root, "dict.csv")).first()
    assert d.surveyversion == 1 and d.questiontext == "Where is it?\n\n*Select all*"


def test_columns_are_read_by_name(spark):
    root = tempfile.mkdtemp(prefix="kinfold-names-")
    d = dt.date(2025, 7, 1)
    _write(root, f"{HRV}/Heart Rate Variability Details - 2025-07-02.csv",
           "﻿low_frequency,extra,RMSSD , timestamp,coverage,high_frequency\r\n1.5,x,41.0,2025-07-02T00:05:00,0.5,\"2.5\"\r\n\r\n7,y,bad\r\n")
    _write(root, f"{HRV}/Heart Rate Variability Details - 2025-07-03.csv",
           "timestamp,rmssd,coverage,low_frequency,high_frequency\n2025-07-03T00:00:00,42.0,0.9,100,50\n")
    _write(root, f"{HRV}/Daily Heart Rate Variability Summary - 2025-07-(01).csv", "nremhr,rmssd,entropy,timestamp\n55,30.5,2.1,2025-07-01\n")
    for bad in ("Heart Rate Variability Details - 2025-02-30.csv", "Daily Heart Rate Variability Summary - 2025-13-(01).csv",
                "Heart Rate Variability Details - 2025-07-02 - copy.csv", "other.csv"):
        _write(root, f"{HRV}/{bad}", "a,b\n1,2\n")
    rows = load_hrv(spark, d, "2025-07-05", root).orderBy("file_date", "timestamp_detail").collect()
    got = [(r.file_date.day, r.rmssd_detail, r.coverage, r.low_frequency, r.high_frequency, r.rmssd_summary, r.nremhr) for r in rows]
    assert sorted(got, key=str) == sorted([(2, 41.0, 0.5, 1.5, 2.5, 30.5, 55.0), (2, None, None, 7.0, None, 30.5, 55.0), (3, 42.0, 0.9, 100.0, 50.0, None, None)], key=str)
    _write(root, "Physical Activity_GoogleData/daily_resting_heart_rate.csv", "extra,beats per minute,timestamp\nx,55.5,2025-07-01T00:00:00Z\n")
    _write(root, "Physical Activity_GoogleData/daily_readiness.csv",
           "timestamp,score,resting heart rate readiness,type,sleep readiness,heart rate variability readiness\n2025-07-02,81,MEDIUM,HIGH,LOW,NONE\n")
    assert [r.resting_hr for r in load_resting_hr(spark, d, "2025-07-05", root).collect()] == [55.5]
    r = load_readiness(spark, d, "2025-07-05", root).first()
    assert (r.daily_readiness_cat, r.sleep_readiness_cat, r.hrv_readiness_cat, r.rhr_readiness_cat, r.daily_readiness_score) == ("HIGH", "LOW", "NONE", "MEDIUM", 81.0)
    _write(root, "Physical Activity_GoogleData/daily_readiness.csv", "timestamp,type\n2025-07-02,HIGH\n")
    with pytest.raises(Exception, match="no column 'sleep readiness'"):
        load_readiness(spark, d, "2025-07-05", root).collect()


def test_files_outside_the_range_are_not_opened(spark, export_root, monkeypatch):
    root, days = export_root
    opened, real = [], wearables.read_by_header
    monkeypatch.setattr(wearables, "read_by_header", lambda s, paths, columns: (opened.extend(paths), real(s, paths, columns))[1])
    load_hrv(spark, days[0], days[2], root).collect()
    assert {re.search(r"07-[(]?(\d\d)[)]?[.]csv$", f).group(1) for f in opened} == {"01", "02", "03"} and len(opened) == 3


TRICKY = {
    "line break": ('timestamp,note,v\n2024-01-01,"a\nb",60\n2024-01-02,c,61\n', [("2024-01-01", "a\nb", 60.0), ("2024-01-02", "c", 61.0)]),
    "quotes": ('note,v,timestamp\r\n"say ""x"", y", 1 ,t1\r\n"",NA,t2\r\n', [("t1", 'say "x", y', 1.0), ("t2", None, None)]),
    "blank lines": ('\n \t\nv,timestamp,note\n\n7,t,n\n   \n', [("t", "n", 7.0)]),
    "short": ("timestamp,note,v\nt\n", [("t", None, None)]),
    "header only": ("timestamp,note,v\n", []),
    "empty": ("", []),
    "mark": ("\ufeffTimestamp,NOTE , v\nt,n,1e2\n", [("t", "n", 100.0)]),
    "wide": (",".join(f"x{i}" for i in range(300)) + ",v,timestamp,note\n" + "," * 300 + "5,t,n\n", [("t", "n", 5.0)]),
    "long": ("v,note,timestamp\n1,\"" + '""' * 30_000 + "\nx\",t\n", [("t", '"' * 30_000 + "\nx", 1.0)]),
    "inner quote": ('timestamp,note,v\n5" tube,n,2\n', [('5" tube', "n", 2.0)]),
}
KINDS = {"timestamp": "string", "note": "string", "v": "double"}


@pytest.mark.parametrize("name", TRICKY)
def test_records_of_texts_and_of_files(spark, name):
    text, want = TRICKY[name]
    got = csv_rows(spark.createDataFrame([(1, text), (2, None)], "id int, text string"), KINDS, keep=["id"]).collect()
    assert [tuple(r)[1:] for r in got] == want and {r.id for r in got} <= {1}
    root = tempfile.mkdtemp(prefix="kinfold-csv-")
    path = os.path.join(root, "a [1] {2}.csv")
    with open(path, "w", newline="") as fh:
        fh.write(text)
    rows = read_by_header(spark, ["file:" + path], KINDS).collect()
    assert [tuple(r)[1:] for r in rows] == want and {r.path for r in rows} <= {"file:" + path}


def test_a_quote_that_never_closes_is_a_character(spark):
    got = csv_rows(spark.createDataFrame([('timestamp,note,v\nt,"open,1\nu,n,2\n',)], "text string"), KINDS).collect()
    assert [tuple(r) for r in got] == [("t", '"open', 1.0), ("u", "n", 2.0)]


def test_one_scan_for_each_header(spark):
    root = tempfile.mkdtemp(prefix="kinfold-heads-")
    for i in range(6):
        _write(root, f"{i}.csv", ("timestamp,note,v\n" if i % 2 else "v,other,note,timestamp\n") + ("t,n,1\n" if i % 2 else "2,o,n,u\n") * (i + 1))
    df = read_by_header(spark, [f"file:{root}/{i}.csv" for i in range(6)], {"timestamp": "string", "v": "double"})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert sorted(line.split("ReadSchema: ")[1].strip() for line in plan.splitlines() if "FileScan csv" in line) == ["struct<c0:string,c2:string>", "struct<c0:string,c3:string>"]
    assert sorted((r.timestamp, r.v, r["count"]) for r in df.groupBy("timestamp", "v").count().collect()) == [("t", 1.0, 12), ("u", 2.0, 9)]
    with pytest.raises(ValueError, match="no column 'w'"):
        read_by_header(spark, [f"file:{root}/1.csv"], {"w": "string"})
    assert read_by_header(spark, [], KINDS).columns == ["path", *KINDS] and read_by_header(spark, [], KINDS).count() == 0


def test_daily_files_of_many_owners(spark):
    root = tempfile.mkdtemp(prefix="kinfold-daily-")
    for who, v in (("ann", 55), ("bob", 66)):
        _write(root, f"{who}/Physical Activity_GoogleData/daily_resting_heart_rate.csv", f"beats per minute,timestamp\n{v},2025-07-01T00:00:00Z\n")
    got = load_resting_hr(spark, "2025-07-01", "2025-07-02", root, owner_pattern=DAILY_OWNER_PATTERN).collect()
    assert sorted((r.owner, r.resting_hr) for r in got) == [("ann", 55.0), ("bob", 66.0)]


def test_many_owners_in_one_scan(spark):
    root = tempfile.mkdtemp(prefix="kinfold-owners-")
    d = dt.date(2025, 7, 1)
    for who, rows in (("ann", 2), ("bob", 3)):
        _detail(os.path.join(root, who), d, rows)
        _summary(os.path.join(root, who), d - dt.timedelta(days=1))
    _detail(os.path.join(root, "cy"), d + dt.timedelta(days=1), 1)
    got = load_hrv(spark, d, d + dt.timedelta(days=2), root, owner_pattern=OWNER_PATTERN).groupBy("owner", "file_date", "rmssd_summary").count().collect()
    assert sorted((r.owner, r.file_date, r.rmssd_summary, r["count"]) for r in got) == [("ann", d, 30.5, 2), ("bob", d, 30.5, 3), ("cy", d + dt.timedelta(days=1), None, 1)]


def test_dictionary_by_name(spark):
    root = tempfile.mkdtemp(prefix="kinfold-dict-")
    _write(root, "d.csv", "surveyversion,note,surveyname,stepidentifier,resultidentifier,survey_type,survey_topic,step_readable,questiontext,answerformat,answerchoices\n"
                          "2,n,gen,s1,q1,BL,topic,S1,Q?,text,a\n")
    r = read_dictionary(spark, os.path.join(root, "d.csv")).first()
    assert (r.surveyname, r.surveyversion, r.answerchoices) == ("gen", 2, "a")
    _write(root, "e.csv", "surveyname\ngen\n")
    with pytest.raises(ValueError, match="surveyversion"):
        read_dictionary(spark, os.path.join(root, "e.csv"))


GOOD = '{"data": {"data": [{"_id": "1", "age": 3.5}, {"_id": "2", "age": "old"}]}, "n": 2}'
BAD = {GOOD[:40]: "malformed or truncated", GOOD + "}": "malformed or truncated", GOOD + GOOD: "malformed or truncated", "nonsense": "malformed or truncated", None: "no text", " ": "no text",
       '{"error": "token expired"}': "no list at data.data", '{"data": {"data": null}}': "no list at data.data", "[]": "no list at data.data",
       '{"data": {"data": {"_id": 5}}}': "no list at data.data", '{"data": {"data": ["x"]}}': "a record is no object"}


def test_bad_responses_are_counted_and_returned(spark):
    texts = [GOOD, '{"data": {"data": []}}', *BAD]
    df = spark.createDataFrame(list(enumerate(texts)), "at int, text string")
    seen = Observation("responses")
    rows = decode_envelope(df, PARTICIPANT_SCHEMA, keep=["at"], observation=seen).collect()
    assert [(r._id, r.age, r.reject_reason, r.reject_text) for r in rows if r["at"] == 0] == [("1", 3.5, None, None), ("2", None, None, None)]
    assert {texts[r["at"]]: (r.reject_reason, r.reject_text, r._id) for r in rows if r["at"] > 1} == {t: (why, t, None) for t, why in BAD.items()}
    assert seen.get == {"responses": len(texts), "bad_responses": len(BAD), "records": 2} and all(r["at"] != 1 for r in rows)
    assert [r._id for r in decode_envelope(df, PARTICIPANT_SCHEMA, on_bad="drop").collect()] == ["1", "2"]
    assert decode_envelope(df.limit(0), PARTICIPANT_SCHEMA, on_bad="fail").count() == 0
    with pytest.raises(ValueError):
        decode_envelope(df, PARTICIPANT_SCHEMA, on_bad="ignore")


def test_a_bad_response_stops_the_read(spark):
    root = tempfile.mkdtemp(prefix="kinfold-bad-")
    _write(root, "p/1.json", GOOD)
    assert read_participants(spark, os.path.join(root, "p")).count() == 2
    _write(root, "p/2.json", GOOD[:50])
    with pytest.raises(Exception, match="bad response .malformed or truncated"):
        read_participants(spark, os.path.join(root, "p")).collect()
    bad = read_participants(spark, os.path.join(root, "p"), on_bad="reject").where("reject_reason IS NOT NULL").collect()
    assert [(os.path.basename(r.path), r.reject_text) for r in bad] == [("2.json", GOOD[:50])]
