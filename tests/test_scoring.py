"""API3, API5-API9 on small hand-made records."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kinfold.operators.responses import clean_dictionary, clean_responses, dictionary_overview, dictionary_versions
from kinfold.operators.scoring import enrich, first_per_group, score_likert, score_totals, topic_slice

PEOPLE = ("patient_id string, mdh_participant_id string, FamilyID int, age double, vitiligo_status int, "
          "total_points int, enroll_date timestamp_ntz")
SURVEYS = ("id string, participantid string, surveyid string, DID string, date string, inserteddate string, "
           "creationDate string, lastUpdateDate string, surveyname string, surveyversion string, "
           "surveydisplayname string, stepidentifier string, resultidentifier string, answers string")
DICT = ("surveyname string, surveyversion int, stepidentifier string, resultidentifier string, survey_type string, "
        "survey_topic string, step_readable string, questiontext string, answerformat string, answerchoices string, "
        "row_order int")


def _people(spark):
    return spark.createDataFrame([("AB_1_1", "m1", 1, 40.0, 1, 250, dt.datetime(2025, 1, 1, 15, 0)),
                                  ("AB_2_1", None, 2, 50.0, 0, 10, dt.datetime(2025, 1, 1, 15, 0))], PEOPLE)


def _survey(i, pid, date, name, disp, q, ans, version="1"):
    return (f"r{i}", pid, "s", "d", date, date, date, date, name, version, disp, f"st{q}", f"q{q}", ans)


def _surveys(spark):
    rows = [
        _survey(1, "m1", "2025-07-29T03:30:00Z", "gen", "General", 1, '["true"]'),
        _survey(2, "m1", "2025-07-29T12:00:00Z", "gen", "General", 2, '["a","b"]'),
        _survey(3, "m9", "2025-07-29T12:00:00Z", "gen", "General", 1, '["x"]'),       # no participant
        _survey(4, None, "2025-07-29T12:00:00Z", "gen", "General", 1, '["n"]'),       # NULL id matches NULL id
        _survey(5, "m1", "2025-07-29T12:00:00Z", "admin", "Consent", 1, '["y"]'),      # no dictionary row
        _survey(6, "m1", "2025-07-29T13:00:00Z", "pss_stress", "Perceived Stress", 4, '["Fairly often"]', "2"),
        _survey(7, "m1", "2025-07-29T12:00:00Z", "pss_stress", "Perceived Stress", 4, '["Never"]', "2"),  # earlier: kept
        _survey(8, "m1", "2025-07-30T12:00:00Z", "pss_stress", "Perceived Stress", 1, '["Fairly often"]', "2"),
        _survey(9, "m1", "2025-07-30T12:00:00Z", "pss_stress", "Perceived Stress", 2, '["maybe"]', "2"),
    ]
    return spark.createDataFrame(rows, SURVEYS)


def _dictionary(spark):
    rows = [("gen", 1, "st1", "q1", "BL", "general health", "s1", "1 Q", "f", "yes/no", 1),
            ("gen", 1, "st2", "q2", "BL", "general health", "s2", "2 Q", "f", "a,b", 2),
            ("gen", 2, "st1", "q1", "QT", "general health", "s1", "1 Q", "f", "yes/no", 3),
            ("pss_stress", 2, "st4", "q4", "QT", "stress", "s4", "4. how often", "f", "scale", 4),
            ("pss_stress", 2, "st1", "q1", "QT", "stress", "s1", "1. how often", "f", "scale", 5),
            ("pss_stress", 2, "st2", "q2", "QT", "stress", "s2", "2. how often", "f", "scale", 6),
            ("pss_stress", 1, "st4", "q4", "BL", "stress", "s4", "4. how often", "f", "scale", 7)]
    return clean_dictionary(spark.createDataFrame(rows, DICT), keep=["row_order"])


def test_clean_responses(spark):
    out = clean_responses(_surveys(spark), _people(spark))
    assert out.columns[:4] == ["patient_id", "recorded_dttm", "recorded_date", "response_id"]
    assert "participantid" not in out.columns and "DID" not in out.columns
    got = {r.response_id: r for r in out.collect()}
    assert "r3" not in got and "r4" in got  # NULL participant id joined the NULL mdh id (quirk Q6)
    assert got["r1"].recorded_date == dt.date(2025, 7, 28)  # local date in New York
    assert got["r2"].answers == '"a"'
    assert clean_responses(_surveys(spark), _people(spark), null_safe=False).where("response_id = 'r4'").count() == 0


def test_dictionary_overviews(spark):
    d = _dictionary(spark)
    v = [(r.survey_topic, r.survey_type, r.surveyversion, r.total_questions) for r in dictionary_versions(d).collect()]
    assert v[0] == ("general health", "BL", "1", 2)
    o = {(r.survey_topic, r.survey_type): r.versions for r in dictionary_overview(d).collect()}
    assert o[("stress", "QT")] == "2" and o[("general health", "BL")] == "1"


def test_enrich_and_score(spark):
    resp = clean_responses(_surveys(spark), _people(spark))
    d = _dictionary(spark)
    e = {(r.patient_id, r.question_standardized): r for r in enrich(resp, d).collect()}
    assert e[("AB_1_1", "1 Q")].answer_clean == "Yes" and e[("AB_1_1", "2 Q")].answer_clean == "a"
    assert len(e) == 3  # r1, r2 and the NULL-id r4 of AB_2_1; admin and stress rows excluded
    s = score_likert(resp, d).collect()
    by_q = {(r.recorded_date, r.question_standardized): r for r in s}
    assert by_q[(dt.date(2025, 7, 29), "4. how often")].answer_clean == "4"   # earliest answer 'never', reversed
    assert by_q[(dt.date(2025, 7, 30), "1. how often")].answer_clean == "3"
    assert by_q[(dt.date(2025, 7, 30), "2. how often")].answer_clean is None  # not on the scale
    assert all(r.survey_type == "QT" for r in s)  # ~6.9 months after enrollment
    assert all(r.possible_answers == "0, 1, 2, 3, 4" for r in s)
    totals = {r.recorded_date: r.stress_score for r in score_totals(topic_slice(score_likert(resp, d), "stress")).collect()}
    assert totals == {dt.date(2025, 7, 29): 4, dt.date(2025, 7, 30): 3}
    with pytest.raises(ValueError):
        topic_slice(enrich(resp, d), "astrology")


def test_first_per_group(spark):
    rows = [("p", 1, None, "r3"), ("p", 1, dt.datetime(2025, 1, 2), "r2"), ("p", 1, dt.datetime(2025, 1, 2), "r1"),
            ("p", 2, dt.datetime(2025, 1, 5), "r9")]
    df = spark.createDataFrame(rows, "p string, k int, t timestamp_ntz, id string")
    got = {r.k: r.id for r in first_per_group(df, ["p", "k"], [F.col("t").isNull(), F.col("t"), F.col("id")]).collect()}
    assert got == {1: "r1", 2: "r9"}


def test_overview_prints_missing_version_as_na(spark):
    rows = [("gen", None, "st1", "q1", "BL", "general health", "s1", "Q", "f", "c", 1),
            ("gen", 2, "st1", "q1", "BL", "general health", "s1", "Q", "f", "c", 2),
            ("gen", None, "st2", "q2", "BL", "general health", "s2", "Q", "f", "c", 3)]
    d = clean_dictionary(spark.createDataFrame(rows, DICT), keep=["row_order"])
    r = dictionary_overview(d).first()
    assert (r.versions, r.total_questions) == ("NA, 2", 3)
