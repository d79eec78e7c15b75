"""API1/API2 on the hand-checked rows of FIXTURES 2.1, 2.2 and 2.5."""

import pytest
from pyspark.sql import functions as F

from kinfold.functions import first_match_int, group_int, suffix_label
from kinfold.operators.people import clean_people, process_compensation

# FIXTURES 2.1: points, tickets, rate -> points, tickets, total
COMPENSATION = [
    (None, None, 100, None, 0, None),
    ("", "", 100, None, 0, None),
    ("12.7", None, 100, 12, 0, 12),
    ("50", None, 100, 50, 0, 50),
    ("99", "0", 100, 99, 0, 99),
    ("100", "0", 100, 0, 1, 100),
    ("250", "0", 100, 50, 2, 250),
    ("250", "-1", 100, 50, 2, 250),
    ("350", "2", 100, 150, 2, 350),
    ("120", "3", 100, -180, 3, 120),
    ("50", "3", 100, 50, 3, 350),
    ("120", "0", 150, 120, 0, 120),
    ("150", "0", 150, 0, 1, 150),
    ("60", "0", 50, 60, 0, 60),
    ("100", "0", 50, 0, 2, 100),
]


@pytest.mark.parametrize("pts,tix,k,exp_p,exp_t,exp_total", COMPENSATION)
def test_compensation(spark, pts, tix, k, exp_p, exp_t, exp_total):
    df = spark.createDataFrame([(pts, tix)], "compensation_points string, compensation_tickets string")
    r = process_compensation(df, pts_to_tix=k).first()
    assert (r.compensation_points, r.compensation_tickets, r.total_points) == (exp_p, exp_t, exp_total)


def test_ids(spark):
    rows = [("ABC_0012_1_v", 12, 1, "vitiligo"), ("ABC_12", 12, None, "healthy"), ("ABC_12_v", 12, None, "vitiligo"),
            ("A1C_12_2", 1, 2, "healthy"), ("", None, None, "healthy"), (None, None, None, "healthy")]
    df = spark.createDataFrame([(r[0],) for r in rows], "pid string")
    got = df.select(first_match_int("pid").alias("f"), group_int("pid").alias("p"), suffix_label("pid").alias("v")).collect()
    assert [(g.f, g.p, g.v) for g in got] == [r[1:] for r in rows]


def _raw(spark, rows):
    schema = ("_id string, patient_id string, mdh_participant_id string, age double, invitationstatus string, "
              "enrollmentdate string, inserteddate string, lastUpdateDate string, enrolled boolean, "
              "active_kitstatus string, aou_complete string, shipment_group string, compensation_points string, "
              "compensation_tickets string, studyendreason string, has_vitiligo int, has_vitiligo_post_baseline int")
    full = [("x", pid, f"m{i}", 30.0, "invited", "2025-07-29T03:30:00Z", None, None, enrolled, None, None, None,
             "120", None, None, has, post) for i, (pid, enrolled, has, post) in enumerate(rows)]
    return spark.createDataFrame(full, schema)


def test_flags_family_and_status(spark):
    # FIXTURES 2.5: flags; family 7 has two affected -> multiplex; NULL family ids form one group
    rows = [("AB_7_1", True, 1, 1), ("AB_7_2", None, 0, None), ("AB_7_3", False, 0, 1), ("AB_7_4", None, None, None),
            (None, True, 1, None), ("", False, 1, None), ("AB_8_1", False, 0, None), ("AB_9_1_v", False, 1, None)]
    out = {r.mdh_participant_id: r for r in clean_people(_raw(spark, rows)).collect()}
    assert (out["m0"].has_vitiligo_post_baseline, out["m0"].vitiligo_status) == (None, 1)
    assert (out["m1"].has_vitiligo_post_baseline, out["m1"].vitiligo_status) == (0, 0)
    assert (out["m2"].has_vitiligo_post_baseline, out["m2"].vitiligo_status) == (1, 1)
    assert (out["m3"].has_vitiligo_post_baseline, out["m3"].vitiligo_status) == (None, 0)
    assert out["m0"].num_affected == 2 and out["m0"].plex == "multiplex"
    assert out["m4"].FamilyID is None and out["m4"].num_affected == 2  # two NULL families, one each
    assert out["m6"].plex == "zeroplex" and out["m7"].plex == "simplex"
    assert out["m0"].invitation_status == "enrolled" and out["m1"].invitation_status == "invited"
    assert len(clean_people(_raw(spark, rows)).columns) == 23


def test_local_enroll_date_and_instant(spark):
    r = clean_people(_raw(spark, [("AB_1_1", True, 0, None)])).first()
    import datetime as dt
    assert r.enroll_date == dt.datetime(2025, 7, 29, 3, 30)


def test_count_preserved(spark):
    raw = _raw(spark, [(f"AB_{i // 3}_{i % 3 + 1}", i % 2 == 0, i % 2, None) for i in range(40)])
    assert clean_people(raw).count() == 40


def test_alternative_id_patterns(spark):
    from kinfold.functions.ids import POSITION_PATTERN_SUFFIXED, prefixed_family_pattern
    df = spark.createDataFrame([("ST_12_3_v",), ("ST_12_4",), ("XX_9_1",)], "pid string")
    got = df.select(first_match_int("pid", prefixed_family_pattern("ST")).alias("f"),
                    first_match_int("pid", POSITION_PATTERN_SUFFIXED).alias("p")).collect()
    assert [(r.f, r.p) for r in got] == [(12, 3), (12, 4), (None, 1)]
