"""AGG1-AGG4: R's NA rules in distinct counts and set differences (FIXTURES 2.6)."""

from pyspark.sql import functions as F

from kinfold.operators.summary import enrollment_counts, enrollment_summary

SCHEMA = "patient_id string, FamilyID int, fam_pos int, invitation_status string"


def test_na_counts_as_a_value(spark):
    # FIXTURES 2.6: enrolled = 3 (a, b, NA), invited = 5 (a, b, c, d, NA)
    rows = [("a", 1, 1, "enrolled"), ("a", 1, 1, "enrolled"), ("b", 1, 2, "enrolled"), ("c", 2, 1, "invited"),
            ("d", 2, 2, None), (None, 3, 1, "enrolled"), (None, 3, None, "invited")]
    df = spark.createDataFrame(rows, SCHEMA)
    c = enrollment_counts(df, df).first()
    assert c.pt_enrolled == 3
    assert c.pt_invited == 5
    assert c.pt_dropped == 0
    # families: enrolled {1, 3} plus NA from d's NULL status -> 3; invited {1, 2, 3} -> 3
    assert c.fam_enrolled == 3 and c.fam_invited == 3
    # founders (fam_pos == 1): ids a, c, NA(id) + NA(cond) -> {a, c, NA} = 3
    assert c.founders_invited == 3
    # founders enrolled: a (TRUE), c (FALSE), d (pos 2 -> FALSE), NA id (TRUE) -> {a, NA}; NULL pos & invited -> FALSE
    assert c.founders_enrolled == 2


def test_dropped(spark):
    everyone = spark.createDataFrame([("a", 1, 1, "enrolled"), ("b", 1, 2, "enrolled"), ("c", 2, 1, "invited"),
                                      (None, 3, 1, "invited")], SCHEMA)
    active = everyone.where(F.col("patient_id").isin("a", "b"))
    c = enrollment_counts(everyone, active).first()
    assert c.pt_dropped == 2       # c and NA
    assert c.fam_dropped == 2      # 2 and 3
    assert c.founders_dropped == 2  # c and NA


def test_summary_shape(spark):
    everyone = spark.createDataFrame([("a", 1, 1, "enrolled"), ("b", 1, 2, "enrolled"), ("c", 2, 1, "invited")], SCHEMA)
    out = enrollment_summary(everyone, everyone).collect()
    assert [r.level for r in out] == ["individuals", "families", "founders"]
    ind, fam, fnd = out
    assert (ind.enrolled, ind.invited, ind.dropped, ind.enroll_pct) == (2.0, 3.0, 0.0, 2 / 3)
    assert ind.avg_enrolled_fam_size is None and fam.avg_enrolled_fam_size == 2.0
    assert (fnd.enrolled, fnd.invited, fnd.enroll_pct) == (1.0, 2.0, 0.5)


def test_zero_division_is_null(spark):
    empty = spark.createDataFrame([("a", 1, 2, "invited")], SCHEMA)
    out = enrollment_summary(empty, empty).collect()
    assert out[1].avg_enrolled_fam_size is None  # 0 / 0
    assert out[2].enroll_pct is None             # no founders
