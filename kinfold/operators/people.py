"""Participant cleaning (API1 process_compensation, API2 clean_people)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.casting import col_of
from kinfold.functions.ids import (AFFECTED_PATTERN, FAMILY_PATTERN, POSITION_PATTERN, first_match_int, group_int,
                                   suffix_label)
from kinfold.functions.timecols import STUDY_TZ, to_instant
from kinfold.operators.joins import join_by

# Points are converted to tickets only above this many points, whatever the rate (quirk Q1).
POINTS_THRESHOLD = 99

# Renames applied to the raw participant record.
PEOPLE_RENAMES = {
    "invitationstatus": "invitation_status",
    "enrollmentdate": "enroll_date",
    "inserteddate": "invite_date",
    "lastUpdateDate": "last_updated_date",
}

# Output columns of the cleaned participant table, in order.
PEOPLE_COLUMNS = (
    "patient_id", "mdh_participant_id", "last_updated_date", "age", "FamilyID", "fam_pos", "vit_status_exp",
    "vitiligo_status", "has_vitiligo", "has_vitiligo_post_baseline", "plex", "num_affected",
    "invitation_status", "enrolled", "active_kitstatus", "aou_complete", "enroll_date", "invite_date",
    "shipment_group", "compensation_points", "compensation_tickets", "total_points", "studyendreason",
)


def process_compensation(df: DataFrame, points: str = "compensation_points", tickets: str = "compensation_tickets",
                         pts_to_tix: int = 100, total: str = "total_points") -> DataFrame:
    """Points -> raffle tickets (MTH1). The four steps are sequential: each sees the previous result.

    1. both fields to int ('' and junk -> NULL, '12.7' -> 12);
    2. NULL or 0 tickets -> 0;
    3. more than 99 points and fewer than 1 ticket -> tickets = floor(points / rate);
    4. more than 99 points and at least 1 ticket -> points = points - tickets * rate (may go negative, Q2);
    5. total = points + rate * tickets.
    """
    k = int(pts_to_tix)
    p, t = f"`{points}`", f"`{tickets}`"
    as_int = "try_cast(try_cast({} AS DOUBLE) AS INT)"  # R as.integer (see functions.casting.safe_int)
    out = df.withColumns({points: F.expr(as_int.format(p)), tickets: F.expr(as_int.format(t))})
    out = out.withColumn(tickets, F.expr(f"CASE WHEN {t} IS NULL OR {t} = 0 THEN 0 ELSE {t} END"))
    out = out.withColumn(tickets, F.expr(f"CASE WHEN {p} > {POINTS_THRESHOLD} AND {t} < 1 "
                                         f"THEN CAST(floor(try_divide({p}, {k})) AS INT) ELSE {t} END"))
    out = out.withColumn(points, F.expr(f"CASE WHEN {p} > {POINTS_THRESHOLD} AND {t} >= 1 THEN {p} - {t} * {k} "
                                        f"ELSE {p} END"))
    return out.withColumn(total, F.expr(f"CAST({p} + {k} * {t} AS INT)"))


def family_totals(df: DataFrame, family: str = "FamilyID", value: str = "vitiligo_status",
                  out: str = "num_affected") -> DataFrame:
    """Per-family sum attached to every member (WIN1); a NULL family is one group.

    Written as aggregate + null-safe join rather than a window: the aggregate combines map-side, and the
    join lets AQE split a hot family (for example all NULL ids) over several tasks, which a window
    partition cannot do.
    """
    sums = df.groupBy(family).agg(F.sum(value).cast("int").alias(out))
    return join_by(df, sums, [family], how="left", suffix=("", "_fam"), null_safe=True)


def clean_people(df: DataFrame, tz: str = STUDY_TZ, pts_to_tix: int = 100, family_pat: str = FAMILY_PATTERN,
                 position_pat: str = POSITION_PATTERN, affected_pat: str = AFFECTED_PATTERN) -> DataFrame:
    """Raw participant records -> the 23-column cleaned table (API2).

    Dates stay instants (UTC wall clock, see ``functions.timecols``); ``tz`` matters where local dates
    are derived downstream. Requires ``has_vitiligo`` and ``has_vitiligo_post_baseline`` (quirk Q10).
    """
    d = df.withColumnsRenamed(PEOPLE_RENAMES)
    has, post = F.col("has_vitiligo"), F.col("has_vitiligo_post_baseline")
    d = d.withColumns({
        "invitation_status": F.when(F.col("enrolled") == F.lit(True), F.lit("enrolled"))
        .otherwise(F.col("invitation_status")),
        "FamilyID": first_match_int("patient_id", family_pat),
        "fam_pos": group_int("patient_id", position_pat),
        "vit_status_exp": suffix_label("patient_id", affected_pat),
        "has_vitiligo_post_baseline": F.when(has == 1, F.lit(None))
        .when((has == 0) & post.isNull(), F.lit(0)).otherwise(post).cast("int"),
        "enroll_date": to_instant(d, "enroll_date"),
        "invite_date": to_instant(d, "invite_date"),
        "last_updated_date": to_instant(d, "last_updated_date"),
    })
    d = d.withColumn("vitiligo_status", (F.coalesce(has, F.lit(0)) + F.coalesce(post, F.lit(0))).cast("int"))
    d = family_totals(d)
    n = F.col("num_affected")
    d = d.withColumn("plex", F.when(n >= 2, F.lit("multiplex")).when(n == 1, F.lit("simplex"))
                     .when(n == 0, F.lit("zeroplex")))
    d = process_compensation(d, pts_to_tix=pts_to_tix)
    return d.select(*PEOPLE_COLUMNS)


def is_active(reason: str = "studyendreason") -> Column:
    """End reason NULL or '' (FLT1), as a condition."""
    r = col_of(reason)
    return r.isNull() | (r == "")


def not_withdrawn(df: DataFrame, reason: str = "studyendreason") -> DataFrame:
    """Keep participants whose end reason is NULL or '' (FLT1)."""
    return df.where(is_active(reason))
