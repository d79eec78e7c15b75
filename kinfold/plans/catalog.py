"""Named queries over the benchmark tables: one per operator group of SURVEY section 2.

Every entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame. Double columns are rounded to
``DIGITS`` decimals at the very end so that engines summing in different orders print the same value.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.functions.answers import ALL_ANSWERS, FIRST_ANSWER
from kinfold.functions.ids import POSITION_PATTERN_SUFFIXED, first_match_int, prefixed_family_pattern
from kinfold.functions.timecols import format_refresh, last_refresh
from kinfold.operators.people import clean_people, is_active, not_withdrawn, process_compensation
from kinfold.operators.responses import (clean_dictionary, clean_responses, dictionary_overview, dictionary_versions,
                                        responses_last_updated)
from kinfold.operators.scoring import (enrich, enriched_long, enriched_overview, first_per_group, score_likert,
                                      score_totals, topic_rows, topic_slice, topic_slices)
from kinfold.operators.reshape import bind_rows, dropped_keys, sample_rows
from kinfold.operators.series import align_daily, combine_series, daily_mean_vs_first, scaled_pair
from kinfold.operators.stats import METRIC_LABELS, box_numbers, compare_groups, two_sample, violin_density
from kinfold.operators.summary import enrollment_summary
from kinfold.plans import study
from kinfold.plans.tables import table
from kinfold.session import materialize
from kinfold.sources.envelope import PARTICIPANT_SCHEMA, SURVEY_SCHEMA, decode_envelope, explode_envelope, read_dictionary
from kinfold.sources.wearables import decode_readiness, decode_resting_hr, hrv_days, index_files, load_resting_hr

DIGITS = 6
# The run time used by the registered queries (a real run passes "now").
RUN_TIME = _dt.datetime(2024, 2, 1, 12, 0, 0)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def wrap(fn):
        QUERIES[name] = fn
        return fn
    return wrap


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        cols.append(F.round(c, digits).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else c)
    return df.select(*cols)


def run_time_refresh():
    # from text: a Python datetime literal would pass through the session time zone
    return last_refresh(F.lit(RUN_TIME.isoformat(sep=" ")).cast("timestamp_ntz"))


# ---------------------------------------------------------------- participants (API1, API2, API4)

@register("compensation")
def q_compensation(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = study.participants_raw(spark, sf_dir)
    out = process_compensation(raw.select("_id", "compensation_points", "compensation_tickets"))
    return out


def people_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_people(study.participants_raw(spark, sf_dir))


@register("people_clean")
def q_people_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(people_all(spark, sf_dir))


@register("dropped_families")
def q_dropped_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dropped_keys(people_all(spark, sf_dir), F.col("FamilyID"), is_active(), name="FamilyID")


@register("dropped_founders")
def q_dropped_founders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dropped_keys(people_all(spark, sf_dir), F.col("patient_id"), is_active(), where=F.col("fam_pos") == 1,
                        name="patient_id")


@register("enrollment_summary")
def q_enrollment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(enrollment_summary(people_all(spark, sf_dir), is_active(), run_time_refresh()))


# ---------------------------------------------------------------- responses and dictionary (API3, API5)

def people_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return not_withdrawn(people_all(spark, sf_dir))


def responses(spark: SparkSession, sf_dir: str, ans_pat: str = FIRST_ANSWER) -> DataFrame:
    return clean_responses(study.surveys_raw(spark, sf_dir), people_active(spark, sf_dir), ans_pat=ans_pat)


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_dictionary(study.dictionary_raw(spark, sf_dir), keep=["row_order"])


@register("responses_clean")
def q_responses_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(responses(spark, sf_dir))


@register("responses_all_answers")
def q_responses_all_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(responses(spark, sf_dir, ALL_ANSWERS))


@register("responses_last_updated")
def q_responses_last_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses_last_updated(responses(spark, sf_dir))


@register("first_per_day")
def q_first_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN2 on every response: the earliest answer per (patient, local day, survey)."""
    r = responses(spark, sf_dir).select("patient_id", "recorded_date", "surveyname", "recorded_dttm", "response_id",
                                        "answers")
    return first_per_group(r, ["patient_id", "recorded_date", "surveyname"],
                           [F.col("recorded_dttm").isNull(), F.col("recorded_dttm"), F.col("response_id"),
                            F.col("answers").isNull(), F.col("answers")])


@register("dictionary_versions")
def q_dictionary_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary_versions(dictionary(spark, sf_dir))


@register("dictionary_overview")
def q_dictionary_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary_overview(dictionary(spark, sf_dir))


# ---------------------------------------------------------------- enrichment and scoring (API6-API9)

@register("enriched")
def q_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(enrich(responses(spark, sf_dir), dictionary(spark, sf_dir)))


@register("stress_items")
def q_stress_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(score_likert(responses(spark, sf_dir), dictionary(spark, sf_dir)))


@register("enriched_all")
def q_enriched_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(enriched_long(responses(spark, sf_dir), dictionary(spark, sf_dir)))


@register("enriched_overview")
def q_enriched_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_overview(enriched_long(responses(spark, sf_dir), dictionary(spark, sf_dir), sort=False))


@register("topic_slice")
def q_topic_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(topic_rows(responses(spark, sf_dir), dictionary(spark, sf_dir), "general health"))


@register("topic_slices")
def q_topic_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API8: all six topic tables, with the topic as a column."""
    return rounded(topic_slices(enriched_long(responses(spark, sf_dir), dictionary(spark, sf_dir), sort=False)))


@register("enriched_days")
def q_enriched_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DAT4: the long table with the days since enrollment."""
    return rounded(enriched_long(responses(spark, sf_dir), dictionary(spark, sf_dir), sort=False, days_col="days_since_enrollment"))


@register("stress_totals")
def q_stress_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = enriched_long(responses(spark, sf_dir), dictionary(spark, sf_dir), sort=False)
    return score_totals(topic_slice(long, "stress"))


# ---------------------------------------------------------------- wearable series (JN4, API12, API13)

PERSON = ("user_id",)


def hrv_daily(spark: SparkSession, sf_dir: str, keys: Sequence[str] = ()) -> DataFrame:
    return align_daily(study.hrv_detail(spark, sf_dir, keys), study.hrv_summary(spark, sf_dir, keys), keys=keys)


@register("hrv_daily")
def q_hrv_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(hrv_daily(spark, sf_dir))


@register("daily_vs_summary")
def q_daily_vs_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = daily_mean_vs_first(hrv_daily(spark, sf_dir), "rmssd_detail", "rmssd_summary", mean_name="mean_rmssd_detail")
    return rounded(d)


def combined_day(spark: SparkSession, sf_dir: str, join_type: str = "full", keys: Sequence[str] = ()) -> DataFrame:
    return combine_series(hrv_daily(spark, sf_dir, keys), study.resting_hr(spark, sf_dir, keys),
                          study.readiness(spark, sf_dir, keys), by="day", join_type=join_type, keys=keys)


@register("combine_day")
def q_combine_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(combined_day(spark, sf_dir))


@register("combine_inner")
def q_combine_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(combine_series(hrv_daily(spark, sf_dir), study.resting_hr(spark, sf_dir), by="day",
                                  join_type="inner"))


@register("combine_left")
def q_combine_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(combine_series(study.resting_hr(spark, sf_dir), hrv_daily(spark, sf_dir), by="day",
                                  join_type="left"))


@register("combine_month")
def q_combine_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(combine_series(hrv_daily(spark, sf_dir), study.resting_hr(spark, sf_dir), by="month"))


@register("combine_hour")
def q_combine_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(combine_series(study.hrv_detail(spark, sf_dir), study.resting_hr(spark, sf_dir), by="hour"))


@register("combine_minute")
def q_combine_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(combine_series(study.hrv_detail(spark, sf_dir), study.resting_hr(spark, sf_dir), by="minute"))


@register("combine_hour_buckets")
def q_combine_hour_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG9: an input without numeric columns gives its distinct buckets."""
    marks = study.hrv_detail(spark, sf_dir).select("timestamp", F.lit("seen").alias("mark"))
    return rounded(combine_series(marks, study.resting_hr(spark, sf_dir), by="hour"))


@register("hrv_daily_by_person")
def q_hrv_daily_by_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(hrv_daily(spark, sf_dir, PERSON))


@register("daily_vs_summary_by_person")
def q_daily_vs_summary_by_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(daily_mean_vs_first(hrv_daily(spark, sf_dir, PERSON), "rmssd_detail", "rmssd_summary",
                                       mean_name="mean_rmssd_detail", keys=PERSON))


@register("combine_day_by_person")
def q_combine_day_by_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(combined_day(spark, sf_dir, keys=PERSON))


@register("combine_hour_by_person")
def q_combine_hour_by_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(combine_series(study.hrv_detail(spark, sf_dir, PERSON), study.resting_hr(spark, sf_dir, PERSON),
                                  by="hour", keys=PERSON))


# Highlighted window of the registered dual-axis query (inclusive dates).
HIGHLIGHT = ("2024-01-10", "2024-01-13")


@register("scaled_pair")
def q_scaled_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scaled_pair(combined_day(spark, sf_dir), "rmssd_detail", "resting_hr", "HRV (RMSSD)",
                               "Resting HR (bpm)", highlight=HIGHLIGHT))


@register("scaled_pair_by_person")
def q_scaled_pair_by_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = scaled_pair(combined_day(spark, sf_dir, keys=PERSON), "rmssd_detail", "resting_hr", "HRV (RMSSD)",
                        "Resting HR (bpm)", highlight=HIGHLIGHT, keys=PERSON)
    return rounded(rounded(pairs, 9))  # halves at the seventh decimal then round alike, whatever the order of addition


@register("sample_rows")
def q_sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(sample_rows(study.hrv_detail(spark, sf_dir, ["event_id"]), 5, seed=7, keys=["event_id"]))


# ---------------------------------------------------------------- sources (SRC1-SRC9, FLT4, RSH4, API10, API11)
# The texts of responses and export files are built from the tables (plans.study); the readers call the same functions. HRV files, which the index
# and both sides of a day read, are written once.

# Date range of the registered export queries.
EXPORT_START, EXPORT_END = "2024-01-04", "2024-01-25"


@register("envelope_participants")
def q_envelope_participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(explode_envelope(study.participant_pages(spark, sf_dir), PARTICIPANT_SCHEMA))


@register("envelope_surveys")
def q_envelope_surveys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_envelope(study.survey_pages(spark, sf_dir), SURVEY_SCHEMA)


@register("envelope_rejects")
def q_envelope_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1, SRC2: records and bad responses of pages of which some are cut short, doubled, blank or error messages."""
    found = decode_envelope(study.damaged_pages(spark, sf_dir), PARTICIPANT_SCHEMA, keep=["page"])
    return found.groupBy("page", "reject_reason").agg(F.count("_id").alias("records"), F.count("reject_text").alias("texts"))


@register("hrv_index")
def q_hrv_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_files(study.hrv_files(spark, sf_dir).select("owner", "path"), EXPORT_START, EXPORT_END, keys=["owner"])


@register("hrv_index_all_dates")
def q_hrv_index_all_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_files(study.hrv_files(spark, sf_dir).select("owner", "path"), EXPORT_START, EXPORT_END,
                       force_all_dates=True, keys=["owner"])


@register("hrv_from_files")
def q_hrv_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(hrv_days(materialize(study.hrv_files(spark, sf_dir)), EXPORT_START, EXPORT_END, keys=["owner"]))


@register("hrv_summary_from_files")
def q_hrv_summary_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(hrv_days(materialize(study.hrv_files(spark, sf_dir)), EXPORT_START, EXPORT_END, summary_only=True, keys=["owner"]))


@register("resting_from_files")
def q_resting_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(decode_resting_hr(study.resting_files(spark, sf_dir), EXPORT_START, EXPORT_END, keys=["owner"]))


@register("readiness_from_files")
def q_readiness_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(decode_readiness(study.readiness_files(spark, sf_dir), EXPORT_START, EXPORT_END, keys=["owner"]))


@register("resting_from_folders")
def q_resting_from_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC7, SRC9: export folders of several owners, read by header; one of them has no file."""
    return rounded(load_resting_hr(spark, EXPORT_START, EXPORT_END, study.resting_folders(spark, sf_dir), owner_pattern="/(p[0-9]+)/Physical Activity_GoogleData/"))


@register("dictionary_from_files")
def q_dictionary_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3: the dictionary as CSV files, by column name."""
    return read_dictionary(spark, study.dictionary_folder(spark, sf_dir))


@register("other_id_patterns")
def q_other_id_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR13: the family and position of the id by the look-around variants of the patterns."""
    people = clean_people(study.participants_raw(spark, sf_dir), family_pat=prefixed_family_pattern("AB"), position_pat="^AB_[0-9]+_([0-9]+)(?=_v)")
    suffixed = first_match_int("patient_id", POSITION_PATTERN_SUFFIXED).alias("suffixed_pos")
    return people.select("patient_id", "mdh_participant_id", "FamilyID", "fam_pos", suffixed)


# ---------------------------------------------------------------- statistics (API14, AGG16-AGG18)

def lineitem_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.year("l_shipdate").alias("year"), "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")


# The compared periods of the registered combined series (the earlier one is moved back two years).
PERIOD_CUT, EARLIER_YEAR, LATER_YEAR = "2024-01-16", 2022, 2024


@register("period_compare")
def q_period_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API14 on a combined series of two periods, with labels (CND9) and one value for each day (Q18)."""
    day = combined_day(spark, sf_dir)
    cut = F.lit(PERIOD_CUT).cast("date")
    moved = F.when(F.col("file_date") < cut, F.add_months("file_date", 12 * (EARLIER_YEAR - LATER_YEAR))).otherwise(F.col("file_date"))
    both = day.withColumn("file_date", moved).withColumn("year", F.year("file_date"))
    return rounded(compare_groups(both, "year", EARLIER_YEAR, LATER_YEAR, ["resting_hr", "rmssd_detail"],
                                  labels=METRIC_LABELS, pre_aggregate_by="file_date"))


@register("year_compare")
def q_year_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the range of dates reaches the scan, which the year alone would not
    ranged = lineitem_years(spark, sf_dir).where((F.col("l_shipdate") >= F.lit("1997-01-01").cast("date")) & (F.col("l_shipdate") < F.lit("1999-01-01").cast("date")))
    return rounded(compare_groups(ranged, "year", 1997, 1998,
                                  ["l_quantity", "l_extendedprice", "l_discount"]))


@register("two_sample_events")
def q_two_sample_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(
        "event_type", "value", F.when(F.dayofmonth("ts") <= 15, "early").otherwise("late").alias("half"))
    return rounded(two_sample(e, "half", "early", "late", "value", ["event_type"]))


@register("box_numbers")
def q_box_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(box_numbers(lineitem_years(spark, sf_dir), ["year"], "l_extendedprice"))


@register("violin_density")
def q_violin_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rounded(violin_density(lineitem_years(spark, sf_dir), ["year"], "l_extendedprice"), 12), 9)


# ---------------------------------------------------------------- refresh time (API15)

@register("last_refresh")
def q_last_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "ts")
    return e.select("event_id", "ts", last_refresh("ts").alias("last_updated"),
                    format_refresh(last_refresh("ts")).alias("last_updated_text"))
