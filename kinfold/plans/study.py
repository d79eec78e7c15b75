"""Benchmark tables -> study-shaped inputs.

The study's own inputs (participant and survey records, the data dictionary, wearable exports) are
personal data and absent; these builders derive inputs of the same schema from the benchmark tables so
that every registered query reads those tables and grows with them. Each derivation is repeated, column
for column, in ``plans.oracle`` for the DuckDB check. NULLs, blanks and malformed text are injected with
fixed modulo rules so that every quirk of the study code is exercised.

Mapping: participants <- customer (+ first/last order date per customer); survey responses <- events
(user_id = customer key); dictionary <- distinct questions of those responses; wearable series <- events
split by event_type.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.plans.tables import table
from kinfold.session import ensure_checkpoint_dir

ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_UTC_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ISO_PLUS2 = "yyyy-MM-dd'T'HH:mm:ss'+02:00'"


def participants_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """participant records (FIXTURES 1.2) from ``customer`` and each customer's order dates."""
    c = table(spark, sf_dir, "customer", spread_rows=True)
    o = (table(spark, sf_dir, "orders")
         .groupBy("o_custkey")
         .agg(F.min("o_orderdate").alias("min_od"), F.max("o_orderdate").alias("max_od")))
    j = c.join(o, c.c_custkey == o.o_custkey, "left")
    enroll_ts = ("timestampadd(HOUR, c_custkey % 24, timestampadd(DAY, dayofyear(min_od) % 92, "
                 "timestamp_ntz'2023-11-01 00:00:00'))")
    invite_ts = f"timestampadd(DAY, -(c_custkey % 30 + 1), {enroll_ts})"
    # one projection of SQL expressions (parsed JVM-side in one go)
    return j.selectExpr(
        "concat('P', c_custkey) AS _id",
        "CASE WHEN c_custkey % 101 = 100 THEN NULL ELSE concat('AB_', c_custkey div 4, '_', c_custkey % 4 + 1, "
        "CASE WHEN c_mktsegment = 'BUILDING' THEN '_v' ELSE '' END) END AS patient_id",
        "concat('M', c_custkey) AS mdh_participant_id",
        "cast(18 + c_custkey % 60 as double) + cast(c_nationkey as double) / 25 AS age",
        "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'invited' END AS invitationstatus",
        f"CASE WHEN c_custkey % 37 = 5 THEN 'not a date' ELSE date_format({enroll_ts}, {_sql(ISO_UTC)}) END "
        "AS enrollmentdate",
        f"date_format({invite_ts}, {_sql(ISO_UTC)}) AS inserteddate",
        f"date_format(timestampadd(HOUR, 12, max_od), {_sql(ISO_PLUS2)}) AS lastUpdateDate",
        "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey % 2 = 0 END AS enrolled",
        "CASE c_nationkey % 3 WHEN 0 THEN 'shipped' WHEN 1 THEN 'received' ELSE 'returned' END AS active_kitstatus",
        "CASE WHEN c_custkey % 2 = 0 THEN 'yes' ELSE 'no' END AS aou_complete",
        "concat('G', c_nationkey % 5) AS shipment_group",
        "CASE WHEN c_custkey % 13 = 0 THEN '' "
        "WHEN c_custkey % 13 = 6 THEN concat(cast(cast(c_acctbal / 20 AS bigint) AS string), '.7') "
        "ELSE cast(cast(c_acctbal / 20 AS bigint) AS string) END AS compensation_points",
        "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE cast(c_custkey % 4 AS string) END AS compensation_tickets",
        "CASE WHEN c_mktsegment = 'MACHINERY' OR c_custkey div 4 % 25 = 3 THEN 'withdrew' WHEN c_custkey % 3 = 0 THEN NULL ELSE '' END "
        "AS studyendreason",
        "CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS has_vitiligo",
        "CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 WHEN c_custkey % 19 = 0 THEN 0 ELSE NULL END "
        "AS has_vitiligo_post_baseline",
    )


def _sql(text: str) -> str:
    """SQL string literal (backslash-escaped quotes)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Survey families of the stand-in responses, keyed by event_type:
# (surveyname, display name, topic).
TOPIC_SURVEYS = {
    "error": ("environment", "Environmental Exposures", "environmental exposures"),
    "click": ("health", "General Health", "general health"),
    "view": ("life", "Life Changes", "life changes"),
    "purchase": ("skin", "Skin Type", "skin type"),
    "signup": ("vitiligo", "Vitiligo Check-in", "vitiligo"),
}
STRESS_SURVEY = ("Stress_PSS", "Perceived Stress Scale", "stress")
ADMIN_SURVEY = ("admin_consent", "Consent form")
# The stress answer given for each event_type (the five scale points, in scale order).
STRESS_ANSWERS = {"error": "Never", "click": "Almost never", "view": "Sometimes", "purchase": "Fairly often",
                  "signup": "Very often"}
# Result ids whose question text the dictionary cleaning overrides.
OVERRIDE_IDS = ("new_spots_adhoc", "new_spots_duration", "vitiligo_location1_adhoc")


def _case(col: str, mapping: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {arms} END"


def _survey_fields() -> dict[str, str]:
    """SQL text of the survey identity columns, shared by responses and dictionary."""
    kind = ("CASE WHEN event_id % 17 = 3 THEN 'admin' WHEN event_id % 4 = 0 THEN 'stress' ELSE 'topic' END")
    topic_name = _case("event_type", {k: v[0] for k, v in TOPIC_SURVEYS.items()})
    surveyname = (f"CASE {kind} WHEN 'admin' THEN '{ADMIN_SURVEY[0]}' WHEN 'stress' THEN '{STRESS_SURVEY[0]}' "
                  f"ELSE {topic_name} END")
    display = (f"CASE {kind} WHEN 'admin' THEN '{ADMIN_SURVEY[1]}' WHEN 'stress' THEN '{STRESS_SURVEY[1]}' "
               f"ELSE {_case('event_type', {k: v[1] for k, v in TOPIC_SURVEYS.items()})} END")
    topic = (f"CASE {kind} WHEN 'admin' THEN NULL WHEN 'stress' THEN '{STRESS_SURVEY[2]}' "
             f"ELSE {_case('event_type', {k: v[2] for k, v in TOPIC_SURVEYS.items()})} END")
    q = "(event_id % 10 + 1)"
    ids = ", ".join(f"'{i}'" for i in OVERRIDE_IDS)
    pick = f"element_at(array({ids}), cast({q} AS int))"
    result_id = (f"CASE WHEN {kind} = 'topic' AND event_type = 'signup' AND {q} <= 3 THEN {pick} "
                 f"ELSE concat({surveyname}, '_q', {q}) END")
    return {"kind": kind, "surveyname": surveyname, "display": display, "topic": topic, "q": q,
            "version": "(event_id % 3 + 1)", "result_id": result_id,
            "step_id": f"concat({surveyname}, '_step', {q})"}


def answers_sql() -> str:
    """SQL text of the raw ``answers`` field of the stand-in responses (some very long, some over several lines)."""
    s = _survey_fields()
    stress_answer = _case("event_type", STRESS_ANSWERS)
    topic_answer = (
        "CASE WHEN event_id % 53 = 5 THEN concat('[\"', repeat('Long text ', 150), '\",\"b\"]') "
        "WHEN event_id % 53 = 6 THEN concat('[\"Line 1', chr(10), 'line 2\",\"c\"]') "
        "ELSE CASE event_type "
        "WHEN 'error' THEN concat('[\"Exposure ', user_id % 5, '\"]') "
        "WHEN 'click' THEN CASE WHEN value > 100 THEN '[\"True\"]' ELSE '[\"false\"]' END "
        "WHEN 'view' THEN concat('[\"opt', event_id % 3, '\",\"opt', user_id % 4, '\"]') "
        "WHEN 'purchase' THEN concat('[', cast(floor(value) AS int), ']') "
        "ELSE CASE WHEN event_id % 2 = 0 THEN NULL ELSE concat('[\"Spot ', event_id % 9, '\", \"arm\"]') END END END")
    return (f"CASE {s['kind']} WHEN 'stress' THEN CASE WHEN user_id % 29 = 0 THEN '[\"not sure\"]' "
            f"ELSE concat('[\"', {stress_answer}, '\"]') END ELSE {topic_answer} END")


def surveys_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """survey response records (FIXTURES 1.3) from ``events``."""
    e = table(spark, sf_dir, "events", spread_rows=True)
    s = _survey_fields()
    return e.selectExpr(
        "concat('R', event_id) AS id",
        "CASE WHEN event_id % 23 = 0 THEN NULL ELSE concat('M', user_id) END AS participantid",
        "concat('S', event_id % 7) AS surveyid",
        "concat('D', user_id % 10) AS DID",
        f"CASE WHEN event_id % 41 = 7 THEN 'n/a' ELSE date_format(ts, {_sql(ISO_UTC_MICROS)}) END AS date",
        f"date_format(ts, {_sql(ISO_UTC_MICROS)}) AS inserteddate",
        f"date_format(ts, {_sql(ISO_UTC_MICROS)}) AS creationDate",
        f"date_format(timestampadd(DAY, 1, ts), {_sql(ISO_UTC)}) AS lastUpdateDate",
        f"{s['surveyname']} AS surveyname",
        f"cast({s['version']} AS string) AS surveyversion",
        f"{s['display']} AS surveydisplayname",
        f"{s['step_id']} AS stepidentifier",
        f"{s['result_id']} AS resultidentifier",
        f"{answers_sql()} AS answers",
    )


def dictionary_fields() -> list[tuple[str, str]]:
    """(SQL text, name) of the dictionary columns, computed per response row."""
    s = _survey_fields()
    q = s["q"]
    is_stress = f"{s['kind']} = 'stress'"
    scale = ", ".join(STRESS_ANSWERS[k].lower() for k in STRESS_ANSWERS)
    return [
        (s["surveyname"], "surveyname"),
        (f"cast({s['version']} AS int)", "surveyversion"),
        (s["step_id"], "stepidentifier"),
        (s["result_id"], "resultidentifier"),
        (f"CASE WHEN {is_stress} THEN CASE WHEN {s['version']} = 1 THEN 'BL' ELSE 'QT' END "
         f"ELSE CASE WHEN {s['version']} = 3 THEN 'QT' ELSE 'BL' END END", "survey_type"),
        (s["topic"], "survey_topic"),
        (f"concat('Step ', {q})", "step_readable"),
        (f"CASE WHEN {is_stress} THEN concat({q}, '. In the last month, how often did item ', {q}, ' happen?') "
         f"ELSE concat('Question ', {q}, ' about ', {s['topic']}) END", "questiontext"),
        (f"CASE WHEN {is_stress} THEN 'scale' ELSE 'text' END", "answerformat"),
        (f"CASE WHEN {is_stress} THEN '{scale}' ELSE 'free text' END", "answerchoices"),
    ]


def dictionary_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """data dictionary (FIXTURES 1.4): one row per distinct question of the non-admin responses.

    ``row_order`` (first event id of the question) stands in for the sheet's row order.
    Its size is bounded by surveys x versions x questions, not by the number of events.
    """
    e = table(spark, sf_dir, "events")
    s = _survey_fields()
    fields = dictionary_fields()
    base = e.where(F.expr(f"{s['kind']} <> 'admin'")).selectExpr(
        *[f"{text} AS {name}" for text, name in fields], "event_id")
    return base.groupBy(*[name for _, name in fields]).agg(F.min("event_id").alias("row_order"))


# ---------------------------------------------------------------- wearable series from events
# Which event_type plays which wearable series.
DETAIL_TYPE, SUMMARY_TYPE, RESTING_TYPE, READINESS_TYPE = "view", "click", "purchase", "signup"


#: Events of one export: a busy user's events are dealt over several exports, so that no file grows with the table.
EXPORT_EVENTS = 1_000_000


def _series(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Events of one series, with the export that each belongs to as ``owner``."""
    owner = F.expr(f"user_id + 1000000000 * (event_id div {EXPORT_EVENTS})")
    return table(spark, sf_dir, "events").where(F.col("event_type") == kind).withColumn("owner", owner)


def hrv_detail(spark: SparkSession, sf_dir: str, keys: Sequence[str] = ()) -> DataFrame:
    """5-minute HRV detail rows (FIXTURES 1.5): one per 'view' event; ``keys`` such as user_id make it many people's."""
    return _series(spark, sf_dir, DETAIL_TYPE).select(
        *keys,
        F.col("ts").alias("timestamp"),
        F.col("value").alias("rmssd"),
        ((F.col("event_id") % 100).cast("double") / F.lit(100.0)).alias("coverage"),
        (F.col("value") * F.lit(2.5)).alias("low_frequency"),
        (F.col("value") / F.lit(3.0)).alias("high_frequency"),
        F.to_date("ts").alias("file_date"),
    )


def hrv_summary(spark: SparkSession, sf_dir: str, keys: Sequence[str] = ()) -> DataFrame:
    """Daily HRV summary (one row per day of 'click' events), dated by the day it describes."""
    daily = _series(spark, sf_dir, SUMMARY_TYPE).groupBy(*keys, F.to_date("ts").alias("file_date")).agg(
        F.avg("value").alias("rmssd"), F.max("value").alias("nremhr"), (F.min("value") / F.lit(10.0)).alias("entropy"))
    return daily.select(*keys, F.col("file_date").cast("timestamp_ntz").alias("timestamp"), "rmssd", "nremhr", "entropy",
                        "file_date")


def resting_hr(spark: SparkSession, sf_dir: str, keys: Sequence[str] = ()) -> DataFrame:
    """Daily resting heart rate (file_date, timestamp, resting_hr) from 'purchase' events."""
    return _series(spark, sf_dir, RESTING_TYPE).groupBy(*keys, F.to_date("ts").alias("file_date")).agg(
        F.min("ts").alias("timestamp"), (F.lit(50.0) + F.min("value") / F.lit(10.0)).alias("resting_hr"))


def readiness(spark: SparkSession, sf_dir: str, keys: Sequence[str] = ()) -> DataFrame:
    """Daily readiness (file_date, four categories, score) from 'signup' events."""
    d = _series(spark, sf_dir, READINESS_TYPE).groupBy(*keys, F.to_date("ts").alias("file_date")).agg(
        F.avg("value").alias("m"), F.max("value").alias("hi"), F.min("value").alias("lo"))

    def cat(c):
        return F.when(c > 150, "High").when(c > 75, "Medium").otherwise("Low")

    return d.select(*keys, "file_date", cat(F.col("m")).alias("daily_readiness_cat"), cat(F.col("hi")).alias("sleep_readiness_cat"),
                    cat(F.col("lo") * 10).alias("hrv_readiness_cat"), cat(F.col("m") * 2).alias("rhr_readiness_cat"),
                    F.round("m", 0).alias("daily_readiness_score"))


# ---------------------------------------------------------------- export files as rows
# Responses and export files cannot be registered inputs, so their texts are built from the tables: the decoding
# functions that the readers call then run on text columns.

PAGE = 100  # records of one response


def participant_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response texts ({"data": {"data": [...]}}) of ``PAGE`` participants each, and one without any."""
    p = participants_raw(spark, sf_dir)
    page = (F.substring("_id", 2, 20).cast("long") / F.lit(PAGE)).cast("long")
    pages = p.groupBy(page.alias("page")).agg(F.collect_list(F.struct(*p.columns)).alias("data"))
    texts = pages.select(F.to_json(F.struct(F.struct("data").alias("data"))).alias("text"))
    return texts.unionByName(texts.sparkSession.range(1).select(F.lit('{"data": {"data": []}}').alias("text")))


def damaged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page, text): ``participant_pages`` by number, most of them damaged by a fixed rule."""
    p = participants_raw(spark, sf_dir)
    page = F.floor(F.substring("_id", 2, 20).cast("long") / F.lit(10))
    pages = p.groupBy(page.alias("page")).agg(F.to_json(F.struct(F.struct(F.sort_array(F.collect_list(F.struct("_id", "age"))).alias("data")).alias("data"))).alias("text"))
    return pages.select("page", F.expr("""CASE page % 9 WHEN 1 THEN substring(text, 1, length(text) - 3) WHEN 2 THEN concat(text, text) WHEN 3 THEN NULL
        WHEN 4 THEN '{"error": "token expired"}' WHEN 5 THEN ' ' WHEN 6 THEN '{"data": {"data": [5]}}' WHEN 7 THEN '{"data": {"data": []}}' ELSE text END""").alias("text"))


def survey_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response texts of ``PAGE`` survey records each."""
    r = surveys_raw(spark, sf_dir)
    page = (F.substring("id", 2, 20).cast("long") / F.lit(PAGE)).cast("long")
    pages = r.groupBy(page.alias("page")).agg(F.collect_list(F.struct(*r.columns)).alias("data"))
    return pages.select(F.to_json(F.struct(F.struct("data").alias("data"))).alias("text"))


# A note of the stand-in files with a comma, quotes and a line break; other columns of the wide files.
NOTE, WIDE = '"a, ""b""\nc"', 80


def _line(*fields) -> Column:
    return F.concat_ws(",", *fields)


def _file_text(df: DataFrame, by: Sequence[str], header: Column | str, line: Column, order: str) -> DataFrame:
    """One text for each ``by`` group: the header (of the group) and the group's lines (a person's day, or a person's days)."""
    head = F.lit(header) if isinstance(header, str) else header
    lines = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("line")))), lambda x: x["line"])
    return df.groupBy(*by).agg(F.array_join(lines, "\n").alias("lines")).select(*by, F.concat(head, F.lit("\n"), "lines", F.lit("\n")).alias("text"))


def hrv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(owner, path, text) of daily detail and summary files of every user.

    Columns stand in another order in every second file; some summary files exist twice (a copy), some names hold
    an impossible date or are no HRV files.
    """
    det = hrv_detail(spark, sf_dir, ["owner", "event_id"])
    iso = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    odd = (F.col("owner") + F.dayofmonth("file_date")) % 2 == 1
    rmssd, coverage, low, high = (F.col(c).cast("string") for c in ("rmssd", "coverage", "low_frequency", "high_frequency"))
    header = F.when(odd, "low_frequency,note,rmssd,high_frequency,timestamp,coverage").otherwise("timestamp,rmssd,coverage,low_frequency,high_frequency")
    line = F.when(odd, _line(low, F.lit(NOTE), rmssd, high, iso, coverage)).otherwise(_line(iso, rmssd, coverage, low, high))
    folder = F.concat(F.lit("/exports/"), F.col("owner"), F.lit("/Heart Rate Variability/"))
    details = _file_text(det, ["owner", "file_date"], header, line, "event_id").select(
        "owner", F.concat(folder, F.lit("Heart Rate Variability Details - "), F.col("file_date").cast("string"), F.lit(".csv")).alias("path"), "text")
    strays = F.when(F.col("owner") % 5 == 1, F.array(
        F.struct(F.regexp_replace("path", "[0-9]{4}-[0-9]{2}-[0-9]{2}", "2024-02-30").alias("path"), F.lit("x").alias("text")),
        F.struct(F.regexp_replace("path", "\\.csv$", " - copy.csv").alias("path"), F.lit("x").alias("text"))))
    details = details.select("owner", F.inline(F.concat(F.array(F.struct("path", "text")), F.coalesce(strays, F.array().cast("array<struct<path:string,text:string>>")))))
    summ = hrv_summary(spark, sf_dir, ["owner"])
    summ = _file_text(summ, ["owner", "file_date"], "nremhr,rmssd,entropy,timestamp",
                      _line(*[F.col(c).cast("string") for c in ("nremhr", "rmssd", "entropy", "file_date")]), "file_date")
    month, day = F.date_format("file_date", "yyyy-MM"), F.date_format("file_date", "dd")
    twice = F.when(F.col("owner") % 7 == 3, F.array(F.lit(""), F.lit("Copy of "))).otherwise(F.array(F.lit("")))
    summaries = summ.select("owner", "text", "file_date", folder.alias("folder"), F.explode(twice).alias("copy")).select(
        "owner", F.concat("folder", "copy", F.lit("Daily Heart Rate Variability Summary - "), month, F.lit("-("), day, F.lit(").csv")).alias("path"), "text")
    return details.unionByName(summaries)


def resting_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(owner, text) of every user's resting heart rate file; every third has many more columns and notes over two lines."""
    r = resting_hr(spark, sf_dir, ["owner"])
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    value = F.col("resting_hr").cast("string")
    wide = F.col("owner") % 3 == 1
    more = ",".join(f"extra {i}" for i in range(WIDE))
    header = F.when(wide, f"note,{more},beats per minute,timestamp").otherwise("data source,beats per minute,timestamp")
    line = F.when(wide, _line(F.lit(NOTE), F.lit("," * (WIDE - 1)), value, stamp)).otherwise(_line(F.lit("watch"), value, stamp))
    return _file_text(r, ["owner"], header, line, "file_date")


def readiness_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(owner, text) of every user's readiness file."""
    r = readiness(spark, sf_dir, ["owner"])
    line = _line(*[F.col(c).cast("string") for c in ("file_date", "daily_readiness_score", "rhr_readiness_cat", "daily_readiness_cat", "sleep_readiness_cat", "hrv_readiness_cat")])
    return _file_text(r, ["owner"], "timestamp,score,resting heart rate readiness,type,sleep readiness,heart rate variability readiness", line, "file_date")


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), "exports", f"{name}-{uuid.uuid4().hex}")


#: Export folders of the stand-in study; a folder without a resting heart rate file among them.
FOLDERS, EMPTY_FOLDER = 4, 2


def resting_folders(spark: SparkSession, sf_dir: str) -> str:
    """Root of export folders, one for each remainder of the user id, with all their users' resting heart rates as CSV files. Every second folder
    has its columns in another order, among others and with quoted line breaks; one has no such file."""
    root = _folder(spark, "resting")
    r = resting_hr(spark, sf_dir, ["user_id"])
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp")
    value, user = F.col("resting_hr").alias("beats per minute"), F.col("user_id").alias("user")
    note = F.concat(F.lit('says "'), F.col("user_id"), F.lit('",\n next line')).alias("note")
    for i in range(FOLDERS):
        if i == EMPTY_FOLDER:
            continue
        cols = [stamp, value, user] if i % 2 else [note, value, user, stamp, F.lit("").alias("other")]
        path = os.path.join(root, f"p{i}", "Physical Activity_GoogleData", "daily_resting_heart_rate.csv")
        r.where(F.col("user_id") % FOLDERS == i).select(*cols).write.option("header", True).option("escape", '"').csv(path)
    return root


def dictionary_folder(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the dictionary as CSV files, columns in reverse order after one of no meaning; question texts are over two lines."""
    path = _folder(spark, "dictionary")
    d = dictionary_raw(spark, sf_dir).withColumn("questiontext", F.concat("questiontext", F.lit('\n"select all", please')))
    names = [name for _, name in dictionary_fields()]
    d.select(F.lit("x").alias("note"), *names[::-1]).write.option("header", True).option("escape", '"').csv(path)
    return path
