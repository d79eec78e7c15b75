"""DuckDB SQL for every registered query: the study derivation and the operator, restated in SQL.

The SQL is written from the operator definitions (not generated from the Spark plans) so that it is an
independent check. Instants are naive UTC timestamps, as in the parquet files.
"""

from __future__ import annotations

SQL: dict[str, str] = {}

TZ = "America/New_York"
RUN_TIME = "TIMESTAMP '2024-02-01 12:00:00'"


def _instant(text: str) -> str:
    return f"timezone('UTC', try_cast({text} AS TIMESTAMPTZ))"


def _int(text: str) -> str:
    """R as.integer on text."""
    return f"try_cast(trunc(try_cast({text} AS DOUBLE)) AS INTEGER)"


def _local(ts: str, tz: str = TZ) -> str:
    return f"timezone('{tz}', timezone('UTC', {ts}))"


def _local_date(ts: str, tz: str = TZ) -> str:
    return f"CAST({_local(ts, tz)} AS DATE)"


def _refresh(ts: str, tz: str = TZ) -> str:
    local = _local(ts, tz)
    day = (f"(CASE WHEN strftime({local}, '%H:%M:%S.%f') > '05:00:00.000000' THEN CAST({local} AS DATE) "
           f"ELSE CAST({local} AS DATE) - 1 END)")
    return f"timezone('UTC', timezone('{tz}', CAST({day} AS TIMESTAMP) + INTERVAL 5 HOUR))"


PARTICIPANTS_RAW = f"""
participants_raw AS (
  SELECT
    'P' || c_custkey AS _id,
    CASE WHEN c_custkey % 101 = 100 THEN NULL
         ELSE 'AB_' || (c_custkey // 4) || '_' || (c_custkey % 4 + 1)
              || CASE WHEN c_mktsegment = 'BUILDING' THEN '_v' ELSE '' END END AS patient_id,
    'M' || c_custkey AS mdh_participant_id,
    CAST(18 + c_custkey % 60 AS DOUBLE) + CAST(c_nationkey AS DOUBLE) / 25 AS age,
    CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'invited' END AS invitationstatus,
    CASE WHEN c_custkey % 37 = 5 THEN 'not a date'
         ELSE strftime(TIMESTAMP '2023-11-01' + to_days(CAST(dayofyear(min_od) % 92 AS INTEGER))
                       + to_hours(CAST(c_custkey % 24 AS BIGINT)), '%Y-%m-%dT%H:%M:%SZ') END AS enrollmentdate,
    strftime(TIMESTAMP '2023-11-01' + to_days(CAST(dayofyear(min_od) % 92 AS INTEGER))
             + to_hours(CAST(c_custkey % 24 AS BIGINT)) - to_days(CAST(c_custkey % 30 + 1 AS INTEGER)),
             '%Y-%m-%dT%H:%M:%SZ') AS inserteddate,
    strftime(max_od + INTERVAL 12 HOUR, '%Y-%m-%dT%H:%M:%S+02:00') AS lastUpdateDate,
    CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey % 2 = 0 END AS enrolled,
    CASE c_nationkey % 3 WHEN 0 THEN 'shipped' WHEN 1 THEN 'received' ELSE 'returned' END AS active_kitstatus,
    CASE WHEN c_custkey % 2 = 0 THEN 'yes' ELSE 'no' END AS aou_complete,
    'G' || (c_nationkey % 5) AS shipment_group,
    CASE WHEN c_custkey % 13 = 0 THEN ''
         WHEN c_custkey % 13 = 6 THEN CAST(CAST(trunc(c_acctbal / 20) AS BIGINT) AS VARCHAR) || '.7'
         ELSE CAST(CAST(trunc(c_acctbal / 20) AS BIGINT) AS VARCHAR) END AS compensation_points,
    CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey % 4 AS VARCHAR) END AS compensation_tickets,
    CASE WHEN c_mktsegment = 'MACHINERY' OR c_custkey // 4 % 25 = 3 THEN 'withdrew' WHEN c_custkey % 3 = 0 THEN NULL ELSE '' END
      AS studyendreason,
    CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS has_vitiligo,
    CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 WHEN c_custkey % 19 = 0 THEN 0 ELSE NULL END
      AS has_vitiligo_post_baseline
  FROM customer
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS min_od, max(o_orderdate) AS max_od
             FROM orders GROUP BY o_custkey) o ON c_custkey = o_custkey
)"""


def _compensation_ctes(src: str, k: int = 100) -> str:
    """Sequential compensation steps over ``src`` with int columns compensation_points/_tickets."""
    return f"""
comp1 AS (SELECT * REPLACE (CASE WHEN compensation_tickets IS NULL OR compensation_tickets = 0 THEN 0
                                 ELSE compensation_tickets END AS compensation_tickets) FROM {src}),
comp2 AS (SELECT * REPLACE (CASE WHEN compensation_points > 99 AND compensation_tickets < 1
                                 THEN CAST(floor(compensation_points / {k}) AS INTEGER)
                                 ELSE compensation_tickets END AS compensation_tickets) FROM comp1),
comp3 AS (SELECT * REPLACE (CASE WHEN compensation_points > 99 AND compensation_tickets >= 1
                                 THEN compensation_points - compensation_tickets * {k}
                                 ELSE compensation_points END AS compensation_points) FROM comp2),
comp4 AS (SELECT *, CAST(compensation_points + {k} * compensation_tickets AS INTEGER) AS total_points FROM comp3)"""


SQL["compensation"] = f"""
WITH {PARTICIPANTS_RAW},
comp0 AS (SELECT _id, {_int('compensation_points')} AS compensation_points,
                 {_int('compensation_tickets')} AS compensation_tickets FROM participants_raw),
{_compensation_ctes('comp0')}
SELECT _id, compensation_points, compensation_tickets, total_points FROM comp4
"""

PEOPLE = f"""{PARTICIPANTS_RAW},
people_base AS (
  SELECT
    patient_id, mdh_participant_id,
    {_instant('lastUpdateDate')} AS last_updated_date,
    age,
    {_int("regexp_extract(patient_id, '[0-9]+')")} AS FamilyID,
    {_int("nullif(regexp_extract(patient_id, '^[^_]+_[0-9]+_([0-9]+)', 1), '')")} AS fam_pos,
    CASE WHEN regexp_matches(patient_id, '_v$') THEN 'vitiligo' ELSE 'healthy' END AS vit_status_exp,
    has_vitiligo,
    CAST(CASE WHEN has_vitiligo = 1 THEN NULL
              WHEN has_vitiligo = 0 AND has_vitiligo_post_baseline IS NULL THEN 0
              ELSE has_vitiligo_post_baseline END AS INTEGER) AS has_vitiligo_post_baseline,
    CASE WHEN enrolled THEN 'enrolled' ELSE invitationstatus END AS invitation_status,
    enrolled, active_kitstatus, aou_complete,
    {_instant('enrollmentdate')} AS enroll_date,
    {_instant('inserteddate')} AS invite_date,
    shipment_group,
    {_int('compensation_points')} AS compensation_points,
    {_int('compensation_tickets')} AS compensation_tickets,
    studyendreason
  FROM participants_raw
),
people_status AS (
  SELECT *, CAST(coalesce(has_vitiligo, 0) + coalesce(has_vitiligo_post_baseline, 0) AS INTEGER) AS vitiligo_status
  FROM people_base
),
fam AS (SELECT FamilyID, CAST(sum(vitiligo_status) AS INTEGER) AS num_affected FROM people_status GROUP BY FamilyID),
people_fam AS (
  SELECT b.*, f.num_affected FROM people_status b LEFT JOIN fam f ON b.FamilyID IS NOT DISTINCT FROM f.FamilyID
),
{_compensation_ctes('people_fam')},
people AS (
  SELECT patient_id, mdh_participant_id, last_updated_date, age, FamilyID, fam_pos, vit_status_exp,
         vitiligo_status, has_vitiligo, has_vitiligo_post_baseline,
         CASE WHEN num_affected >= 2 THEN 'multiplex' WHEN num_affected = 1 THEN 'simplex'
              WHEN num_affected = 0 THEN 'zeroplex' END AS plex,
         num_affected, invitation_status, enrolled, active_kitstatus, aou_complete, enroll_date, invite_date,
         shipment_group, compensation_points, compensation_tickets, total_points, studyendreason
  FROM comp4
),
people_active AS (SELECT * FROM people WHERE studyendreason IS NULL OR studyendreason = '')"""

SQL["people_clean"] = f"""
WITH {PEOPLE}
SELECT * REPLACE (round(age, 6) AS age) FROM people
"""


def _ndistinct(values_sql: str) -> str:
    """n_distinct with NA counted as a value, over a one-column subquery named x."""
    return (f"(SELECT count(DISTINCT x) + coalesce(max(CASE WHEN x IS NULL THEN 1 ELSE 0 END), 0) "
            f"FROM ({values_sql}))")


def _masked(col: str, cond: str, src: str) -> str:
    """R's col[cond]: TRUE keeps the value, NA gives NA, FALSE drops."""
    return f"SELECT CASE WHEN {cond} THEN {col} END AS x FROM {src} WHERE ({cond}) OR ({cond}) IS NULL"


def _setdiff(a: str, b: str) -> str:
    return f"(SELECT count(*) FROM ({a} EXCEPT {b}))"


SQL["enrollment_summary"] = f"""
WITH {PEOPLE},
c AS (
  SELECT
    {_ndistinct(_masked('patient_id', "invitation_status = 'enrolled'", 'people'))} AS pt_enrolled,
    {_ndistinct('SELECT patient_id AS x FROM people')} AS pt_invited,
    {_setdiff('SELECT patient_id AS x FROM people', 'SELECT patient_id AS x FROM people_active')} AS pt_dropped,
    {_ndistinct(_masked('FamilyID', "invitation_status = 'enrolled'", 'people'))} AS fam_enrolled,
    {_ndistinct('SELECT FamilyID AS x FROM people')} AS fam_invited,
    {_setdiff('SELECT FamilyID AS x FROM people', 'SELECT FamilyID AS x FROM people_active')} AS fam_dropped,
    {_ndistinct(_masked('patient_id', "fam_pos = 1 AND invitation_status = 'enrolled'", 'people'))}
      AS founders_enrolled,
    {_ndistinct(_masked('patient_id', 'fam_pos = 1', 'people'))} AS founders_invited,
    {_setdiff(_masked('patient_id', 'fam_pos = 1', 'people'), _masked('patient_id', 'fam_pos = 1', 'people_active'))}
      AS founders_dropped
),
r AS (SELECT {_refresh(RUN_TIME)} AS last_updated)
SELECT r.last_updated, 'individuals' AS level, CAST(pt_enrolled AS DOUBLE) AS enrolled,
       CAST(pt_invited AS DOUBLE) AS invited, CAST(pt_dropped AS DOUBLE) AS dropped,
       CAST(NULL AS DOUBLE) AS avg_enrolled_fam_size, round(pt_enrolled / nullif(pt_invited, 0), 6) AS enroll_pct
FROM c, r
UNION ALL
SELECT r.last_updated, 'families', fam_enrolled, fam_invited, fam_dropped,
       round(pt_enrolled / nullif(fam_enrolled, 0), 6), round(fam_enrolled / nullif(fam_invited, 0), 6)
FROM c, r
UNION ALL
SELECT r.last_updated, 'founders', founders_enrolled, founders_invited, founders_dropped,
       NULL, round(founders_enrolled / nullif(founders_invited, 0), 6)
FROM c, r
"""


# ---------------------------------------------------------------- responses, dictionary, scoring

# One row for each event with what its survey is, written out from the derivation (plans.study).
EVENT_SURVEYS = """
event_kind AS (
  SELECT *, CASE WHEN event_id % 17 = 3 THEN 'admin' WHEN event_id % 4 = 0 THEN 'stress' ELSE 'topic' END AS kind,
         event_id % 10 + 1 AS q, event_id % 3 + 1 AS version
  FROM events
),
topic_names(event_type, t_name, t_display, t_topic, stress_answer) AS (VALUES
  ('error', 'environment', 'Environmental Exposures', 'environmental exposures', 'Never'),
  ('click', 'health', 'General Health', 'general health', 'Almost never'),
  ('view', 'life', 'Life Changes', 'life changes', 'Sometimes'),
  ('purchase', 'skin', 'Skin Type', 'skin type', 'Fairly often'),
  ('signup', 'vitiligo', 'Vitiligo Check-in', 'vitiligo', 'Very often')
),
event_named AS (
  SELECT e.*, t.stress_answer,
         CASE kind WHEN 'admin' THEN 'admin_consent' WHEN 'stress' THEN 'Stress_PSS' ELSE t_name END AS surveyname,
         CASE kind WHEN 'admin' THEN 'Consent form' WHEN 'stress' THEN 'Perceived Stress Scale' ELSE t_display END AS display,
         CASE kind WHEN 'admin' THEN NULL WHEN 'stress' THEN 'stress' ELSE t_topic END AS topic
  FROM event_kind e LEFT JOIN topic_names t ON e.event_type = t.event_type
),
event_survey AS (
  SELECT *, surveyname || '_step' || q AS step_id,
         CASE WHEN kind = 'topic' AND event_type = 'signup' AND q = 1 THEN 'new_spots_adhoc'
              WHEN kind = 'topic' AND event_type = 'signup' AND q = 2 THEN 'new_spots_duration'
              WHEN kind = 'topic' AND event_type = 'signup' AND q = 3 THEN 'vitiligo_location1_adhoc'
              ELSE surveyname || '_q' || q END AS result_id
  FROM event_named
)"""

_ANSWERS_RAW = """
         CASE WHEN kind = 'stress' THEN CASE WHEN user_id % 29 = 0 THEN '["not sure"]' ELSE '["' || stress_answer || '"]' END
              WHEN event_id % 53 = 5 THEN '["' || repeat('Long text ', 150) || '","b"]'
              WHEN event_id % 53 = 6 THEN '["Line 1' || chr(10) || 'line 2","c"]'
              WHEN event_type = 'error' THEN '["Exposure ' || (user_id % 5) || '"]'
              WHEN event_type = 'click' THEN CASE WHEN value > 100 THEN '["True"]' ELSE '["false"]' END
              WHEN event_type = 'view' THEN '["opt' || (event_id % 3) || '","opt' || (user_id % 4) || '"]'
              WHEN event_type = 'purchase' THEN '[' || CAST(floor(value) AS INTEGER) || ']'
              WHEN event_id % 2 = 0 THEN NULL
              ELSE '["Spot ' || (event_id % 9) || '", "arm"]' END"""

_ISO_US = "'%Y-%m-%dT%H:%M:%S.%fZ'"


def _surveys_raw() -> str:
    return f"""{EVENT_SURVEYS.lstrip()},
surveys_raw AS (
  SELECT 'R' || event_id AS id,
         CASE WHEN event_id % 23 = 0 THEN NULL ELSE 'M' || user_id END AS participantid,
         'S' || (event_id % 7) AS surveyid, 'D' || (user_id % 10) AS DID,
         CASE WHEN event_id % 41 = 7 THEN 'n/a' ELSE strftime(ts, {_ISO_US}) END AS date,
         strftime(ts, {_ISO_US}) AS inserteddate, strftime(ts, {_ISO_US}) AS creationDate,
         strftime(ts + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%SZ') AS lastUpdateDate,
         surveyname, CAST(version AS VARCHAR) AS surveyversion, display AS surveydisplayname,
         step_id AS stepidentifier, result_id AS resultidentifier, {_ANSWERS_RAW} AS answers
  FROM event_survey
)"""


# Expects EVENT_SURVEYS before it.
DICT_CLEAN = """
dictionary_rows AS (
  SELECT surveyname, CAST(version AS VARCHAR) AS surveyversion, step_id AS stepidentifier, result_id AS resultidentifier,
         CASE WHEN kind = 'stress' THEN CASE WHEN version = 1 THEN 'BL' ELSE 'QT' END
              ELSE CASE WHEN version = 3 THEN 'QT' ELSE 'BL' END END AS survey_type,
         topic AS survey_topic, 'Step ' || q AS step_readable,
         CASE result_id
           WHEN 'new_spots_adhoc' THEN 'Have you noticed any new white spots on your skin that you think can be vitiligo or improvement (repigmentation) of your vitiligo?'
           WHEN 'new_spots_duration' THEN 'How long ago did you notice your new white spots?'
           WHEN 'vitiligo_location1_adhoc' THEN 'Where is your vitiligo located? Please include the new spot you''re currently reporting.' || chr(10) || chr(10) || '*Select all that apply*'
           ELSE CASE WHEN kind = 'stress' THEN q || '. In the last month, how often did item ' || q || ' happen?'
                     ELSE 'Question ' || q || ' about ' || topic END END AS question_standardized,
         CASE WHEN kind = 'stress' THEN 'never, almost never, sometimes, fairly often, very often' ELSE 'free text' END AS possible_answers,
         event_id
  FROM event_survey WHERE kind <> 'admin'
),
dict_clean AS (
  SELECT surveyname, surveyversion, stepidentifier, resultidentifier, survey_type, survey_topic, step_readable,
         question_standardized, possible_answers, min(event_id) AS row_order
  FROM dictionary_rows
  GROUP BY surveyname, surveyversion, stepidentifier, resultidentifier, survey_type, survey_topic, step_readable,
           question_standardized, possible_answers
)"""


def _answers_list(pattern_kind: str) -> str:
    if pattern_kind == "first":
        found = "nullif(regexp_extract(answers, '\"(.*?)\"', 0), '')"
    else:
        found = "nullif(regexp_extract(answers, '\"(.+)\"', 1, 's'), '')"
    return f"string_split(lower({found}), '\",\"')"


PEOPLE_COLUMNS_SQL = ("last_updated_date, age, FamilyID, fam_pos, vit_status_exp, vitiligo_status, has_vitiligo, "
                      "has_vitiligo_post_baseline, plex, num_affected, invitation_status, enrolled, active_kitstatus, "
                      "aou_complete, enroll_date, invite_date, shipment_group, compensation_points, "
                      "compensation_tickets, total_points, studyendreason")


def _responses(pattern_kind: str = "first") -> str:
    return f"""{PEOPLE},
{_surveys_raw()},
resp_join AS (
  SELECT s.*, p.patient_id, {', '.join('p.' + c.strip() for c in PEOPLE_COLUMNS_SQL.split(','))}
  FROM surveys_raw s JOIN people_active p ON s.participantid IS NOT DISTINCT FROM p.mdh_participant_id
  WHERE p.patient_id IS NOT NULL
),
resp AS (
  SELECT patient_id, {_instant('date')} AS recorded_dttm, {_local_date(_instant('date'))} AS recorded_date,
         id AS response_id, surveyname, surveyversion, surveydisplayname, stepidentifier, resultidentifier,
         UNNEST(coalesce({_answers_list(pattern_kind)}, [NULL])) AS answers,
         {PEOPLE_COLUMNS_SQL}
  FROM resp_join
)"""


SQL["responses_clean"] = f"""
WITH {_responses('first')}
SELECT * REPLACE (round(age, 6) AS age) FROM resp
"""

SQL["responses_all_answers"] = f"""
WITH {_responses('all')}
SELECT * REPLACE (round(age, 6) AS age) FROM resp
"""

SQL["dictionary_versions"] = f"""
WITH {EVENT_SURVEYS.lstrip()},
{DICT_CLEAN}
SELECT survey_topic, survey_type, surveyversion, count(*) AS total_questions
FROM dict_clean GROUP BY survey_topic, survey_type, surveyversion
"""

SQL["dictionary_overview"] = f"""
WITH {EVENT_SURVEYS.lstrip()},
{DICT_CLEAN},
per_version AS (
  SELECT survey_topic, survey_type, surveyversion, count(*) AS n, min(row_order) AS first_seen
  FROM dict_clean GROUP BY survey_topic, survey_type, surveyversion
)
SELECT survey_topic, survey_type, CAST(sum(n) AS BIGINT) AS total_questions,
       string_agg(coalesce(surveyversion, 'NA'), ', ' ORDER BY first_seen) AS versions
FROM per_version GROUP BY survey_topic, survey_type
"""

_CLEAN = ("CASE WHEN regexp_replace(answers, '^\"|\"$', '', 'g') = 'true' THEN 'Yes' "
          "WHEN regexp_replace(answers, '^\"|\"$', '', 'g') = 'false' THEN 'No' "
          "ELSE regexp_replace(answers, '^\"|\"$', '', 'g') END")
_KEYS_ON = " AND ".join(f"r.{k} IS NOT DISTINCT FROM d.{k}"
                        for k in ("surveyname", "surveyversion", "stepidentifier", "resultidentifier"))

ENRICHED = f"""{_responses('first')},
{DICT_CLEAN},
enr AS (
  SELECT r.patient_id, r.FamilyID, r.age, r.vitiligo_status, r.total_points AS raffle_points, r.recorded_date,
         r.enroll_date, d.survey_topic, r.surveydisplayname AS survey_display_name, r.surveyversion, d.survey_type,
         d.question_standardized, {_CLEAN.replace('answers', 'r.answers')} AS answer_clean, d.possible_answers
  FROM resp r JOIN dict_clean d ON {_KEYS_ON}
  WHERE NOT regexp_matches(r.surveydisplayname, '(S|s)tress') AND d.survey_topic IS NOT NULL
),
st_join AS (
  SELECT r.*, d.survey_topic, d.question_standardized, d.possible_answers
  FROM resp r LEFT JOIN (SELECT * FROM dict_clean WHERE survey_type = 'QT' AND regexp_matches(surveyname, '(S|s)tress')) d
    ON {_KEYS_ON}
  WHERE regexp_matches(r.surveydisplayname, '(S|s)tress')
),
st_first AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY patient_id, recorded_date, question_standardized
                                 ORDER BY recorded_dttm ASC NULLS LAST, response_id, answers ASC NULLS LAST) AS rn
    FROM st_join) WHERE rn = 1
),
st_scored AS (
  SELECT *,
         date_diff('day', {_local_date('enroll_date')}, {_local_date('recorded_dttm')}) / 30.4375 AS months,
         CASE {_CLEAN} WHEN 'never' THEN 0 WHEN 'almost never' THEN 1 WHEN 'sometimes' THEN 2
                       WHEN 'fairly often' THEN 3 WHEN 'very often' THEN 4 END AS score
  FROM st_first
),
st AS (
  SELECT patient_id, FamilyID, age, vitiligo_status, total_points AS raffle_points, recorded_date, enroll_date,
         survey_topic, surveydisplayname AS survey_display_name, surveyversion,
         CASE WHEN months < 2.9 THEN 'BL' WHEN months >= 2.9 THEN 'QT' END AS survey_type,
         question_standardized,
         CAST(CASE WHEN coalesce(regexp_extract(question_standardized, '^[0-9]+') IN ('4', '5', '7', '8'), false)
                   THEN 4 - score ELSE score END AS VARCHAR) AS answer_clean,
         '0, 1, 2, 3, 4' AS possible_answers
  FROM st_scored WHERE survey_topic IS NOT NULL
),
long AS (SELECT * FROM enr UNION ALL SELECT * FROM st)"""

SQL["enriched"] = f"""
WITH {ENRICHED}
SELECT * REPLACE (round(age, 6) AS age) FROM enr
"""

SQL["stress_items"] = f"""
WITH {ENRICHED}
SELECT * REPLACE (round(age, 6) AS age) FROM st
"""

SQL["enriched_all"] = f"""
WITH {ENRICHED}
SELECT * REPLACE (round(age, 6) AS age) FROM long
"""

SQL["topic_slice"] = f"""
WITH {ENRICHED}
SELECT patient_id, FamilyID, round(age, 6) AS age, vitiligo_status, raffle_points, recorded_date, enroll_date,
       surveyversion, survey_type, question_standardized, answer_clean
FROM long WHERE survey_topic = 'general health'
"""

SQL["stress_totals"] = f"""
WITH {ENRICHED}
SELECT patient_id, FamilyID, recorded_date, enroll_date, survey_type,
       CAST(coalesce(sum(try_cast(trunc(try_cast(answer_clean AS DOUBLE)) AS INTEGER)), 0) AS INTEGER) AS stress_score
FROM long WHERE survey_topic = 'stress'
GROUP BY patient_id, FamilyID, recorded_date, enroll_date, survey_type
"""


# ---------------------------------------------------------------- wearable series

SERIES = """
hrv_detail AS (
  SELECT ts AS timestamp, value AS rmssd, CAST(event_id % 100 AS DOUBLE) / 100.0 AS coverage,
         value * 2.5 AS low_frequency, value / 3.0 AS high_frequency, CAST(ts AS DATE) AS file_date
  FROM events WHERE event_type = 'view'
),
hrv_summary AS (
  SELECT CAST(d AS TIMESTAMP) AS timestamp, avg(value) AS rmssd, max(value) AS nremhr, min(value) / 10.0 AS entropy,
         d AS file_date
  FROM (SELECT CAST(ts AS DATE) AS d, value FROM events WHERE event_type = 'click') GROUP BY d
),
hrv_daily AS (
  SELECT d.file_date, d.timestamp AS timestamp_detail, d.rmssd AS rmssd_detail, d.coverage, d.low_frequency,
         d.high_frequency, s.timestamp AS timestamp_summary, s.rmssd AS rmssd_summary, s.nremhr, s.entropy
  FROM hrv_detail d LEFT JOIN hrv_summary s ON d.file_date = s.file_date + 1
),
resting AS (
  SELECT CAST(ts AS DATE) AS file_date, min(ts) AS timestamp, 50.0 + min(value) / 10.0 AS resting_hr
  FROM events WHERE event_type = 'purchase' GROUP BY CAST(ts AS DATE)
),
ready_raw AS (
  SELECT CAST(ts AS DATE) AS file_date, avg(value) AS m, max(value) AS hi, min(value) AS lo
  FROM events WHERE event_type = 'signup' GROUP BY CAST(ts AS DATE)
),
readiness AS (
  SELECT file_date,
         CASE WHEN m > 150 THEN 'High' WHEN m > 75 THEN 'Medium' ELSE 'Low' END AS daily_readiness_cat,
         CASE WHEN hi > 150 THEN 'High' WHEN hi > 75 THEN 'Medium' ELSE 'Low' END AS sleep_readiness_cat,
         CASE WHEN lo * 10 > 150 THEN 'High' WHEN lo * 10 > 75 THEN 'Medium' ELSE 'Low' END AS hrv_readiness_cat,
         CASE WHEN m * 2 > 150 THEN 'High' WHEN m * 2 > 75 THEN 'Medium' ELSE 'Low' END AS rhr_readiness_cat,
         round(m, 0) AS daily_readiness_score
  FROM ready_raw
),
day_hrv AS (SELECT DISTINCT * FROM hrv_daily),
day_rest AS (SELECT DISTINCT file_date, resting_hr FROM resting),
day_ready AS (SELECT DISTINCT * FROM readiness),
combined_day AS (
  SELECT * FROM day_hrv FULL JOIN day_rest USING (file_date) FULL JOIN day_ready USING (file_date)
)"""

_HRV_COLS = ("timestamp_detail", "rmssd_detail", "coverage", "low_frequency", "high_frequency", "timestamp_summary",
             "rmssd_summary", "nremhr", "entropy")


def _round_cols(cols, digits=6):
    return ", ".join(f"round({c}, {digits}) AS {c}" if c not in ("timestamp_detail", "timestamp_summary", "file_date")
                     else c for c in cols)


SQL["hrv_daily"] = f"""
WITH {SERIES.lstrip()}
SELECT file_date, {_round_cols(_HRV_COLS)} FROM hrv_daily
"""

SQL["daily_vs_summary"] = f"""
WITH {SERIES.lstrip()}
SELECT file_date, round(avg(rmssd_detail), 6) AS mean_rmssd_detail, round(max(rmssd_summary), 6) AS rmssd_summary
FROM hrv_daily GROUP BY file_date
"""

_READY_COLS = ("daily_readiness_cat", "sleep_readiness_cat", "hrv_readiness_cat", "rhr_readiness_cat")

SQL["combine_day"] = f"""
WITH {SERIES.lstrip()}
SELECT file_date, {_round_cols(_HRV_COLS)}, round(resting_hr, 6) AS resting_hr, {', '.join(_READY_COLS)},
       round(daily_readiness_score, 6) AS daily_readiness_score
FROM combined_day
"""

SQL["combine_inner"] = f"""
WITH {SERIES.lstrip()}
SELECT file_date, {_round_cols(_HRV_COLS)}, round(resting_hr, 6) AS resting_hr
FROM day_hrv JOIN day_rest USING (file_date)
"""

SQL["combine_left"] = f"""
WITH {SERIES.lstrip()}
SELECT file_date, round(resting_hr, 6) AS resting_hr, {_round_cols(_HRV_COLS)}
FROM day_rest LEFT JOIN day_hrv USING (file_date)
"""

_HRV_NUM = ("rmssd_detail", "coverage", "low_frequency", "high_frequency", "rmssd_summary", "nremhr", "entropy")
_DET_NUM = ("rmssd", "coverage", "low_frequency", "high_frequency")


def _avgs(cols):
    return ", ".join(f"avg({c}) AS {c}" for c in cols)


SQL["combine_month"] = f"""
WITH {SERIES.lstrip()},
m_hrv AS (SELECT CAST(date_trunc('month', file_date) AS DATE) AS year_month, {_avgs(_HRV_NUM)} FROM hrv_daily GROUP BY 1),
m_rest AS (SELECT CAST(date_trunc('month', file_date) AS DATE) AS year_month, avg(resting_hr) AS resting_hr
           FROM resting GROUP BY 1)
SELECT year_month, {_round_cols(_HRV_NUM)}, round(resting_hr, 6) AS resting_hr
FROM m_hrv FULL JOIN m_rest USING (year_month)
"""

for _unit in ("hour", "minute"):
    SQL[f"combine_{_unit}"] = f"""
WITH {SERIES.lstrip()},
b_det AS (SELECT date_trunc('{_unit}', timestamp) AS datetime_{_unit}, {_avgs(_DET_NUM)} FROM hrv_detail GROUP BY 1),
b_rest AS (SELECT date_trunc('{_unit}', timestamp) AS datetime_{_unit}, avg(resting_hr) AS resting_hr
           FROM resting GROUP BY 1)
SELECT datetime_{_unit}, {_round_cols(_DET_NUM)}, round(resting_hr, 6) AS resting_hr
FROM b_det FULL JOIN b_rest USING (datetime_{_unit})
"""

SQL["scaled_pair"] = f"""
WITH {SERIES.lstrip()},
daily AS (SELECT file_date, avg(rmssd_detail) AS var1, avg(resting_hr) AS var2 FROM combined_day GROUP BY file_date),
st AS (SELECT min(var1) AS min1, max(var1) AS max1, min(var2) AS min2, max(var2) AS max2, avg(var1) AS mean1,
              avg(var2) AS mean2 FROM daily),
j AS (SELECT *, (max1 - min1) / nullif(max2 - min2, 0) AS k FROM daily, st)
SELECT file_date, round(var1, 6) AS Value, 'HRV (RMSSD)' AS Measure, round(mean1, 6) AS mean_value,
       file_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-13' AS highlight FROM j
UNION ALL
SELECT file_date, round((var2 - min2) * k + min1, 6), 'Resting HR (bpm)', round((mean2 - min2) * k + min1, 6),
       file_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-13' FROM j
"""


# ---------------------------------------------------------------- statistics

def _normal_p(z: str) -> str:
    """P(|Z| >= |z|): one minus erf(|z| / sqrt 2) by its series of x^(2n+1) / gamma(n + 3/2); good to 1e-14 absolutely."""
    x = f"(abs({z}) / sqrt(2.0))"
    series = f"list_sum([exp((2 * n + 1) * ln({x}) - {x} * {x} - lgamma(n + 1.5)) FOR n IN range(0, 400)])"
    return f"(CASE WHEN {z} = 0 THEN 1.0 WHEN {x} > 9 THEN 0.0 ELSE greatest(1.0 - {series}, 0.0) END)"


def _ks_p(z: str) -> str:
    series = (f"list_sum([CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * k * k * ({z}) * ({z})) "
              f"FOR k IN range(1, 101)])")
    return f"(CASE WHEN {z} IS NULL THEN NULL WHEN {z} < 0.2 THEN 1.0 ELSE least(greatest(2.0 * {series}, 0.0), 1.0) END)"


def _fixed(x: str, d: int) -> str:
    scale = float(10 ** d)
    return f"printf('%.{d}f', sign({x}) * floor(abs({x}) * {scale} + 0.5) / {scale})"


def _p_text(p: str) -> str:
    return f"(CASE WHEN {p} < 0.001 THEN 'p < 0.001' ELSE 'p = ' || {_fixed(p, 3)} END)"


def _stars(p: str) -> str:
    return (f"(CASE WHEN {p} < 0.001 THEN '***' WHEN {p} < 0.01 THEN '**' WHEN {p} < 0.05 THEN '*' "
            f"WHEN {p} < 0.1 THEN '†' ELSE 'ns' END)")


def _signed(x: str) -> str:
    return f"((CASE WHEN {x} >= 0 THEN '+' ELSE '' END) || {_fixed(x, 1)})"


def _two_sample(long_cte: str, g: str, a: str, b: str) -> str:
    """CTEs computing the two-sample table from ``long_cte(grp, {g}, value)``; result CTE ``ts``."""
    return f"""
rows_t AS (SELECT {g}, count(*) FILTER (WHERE grp = {a}) AS rows_a, count(*) FILTER (WHERE grp = {b}) AS rows_b,
                  max(value) FILTER (WHERE value IS NOT NULL AND NOT isnan(value)) AS max_val
           FROM {long_cte} GROUP BY {g}),
vals AS (SELECT {g}, grp, value FROM {long_cte} WHERE value IS NOT NULL AND NOT isnan(value)),
sizes AS (SELECT {g}, count(*) FILTER (WHERE grp = {a}) AS n_a, count(*) FILTER (WHERE grp = {b}) AS n_b,
                 avg(value) FILTER (WHERE grp = {a}) AS mean_a, avg(value) FILTER (WHERE grp = {b}) AS mean_b,
                 quantile_cont(value, 0.5) FILTER (WHERE grp = {a}) AS median_a,
                 quantile_cont(value, 0.5) FILTER (WHERE grp = {b}) AS median_b
          FROM vals GROUP BY {g}),
cnt AS (SELECT {g}, value AS v, count(*) FILTER (WHERE grp = {a}) AS c_a, count(*) FILTER (WHERE grp = {b}) AS c_b
        FROM vals GROUP BY {g}, value),
cum AS (SELECT *, sum(c_a) OVER w AS cum_a, sum(c_b) OVER w AS cum_b FROM cnt
        WINDOW w AS (PARTITION BY {g} ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
agg AS (SELECT c.{g}, max(abs(cum_a / s.n_a - cum_b / s.n_b)) AS ks_statistic,
               CAST(sum(c_a * ((cum_a + cum_b - c_a - c_b) + (c_a + c_b + 1) / 2.0)) AS DOUBLE) AS rank_sum_a,
               CAST(sum(power(CAST(c_a + c_b AS DOUBLE), 3) - CAST(c_a + c_b AS DOUBLE)) AS DOUBLE) AS ties
        FROM cum c JOIN sizes s ON c.{g} = s.{g} GROUP BY c.{g}),
w1 AS (SELECT s.*, a.ks_statistic, a.rank_sum_a, a.ties,
              CAST(s.n_a AS DOUBLE) AS na, CAST(s.n_b AS DOUBLE) AS nb
       FROM sizes s JOIN agg a ON s.{g} = a.{g}),
w2 AS (SELECT *, rank_sum_a - na * (na + 1) / 2 AS wilcox_statistic,
              sqrt(na * nb / 12 * ((na + nb + 1) - ties / ((na + nb) * (na + nb - 1)))) AS sigma,
              sqrt(na * nb / (na + nb)) * ks_statistic AS ks_z
       FROM w1),
w3 AS (SELECT *, (wilcox_statistic - na * nb / 2 - sign(wilcox_statistic - na * nb / 2) * 0.5) / sigma AS wz FROM w2),
ts AS (SELECT r.{g}, r.rows_a, r.rows_b, w.n_a, w.n_b, w.mean_a, w.mean_b, w.median_a, w.median_b, w.ks_statistic,
              {_ks_p('w.ks_z')} AS ks_p, w.wilcox_statistic,
              CASE WHEN w.sigma > 0 THEN {_normal_p('w.wz')} END AS wilcox_p,
              r.max_val
       FROM rows_t r LEFT JOIN w3 w ON r.{g} = w.{g})"""


def _exact_p(g: str) -> str:
    """CTE ``te``: ``ts`` of small samples with exact p-values, by counting ranks dealt one by one (rank sum, if no values tie) and lattice
    paths that stay inside the statistic's bound, step by step (KS)."""
    return f"""
small AS (SELECT {g}, n_a, n_b, wilcox_statistic AS w, floor(ks_statistic * n_a * n_b - 1e-7) + 1 AS bound FROM ts WHERE n_a * n_b < 10000),
ends AS (SELECT {g}, cum_a + cum_b AS k, max(c_a + c_b) OVER (PARTITION BY {g}) AS most FROM cum),
dealt AS (
  SELECT {g}, 0 AS r, 0 AS j, 0 AS s, 1.0::DOUBLE AS ways FROM small
  UNION ALL
  SELECT {g}, r, j, s, sum(ways) FROM (
    SELECT d.{g}, r + 1 AS r, j + take AS j, s + CASE WHEN take = 1 THEN r - j ELSE 0 END AS s, ways
    FROM dealt d JOIN small m ON d.{g} = m.{g}, (VALUES (0), (1)) AS t(take) WHERE r < n_a + n_b AND j + take <= n_a AND r + 1 - j - take <= n_b)
  GROUP BY {g}, r, j, s
),
path AS (
  SELECT {g}, 0 AS i, 0 AS j, 1.0::DOUBLE AS ways FROM small
  UNION ALL
  SELECT {g}, i, j, sum(ways) FROM (
    SELECT p.{g}, i + di AS i, j + 1 - di AS j, ways, n_a, n_b, bound
    FROM path p JOIN small m ON p.{g} = m.{g}, (VALUES (0), (1)) AS t(di) WHERE i + di <= n_a AND j + 1 - di <= n_b) q
  WHERE abs(i * n_b - j * n_a) < bound OR NOT EXISTS (SELECT 1 FROM ends e WHERE e.{g} = q.{g} AND e.k = i + j)
  GROUP BY {g}, i, j
),
ranked AS (SELECT d.{g}, sum(ways) FILTER (s <= least(w, n_a * n_b - w)) AS low, sum(ways) AS ways
           FROM dealt d JOIN small m ON d.{g} = m.{g} AND d.r = n_a + n_b GROUP BY d.{g}),
stayed AS (SELECT p.{g}, ways FROM path p JOIN small m ON p.{g} = m.{g} AND i = n_a AND j = n_b),
te AS (SELECT ts.* REPLACE (
         CASE WHEN r.ways IS NULL THEN ks_p ELSE 1 - coalesce(s.ways, 0) / r.ways END AS ks_p,
         CASE WHEN r.ways IS NULL OR most > 1 THEN wilcox_p ELSE least(1, 2 * low / r.ways) END AS wilcox_p)
       FROM ts LEFT JOIN ranked r ON ts.{g} = r.{g} LEFT JOIN stayed s ON ts.{g} = s.{g}
       LEFT JOIN (SELECT DISTINCT {g}, most FROM ends) m ON ts.{g} = m.{g})"""


_TS_COLS = ("rows_a", "rows_b", "n_a", "n_b", "mean_a", "mean_b", "median_a", "median_b", "ks_statistic", "ks_p",
            "wilcox_statistic", "wilcox_p", "max_val")


def _ts_select(g: str) -> str:
    return ", ".join([g] + [f"round({c}, 6) AS {c}" if c not in ("rows_a", "rows_b", "n_a", "n_b") else c
                            for c in _TS_COLS])


SQL["year_compare"] = f"""
WITH li AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS grp, l_quantity, l_extendedprice, l_discount FROM lineitem
            WHERE year(l_shipdate) IN (1997, 1998)),
long AS (SELECT grp, 'l_quantity' AS metric, CAST(l_quantity AS DOUBLE) AS value FROM li
         UNION ALL SELECT grp, 'l_extendedprice', CAST(l_extendedprice AS DOUBLE) FROM li
         UNION ALL SELECT grp, 'l_discount', CAST(l_discount AS DOUBLE) FROM li),
{_two_sample('long', 'metric', '1997', '1998')},
fin AS (SELECT *, mean_b - mean_a AS mean_diff, median_b - median_a AS median_diff FROM ts)
SELECT {_ts_select('metric')}, round(mean_diff, 6) AS mean_diff, round(median_diff, 6) AS median_diff,
       {_p_text('ks_p')} AS ks_p_formatted, {_p_text('wilcox_p')} AS wilcox_p_formatted,
       {_stars('ks_p')} AS ks_significance, {_stars('wilcox_p')} AS wilcox_significance,
       'Diff Median: ' || {_signed('median_diff')} || ' | Diff Mean: ' || {_signed('mean_diff')} || chr(10)
         || 'KS: ' || {_p_text('ks_p')} || ' ' || {_stars('ks_p')} || ' | '
         || 'Wilcoxon: ' || {_p_text('wilcox_p')} || ' ' || {_stars('wilcox_p')} AS annotation_text,
       round(max_val * 1.05, 6) AS y_pos, 1.5 AS x_pos
FROM fin
"""

SQL["two_sample_events"] = f"""
WITH RECURSIVE long AS (SELECT CASE WHEN day(ts) <= 15 THEN 'early' ELSE 'late' END AS grp, event_type,
                     CAST(value AS DOUBLE) AS value FROM events),
{_two_sample('long', 'event_type', "'early'", "'late'")},{_exact_p('event_type')}
SELECT {_ts_select('event_type')} FROM te
"""

SQL["box_numbers"] = """
WITH v AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(l_extendedprice AS DOUBLE) AS value FROM lineitem
           WHERE l_extendedprice IS NOT NULL AND NOT isnan(l_extendedprice)),
q AS (SELECT year, count(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM v GROUP BY year)
SELECT year, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)), 6)
         AS lower_whisker,
       round(max(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)), 6)
         AS upper_whisker,
       count(*) FILTER (WHERE NOT (value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1))) AS n_outliers
FROM v JOIN q USING (year) GROUP BY year, n, q1, median, q3
"""

SQL["last_refresh"] = f"""
SELECT event_id, ts, {_refresh('ts')} AS last_updated,
       'Last updated: ' || strftime({_local(_refresh('ts'))}, '%Y-%m-%d') || ' '
         || strftime({_local(_refresh('ts'))}, '%H:%M:%S') || ' {TZ}' AS last_updated_text
FROM events
"""


# ---------------------------------------------------------------- overviews and set differences

SQL["responses_last_updated"] = f"""
WITH {_responses('first')},
m AS (SELECT max(recorded_dttm) AS last_updated FROM resp)
SELECT last_updated, 'Last updated: ' || strftime({_local('last_updated')}, '%Y-%m-%d %H:%M:%S') || ' {TZ}'
       AS last_updated_text
FROM m
"""

SQL["enriched_overview"] = f"""
WITH {ENRICHED},
numbered AS (SELECT survey_topic, row_number() OVER (ORDER BY patient_id ASC NULLS LAST, recorded_date ASC NULLS LAST,
                                                   survey_topic ASC NULLS LAST) AS rn FROM long),
per_topic AS (SELECT survey_topic, count(*) AS n, min(rn) AS first_rn FROM numbered GROUP BY survey_topic)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, 14 AS n_cols, string_agg(survey_topic, ', ' ORDER BY first_rn) AS topics
FROM per_topic
"""

SQL["dropped_families"] = f"""
WITH {PEOPLE}
SELECT FamilyID FROM people EXCEPT SELECT FamilyID FROM people_active
"""

SQL["dropped_founders"] = f"""
WITH {PEOPLE}
{_masked('patient_id', 'fam_pos = 1', 'people').replace(' AS x', ' AS patient_id')}
EXCEPT
{_masked('patient_id', 'fam_pos = 1', 'people_active').replace(' AS x', ' AS patient_id')}
"""

SQL["first_per_day"] = f"""
WITH {_responses('first')}
SELECT patient_id, recorded_date, surveyname, recorded_dttm, response_id, answers FROM (
  SELECT *, row_number() OVER (PARTITION BY patient_id, recorded_date, surveyname
                               ORDER BY recorded_dttm ASC NULLS LAST, response_id, answers ASC NULLS LAST) AS rn
  FROM resp) WHERE rn = 1
"""


# ---------------------------------------------------------------- topics, days since enrollment

SQL["topic_slices"] = f"""
WITH {ENRICHED}
SELECT survey_topic, patient_id, FamilyID, round(age, 6) AS age, vitiligo_status, raffle_points, recorded_date, enroll_date,
       surveyversion, survey_type, question_standardized, answer_clean
FROM long WHERE survey_topic IN ('environmental exposures', 'general health', 'life changes', 'skin type', 'vitiligo', 'stress')
"""

# recorded_date is the local date of the response
SQL["enriched_days"] = f"""
WITH {ENRICHED}
SELECT * REPLACE (round(age, 6) AS age),
       CAST(date_diff('day', {_local_date('enroll_date')}, recorded_date) AS INTEGER) AS days_since_enrollment
FROM long
"""


# ---------------------------------------------------------------- series of many people

PERSON_SERIES = """
p_detail AS (
  SELECT user_id, ts AS timestamp, value AS rmssd, CAST(event_id % 100 AS DOUBLE) / 100.0 AS coverage,
         value * 2.5 AS low_frequency, value / 3.0 AS high_frequency, CAST(ts AS DATE) AS file_date, event_id
  FROM events WHERE event_type = 'view'
),
p_summary AS (
  SELECT user_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS timestamp, avg(value) AS rmssd, max(value) AS nremhr,
         min(value) / 10.0 AS entropy, CAST(ts AS DATE) AS file_date
  FROM events WHERE event_type = 'click' GROUP BY user_id, CAST(ts AS DATE)
),
p_daily AS (
  SELECT d.user_id, d.file_date, d.timestamp AS timestamp_detail, d.rmssd AS rmssd_detail, d.coverage, d.low_frequency,
         d.high_frequency, s.timestamp AS timestamp_summary, s.rmssd AS rmssd_summary, s.nremhr, s.entropy
  FROM p_detail d LEFT JOIN p_summary s ON d.user_id = s.user_id AND d.file_date = s.file_date + 1
),
p_resting AS (
  SELECT user_id, CAST(ts AS DATE) AS file_date, min(ts) AS timestamp, 50.0 + min(value) / 10.0 AS resting_hr
  FROM events WHERE event_type = 'purchase' GROUP BY user_id, CAST(ts AS DATE)
),
p_ready_raw AS (
  SELECT user_id, CAST(ts AS DATE) AS file_date, avg(value) AS m, max(value) AS hi, min(value) AS lo
  FROM events WHERE event_type = 'signup' GROUP BY user_id, CAST(ts AS DATE)
),
p_readiness AS (
  SELECT user_id, file_date,
         CASE WHEN m > 150 THEN 'High' WHEN m > 75 THEN 'Medium' ELSE 'Low' END AS daily_readiness_cat,
         CASE WHEN hi > 150 THEN 'High' WHEN hi > 75 THEN 'Medium' ELSE 'Low' END AS sleep_readiness_cat,
         CASE WHEN lo * 10 > 150 THEN 'High' WHEN lo * 10 > 75 THEN 'Medium' ELSE 'Low' END AS hrv_readiness_cat,
         CASE WHEN m * 2 > 150 THEN 'High' WHEN m * 2 > 75 THEN 'Medium' ELSE 'Low' END AS rhr_readiness_cat,
         round(m, 0) AS daily_readiness_score
  FROM p_ready_raw
),
p_combined AS (
  SELECT * FROM (SELECT DISTINCT * FROM p_daily)
  FULL JOIN (SELECT user_id, file_date, resting_hr FROM p_resting) USING (user_id, file_date)
  FULL JOIN p_readiness USING (user_id, file_date)
)"""

SQL["combine_hour_buckets"] = f"""
WITH {SERIES.lstrip()},
b_det AS (SELECT DISTINCT date_trunc('hour', timestamp) AS datetime_hour FROM hrv_detail),
b_rest AS (SELECT date_trunc('hour', timestamp) AS datetime_hour, avg(resting_hr) AS resting_hr FROM resting GROUP BY 1)
SELECT datetime_hour, round(resting_hr, 6) AS resting_hr FROM b_det FULL JOIN b_rest USING (datetime_hour)
"""

SQL["hrv_daily_by_person"] = f"""
WITH {PERSON_SERIES.lstrip()}
SELECT user_id, file_date, {_round_cols(_HRV_COLS)} FROM p_daily
"""

SQL["daily_vs_summary_by_person"] = f"""
WITH {PERSON_SERIES.lstrip()}
SELECT user_id, file_date, round(avg(rmssd_detail), 6) AS mean_rmssd_detail, round(max(rmssd_summary), 6) AS rmssd_summary
FROM p_daily GROUP BY user_id, file_date
"""

SQL["combine_day_by_person"] = f"""
WITH {PERSON_SERIES.lstrip()}
SELECT user_id, file_date, {_round_cols(_HRV_COLS)}, round(resting_hr, 6) AS resting_hr, {', '.join(_READY_COLS)},
       round(daily_readiness_score, 6) AS daily_readiness_score
FROM p_combined
"""

SQL["combine_hour_by_person"] = f"""
WITH {PERSON_SERIES.lstrip()},
b_det AS (SELECT user_id, date_trunc('hour', timestamp) AS datetime_hour, {_avgs(_DET_NUM)} FROM p_detail GROUP BY 1, 2),
b_rest AS (SELECT user_id, date_trunc('hour', timestamp) AS datetime_hour, avg(resting_hr) AS resting_hr
           FROM p_resting GROUP BY 1, 2)
SELECT user_id, datetime_hour, {_round_cols(_DET_NUM)}, round(resting_hr, 6) AS resting_hr
FROM b_det FULL JOIN b_rest USING (user_id, datetime_hour)
"""

SQL["scaled_pair_by_person"] = f"""
WITH {PERSON_SERIES.lstrip()},
daily AS (SELECT user_id, file_date, avg(rmssd_detail) AS var1, avg(resting_hr) AS var2 FROM p_combined
          GROUP BY user_id, file_date),
st AS (SELECT user_id, min(var1) AS min1, max(var1) AS max1, min(var2) AS min2, max(var2) AS max2, avg(var1) AS mean1,
              avg(var2) AS mean2 FROM daily GROUP BY user_id),
j AS (SELECT *, (max1 - min1) / nullif(max2 - min2, 0) AS k FROM daily JOIN st USING (user_id))
SELECT user_id, file_date, round(round(var1, 9), 6) AS Value, 'HRV (RMSSD)' AS Measure, round(round(mean1, 9), 6) AS mean_value,
       file_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-13' AS highlight FROM j
UNION ALL
SELECT user_id, file_date, round(round((var2 - min2) * k + min1, 9), 6), 'Resting HR (bpm)', round(round((mean2 - min2) * k + min1, 9), 6),
       file_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-13' FROM j
"""

SQL["sample_rows"] = f"""
WITH {PERSON_SERIES.lstrip()}
SELECT event_id, timestamp, round(rmssd, 6) AS rmssd, round(coverage, 6) AS coverage, round(low_frequency, 6) AS low_frequency,
       round(high_frequency, 6) AS high_frequency, file_date
FROM p_detail ORDER BY md5('7|' || event_id), event_id LIMIT 5
"""


# ---------------------------------------------------------------- sources

SQL["envelope_participants"] = f"""
WITH {PARTICIPANTS_RAW.lstrip()}
SELECT _id, patient_id, mdh_participant_id, round(age, 6) AS age, invitationstatus, enrollmentdate, inserteddate,
       lastUpdateDate, enrolled, active_kitstatus, aou_complete, shipment_group, compensation_points,
       compensation_tickets, studyendreason, has_vitiligo, has_vitiligo_post_baseline
FROM participants_raw
"""

SQL["envelope_surveys"] = f"""
WITH {_surveys_raw()}
SELECT * FROM surveys_raw
"""

# An export holds the events of one user and one block of events.
EXPORT_SERIES = PERSON_SERIES.lstrip().replace("FROM events", "FROM (SELECT * REPLACE (user_id + 1000000000 * (event_id // 1000000) AS user_id) FROM events)")

# Files by the rules alone: a summary of day D belongs to D + 1 and is missing where two copies of it exist.
FILE_INDEX = f"""{EXPORT_SERIES},
days_of AS (SELECT DISTINCT user_id AS owner, file_date FROM p_detail),
det_file AS (
  SELECT owner, file_date, '/exports/' || owner || '/Heart Rate Variability/Heart Rate Variability Details - ' || file_date
         || '.csv' AS detail_file
  FROM days_of
),
summ_file AS (
  SELECT user_id AS owner, file_date + 1 AS file_date,
         CASE WHEN user_id % 7 <> 3 THEN
           '/exports/' || user_id || '/Heart Rate Variability/Daily Heart Rate Variability Summary - '
           || strftime(file_date, '%Y-%m') || '-(' || strftime(file_date, '%d') || ').csv' END AS summary_file
  FROM p_summary
),
file_index AS (
  SELECT owner, CAST(file_date AS DATE) AS file_date, summary_file, detail_file
  FROM summ_file FULL JOIN det_file USING (owner, file_date)
  WHERE file_date BETWEEN DATE '2024-01-04' AND DATE '2024-01-25' AND (summary_file IS NOT NULL OR detail_file IS NOT NULL)
)"""

SQL["hrv_index"] = f"""
WITH {FILE_INDEX}
SELECT owner, file_date, summary_file, detail_file FROM file_index
"""

SQL["hrv_index_all_dates"] = f"""
WITH {FILE_INDEX},
owners AS (SELECT DISTINCT user_id AS owner FROM p_detail UNION SELECT DISTINCT user_id FROM p_summary),
every_day AS (SELECT owner, CAST(unnest(generate_series(DATE '2024-01-04', DATE '2024-01-25', INTERVAL 1 DAY)) AS DATE) AS file_date
              FROM owners)
SELECT owner, file_date, summary_file, detail_file FROM every_day LEFT JOIN file_index USING (owner, file_date)
"""

SQL["hrv_from_files"] = f"""
WITH {FILE_INDEX}
SELECT d.user_id AS owner, d.file_date, d.timestamp AS timestamp_detail, round(d.rmssd, 6) AS rmssd_detail,
       round(d.coverage, 6) AS coverage, round(d.low_frequency, 6) AS low_frequency, round(d.high_frequency, 6) AS high_frequency,
       s.timestamp AS timestamp_summary, round(s.rmssd, 6) AS rmssd_summary, round(s.nremhr, 6) AS nremhr, round(s.entropy, 6) AS entropy
FROM p_detail d LEFT JOIN p_summary s ON d.user_id = s.user_id AND d.file_date = s.file_date + 1 AND d.user_id % 7 <> 3
WHERE d.file_date BETWEEN DATE '2024-01-04' AND DATE '2024-01-25'
"""

SQL["hrv_summary_from_files"] = f"""
WITH {FILE_INDEX}
SELECT i.owner, i.file_date, s.timestamp, round(s.rmssd, 6) AS rmssd, round(s.nremhr, 6) AS nremhr, round(s.entropy, 6) AS entropy
FROM file_index i LEFT JOIN p_summary s
  ON i.summary_file IS NOT NULL AND s.user_id = i.owner AND s.file_date + 1 = i.file_date
"""

SQL["resting_from_files"] = f"""
WITH {EXPORT_SERIES}
SELECT user_id AS owner, file_date, timestamp, round(resting_hr, 6) AS resting_hr FROM p_resting
WHERE file_date BETWEEN DATE '2024-01-04' AND DATE '2024-01-25'
"""

SQL["readiness_from_files"] = f"""
WITH {EXPORT_SERIES}
SELECT user_id AS owner, file_date, {', '.join(_READY_COLS)}, round(daily_readiness_score, 6) AS daily_readiness_score
FROM p_readiness WHERE file_date BETWEEN DATE '2024-01-04' AND DATE '2024-01-25'
"""


# ---------------------------------------------------------------- two periods of a combined series

SQL["period_compare"] = f"""
WITH RECURSIVE {SERIES.lstrip()},
day_values AS (
  SELECT CASE WHEN file_date >= DATE '2024-01-16' THEN 2024 ELSE 2022 END AS grp, file_date,
         round(avg(resting_hr), 9) AS resting_hr, round(avg(rmssd_detail), 9) AS rmssd_detail
  FROM combined_day GROUP BY file_date
),
long AS (SELECT grp, 'Resting Heart Rate (bpm)' AS metric, resting_hr AS value FROM day_values
         UNION ALL SELECT grp, 'RMSSD Detail (ms)', rmssd_detail FROM day_values),
{_two_sample('long', 'metric', '2022', '2024')},{_exact_p('metric')},
fin AS (SELECT *, mean_b - mean_a AS mean_diff, median_b - median_a AS median_diff FROM te)
SELECT {_ts_select('metric')}, round(mean_diff, 6) AS mean_diff, round(median_diff, 6) AS median_diff,
       {_p_text('ks_p')} AS ks_p_formatted, {_p_text('wilcox_p')} AS wilcox_p_formatted,
       {_stars('ks_p')} AS ks_significance, {_stars('wilcox_p')} AS wilcox_significance,
       'Diff Median: ' || {_signed('median_diff')} || ' | Diff Mean: ' || {_signed('mean_diff')} || chr(10)
         || 'KS: ' || {_p_text('ks_p')} || ' ' || {_stars('ks_p')} || ' | '
         || 'Wilcoxon: ' || {_p_text('wilcox_p')} || ' ' || {_stars('wilcox_p')} AS annotation_text,
       round(max_val * 1.05, 6) AS y_pos, 1.5 AS x_pos
FROM fin
"""

SQL["violin_density"] = """
WITH v AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(l_extendedprice AS DOUBLE) AS x FROM lineitem
           WHERE l_extendedprice IS NOT NULL AND NOT isnan(l_extendedprice) AND NOT isinf(l_extendedprice)),
s AS (SELECT year, count(*) AS n, stddev_samp(x) AS sd, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr, min(x) AS lo, max(x) AS hi FROM v GROUP BY year),
b AS (SELECT *, 0.9 * coalesce(nullif(least(sd, iqr / 1.34), 0), nullif(sd, 0), nullif(abs(lo), 0), 1) * power(n, -0.2) AS bw FROM s WHERE n > 1),
f AS (SELECT *, lo - 3 * bw AS a, hi + 3 * bw AS z, (hi - lo + 14 * bw) / 511 AS step FROM b),
p AS (SELECT v.year, (x - (a - 4 * bw)) / step AS pos FROM v JOIN f ON v.year = f.year),
w AS (SELECT year, i, sum(w) AS w FROM (
        SELECT year, CAST(floor(pos) AS INTEGER) AS i, 1 - (pos - floor(pos)) AS w FROM p
        UNION ALL SELECT year, CAST(floor(pos) AS INTEGER) + 1, pos - floor(pos) FROM p) GROUP BY year, i),
g AS (SELECT f.year, k, sum(w * exp(-0.5 * power((k - i) * step / bw, 2))) / (n * bw * sqrt(2 * pi())) AS d
      FROM f JOIN w ON w.year = f.year, range(512) AS r(k) GROUP BY f.year, k, n, bw),
o AS (SELECT year, n, bw, point, a + point * (z - a) / 511 AS y, (a + point * (z - a) / 511 - (a - 4 * bw)) / step AS pos FROM f, range(512) AS r(point)),
d AS (SELECT o.year, o.n, bw, point, y, g.d + (pos - floor(pos)) * (h.d - g.d) AS density
      FROM o JOIN g ON g.year = o.year AND g.k = floor(pos) JOIN g h ON h.year = o.year AND h.k = floor(pos) + 1)
SELECT year, n, round(round(bw, 12), 9) AS bw, CAST(point AS INTEGER) AS point, round(round(y, 12), 9) AS y, round(round(density, 12), 9) AS density,
       round(round(density / max(density) OVER (), 12), 9) AS width FROM d
"""

SQL["envelope_rejects"] = f"""
WITH {PARTICIPANTS_RAW.lstrip()},
page AS (
  SELECT CAST(substring(_id, 2) AS BIGINT) // 10 AS page, count(*) AS n FROM participants_raw GROUP BY 1)
SELECT page, reason AS reject_reason, CASE WHEN reason IS NULL AND page % 9 <> 7 THEN n ELSE 0 END AS records,
       CASE WHEN reason IS NULL OR page % 9 = 3 THEN 0 ELSE 1 END AS texts
FROM (SELECT *, CASE page % 9 WHEN 1 THEN 'malformed or truncated' WHEN 2 THEN 'malformed or truncated' WHEN 3 THEN 'no text'
                   WHEN 4 THEN 'no list at data.data' WHEN 5 THEN 'no text' WHEN 6 THEN 'a record is no object' END AS reason FROM page)
WHERE page % 9 <> 7
"""

SQL["resting_from_folders"] = f"""
WITH {PERSON_SERIES.lstrip()}
SELECT 'p' || (user_id % 4) AS owner, file_date, timestamp, round(resting_hr, 6) AS resting_hr FROM p_resting
WHERE user_id % 4 <> 2 AND file_date BETWEEN DATE '2024-01-04' AND DATE '2024-01-25'
"""

SQL["dictionary_from_files"] = f"""
WITH {EVENT_SURVEYS.lstrip()}
SELECT DISTINCT surveyname, CAST(version AS INTEGER) AS surveyversion, step_id AS stepidentifier, result_id AS resultidentifier,
       CASE WHEN kind = 'stress' THEN CASE WHEN version = 1 THEN 'BL' ELSE 'QT' END ELSE CASE WHEN version = 3 THEN 'QT' ELSE 'BL' END END AS survey_type,
       topic AS survey_topic, 'Step ' || q AS step_readable,
       CASE WHEN kind = 'stress' THEN q || '. In the last month, how often did item ' || q || ' happen?' ELSE 'Question ' || q || ' about ' || topic END
         || chr(10) || '"select all", please' AS questiontext,
       CASE WHEN kind = 'stress' THEN 'scale' ELSE 'text' END AS answerformat,
       CASE WHEN kind = 'stress' THEN 'never, almost never, sometimes, fairly often, very often' ELSE 'free text' END AS answerchoices
FROM event_survey WHERE kind <> 'admin'
"""

SQL["other_id_patterns"] = f"""
WITH {PARTICIPANTS_RAW.lstrip()}
SELECT patient_id, mdh_participant_id, {_int("regexp_extract(patient_id, 'AB_([0-9]+)', 1)")} AS FamilyID,
       {_int("regexp_extract(patient_id, '^AB_[0-9]+_([0-9]+)_v', 1)")} AS fam_pos, {_int("regexp_extract(patient_id, '([0-9]+)(_v)?$', 1)")} AS suffixed_pos
FROM participants_raw
"""
