"""Survey responses and the data dictionary (API3 clean_responses, API5 dictionary cleaning + overviews)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions.answers import FIRST_ANSWER, extract_answers
from kinfold.functions.casting import safe_int
from kinfold.functions.timecols import STUDY_TZ, local_date, local_wallclock, to_instant
from kinfold.operators.joins import checked_broadcast, join_by
from kinfold.operators.reshape import relocate

# Time columns of a response record, and the columns dropped after the join (quirk Q7:
# the study code drops two positional ranges; these are the columns those ranges hold).
RESPONSE_TIMES = ("date", "inserteddate", "creationDate", "lastUpdateDate")
RESPONSE_DROP = ("participantid", "surveyid", "inserteddate", "creationDate", "lastUpdateDate", "DID")


def clean_responses(surveys: DataFrame, people: DataFrame, ans_pat: str = FIRST_ANSWER, tz: str = STUDY_TZ,
                    null_safe: bool = True, drop_cols: Sequence[str] = RESPONSE_DROP,
                    people_broadcast_rows: int | None = None) -> DataFrame:
    """Join responses to cleaned participants and explode the answers (API3).

    * left join on participantid = mdh_participant_id (NULL matches NULL when ``null_safe``), clashing
      participant columns get '_pt'; unmatched rows are dropped, so Catalyst plans an inner join;
    * the four time columns become instants; ``recorded_date`` is the local date of ``date``;
    * answers: first match of ``ans_pat``, lower case, split on '","', one row per answer
      (``explode_outer``: a NULL answer keeps its row).

    ``people_broadcast_rows``: broadcast the participants after a bounded count proves them at most that
    many rows; by default the join is left to AQE.
    """
    right = checked_broadcast(people, people_broadcast_rows)
    j = join_by(surveys, right, {"participantid": "mdh_participant_id"}, how="left", suffix=("", "_pt"),
                null_safe=null_safe)
    j = j.where(F.col("patient_id").isNotNull())
    j = j.withColumns({c: to_instant(j, c) for c in RESPONSE_TIMES if c in j.columns})
    j = j.withColumns({"recorded_date": local_date("date", tz), "answers": extract_answers("answers", ans_pat)})
    j = j.withColumnsRenamed({"date": "recorded_dttm", "id": "response_id"})
    j = relocate(j.drop(*drop_cols), ["patient_id", "recorded_dttm", "recorded_date", "response_id"])
    return j.withColumn("answers", F.explode_outer("answers"))


# Dictionary renames, and question texts standardised by result id (CND5).
DICTIONARY_RENAMES = {"questiontext": "question_readable", "answerformat": "answer_format",
                      "answerchoices": "possible_answers"}
QUESTION_OVERRIDES = {
    "new_spots_adhoc": "Have you noticed any new white spots on your skin that you think can be vitiligo or "
                       "improvement (repigmentation) of your vitiligo?",
    "new_spots_duration": "How long ago did you notice your new white spots?",
    "vitiligo_location1_adhoc": "Where is your vitiligo located? Please include the new spot you're currently "
                                "reporting.\n\n*Select all that apply*",
}
DICTIONARY_KEYS = ("surveyname", "surveyversion", "stepidentifier", "resultidentifier")
DICTIONARY_COLUMNS = ("surveyname", "surveyversion", "stepidentifier", "resultidentifier", "survey_type",
                      "survey_topic", "step_readable", "question_standardized", "possible_answers")


def clean_dictionary(df: DataFrame, overrides: dict[str, str] | None = None,
                     keep: Sequence[str] = ()) -> DataFrame:
    """Rename, version as text, standardised question text (API5). ``keep``: extra columns to carry
    (for example a row-order column for ``dictionary_overview``)."""
    overrides = QUESTION_OVERRIDES if overrides is None else overrides
    d = df.withColumnsRenamed(DICTIONARY_RENAMES).withColumn("surveyversion", F.col("surveyversion").cast("string"))
    if overrides:
        pairs = []
        for k, v in overrides.items():
            pairs += [F.lit(k), F.lit(v)]
        std = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("resultidentifier")), F.col("question_readable"))
    else:
        std = F.col("question_readable")
    d = d.withColumn("question_standardized", std)
    return d.select(*DICTIONARY_COLUMNS, *keep)


def dictionary_versions(d: DataFrame) -> DataFrame:
    """Questions per (topic, type, version), newest version first within a topic and type (AGG5, SRT2)."""
    out = d.groupBy("survey_topic", "survey_type", "surveyversion").agg(F.count(F.lit(1)).alias("total_questions"))
    return out.orderBy(F.asc_nulls_last("survey_topic"), F.asc_nulls_last("survey_type"),
                       F.desc_nulls_last(safe_int("surveyversion")))


def dictionary_overview(d: DataFrame, order_col: str = "row_order") -> DataFrame:
    """Questions per (topic, type) and their versions joined by ', ' in order of first appearance (AGG6).

    Two steps: first appearance per version (``min(order_col)``), then the versions of a (topic, type)
    sorted by it. The collected list holds one entry per distinct version, not per question.
    """
    per_version = d.groupBy("survey_topic", "survey_type", "surveyversion").agg(
        F.count(F.lit(1)).alias("n"), F.min(order_col).alias("first_seen"))
    out = per_version.groupBy("survey_topic", "survey_type").agg(
        F.sum("n").alias("total_questions"),
        # a missing version prints as NA, as R's paste() does
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first_seen", "surveyversion"))),
                                 lambda x: x["surveyversion"]), ", ", "NA").alias("versions"))
    return out.orderBy(F.asc_nulls_last("survey_topic"), F.asc_nulls_last("survey_type"))


def responses_last_updated(responses: DataFrame, tz: str = STUDY_TZ, label: str = "Last updated:") -> DataFrame:
    """Latest response instant (NULLs ignored, quirk Q21) and 'Last updated: <local time> <zone>' (AGG14)."""
    latest = responses.agg(F.max("recorded_dttm").alias("last_updated"))
    local = local_wallclock("last_updated", tz)
    return latest.withColumn("last_updated_text", F.concat_ws(" ", F.lit(label),
                                                              F.date_format(local, "yyyy-MM-dd HH:mm:ss"), F.lit(tz)))
