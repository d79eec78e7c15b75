"""Enrichment with the dictionary and scale scoring (API6-API9, WIN2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.functions.answers import (LIKERT_LEVELS, REVERSE_ITEMS, SCORED_CHOICES, clean_answer, level_score,
                                       reverse_scored)
from kinfold.functions.casting import safe_int
from kinfold.functions.timecols import STUDY_TZ, local_date, months_since, phase_label
from kinfold.operators.joins import join_by, local_copy
from kinfold.operators.responses import DICTIONARY_KEYS

# Pattern of the scored survey's display name and survey name.
STRESS_PATTERN = "(S|s)tress"
# Topics known to the study, and the enriched long-table columns (source -> output name).
KNOWN_TOPICS = ("environmental exposures", "general health", "life changes", "skin type", "vitiligo", "stress")
ENRICHED_COLUMNS = (
    ("patient_id", "patient_id"), ("FamilyID", "FamilyID"), ("age", "age"), ("vitiligo_status", "vitiligo_status"),
    ("total_points", "raffle_points"), ("recorded_date", "recorded_date"), ("enroll_date", "enroll_date"),
    ("survey_topic", "survey_topic"), ("surveydisplayname", "survey_display_name"),
    ("surveyversion", "surveyversion"), ("survey_type", "survey_type"),
    ("question_standardized", "question_standardized"), ("answer_clean", "answer_clean"),
    ("possible_answers", "possible_answers"),
)
TOPIC_COLUMNS = ("patient_id", "FamilyID", "age", "vitiligo_status", "raffle_points", "recorded_date", "enroll_date",
                 "surveyversion", "survey_type", "question_standardized", "answer_clean")
TOTAL_KEYS = ("patient_id", "FamilyID", "recorded_date", "enroll_date", "survey_type")


def _select_enriched(df: DataFrame, days_col: str | None = None) -> DataFrame:
    return df.selectExpr(*[f"`{src}` AS `{dst}`" for src, dst in ENRICHED_COLUMNS], *([f"`{days_col}`"] if days_col else []))


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every ``keys`` group by ``order`` (WIN2: sort, then keep the first distinct).

    ``min_by`` over a struct of the row is an ordinary aggregate: it combines map-side, so each group
    reaches the shuffle as one row per task and a very large group cannot pile up in one task.
    ``order`` must make the pick unique (end it with an id column). Carrying whole rows, it is planned as a sorted
    aggregate: a sort within each task is the price of the smaller shuffle.
    """
    row = F.expr("struct(" + ", ".join(f"`{c}`" for c in df.columns) + ")")  # the whole row, one parse
    picked = df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("__row"))
    return picked.select("__row.*")


DICTIONARY_ROWS = 100_000


def _with_days(j: DataFrame, days_col: str | None, tz: str) -> DataFrame:
    """Optional column: local days from enrollment to the response (DAT4)."""
    if not days_col:
        return j
    return j.withColumn(days_col, F.date_diff(local_date("recorded_dttm", tz), local_date("enroll_date", tz)))


def _matched(responses: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Responses next to their dictionary row, if there is one; a small dictionary is broadcast (checked)."""
    d = dictionary.select(*DICTIONARY_KEYS, "survey_type", "survey_topic", "question_standardized", "possible_answers")
    return join_by(responses, local_copy(d, DICTIONARY_ROWS), list(DICTIONARY_KEYS), how="left", null_safe=True)


def _first_order() -> list[Column]:
    return [F.col("recorded_dttm").isNull(), F.col("recorded_dttm"), F.col("response_id"), F.col("answers").isNull(),
            F.col("answers")]


FIRST_KEYS = ("patient_id", "recorded_date", "question_standardized")


def _scored(j: DataFrame, levels: Sequence[str], reverse_items: Sequence[int], tz: str, when: Column | None = None) -> DataFrame:
    """Phase, score and choices of the scored rows (those for which ``when`` holds; default: all)."""
    months = months_since(local_date("recorded_dttm", tz), local_date("enroll_date", tz))
    j = j.withColumn("answer_clean", clean_answer("answers"))
    score = reverse_scored(level_score("answer_clean", levels), "question_standardized", reverse_items,
                           top=len(levels) - 1).cast("string")
    new = {"survey_type": phase_label(months), "answer_clean": score, "possible_answers": F.lit(SCORED_CHOICES)}
    return j.withColumns(new if when is None else {c: F.when(when, x).otherwise(F.col(c)) for c, x in new.items()})


def enrich(responses: DataFrame, dictionary: DataFrame, exclude: str = STRESS_PATTERN, days_col: str | None = None,
           tz: str = STUDY_TZ) -> DataFrame:
    """Unscored topics (API6): responses whose display name does not match ``exclude`` (NULL names are
    dropped too), left join on the four dictionary keys, clean answer text, keep dictionary matches.
    ``days_col`` names an additional column of the days since enrollment (DAT4)."""
    j = _matched(responses.where(~F.col("surveydisplayname").rlike(exclude)), dictionary)
    j = j.withColumn("answer_clean", clean_answer("answers")).where(F.col("survey_topic").isNotNull())
    return _select_enriched(_with_days(j, days_col, tz), days_col)


def score_likert(responses: DataFrame, dictionary: DataFrame, include: str = STRESS_PATTERN,
                 levels: Sequence[str] = LIKERT_LEVELS, reverse_items: Sequence[int] = REVERSE_ITEMS,
                 tz: str = STUDY_TZ, days_col: str | None = None) -> DataFrame:
    """Scored scale (API7).

    1. responses of the scale joined to its follow-up ('QT') dictionary rows;
    2. first answer per (patient, local day, question), earliest ``recorded_dttm`` first (NULL last);
    3. phase from months since enrollment (days / 30.4375; < 2.9 'BL', else 'QT');
    4. answer text -> position on the scale; reverse-keyed items -> top - score;
    5. unmatched dictionary rows dropped; the score is carried as text in ``answer_clean``.
    """
    d = dictionary.where((F.col("survey_type") == F.lit("QT")) & F.col("surveyname").rlike(include))
    j = _matched(responses.where(F.col("surveydisplayname").rlike(include)), d)
    j = first_per_group(j, list(FIRST_KEYS), _first_order()).where(F.col("survey_topic").isNotNull())
    return _select_enriched(_with_days(_scored(j, levels, reverse_items, tz), days_col, tz), days_col)


def enriched_long(responses: DataFrame, dictionary: DataFrame, pattern: str = STRESS_PATTERN, sort: bool = True,
                  levels: Sequence[str] = LIKERT_LEVELS, reverse_items: Sequence[int] = REVERSE_ITEMS,
                  tz: str = STUDY_TZ, days_col: str | None = None) -> DataFrame:
    """Unscored and scored answers in one table, sorted (API8, SET1). ``sort=False`` when only slices are read.

    The rows of ``enrich`` and ``score_likert`` in one pass: one dictionary join (scored responses match follow-up rows of
    the scale only), one window that picks the first answer of scored questions, and conditional scoring.
    """
    scored = F.col("surveydisplayname").rlike(pattern)
    of_scale = F.col("survey_type").eqNullSafe(F.lit("QT")) & F.col("surveyname").rlike(pattern)
    j = _matched(responses.where(scored.isNotNull()).withColumn("__scored", scored), dictionary)
    found = ["survey_type", "survey_topic", "question_standardized", "possible_answers"]
    j = j.withColumns({c: F.when(~F.col("__scored") | of_scale, F.col(c)) for c in found})
    j = j.where(F.col("__scored") | F.col("survey_topic").isNotNull())
    # unscored rows are all kept; their window keys only spread them
    keys = [F.when(F.col("__scored"), F.col(c).cast("string")) for c in FIRST_KEYS] + [F.when(~F.col("__scored"), F.col("response_id"))]
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*_first_order()))
    j = j.withColumn("__nth", nth).where((~F.col("__scored") | (F.col("__nth") == 1)) & F.col("survey_topic").isNotNull())
    out = _select_enriched(_with_days(_scored(j, levels, reverse_items, tz, F.col("__scored")), days_col, tz), days_col)
    if not sort:
        return out
    return out.orderBy(F.asc_nulls_last("patient_id"), F.asc_nulls_last("recorded_date"),
                       F.asc_nulls_last("survey_topic"))


def topic_slice(enriched: DataFrame, topic: str, known_topics: Sequence[str] = KNOWN_TOPICS) -> DataFrame:
    """Rows of one topic with the 11 topic columns (API8, FLT5). Unknown topic -> ValueError (Q16)."""
    if topic not in known_topics:
        raise ValueError(f"no survey topic {topic!r}; known are {', '.join(known_topics)}")
    return enriched.where(F.col("survey_topic") == F.lit(topic)).select(*TOPIC_COLUMNS)


def topic_rows(responses: DataFrame, dictionary: DataFrame, topic: str, pattern: str = STRESS_PATTERN,
               known_topics: Sequence[str] = KNOWN_TOPICS) -> DataFrame:
    """``topic_slice`` without building the whole table: where the dictionary has no scored question of the topic, only the
    unscored answers are read, next to the topic's dictionary rows."""
    if topic not in known_topics:
        raise ValueError(f"no survey topic {topic!r}; known are {', '.join(known_topics)}")
    d = local_copy(dictionary, DICTIONARY_ROWS)
    of_scale = (F.col("survey_type") == F.lit("QT")) & F.col("surveyname").rlike(pattern) & (F.col("survey_topic") == F.lit(topic))
    if d.where(of_scale).limit(1).count():
        return topic_slice(enriched_long(responses, d, pattern, sort=False), topic, known_topics)
    return enrich(responses, d.where(F.col("survey_topic") == F.lit(topic)), pattern).select(*TOPIC_COLUMNS)


def topic_slices(enriched: DataFrame, known_topics: Sequence[str] = KNOWN_TOPICS) -> DataFrame:
    """All topic tables in one: the topic and the 11 topic columns of the rows of every known topic (API8)."""
    return enriched.where(F.col("survey_topic").isin(*known_topics)).select("survey_topic", *TOPIC_COLUMNS)


def score_totals(items: DataFrame, keys: Sequence[str] = TOTAL_KEYS, score_col: str = "answer_clean",
                 out: str = "stress_score") -> DataFrame:
    """Sum of item scores per submission; all-NULL sums to 0 (API9, AGG7)."""
    return items.groupBy(*keys).agg(F.coalesce(F.sum(safe_int(score_col)), F.lit(0)).cast("int").alias(out))


def enriched_overview(enriched: DataFrame, order: Sequence[str] = ("patient_id", "recorded_date"),
                      topic: str = "survey_topic") -> DataFrame:
    """Shape of the long table and its topics in order of first appearance (AGG15, SET4).

    The long table is sorted by ``order`` then topic; a topic first appears at the smallest sort key among
    its rows, so ordering topics by that minimum gives the same list without numbering every row.
    """
    key = F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))], F.col(topic))
    per_topic = enriched.groupBy(topic).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first_key"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("first_key", topic))), lambda x: x[topic])
    return per_topic.agg(F.sum("n").alias("n_rows"), F.lit(len(enriched.columns)).alias("n_cols"),
                         F.array_join(ordered, ", ").alias("topics"))
