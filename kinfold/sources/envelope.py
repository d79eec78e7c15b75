"""Exported API responses and the data dictionary (SRC1-SRC3, FIXTURES 1.1-1.4).

The study code fetches JSON over HTTP and keeps the rows at ``data.data``; here the responses are files
(one JSON document per file, any number of files), read in one scan with an explicit schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.sources.headered import plain_path

# Record schemas inferred from the study code (FIXTURES 1.2-1.4).
PARTICIPANT_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType()), T.StructField("patient_id", T.StringType()),
    T.StructField("mdh_participant_id", T.StringType()), T.StructField("age", T.DoubleType()),
    T.StructField("invitationstatus", T.StringType()), T.StructField("enrollmentdate", T.StringType()),
    T.StructField("inserteddate", T.StringType()), T.StructField("lastUpdateDate", T.StringType()),
    T.StructField("enrolled", T.BooleanType()), T.StructField("active_kitstatus", T.StringType()),
    T.StructField("aou_complete", T.StringType()), T.StructField("shipment_group", T.StringType()),
    T.StructField("compensation_points", T.StringType()), T.StructField("compensation_tickets", T.StringType()),
    T.StructField("studyendreason", T.StringType()), T.StructField("has_vitiligo", T.IntegerType()),
    T.StructField("has_vitiligo_post_baseline", T.IntegerType()),
])
SURVEY_SCHEMA = T.StructType([
    T.StructField(n, T.StringType()) for n in (
        "id", "participantid", "surveyid", "DID", "date", "inserteddate", "creationDate", "lastUpdateDate",
        "surveyname", "surveyversion", "surveydisplayname", "stepidentifier", "resultidentifier", "answers")
])
DICTIONARY_SCHEMA = T.StructType([
    T.StructField("surveyname", T.StringType()), T.StructField("surveyversion", T.IntegerType()),
    T.StructField("stepidentifier", T.StringType()), T.StructField("resultidentifier", T.StringType()),
    T.StructField("survey_type", T.StringType()), T.StructField("survey_topic", T.StringType()),
    T.StructField("step_readable", T.StringType()), T.StructField("questiontext", T.StringType()),
    T.StructField("answerformat", T.StringType()), T.StructField("answerchoices", T.StringType()),
])


def envelope_schema(record: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("data", T.StructType([T.StructField("data", T.ArrayType(record))]))])


MALFORMED, NO_RECORDS, NO_TEXT, NO_OBJECT = "malformed or truncated", "no list at data.data", "no text", "a record is no object"


def decode_envelope(texts: DataFrame, record: T.StructType, text_col: str = "text", keep: Sequence[str] = (),
                    on_bad: str = "reject", observation: Observation | None = None) -> DataFrame:
    """Rows of ``data.data`` of JSON responses held as texts (SRC1), and what became of the responses that have none.

    A response is bad if it is NULL or blank, not one whole JSON document (a truncated one, or two), holds no list at data.data, or a list with something
    else than objects. A list may be empty. A field whose value does not fit its type is NULL and makes no response bad.

    * ``on_bad="reject"``: (keep, reject_reason, reject_text, record columns); a bad response is one row with a reason and its text;
    * ``"fail"``: (keep, record columns); the first bad response is an error that tells its reason and beginning;
    * ``"drop"``: (keep, record columns); bad responses give no rows.

    ``observation`` receives the numbers of responses, bad_responses and records while the rows are read, in the same scan.
    """
    if on_bad not in ("reject", "fail", "drop"):
        raise ValueError(f"on_bad {on_bad!r} is none of reject, fail, drop")
    text = F.col(text_col)
    reason = F.when(F.coalesce(F.trim(text), F.lit("")) == "", F.lit(NO_TEXT)).when(
        # one document and nothing else: the whole text is read, and nothing taken over from one that is cut short
        F.coalesce(F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))), F.lit(0)) != 1, F.lit(MALFORMED)).when(
        F.json_array_length(F.get_json_object(text, "$.data.data")).isNull(), F.lit(NO_RECORDS))
    read = texts.select(*keep, text.alias("_text"), reason.alias("reject_reason"), F.from_json(text, envelope_schema(record))["data"]["data"].alias("_records"))
    odd = F.coalesce(F.exists("_records", lambda r: r.isNull()), F.lit(True))
    read = read.withColumn("reject_reason", F.coalesce("reject_reason", F.when(odd, F.lit(NO_OBJECT))))
    read = read.withColumn("_records", F.when(F.col("reject_reason").isNull(), F.col("_records")))
    if observation is not None:
        read = read.observe(observation, F.count(F.lit(1)).alias("responses"), F.count("reject_reason").alias("bad_responses"),
                            F.coalesce(F.sum(F.size(F.coalesce("_records", F.array()))), F.lit(0)).alias("records"))
    if on_bad == "fail":
        stop = F.raise_error(F.concat(F.lit("bad response ("), F.col("reject_reason"), F.lit("): "), F.coalesce(F.substring("_text", 1, 80), F.lit("NULL"))))
        read = read.withColumn("_records", F.when(F.col("reject_reason").isNull(), F.col("_records")).otherwise(stop.cast(read.schema["_records"].dataType)))
    if on_bad != "reject":
        return read.select(*keep, F.explode("_records").alias("_record")).select(*keep, "_record.*")
    out = read.select(*keep, "reject_reason", F.when(F.col("reject_reason").isNotNull(), F.col("_text")).alias("reject_text"), F.explode_outer("_records").alias("_record"))
    return out.where("reject_reason IS NOT NULL OR _record IS NOT NULL").select(*keep, "reject_reason", "reject_text", "_record.*")


def explode_envelope(texts: DataFrame, record: T.StructType, text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``decode_envelope`` of responses whose bad ones give no rows."""
    return decode_envelope(texts, record, text_col, keep, on_bad="drop")


def read_envelope(spark: SparkSession, path: str, record: T.StructType, on_bad: str = "fail", observation: Observation | None = None) -> DataFrame:
    """``decode_envelope`` of every JSON response under ``path`` (SRC1, SRC2); a file is one document. A bad one stops the read, as in the study
    code, unless ``on_bad`` says otherwise; ``"reject"`` also gives the ``path`` of each row."""
    files = spark.read.text(path, wholetext=True)
    texts = files.select(plain_path("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return decode_envelope(texts, record, keep=["path"] if on_bad == "reject" else [], on_bad=on_bad, observation=observation)


def read_participants(spark: SparkSession, path: str, on_bad: str = "fail", observation: Observation | None = None) -> DataFrame:
    return read_envelope(spark, path, PARTICIPANT_SCHEMA, on_bad, observation)


def read_surveys(spark: SparkSession, path: str, on_bad: str = "fail", observation: Observation | None = None) -> DataFrame:
    return read_envelope(spark, path, SURVEY_SCHEMA, on_bad, observation)


def read_dictionary(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Data dictionary as CSV (header row) or Parquet (SRC3); the workbook itself is exported first.

    Columns are taken by name, in any order and among others; a missing one is an error. Fields may hold line breaks and doubled quotes.
    Files of one folder must have the same header: a dictionary is one sheet.
    """
    if fmt == "csv":
        raw = spark.read.options(header=True, multiLine=True, enforceSchema=False, escape='"').csv(path)
    else:
        raw = spark.read.format(fmt).load(path)
    names = {c.strip().lower(): c for c in raw.columns}
    if missing := [f.name for f in DICTIONARY_SCHEMA.fields if f.name.lower() not in names]:
        raise ValueError(f"{path} has no column {', '.join(missing)}; it has {', '.join(raw.columns)}")
    return raw.select(*[F.col(f"`{names[f.name.lower()]}`").try_cast(f.dataType).alias(f.name) for f in DICTIONARY_SCHEMA.fields])
