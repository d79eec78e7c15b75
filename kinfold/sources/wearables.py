"""Wearable export files (SRC4-SRC9, API10-API11).

Layout under ``root`` (FIXTURES 1.5)::

    Heart Rate Variability/Daily Heart Rate Variability Summary - YYYY-MM-(DD).csv
    Heart Rate Variability/Heart Rate Variability Details - YYYY-MM-DD.csv
    Physical Activity_GoogleData/daily_resting_heart_rate.csv
    Physical Activity_GoogleData/daily_readiness.csv

The study code loops over days and reads one file pair per day. Here the day rules are joins and aggregates on the paths,
and each file kind is decoded by column name (``headered``): files of a folder by a scan for each different header, and texts in
a column (a stream, a table of files) one by one. ``keys`` are columns of an owner (a person), so that many people's exports
are read in one scan; ``owner_pattern`` takes the owner from the path.
"""

from __future__ import annotations

import datetime as _dt
import os
import warnings
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.functions.timecols import to_instant
from kinfold.operators.joins import join_by
from kinfold.sources.headered import csv_rows, plain_path, read_by_header

# Export folder and file names.
HRV_DIR = "Heart Rate Variability"
GOOGLE_DIR = "Physical Activity_GoogleData"
SUMMARY_REGEX = "Daily Heart Rate Variability Summary - ([0-9]{4}-[0-9]{2})-\\(([0-9]{2})\\)\\.csv$"
DETAIL_REGEX = "Heart Rate Variability Details - ([0-9]{4}-[0-9]{2}-[0-9]{2})\\.csv$"
RESTING_FILE = "daily_resting_heart_rate.csv"
READINESS_FILE = "daily_readiness.csv"

# Columns of each export file and their types.
SUMMARY_COLUMNS = {"timestamp": "string", "rmssd": "double", "nremhr": "double", "entropy": "double"}
DETAIL_COLUMNS = {"timestamp": "string", "rmssd": "double", "coverage": "double", "low_frequency": "double",
                  "high_frequency": "double"}
RESTING_COLUMNS = {"timestamp": "string", "beats per minute": "double"}
READINESS_COLUMNS = {"timestamp": "string", "type": "string", "sleep readiness": "string",
                     "heart rate variability readiness": "string", "resting heart rate readiness": "string",
                     "score": "double"}
# Kind -> (file name pattern, columns, days from the named day to the day it belongs to).
HRV_KINDS = {"detail": (DETAIL_REGEX, DETAIL_COLUMNS, 0), "summary": (SUMMARY_REGEX, SUMMARY_COLUMNS, 1)}


def _dates(start, end) -> tuple[_dt.date, _dt.date]:
    s, e = (_dt.date.fromisoformat(str(x)[:10]) for x in (start, end))
    if s > e:
        raise ValueError(f"start date {s} is after end date {e}")  # quirk Q25
    return s, e


def hrv_file_day(name: Column, kind: str) -> Column:
    """The day that a file of ``kind`` belongs to, from its name (SRC4a, SRC4b).

    NULL for any other name and for an impossible date: such a file is no HRV file.
    """
    regex, _, shift = HRV_KINDS[kind]
    part = F.regexp_extract(name, regex, 1)
    text = F.concat(part, F.lit("-"), F.regexp_extract(name, regex, 2)) if kind == "summary" else part
    return F.date_add(F.when(name.rlike(regex), text).try_cast("date"), shift)


def _one_per_day(files: DataFrame, kind: str, path_col: str, keys: Sequence[str]) -> DataFrame:
    """(keys, file_date, file): the single file of a day; 0 or several matches -> NULL (SRC4c)."""
    dated = files.withColumn("file_date", hrv_file_day(F.col(path_col), kind)).where("file_date IS NOT NULL")
    return dated.groupBy(*keys, "file_date").agg(F.when(F.count(F.lit(1)) == 1, F.max(path_col)).alias(f"{kind}_file"))


def index_files(files: DataFrame, start, end, force_all_dates: bool = False, path_col: str = "path",
                keys: Sequence[str] = ()) -> DataFrame:
    """(keys, file_date, summary_file, detail_file) for each day of [start, end] from a table of paths (SRC4).

    The summary file of day D-1 belongs to day D. Days without any file are left out unless ``force_all_dates`` (then
    every day of the range appears for every owner, with NULL paths).
    """
    s, e = _dates(start, end)
    k = list(keys)
    paths = files.select(*k, path_col)
    idx = join_by(_one_per_day(paths, "summary", path_col, k), _one_per_day(paths, "detail", path_col, k), [*k, "file_date"], how="full", one_per_key=True)
    idx = idx.where(F.col("file_date").between(F.lit(s), F.lit(e)))
    idx = idx.where(F.col("summary_file").isNotNull() | F.col("detail_file").isNotNull())
    if force_all_dates:
        owners = paths.select(*k).distinct() if k else files.sparkSession.range(1).select()
        days = owners.select(*k, F.explode(F.sequence(F.lit(s), F.lit(e), F.expr("INTERVAL 1 DAY"))).alias("file_date"))
        idx = join_by(days, idx, [*k, "file_date"], how="left")
    return idx.select(*k, "file_date", "summary_file", "detail_file")


def decode_hrv(files: DataFrame, kind: str, keep: Sequence[str] = (), text_col: str = "text") -> DataFrame:
    """Rows of summary or detail files given as texts, by column name, with the time as an instant (SRC5, SRC6, RSH4)."""
    rows = csv_rows(files, HRV_KINDS[kind][1], text_col, keep)
    return rows.withColumn("timestamp", to_instant(rows, "timestamp"))


def _side(idx: DataFrame, rows_of: Callable[[str, DataFrame], DataFrame], kind: str, keys: Sequence[str]) -> DataFrame:
    """Rows of the files that the index names, with their index date; one all-NULL row for every index date without
    a readable row (the study's placeholder row for a missing file, quirk Q19)."""
    col, k = f"{kind}_file", list(keys)
    present = idx.where(F.col(col).isNotNull()).select(*[F.col(c).alias(f"__{c}") for c in k], "file_date", F.col(col).alias("__path"))
    missing = idx.where(F.col(col).isNull()).select(*k, "file_date")
    return rows_of(kind, present).select(*k, "file_date", *HRV_KINDS[kind][1]).unionByName(missing, allowMissingColumns=True)


def _named(rows: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` (keys, path, ...) of the files that ``present`` names, with their date."""
    cond = F.col("path") == F.col("__path")
    for c in keys:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return rows.join(present, cond)


def hrv_days(files: DataFrame, start, end, summary_only: bool = False, force_missing_detail: bool = False,
             force_all_dates: bool = False, keys: Sequence[str] = ()) -> DataFrame:
    """HRV detail rows of each day next to the previous day's summary, from (keys, path, text) rows (API10, JN4).

    * days without a detail file are skipped unless ``summary_only`` or ``force_missing_detail``;
    * a missing summary gives NULL summary columns; ``summary_only`` returns the summary side only;
    * detail and summary of a day are fully joined on ``file_date`` (shared names get _detail/_summary).
    """
    s, e = _dates(start, end)

    def decoded(kind: str, present: DataFrame) -> DataFrame:  # only files of the range are decoded: the day comes from the name
        dated = files.where(hrv_file_day(F.col("path"), kind).between(F.lit(s), F.lit(e)))
        return decode_hrv(_named(dated, present, keys), kind, [*keys, "file_date"])

    return _hrv_days(files, decoded, start, end, summary_only, force_missing_detail, force_all_dates, keys)


def _hrv_days(listing: DataFrame, rows_of: Callable[[str, DataFrame], DataFrame], start, end, summary_only: bool,
              force_missing_detail: bool, force_all_dates: bool, keys: Sequence[str]) -> DataFrame:
    """``hrv_days`` of a listing (keys, path); ``rows_of`` gives the rows of the files of one kind that a table names."""
    k = list(keys)
    idx = index_files(listing, start, end, force_all_dates, keys=k)
    if not summary_only and not force_missing_detail:
        idx = idx.where(F.col("detail_file").isNotNull())
    # a day with neither file is always skipped, even when the index lists every day
    idx = idx.where(F.col("summary_file").isNotNull() | F.col("detail_file").isNotNull())
    summary = _side(idx, rows_of, "summary", k)
    if summary_only:
        return summary.select(*k, *SUMMARY_COLUMNS, "file_date")
    # the rows of a key are those of one file, which one task reads in any case
    return join_by(_side(idx, rows_of, "detail", k), summary, [*k, "file_date"], how="full", suffix=("_detail", "_summary"), one_per_key=True)


OWNER_PATTERN = "([^/]+)/" + HRV_DIR + "/[^/]+$"


def _listing(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame | None:
    """(path) of the files under ``path``, for which none is opened; None when the folder or file does not exist."""
    reader = spark.read.format("binaryFile")
    try:
        return (reader.option("pathGlobFilter", glob) if glob else reader).load(path).select("path")
    except AnalysisException:
        return None


def _hrv_listing(spark: SparkSession, root: str, owner_pattern: str | None) -> DataFrame:
    folder = os.path.join(root, "*", HRV_DIR) if owner_pattern else os.path.join(root, HRV_DIR)
    listing = _listing(spark, folder, "*.csv")
    if listing is None:
        warnings.warn(f"No HRV export folder at: {folder}")  # SRC9: empty result, schema kept
        listing = spark.createDataFrame([], "path string")
    return _with_owner(listing, owner_pattern)


def _with_owner(df: DataFrame, owner_pattern: str | None) -> DataFrame:
    return df.withColumn("owner", F.regexp_extract("path", owner_pattern, 1)) if owner_pattern else df


def hrv_file_index(spark: SparkSession, start, end, root: str, force_all_dates: bool = False,
                   owner_pattern: str | None = None) -> DataFrame:
    """``index_files`` of an export folder; with ``owner_pattern``, of every export folder below ``root``, by owner."""
    _dates(start, end)
    return index_files(_hrv_listing(spark, root, owner_pattern), start, end, force_all_dates, keys=["owner"] if owner_pattern else [])


def load_hrv(spark: SparkSession, start, end, root: str, summary_only: bool = False, force_missing_detail: bool = False,
             force_all_dates: bool = False, owner_pattern: str | None = None) -> DataFrame:
    """``hrv_days`` of an export folder; with ``owner_pattern``, of every export folder below ``root``, by owner.

    Only files whose name gives a day of the range are opened, each kind by a scan for each different header.
    """
    s, e = _dates(start, end)
    listing, k = _hrv_listing(spark, root, owner_pattern), ["owner"] if owner_pattern else []

    def scanned(kind: str, present: DataFrame) -> DataFrame:
        dated = listing.where(hrv_file_day(F.col("path"), kind).between(F.lit(s), F.lit(e)))
        rows = _with_owner(read_by_header(spark, [r.path for r in dated.collect()], HRV_KINDS[kind][1]), owner_pattern)
        return _named(rows.withColumn("timestamp", to_instant(rows, "timestamp")), present, k)

    return _hrv_days(listing, scanned, start, end, summary_only, force_missing_detail, force_all_dates, k)


def decode_resting_hr(files: DataFrame, start, end, keys: Sequence[str] = (), text_col: str = "text") -> DataFrame:
    """(keys, file_date, timestamp, resting_hr) within [start, end] by UTC date, from file texts (SRC7, FLT4)."""
    return resting_hr_rows(csv_rows(files, RESTING_COLUMNS, text_col, keys), start, end, keys)


def resting_hr_rows(raw: DataFrame, start, end, keys: Sequence[str] = ()) -> DataFrame:
    """``decode_resting_hr`` of rows with the columns of the file."""
    s, e = _dates(start, end)
    d = raw.select(*keys, to_instant(raw, "timestamp").alias("timestamp"), F.col("`beats per minute`").alias("resting_hr"))
    d = d.withColumn("file_date", F.to_date("timestamp"))
    return d.where(F.col("file_date").between(F.lit(s), F.lit(e))).select(*keys, "file_date", "timestamp", "resting_hr")


def decode_readiness(files: DataFrame, start, end, keys: Sequence[str] = (), text_col: str = "text") -> DataFrame:
    """(keys, file_date, four readiness categories, daily_readiness_score) within [start, end] (SRC8, FLT4, quirk Q17)."""
    return readiness_rows(csv_rows(files, READINESS_COLUMNS, text_col, keys), start, end, keys)


def readiness_rows(raw: DataFrame, start, end, keys: Sequence[str] = ()) -> DataFrame:
    """``decode_readiness`` of rows with the columns of the file."""
    s, e = _dates(start, end)
    d = raw.select(
        *keys, F.to_date(to_instant(raw, "timestamp")).alias("file_date"),
        F.col("type").alias("daily_readiness_cat"),
        F.col("`sleep readiness`").alias("sleep_readiness_cat"),
        F.col("`heart rate variability readiness`").alias("hrv_readiness_cat"),
        F.col("`resting heart rate readiness`").alias("rhr_readiness_cat"),
        F.col("score").alias("daily_readiness_score"))
    return d.where(F.col("file_date").between(F.lit(s), F.lit(e)))


def _daily_rows(spark: SparkSession, root: str, name: str, columns: dict[str, str], owner_pattern: str | None) -> DataFrame:
    """Rows of a daily file of one export folder, or (with its owner) of all export folders below ``root``."""
    path = os.path.join(root, "*", GOOGLE_DIR, name) if owner_pattern else os.path.join(root, GOOGLE_DIR, name)
    listing = _listing(spark, path)
    if listing is None:
        warnings.warn(f"no such export file: {path}")
    return _with_owner(read_by_header(spark, [r.path for r in listing.collect()] if listing is not None else [], columns), owner_pattern)


DAILY_OWNER_PATTERN = "([^/]+)/" + GOOGLE_DIR + "/[^/]+$"


def load_resting_hr(spark: SparkSession, start, end, root: str, owner_pattern: str | None = None) -> DataFrame:
    """``decode_resting_hr`` of an export folder (with ``owner_pattern``, of every one below ``root``, by owner); missing file -> a warning and no
    rows (SRC9)."""
    rows = _daily_rows(spark, root, RESTING_FILE, RESTING_COLUMNS, owner_pattern)
    return resting_hr_rows(rows, start, end, ["owner"] if owner_pattern else [])


def load_readiness(spark: SparkSession, start, end, root: str, owner_pattern: str | None = None) -> DataFrame:
    """``decode_readiness`` of an export folder, as ``load_resting_hr`` (SRC9)."""
    rows = _daily_rows(spark, root, READINESS_FILE, READINESS_COLUMNS, owner_pattern)
    return readiness_rows(rows, start, end, ["owner"] if owner_pattern else [])
