"""Incremental ingestion of date-named wearable files.

The study code re-reads a person's whole export on every run after the daily 05:00 refresh. With
Structured Streaming the same folder becomes a file stream: each run (``trigger(availableNow=True)``)
reads only the files that arrived since the last run, appends their rows to a table partitioned by
``file_date``, and records progress in a checkpoint. A failed run is simply started again: the file
source and the file sink are exactly-once through the checkpoint.

Two things need more than appended files. ``align_stream`` joins the streams of detail and summary rows, so that a summary that arrives
in a later run still meets its day. ``refresh_daily`` takes over files that are rewritten whole (daily metrics) by key, into
numbered versions of a table.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kinfold.session import ensure_checkpoint_dir
from kinfold.sources.headered import text_files
from kinfold.sources.wearables import HRV_DIR, HRV_KINDS, decode_hrv, hrv_file_day


def hrv_stream(spark: SparkSession, root: str, kind: str = "detail", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming rows of one HRV file kind, with ``file_date`` taken from the file name.

    Files whose name is not that of the kind, or names an impossible date, are passed over. Columns are read by name.
    """
    if kind not in HRV_KINDS:
        raise ValueError(f"unknown kind {kind!r}; one of {', '.join(HRV_KINDS)}")
    options = {"maxFilesPerTrigger": max_files_per_trigger} if max_files_per_trigger else {}
    files = text_files(spark, os.path.join(root, HRV_DIR), "*.csv", stream=True, **options)
    dated = files.withColumn("file_date", hrv_file_day(F.col("file_name"), kind)).where("file_date IS NOT NULL")
    return decode_hrv(dated, kind, ["file_date"])


def ingest_available(stream: DataFrame, target: str, name: str, checkpoint: str | None = None) -> StreamingQuery:
    """Append everything new in ``stream`` to parquet at ``target`` and stop (one refresh run).

    The checkpoint defaults to ``<spark.checkpoint.dir>/streams/<name>``: a shared folder on a cluster.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "streams", name)
    query = (stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
             .partitionBy("file_date").outputMode("append").trigger(availableNow=True).queryName(name).start())
    query.awaitTermination()
    return query


def align_stream(detail: DataFrame, summary: DataFrame, delay: str = "3 days", keys: Sequence[str] = (),
                 suffix: tuple[str, str] = ("_detail", "_summary")) -> DataFrame:
    """Streaming detail rows of day D next to the summary of day D - 1, across runs (JN4).

    Both streams carry ``file_date``, the day a row belongs to (``hrv_stream``: the day after the one a summary names). Rows wait in the join's state for
    their other side, and a summary that arrives up to ``delay`` after newer days have been seen still meets its detail rows. Detail rows whose
    day has passed by more than that come out with NULL summary columns; summaries without detail are dropped. Of several summary rows of a day the
    first to arrive counts. Shared column names get the suffixes, as in ``operators.series.align_daily``.
    """
    k = list(keys)
    shared = (set(detail.columns) & set(summary.columns)) - {*k, "file_date"}
    # the watermark needs a time; every zone has the same day on both sides
    left = detail.withColumn("__day", F.col("file_date").cast("timestamp")).withWatermark("__day", delay)
    right = summary.select(F.col("file_date").cast("timestamp").alias("__when"), *[F.col(c).alias(f"__{c}") for c in k],
                           *[F.col(f"`{c}`").alias(c + suffix[1] if c in shared else c) for c in summary.columns if c not in (*k, "file_date")])
    right = right.withWatermark("__when", delay).dropDuplicatesWithinWatermark(["__when", *[f"__{c}" for c in k]])
    cond = F.col("__day") == F.col("__when")
    for c in k:
        cond = cond & (F.col(c) == F.col(f"__{c}"))
    joined = left.withColumnsRenamed({c: c + suffix[0] for c in shared}).join(right, cond, "left_outer")
    return joined.drop("__day", "__when", *[f"__{c}" for c in k])


def daily_versions(spark: SparkSession, target: str) -> int:
    """Number of the last complete version of a daily table; 0 if there is none."""
    try:
        return spark.read.schema("version int").parquet(os.path.join(target, "log")).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]
    except AnalysisException:
        return 0


def read_daily(spark: SparkSession, target: str, version: int | None = None) -> DataFrame | None:
    """A version (the last one by default) of a daily table; None if there is none."""
    version = daily_versions(spark, target) if version is None else version
    return spark.read.parquet(os.path.join(target, f"v{version}")) if version else None


def refresh_daily(rows: DataFrame, target: str, keys: Sequence[str] = ("file_date",)) -> int:
    """Take ``rows`` over into the daily table at ``target`` by key (SRC7, SRC8 across runs); the number of the version that holds them.

    A row replaces the one with its keys (NULL matches NULL); rows whose keys are not among the new ones stay. Of several new rows of a key the largest
    counts, column by column. The result is a new version beside the old one, and a version counts only when its line in the log is written: a run that
    fails at any point leaves the table as it was, and the next one writes the same version again. Rows that change nothing write nothing.
    """
    spark, k = rows.sparkSession, list(keys)
    rest = [c for c in rows.columns if c not in k]
    version = daily_versions(spark, target)
    old = read_daily(spark, target, version)

    def largest(df: DataFrame, mark: Sequence[str] = ()) -> DataFrame:
        """One row of each key: aggregates combine map-side."""
        best = df.groupBy(*k).agg(F.max(F.struct(*mark, *[F.col(f"`{c}`") for c in rest])).alias("__row"))
        return best.select(*k, *[F.col(f"__row.`{c}`").alias(c) for c in rest])

    merged = largest(rows)
    if old is not None:
        if merged.exceptAll(old.select(*merged.columns)).isEmpty():
            return version
        # the mark comes first, so a new row wins
        merged = largest(merged.withColumn("__new", F.lit(1)).unionByName(old.withColumn("__new", F.lit(0))), ["__new"])
    merged.write.mode("overwrite").parquet(os.path.join(target, f"v{version + 1}"))
    spark.createDataFrame([(version + 1,)], "version int").coalesce(1).write.mode("append").parquet(os.path.join(target, "log"))
    return version + 1
