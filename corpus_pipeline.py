"""From raw documents to packed training sequences: five stages, each calling one operator of ``kinfold.llm``.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns
of ``documents``. ``run`` applies them to the table, with each stage's result written before the next reads it.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.batches import crc_bucket, written
from kinfold.llm.decontam import decontaminate
from kinfold.llm.langid import identify
from kinfold.llm.packing import pack
from kinfold.llm.secret_scan import scan_secrets
from kinfold.llm.simhash import near_duplicates

#: No DuckDB SQL expresses the trained model or the packing; the tests compare the stages with brute force.
ORACLE_SQL = None


#: Number of a row in its stage: ids may be NULL or repeat.
ROW = "_row_number"


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number for each row, written so that the numbers stay."""
    return written(docs.withColumn(ROW, F.monotonically_increasing_id()))


def _keep(docs: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """The ``columns`` of the rows of ``docs`` whose number is in ``rows``."""
    return docs.join(rows.select(ROW), ROW, "left_semi").select(*[F.col(f"`{c}`") for c in columns])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts of no learned language."""
    known = identify(docs, docs.where(crc_bucket("doc_id", 5) != 0), carry=True)
    return known.where("known").select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest doc_id (NULL last), once."""
    rows = _numbered(docs)
    groups = near_duplicates(rows, id_col=ROW, shingle_words=3, radius=2).select(ROW, F.col("component_id").alias("_group"))
    ids = rows.select(ROW, F.col("doc_id").alias("_id"))
    first = groups.join(ids, ROW).groupBy("_group").agg(F.min(F.struct(F.col("_id").isNull(), "_id", ROW)).alias("_first"))
    return _keep(rows, first.select(F.col(f"_first.{ROW}").alias(ROW)), docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more stands in benchmark windows."""
    benchmark = spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet"))
    rows = _numbered(docs)
    return _keep(rows, decontaminate(rows, benchmark, id_col=ROW, window_words=13, one_in=20).where(~F.col("contaminated")), docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts by a mark and corrects n_chars; all documents stay."""
    found = scan_secrets(docs, carry=True)
    new = {"text": F.coalesce("redacted", "row.text"), "n_chars": F.when(F.col("redacted").isNull(), F.col("row.n_chars")).otherwise(F.length("redacted")).cast("long")}
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 1024 tokens."""
    return pack(docs, capacity=1024, end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("best_fit_packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = written(docs)
    return docs
