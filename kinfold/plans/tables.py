"""Access to the benchmark tables (one parquet file or folder per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan that yields fewer partitions than the cluster has task slots.

    A small table stored as one row group is read by a single task, and every per-row step before the
    first shuffle then runs on one core. A large input already has at least as many partitions as slots,
    so at scale this returns ``df`` unchanged (no extra shuffle); rows and results are the same either way.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots)
    return df


def table(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = False) -> DataFrame:
    """The parquet table ``name`` as it is now; ``spread_rows`` applies ``spread`` (before per-row text work)."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return spread(df) if spread_rows else df
