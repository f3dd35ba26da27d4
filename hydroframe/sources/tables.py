"""Parquet table scans (A19, A20): lazy, column-pruned, predicates pushed to the scan."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, spread_small: bool = False) -> DataFrame:
    """Scan one parquet table. Projections and filters applied later reach the scan."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return spread(df) if spread_small else df


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Give a scan at least as many partitions as the cluster has task slots.

    A file with one row group is one split, so every per-row stage above it would run in a
    single task. Such a scan is spread round-robin over ``defaultParallelism`` partitions;
    a large input (more splits than slots, the normal case at scale) is left untouched.
    Worth its round-robin shuffle only when the per-row work is CPU-heavy (JSON, geometry);
    for plain filters and aggregates a single-split scan is cheaper left alone (measured).
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
