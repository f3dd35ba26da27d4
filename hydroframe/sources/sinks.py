"""Sinks (A16, B1-B7): parquet for vectors and cubes, CSV for series, write-back checks."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hydroframe.session import ensure_checkpoint_dir

STATION_SCHEMA = T.StructType([
    T.StructField("grdc_no", T.LongType()), T.StructField("river", T.StringType()),
    T.StructField("station", T.StringType()), T.StructField("country", T.StringType()),
    T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()),
    T.StructField("area", T.DoubleType()), T.StructField("altitude", T.DoubleType()),
])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder for job outputs under the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark)}/outputs/{name}"


def write_vector(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """B1: a feature table with nested-array geometry, as parquet."""
    df.write.mode(mode).parquet(path)


def write_cube(df: DataFrame, path: str, value_cols: list[str], day_col: str = "day",
               mode: str = "overwrite", sort_cols: tuple = ("lat", "lon")) -> None:
    """B2: a cube partitioned by day, values as float32, zstd.

    Rows are rebalanced by day first, so there are about as many files as days; AQE splits
    a day that holds many rows over several tasks. Within each task rows are sorted by
    ``lat, lon``, so every file's row groups cover narrow coordinate ranges and an extent
    filter on a later read skips row groups from their min/max statistics.
    """
    out = df.withColumns({c: F.col(c).cast("float") for c in value_cols}).hint("rebalance", day_col)
    keys = [c for c in (day_col, *sort_cols) if c in out.columns]
    if keys:
        out = out.sortWithinPartitions(*keys)
    out.write.mode(mode).partitionBy(day_col).option("compression", "zstd").parquet(path)


def empty_result(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table with the full schema."""
    return spark.createDataFrame([], schema)


def write_series_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A time series as CSV with a header (one file per task; no single-task funnel)."""
    df.write.mode(mode).option("header", True).csv(path)


def read_stations(spark: SparkSession, path: str, schema: T.StructType = STATION_SCHEMA) -> DataFrame:
    """Station CSV with a fixed header; an empty table with the schema if absent.

    Spark's reader looks the path up in its own filesystem, so one rule holds for all schemes.
    """
    try:
        return spark.read.schema(schema).option("header", True).csv(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_result(spark, schema)


def replace_whole(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Replace the table at ``path`` only when its successor is complete.

    ``write`` writes the new table to the folder it is given. If that fails, the old table is
    as it was; if it succeeds, two renames put the new one in its place and the old one is deleted.
    """
    jvm = spark._jvm
    token = uuid.uuid4().hex
    here, new, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.new-{token}", f"{path}.old-{token}"))
    fs = here.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        write(new.toString())
    except BaseException:
        fs.delete(new, True)
        raise
    had = fs.exists(here)
    if had and not fs.rename(here, old):
        raise OSError(f"{path} cannot be renamed")
    if not fs.rename(new, here):
        if had:
            fs.rename(old, here)
        raise OSError(f"{path} cannot be replaced")
    fs.delete(old, True)


def read_with_footers(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet files through Spark's second data source interface, which answers count, min and
    max without a filter from the files' footers (``spark.sql.parquet.aggregatePushdown``)."""
    key = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(key)
    spark.conf.set(key, ",".join(x for x in before.split(",") if x != "parquet"))
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    finally:
        spark.conf.set(key, before)


def write_back_check(spark: SparkSession, path: str, range_cols: list[str],
                     schema: T.StructType | None = None) -> DataFrame:
    """Re-read what was written, list its columns, count it and report min/max of some columns.

    The figures come from the file footers; no data page is read. Pass the written schema to
    check outputs that may be empty (no data files to infer from).
    """
    back = read_with_footers(spark, path, schema)
    aggs = [F.count("*").alias("n_rows")]
    for c in range_cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return back.agg(*aggs).withColumn("columns", F.lit(",".join(sorted(back.columns))))
