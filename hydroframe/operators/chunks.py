"""Time chunking and chunk merge.

Chunks are computed, not looped over: the chunk table comes from one ``sequence`` explode,
and rows are assigned to chunks by month arithmetic (an equi-key, no range join). Writing
with ``partitionBy("chunk_id")`` gives the per-chunk outputs; reading them back is one scan.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydroframe.sources.sinks import replace_whole

CHUNK_MONTHS = 3  # fixed value: the reference builds 3-month chunks


def _months_from(start: Column, d: Column) -> Column:
    return (F.year(d) - F.year(start)) * 12 + (F.month(d) - F.month(start))


def chunk_table(spark: SparkSession, bounds: DataFrame, months: int = CHUNK_MONTHS) -> DataFrame:
    """K1 + K2 from a one-row ``(start, end)`` table of dates.

    Chunk k starts on ``start`` (k = 0) or on the 1st of month ``start.month + 3k``; it ends
    on the last day of month ``start.month + 3k + 2``, trimmed to ``end``. Calendar-safe
    (Q15: a chunk starting in November or December rolls into the next year).
    """
    n = (F.floor(_months_from(F.col("start"), F.col("end")) / F.lit(months)) + 1).cast("int")
    k = F.col("chunk_id")
    first_of = F.trunc(F.add_months(F.col("start"), k * months), "MM")
    # Other columns of ``bounds`` (e.g. a job id) are carried, so many periods chunk at once.
    keep = [c for c in bounds.columns if c not in ("start", "end")]
    return (bounds.select(*keep, "start", "end", F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk_id"))
                  .select(*keep, "chunk_id",
                          F.when(k == 0, F.col("start")).otherwise(first_of).alias("chunk_start"),
                          F.least(F.last_day(F.add_months(F.col("start"), k * months + (months - 1))),
                                  F.col("end")).alias("chunk_end"))
                  .withColumn("chunk_label", F.concat_ws("_", F.date_format("chunk_start", "yyyyMMdd"),
                                                         F.date_format("chunk_end", "yyyyMMdd"))))


def period_bounds(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """A one-row ``(start, end)`` table from job parameters."""
    return spark.createDataFrame([(start, end)], "start date, end date")


def data_bounds(df: DataFrame, time_col: str = "time") -> DataFrame:
    """A one-row ``(start, end)`` table spanning the data (one partial aggregate)."""
    return df.agg(F.to_date(F.min(time_col)).alias("start"), F.to_date(F.max(time_col)).alias("end"))


def chunk_of(time_col: str, start: dt.date, months: int = CHUNK_MONTHS) -> Column:
    """K4: chunk id of a row, from its month offset to the period start (no join)."""
    return F.floor(_months_from(F.lit(start), F.to_date(F.col(time_col))) / F.lit(months)).cast("int")


def assign_chunks(df: DataFrame, start: dt.date, end: dt.date, time_col: str = "time",
                  months: int = CHUNK_MONTHS) -> DataFrame:
    """K4: rows of ``[start, end]`` tagged with their chunk id."""
    d = F.to_date(F.col(time_col))
    return (df.filter((d >= F.lit(start)) & (d <= F.lit(end)))
              .withColumn("chunk_id", chunk_of(time_col, start, months)))


def chunk_rollup(tagged: DataFrame, time_col: str = "time") -> DataFrame:
    """J2 + D13 per chunk: rows and time steps of each chunk."""
    return tagged.groupBy("chunk_id").agg(F.count("*").alias("n_rows"),
                                          F.count_distinct(time_col).alias("n_times"),
                                          F.min(time_col).alias("first_time"),
                                          F.max(time_col).alias("last_time"))


def write_chunks(tagged: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4 sink + B6: one folder per chunk that has rows (``chunk_id=k``), zstd parquet.

    ``overwrite`` replaces the whole result once the new one is complete; ``chunks`` replaces
    only the chunks that ``tagged`` holds (dynamic partition overwrite, staged by the committer).
    Either way an aborted write leaves the old result readable. Rows are rebalanced by chunk,
    so files follow the chunks and AQE splits a hot chunk.
    """
    spread = tagged.hint("rebalance", "chunk_id")

    def write(to: str, how: str) -> None:
        (spread.write.mode(how).partitionBy("chunk_id").option("compression", "zstd")
         .option("partitionOverwriteMode", "dynamic" if how == "overwrite" else "static").parquet(to))

    if mode == "overwrite":
        replace_whole(tagged.sparkSession, path, lambda new: write(new, "errorifexists"))
    elif mode == "chunks":
        write(path, "overwrite")
    else:
        raise ValueError(f"mode {mode!r} is neither 'overwrite' nor 'chunks'")


def read_chunks(spark: SparkSession, base: str, schema=None) -> DataFrame:
    """A19 + J2: the chunk folders that exist, read back in one lazy scan (``chunk_id`` is
    recovered from the folder names; a chunk without rows has no folder). The written
    schema allows a period without any rows."""
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(base)


def write_by_month(df: DataFrame, path: str, time_col: str = "time") -> None:
    """A12 + K4 sink: rows partitioned by calendar month, the unit that chunks are made of."""
    tagged = df.withColumn("month", F.to_date(F.trunc(F.to_date(time_col), "MM")))
    tagged.hint("rebalance", "month").write.partitionBy("month").option("compression", "zstd").parquet(path)


def chunk_months(chunk_rows: DataFrame) -> DataFrame:
    """The months of chunks (rows of ``chunk_table``): (chunk_id, chunk_start, chunk_end, month)."""
    months = F.sequence(F.trunc("chunk_start", "MM"), F.trunc("chunk_end", "MM"), F.expr("INTERVAL 1 MONTH"))
    return chunk_rows.select("chunk_id", "chunk_start", "chunk_end", F.explode(months).alias("month"))


def rows_of_chunks(cube: DataFrame, chunk_rows: DataFrame, time_col: str = "time") -> DataFrame:
    """A12 + K4: the rows of some chunks of a month-partitioned cube, with their chunk id.

    The months of the chunks reach the scan when the query runs (dynamic partition pruning), so
    only their folders are listed and read. The months side is bounded by the period: broadcast.
    """
    day = F.to_date(F.col(time_col))
    return (cube.join(F.broadcast(chunk_months(chunk_rows)), "month")
            .filter((day >= F.col("chunk_start")) & (day <= F.col("chunk_end")))
            .drop("chunk_start", "chunk_end", "month"))


def concat_chunks(parts: list[DataFrame]) -> DataFrame:
    """Concatenate chunk cubes along time, no dedupe."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def concat_dedupe(parts: list[DataFrame], keys: list[str] | None = None) -> DataFrame:
    """Concatenate and drop duplicate rows (or duplicate keys)."""
    u = concat_chunks(parts)
    return u.dropDuplicates(keys) if keys else u.dropDuplicates()


def merge_static_forcing(static_tagged: DataFrame, forcing_tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Static maps from the first chunk only; forcing from all chunks."""
    first = static_tagged.agg(F.min("chunk_id").alias("chunk_id"))
    return static_tagged.join(F.broadcast(first), "chunk_id"), forcing_tagged
