"""Helpers shared by the operators: table reads, written intermediates, ranks, id routing."""

from __future__ import annotations

import math
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hydroframe.session import ensure_checkpoint_dir, ship_package
from hydroframe.sources.tables import read_table

# Rows per Arrow batch sent to Python workers: texts may be long, so batches are small.
ARROW_ROWS = 1000
# Routing bitmaps have a fixed size: 2**26 bits are 2048 rows of 4 kB, 8 MB when broadcast.
ROUTE_BITS = 26
_BITMAP_BITS = 15  # bits of one bitmap of Spark's bitmap functions (32768 positions)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def ready_workers(spark: SparkSession) -> None:
    """Send the package to the Python workers and bound the rows per Arrow batch, as texts are long."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet below the shared checkpoint folder, read it back.

    A lost executor then costs the tasks it ran, never the steps before this table.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_row_order(df: DataFrame, *cols: Column) -> DataFrame:
    """The given columns, and ``file`` (text) and ``row`` (long) that sort the rows as they were written.

    A scan deals files to its tasks by size, so the order is read from the names of the files,
    which the writing job numbers, and the places of the rows in them. A table that is no scan
    of files is in the order of its partitions.
    """
    try:
        return df.select(*cols, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    except AnalysisException:
        return df.select(*cols, F.lpad(F.spark_partition_id().cast("string"), 10, "0").alias("file"),
                         F.monotonically_increasing_id().alias("row"))


def text_or_empty(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(""))


def top_bits(key: Column, bits: int) -> Column:
    """The top ``bits`` bits of a 64-bit hash as a number from 0."""
    return F.shiftrightunsigned(key, 64 - bits)


def rank_bits(rows: int, per_bucket: int = 20_000) -> int:
    """Bits so that a hash bucket holds about ``per_bucket`` rows (64 buckets at least)."""
    return max(6, math.ceil(math.log2(max(1, rows) / per_bucket))) if rows else 6


def rank_in_group(df: DataFrame, group: str, key: str, ties: list[str], bits: int,
                  out: str = "rank", total: str = "group_rows") -> DataFrame:
    """Rank rows from 0 within ``group`` by the hash ``key`` (unsigned), ties by ``ties``.

    A group may hold any share of the rows: each is cut by the top bits of the hash into
    buckets of a bounded size, buckets are ranked separately and shifted by the rows of the
    buckets before. Adds ``out`` and the group's row count ``total``. ``group`` may be null.
    """
    b = df.withColumn("_bucket", top_bits(F.col(key), bits))
    sizes = b.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col(group).alias("_g"), F.col("_bucket").alias("_b"),
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                         F.sum("_n").over(Window.partitionBy(group)).alias(total))
    joined = b.join(sizes, b[group].eqNullSafe(sizes["_g"]) & (b["_bucket"] == sizes["_b"]))
    own = Window.partitionBy(group, "_bucket").orderBy(key, *ties)
    return (joined.withColumn(out, F.row_number().over(own) - 1 + F.col("_before"))
            .drop("_bucket", "_g", "_b", "_before"))


def rank_by_fraction(df: DataFrame, fraction: str, order: list[str], buckets: int,
                     out: str = "position") -> DataFrame:
    """Rank all rows from 0 by ``fraction`` (0 <= f < 1, spread evenly), then by ``order``.

    Rows are cut into ``buckets`` equal ranges of the fraction; only the table of bucket sizes
    (``buckets`` rows) meets in one task.
    """
    b = df.withColumn("_bucket", F.floor(F.col(fraction) * buckets))
    sizes = b.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("_bucket").alias("_b"),
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("_bucket").orderBy(fraction, *order)
    joined = b.join(sizes, b["_bucket"] == sizes["_b"])
    return (joined.withColumn(out, F.row_number().over(own) - 1 + F.col("_before"))
            .drop("_bucket", "_b", "_before"))


def _route_hash(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key.cast("string")), 64 - bits)


def route(df: DataFrame, key: str, keys: DataFrame, keys_col: str,
          bits: int = ROUTE_BITS) -> DataFrame:
    """Add ``_maybe``: false only if the row's ``key`` is certainly not among ``keys``.

    The keys set bits of a bitmap of fixed size (``bits``), which is broadcast whatever the
    number of keys; a row whose bit is set may be a false positive, so an exact join has to
    follow on the routed rows. Rows that need no join are never shuffled.
    """
    h = _route_hash(F.col(keys_col), bits)
    maps = (keys.select(F.shiftright(h, _BITMAP_BITS).alias("_part"),
                        h.bitwiseAND((1 << _BITMAP_BITS) - 1).alias("_pos"))
            .groupBy("_part").agg(F.bitmap_construct_agg("_pos").alias("_map")))
    own = df.withColumn("_h", _route_hash(F.col(key), bits))
    own = own.withColumn("_p", F.shiftright("_h", _BITMAP_BITS))
    at = F.col("_h").bitwiseAND((1 << _BITMAP_BITS) - 1)
    byte = F.conv(F.hex(F.expr("substring(_map, cast(_at / 8 as int) + 1, 1)")), 16, 10).cast("int")
    bit = F.expr("cast(_at % 8 as int)")
    joined = own.join(F.broadcast(maps), F.col("_p") == F.col("_part"), "left").withColumn("_at", at)
    hit = F.call_function("shiftright", byte, bit).bitwiseAND(1) == 1
    return (joined.withColumn("_maybe", F.coalesce(hit, F.lit(False)))
            .drop("_h", "_p", "_part", "_map", "_at"))


def row_and(docs: DataFrame, **cols: Column) -> DataFrame:
    """The whole row as the struct ``row`` beside the given columns, so that no name can clash.

    ``select("row.*")`` gives the rows back.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       *[c.alias(n) for n, c in cols.items()])


def hash_fraction(key: str) -> Column:
    """A number from 0 to 1 that a hash of the column sets: rows below a share are a fixed sample."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(77), F.col(key)), 11) / float(1 << 53)


def without_ids(docs: DataFrame, key: str, drop: DataFrame, drop_col: str) -> DataFrame:
    """Rows of ``docs`` whose ``key`` is not in ``drop``; rows that stay are mostly not moved.

    Null keys stay.
    """
    routed = route(docs, key, drop, drop_col)
    sure = routed.where(~F.col("_maybe")).drop("_maybe")
    ids = drop.select(F.col(drop_col).alias("_drop_id"))
    maybe = routed.where(F.col("_maybe")).drop("_maybe")
    left = maybe.join(ids, maybe[key] == ids["_drop_id"], "left_anti")
    return sure.unionByName(left)
