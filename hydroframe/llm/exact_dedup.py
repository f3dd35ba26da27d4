"""Exact de-duplication with counting quotient filters (operator 7).

Every row's text is normalised (each run of blanks becomes one space) and hashed to a 64-bit
fingerprint. Each partition builds a counting quotient filter of its fingerprints: the high
half is the quotient, stored as sorted runs, the low half is the remainder, stored sorted
inside its run with a count. Filters merge without loss by merging sorted remainders and
adding counts, one range of quotients per group, so no task ever holds a whole filter.
Only rows whose fingerprint has a merged count above one are read again, and their bytes are
compared; everything else keeps its row without being moved.

Edge cases: a null text counts as empty; rows with equal doc_id and equal text count as
repeated rows, of which one stays; a null doc_id sorts after all others; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydroframe.llm.common import ready_workers, route, row_and, text_or_empty, written

RANGE_BITS = 12  # top bits of the quotient: 4096 ranges of the merged filter
BLANKS = r"[\x20\x09-\x0D]+"
FILTER_SCHEMA = "quotient_range int, quotients binary, run_lengths binary, remainders binary, counts binary"


def normalised(text: str = "text") -> F.Column:
    return F.regexp_replace(text_or_empty(text), BLANKS, " ")


def encode_filter(fingerprints: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    """Sorted distinct fingerprints -> quotients, run lengths, remainders, counts."""
    quotients, run_lengths = np.unique((fingerprints >> np.uint64(32)).astype("<u4"), return_counts=True)
    remainders = (fingerprints & np.uint64(0xFFFFFFFF)).astype("<u4")
    return (quotients.tobytes(), run_lengths.astype("<u4").tobytes(), remainders.tobytes(),
            counts.astype("<i8").tobytes())


def decode_filter(quotients: bytes, run_lengths: bytes, remainders: bytes, counts: bytes):
    high = np.repeat(np.frombuffer(quotients, "<u4"), np.frombuffer(run_lengths, "<u4")).astype(np.uint64)
    return ((high << np.uint64(32)) | np.frombuffer(remainders, "<u4"), np.frombuffer(counts, "<i8"))


def merge_sorted(fingerprints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge runs of sorted fingerprints; the counts of equal ones are added."""
    order = np.argsort(fingerprints, kind="stable")  # a merge sort: the input is sorted runs
    values, starts = np.unique(fingerprints[order], return_index=True)
    return values, np.add.reduceat(counts[order], starts) if len(values) else counts[:0]


def _partition_filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One filter row per quotient range and about a million fingerprints of the partition."""
    def emit(parts):
        every = np.concatenate(parts)
        values, counts = np.unique(every, return_counts=True)
        ranges = (values >> np.uint64(64 - RANGE_BITS)).astype(np.int32)
        cuts = np.flatnonzero(np.diff(ranges)) + 1
        rows = [(int(r[0]), *encode_filter(v, c)) for r, v, c in
                zip(np.split(ranges, cuts), np.split(values, cuts), np.split(counts, cuts))]
        return pa.RecordBatch.from_arrays(
            [pa.array(col, t) for col, t in zip(zip(*rows), [pa.int32()] + [pa.binary()] * 4)],
            names=["quotient_range", "quotients", "run_lengths", "remainders", "counts"])

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            size += batch.num_rows
        if size >= 1 << 20:
            yield emit(held)
            held, size = [], 0
    if size:
        yield emit(held)


def _merge_range(table: pa.Table) -> pa.Table:
    """Merge the filters of one quotient range; keep fingerprints with a count above one."""
    parts = [decode_filter(*(row[c] for c in ("quotients", "run_lengths", "remainders", "counts")))
             for row in table.to_pylist()]
    values, counts = merge_sorted(np.concatenate([p[0] for p in parts]),
                                  np.concatenate([p[1] for p in parts]))
    many = counts > 1
    return pa.table({"fp": pa.array(values[many].view(np.int64)), "fp_count": pa.array(counts[many])})


def repeated_fingerprints(fps: DataFrame) -> DataFrame:
    """Fingerprints (column ``fp``, long) that occur more than once, with their counts."""
    filters = fps.select("fp").mapInArrow(_partition_filters, FILTER_SCHEMA)
    return filters.groupBy("quotient_range").applyInArrow(_merge_range, "fp long, fp_count long")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    ready_workers(docs.sparkSession)
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), normalised(text).alias("_t"))
    keys = written(slim.select("doc_id", F.xxhash64("_t").alias("fp"), F.sha2("_t", 256).alias("sha"),
                               F.monotonically_increasing_id().alias("rid")), "fingerprints")
    repeated = repeated_fingerprints(keys)
    candidates = written(keys.join(repeated.select("fp"), "fp", "left_semi"), "candidates")

    # Byte verification: the whole texts of the candidates, grouped by their bytes.
    flagged = route(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_raw")),
                    "doc_id", candidates, "doc_id").where("_maybe or doc_id is null")
    texts = (flagged.select(normalised("_raw").alias("_t"))
             .groupBy(F.xxhash64("_t").alias("fp"), F.sha2("_t", 256).alias("sha"), "_t").agg(F.lit(1).alias("one")))
    verified = texts.groupBy("fp", "sha").agg(F.count("one").alias("variants"))
    keep = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")
    groups = (candidates.groupBy("fp", "sha").agg(F.min(keep).alias("keep"), F.count(F.lit(1)).alias("n"))
              .join(verified, ["fp", "sha"])
              .select("fp", "sha", F.col("keep.doc_id").alias("keep_id"), F.col("keep.rid").alias("keep_rid"),
                      F.when(F.col("variants") == 1, F.col("n"))
                      .otherwise(F.raise_error(F.lit("different texts share a SHA-256 digest"))).alias("n")))
    single = F.col("n").isNull()
    return (keys.join(groups, ["fp", "sha"], "left")
            .select("doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                    (single | (F.col("rid") == F.col("keep_rid"))).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that exact de-duplication drops, all columns kept.

    Rows that stay are not moved, but for those that share an id with a dropped row.
    """
    result = written(exact_groups(docs, doc_id, text), "exact")
    pairs = result.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("stays"),
                                                        F.count(F.lit(1)).alias("n"))
    pairs = written(pairs.where("not stays or n > 1"), "changed")
    own = row_and(docs, id=F.col(doc_id).cast("long"), sha=F.sha2(normalised(text), 256))
    routed = route(own, "id", pairs, "doc_id")
    sure = routed.where("not _maybe and id is not null")
    maybe = routed.where("_maybe or id is null")
    gone = pairs.where("not stays").select(F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone"))
    left = maybe.join(gone, maybe["id"].eqNullSafe(gone["gone_id"]) & (maybe["sha"] == gone["gone"]), "left_anti")
    return sure.select("row.*").unionByName(left.dropDuplicates(["id", "sha"]).select("row.*"))
