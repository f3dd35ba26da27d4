"""Sharding by proportional stratified interleaving (operator 3), under the law ``rows``.

Within each source, rows are ranked in a seeded shuffle; a row's fractional rank is
(rank + u) / rows of its source, where u from 0 to 1 is a seeded number of the source: its phase.
So every source is spread evenly, and many small sources, even of a row each, are spread over all
shards like one large one instead of meeting in the middle. All rows are
sorted by fractional rank and cut into runs whose row counts differ by one at most. A shard
then holds each source's share of the rows to within a row or two.

A hot source is ranked in hash buckets of bounded size; only (id, source, size, checksum)
rows are shuffled, never texts.

Edge cases: a null text has size 1 and the checksum of no bytes; a null source is a stratum of
its own; texts of any length are measured whole; repeated rows are separate rows; fewer rows than shards leave shards empty; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydroframe.llm.common import rank_bits, rank_by_fraction, rank_in_group, text_or_empty

N_SHARDS = 16
SEED = 20260101


def stratified_shards(docs: DataFrame, n_shards: int = N_SHARDS, seed: int = SEED,
                      doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, text_crc32, law, shard, slot, grown_shard."""
    raw = F.encode(text_or_empty(text), "UTF-8")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"),
                       (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    rows = rows.withColumn("_key", F.xxhash64(F.lit(seed), "doc_id", "text_crc32"))
    n = docs.count()
    bits = rank_bits(n)
    ranked = rank_in_group(rows, "source", "_key", ["doc_id", "text_crc32", "size"], bits)
    phase = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit("phase"), "source"), 11) / float(1 << 53)
    ranked = ranked.withColumn("_fraction", (F.col("rank") + phase) / F.col("group_rows"))
    placed = rank_by_fraction(ranked, "_fraction", ["source", "_key", "doc_id", "text_crc32", "size"],
                              max(256, 1 << bits))
    base, more = divmod(n, n_shards)  # the first `more` shards take one row more
    head = more * (base + 1)
    pos = F.col("position")
    shard = F.when(pos < head, F.floor(pos / (base + 1))).otherwise(more + F.floor((pos - head) / max(1, base)))
    start = F.when(F.col("shard") < more, F.col("shard") * (base + 1)).otherwise(
        head + (F.col("shard") - more) * base)
    return (placed.withColumn("shard", shard.cast("int"))
            .select("doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    (pos - start).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
