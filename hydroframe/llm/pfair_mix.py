"""Mixing sources to target weights by Pfair scheduling (operator 4, native).

Each source's rows are shuffled by a seeded hash and cut into blocks of ``block_rows``. With
integer parts a_i of a total H, block k of source i is released at floor(k H / a_i) and due by
ceil((k + 1) H / a_i); at every slot the released block with the earliest deadline is placed.
On one sequence of slots this meets all deadlines, so after t slots a source has had within
one block of t a_i / H. The schedule repeats after H slots, so one period, whose length is the
sum of the target parts, places any number of blocks by arithmetic. When a source runs out, the
others go on with their parts in the same proportion: a new phase, at most one per source.

A stream is a source. Where a table has more than ``MAX_STREAMS`` sources, those without a
target form one stream together, with as many parts as all targets have; their rows are in the
order of one seeded shuffle, so inside the stream each comes in proportion to its rows. So the plan's size
follows the targets, never the number of sources.

Placing needs (id, stream, hash) rows only. :func:`in_mix_order` then moves each whole row once: the
hash decides the row's stream rank to within a bucket, and with the few keys at which output
ranges begin, the range it belongs to; ranks are completed inside the range.

Edge cases: a source without a target has ``default_part`` parts; a null source is a source of
its own; texts of any length are hashed whole; repeated rows (one id and text) are separate rows,
and where an output range begins among them all of them come in it; an empty table gives an empty result; other columns are ignored, and kept by
:func:`in_mix_order`, whatever their names.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydroframe.llm.common import rank_bits, rank_in_group, row_and, text_or_empty, top_bits, written

BLOCK_ROWS = 64
SEED = 20260102
# Target parts of the production mixture; sources not named take the default.
TARGET_PARTS: dict[str | None, int] = {"src0": 4, "src1": 3, "src2": 3, "src3": 3}
DEFAULT_PART = 1
MAX_STREAMS = 64      # sources with a place of their own in the plan
ROWS_A_RANGE = 10_000  # rows of one output range, while there are at most MAX_RANGES
MAX_RANGES = 20_000


def edf_period(parts: list[int]) -> list[int]:
    """Source index per slot of one period: earliest deadline first among released blocks.

    Ties go to the smaller index. Slot t is (t, t + 1]; a block is released at its window's start.
    """
    total, done, slots = sum(parts), [0] * len(parts), []
    for t in range(total):
        due = min((-(-(done[i] + 1) * total // a), i) for i, a in enumerate(parts)
                  if done[i] < a and done[i] * total < (t + 1) * a)
        done[due[1]] += 1
        slots.append(due[1])
    return slots


def plan(blocks: Mapping[int, int], target: Mapping[int, int], default: int) -> list[dict]:
    """Phases of the mixture: in each, the active sources follow one period again and again.

    A row per (phase, source): first block, first slot, parts, period length and the places of
    the source's blocks in a period. A phase ends with the last block of the first source out.
    """
    left = {s: n for s, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    rows, start, phase = [], 0, 0
    while left:
        names = sorted(left)
        parts = [target.get(s, default) for s in names]
        slots = edf_period(parts)
        places = [[t for t, i in enumerate(slots) if i == k] for k in range(len(names))]
        period = len(slots)
        end = min((left[s] - 1) // a * period + p[(left[s] - 1) % a] + 1
                  for s, a, p in zip(names, parts, places))
        for s, a, p in zip(names, parts, places):
            rows.append({"phase": phase, "source": s, "first_block": done[s], "first_slot": start,
                         "parts": a, "period": period, "places": p})
            used = end // period * a + sum(x < end % period for x in p)
            done[s] += used
            left[s] -= used
        left = {s: n for s, n in left.items() if n}
        start, phase = start + end, phase + 1
    return rows


class Mixture:
    """The streams of a table, their row counts and the plan that places their ranks.

    Everything here has the size of the plan: streams, phases and slots of a period.
    """

    def __init__(self, docs: DataFrame, target: Mapping[str | None, int] | None, default_part: int, block_rows: int,
                 source: str, max_streams: int):
        target = TARGET_PARTS if target is None else target
        self.block_rows = block_rows
        name = F.col(f"`{source}`").cast("string")
        found = docs.select(name.alias("s")).groupBy("s").count().limit(max_streams + 1).collect()
        parts = {(r["s"],): target.get(r["s"], default_part) for r in found}
        self.rest = len(found) > max_streams
        if self.rest:
            parts = {(s,): p for s, p in target.items()} | {(): max(1, sum(target.values()))}
        # streams in a fixed order: null first, then by name, the rest last
        self.keys = sorted(parts, key=lambda k: (not k, bool(k) and k[0] is not None, k[0] or "" if k else ""))
        self.source = name
        counts = {r["i"]: r["count"] for r in docs.select(self.stream().alias("i")).groupBy("i").count().collect()}
        self.counts = {i: n for i, n in counts.items() if n}
        self.phases = plan({i: -(-n // block_rows) for i, n in self.counts.items()}, {i: parts[k] for i, k in enumerate(self.keys)}, default_part)
        self.rows = sum(self.counts.values())

    def stream(self) -> Column:
        """The number of a row's stream."""
        out = F.lit(len(self.keys) - 1)  # with a rest it is the last one; without, every source is named
        for i, k in enumerate(self.keys):
            if k:
                out = F.when(self.source.eqNullSafe(F.lit(k[0])), i).otherwise(out)
        return out.cast("int")

    def places(self, stream: str, rank: str) -> dict[str, Column]:
        """block, phase, slot, slot_row and mix_position of a rank in a stream."""
        kind = "array<struct<first_block:bigint,phase:int,first_slot:bigint,parts:int,period:int,places:array<int>>>"
        of: dict[int, list] = {}
        for p in self.phases:
            of.setdefault(p["source"], []).append({k: p[k] for k in ("first_block", "phase", "first_slot", "parts", "period", "places")})
        n = self.block_rows
        block = F.floor(F.col(rank) / n).cast("long")
        none = F.from_json(F.lit("[]"), kind)
        own = none
        for i, rows in of.items():
            own = F.when(F.col(stream) == i, F.from_json(F.lit(json.dumps(rows)), kind)).otherwise(own)
        found = F.element_at(F.filter(own, lambda p: p["first_block"] <= block), -1)
        # Only the last block of a stream can be short: rows missing before a slot, one entry a stream.
        ends = {}
        for p in self.phases:
            last = -(-self.counts[p["source"]] // n) - 1
            if p["first_block"] <= last:
                k = last - p["first_block"]
                ends[p["source"]] = p["first_slot"] + k // p["parts"] * p["period"] + p["places"][k % p["parts"]]
        short = [{"slot": ends[i], "rows": -c % n} for i, c in self.counts.items() if -c % n]
        gaps = F.from_json(F.lit(json.dumps(short)), "array<struct<slot:bigint,rows:bigint>>")
        k = F.col("block") - F.col("_phase.first_block")
        slot = (F.col("_phase.first_slot") + F.floor(k / F.col("_phase.parts")) * F.col("_phase.period")
                + F.get(F.col("_phase.places"), (k % F.col("_phase.parts")).cast("int")))
        missing = F.aggregate(gaps, F.lit(0).cast("long"),
                              lambda acc, g: acc + F.when(g["slot"] < F.col("slot"), g["rows"]).otherwise(F.lit(0)))
        return {"block": block, "_phase": found, "slot_row": (F.col(rank) % n).cast("int"), "slot": slot.cast("long"),
                "phase": F.col("_phase.phase"), "mix_position": F.col("slot") * n + F.col("slot_row") - missing}

    def place(self, ranked: DataFrame, stream: str, rank: str) -> DataFrame:
        for name, column in self.places(stream, rank).items():
            ranked = ranked.withColumn(name, column)
        return ranked.drop("_phase")


def _key(seed: int, doc_id: Column, crc: Column) -> Column:
    return F.xxhash64(F.lit(seed), doc_id, crc)


def _crc(text: str) -> Column:
    return F.crc32(F.encode(text_or_empty(F.col(f"`{text}`")), "UTF-8"))


def _placed(docs: DataFrame, mix: Mixture, seed: int, doc_id: str, text: str) -> DataFrame:
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), mix.source.alias("source"), mix.stream().alias("stream"),
                       _crc(text).alias("text_crc32"))
    rows = rows.withColumn("_key", _key(seed, F.col("doc_id"), F.col("text_crc32")))
    ranked = rank_in_group(rows, "stream", "_key", ["doc_id", "text_crc32"], rank_bits(mix.rows))
    return mix.place(ranked, "stream", "rank")


def pfair_mix(docs: DataFrame, target: Mapping[str | None, int] | None = None, default_part: int = DEFAULT_PART,
              block_rows: int = BLOCK_ROWS, seed: int = SEED, doc_id: str = "doc_id",
              text: str = "text", source: str = "source", max_streams: int = MAX_STREAMS) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, block, phase, slot, slot_row, mix_position, text_crc32.

    Sorted by (slot, slot_row), which is mix_position, the mixture holds at every prefix.
    """
    mix = Mixture(docs, target, default_part, block_rows, source, max_streams)
    return _placed(docs, mix, seed, doc_id, text).select(
        "doc_id", "source", "block", "phase", "slot", "slot_row", "mix_position", "text_crc32")


def in_mix_order(docs: DataFrame, target: Mapping[str | None, int] | None = None, default_part: int = DEFAULT_PART,
                 block_rows: int = BLOCK_ROWS, seed: int = SEED, doc_id: str = "doc_id", text: str = "text",
                 source: str = "source", max_streams: int = MAX_STREAMS, range_rows: int = ROWS_A_RANGE) -> DataFrame:
    """All rows and columns of ``docs``, in partitions and rows sorted by mix position.

    One exchange carries the whole rows. Within a stream, rank follows the (unsigned) hash, so an
    output range takes a range of hashes from every stream. A table of (stream, top bits of the
    hash) names the range, and the hashes inside those bits at which further ranges begin; it has
    some four entries a range and stream, a bound that the plan and ``MAX_RANGES`` set.
    """
    mix = Mixture(docs, target, default_part, block_rows, source, max_streams)
    if not mix.rows:
        return docs
    ranges = min(MAX_RANGES, max(1, -(-mix.rows // range_rows)))
    bits = max(2, (4 * ranges - 1).bit_length())
    order = F.col("_key").bitwiseXOR(F.lit(-(1 << 63)))  # signed order of this is unsigned order of the hash
    slim = written(_placed(docs, mix, seed, doc_id, text).select(
        "stream", "_key", order.alias("_u"), "mix_position"), "mix")
    due = slim.select("stream", "_u", F.floor(F.col("mix_position") * ranges / mix.rows).cast("int").alias("part"))
    starts = due.groupBy("stream", "part").agg(F.min("_u").alias("_u"))
    top = lambda u: top_bits(u.bitwiseXOR(F.lit(-(1 << 63))), bits)
    # the range that holds a bucket's first hash is the last one to start before the bucket
    marks = starts.select("stream", top(F.col("_u")).alias("bucket"), "_u", "part")
    grid = docs.sparkSession.range(1 << bits).select(F.explode(F.sequence(F.lit(0), F.lit(len(mix.keys) - 1))).alias("stream"), F.col("id").alias("bucket"))
    cuts = grid.join(marks.groupBy("stream", "bucket").agg(F.sort_array(F.collect_list(F.struct("_u", "part"))).alias("cuts"),
                                                           F.max("part").alias("top")), ["stream", "bucket"], "left")
    before = Window.partitionBy("stream").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cuts = written(cuts.select(F.col("stream").alias("_stream"), F.col("bucket").alias("_bucket"), "cuts",
                               F.coalesce(F.max("top").over(before), F.lit(0)).alias("first")), "cuts")

    def with_part(df: DataFrame) -> DataFrame:
        at = df.join(F.broadcast(cuts), (F.col("stream") == F.col("_stream")) & (top(F.col("_u")) == F.col("_bucket")))
        started = F.filter(F.coalesce("cuts", F.array().cast("array<struct<_u:bigint,part:int>>")), lambda c: c["_u"] <= F.col("_u"))
        return (at.withColumn("part", F.coalesce(F.get(started, F.size(started) - 1)["part"], "first"))
                .drop("_stream", "_bucket", "cuts", "first"))

    # rows of a stream in earlier ranges: the rank of a range's first row
    sizes = with_part(slim.select("stream", "_u")).groupBy("stream", "part").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("stream").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = written(sizes.select(F.col("stream").alias("_stream"), F.col("part").alias("_part"),
                                F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base")), "bases")

    own = row_and(docs, id=F.col(f"`{doc_id}`").cast("long"), crc=_crc(text), stream=mix.stream())
    own = own.withColumn("_u", _key(seed, F.col("id"), F.col("crc")).bitwiseXOR(F.lit(-(1 << 63))))
    moved = with_part(own).repartitionById(ranges, "part")
    inside = Window.partitionBy("part", "stream").orderBy("_u", "id", "crc")
    ranked = (moved.withColumn("_n", F.row_number().over(inside))
              .join(F.broadcast(base), (F.col("stream") == F.col("_stream")) & (F.col("part") == F.col("_part")))
              .withColumn("rank", F.col("base") + F.col("_n") - 1))
    return mix.place(ranked, "stream", "rank").sortWithinPartitions("mix_position").select("row.*")
