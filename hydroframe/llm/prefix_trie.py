"""Prefix trie of conversations, screened by a count-min sketch of prefix digests.

Conversations are rebuilt first: the first h turns of the conversation that opens the block of
``BLOCK_IDS`` ids, then the conversation's own turns after its first h (h is a checksum of the id,
modulo ``HEAD_TURNS``). A node of the trie is a distinct sequence of first d rebuilt turns.

Method. Every rebuilt turn gets the digest of its prefix (two 64-bit halves, the xor of hashes of
(position, turn), so that a prefix is a running xor). All digests are counted in a count-min
sketch of two rows whose counters stop at two. An estimate of one proves that a prefix has a
single member; as every longer prefix then has one too, these rows (the tail of a conversation)
become nodes where they stand. Only rows that may be shared are shuffled and grouped by the whole
digest, so a false alarm of the sketch costs a shuffled row and changes no result.

Sums over subtrees need no walk. Each node belongs to its smallest member; a conversation's nodes
form one path. With T(c) the sum of (members - 1) * words over the path of c and L(c) = 1 if that
path ends in a leaf, a node's saved tokens are the sum of T over its members less what its own
path has above it, and its leaves are the sum of L over its members.

Scale. Texts are read once and never moved; a turn travels as its digest. Turns are ranked in
pieces of a range partitioning by (conversation, turn), so one conversation may hold any share of
the rows. The sketch's bitmaps are at most 2 * 2**``MAX_CELL_BITS`` bits (32 MB) when broadcast,
whatever the input; beyond that more rows take the exact path. ``ends_sha256`` hashes the ids of
a node's ends in order, which SHA-256 allows one after the other only: ids are sorted and joined
in many tasks, and one task streams a node's joined pieces through the hash without holding them.

Edge cases. Null role or text: empty. Null turn: first. Turns equal in ``turn``: ordered by their
digest, a fixed order that ids and partitions do not change; equal rows repeat the turn. Rows
without ``conv_id`` belong to no conversation. Empty table: no rows, not even the root. Texts of
any length count whole. Columns other than conv_id, turn, role and text are not read. For
negative ids, remainders have the sign of the id, as in SQL.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydroframe.llm.common import ready_workers, text_or_empty, written

BLOCK_IDS = 20   # conversations of one block share the block's opening conversation
HEAD_TURNS = 4   # h is below this
WORD = r"[^\x20\x09-\x0D]+"
CELLS_A_ROW = 8  # sketch cells for each counted prefix, until MAX_CELL_BITS
MIN_CELL_BITS, MAX_CELL_BITS = 15, 27
_MAP_BITS = 15   # bits of one bitmap of Spark's bitmap functions
_NODE = ["p1", "p2", "depth"]
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _signed(hex16: Column) -> Column:
    return F.conv(hex16, 16, -10).cast("long")


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, t1, t2, words): a turn as two halves of a digest and the words of its text."""
    role, text = text_or_empty(F.col("role")), text_or_empty(F.col("text"))
    sha = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return (conversations.where("conv_id IS NOT NULL")
            .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", sha.alias("sha"),
                    F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
            .select("conv_id", "turn", _signed(F.substring("sha", 1, 16)).alias("t1"),
                    _signed(F.substring("sha", 17, 16)).alias("t2"), "words"))


def _step(half: int, depth: Column, t1: Column, t2: Column) -> Column:
    return F.xxhash64(F.lit(half), depth, t1, t2)


def _running(head: Column, half: int) -> Column:
    """The prefix digests of an array of turns."""
    steps = F.transform(head, lambda t: _step(half, t["j"].cast("long"), t["t1"], t["t2"]))
    return F.transform(steps, lambda _, i: F.aggregate(F.slice(steps, F.lit(1), i + 1), F.lit(0).cast("long"),
                                                       lambda a, x: a.bitwiseXOR(x)))


def _lead(df: DataFrame, key: str, order: str, value: Column, out: str) -> DataFrame:
    """The total of ``value`` over a key's rows with a smaller ``order`` (few rows a key)."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.coalesce(value.over(w), F.lit(0)))


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations as (conv_id, length), and their turns as
    (conv_id, depth, p1, p2, q1, q2, words, is_end): p is the digest of the prefix, q its parent's."""
    ordered = _turns(conversations).repartitionByRange("conv_id", F.col("turn").asc_nulls_first(), "t1", "t2")
    pieces = written(ordered.withColumn("piece", F.spark_partition_id()), "turn-pieces")
    own = Window.partitionBy("conv_id", "piece").orderBy(F.col("turn").asc_nulls_first(), "t1", "t2")

    counts = _lead(pieces.groupBy("conv_id", "piece").agg(F.count(F.lit(1)).alias("n")), "conv_id", "piece", F.sum("n"), "before")
    heads = (pieces.where(F.col("conv_id") % BLOCK_IDS == 0).withColumn("j", F.row_number().over(own))
             .where(F.col("j") < HEAD_TURNS)  # of each piece; the few of a later piece are ruled out below
             .join(counts.select("conv_id", "piece", "before"), ["conv_id", "piece"])
             .withColumn("j", F.col("j") + F.col("before")).where(F.col("j") < HEAD_TURNS)
             .groupBy(F.col("conv_id").alias("block"))
             .agg(F.array_sort(F.collect_list(F.struct("j", "t1", "t2", "words"))).alias("head")))
    checksum = F.crc32(F.col("conv_id").cast("string").cast("binary"))
    convs = (counts.groupBy("conv_id").agg(F.sum("n").alias("n_own"))
             .withColumn("h", (checksum % HEAD_TURNS).cast("int"))
             .withColumn("block", F.col("conv_id") - F.col("conv_id") % BLOCK_IDS)
             .join(heads, "block", "left")
             .withColumn("head", F.slice(F.coalesce("head", F.array().cast("array<struct<j:int,t1:bigint,t2:bigint,words:bigint>>")),
                                         F.lit(1), F.col("h")))
             .withColumn("m", F.size("head"))
             .withColumn("length", F.col("m") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))))
    # the running digests of the head, which has fewer than HEAD_TURNS turns
    for half in (1, 2):
        convs = convs.withColumn(f"run{half}", _running(F.col("head"), half))
    convs = written(convs.select("conv_id", "h", "m", "length", "head", "run1", "run2"), "convs")

    def after(run: str) -> Column:
        return F.coalesce(F.element_at(run, -1), F.lit(0)).cast("long")

    seg = (counts.select("conv_id", "piece", "before", F.count(F.lit(1)).over(Window.partitionBy("conv_id")).alias("n_pieces"))
           .join(convs.select("conv_id", "h", "m", "length", F.when(F.col("m") > 0, after("run1")).otherwise(0).alias("x1"),
                              F.when(F.col("m") > 0, after("run2")).otherwise(0).alias("x2")), "conv_id"))
    numbered = (pieces.withColumn("j", F.row_number().over(own)).join(seg, ["conv_id", "piece"])
                .withColumn("j", F.col("j") + F.col("before")).where("j > h")
                .withColumn("depth", (F.col("j") - F.col("h") + F.col("m")).cast("long"))
                .withColumn("s1", _step(1, F.col("depth"), F.col("t1"), F.col("t2")))
                .withColumn("s2", _step(2, F.col("depth"), F.col("t1"), F.col("t2"))))
    # conversations that lie in several pieces: at most one for each border between pieces
    over = numbered.where("n_pieces > 1").groupBy("conv_id", "piece").agg(F.bit_xor("s1").alias("s1"), F.bit_xor("s2").alias("s2"))
    over = _lead(_lead(over, "conv_id", "piece", F.bit_xor("s1"), "o1"), "conv_id", "piece", F.bit_xor("s2"), "o2")
    run = Window.partitionBy("conv_id", "piece").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    tail = (numbered.withColumn("r1", F.bit_xor("s1").over(run)).withColumn("r2", F.bit_xor("s2").over(run))
            .join(F.broadcast(over.where("o1 <> 0 OR o2 <> 0").select("conv_id", "piece", "o1", "o2")), ["conv_id", "piece"], "left")
            .withColumn("p1", F.col("r1").bitwiseXOR(F.col("x1")).bitwiseXOR(F.coalesce("o1", F.lit(0))))
            .withColumn("p2", F.col("r2").bitwiseXOR(F.col("x2")).bitwiseXOR(F.coalesce("o2", F.lit(0))))
            .select("conv_id", "depth", "p1", "p2", "s1", "s2", "words", "length"))
    head = (convs.select("conv_id", "length", F.explode(F.arrays_zip("head", "run1", "run2")).alias("z"))
            .withColumn("depth", F.col("z.head.j").cast("long"))
            .select("conv_id", "depth", F.col("z.run1").alias("p1"), F.col("z.run2").alias("p2"),
                    _step(1, F.col("depth"), F.col("z.head.t1"), F.col("z.head.t2")).alias("s1"),
                    _step(2, F.col("depth"), F.col("z.head.t1"), F.col("z.head.t2")).alias("s2"),
                    F.col("z.head.words").alias("words"), "length"))
    rows = head.unionByName(tail).select(
        "conv_id", "depth", "p1", "p2", F.col("p1").bitwiseXOR(F.col("s1")).alias("q1"),
        F.col("p2").bitwiseXOR(F.col("s2")).alias("q2"), "words", (F.col("depth") == F.col("length")).alias("is_end"))
    return convs.select("conv_id", "length"), written(rows, "prefixes")


def _cell(half: Column, bits: int) -> Column:
    return F.shiftrightunsigned(half, 64 - bits)


def sketch(rows: DataFrame, bits: int) -> DataFrame:
    """(line, part, map): for each of the two rows of the sketch, bitmaps of the cells counted twice or more."""
    cells = rows.select(F.explode(F.array(
        F.struct(F.lit(1).alias("line"), _cell(F.col("p1"), bits).alias("cell")),
        F.struct(F.lit(2).alias("line"), _cell(F.col("p2"), bits).alias("cell")))).alias("z")).select("z.*")
    often = cells.groupBy("line", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return (often.groupBy("line", F.shiftright("cell", _MAP_BITS).alias("part"))
            .agg(F.bitmap_construct_agg(F.col("cell").bitwiseAND((1 << _MAP_BITS) - 1)).alias("map")))


def _with_estimates(rows: DataFrame, maps: DataFrame, bits: int) -> DataFrame:
    """Add ``alone`` and ``parent_alone``: the sketch proves that the prefix (its parent) has one member."""
    df = rows
    for name in ("p1", "p2", "q1", "q2"):
        line = int(name[1])
        side = maps.where(F.col("line") == line).select(F.col("part").alias(f"part_{name}"), F.col("map").alias(f"map_{name}"))
        cell = _cell(F.col(name), bits)
        df = df.join(F.broadcast(side), F.shiftright(cell, _MAP_BITS) == F.col(f"part_{name}"), "left")
        at = cell.bitwiseAND((1 << _MAP_BITS) - 1)
        byte = F.conv(F.hex(F.substring(F.col(f"map_{name}"), F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        bit = F.call_function("shiftright", byte, at.bitwiseAND(7).cast("int")).bitwiseAND(1) == 1
        df = df.withColumn(f"twice_{name}", F.coalesce(bit, F.lit(False))).drop(f"part_{name}", f"map_{name}")
    return (df.withColumn("alone", ~(F.col("twice_p1") & F.col("twice_p2")))
            .withColumn("parent_alone", (F.col("depth") > 1) & ~(F.col("twice_q1") & F.col("twice_q2")))
            .drop("twice_p1", "twice_p2", "twice_q1", "twice_q2"))


def _runs(p1: np.ndarray, p2: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Where a new node starts in sorted columns, with the end as the last entry."""
    new = (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1]) | (depth[1:] != depth[:-1])
    return np.concatenate([[0], np.flatnonzero(new) + 1, [len(p1)]])


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (p1, p2, depth, conv_id) rows to pieces of comma-joined ids."""
    for b in batches:
        if not b.num_rows:
            continue
        p1, p2, depth, ids = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        at = _runs(p1, p2, depth)
        yield pa.RecordBatch.from_pydict({
            "p1": p1[at[:-1]], "p2": p2[at[:-1]], "depth": depth[at[:-1]], "first": ids[at[:-1]],
            "ids": pa.array([",".join(map(str, ids[a:z].tolist())) for a, z in zip(at, at[1:])], pa.string())})


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces of ids to one digest a node; a node may go on from batch to batch."""
    node, sha = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([v], pa.int64()) for v in node] + [pa.array([sha.hexdigest()], pa.string())], [*_NODE, "joined_sha"])

    for b in batches:
        for p1, p2, depth, ids in zip(*(b.column(n).to_pylist() for n in (*_NODE, "ids"))):
            if (p1, p2, depth) == node:
                sha.update(b"," + ids.encode())
                continue
            if node is not None:
                yield row()
            node, sha = (p1, p2, depth), hashlib.sha256(ids.encode())
    if node is not None:
        yield row()


def _joined_ends(ends: DataFrame) -> DataFrame:
    """The digest of the ordered ids of each node's ends, nodes of any number of ends."""
    sorted_ids = ends.select(*_NODE, "conv_id").repartitionByRange(*_NODE, "conv_id").sortWithinPartitions(*_NODE, "conv_id")
    pieces = sorted_ids.mapInArrow(_join_ids, "p1 long, p2 long, depth long, first long, ids string")
    return (pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "first")
            .mapInArrow(_hash_ids, "p1 long, p2 long, depth long, joined_sha string"))


def _value_above(nodes: DataFrame, block: int = 1 << 16) -> DataFrame:
    """Add ``above``: the sum of ``value`` over the same path's nodes of smaller depth.

    A path is cut into blocks of depths, so a path of any length is spread over tasks.
    """
    cut = nodes.withColumn("blk", F.floor(F.col("depth") / block))
    sums = cut.groupBy("conv_id", "blk").agg(F.sum("value").alias("n"))
    lead = _lead(sums, "conv_id", "blk", F.sum("n"), "lead").where("lead > 0").select("conv_id", "blk", "lead")
    w = Window.partitionBy("conv_id", "blk").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    return (cut.join(lead, ["conv_id", "blk"], "left")
            .withColumn("above", F.coalesce(F.sum("value").over(w), F.lit(0)) + F.coalesce("lead", F.lit(0)))
            .drop("blk", "lead"))


def prefix_trie(conversations: DataFrame, cell_bits: int | None = None) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``cell_bits`` sets the sketch's size; by default it follows the number of turns.
    """
    spark = conversations.sparkSession
    ready_workers(spark)
    convs, rows = rebuilt_turns(conversations)
    if cell_bits is None:
        cells = CELLS_A_ROW * max(1, rows.count())
        cell_bits = min(MAX_CELL_BITS, max(MIN_CELL_BITS, math.ceil(math.log2(cells))))
    screened = _with_estimates(rows, written(sketch(rows, cell_bits), "sketch"), cell_bits)
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", *[zero.alias(c) for c in ("depth", "p1", "p2", "q1", "q2", "words")],
                         (F.col("length") == 0).alias("is_end"))
    # a row that is not proven alone but whose parent is has one member all the same
    lone = F.col("alone") | F.col("parent_alone")
    maybe = written(screened.where(~lone).drop("alone", "parent_alone").unionByName(roots), "maybe-shared")
    tails = screened.where(lone)

    nodes = written(maybe.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.count_if("is_end").alias("n_ends"),
        F.min(F.when(F.col("is_end"), F.col("conv_id"))).alias("end_id"), F.max("words").alias("words"),
        F.max("q1").alias("q1"), F.max("q2").alias("q2")), "shared-nodes")
    paths = nodes.select("conv_id", *_NODE, "q1", "q2", "n_convs", "n_ends", "end_id",
                         ((F.col("n_convs") - 1) * F.col("words")).alias("value"))
    per_conv = (paths.select("conv_id", "value", (F.col("n_convs") == F.col("n_ends")).cast("long").alias("leaf"))
                .unionByName(tails.where("is_end").select("conv_id", zero.alias("value"), F.lit(1).cast("long").alias("leaf")))
                .groupBy("conv_id").agg(F.sum("value").alias("value"), F.sum("leaf").alias("leaf")))
    sums = (maybe.select("conv_id", *_NODE).join(per_conv, "conv_id", "left")
            .groupBy(*_NODE).agg(F.coalesce(F.sum("value"), zero).alias("all_saved"), F.coalesce(F.sum("leaf"), zero).alias("n_leaves")))
    first_tails = tails.where(~F.col("parent_alone"))
    parent = [F.col("q1").alias("p1"), F.col("q2").alias("p2"), (F.col("depth") - 1).alias("depth")]
    children = (nodes.where("depth > 0").select(*parent).unionByName(first_tails.select(*parent))
                .groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n_children")))
    joined = _joined_ends(maybe.where("is_end").join(nodes.where("n_ends > 1").select(*_NODE), _NODE, "left_semi"))
    sha = (F.when(F.col("n_ends") == 0, F.lit(_EMPTY_SHA))
           .when(F.col("n_ends") == 1, F.sha2(F.col("end_id").cast("string"), 256)).otherwise(F.col("joined_sha")))
    shared = (_value_above(paths).join(sums, _NODE).join(children, _NODE, "left").join(joined, _NODE, "left")
              .select("conv_id", "depth", "q1", "q2", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves",
                      (F.col("all_saved") - F.col("above")).alias("saved_tokens"), sha.alias("ends_sha256")))

    end_sha = F.when(F.col("is_end"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(_EMPTY_SHA))
    one = F.lit(1).cast("long")
    tail = ["conv_id", "depth", "q1", "q2", one.alias("n_convs"), (~F.col("is_end")).cast("long").alias("n_children"),
            one.alias("n_leaves"), zero.alias("saved_tokens"), end_sha.alias("ends_sha256")]
    hung = shared.unionByName(first_tails.select(*tail))  # nodes whose parent is a grouped node (or none)
    above = nodes.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), (F.col("depth") + 1).alias("depth"),
                         F.col("conv_id").alias("parent_conv_id"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    # a parent that is not among the grouped nodes has this node's only member
    parent_id = F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id"))
    return (hung.join(above, ["q1", "q2", "depth"], "left").withColumn("parent_conv_id", parent_id).select(*out)
            .unionByName(tails.where("parent_alone").select(*tail).withColumn("parent_conv_id", F.col("conv_id")).select(*out)))


def oracle() -> str:
    """The trie in DuckDB SQL, by whole prefixes and joins of nodes with their ancestors."""
    return r"""
WITH RECURSIVE ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
chars AS (SELECT conv_id, unnest(range(1, length(conv_id::VARCHAR) + 1)) AS i FROM ids),
bytes AS (SELECT conv_id, list(ascii(substr(conv_id::VARCHAR, i::INT, 1))::BIGINT ORDER BY i) AS b FROM chars GROUP BY conv_id),
crc AS (SELECT conv_id, b, 0 AS k, 4294967295::BIGINT AS s FROM bytes
  UNION ALL
  SELECT conv_id, b, k + 1, list_reduce([xor(s, b[k + 1]), 1, 2, 3, 4, 5, 6, 7, 8],
    lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END) FROM crc WHERE k < len(b)),
h AS (SELECT conv_id, xor(s, 4294967295::BIGINT) % 4 AS h FROM crc WHERE k = len(b)),
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS j
  FROM conversations WHERE conv_id IS NOT NULL),
rebuilt AS (
  SELECT h.conv_id, t.j, role, text FROM h JOIN t ON t.conv_id = h.conv_id - h.conv_id % 20 AND t.j <= h.h
  UNION ALL
  SELECT h.conv_id, t.j, role, text FROM h JOIN t ON t.conv_id = h.conv_id AND t.j > h.h),
d AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY j) AS depth FROM rebuilt),
p AS (SELECT conv_id, depth, sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '')
    OVER (PARTITION BY conv_id ORDER BY depth)) AS node,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM d
  UNION ALL SELECT conv_id, 0, 'root', 0 FROM ids),
ends AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id),
n AS (SELECT p.depth, node, min(p.conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (e.depth = p.depth), '')) AS ends_sha256
  FROM p JOIN ends e ON e.conv_id = p.conv_id GROUP BY p.depth, node),
parents AS (SELECT n.*, q.conv_id AS parent_conv_id FROM n
  LEFT JOIN p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
  LEFT JOIN n q ON q.node = p.node AND q.depth = p.depth),
kids AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM parents WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT a.*, coalesce(k.n_children, 0) AS n_children FROM parents a LEFT JOIN kids k USING (conv_id, depth)),
sub AS (SELECT p.depth, p.node, sum(CASE WHEN y.n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves,
    sum((y.n_convs - 1) * y.words)::BIGINT AS saved_tokens
  FROM full_nodes y JOIN p ON p.conv_id = y.conv_id AND p.depth <= y.depth GROUP BY p.depth, p.node)
SELECT conv_id, f.depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM full_nodes f JOIN sub USING (depth, node)
"""
