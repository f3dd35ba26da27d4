"""Exact Jaccard join on word n-grams with a token-group matrix (operator 6).

A document's set holds the hashes of its distinct word shingles; documents with equal sets
form one class, and only classes are compared.

1. Shingles are ordered rarest first by a count sketch of all shingles (a fixed-size table).
   Two linked sets share one of the first n - ceil(threshold n) + 1 shingles of this order,
   so only those prefixes are shuffled, and a shingle that one class alone has is dropped.
2. Seed links: in the list of each shared shingle, every class is compared exactly with the
   class whose prefix is commonest (of a text and its edited copies, the text itself), if
   their parity bitmaps (n / 16 bytes a set) allow it: the bits in which two bitmaps differ
   are at most the shingles in which the sets differ. Their components are similar documents
   by proof; classes without a link join the class that leads their longest list. Cut into
   chunks of bounded size, these are the groups.
3. Token-group matrix: shingle by shingle, a class (the query) meets the groups that hold
   other components; bitmaps rule most groups out before any set is moved. Each group left
   stores the union of its members' shingles; a query whose overlap with the union falls
   short of the threshold cannot link to any member, and only the groups left are opened and
   compared member by member.
4. Components over all links; equal sets and links already proved are never compared again,
   so a group of near copies costs its size, not its square.

No link between different texts is lost: prefixes, sizes, bitmaps and unions are bounds. Sets are
compared by 64-bit hashes of their shingles and classes named by a 64-bit hash of the set.

Edge cases: null or blank texts have no shingles and link to nothing; fewer words than a
shingle count as one; rows without an id are linked but never name a component; repeated
rows are separate rows of one class; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hydroframe.llm.common import ready_workers, row_and, text_or_empty, without_ids, written
from hydroframe.llm.components import components

WORDS = 4
PERCENT = 85
SKETCH_BITS = 20     # cells of the count sketch: 4 MB
SKETCH_BLOCK = 14    # cells that are merged together
ROUTE_BITS = 26      # classes that share a shingle, as a bitmap of 8 MB
GROUP_MEMBERS = 256
QUERIES_A_TASK = 500  # queries that meet a group at once
SLICE_BYTES = 1 << 20  # text hashed at a time

_M1, _M2, _M3 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift, multiply) that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words of lower-cased UTF-8 bytes."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts
    lower = (data + 32 * ((data >= 65) & (data <= 90)).view(np.uint8)).astype(np.uint64)
    powers = np.cumprod(np.full(int((ends - starts).max()), _M3 | np.uint64(1), np.uint64))
    word = np.cumsum(np.bincount(starts, minlength=len(data))[:len(data)]) - 1
    place = np.arange(len(data)) - starts[np.maximum(word, 0)]
    value = (lower + np.uint64(1)) * powers[np.minimum(np.maximum(place, 0), len(powers) - 1)]
    value[blank] = 0
    return _mix(np.add.reduceat(value, starts) + (ends - starts).astype(np.uint64)), starts


def shingle_sets(texts: list[bytes], words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text (UTF-8)."""
    held: list[bytes] = []
    size = 0

    def flush():
        data = np.frombuffer(b"\n".join(held) + b"\n", np.uint8)
        hashes, starts = _word_hashes(data)
        cuts = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in held]))
        full = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
        for i in range(words):
            full = _mix(full + hashes[i:len(hashes) - words + 1 + i] * _M3) + _M3 if len(full) else full
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if b - a >= words:
                yield np.unique(full[a:b - words + 1])
            elif b > a:
                short = np.zeros(1, np.uint64)
                for i in range(a, b):
                    short = _mix(short + hashes[i:i + 1] * _M3) + _M3
                yield _mix(short + np.uint64(b - a))
            else:
                yield np.empty(0, np.uint64)

    for t in texts:
        held.append(t)
        size += len(t)
        if size >= SLICE_BYTES:
            yield from flush()
            held, size = [], 0
    if held:
        yield from flush()


def class_of(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).view(np.int64))


def linked(common, n1, n2, percent: int = PERCENT):
    return 100 * common >= percent * (n1 + n2 - common)


def parity_bitmap(tokens: np.ndarray) -> bytes:
    """One bit per hash slot, set if an odd number of shingles falls there; about n / 2 slots."""
    slots = 1 << max(7, len(tokens).bit_length() - 1)
    odd = np.bincount((tokens & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps with fewer slots: slots are low bits of the hash, so halves fold onto each other."""
    while bits.shape[-1] > size:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def least_difference(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """At least so many shingles are in one of two sets only, by their bitmaps (last axis)."""
    size = min(x.shape[-1], y.shape[-1])
    return np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum(-1, dtype=np.int64)


def most_difference(n1, n2, percent: int):
    """Linked sets of these sizes differ in at most so many shingles (below 0: they cannot link)."""
    common = -(-percent * (n1 + n2) // (100 + percent))
    return np.where(common <= np.minimum(n1, n2), n1 + n2 - 2 * common, -1)


def _bits(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8)


def _sets_of(batch: pa.RecordBatch, words: int) -> Iterator[np.ndarray]:
    return shingle_sets([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()], words)


# --- pass 1: sizes, classes and the count sketch -------------------------------------------

def _first_pass(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, seen = np.zeros(1 << SKETCH_BITS, np.uint32), set()
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]
        names = ["doc_id", "cls", "n", "bitmap", "block", "cells", "counts"]
        for batch in batches:
            cls, n, bitmaps = [], [], []
            for tokens in _sets_of(batch, words):
                c = class_of(tokens)
                cls.append(c)
                n.append(len(tokens))
                bitmaps.append(parity_bitmap(tokens))
                if len(tokens) and c not in seen:
                    seen.add(c)
                    np.add.at(sketch, tokens >> np.uint64(64 - SKETCH_BITS), np.uint32(1))
            none = [None] * len(cls)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip([batch.column("doc_id").to_pylist(), cls, n, bitmaps, none, none, none], kinds)],
                names=names)
        rows = []
        for block, part in enumerate(sketch.reshape(-1, 1 << SKETCH_BLOCK)):
            cells = np.flatnonzero(part)
            if len(cells):
                rows.append((None, None, None, None, block, cells.astype("<u2").tobytes(), part[cells].astype("<u4").tobytes()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=names)
    return run


def _add_sketches(table: pa.Table) -> pa.Table:
    total = np.zeros(1 << SKETCH_BLOCK, np.int64)
    for cells, counts in zip(table["cells"].to_pylist(), table["counts"].to_pylist()):
        total[np.frombuffer(cells, "<u2")] += np.frombuffer(counts, "<u4")
    return pa.table({"block": pa.array([table["block"][0].as_py()], pa.int32()),
                     "total": pa.array([np.minimum(total, (1 << 24) - 1).astype("<u4").tobytes()])})


def _whole_sketch(parts: DataFrame) -> np.ndarray:
    out = np.zeros((1 << SKETCH_BITS - SKETCH_BLOCK, 1 << SKETCH_BLOCK), np.uint32)
    merged = parts.select("block", "cells", "counts").groupBy("block").applyInArrow(_add_sketches, "block int, total binary")
    for r in merged.collect():  # a table of fixed size
        out[r["block"]] = np.frombuffer(r["total"], "<u4")
    return out.ravel()


# --- pass 2: the rarest shingles of each class ---------------------------------------------

def prefix(tokens: np.ndarray, sketch: np.ndarray, percent: int) -> np.ndarray:
    """The first n - ceil(percent n / 100) + 1 shingles, rarest first, ties by hash."""
    n = len(tokens)
    keep = n + (-percent * n) // 100 + 1
    seldom = sketch[tokens >> np.uint64(64 - SKETCH_BITS)].astype(np.uint64)
    order = np.argsort((seldom << np.uint64(40)) | (tokens >> np.uint64(24)), kind="stable")
    return tokens[order[:keep]]


def weight(tokens: np.ndarray, n: int, sketch: np.ndarray) -> int:
    """How common a prefix is (its mean sketch count, in sixteenths), and the set's size below it."""
    common = int(16 * sketch[tokens >> np.uint64(64 - SKETCH_BITS)].mean())
    return (min(common, (1 << 30) - 1) << 32) | n


def _second_pass(sketch, words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            parts, classes, weights = [], [], []
            for tokens in _sets_of(batch, words):
                c = class_of(tokens)
                if len(tokens) and c not in seen:
                    seen.add(c)
                    parts.append(prefix(tokens, sketch.value, percent))
                    classes.append(c)
                    weights.append(weight(parts[-1], len(tokens), sketch.value))
            if parts:
                many = [len(p) for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(parts).view(np.int64)), pa.array(np.repeat(np.array(classes, np.int64), many)),
                     pa.array(np.repeat(np.array(weights, np.int64), many))], names=["token", "cls", "weight"])
    return run


# --- pass 3: the whole sets of the classes that share a shingle -----------------------------

def _bit_of(cls: F.Column, bits: int) -> F.Column:
    return F.shiftrightunsigned(cls, 64 - bits)


def _shared_bitmap(classes: DataFrame, bits: int = ROUTE_BITS) -> np.ndarray:
    at = _bit_of(F.col("cls"), bits)
    maps = (classes.select(F.shiftright(at, 15).alias("part"), at.bitwiseAND((1 << 15) - 1).alias("pos"))
            .groupBy("part").agg(F.bitmap_construct_agg("pos").alias("map")))
    out = np.zeros((1 << bits - 15, 1 << 12), np.uint8)
    for r in maps.collect():  # a table of fixed size
        out[r["part"]] = np.frombuffer(r["map"], np.uint8)
    return out.ravel()


def _third_pass(shared, words: int, bits: int = ROUTE_BITS):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            rows = []
            for tokens in _sets_of(batch, words):
                c = class_of(tokens)
                at = (c % (1 << 64)) >> (64 - bits)
                if len(tokens) and c not in seen and shared.value[at >> 3] >> (at & 7) & 1:
                    seen.add(c)
                    rows.append((c, tokens.tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                                  pa.array([r[1] for r in rows], pa.binary())], names=["cls", "tokens"])
    return run


def _likely_pairs(percent: int):
    """Pairs whose bitmaps do not rule a link out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb, ba, bb = (batch.column(c).to_pylist() for c in ("a", "b", "na", "nb", "ba", "bb"))
            least = np.array([int(least_difference(_bits(x), _bits(y))) for x, y in zip(ba, bb)], np.int64)
            hit = least <= most_difference(np.array(na, np.int64), np.array(nb, np.int64), percent)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.int64)[hit]) for x in (a, b)], names=["a", "b"])
    return run


def _verify_pairs(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            hit = np.zeros(len(a), bool)
            for i, (x, y) in enumerate(zip(batch.column("ta"), batch.column("tb"))):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                hit[i] = linked(int((y[at] == x).sum()), len(x), len(y), percent)
            yield pa.RecordBatch.from_arrays([pa.array(a[hit]), pa.array(b[hit])], names=["a", "b"])
    return run


# --- the token-group matrix ----------------------------------------------------------------

def _likely_groups(percent: int):
    """Queries with a member of the group, of another component, that bitmaps do not rule out."""
    def run(members: pa.Table, queries: pa.Table) -> pa.Table:
        by_size: dict[int, list[tuple[int, int, np.ndarray]]] = {}
        for comp, n, raw in zip(*(members[c].to_pylist() for c in ("comp", "n", "bitmap"))):
            by_size.setdefault(len(raw), []).append((comp, n, _bits(raw)))
        held = [(np.array([c for c, *_ in own]), np.array([n for _, n, _ in own]), np.stack([b for *_, b in own]))
                for own in by_size.values()]
        rows = [q for q, comp, n, raw in zip(*(queries[c].to_pylist() for c in ("query", "q_comp", "q_n", "q_bitmap")))
                if any(((least_difference(bits, _bits(raw)) <= most_difference(sizes, n, percent)) & (comps != comp)).any()
                       for comps, sizes, bits in held)]
        group = queries["q_grp"][0].as_py() if rows else None
        return pa.table({"query": pa.array(rows, pa.int64()), "grp": pa.array([group] * len(rows), pa.int64())})
    return run


def _open_groups(percent: int):
    """Queries against one group: bound by the union of its shingles, then member by member."""
    def run(members: pa.Table, queries: pa.Table) -> pa.Table:
        found: set[tuple[int, int]] = set()
        if members.num_rows and queries.num_rows:
            comps = np.array(members["comp"].to_pylist(), np.int64)
            sets = [np.frombuffer(t, "<u8") for t in members["held"].to_pylist()]
            sizes = np.array([len(s) for s in sets])
            every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
            union = np.unique(every)
            for comp, raw in zip(queries["q_comp"].to_pylist(), queries["asked"].to_pylist()):
                q = np.frombuffer(raw, "<u8")
                at = np.minimum(np.searchsorted(union, q), len(union) - 1)
                inside = q[union[at] == q]
                if 100 * len(inside) < percent * len(q):
                    continue  # no member can reach the threshold: the group stays closed
                hit = inside[np.minimum(np.searchsorted(inside, every), len(inside) - 1)] == every
                common = np.bincount(owner[hit], minlength=len(sets))
                hits = linked(common, len(q), sizes, percent) & (comps != comp)
                found.update((comp, c) for c in np.unique(comps[hits]).tolist())
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})
    return run


def _by_group(pairs: DataFrame, members: DataFrame, asked: DataFrame, held: list[str], asks: list[str]):
    """Members and queries of each group, side by side, the queries in parts of bounded size."""
    loads = pairs.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / QUERIES_A_TASK).cast("int").alias("parts"))
    parted = members.join(loads, "grp").select(
        F.col("grp").alias("m_grp"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("m_part"), "comp", *held)
    ask = asked.join(loads, "grp").select(
        F.col("grp").alias("q_grp"), F.pmod(F.xxhash64("query"), F.col("parts")).cast("int").alias("q_part"), "query", "q_comp", *asks)
    return parted.groupBy("m_grp", "m_part").cogroup(ask.groupBy("q_grp", "q_part"))


def _group_links(postings: DataFrame, comps: DataFrame, bitmaps: DataFrame, whole_sets, percent: int) -> DataFrame | None:
    """Links (a, b) between components, from queries against the groups with members of others."""
    sizes = comps.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    of = comps.join(sizes, "component").select(F.col("node").alias("cls"), F.col("component").alias("comp"), "size")
    known = postings.dropDuplicates(["token", "cls"]).join(of, "cls", "left").select(
        "token", "cls", "n", "center", "listed", F.coalesce("comp", "cls").alias("comp"), F.coalesce("size", F.lit(1)).alias("size"))
    # Shingles whose classes are all in one component have nothing left to find.
    low, high = F.min("comp").over(Window.partitionBy("token")), F.max("comp").over(Window.partitionBy("token"))
    known = written(known.withColumn("lo", low).withColumn("hi", high).where("lo <> hi").drop("lo", "hi"), "matrix")
    # Groups: a component, or the classes without a link that the same class leads, in chunks.
    home = known.groupBy("cls", "comp", "size").agg(F.max_by("center", F.struct("listed", "center")).alias("leader"))
    home = home.withColumn("key", F.when(F.col("size") > 1, F.xxhash64("comp")).otherwise(F.xxhash64("leader", F.lit("leads"))))
    many = home.groupBy(F.col("key").alias("_key")).agg(F.ceil(F.count(F.lit(1)) / GROUP_MEMBERS).alias("chunks"))
    members = home.join(many, home["key"] == many["_key"]).select(
        "cls", "comp", "size", F.xxhash64("key", F.pmod(F.xxhash64("cls"), F.col("chunks"))).alias("grp"))
    members = written(members, "members")
    rank = F.struct("size", "comp")
    matrix = (known.select("token", "cls", "n").join(members, "cls").groupBy("token", "grp")
              .agg(F.min("n").alias("n_min"), F.max("n").alias("n_max"), F.max(rank).alias("top")))
    asks = known.select("token", F.col("cls").alias("query"), "n", F.struct("size", "comp").alias("own"))
    # Of two components the smaller one asks: a group is met if a member's component ranks above.
    pairs = (asks.join(matrix, "token")
             .where(f"own < top and 100 * n_max >= {percent} * n and 100 * n >= {percent} * n_min")
             .select("query", "grp").distinct())
    pairs = written(pairs, "query_groups")
    own = members.select(F.col("cls").alias("query"), F.col("comp").alias("q_comp"))
    asked = pairs.join(own, "query").join(
        bitmaps.select(F.col("cls").alias("query"), F.col("n").alias("q_n"), F.col("bitmap").alias("q_bitmap")), "query")
    held = members.select("cls", "comp", "grp").join(bitmaps, "cls")
    likely = written(_by_group(pairs, held, asked, ["n", "bitmap"], ["q_n", "q_bitmap"])
                     .applyInArrow(_likely_groups(percent), "query long, grp long"), "likely_groups")
    if likely.isEmpty():
        return None
    opened = members.select("cls", "comp", "grp").join(likely.select("grp").distinct(), "grp")
    sets = whole_sets(opened.select("cls").union(likely.select("query")).distinct(), "group_sets")
    queries = likely.join(own, "query").join(
        sets.select(F.col("cls").alias("query"), F.col("tokens").alias("asked")), "query")
    held = opened.join(sets.select("cls", F.col("tokens").alias("held")), "cls")
    return _by_group(likely, held, queries, ["held"], ["asked"]).applyInArrow(_open_groups(percent), "a long, b long")


def jaccard_classes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, cls (hash of the set), comp (class of its component)."""
    spark: SparkSession = docs.sparkSession
    ready_workers(spark)
    sc = spark.sparkContext
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    first = written(slim.mapInArrow(_first_pass(words), "doc_id long, cls long, n long, bitmap binary, block int, "
                                    "cells binary, counts binary"), "shingles")
    rows = first.where("block is null").select("doc_id", "cls", F.col("n").alias("n_shingles"))
    bitmaps = first.where("block is null and n > 0").select("cls", "n", "bitmap").dropDuplicates(["cls"])
    sketch = sc.broadcast(_whole_sketch(first.where("block is not null")))
    texts = slim.select("text")

    def whole_sets(classes: DataFrame, name: str) -> DataFrame:
        shared = sc.broadcast(_shared_bitmap(classes.select(F.col(classes.columns[0]).alias("cls"))))
        return written(texts.mapInArrow(_third_pass(shared, words), "cls long, tokens binary").dropDuplicates(["cls"]), name)

    prefixes = texts.mapInArrow(_second_pass(sketch, words, percent), "token long, cls long, weight long")
    by_token = Window.partitionBy("token")
    size = lambda w: F.col(w).bitwiseAND((1 << 32) - 1)
    postings = (prefixes.withColumn("top", F.max(F.struct("weight", "cls")).over(by_token))
                .withColumn("listed", F.count("cls").over(by_token))
                .withColumn("low", F.min("cls").over(by_token)).withColumn("high", F.max("cls").over(by_token)))
    postings = written(postings.where("low <> high").select(
        "token", "cls", "listed", size("weight").alias("n"), F.col("top.cls").alias("center"), size("top.weight").alias("n_center")),
        "postings")
    pairs = (postings.where(f"cls <> center and 100 * n >= {percent} * n_center and 100 * n_center >= {percent} * n")
             .select(F.col("center").alias("a"), F.col("cls").alias("b")).distinct())
    marked = (pairs.join(bitmaps.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("bitmap").alias("bb")), "b")
              .join(bitmaps.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("bitmap").alias("ba")), "a"))
    likely = written(marked.select("a", "b", "na", "nb", "ba", "bb").mapInArrow(_likely_pairs(percent), "a long, b long"), "likely")
    sets = whole_sets(likely.select("a").union(likely.select("b")).distinct(), "sets")
    joined = (likely.join(sets.select(F.col("cls").alias("b"), F.col("tokens").alias("tb")), "b")
              .join(sets.select(F.col("cls").alias("a"), F.col("tokens").alias("ta")), "a"))
    seeds = joined.select("a", "b", "ta", "tb").mapInArrow(_verify_pairs(percent), "a long, b long")
    seeded = written(components(seeds, "a", "b"), "seeded")
    links = _group_links(postings, seeded, bitmaps, whole_sets, percent)
    if links is None:
        final = seeded.select("node", F.col("component").alias("comp"))
    else:
        merged = components(links, "a", "b").select(F.col("node").alias("component"), F.col("component").alias("merged"))
        final = seeded.join(merged, "component", "left").select("node", F.coalesce("merged", "component").alias("comp"))
        alone = merged.join(seeded.select("component"), "component", "left_anti").select(
            F.col("component").alias("node"), F.col("merged").alias("comp"))
        final = written(final.unionByName(alone), "components")
    return (rows.join(final, rows["cls"] == final["node"], "left")
            .select("doc_id", "n_shingles", "cls", F.coalesce("comp", "cls").alias("comp")))


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, doc_id: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, class_id.

    class_id is the smallest doc_id with the same set, component_id the smallest one reachable
    by links; documents without shingles have their own id in both.
    """
    rows = written(jaccard_classes(docs, words, percent, doc_id, text), "linked")
    own = rows.where("n_shingles > 0")
    by_class = own.groupBy("cls").agg(F.min("doc_id").alias("class_id"), F.min("comp").alias("comp"))
    by_comp = by_class.groupBy("comp").agg(F.min("class_id").alias("component_id"))
    names = by_class.join(by_comp, "comp").select("cls", "class_id", "component_id")
    out = own.join(names, "cls").select("doc_id", "n_shingles", "component_id", "class_id")
    bare = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"),
                                               F.col("doc_id").alias("class_id"))
    return out.unionByName(bare)


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id; all columns kept.

    Rows without an id, and rows that share the id that stays, all stay.
    """
    found = jaccard_components(docs, words, percent, doc_id, text)
    drop = (found.where("doc_id is not null").groupBy("doc_id")
            .agg(F.max(F.col("doc_id") == F.col("component_id")).alias("stays")).where("not stays"))
    own = row_and(docs, id=F.col(doc_id).cast("long"))
    return without_ids(own, "id", written(drop.select("doc_id"), "dropped"), "doc_id").select("row.*")
