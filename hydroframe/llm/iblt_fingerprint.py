"""Document fingerprints by invertible Bloom lookup sketches (operator 1, native).

A text is cut into short paragraphs (lines, long ones at sentence ends), each hashed to a 64-bit
digest. A sketch has three tables of cells; a digest falls into one cell of each, which adds 1
to a count and xors the digest and its checksum. Two versions' sketches subtract cell by cell, so
what they share vanishes; cells that hold one digest are peeled table by table until the
differing digests are recovered. A subtraction that does not peel down to nothing is retried
with larger tables and other hashes.

The fingerprint is the sketch at its smallest size, with the number of digests. A pair's sketch
is sized by the digests of both, and cells are rows that exist only where something fell, so a
large table costs no more than a small one. Likeness is the Jaccard likeness of the digest
sets that the recovered difference implies: shared / (all digests of both).

Each document meets the next one (descending doc_id) in a window over blocks of neighbouring ids, about
sqrt(rows) blocks of sqrt(rows) rows, joined by one row per block at their ends. Texts are
shuffled once; building, subtracting and peeling run in the same stage, by block.

Edge cases: a null text counts as empty, whose sketch is empty and like any other empty one;
rows without an id come last, ties in id are ordered by a hash of the text; a single row's next document
is itself; repeated rows are separate rows; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydroframe.llm.common import route, text_or_empty, written

# At least 8 words where the line has them, on to the end of the sentence, 24 words at most.
PARAGRAPH = r"(?:\S+[ \t]+){0,7}(?:\S*[^\s.!?][ \t]+){0,16}\S+"
TABLES = 3
FINGERPRINT_CELLS = 4   # per table
CELLS_A_DIGEST = 2      # per table, for pairs
PEELS = 7               # steps, each on one table in turn
ATTEMPTS = 6
EDITED, NEXT, OWN, OWN_EDITED = 0, 1, 2, 3  # the four sketches of a row: two differences, two fingerprints

VERSION_KEYS = ["block", "rn"]
CELL_KEYS = ["block", "rn", "kind", "cells", "tab", "idx", "info"]


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of a text's paragraphs."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), lambda p: F.xxhash64(p)))


def _cell(digest: Column, tab, cells: Column, salt: int) -> Column:
    return F.pmod(F.xxhash64(digest, F.lit(tab) if isinstance(tab, int) else tab, F.lit(salt)), cells)


def _check(digest: Column) -> Column:
    return F.xxhash64(F.lit("check"), digest)


def _summed(cells: DataFrame) -> DataFrame:
    """Add up what fell into each cell; cells that cancelled out are gone."""
    out = cells.groupBy(*CELL_KEYS).agg(F.sum("n").alias("n"), F.bit_xor("key").alias("key"),
                                        F.bit_xor("chk").alias("chk"), F.sum("found").alias("found"))
    return out.where("tab = -1 or n <> 0 or key <> 0 or chk <> 0")


def _built(rows: DataFrame, info: Column, grow: int, salt: int, fingerprints: bool) -> DataFrame:
    """Sketch cells of the differences (and fingerprints) of rows with digest arrays a, e and b."""
    def part(kind: int, sign: int, array: str) -> Column:
        return F.transform(array, lambda d: F.struct(F.lit(kind).alias("kind"), F.lit(sign).alias("sign"), d.alias("digest")))

    parts = [part(EDITED, 1, "a"), part(EDITED, -1, "e"), part(NEXT, 1, "a"), part(NEXT, -1, "b")]
    if fingerprints:
        parts += [part(OWN, 1, "a"), part(OWN_EDITED, 1, "e")]
    # A row with tab -1 for each document carries what is known of it, also without any digest.
    mark = F.array(F.struct(F.lit(EDITED).alias("kind"), F.lit(0).alias("sign"), F.lit(0).cast("long").alias("digest")))
    size = {EDITED: F.size("a") + F.size("e"), NEXT: F.size("a") + F.size("b")}
    every = rows.select("block", "rn", info.alias("_info"), (size[EDITED] * CELLS_A_DIGEST * grow + 4).alias("_edited"),
                        (size[NEXT] * CELLS_A_DIGEST * grow + 4).alias("_next"), F.inline(F.concat(*parts, mark)))
    every = every.withColumn("cells", F.when(F.col("kind") == EDITED, F.col("_edited")).when(
        F.col("kind") == NEXT, F.col("_next")).otherwise(F.lit(FINGERPRINT_CELLS)).cast("long"))
    marked = F.col("sign") == 0
    tabs = F.when(marked, F.array(F.lit(-1))).otherwise(F.array(*[F.lit(t) for t in range(TABLES)]))
    every = every.withColumn("tab", F.explode(tabs))
    zero = F.lit(0).cast("long")
    cells = every.select(
        "block", "rn", "kind", F.when(marked, zero).otherwise(F.col("cells")).alias("cells"), "tab",
        F.when(marked, zero).otherwise(_cell(F.col("digest"), F.col("tab"), F.col("cells"), salt)).alias("idx"),
        F.when(marked, F.col("_info")).alias("info"), F.col("sign").cast("long").alias("n"),
        F.when(marked, zero).otherwise(F.col("digest")).alias("key"),
        F.when(marked, zero).otherwise(_check(F.col("digest"))).alias("chk"), zero.alias("found"))
    return _summed(cells)


def _peeled(cells: DataFrame, table: int, salt: int) -> DataFrame:
    """Recover the digests that are alone in a cell of one table and take them out of the others.

    Within one table a digest has one cell, so no digest is taken out twice.
    """
    pure = ((F.col("tab") == table) & (F.col("kind") <= NEXT) & (F.abs("n") == 1) & (F.col("chk") == _check(F.col("key")))
            & (F.col("idx") == _cell(F.col("key"), table, F.col("cells"), salt)))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast(cells.schema["info"].dataType)

    def cell(tab, cells_, idx, info, n, key, chk, found):
        return F.struct(tab.alias("tab"), cells_.alias("cells"), idx.alias("idx"), info.alias("info"), n.alias("n"),
                        key.alias("key"), chk.alias("chk"), found.alias("found"))

    same = cell(*[F.col(c) for c in ("tab", "cells", "idx", "info", "n", "key", "chk", "found")])
    out = [cell(F.lit(-1), zero, zero, none, zero, zero, zero, F.lit(1).cast("long"))]
    out += [cell(F.lit(t), F.col("cells"), _cell(F.col("key"), t, F.col("cells"), salt), none, -F.col("n"),
                 F.col("key"), F.col("chk"), zero) for t in range(TABLES) if t != table]
    return _summed(cells.select("block", "rn", "kind", F.inline(F.when(pure, F.array(*out)).otherwise(F.array(same)))))


def _fingerprint(kind: int) -> Column:
    """Non-empty cells of a fingerprint, in order, as text."""
    own = (F.col("kind") == kind) & (F.col("tab") >= 0)
    held = F.array_sort(F.collect_list(F.when(own, F.struct("tab", "idx", "n", "key", "chk"))))
    return F.array_join(F.transform(held, lambda c: F.concat(
        F.hex((c["tab"] * FINGERPRINT_CELLS + c["idx"]).cast("long")), F.lit("."), F.hex(c["n"]), F.lit("."),
        F.lpad(F.hex(c["key"]), 16, "0"), F.substring(F.lpad(F.hex(c["chk"]), 16, "0"), 1, 8))), "-")


def _differences(rows: DataFrame, info: Column, attempt: int, fingerprints: bool) -> DataFrame:
    """Per row: info, digests recovered and cells left of both differences (and fingerprints)."""
    cells = _built(rows, info, 1 << attempt, attempt, fingerprints)
    for step in range(PEELS):
        cells = _peeled(cells, step % TABLES, attempt)
    count = lambda kind, what: F.sum(F.when((F.col("kind") == kind), what).otherwise(0))
    left = F.when(F.col("tab") >= 0, 1).otherwise(0)
    out = [F.max("info").alias("info")]
    for kind, name in ((EDITED, "edited"), (NEXT, "next")):
        out += [count(kind, F.col("found")).alias(f"d_{name}"), count(kind, left).alias(f"left_{name}")]
    if fingerprints:
        out += [_fingerprint(OWN).alias("cells_own"), _fingerprint(OWN_EDITED).alias("cells_edited")]
    return cells.groupBy(*VERSION_KEYS).agg(*out)


def _edited(text: Column, next_text: Column) -> Column:
    """The last half (rounded down) of the code points replaced by the next text's first as many."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.left(text, n - half), F.left(next_text, half))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, h, text, a) with their block, place in it, and the next row's doc_id, h, text and a."""
    spark = docs.sparkSession
    n = docs.count()
    blocks = max(1, math.ceil(math.sqrt(n)))
    shares = [i / blocks for i in range(1, blocks)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * blocks))).first()[0] if shares else []
    bounds = sorted(set(bounds or []))  # about sqrt(rows) numbers
    table = F.from_json(F.lit(json.dumps(bounds)), "array<bigint>")
    steps = [1 << i for i in range(max(1, len(bounds)).bit_length() - 1, -1, -1)]
    # Binary search for the number of bounds below the id; rows without an id are the last block, -1.
    place = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when(
        (at + s <= len(bounds)) & (F.get(table, at + s - 1) < F.col("doc_id")), at + s).otherwise(at))
    rows = docs.withColumn("block", F.when(F.col("doc_id").isNull(), -1).otherwise(place if bounds else F.lit(0)))
    keys = rows.groupBy("block").agg(F.min(F.struct((-F.col("doc_id")).alias("neg"), "h")).alias("head"))
    down = Window.orderBy(F.desc("block"))  # about sqrt(rows) rows
    around = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    chain = keys.select("block", F.coalesce(F.lead("head").over(down), F.first("head").over(around)).alias("head"))
    chain = written(chain.select("block", (-F.col("head.neg")).alias("head_id"), F.col("head.h").alias("head_h")), "chain")
    heads = docs.select(F.col("doc_id").alias("next_id"), F.col("h").alias("next_h"), F.col("text").alias("next_text"),
                        F.col("a").alias("b"))
    heads = (heads.join(F.broadcast(chain), heads["next_id"].eqNullSafe(chain["head_id"]) & (heads["next_h"] == chain["head_h"]))
             .dropDuplicates(["block"]).drop("head_id", "head_h"))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = Window.partitionBy("block").orderBy(F.desc_nulls_last("doc_id"), "h")
    rows = rows.repartition(parts, "block").select(
        "block", "doc_id", "h", "text", "a", F.row_number().over(own).alias("rn"),
        F.lead(F.struct("doc_id", "h", "text", "a")).over(own).alias("after"))
    heads = heads.select(F.col("block").alias("_block"), F.struct(
        F.col("next_id").alias("doc_id"), F.col("next_h").alias("h"), F.col("next_text").alias("text"),
        F.col("b").alias("a")).alias("head"))
    joined = rows.join(heads, rows["block"] == heads["_block"], "left").drop("_block")
    nxt = F.coalesce("after", "head")
    return joined.select("block", "rn", "doc_id", "h", "text", "a", nxt["doc_id"].alias("next_id"), nxt["h"].alias("next_h"),
                         nxt["text"].alias("next_text"), nxt["a"].alias("b"))


def _likeness(size_a: Column, size_b: Column, apart: Column) -> Column:
    shared = (size_a + size_b - apart) / 2
    return F.when(size_a + size_b == 0, 1.0).otherwise(shared / (size_a + size_b - shared))


def _retried(results: DataFrame, docs: DataFrame) -> DataFrame:
    """Differences that did not peel, again with tables twice as large and other hashes each time."""
    failed = written(results.where("left_edited > 0 or left_next > 0").select("block", "rn", "info"), "failed")
    done = None
    for attempt in range(1, ATTEMPTS + 1):
        if failed.isEmpty():
            break
        ids = failed.select("info.doc_id").union(failed.select("info.next_id")).distinct()
        texts = route(docs.select("doc_id", "h", "text", "a"), "doc_id", ids, "doc_id").where("_maybe or doc_id is null")
        texts = texts.drop("_maybe").dropDuplicates(["doc_id", "h"])
        first = texts.select(F.col("doc_id").alias("i1"), F.col("h").alias("h1"), F.col("text").alias("t1"), "a")
        second = texts.select(F.col("doc_id").alias("i2"), F.col("h").alias("h2"), F.col("text").alias("t2"), F.col("a").alias("b"))
        pairs = (failed.join(first, F.col("info.doc_id").eqNullSafe(F.col("i1")) & (F.col("info.h") == F.col("h1")))
                 .join(second, F.col("info.next_id").eqNullSafe(F.col("i2")) & (F.col("info.next_h") == F.col("h2")))
                 .select("block", "rn", "info", "a", "b", digests(_edited(F.col("t1"), F.col("t2"))).alias("e")))
        if attempt < ATTEMPTS:
            again = _differences(pairs, F.col("info"), attempt, False)
        else:  # the exact difference, for what no sketch has peeled
            apart = lambda x, y: F.size(F.array_except(x, y)) + F.size(F.array_except(y, x))
            again = pairs.select("block", "rn", "info", apart("a", "e").cast("long").alias("d_edited"), F.lit(0).alias("left_edited"),
                                 apart("a", "b").cast("long").alias("d_next"), F.lit(0).alias("left_next"))
        again = written(again, f"attempt{attempt}")
        solved = again.where("left_edited = 0 and left_next = 0").select("block", "rn", "d_edited", "d_next")
        done = solved if done is None else done.unionByName(solved)
        failed = again.where("left_edited > 0 or left_next > 0").select("block", "rn", "info")
    if done is None:
        return results
    done = done.select(F.col("block").alias("_b"), F.col("rn").alias("_r"), F.col("d_edited").alias("_e"), F.col("d_next").alias("_n"))
    joined = results.join(done, (results["block"] == done["_b"]) & (results["rn"] == done["_r"]), "left")
    return joined.withColumn("d_edited", F.coalesce("_e", "d_edited")).withColumn("d_next", F.coalesce("_n", "d_next"))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, paragraphs, differing_edited, differing_next."""
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    own = own.select("doc_id", F.xxhash64("text").alias("h"), "text", digests(F.col("text")).alias("a"))
    # A generator's output is computed once; plain projections would be merged and the edited
    # text and its digests computed again for every use.
    rows = with_next(own)
    rows = rows.select("block", "rn", "doc_id", "h", "a", "b", "next_id", "next_h", F.inline(F.array(F.struct(
        F.char_length("text").cast("long").alias("n_chars"), _edited(F.col("text"), F.col("next_text")).alias("edited")))))
    rows = rows.select("block", "rn", "doc_id", "h", "a", "b", "next_id", "next_h", "n_chars", F.inline(F.array(F.struct(
        F.sha2("edited", 256).alias("sha"), digests(F.col("edited")).alias("e")))))
    info = F.struct("doc_id", "h", "next_id", "next_h", "n_chars", "sha", F.size("a").alias("na"), F.size("e").alias("ne"),
                    F.size("b").alias("nb"))
    results = written(_differences(rows, info, 0, True), "differences")
    out = _retried(results, own)
    label = lambda size, cells: F.concat(F.hex(F.col(size).cast("long")), F.lit("|"), F.col(cells))
    return out.select(
        "info.doc_id", "info.n_chars", F.col("info.sha").alias("edited_sha256"),
        label("info.na", "cells_own").alias("fingerprint"), label("info.ne", "cells_edited").alias("edited_fingerprint"),
        _likeness(F.col("info.na"), F.col("info.ne"), F.col("d_edited")).alias("near_edited"),
        _likeness(F.col("info.na"), F.col("info.nb"), F.col("d_next")).alias("near_next"),
        F.col("info.na").alias("paragraphs"), F.col("d_edited").alias("differing_edited"),
        F.col("d_next").alias("differing_next"))
