"""Best-fit packing of token sequences by a linear grouping scheme (operator 8).

Texts are tokenised, closed with the end id, and only sequences longer than the capacity are
cut. Lengths are integers up to the capacity, so a histogram of at most ``capacity`` rows
describes the whole corpus and is all that reaches the driver. On it:

1. linear grouping: pieces above ``large`` of the capacity, sorted, form groups of equal
   cardinality, and each is rounded up to the longest of its group;
2. the configuration programme over these few sizes is solved by column generation; whole uses
   of configurations are kept, the rest is best-fitted with the small pieces;
3. substitution: each slot of a configuration takes an actual piece of its group, which is
   not longer, so every sequence fits and has more room than planned;
4. best fit: small pieces, longest first, go where the least room is left that holds them.

Packed like this, a sequence holds pieces from anywhere in the table. :func:`pack_in_order` is for
rows whose order matters, such as a mixture of sources: it takes the rows in the order they were
written in, packs window after window of so many pieces with the same scheme, and numbers the
sequences in that order, so any prefix of the sequences holds a prefix of the rows, to within a
window. A window's pieces meet in one task, its size is fixed.

Every step works on runs (so many sequences with the same content lengths), hence its size
follows the capacity and the groups, not the corpus. A run says which ranks of a length go
where; Spark ranks the pieces of each length (hot lengths in hash buckets) and applies it.

Edge cases: a null or empty text is one piece that holds the end id; repeated rows are packed
separately; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hydroframe.llm.common import in_row_order, rank_bits, rank_in_group, ready_workers, written

CAPACITY = 4096
END_ID = 1
GROUPS = 40
LARGE = 1 / 8
CACHE_ENTRIES = 400_000  # pre-tokens whose ids a worker remembers (a generation)
LONGEST_KEPT = 64        # characters of a pre-token that is remembered: entries have a bounded size
WINDOW_PIECES = 16_384   # of ordered packing: what a prefix may be off by, against a few more sequences a window
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"

ORDERED_SCHEMA = PIECE_SCHEMA + ", window long, sequence long, offset long"


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# Texts of these characters are cut into the tokenizer's own pre-tokens, whose ids are looked up;
# other texts are cut at blanks, and only their chunks of other characters go to the tokenizer as
# they are. The tokenizer file's split.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ \n\t\r]*")
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9 \n\t\r]+")


class Remembered(dict):
    """A dict of two generations: when the young one is full it becomes the old one."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.old = most, {}

    def missing(self, keys) -> list:
        """Keys that are not known; old entries that are asked for become young again."""
        new = [k for k in keys if k not in self]
        if len(self) + len(new) > self.most:
            self.old = dict(self)
            self.clear()
            new = list(keys)
        old = self.old
        self.update((k, old[k]) for k in new if k in old)
        return [k for k in new if k not in self]


class WordTokenizer:
    """Ids of whole texts as little-endian bytes; words that a worker has met are remembered.

    The tokenizer splits at white space before anything joins characters, so a text's ids are
    its words' ids in order; texts that hold a special token's string go whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        vocab = self.whole.get_vocab(with_added_tokens=True)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.closes = np.zeros(max(vocab.values()) + 1, bool)  # ids that end a pre-token
        self.closes[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.parts = Remembered(CACHE_ENTRIES)

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_parts(self, parts: list[str]) -> None:
        """Ids of pre-tokens, many to a call: each ends with the one id that closes it."""
        raw = b"".join(self._encode([" ".join(parts[i:i + 256]) for i in range(0, len(parts), 256)]))
        ends = (np.flatnonzero(self.closes[np.frombuffer(raw, "<u4")]) + 1) * 4
        if len(ends) != len(parts):
            raise ValueError("the tokenizer's words are not closed one by one")
        at = 0
        for part, end in zip(parts, ends.tolist()):
            self.parts[part] = raw[at:end]
            at = end

    def batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text: those of its pre-tokens, in order."""
        split: list[list[str]] = []
        whole: dict[int, bytes] = {}
        other: dict[str, bytes] = {}  # chunks of characters that the pre-token pattern does not cover
        for i, t in enumerate(texts):
            if any(s in t for s in self.special):
                whole[i] = self._encode([t])[0]
                split.append([])
            elif PLAIN.fullmatch(t):
                split.append(PARTS.findall(t.lower()))
            else:
                keys: list[str] = []
                for chunk in t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "):
                    if PLAIN.fullmatch(chunk):
                        keys += PARTS.findall(chunk.lower())
                    else:
                        keys.append(" " + chunk)  # no pre-token starts with a blank
                        other[keys[-1]] = b""
                split.append(keys)
        every = set().union(*split).difference(other)
        kept = [k for k in every if len(k) <= LONGEST_KEPT]
        self._learn_parts(self.parts.missing(kept))
        get = self.parts.__getitem__
        if other or len(kept) < len(every):
            long = [k for k in every if len(k) > LONGEST_KEPT]
            rare = dict(zip(other, self._encode([k[1:] for k in other]))) | dict(zip(long, self._encode(long)))
            get = lambda k, own=get: rare[k] if k in rare else own(k)
        return [whole[i] if i in whole else b"".join(map(get, s)) for i, s in enumerate(split)]


@lru_cache(maxsize=1)
def worker_tokenizer(path: str) -> WordTokenizer:
    """One per Python worker, kept from task to task."""
    return WordTokenizer(path)


def _piece_batches(path: str, capacity: int, end_id: int, with_ids: bool, kept: int = 0):
    """Pieces of (doc_id, text) batches; ``kept`` further columns are repeated for every piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, end = worker_tokenizer(path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            texts = [t or "" for t in batch.column(1).to_pylist()]
            of = []
            for row_no, (doc, ids) in enumerate(zip(batch.column(0).to_pylist(), tok.batch(texts))):
                raw = ids + end
                for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at:at + 4 * capacity]
                    row = (doc, piece, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None)
                    of.append(row_no)
                    for col, v in zip(out.values(), row):
                        col.append(v)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            n = 6 if with_ids else 5
            further = [batch.column(2 + i).take(pa.array(of, pa.int64())) for i in range(kept)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in list(zip(out.values(), kinds))[:n]] + further,
                                             names=list(out)[:n] + batch.schema.names[2:2 + kept])
    return run


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                 doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of every text: doc_id, piece, start, length, ids_crc32 (and ids, if asked for)."""
    ready_workers(docs.sparkSession)
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return slim.mapInArrow(_piece_batches(path or tokenizer_path(), capacity, end_id, with_ids),
                           PIECE_SCHEMA + (", ids binary" if with_ids else ""))


# --- the plan, on the histogram of lengths -------------------------------------------------

def solve_configurations(sizes: list[int], demand: list[int], capacity: int,
                         rounds: int = 400) -> list[tuple[list[int], int]]:
    """Fractional configuration programme by column generation, rounded down.

    Returns (uses of each size, whole number of sequences) for the configurations of the basis.
    """
    k = len(sizes)
    basis = np.diag([capacity // s for s in sizes]).astype(float)
    need = np.array(demand, float)
    most = capacity // min(sizes)
    for _ in range(rounds):
        inverse = np.linalg.inv(basis)
        price = np.ones(k) @ inverse
        # Best new configuration: a knapsack over the capacity, one more item in each step.
        best = np.zeros(capacity + 1)
        picks = []
        for _ in range(most):
            gain = np.stack([np.concatenate([np.full(s, -1.0), best[:capacity + 1 - s] + p])
                             for s, p in zip(sizes, price)])
            pick, value = gain.argmax(0), gain.max(0)
            better = value > best + 1e-12
            picks.append(np.where(better, pick, -1))
            best = np.where(better, value, best)
        if best[capacity] <= 1 + 1e-9:
            break
        column, room = np.zeros(k), capacity
        for pick in reversed(picks):
            if pick[room] >= 0:
                column[pick[room]] += 1
                room -= sizes[pick[room]]
        step, x = inverse @ column, inverse @ need
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        basis[:, int(ratio.argmin())] = column
    uses = np.linalg.solve(basis, need)
    return [(basis[:, j].astype(int).tolist(), int(np.floor(uses[j] + 1e-9))) for j in range(k)]


class RunPlan:
    """Sequences in runs; ``entries`` holds (length, first rank, pieces, first sequence, per sequence)."""

    def __init__(self, capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.entries: list[tuple[int, int, int, int, int]] = []
        self.rooms: list[int] = []                     # sorted rooms that some run has
        self.runs: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, sequences)

    def put(self, room: int, first: int, n: int) -> None:
        if n <= 0:
            return
        if room not in self.runs:
            bisect.insort(self.rooms, room)
            self.runs[room] = []
        self.runs[room].append((first, n))

    def open(self, n: int) -> int:
        first = self.sequences
        self.sequences += n
        return first

    def best_fit(self, length: int, rank: int, n: int) -> None:
        """Place ``n`` pieces of one length, each where the least room that holds it is left."""
        while n:
            at = bisect.bisect_left(self.rooms, length)
            if at == len(self.rooms):
                q = self.capacity // length
                new = -(-n // q)
                self.put(self.capacity, self.open(new), new)
                continue
            room = self.rooms[at]
            first, have = self.runs[room].pop()
            if not self.runs[room]:
                del self.runs[room]
                self.rooms.pop(at)
            q = room // length
            full = min(have, n // q)
            if full:
                self.entries.append((length, rank, full * q, first, q))
                self.put(room - q * length, first, full)
                rank, n, first, have = rank + full * q, n - full * q, first + full, have - full
            if have and 0 < n < q:
                self.entries.append((length, rank, n, first, n))
                self.put(room - n * length, first, 1)
                rank, n, first, have = rank + n, 0, first + 1, have - 1
            self.put(room, first, have)


def pack_histogram(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS,
                   large: float = LARGE) -> RunPlan:
    """The plan for pieces given as length -> count."""
    out = RunPlan(capacity)
    if capacity in histogram:
        n = histogram[capacity]
        out.entries.append((capacity, 0, n, out.open(n), 1))
    lengths = sorted((s for s in histogram if s < capacity), reverse=True)
    big = [s for s in lengths if s > large * capacity]
    total = sum(histogram[s] for s in big)
    left: dict[int, list[list[int]]] = {s: [[0, histogram[s]]] for s in lengths}  # ranks not placed yet
    if total:
        ends, cum = [], 0  # ranks over all big pieces, longest first
        for s in big:
            cum += histogram[s]
            ends.append(cum)
        bounds = sorted({round(total * g / groups) for g in range(groups + 1)})
        members = list(zip(bounds, bounds[1:]))
        size_at = lambda r: big[bisect.bisect_right(ends, r)]
        merged: dict[int, list[list[int]]] = {}  # equal rounded sizes are one size
        for a, b in members:
            merged.setdefault(size_at(a), []).append([a, b])
        sizes = list(merged)
        demand = [sum(b - a for a, b in merged[s]) for s in sizes]
        spans = [(merged[s][0][0], merged[s][-1][1]) for s in sizes]
        taken = [a for a, _ in spans]
        for uses, n in solve_configurations(sizes, demand, capacity):
            n = min([n] + [(spans[g][1] - taken[g]) // u for g, u in enumerate(uses) if u])
            if n <= 0 or not any(uses):
                continue
            first, slots = out.open(n), []
            for g, u in enumerate(uses):
                for _ in range(u):
                    slots.append(taken[g])
                    taken[g] += n
            # Substitution: cut the run where the actual length of some slot changes.
            cuts = {0, n}
            for at in slots:
                i = bisect.bisect_right(ends, at)
                while i < len(ends) and ends[i] < at + n:
                    cuts.add(ends[i] - at)
                    i += 1
            marks = sorted(cuts)
            for a, b in zip(marks, marks[1:]):
                room = capacity
                for at in slots:
                    i = bisect.bisect_right(ends, at + a)
                    room -= big[i]
                    before = ends[i - 1] if i else 0
                    out.entries.append((big[i], at + a - before, b - a, first + a, 1))
                out.put(room, first + a, b - a)
        left = {s: left[s] for s in lengths if s not in set(big)}
        for g, (_, end) in enumerate(spans):  # pieces that whole uses of configurations left over
            at = taken[g]
            while at < end:
                i = bisect.bisect_right(ends, at)
                stop = min(end, ends[i])
                left.setdefault(big[i], []).append([at - (ends[i - 1] if i else 0),
                                                    stop - (ends[i - 1] if i else 0)])
                at = stop
    for s in sorted(left, reverse=True):
        for a, b in left[s]:
            out.best_fit(s, a, b - a)
    return out


def _sequences(plan: RunPlan):
    """The sequences of pieces given by their lengths and their ranks among equal lengths."""
    rows = np.array(sorted(plan.entries), np.int64).reshape(-1, 5)
    keys = (rows[:, 0] << 48) + rows[:, 1]

    def of(length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        at = np.searchsorted(keys, (length << 48) + rank, "right") - 1
        return rows[at, 3] + (rank - rows[at, 1]) // rows[at, 4]
    return of


def _placer(plan: RunPlan):
    of = _sequences(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(of(length, rank), pa.int64())],
                                             names=[*batch.schema.names, "sequence_id"])
    return run


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         groups: int = GROUPS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = written(token_pieces(docs, path, capacity, end_id, doc_id, text), "pieces")
    sizes = pieces.groupBy("length").count().collect()  # at most `capacity` rows
    plan = pack_histogram({r["length"]: r["count"] for r in sizes}, capacity, groups)
    keyed = pieces.withColumn("_key", F.xxhash64("doc_id", "piece", "ids_crc32"))
    ranked = rank_in_group(keyed, "length", "_key", ["doc_id", "piece", "start", "ids_crc32"],
                           rank_bits(sum(r["count"] for r in sizes)))
    slim = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    placed = slim.mapInArrow(_placer(plan), PIECE_SCHEMA + ", rank long, sequence_id long")
    before = (Window.partitionBy("sequence_id").orderBy(F.desc("length"), "rank")
              .rowsBetween(Window.unboundedPreceding, -1))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id",
                         F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"))


def _window_packer(capacity: int, groups: int):
    def run(window: pa.Table) -> pa.Table:
        """One window: sequences numbered by their first piece, pieces in row order inside them."""
        window = window.sort_by("place")
        length = window.column("length").to_numpy()
        n = len(length)
        rank = np.empty(n, np.int64)  # among equal lengths, in row order
        by = np.argsort(length, kind="stable")
        sizes, starts, counts = np.unique(length[by], return_index=True, return_counts=True)
        rank[by] = np.arange(n) - np.repeat(starts, counts)
        plan = pack_histogram(dict(zip(sizes.tolist(), counts.tolist())), capacity, groups)
        where = _sequences(plan)(length, rank)
        _, first, own = np.unique(where, return_index=True, return_inverse=True)
        number = np.empty(len(first), np.int64)
        number[np.argsort(first)] = np.arange(len(first))
        sequence = number[own]
        by = np.argsort(sequence, kind="stable")
        before = np.cumsum(length[by]) - length[by]
        heads = np.concatenate([[True], sequence[by][1:] != sequence[by][:-1]])
        offset = np.empty(n, np.int64)
        offset[by] = before - np.maximum.accumulate(np.where(heads, before, 0))
        columns = [window.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32", "window")]
        return pa.table([*columns, pa.array(sequence), pa.array(offset)], names=ORDERED_SCHEMA.replace(" long", "").replace(" int", "").split(", "))
    return run


def pack_in_order(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                  groups: int = GROUPS, doc_id: str = "doc_id", text: str = "text",
                  window_pieces: int = WINDOW_PIECES) -> DataFrame:
    """The columns of :func:`pack`, with sequences that follow the order of the rows of ``docs``.

    Rows are in order as they were written (:func:`common.in_row_order`). Sequence ids are gapless
    from 0; those of a window come before those of the next.
    """
    ready_workers(docs.sparkSession)
    slim = in_row_order(docs, F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    pieces = written(slim.select("doc_id", "text", "file", "row").mapInArrow(
        _piece_batches(path or tokenizer_path(), capacity, end_id, False, 2), PIECE_SCHEMA + ", file string, row long"), "pieces")
    # a piece's place: the pieces of the files before, and those before it in its file
    files = pieces.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(F.col("file").alias("_file"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    own = Window.partitionBy("file").orderBy("row", "piece")
    placed = (pieces.withColumn("n", F.row_number().over(own)).join(F.broadcast(files), F.col("file") == F.col("_file"))
              .withColumn("place", F.col("before") + F.col("n") - 1).withColumn("window", F.floor(F.col("place") / window_pieces)))
    packed = written(placed.select("doc_id", "piece", "start", "length", "ids_crc32", "place", "window")
                     .groupBy("window").applyInArrow(_window_packer(capacity, groups), ORDERED_SCHEMA), "packed")
    used = packed.groupBy("window").agg((F.max("sequence") + 1).alias("n"))
    ahead = Window.orderBy("window").rowsBetween(Window.unboundedPreceding, -1)
    used = used.select(F.col("window").alias("_window"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    return (packed.join(F.broadcast(used), F.col("window") == F.col("_window"))
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("before") + F.col("sequence")).alias("sequence_id"), "offset"))
