"""Spelling variants: words one edit apart, found with a bit-sliced position index.

Words are counted over all documents; those of ``MIN_LETTERS`` letters and ``MIN_COUNT``
occurrences are the vocabulary. Two words are near if one letter is inserted, deleted or replaced.
A word's form is its near word of the largest count, if that is ``FORM_RATIO`` times its own.

Method. The index holds, per (position, letter), a bitset over a slab of the vocabulary. A query
walks its letters and updates three bitsets for all words of the slab at once: ``zero`` (the prefix
matches), ``replaced`` (one letter differs) and ``inserted`` (the word has one letter more, so it is
read one position further on). Deletions are the same pairs seen from the longer word.

Which words meet. If words of b and b or b + 1 letters are one edit apart, they share their first
b // 2 letters or their last b - b // 2. So a word is filed under both halves, in band b = its
length and b = its length - 1, and only words of one file are compared; a pair in both files counts
in the first. A file of any size works: one above ``FILE_WORDS`` words is cut into blocks by a hash
of the word, and each pair of blocks is a unit of its own for some task. Tasks hold one slab (small
files together) or one unit at a time; pairs are summed in the task and never written out.

Edge cases. Null text has no words; a null doc_id counts as an empty id in the checksum. Letters
beyond U+00FF end a run; texts and runs of any length count whole. Of near words with equal counts
the smallest by code point is the form. Repeated rows count again. Empty table: no rows. Columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydroframe.llm.common import ready_workers, written

MIN_LETTERS, MIN_COUNT, FORM_RATIO = 6, 5, 5
SLIP = 199               # a run whose checksum this divides loses a letter
HELD_WORDS = 400_000     # distinct words a task holds before it passes their counts on
FILE_WORDS = 8192        # words of one file that are compared in one unit
SLAB_WORDS = 2048        # small files are searched together up to this many words
SLAB_CELLS = 1 << 17     # 64-bit cells of one bitset matrix (queries x words)

# One byte a letter: bytes of ISO 8859-1 are the code points; everything that is no letter is a blank.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 192 else 32 for c in range(256))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) rows to (word, n): one row for each word and full store of the task."""
    store: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        words = [w.decode("latin-1") for w in store]
        batch = pa.RecordBatch.from_pydict({"word": pa.array(words, pa.string()), "n": pa.array(list(store.values()), pa.int64())})
        store.clear()
        return batch

    for b in batches:
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
            t = text.as_py()
            if not t:
                continue
            start = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
            runs = Counter(t.encode("latin-1", "replace").translate(_LETTERS).split())
            for run, n in runs.items():
                if len(run) < MIN_LETTERS:
                    continue
                h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
                if h % SLIP == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                    if len(run) < MIN_LETTERS:
                        continue
                store[run] += n
            if len(store) >= HELD_WORDS:
                yield out()
    if store:
        yield out()


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of enough letters and occurrences."""
    ready_workers(docs.sparkSession)
    counts = docs.select("doc_id", "text").mapInArrow(_count_words, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def _filed(vocab: DataFrame, file_words: int) -> DataFrame:
    """Each word in the files of its halves: (band, file, lo, hi, blk, word, n).

    (file, lo, hi) is a unit: the file's block ``lo`` against its block ``hi``.
    """
    size = F.length("word")
    bands = F.filter(F.array(size, size - 1), lambda b: b >= MIN_LETTERS)
    w = vocab.withColumn("band", F.explode(bands))
    half = F.floor(F.col("band") / 2).cast("int")
    first = F.concat(F.lit("<"), F.substring("word", F.lit(1), half))
    last = F.concat(F.lit(">"), F.right(F.col("word"), F.col("band") - half))
    w = w.withColumn("file", F.explode(F.array(first, last)))
    large = (w.groupBy("band", "file").agg(F.count(F.lit(1)).alias("words")).where(F.col("words") > file_words)
             .select("band", "file", F.ceil(F.col("words") / file_words).cast("int").alias("blocks")))
    w = w.join(large, ["band", "file"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    w = w.withColumn("blk", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    w = w.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return w.select("band", "file", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi"), "blk", "word", "n")


class _Slab:
    """Words of one band and some units: the bit-sliced index and the search of all its queries."""

    def __init__(self, band: int, units: np.ndarray, first: np.ndarray, cross: np.ndarray, blk: np.ndarray,
                 words: list[bytes], n: np.ndarray):
        self.band, self.units, self.first, self.cross, self.blk, self.words, self.n = band, units, first, cross, blk, words, n
        self.cells = -(-len(words) // 64)
        self.size = np.array([len(w) for w in words])
        letters = np.zeros((len(words), band + 2), np.uint8)  # 0: past the end
        flat = np.frombuffer(b"".join(words), np.uint8)
        letters[np.arange(band + 2) < self.size[:, None]] = flat
        self.letters = letters

    def _bits(self, flags: np.ndarray) -> np.ndarray:
        packed = np.packbits(flags, axis=-1, bitorder="little")
        out = np.zeros((*flags.shape[:-1], self.cells * 8), np.uint8)
        out[..., :packed.shape[-1]] = packed
        return out.view(np.uint64)

    def _position(self, i: int) -> np.ndarray:
        """The bitsets of position ``i``, one for each letter code in use (row 0 is empty)."""
        col = self.letters[:, i]
        used = np.flatnonzero(np.bincount(col, minlength=256)[1:]) + 1
        rows = np.zeros(256, np.int64)
        rows[used] = np.arange(1, len(used) + 1)
        sets = np.concatenate([np.zeros((1, self.cells), np.uint64), self._bits(col[None, :] == used[:, None])])
        return sets, rows

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of all near pairs whose shorter word has ``band`` letters; those of equal length both ways."""
        queries = np.flatnonzero(self.size == self.band)
        longer = self._bits(self.size == self.band + 1)
        found_q, found_w = [], []
        step = max(64, SLAB_CELLS // self.cells)
        index = [self._position(i) for i in range(self.band + 1)]
        for at in range(0, len(queries), step):
            q = queries[at:at + step]
            meet = self.units[q][:, None] == self.units[None, :]
            meet &= ~self.cross[q][:, None] | (self.blk[q][:, None] != self.blk[None, :])
            zero = self._bits(meet)
            replaced, inserted = np.zeros_like(zero), np.zeros_like(zero)
            for i in range(self.band):
                letter = self.letters[q, i]
                (here, row), (ahead, row_ahead) = index[i], index[i + 1]
                same, shifted = here[row[letter]], ahead[row_ahead[letter]]
                replaced = (replaced & same) | (zero & ~same)
                inserted = (inserted | zero) & shifted
                zero &= same
            near = (replaced & ~longer) | ((inserted | zero) & longer)
            some = np.flatnonzero(near.any(axis=1))
            hit = np.unpackbits(near[some].view(np.uint8), axis=1, bitorder="little")[:, :len(self.words)]
            a, b = np.nonzero(hit)
            found_q.append(q[some[a]])
            found_w.append(b)
        if not found_q:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_q), np.concatenate(found_w)

    def result(self) -> pa.RecordBatch | None:
        """(word, n_near, best_n, best) for the words with a near word in their unit."""
        q, w = self.pairs()
        half = self.band // 2
        head = np.array([x[:half] for x in self.words], f"S{half}")
        new = self.first[q] | (head[q] != head[w])  # a pair that shares its first half counts there
        q, w = q[new], w[new]
        longer = self.size[w] > self.band
        src, dst = np.concatenate([q, w[longer]]), np.concatenate([w, q[longer]])
        if not len(src):
            return None
        rank = np.empty(len(self.words), np.int64)
        rank[sorted(range(len(self.words)), key=self.words.__getitem__)] = np.arange(len(self.words))
        order = np.lexsort((rank[dst], -self.n[dst], src))
        src, dst = src[order], dst[order]
        at = np.flatnonzero(np.concatenate([[True], src[1:] != src[:-1]]))
        return pa.RecordBatch.from_pydict({
            "word": pa.array([self.words[i].decode("latin-1") for i in src[at]], pa.string()),
            "n_near": np.diff(np.append(at, len(src))), "best_n": self.n[dst[at]],
            "best": pa.array([self.words[i].decode("latin-1") for i in dst[at]], pa.string())})


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of whole units to near-word sums; one slab is held at a time."""
    held: list[tuple] = []

    def slab(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if len(rows) > 1:
            ids: dict[tuple, int] = {}
            units = np.array([ids.setdefault(r[1:4], len(ids)) for r in rows])
            out = _Slab(rows[0][0], units, np.array([r[1][0] == "<" for r in rows]), np.array([r[2] != r[3] for r in rows]),
                        np.array([r[4] for r in rows]), [r[5].encode("latin-1") for r in rows], np.array([r[6] for r in rows])).result()
            if out is not None:
                yield out

    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if held and (row[0] != held[0][0] or len(held) >= SLAB_WORDS and row[:4] != held[-1][:4]):
                yield from slab(held)
                held = []
            held.append(row)
    yield from slab(held)


def near_words(vocab: DataFrame, file_words: int = FILE_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) for the words of ``vocab`` (word, n) that have a near word."""
    units = _filed(vocab, file_words).repartition("band", "file", "lo", "hi").sortWithinPartitions("band", "file", "lo", "hi")
    found = units.mapInArrow(_search, "word string, n_near long, best_n long, best string")
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                      F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top"))
            .select("word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) by pointer doubling over (word, form, n).

    Counts grow ``FORM_RATIO`` times with each step, which bounds the length of a chain and so
    the rounds by the logarithm of the largest count.
    """
    top = forms.agg(F.max("form_n")).first()[0]
    if top is None:
        return forms.select("word", F.col("form").alias("root"))
    steps = max(1, math.ceil(math.log(top / MIN_COUNT, FORM_RATIO)) + 1)
    state = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps))):
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        state = written(state.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return state


def spelling_groups(docs: DataFrame, file_words: int = FILE_WORDS) -> DataFrame:
    """One row per word of the vocabulary: word, form, root, n, n_near, form_n."""
    vocab = written(vocabulary(docs), "vocabulary")
    found = near_words(vocab, file_words)
    enough = F.col("best_n") >= FORM_RATIO * F.col("n")
    words = written(vocab.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, F.col("best")).alias("form"), F.when(enough, F.col("best_n")).alias("form_n")), "words")
    roots = _roots(words.where("form IS NOT NULL"))
    return (words.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def oracle() -> str:
    """The groups in DuckDB SQL: near words by equal texts after one letter is taken out."""
    return r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
g AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x
  FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run),
steps AS (SELECT list(list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8],
    lambda s, k: CASE WHEN s % 2 = 1 THEN xor(s // 2, 3988292384::BIGINT) ELSE s // 2 END) ORDER BY i) AS crc_table
  FROM range(256) r(i)),
h AS (SELECT run, n, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i::INT + 1, 2))::BIGINT)),
    lambda s, b: xor(s // 256, crc_table[(xor(s, b) % 256 + 1)::INT])), 4294967295::BIGINT) AS h FROM g, steps),
words AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word,
    sum(n)::BIGINT AS n FROM h GROUP BY 1),
v AS (SELECT word, n FROM words WHERE length(word) >= 6 AND n >= 5),
less AS (SELECT word, n, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS rest FROM v, unnest(range(length(word))) r(i)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN v b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, min((-other_n, other)) AS top FROM near GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -top[1] >= 5 * v.n THEN top[2] END AS form, CASE WHEN -top[1] >= 5 * v.n THEN -top[1] END AS form_n
  FROM v LEFT JOIN best ON best.word = v.word),
chain AS (SELECT word, word AS root FROM f UNION ALL SELECT c.word, f.form FROM chain c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.root FROM chain c JOIN f ON f.word = c.root WHERE f.form IS NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN ends ON ends.word = f.word
"""
