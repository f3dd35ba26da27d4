"""Toxicity scores on noisy-channel restored text (operator 9).

Writers hide words by look-alike symbols, spaced letters and repeated letters. Each suspicious
stretch becomes a lattice: every character offers the letters it may stand for, symbols may be
dropped, runs shortened and single letters joined, with word ends between them. A Viterbi search finds the likeliest
letters under a character trigram model of the corpus and fixed channel costs. Restored words
are then scored with the words as written.

The character model is counted over the texts of all documents; it reads no label. The full
counts are a written table. Of it, the tasks get every letter, and the pairs and triples that make
up ``MIN_SHARE`` of their rarest letter or more: a letter can have at most 3 / ``MIN_SHARE`` such
triples, so their number follows the alphabets and not the input, and a rare script keeps as much
detail as a common one. Ideographs and Hangul syllables are sent as single letters only: no symbol
stands for them, so a lattice never has to choose between them.

The lexicon is learnt from all labelled rows that are not held out, so that a term's precision
is its rate in the corpus at any input size: words and word beginnings that are commoner in rows
with label 1 than chance among all candidates allows, and nearly always come with it. A text's
score is the probability that any of its lexicon terms is right, or a low floor without one.
Model sizes are bounded, so the model travels with the tasks; scoring is one pass over whole
texts without a shuffle, counting terms moves the labelled rows only.

Edge cases: a null text counts as empty and gets the floor; without labels every row gets it;
labels of a repeated id count as 1 if any is; texts of any length are read whole, a long stretch
in parts and overlapping pieces; columns of any other name do not matter; repeated rows are separate rows; an empty table
gives an empty result; other columns are ignored, and kept by :func:`drop_toxic`.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydroframe.llm.common import ready_workers, route, row_and, written

HELD_OUT = (5, 0)  # ids whose CRC-32 leaves 0 modulo 5 are never learnt from
MAX_TERMS = 500_000  # of the lexicon: the model's size, tens of MB in a worker
MIN_SHARE = 1e-4    # of the occurrences of a gram's rarest letter; rarer grams are backed off
MAX_WORDS = 300_000  # different words that a task holds at a time
MIN_ROWS = 5        # rows with label 1 that a term needs
MIN_PRECISION = 0.8
ALL_ROWS = ""       # counted as a term that every row has; words are never empty
FLOOR = 0.01

# Letters that a symbol may stand for; other symbols can only be dropped.
LOOKALIKE = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a",
             "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "2": "z",
             "*": "aeiou", "#": "h"}
EDGES = ".,;:?!\"')]}>*#%&"  # punctuation after a word
WORDS = re.compile(r"[^\W\d_]+")
REPEAT = re.compile(r"([^\W\d_])\1\1")
# Single letters, or symbols that stand for one, with blanks between them.
_LETTER = rf"(?:\w|[{re.escape(''.join(c for c in LOOKALIKE if not c.isalnum()))}](?!\S))"
SPELT = re.compile(rf"(?<![^\s\"\[{{]){_LETTER}(?:\s+{_LETTER}){{2,}}(?!\w)")
INSIDE = re.compile(r"[^\W\d_].*[\W\d_].*[^\W\d_]|^[\d@$!|+(€£¡*]+[^\W\d_]{2}|[^\W\d_]{2}[\d@$]+$", re.S)
SYLLABLE = re.compile("[\u3400-\u4dbf\u4e00-\u9fff\ua000-\ua4cf\uac00-\ud7a3\uf900-\ufaff\U00020000-\U0003ffff]")
MAX_STRETCH = 40  # longer stretches are keys, numbers or links: they are decoded in pieces
SEPARATORS = re.compile(r"[-_/.,:;=&?%\\~]+")

# Channel costs, in nats: a look-alike for its letter, a dropped separator, a dropped look-alike,
# a dropped letter of a run of three or more.
COST_LOOKALIKE, COST_DROP, COST_DROP_LOOKALIKE, COST_REPEAT = 1.0, 1.0, 15.0, 0.7
SLACK, BEAM, WIDTH = 4.0, 12.0, 64  # nats that a reading of a spelt run may cost more than the best; the search's own
DECODINGS = 3  # likeliest readings of a stretch that are looked up


class CharModel:
    """Character trigrams with back-off to bigrams and letters."""

    def __init__(self, grams: dict[str, int]):
        self.grams = grams
        self.letters = sum(n for g, n in grams.items() if len(g) == 1) or 1
        self.kinds = sum(len(g) == 1 for g in grams) + 1

    def cost(self, a: str, b: str, c: str) -> float:
        g = self.grams
        one = (g.get(c, 0) + 0.5) / (self.letters + 0.5 * self.kinds)
        two = (g.get(b + c, 0) + 2 * one) / (g.get(b, 0) + 2)
        return -math.log((g.get(a + b + c, 0) + 2 * two) / (g.get(a + b, 0) + 2))


def _runs(stretch: str) -> list[tuple[str, int]]:
    """Every character with the length of the run of equal ones that it stands in."""
    return [(ch, n) for ch, g in groupby(stretch) for n in [len(list(g))] for _ in range(n)]


def _steps(ch: str, length: int, a: str, b: str, cost: float, text: str, model: CharModel) -> list:
    """What a character may add to a reading that ends in two letters: (letters, cost, reading)."""
    options = [(c, COST_LOOKALIKE) for c in LOOKALIKE.get(ch, "")]
    if ch.isalpha():
        options.append((ch, 0.0))
    steps = [((b, c), cost + paid + model.cost(a, b, c), text + c) for c, paid in options]
    if not ch.isalpha():
        steps.append(((a, b), cost + (COST_DROP_LOOKALIKE if options else COST_DROP), text))
    if length > 2 and any(c == b for c, _ in options):  # one more of the letter just written
        steps.append(((a, b), cost + COST_REPEAT, text))
    return steps


def segment(run: str, model: CharModel) -> list[str]:
    """Words of a spelt-out run: a word may end after any character, at the model's cost.

    All words on a reading that costs at most SLACK more than the cheapest one.
    """
    ends = [0.0] + [math.inf] * len(run)  # cheapest reading of the first characters
    spans: list[tuple[int, int, float, str]] = []
    alive: dict[tuple[str, str, int], tuple[float, str]] = {}
    for i, (ch, length) in enumerate(_runs(run)):
        if ends[i] < math.inf:
            alive["^", "^", i] = (ends[i], "")
        new: dict[tuple[str, str, int], tuple[float, str]] = {}
        for (a, b, start), (cost, text) in alive.items():
            for state, value, out in _steps(ch, length, a, b, cost, text, model):
                if (*state, start) not in new or value < new[*state, start][0]:
                    new[*state, start] = (value, out)
        most = min((cost for cost, _ in new.values()), default=0.0) + BEAM
        alive = dict(sorted((x for x in new.items() if x[1][0] <= most), key=lambda x: x[1])[:WIDTH])
        for (a, b, start), (cost, text) in alive.items():
            end = cost + (model.cost(a, b, "$") if text else 0.0)
            spans.append((start, i + 1, end - ends[start], text))
            ends[i + 1] = min(ends[i + 1], end)
    rest = [math.inf] * len(run) + [0.0]
    for start, end, cost, _ in reversed(spans):
        rest[start] = min(rest[start], cost + rest[end])
    return sorted({w for start, end, cost, w in spans if w and ends[start] + cost + rest[end] <= rest[0] + SLACK})


def decode(stretch: str, model: CharModel) -> list[str]:
    """Likeliest letters behind a stretch of characters: Viterbi over the last two letters."""
    best: dict[tuple[str, str], tuple[float, str]] = {("^", "^"): (0.0, "")}
    for ch, length in _runs(stretch):
        new: dict[tuple[str, str], tuple[float, str]] = {}
        for (a, b), (cost, text) in best.items():
            for state, value, out in _steps(ch, length, a, b, cost, text, model):
                if state not in new or value < new[state][0]:
                    new[state] = (value, out)
        best = dict(sorted(new.items(), key=lambda x: x[1])[:32])
    ends = sorted((cost + model.cost(*state, "$"), text) for state, (cost, text) in best.items())
    return [text for _, text in ends[:DECODINGS]]


def stretches(text: str, words: set[str]) -> set[str]:
    """Suspicious stretches of a lower-case text with the given words.

    Tokens with something else than letters inside, and words that repeat a letter three times.
    """
    joined = f" {' '.join(words)} "
    found = {joined[joined.rfind(" ", 0, m.start()) + 1:joined.index(" ", m.end())]
             for m in REPEAT.finditer(joined)}
    for token in set(text.split()):
        if not token.isalpha():
            core = token.rstrip(EDGES)
            core = core.rstrip("$") if core.endswith("$$$") else core
            if not core.isalpha() and INSIDE.search(core):
                found.add(core)
    long = {s for s in found if len(s) > MAX_STRETCH}
    return found.difference(long).union(*map(pieces, long))


def pieces(stretch: str) -> set[str]:
    """What a long stretch is decoded as: its parts between separators, and of parts that are
    long themselves, pieces that overlap by MAX_STRETCH, so that no word of that length is cut."""
    parts = {x for x in SEPARATORS.split(stretch) if x and not x.isdigit()}
    return {x[i:i + 2 * MAX_STRETCH] for x in parts for i in range(0, max(1, len(x) - MAX_STRETCH), MAX_STRETCH)}


def spelt(text: str) -> set[str]:
    """Single letters spelt out with blanks, joined; long runs in pieces that overlap by MAX_STRETCH."""
    found = {"".join(m[0].split()) for m in SPELT.finditer(text)}
    return {s[i:i + 2 * MAX_STRETCH] for s in found for i in range(0, max(1, len(s) - MAX_STRETCH), MAX_STRETCH)}


class Restorer:
    """Words of a text as written and as restored; decoded stretches are remembered."""

    def __init__(self, grams: dict[str, int]):
        self.decode = lru_cache(maxsize=50_000)(lambda s, m=CharModel(grams): decode(s, m))
        self.segment = lru_cache(maxsize=10_000)(lambda s, m=CharModel(grams): segment(s, m))

    def words(self, text: str) -> set[str]:
        low = text.lower()
        words = set(WORDS.findall(low))
        return words.union(*(self.decode(s) for s in stretches(low, words)),
                           *(self.segment(s) for s in spelt(low))) - {""}


def terms(words: set[str]) -> set[str]:
    """Words, and word beginnings of four and five letters (marked by a dash)."""
    return words | {w[:n] + "-" for w in words for n in (4, 5) if len(w) > n}


def _grams_of(tokens: Counter[str]) -> pa.RecordBatch:
    """Counts of letters, pairs and triples of the words in counted tokens, ^^ before and $ after each."""
    words: Counter[str] = Counter()
    for token, n in tokens.items():
        for w in (token,) if token.isalpha() else WORDS.findall(token):
            words[w] += n
    letters = np.frombuffer("".join(f"^^{w}$" for w in words).encode("utf-32-le"), np.uint32).astype(np.int64)
    times = np.repeat(np.fromiter(words.values(), np.int64, len(words)),
                      np.fromiter((len(w) + 3 for w in words), np.int64, len(words)))
    inside = (letters[:-2] != ord("$")) & (letters[1:-1] != ord("$"))
    triples, kinds = pd.factorize((letters[:-2] << 42 | letters[1:-1] << 21 | letters[2:])[inside])
    sums = np.zeros(len(kinds), np.int64)
    np.add.at(sums, triples, times[:-2][inside])
    grams: Counter[str] = Counter()
    for kind, n in zip(kinds.tolist(), sums.tolist()):
        a, b, c = chr(kind >> 42), chr(kind >> 21 & 0x1FFFFF), chr(kind & 0x1FFFFF)
        for gram in (a, a + b, a + b + c, *((b, c, b + c) if c == "$" else ())):
            grams[gram] += n
    return pa.RecordBatch.from_arrays([pa.array(list(grams), pa.string()),
                                       pa.array(list(grams.values()), pa.int64())], names=["gram", "n"])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokens: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            tokens.update((text or "").lower().split())
        if len(tokens) > MAX_WORDS:
            yield _grams_of(tokens)
            tokens.clear()
    yield _grams_of(tokens)


def _common_grams(letters: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [len(g) == 1 or not SYLLABLE.search(g) and n >= MIN_SHARE * min(letters[c] for c in g)
                    for g, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield batch.filter(pa.array(keep, pa.bool_()))
    return run


def count_grams(docs: DataFrame, text: str = "text") -> dict[str, int]:
    """Counts of the letters, pairs and triples of the model, over the words of all ``docs``."""
    every = (docs.select(F.col(text).alias("text")).mapInArrow(_count_grams, "gram string, n long")
             .groupBy("gram").agg(F.sum("n").alias("n")))
    every = written(every, "grams")
    letters = {r["gram"]: r["n"] for r in every.where(F.char_length("gram") == 1).collect()}
    common = every.mapInArrow(_common_grams(letters), "gram string, n long")
    return {r["gram"]: r["n"] for r in common.collect()}


def _count_terms(grams: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(grams)
        for batch in batches:
            counts: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[toxic].update(terms(restorer.words(text or "")) | {ALL_ROWS})
            every = list(counts[0] | counts[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(every, pa.string()), pa.array([counts[1][t] for t in every], pa.int64()),
                 pa.array([counts[0][t] for t in every], pa.int64())], names=["term", "bad", "good"])
    return run


class Scorer:
    def __init__(self, grams: dict[str, int], lexicon: dict[str, float]):
        self.grams, self.lexicon = grams, lexicon
        self._restorer = None

    def score(self, text: str | None) -> float:
        if self._restorer is None:
            self._restorer = Restorer(self.grams)
            self._terms = frozenset(self.lexicon)
        found = terms(self._restorer.words(text or "")) & self._terms
        clean = 1.0 - FLOOR
        for t in sorted(found):
            clean *= 1 - self.lexicon[t]
        return 1.0 - clean

    def __getstate__(self):
        return {"grams": self.grams, "lexicon": self.lexicon, "_restorer": None}


def remainder(doc_id: str) -> F.Column:
    """CRC-32 of the id as text modulo the folds; 1 for a null id, which is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % HELD_OUT[0], F.lit(1))


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "toxic") -> Scorer:
    """Character model from all of ``docs``, lexicon from labelled rows that are not held out."""
    ready_workers(docs.sparkSession)
    marked = labels.select(F.col(doc_id).cast("long").alias("id"), F.col(label).cast("int").alias("toxic"))
    marked = marked.where("id is not null and toxic in (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic"))
    marked = marked.where(remainder("id") != HELD_OUT[1])
    if not marked.where("toxic = 1").limit(1).count():
        return Scorer({}, {})
    own = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    near = route(own, "doc", marked, "id").where("_maybe")  # rows without a label are not moved
    # The same plan at any size: texts and labels meet by id, in tables of labels without texts.
    labelled = near.join(marked.hint("shuffle_hash"), near["doc"] == marked["id"]).select("text", "toxic")
    grams = count_grams(docs, text)
    counts = (labelled.mapInArrow(_count_terms(grams), "term string, bad long, good long").groupBy("term")
              .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).where(F.col("bad") >= MIN_ROWS))
    counts = written(counts, "terms")
    rows = counts.where(F.col("term") == ALL_ROWS).collect()
    counts = counts.where(F.col("term") != ALL_ROWS)
    base = rows[0]["bad"] / (rows[0]["bad"] + rows[0]["good"]) if rows else 0
    if not 0 < base < 1:
        return Scorer(grams, {})
    # A term's surplus of label 1 over the base rate must beat what one of all terms has by chance.
    p = F.col("bad") / (F.col("bad") + F.col("good"))
    surplus = (F.col("bad") * F.log(p / base)
               + F.when(F.col("good") > 0, F.col("good") * F.log((1 - p) / (1 - base))).otherwise(0))
    candidates = max(2, counts.count())
    kept = (counts.withColumn("surplus", surplus)
            .where((p > base) & (F.col("surplus") >= math.log(candidates)))
            .withColumn("precision", (F.col("bad") + 0.5 * base) / (F.col("bad") + F.col("good") + 0.5))
            .where(F.col("precision") >= MIN_PRECISION)
            .orderBy(F.desc("surplus"), "term").limit(MAX_TERMS))
    return Scorer(grams, {r["term"]: min(0.999, r["precision"]) for r in kept.collect()})


def score_column(scorer: Scorer, text: F.Column) -> F.Column:
    """Scores of a text column with a learnt model."""
    from pyspark.sql import SparkSession
    sent = SparkSession.active().sparkContext.broadcast(scorer)

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        return texts.map(sent.value.score, na_action=None).astype("float64")

    return scores(text)


def score_documents(docs: DataFrame, labels: DataFrame, scorer: Scorer | None = None,
                    doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    scorer = scorer or learn(docs, labels, doc_id=doc_id, text=text, label=label)
    ready_workers(docs.sparkSession)
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return (own.withColumn("score", score_column(scorer, F.col("text")))
            .select("doc_id", (remainder("doc_id") == HELD_OUT[1]).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


def drop_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
               label: str = "toxic") -> DataFrame:
    """``docs`` without the rows that score 0.5 or more, all columns kept; no row is moved."""
    scorer = learn(docs, labels, doc_id=doc_id, text=text, label=label)
    own = row_and(docs, score=score_column(scorer, F.col(text)))
    return own.where("score < 0.5").select("row.*")
