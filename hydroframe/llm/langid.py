"""Language identification by rank-order profiles (operator 10).

A language's profile lists its most frequent character n-grams (1 to 3 letters, words bounded by
a separator) in order. A document's own most frequent n-grams are compared to each profile:
the out-of-place distance adds, n-gram by n-gram, how far its places are apart, and the
profile's length for one that the profile lacks. The nearest profile names the language.

Profiles are learnt from a bounded sample of labelled rows, about ``PER_LANGUAGE`` of each
language, chosen by a hash of the id; their size is fixed, so they travel with the tasks.
Prediction is one pass over whole texts, without a shuffle.

Edge cases: a null text or one without a letter is ``und`` with score 0; without any learnt
language every row is; equal distances go to the first language by name; equal counts share
their mean place; texts of any length are read whole; columns of any other name do not matter;
any number of languages is learnt, and the model has PROFILE entries for each; repeated rows are separate rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydroframe.llm.common import hash_fraction, ready_workers

PER_LANGUAGE = 1500
PROFILE = 400
HELD_OUT = (4, 2)  # ids whose CRC-32 leaves 2 modulo 4 are never learnt from
_SEP = 1  # code point that stands for anything but a letter
_BITS = np.uint64(21)


def ngrams(text: str) -> np.ndarray:
    """All 1-, 2- and 3-grams of a text as numbers (21 bits a letter); empty without a letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    kinds, back = np.unique(codes, return_inverse=True)
    letter = np.array([chr(c).isalpha() for c in kinds.tolist()], bool)[back]
    if not letter.any():
        return np.empty(0, np.uint64)
    codes = np.concatenate([[_SEP], np.where(letter, codes, _SEP), [_SEP]]).astype(np.uint64)
    gap = codes == _SEP
    codes = codes[~(gap & np.concatenate([[False], gap[:-1]]))]  # one separator between words
    one = codes[codes != _SEP]
    two = (codes[:-1] << _BITS) | codes[1:]
    three = (two[:-1] << _BITS) | codes[2:]
    return np.concatenate([one, two, three[codes[1:-1] != _SEP]])


def mean_places(counts: np.ndarray) -> np.ndarray:
    """Places from 0 of counts sorted downwards; equal counts share their mean place."""
    _, start, n = np.unique(-counts, return_index=True, return_counts=True)
    return np.repeat(start + (n - 1) / 2, n)


def top_ngrams(text: str, most: int = PROFILE) -> tuple[np.ndarray, np.ndarray]:
    """A text's most frequent n-grams and their places."""
    grams, counts = np.unique(ngrams(text), return_counts=True)
    order = np.lexsort((grams, -counts))
    places = mean_places(counts[order])
    return grams[order[:most]], places[:most]


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by.setdefault(lang, []).append(ngrams(text or ""))
        for lang, parts in by.items():
            grams, counts = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)),
                 pa.array(counts.astype(np.int64))], names=["lang", "gram", "n"])


class Profiles:
    """Places of the learnt n-grams, by n-gram: for each, the languages that have it and where.

    The size follows the entries, at most ``size`` of a language, and not n-grams times languages.
    """

    def __init__(self, rows: list[tuple[str, int, int]], size: int = PROFILE):
        """rows: (language, n-gram, count), at most ``size`` of a language, in any order."""
        self.size = size
        self.langs = sorted({r[0] for r in rows})
        number = {lang: k for k, lang in enumerate(self.langs)}
        by_lang: dict[str, list[tuple[int, int]]] = {}
        for lang, gram, n in rows:
            by_lang.setdefault(lang, []).append((n, gram))
        grams, langs, places = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0)]
        for lang, own in by_lang.items():
            own.sort(key=lambda x: (-x[0], x[1]))
            grams.append(np.array([g for _, g in own], np.int64).view(np.uint64))
            langs.append(np.full(len(own), number[lang]))
            places.append(mean_places(np.array([n for n, _ in own])))
        every = np.concatenate(grams)
        order = np.argsort(every, kind="stable")
        self.grams, first = np.unique(every[order], return_index=True)
        self.bounds = np.append(first, len(every))  # entries of each n-gram
        self.entry_lang, self.entry_place = np.concatenate(langs)[order], np.concatenate(places)[order]

    def distances(self, text: str | None) -> np.ndarray | None:
        """Out-of-place distance to every language; None for a text without a letter.

        An n-gram that a profile lacks counts as ``size`` places away.
        """
        grams, places = top_ngrams(text or "", self.size)
        if not len(grams) or not self.langs:
            return None
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        known = self.grams[at] == grams
        at, places = at[known], places[known]
        many = self.bounds[at + 1] - self.bounds[at]
        entry = np.repeat(self.bounds[at], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        nearer = np.abs(self.entry_place[entry] - np.repeat(places, many)) - self.size
        return float(self.size) * len(grams) + np.bincount(self.entry_lang[entry], nearer, minlength=len(self.langs))

    def nearest(self, text: str | None) -> tuple[str, float]:
        distance = self.distances(text)
        if distance is None:
            return "und", 0.0
        first = int(distance.argmin())
        if len(distance) == 1:
            return self.langs[0], 1.0
        second = np.delete(distance, first).min()
        return self.langs[first], float(1 - distance[first] / second) if second > 0 else 0.0


def learn_profiles(docs: DataFrame, per_language: int = PER_LANGUAGE, size: int = PROFILE,
                   doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Profiles:
    """Profiles of the languages named in ``docs``, from rows that are not held out."""
    ready_workers(docs.sparkSession)
    slim = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(lang).cast("string").alias("lang"),
                       F.col(text).alias("text"))
    slim = slim.where(F.col("lang").isNotNull() & (remainder("id") != HELD_OUT[1]))
    sizes = slim.groupBy("lang").count().collect()  # a row per language, a small part of the model
    if not sizes:
        return Profiles([], size)
    share = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, per_language / r["count"])) for r in sizes], "lang string, share double")
    sample = slim.join(F.broadcast(share), "lang").where(hash_fraction("id") < F.col("share"))
    counts = (sample.select("lang", "text").mapInArrow(_count_batches, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("neg"), "gram")))
    top = counts.groupBy("lang").agg(F.slice(order, 1, size).alias("top"))
    return Profiles([(r["lang"], g["gram"], -g["neg"]) for r in top.collect() for g in r["top"]], size)


def remainder(doc_id: str) -> F.Column:
    """CRC-32 of the id as text modulo the folds; 0 for a null id, which is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % HELD_OUT[0], F.lit(0))


def identify(docs: DataFrame, profiles: Profiles | None = None, doc_id: str = "doc_id",
             text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score (relative margin, 0 to 1)."""
    ready_workers(docs.sparkSession)
    learnt = docs.sparkSession.sparkContext.broadcast(profiles or learn_profiles(docs, doc_id=doc_id, text=text, lang=lang))

    @F.pandas_udf("lang_pred string, score double")
    def nearest(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([learnt.value.nearest(t) for t in texts], columns=["lang_pred", "score"])

    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return (own.withColumn("p", nearest("text"))
            .select("doc_id", (remainder("doc_id") == HELD_OUT[1]).alias("held_out"), "p.lang_pred", "p.score"))
