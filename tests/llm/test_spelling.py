"""Spelling variants against a comparison of all pairs of words, and their edge cases."""

import random
import re
import zlib
from collections import Counter

import pytest

from hydroframe.llm import spelling as S
from tests.llm.helpers import EDGE_TEXTS, edge_docs, empty_docs

COLS = ["word", "form", "root", "n", "n_near", "form_n"]


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    vocab = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [x for x in vocab if one_edit(w, x)] for w in vocab}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-vocab[x], x), default=None)
        form[w] = best if best is not None and vocab[best] >= 5 * vocab[w] else None
    out = []
    for w in vocab:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, vocab[w], len(near[w]), vocab[form[w]] if form[w] else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=str)


def texts():
    rnd = random.Random(5)
    stems = ["".join(rnd.choice("abéßzÿ×") for _ in range(rnd.randint(6, 9))) for _ in range(40)] + ["Prefix" + c + "same" for c in "abcdefgh"]
    words = []
    for i, stem in enumerate(stems):
        words += [stem] * rnd.choice([5, 30, 200])
        for _ in range(4):
            at = rnd.randrange(len(stem))
            edited = rnd.choice([stem[:at] + stem[at + 1:], stem[:at] + rnd.choice("aéz") + stem[at:], stem[:at] + "b" + stem[at + 1:]])
            words += [edited] * rnd.choice([1, 4, 5, 7, 40])
            words += [edited[:-1] + "y"] * rnd.choice([5, 6])
    words += [f"chain{'x' * k}" for k in range(1, 6) for _ in range(5 * 6 ** (5 - k))]  # forms that lead on to forms
    rnd.shuffle(words)
    return [(d, " ".join(words[d::9]) + (" 123abcdef-ABCDEF" * 3)) for d in range(9)]


@pytest.mark.parametrize("file_words", [S.FILE_WORDS, 4])
def test_equals_all_pairs(spark, file_words):
    docs = texts()
    got = rows_of(S.spelling_groups(spark.createDataFrame(docs, "doc_id long, text string"), file_words))
    assert got == brute(docs)
    assert any(r[1] and r[2] != r[1] for r in got)


def test_a_third_of_the_words_share_one_half(spark):
    rnd = random.Random(9)
    words = ["common" + "".join(rnd.choice("abcd") for _ in range(6)) for _ in range(250)]
    words += ["".join(rnd.choice("efgh") for _ in range(9)) for _ in range(500)]
    docs = [(d, " ".join(words)) for d in range(6)]
    got = rows_of(S.spelling_groups(spark.createDataFrame(docs, "doc_id long, text string"), file_words=20))
    assert got == brute(docs)


def test_edges(spark):
    docs = [(r[0], r[1]) for r in EDGE_TEXTS] + [(50 + i, "Ünïcödé naïveté " + "q" * 30_000) for i in range(6)]
    assert rows_of(S.spelling_groups(edge_docs(spark, [(*r, "en", "a") for r in docs]))) == brute(docs)
    assert rows_of(S.spelling_groups(empty_docs(spark))) == []


def test_counts_pass_through_full_stores(spark, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(S, "HELD_WORDS", 3)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, None], "text": ["abcdefg hijklmn opqrstu", "abcdefg vwxyzab", None]})
    total = Counter()
    for b in S._count_words(iter([batch])):
        for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            total[w] += n
    assert total["abcdefg"] == 2 and sum(total.values()) == 5
