"""Operator 6 against brute force, with hot groups of near copies and common passages."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from hydroframe.llm import jaccard_join, queries
from hydroframe.llm.common import documents
from tests.conftest import SF_SMALL
from tests.llm.helpers import EDGE_TEXTS, docs_of, edge_docs, empty_docs


def shingles(text, words):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(w) < words:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k:k + words]) for k in range(len(w) - words + 1))


def brute(docs, words=4, percent=85):
    """(doc_id, set size, component_id) of every document."""
    rows = [(d, shingles(t, words)) for d, t in docs]
    ids = defaultdict(list)
    for d, s in rows:
        ids[s].append(d)
    sets = [s for s in ids if s]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for k, s in enumerate(sets):
        for t in s:
            where[t].append(k)
    common = Counter((a, b) for own in where.values() for i, b in enumerate(own) for a in own[:i])
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            parent[find(a)] = find(b)
    least = {}
    for k, s in enumerate(sets):
        own = [d for d in ids[s] if d is not None]
        if own:
            least[find(k)] = min(own + [least.get(find(k), own[0])])
    number = {s: k for k, s in enumerate(sets)}
    return [(d, len(s), least.get(find(number[s])) if s else d) for d, s in rows]


def check(rows, docs, words=4, percent=85):
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows)
    assert got == Counter(brute(docs, words, percent))


def test_join_of_the_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in documents(spark, SF_SMALL).collect()]
    check(queries.op6_jaccard_join(spark, SF_SMALL).collect(), docs)


@pytest.mark.parametrize("seed,words,percent", [(1, 4, 85), (3, 2, 60)])
def test_join_with_hot_groups(spark, monkeypatch, seed, words, percent):
    monkeypatch.setattr(jaccard_join, "GROUP_MEMBERS", 8)
    monkeypatch.setattr(jaccard_join, "QUERIES_A_TASK", 5)
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randint(0, 400))
    line = [word() for _ in range(25)]
    texts = []
    for _ in range(6):  # groups whose members are a few words apart, chained and around one text
        base = [word() for _ in range(rng.randint(40, 120))]
        for _ in range(rng.choice([5, 40])):
            own = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 40)):
                own[rng.randrange(len(own))] = word()
            if rng.random() < 0.3:
                base = own
            texts.append(" ".join(own))
    texts += [" ".join(line + [word() for _ in range(rng.randint(0, 12))]) for _ in range(60)]
    texts += [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(80)]
    texts += texts[:20] + ["x", "X", "x y", "", " ", None]
    rng.shuffle(texts)
    rows = jaccard_join.jaccard_components(docs_of(spark, texts), words, percent).collect()
    check(rows, list(enumerate(texts)), words, percent)
    sizes = Counter(r["component_id"] for r in rows)
    assert max(sizes.values()) > 10


def test_join_edges(spark):
    check(jaccard_join.jaccard_components(edge_docs(spark)).collect(), [(d, t) for d, t, *_ in EDGE_TEXTS])
    assert jaccard_join.jaccard_components(empty_docs(spark)).count() == 0


def test_one_of_each_component_stays(spark):
    base = " ".join(f"w{i}" for i in range(60))
    texts = [base, base + " end", "other words are here and there", base + " end now", "", ""]
    docs = docs_of(spark, texts)
    out = jaccard_join.drop_near_copies(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [0, 2, 4, 5]
    assert jaccard_join.drop_near_copies(empty_docs(spark)).count() == 0


def test_shingle_sets_follow_words_and_slices(monkeypatch):
    texts = [b"", b" ", b"One two", b"one  TWO", b"a b c d e", b"A B\tC\nD E", b"a b c d", b"e d c b a", "é É".encode()]
    whole = [s.tolist() for s in jaccard_join.shingle_sets(texts)]
    assert [len(s) for s in whole] == [0, 0, 1, 1, 2, 2, 1, 2, 1]
    assert whole[2] == whole[3] and whole[4] == whole[5] and set(whole[6]) < set(whole[4]) and whole[7] != whole[4]
    monkeypatch.setattr(jaccard_join, "SLICE_BYTES", 5)
    assert [s.tolist() for s in jaccard_join.shingle_sets(texts)] == whole


@pytest.mark.parametrize("percent", [60, 80, 85, 100])
def test_prefixes_of_linked_sets_meet(percent):
    rng = np.random.default_rng(1)
    sketch = rng.integers(0, 50, 1 << jaccard_join.SKETCH_BITS).astype(np.uint32)
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 40)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 2**63, rng.integers(0, 4)).astype(np.uint64)]))
        n = len(np.intersect1d(a, b))
        if len(b) and jaccard_join.linked(n, len(a), len(b), percent):
            pa, pb = (jaccard_join.prefix(x, sketch, percent) for x in (a, b))
            assert len(np.intersect1d(pa, pb))


def test_bitmaps_never_rule_a_link_out():
    rng = np.random.default_rng(2)
    for _ in range(400):
        n = int(rng.integers(1, 900))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.uniform(0.7, 1)], rng.integers(0, 2**63, rng.integers(0, 60)).astype(np.uint64)]))
        if not len(b):
            continue
        common = len(np.intersect1d(a, b))
        apart = len(a) + len(b) - 2 * common
        bits = [np.frombuffer(jaccard_join.parity_bitmap(x), np.uint8) for x in (a, b)]
        least = jaccard_join.least_difference(*bits)
        assert least <= apart
        for percent in (50, 85, 100):
            most = jaccard_join.most_difference(len(a), len(b), percent)
            assert jaccard_join.linked(common, len(a), len(b), percent) == (apart <= most)
