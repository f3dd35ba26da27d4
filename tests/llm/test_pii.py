"""Personal data: base spans against the plain patterns, EM and the classifier on made votes, edge cases."""

import hashlib
import random
import re

import numpy as np
import pytest

from hydroframe.llm import pii as P
from tests.llm.helpers import EDGE_TEXTS, edge_docs, empty_docs

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def keeps(kind, span):
    digits = re.sub("[^0-9]", "", span)
    if kind == "ip":
        return all(int(p) <= 255 for p in span.split("."))
    if kind == "card":
        doubled = [int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(digits[::-1])]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    found = [(m.start(), i, m.end()) for i, (kind, pattern) in enumerate(PATTERNS) for m in re.finditer(pattern, text) if keeps(kind, m[0])]
    return sorted(found)


ODD = ["a@b.c@d.e", "@a.b@c.d", "x@y..z a@b-.c", "1.2.3.4.5.6.7.8", "300.1.1.1 1.1.1.300", "00255.0.0.1", "4111 1111-1111 1111", "4111--1111 1111 1111",
       "+1 (988) 555-2485", "+1-", "+1 2345678 9))", "++49 30 123456", "+12 34 56 78 90 12 34 56 78", "é@b.co 😀a@b.co", "1234567890123452 4111111111111111",
       "a.b_%+-@x.yz.", "5.5.5.5@mail.de", "4111111111111111.1.1.1", "me@h.1.2.3.4"]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert P.base_spans(text) == brute(text)


def test_random_texts_equal_the_plain_patterns():
    rnd = random.Random(3)
    for _ in range(4000):
        text = "".join(rnd.choice("ab@.. -+()0123459é4111") for _ in range(rnd.randint(0, 60)))
        assert P.base_spans(text) == brute(text), text


def test_long_texts_take_time_in_proportion():
    for text in ("1" * 400_000, "a" * 400_000, "a@" * 200_000, "1." * 200_000, "+1" * 200_000, "+1 " + "(" * 400_000, "1 " * 200_000, " at a dot b" * 40_000,
                 "a:" * 200_000, "[at]a" * 80_000, "." * 400_000 + "@"):
        P.base_spans(text)
        P.wide_spans(text)


def docs():
    rnd = random.Random(1)
    rows = []
    for i in range(300):
        word = rnd.choice(["river", "stone", "cloud", "window"])
        card = f"4{rnd.randrange(10**14):014d}"
        card += next(c for c in "0123456789" if P.luhn(card + c))
        rows.append(f"{word} mail bob{i}@host{i % 7}.example.com or 81.{i % 250}.7.{i % 200} and card {card}, phone +1 ({200 + i}) 555-{1000 + i} {word}")
    rows += [f"the {w} has 12.5 13.7 14.{i} values in version 1.{i} of 2001-02-1{i % 9}" for i, w in enumerate(["lake", "hill"] * 60)]
    return rows


WIDE = {"Write to john dot smith at example dot com today": "email:9:42", "mail anna [at] example [dot] org please": "email:5:32",
        "phone: (988) 555-2485 ok": "phone:7:21", "visa card 4111  1111  1111  1111 end": "card:10:32", "host 10[.]2[.]3[.]4 down": "ip:5:19"}
CLEAN = ["meet at noon dot the end", "version 2024-01-05 10:20", "order 123 456 789 012", "isbn 978-3-16-148410-0", "he was at home.", "call me at example.com", "", None]


def test_added_spans_and_clean_texts(spark):
    texts = docs() + list(WIDE) + CLEAN
    rows = P.find_personal_data(edge_docs(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        base = brute(text)
        joined = ",".join(f"{P.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))
        if text in WIDE:
            assert r.spans == WIDE[text] and r.n_added == 1
        if texts[r.doc_id] in CLEAN:
            assert r.spans == ""


def test_em_finds_the_reliable_labelers():
    rnd = np.random.default_rng(0)
    truth = rnd.random(20_000) < 0.4
    right = np.array([0.95, 0.9, 0.85, 0.8, 0.6, 0.55])
    vote = np.where((rnd.random((20_000, 6)) < right) == truth[:, None], P.YES, P.NO)
    vote[rnd.random(vote.shape) < 0.2] = P.ABSTAIN
    codes = (vote * 3 ** np.arange(5, -1, -1)).sum(1)
    unique, at, counts = np.unique(codes, return_inverse=True, return_counts=True)
    rates, p = P.reliabilities(unique, counts.astype(float))
    yes = rates[1, :, P.YES] / (rates[1, :, P.YES] + rates[1, :, P.NO])
    assert np.abs(yes - right).max() < 0.05
    assert ((p[at] > 0.5) == truth).mean() > 0.95


def test_edges(spark):
    rows = P.find_personal_data(edge_docs(spark)).collect()
    assert len(rows) == len(EDGE_TEXTS) and sum(r.doc_id is None for r in rows) == 2
    assert P.find_personal_data(empty_docs(spark)).collect() == []


def test_spans_kept_apart():
    assert P.apart([(0, 0, 3), (5, 1, 9), (8, 2, 20), (20, 3, 25)], [(2, 0, 4), (3, 1, 4), (10, 2, 20)]) == [(5, 1, 9), (20, 3, 25)]
