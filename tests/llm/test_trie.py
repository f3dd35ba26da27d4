"""Prefix trie against a plain dictionary of prefixes, and its edge cases."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest

from hydroframe.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, depth long, words string, p1 string, piece string"
COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, "w", "p", "q") for r in rows], SCHEMA)


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        seq = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in kids[node])
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest()) for n, m in members.items())


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def talks():
    rows = []
    for c in range(0, 130):
        if c == 40:  # the opening conversation of a block is absent
            continue
        for t in range(1 + (c * 7) % 5):
            text = f"same start {t}" if c % 3 == 0 and t < 3 else f"text {c if c % 4 else 1} {t} of  words\n{t}"
            rows.append((c, None if t == 0 and c % 11 == 0 else t, None if c % 9 == 0 else ("user", "assistant")[t % 2], None if c % 13 == 5 else text))
    for c in (200, 220, 240, 260, 280):  # whole copies
        rows += [(c, t, "user", f"copy {t}") for t in range(4)]
    return rows


@pytest.mark.parametrize("bits", [None, 4])
def test_equals_the_plain_trie(spark, bits):
    rows = talks()
    assert rows_of(T.prefix_trie(table(spark, rows), cell_bits=bits)) == brute(rows)


def test_one_conversation_holds_a_third_of_the_rows(spark):
    rows = [(100, t, "user", f"turn {t}") for t in range(3000)] + [(120, t, "user", f"turn {t}") for t in range(2500)]
    rows += [(c, 0, "user", "hello") for c in range(300, 1300)]
    got = rows_of(T.prefix_trie(table(spark, rows)))
    assert got == brute(rows)


def test_empty_and_rows_without_an_id(spark):
    assert rows_of(T.prefix_trie(table(spark, []))) == []
    assert rows_of(T.prefix_trie(table(spark, [(None, 0, "user", "x")]))) == []


def test_long_text_and_repeated_rows(spark):
    rows = [(1, 0, "user", "word " * 300_000), (1, 1, "user", "b"), (1, 1, "user", "b"), (2, 0, "user", "word " * 300_000), (2, 1, "user", "b"),
            (20, 0, "a", "same"), (20, 0, "a", "same"), (21, 5, "z", "own")]
    assert rows_of(T.prefix_trie(table(spark, rows))) == brute(rows)


def test_path_values_are_summed_over_blocks(spark):
    nodes = spark.createDataFrame([(1, d, 1 + d % 3) for d in range(2, 60)] + [(2, 0, 5), (2, 1, 0), (2, 2, 4)], "conv_id long, depth long, value long")
    got = {(r.conv_id, r.depth): r.above for r in T._value_above(nodes, block=7).collect()}
    rows = [(r.conv_id, r.depth, r.value) for r in nodes.collect()]
    assert got == {(c, d): sum(v for k, e, v in rows if k == c and e < d) for c, d, _ in rows}
