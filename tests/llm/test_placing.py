"""Operators 3, 4, 7 and 8 against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from hydroframe.llm import exact_dedup, packing, pfair_mix, queries, stratified_shards
from hydroframe.llm.common import documents
from tests.conftest import SF_SMALL
from tests.llm.helpers import EDGE_TEXTS, docs_of, edge_docs, empty_docs
from tests.oracle_compare import compare


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


# --- 3: shards ---------------------------------------------------------------------------------

def check_shards(rows, texts, n_shards=16):
    n = len(rows)
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values(), default=0) - min((counts.get(s, 0) for s in range(n_shards)), default=0) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in rows)
    by = defaultdict(Counter)
    for r in rows:
        by[r["source"]][r["shard"]] += 1
    for source, per in by.items():
        share = sum(per.values()) / n
        for s in range(n_shards):
            assert abs(per[s] - share * counts.get(s, 0)) <= 2 + 1e-9, source


def test_shards_of_the_table(spark):
    docs = documents(spark, SF_SMALL)
    rows = queries.op3_stratified_shards(spark, SF_SMALL).collect()
    check_shards(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_small_sources_reach_every_shard_alike(spark):
    rows = [(i, f"t{i}", "en", "big") for i in range(8000)] + [(10_000 + i, f"u{i}", "en", f"one{i}") for i in range(8000)]
    got = stratified_shards.stratified_shards(edge_docs(spark, rows)).collect()
    per = Counter(r["shard"] for r in got if r["source"] != "big")
    assert set(Counter(r["shard"] for r in got).values()) == {1000}
    assert sorted(per) == list(range(16)) and all(abs(n - 500) <= 50 for n in per.values())


def test_shards_edges(spark):
    rows = stratified_shards.stratified_shards(edge_docs(spark)).collect()
    check_shards(rows, [(d, t) for d, t, *_ in EDGE_TEXTS])
    assert stratified_shards.stratified_shards(empty_docs(spark)).count() == 0


def test_shards_hot_source_in_many_buckets(spark):
    from hydroframe.llm.common import rank_in_group
    df = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('s', id % 7)) as g", "xxhash64(id) as k")
    rows = rank_in_group(df, "g", "k", ["id"], 6).collect()
    for g in {r["g"] for r in rows}:
        own = sorted((r for r in rows if r["g"] == g), key=lambda r: r["k"] % 2**64)
        own.sort(key=lambda r: (r["k"] % 2**64 >> 58, r["k"]))
        assert [r["rank"] for r in own] == list(range(len(own)))
        assert {r["group_rows"] for r in own} == {len(own)}


# --- 4: mixing ---------------------------------------------------------------------------------

@pytest.mark.parametrize("parts", [[1], [4, 3, 3, 3, 1, 1, 1], [7, 1], [5, 5, 5], [13, 1, 2, 9, 30, 4]])
def test_edf_keeps_every_prefix_within_one_block(parts):
    slots, total = pfair_mix.edf_period(parts), sum(parts)
    assert Counter(slots) == {i: a for i, a in enumerate(parts)}
    for t in range(total + 1):
        for i, a in enumerate(parts):
            assert abs(slots[:t].count(i) * total - t * a) < total


def check_mix(rows, block_rows, target, default):
    rows = sorted(rows, key=lambda r: r["mix_position"])
    assert [r["mix_position"] for r in rows] == list(range(len(rows)))
    assert [(r["slot"], r["slot_row"]) for r in rows] == sorted((r["slot"], r["slot_row"]) for r in rows)
    slots = {}
    for r in rows:
        assert slots.setdefault(r["slot"], (r["source"], r["block"], r["phase"])) == (r["source"], r["block"], r["phase"])
    assert sorted(slots) == list(range(len(slots)))
    for phase in {p for *_, p in slots.values()}:
        own = [slots[s][0] for s in sorted(slots) if slots[s][2] == phase]
        names = {s for x in sorted(slots) if slots[x][2] >= phase for s in [slots[x][0]]}
        parts = {s: target.get(s, default) for s in names}
        total = sum(parts.values())
        for t in range(len(own) + 1):
            for s, a in parts.items():
                assert abs(own[:t].count(s) - t * a / total) < 1


def test_mix_of_the_table(spark):
    docs = documents(spark, SF_SMALL)
    target = {"src0": 4, "src1": 3}
    rows = pfair_mix.pfair_mix(docs, target, 1, block_rows=3).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in docs.collect())
    check_mix(rows, 3, target, 1)


def test_mix_edges(spark):
    rows = pfair_mix.pfair_mix(edge_docs(spark), {"a": 2}, 1, block_rows=2).collect()
    assert len(rows) == len(EDGE_TEXTS)
    check_mix(rows, 2, {"a": 2}, 1)
    assert pfair_mix.pfair_mix(empty_docs(spark)).count() == 0


def test_mix_order_keeps_rows_and_columns(spark):
    docs = edge_docs(spark)
    out = pfair_mix.in_mix_order(docs, block_rows=2)
    assert out.columns == docs.columns
    assert Counter(map(tuple, out.collect())) == Counter(map(tuple, docs.collect()))


def test_mix_order_is_the_order_of_positions(spark):
    docs = documents(spark, SF_SMALL)
    for range_rows in (3, 40, 10**6):
        out = pfair_mix.in_mix_order(docs, {"src0": 4, "src1": 3}, block_rows=3, range_rows=range_rows)
        got = [r["doc_id"] for r in out.collect()]
        place = {r["doc_id"]: r["mix_position"] for r in pfair_mix.pfair_mix(docs, {"src0": 4, "src1": 3}, block_rows=3).collect()}
        assert [place[d] for d in got] == list(range(len(got)))
    rows = [(i % 50, "same text" if i % 3 else f"text {i}", "en", f"s{i % 4}") for i in range(200)]  # repeated rows at the cuts
    out = pfair_mix.in_mix_order(edge_docs(spark, rows), {"s0": 2}, block_rows=2, range_rows=5)
    assert Counter(map(tuple, out.collect())) == Counter(map(tuple, edge_docs(spark, rows).collect()))
    assert pfair_mix.in_mix_order(empty_docs(spark)).count() == 0


def test_many_sources_without_a_target_are_one_stream(spark):
    rows = [(i, f"text {i}", "en", "big" if i % 3 == 0 else f"site{i}.org") for i in range(600)]
    mix = sorted(pfair_mix.pfair_mix(edge_docs(spark, rows), {"big": 3}, block_rows=2, max_streams=8).collect(), key=lambda r: r["mix_position"])
    assert [r["mix_position"] for r in mix] == list(range(600)) and len({r["source"] for r in mix}) == 401
    slots = {r["slot"]: r["source"] == "big" for r in mix}
    for t in range(1, 201):  # half of the parts, while both streams last
        assert abs(sum(slots[s] for s in range(t)) - t / 2) < 1


def test_whole_rows_are_moved_once(spark):
    from hydroframe.plans.report import final_plan
    plan = final_plan(pfair_mix.in_mix_order(documents(spark, SF_SMALL), range_rows=20))
    assert plan.count("Exchange shufflepartitionidpassthrough") == 1
    assert all("row#" not in line for line in plan.splitlines() if "Exchange" in line and "hashpartitioning" in line)


# --- 7: exact de-duplication -------------------------------------------------------------------

def test_exact_dedup_matches_sql(spark):
    ok, msg = compare(queries.op7_exact_dedup(spark, SF_SMALL), queries.OP7_SQL, SF_SMALL)
    assert ok, msg


def test_exact_dedup_edges(spark):
    rows = exact_dedup.exact_groups(edge_docs(spark)).collect()
    groups = defaultdict(list)
    for d, t, *_ in EDGE_TEXTS:
        groups[hashlib.sha256(norm(t).encode()).hexdigest()].append(d)
    assert len(rows) == len(EDGE_TEXTS)
    for r in rows:
        ids = groups[r["text_sha256"]]
        first = min((d for d in ids if d is not None), default=None)
        assert (r["keep_id"], r["group_size"]) == (first, len(ids))
    for sha, ids in groups.items():
        assert sum(r["kept"] for r in rows if r["text_sha256"] == sha) == 1
    assert exact_dedup.exact_groups(empty_docs(spark)).count() == 0


def test_drop_copies(spark):
    docs = edge_docs(spark)
    out = exact_dedup.drop_copies(docs)
    assert out.columns == docs.columns
    kept = out.collect()
    assert sorted(norm(r["text"]) for r in kept) == sorted({norm(t) for _, t, *_ in EDGE_TEXTS})
    assert {r["doc_id"] for r in kept} == {1, 3, 5, 7, 9, 10, 11, 13, 16, None}
    assert exact_dedup.drop_copies(empty_docs(spark)).count() == 0


def test_filters_merge_without_loss():
    rng = np.random.default_rng(5)
    parts = [rng.integers(0, 2**63, 500).astype(np.uint64) for _ in range(4)]
    parts += [parts[0][:100], np.array([0, 2**64 - 1, 2**32, 2**32 - 1], np.uint64)]
    coded = [exact_dedup.decode_filter(*exact_dedup.encode_filter(*np.unique(p, return_counts=True))) for p in parts]
    values, counts = exact_dedup.merge_sorted(np.concatenate([c[0] for c in coded]),
                                              np.concatenate([c[1] for c in coded]))
    assert Counter(dict(zip(values.tolist(), counts.tolist()))) == Counter(np.concatenate(parts).tolist())


# --- 8: packing --------------------------------------------------------------------------------

def check_packing(rows, docs, capacity=4096):
    tok = packing.WordTokenizer(packing.tokenizer_path())
    want = Counter()
    for d, t in docs:
        ids = np.array(tok.whole.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        for i, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want[(d, i, at, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), -(-sum(r["length"] for r in rows) // capacity)


def test_packing_of_the_table(spark):
    rows = queries.op8_best_fit_packing(spark, SF_SMALL).collect()
    used, least = check_packing(rows, [(r["doc_id"], r["text"]) for r in documents(spark, SF_SMALL).collect()])
    assert used <= least * 1.03 + 1


def test_packing_edges(spark):
    rows = packing.pack(edge_docs(spark)).collect()
    check_packing(rows, [(d, t) for d, t, *_ in EDGE_TEXTS])
    assert packing.pack(empty_docs(spark)).count() == 0
    rows = packing.pack(docs_of(spark, ["a b c d e f g", "a", "b c"]), capacity=4).collect()
    check_packing(rows, list(enumerate(["a b c d e f g", "a", "b c"])), 4)


def test_packing_in_order_of_the_rows(spark, tmp_path):
    rng = random.Random(3)
    texts = [" ".join(["word"] * rng.randint(0, 30)) for _ in range(400)]
    ids = rng.sample(range(10_000), 400)
    cuts = [0, 3, 200, 210, 211, 399, 400]  # files of very different sizes
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        rows = edge_docs(spark, [(ids[i], texts[i], "en", "a") for i in range(a, b)])
        rows.coalesce(1).write.parquet(str(tmp_path / f"part{k}"))
    docs = spark.read.parquet(*[str(tmp_path / f"part{k}") for k in range(len(cuts) - 1)])
    rows = packing.pack_in_order(docs, capacity=16, window_pieces=50).collect()
    used, least = check_packing(rows, list(zip(ids, texts)), 16)
    assert {r["sequence_id"] for r in rows} == set(range(used)) and used <= least * 1.2
    place = {d: i for i, d in enumerate(ids)}
    in_order = sorted(rows, key=lambda r: (place[r["doc_id"]], r["piece"]))
    spans = [{r["sequence_id"] for r in in_order[a:a + 50]} for a in range(0, len(rows), 50)]
    assert all(max(x) + 1 == min(y) for x, y in zip(spans, spans[1:]))
    first = {}
    for n, r in enumerate(in_order):
        first.setdefault(r["sequence_id"], n)
    assert list(first) == sorted(first)  # inside a window, too, sequences come by their first pieces
    other = packing.pack_in_order(edge_docs(spark), window_pieces=3).collect()
    check_packing(other, [(d, t) for d, t, *_ in EDGE_TEXTS])
    assert packing.pack_in_order(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_rank_once_and_fits(seed):
    rng = random.Random(seed)
    hist = {rng.randint(1, 4096): rng.randint(1, 40) for _ in range(rng.choice([1, 5, 60, 400]))}
    groups = 40 if seed % 2 else 5
    plan = packing.pack_histogram(hist, groups=groups)
    placed, used = defaultdict(list), Counter()
    for length, rank, n, first, q in plan.entries:
        placed[length] += range(rank, rank + n)
        for i in range(n):
            used[first + i // q] += length
    assert {k: sorted(v) for k, v in placed.items()} == {k: list(range(n)) for k, n in hist.items()}
    assert max(used.values()) <= 4096 and set(used) <= set(range(plan.sequences))
    order = sorted((x for k, n in hist.items() for x in [k] * n), reverse=True)
    rooms = []
    for x in order:  # plain best fit decreasing
        fit = min((r for r in rooms if r >= x), default=None)
        if fit is None:
            rooms.append(4096 - x)
        else:
            rooms[rooms.index(fit)] -= x
    assert groups == 5 or plan.sequences <= len(rooms) * 1.06 + 2
