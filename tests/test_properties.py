"""Properties checked over many random cases per Spark job, against independent numpy models."""

import datetime as dt
import json
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hydroframe.operators import lai, waterbody
from hydroframe.params import Extent
from hydroframe.sources import vector


def _numpy_dam_height(v, a):
    """Independent model of the dam-height rule (vectorised numpy)."""
    v = np.array([np.nan if x is None else x for x in v], dtype=float)
    a = np.array([np.nan if x is None else x for x in a], dtype=float)
    with np.errstate(all="ignore"):
        am2 = a * 1e6
        prism, emp, cub = 2 * v / am2, 10 * np.sqrt(v / am2), 5 * np.power(v, 1 / 3)
        h = np.select([v < 1e6, (v >= 1e6) & (v <= 1e8), v > 1e8],
                      [0.7 * emp + 0.2 * prism + 0.1 * cub, 0.4 * emp + 0.4 * prism + 0.2 * cub,
                       0.3 * emp + 0.6 * prism + 0.1 * cub], default=0.0)
        h = np.clip(h, 5.0, 300.0)
        h = np.where(np.isnan(h) | np.isinf(h), 20.0, h)
        valid = ~np.isnan(v) & ~np.isnan(a) & (v > 0) & (a > 0)
    return np.where(valid, h, 20.0)


def test_dam_height_matches_numpy_model(spark):
    rnd = random.Random(11)
    specials = [None, 0.0, -1.0, float("nan"), float("inf"), 1e6, 1e8, 1e-12, 1e40]
    rows = []
    for i in range(3000):
        v = rnd.choice(specials) if i % 10 == 0 else 10 ** rnd.uniform(-3, 12)
        a = rnd.choice(specials[:4] + [1e-9, 1e9]) if i % 13 == 0 else 10 ** rnd.uniform(-4, 4)
        rows.append((i, v, a))
    df = spark.createDataFrame(rows, "i long, Vol_total double, Lake_area double")
    got = [r.Dam_height for r in waterbody.with_dam_height(df).orderBy("i").collect()]
    want = _numpy_dam_height([r[1] for r in rows], [r[2] for r in rows])
    np.testing.assert_allclose(got, want, rtol=1e-12)
    assert min(got) >= 5.0 and max(got) <= 300.0


def _square(x0, y0, w, h):
    return [[x0, y0], [x0 + w, y0], [x0 + w, y0 + h], [x0, y0 + h], [x0, y0]]


def test_box_clip_properties(spark):
    rnd = random.Random(5)
    ext = Extent(0.0, 0.0, 10.0, 10.0)
    feats = []
    for i in range(400):
        x0, y0 = rnd.uniform(-5, 12), rnd.uniform(-5, 12)
        w, h = rnd.uniform(0.1, 6), rnd.uniform(0.1, 6)
        feats.append((i, x0, y0, w, h, json.dumps({"type": "Feature", "properties": {"id": i},
                      "geometry": {"type": "Polygon", "coordinates": [_square(x0, y0, w, h)]}})))
    df = spark.createDataFrame([(f[5],) for f in feats], "t string")
    props = T.StructType([T.StructField("id", T.LongType())])
    once = vector.features_in_extent(vector.parse_features(df, "t", props), ext)
    twice = vector.features_in_extent(once.select("id", "rings"), ext)
    a1 = {r.id: r for r in once.collect()}
    a2 = {r.id: r for r in twice.collect()}
    assert set(a1) == set(a2)
    for i, x0, y0, w, h, _ in feats:
        ix = max(0.0, min(x0 + w, 10.0) - max(x0, 0.0))
        iy = max(0.0, min(y0 + h, 10.0) - max(y0, 0.0))
        if ix * iy > 0:
            assert a1[i].area == pytest.approx(ix * iy, rel=1e-9, abs=1e-12)   # exact intersection
            assert a2[i].area == pytest.approx(a1[i].area, rel=1e-12)             # idempotent
            assert 0.0 <= a1[i].xmin <= a1[i].xmax <= 10.0
            assert 0.0 <= a1[i].ymin <= a1[i].ymax <= 10.0
        else:
            assert i not in a1


def test_line_clip_properties(spark):
    rnd = random.Random(9)
    ext = Extent(0.0, 0.0, 10.0, 10.0)
    rows = []
    for i in range(300):
        pts = [[rnd.uniform(-5, 15), rnd.uniform(-5, 15)] for _ in range(rnd.randint(2, 6))]
        rows.append((i, pts, json.dumps({"type": "Feature", "properties": {"id": i},
                                          "geometry": {"type": "LineString", "coordinates": pts}})))
    df = spark.createDataFrame([(r[2],) for r in rows], "t string")
    props = T.StructType([T.StructField("id", T.LongType())])
    once = {r.id: r for r in vector.lines_in_extent(vector.parse_line_features(df, "t", props), ext).collect()}
    for i, pts, _ in rows:
        total = sum(math.dist(p, q) for p, q in zip(pts, pts[1:]))
        if i in once:
            r = once[i]
            assert 0 < r.length <= total + 1e-9
            for line in r.lines:
                for p in line:
                    assert -1e-9 <= p.x <= 10 + 1e-9 and -1e-9 <= p.y <= 10 + 1e-9
    # clipping the clipped lines again changes nothing
    again_rows = [json.dumps({"type": "Feature", "properties": {"id": i},
                              "geometry": {"type": "MultiLineString",
                                           "coordinates": [[[p.x, p.y] for p in l] for l in r.lines]}})
                  for i, r in once.items()]
    df2 = spark.createDataFrame([(t,) for t in again_rows], "t string")
    again = {r.id: r.length for r in vector.lines_in_extent(vector.parse_line_features(df2, "t", props), ext).collect()}
    for i, r in once.items():
        assert again[i] == pytest.approx(r.length, rel=1e-9)


@settings(max_examples=12, deadline=None)
@given(n=st.integers(min_value=1, max_value=80), step=st.integers(min_value=1, max_value=9))
def test_always_twelve_slots(spark, n, step):
    days = spark.createDataFrame([(dt.date(2010, 1, 1) + dt.timedelta(days=step * i),) for i in range(n)], "time date")
    got = lai.select_slots(days).orderBy("slot").collect()
    assert [r.slot for r in got] == list(range(12))
    times = [r.time for r in got]
    assert times == sorted(times) and len(set(times)) == 12


def _py_chunks(s, e, months=3):
    """Independent model of the chunk rule: chunk k starts on s (k = 0) or on the 1st of
    month s.month + 3k, ends on the last day of month s.month + 3k + 2, trimmed to e."""
    import calendar
    out, k = [], 0
    while True:
        m0 = s.month - 1 + months * k
        y, m = s.year + m0 // 12, m0 % 12 + 1
        start = s if k == 0 else dt.date(y, m, 1)
        if start > e:
            return out
        m2 = m0 + months - 1
        y2, mm2 = s.year + m2 // 12, m2 % 12 + 1
        out.append((start, min(dt.date(y2, mm2, calendar.monthrange(y2, mm2)[1]), e)))
        k += 1


def test_chunks_match_calendar_model(spark):
    from hydroframe.operators import chunks
    rnd = random.Random(3)
    periods = [(98, dt.date(2020, 11, 15), dt.date(2021, 12, 20)), (99, dt.date(2019, 12, 31), dt.date(2020, 3, 1))]
    for i in range(60):
        s = dt.date(1990, 1, 1) + dt.timedelta(days=rnd.randrange(0, 12000))
        periods.append((i, s, s + dt.timedelta(days=rnd.randrange(0, 2000))))
    bounds = spark.createDataFrame(periods, "pid int, start date, end date")
    got: dict[int, list] = {}
    for r in chunks.chunk_table(spark, bounds).orderBy("pid", "chunk_id").collect():   # one job
        got.setdefault(r.pid, []).append((r.chunk_start, r.chunk_end))
    for pid, s, e in periods:
        assert got[pid] == _py_chunks(s, e), (s, e)


def test_flagship_with_a_third_of_rows_on_one_key(spark):
    from hydroframe.operators import climate
    from hydroframe.params import JobParams
    t0 = dt.datetime(2024, 1, 1, 5)
    rows = []
    # 3000 copies of one (time, cell, band): the largest obs_id wins
    for i in range(3000):
        rows.append((i, t0, 26.0, 85.0, "26.0", "temperature_2m", 270.0 + (i % 7)))
    # 6000 other rows spread over hours and cells
    rnd = random.Random(1)
    for i in range(3000, 9000):
        h = rnd.randrange(0, 48)
        rows.append((i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), 26.0 + 0.25 * rnd.randrange(4),
                     85.0 + 0.25 * rnd.randrange(4), None, "total_precipitation", rnd.uniform(0, 1e-3)))
    rows = [(r[0], r[1], r[2], r[3], r[4] if r[4] else str(r[2]), r[5], r[6]) for r in rows]
    obs = spark.createDataFrame(rows, "obs_id long, time timestamp_ntz, lat double, lon double, "
                                      "lat_text string, band string, value double").repartition(8)
    p = JobParams.of([80, 20, 100, 70], "2024-01-01", "2024-01-02", climate_buffer=0)
    got = {(r.day, r.lat, r.lon): r for r in climate.daily_forcing(spark, obs, p).collect()}
    # independent model: dedupe by max obs_id per (time, lat, lon, band), then daily sum/mean
    latest = {}
    for oid, t, la, lo, _, band, v in rows:
        k = (t, la, lo, band)
        if k not in latest or oid > latest[k][0]:
            latest[k] = (oid, v)
    want_p, want_t = {}, {}
    for (t, la, lo, band), (_, v) in latest.items():
        key = (t.date(), la, lo)
        if band == "total_precipitation":
            want_p[key] = want_p.get(key, 0.0) + v * 1000.0
        else:
            want_t.setdefault(key, []).append(v - 273.15)
    for key, v in want_p.items():
        assert got[key].precip == pytest.approx(v, abs=1e-5)
    assert got[(dt.date(2024, 1, 1), 26.0, 85.0)].temp == pytest.approx((270.0 + 2999 % 7) - 273.15, abs=1e-6)


def test_tile_join_with_a_third_of_features_in_one_tile(spark):
    from hydroframe.operators import extent
    rnd = random.Random(2)
    feats = []
    for i in range(900):
        if i % 3 == 0:   # hot tile
            x, y = rnd.uniform(0.0, 0.9), rnd.uniform(0.0, 0.9)
        else:
            x, y = rnd.uniform(0, 20), rnd.uniform(0, 20)
        feats.append((i, x, y, x + rnd.uniform(0.01, 0.5), y + rnd.uniform(0.01, 0.5)))
    areas = [(j, x, y, x + 1.5, y + 1.5) for j, (x, y) in enumerate((rnd.uniform(-1, 19), rnd.uniform(-1, 19))
                                                                      for _ in range(40))] + [(99, 0.0, 0.0, 1.0, 1.0)]
    f = spark.createDataFrame(feats, "fid long, xmin double, ymin double, xmax double, ymax double")
    a = spark.createDataFrame(areas, "aid long, xmin double, ymin double, xmax double, ymax double")
    got = sorted((r.aid, r.fid) for r in extent.features_in_areas(f, a, "aid", leaf_pairs=50).collect())
    want = sorted((aid, fid) for fid, x0, y0, x1, y1 in feats for aid, a0, b0, a1, b1 in areas
                  if x1 >= a0 and x0 <= a1 and y1 >= b0 and y0 <= b1)
    assert got == want and len(got) == len(set(got))


def test_quadtree_leaves_stay_within_their_budget(spark):
    """A third of both sides shares one place: it is salted, and no unit is far above the median."""
    from hydroframe.operators import extent
    rnd = random.Random(4)
    feats, areas = [], []
    for i in range(3000):
        x, y = (5.2, 5.2) if i % 3 == 0 else (rnd.uniform(0, 30), rnd.uniform(0, 30))
        feats.append((i, x, y, x + 0.2, y + 0.2))
    for j in range(300):
        x, y = (5.0, 5.0) if j % 3 == 0 else (rnd.uniform(0, 30), rnd.uniform(0, 30))
        areas.append((j, x, y, x + 0.5 + (j % 7) * 0.001, y + 0.5))
    f = spark.createDataFrame(feats, "fid long, xmin double, ymin double, xmax double, ymax double")
    a = spark.createDataFrame(areas, "aid long, xmin double, ymin double, xmax double, ymax double")
    got = sorted((r.aid, r.fid) for r in extent.features_in_areas(f, a, "aid", leaf_pairs=2000).collect())
    want = sorted((j, i) for i, x0, y0, x1, y1 in feats for j, a0, b0, a1, b1 in areas
                  if x1 >= a0 and x0 <= a1 and y1 >= b0 and y0 <= b1)
    assert got == want
    boxes = a.select(*[F.col(c).alias("a_" + c) for c in extent.BOX]).distinct()
    tree = extent._grid(f, boxes, 8)
    n_f, n_a = extent._tally(tree, f), extent._tally(tree, boxes, "a_")
    rows = tree.leaves(n_f, n_a, 2000)
    units = {}
    for gx, gy, leaf, _, _, slices in rows:
        n = units.setdefault(leaf, [0, 0, slices])
        n[0] += n_f[gx, gy]
        n[1] += n_a[gx, gy]
    pairs = sorted(p / s for p, s in ((n[0] * n[1], n[2]) for n in units.values()) for _ in range(s))
    assert pairs[-1] <= 2000 and max(s for _, _, s in units.values()) > 1
    assert len({(x, y, leaf) for x, y, leaf, *_ in rows}) == len(rows)


def test_areas_that_nothing_can_meet(spark):
    from hydroframe.operators import extent
    box = "xmin double, ymin double, xmax double, ymax double"
    f = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0), (2, None, 0.0, 1.0, 1.0)], f"fid long, {box}")
    far = spark.createDataFrame([(1, 5.0, 5.0, 6.0, 6.0)], f"aid long, {box}")
    touching = spark.createDataFrame([(1, 1.0, 1.0, 6.0, 6.0), (2, 1.0, 1.0, 6.0, 6.0)], f"aid long, {box}")
    assert extent.features_in_areas(f, far, "aid").count() == 0
    assert extent.features_in_areas(f, far.limit(0), "aid").count() == 0
    assert sorted(r.aid for r in extent.features_in_areas(f, touching, "aid").collect()) == [1, 2]
    assert extent.features_in_areas(f, touching, "aid", clip=True).count() == 0


def test_areas_with_one_box_are_fanned_out_in_many_tasks(spark):
    """All areas and a third of the features at one place: no task gives a large share of the pairs."""
    from hydroframe.operators import extent
    box = "xmin double, ymin double, xmax double, ymax double"
    place = lambda i: (5.0, 5.0) if i % 3 == 0 else (i % 30 * 1.0, i % 7 * 4.0)
    feats = [(i, x, y, x + 0.2, y + 0.2) for i in range(900) for x, y in [place(i)]]
    areas = [(j if j % 50 else None, 5.0, 5.0, 5.5, 5.5) for j in range(400)] + [(7, 5.0, 5.0, 5.5, 5.5)] * 2
    f = spark.createDataFrame(feats, f"fid long, {box}")
    a = spark.createDataFrame(areas, f"aid long, {box}")
    out = extent.features_in_areas(f, a, "aid", leaf_pairs=2000)
    assert out.columns == ["fid", *extent.BOX, "aid"]
    per = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    met = [i for i, x0, y0, x1, y1 in feats if x1 >= 5.0 and x0 <= 5.5 and y1 >= 5.0 and y0 <= 5.5]
    assert sum(per) == len(met) * len(areas) and max(per) <= 0.1 * sum(per)
    want = sorted((aid or 0, fid) for aid, *_ in areas for fid in met)
    assert sorted((r.aid or 0, r.fid) for r in out.collect()) == want


def test_rows_of_the_area_join_on_disk_follow_the_input(spark, monkeypatch):
    """Twice the boxes of both sides give four times the pairs, but twice the rows that are shuffled."""
    from hydroframe.operators import extent
    monkeypatch.setattr(extent, "LEAF_PAIRS", 50)
    box = "xmin double, ymin double, xmax double, ymax double"

    def shuffled(plan):
        children = [plan.children().apply(i) for i in range(plan.children().size())]
        if "QueryStage" in plan.getClass().getSimpleName():
            children.append(plan.plan())
        own = plan.metrics().apply("shuffleRecordsWritten").value() if plan.getClass().getSimpleName() == "ShuffleExchangeExec" else 0
        return own + sum(shuffled(c) for c in children)

    def run(n):
        feats = [(i, 5.0 + i % 11 * 0.01, 5.0 + i % 7 * 0.01, 5.5 + i % 11 * 0.01, 5.5 + i % 7 * 0.01) for i in range(2 * n)]
        areas = [(j, 5.0 + j * 1e-4, 5.0, 5.1 + j * 1e-4, 5.1) for j in range(n)]
        f, a = spark.createDataFrame(feats, f"fid long, {box}"), spark.createDataFrame(areas, f"aid long, {box}")
        out = extent.features_in_areas(f, a, "aid")
        met = [(j, i) for i, x0, y0, x1, y1 in feats for j, a0, b0, a1, b1 in areas if x1 >= a0 and x0 <= a1 and y1 >= b0 and y0 <= b1]
        assert sorted((r.aid, r.fid) for r in out.collect()) == sorted(met)
        qe = out._jdf.queryExecution()
        qe.toRdd().count()
        return shuffled(qe.executedPlan().executedPlan()), len(met)
    (rows, pairs), (rows_2, pairs_2) = run(150), run(300)
    assert pairs_2 > 3.5 * pairs
    assert 450 <= rows <= rows_2 < 2.5 * rows
