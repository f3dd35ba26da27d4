"""Hand-written edge tables (FIXTURES.md §3) and properties of the operators."""

import datetime as dt
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hydroframe.operators import chunks, climate, discharge, lai, network, raster, waterbody
from hydroframe.operators.ids import exact_median, exact_medians, sequential_id, value_at_rank
from hydroframe.params import Extent, JobParams
from hydroframe.functions import scalar
from hydroframe.sources import vector
from tests.conftest import SF_SMALL

D = dt.date


# --- chunks (K1, Q15) ----------------------------------------------------------------------

def _chunks(spark, s, e):
    t = chunks.chunk_table(spark, chunks.period_bounds(spark, s, e)).orderBy("chunk_id").collect()
    return [(r.chunk_start, r.chunk_end) for r in t]


def test_chunks_cross_year(spark):
    got = _chunks(spark, D(2020, 11, 15), D(2021, 12, 20))
    assert got == [(D(2020, 11, 15), D(2021, 1, 31)), (D(2021, 2, 1), D(2021, 4, 30)),
                   (D(2021, 5, 1), D(2021, 7, 31)), (D(2021, 8, 1), D(2021, 10, 31)),
                   (D(2021, 11, 1), D(2021, 12, 20))]


def test_chunks_single(spark):
    assert _chunks(spark, D(2021, 3, 5), D(2021, 3, 20)) == [(D(2021, 3, 5), D(2021, 3, 20))]
    assert _chunks(spark, D(2021, 3, 5), D(2021, 3, 5)) == [(D(2021, 3, 5), D(2021, 3, 5))]


def test_chunks_tile_period(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(40):
        s = D(2000, 1, 1) + dt.timedelta(days=rnd.randrange(0, 8000))
        e = s + dt.timedelta(days=rnd.randrange(0, 1500))
        rows.append((i, s, e))
    for pid, s, e in rows:
        got = _chunks(spark, s, e)
        assert got[0][0] == s and got[-1][1] == e
        for (a0, a1), (b0, b1) in zip(got, got[1:]):
            assert b0 == a1 + dt.timedelta(days=1)
        for a0, a1 in got:
            assert a0 <= a1


def test_chunk_label_and_assignment(spark):
    df = spark.createDataFrame([(D(2020, 11, 15),), (D(2021, 1, 31),), (D(2021, 2, 1),)], "time date")
    tagged = chunks.assign_chunks(df, D(2020, 11, 15), D(2021, 12, 20)).orderBy("time").collect()
    assert [r.chunk_id for r in tagged] == [0, 0, 1]
    lab = chunks.chunk_table(spark, chunks.period_bounds(spark, D(2020, 11, 15), D(2021, 12, 20))) \
        .orderBy("chunk_id").first().chunk_label
    assert lab == "20201115_20210131"


# --- dam height (H1-H7, Q16, Q18) --------------------------------------------------------

def _heights(spark, rows, schema="Vol_total double, Lake_area double"):
    df = spark.createDataFrame(rows, schema)
    return [r.Dam_height for r in waterbody.with_dam_height(df, keep_intermediate="Vol_total" in schema).collect()]


def test_dam_height_boundaries(spark):
    d = waterbody.with_dam_height(spark.createDataFrame([(1e6, 1.0), (1e8, 1.0)], "Vol_total double, Lake_area double"),
                                  keep_intermediate=True)
    assert [r.size_class for r in d.collect()] == ["medium", "medium"]


def test_dam_height_invalid_default(spark):
    rows = [(None, 1.0), (1e6, None), (0.0, 1.0), (1e6, 0.0), (-5.0, 1.0), (1e6, -1.0)]
    assert _heights(spark, rows) == [20.0] * 6


def test_dam_height_clipped(spark):
    h = _heights(spark, [(1e-9, 1e6), (1e30, 1e-6)])
    assert h == [5.0, 300.0]


def test_dam_height_missing_column(spark):
    assert _heights(spark, [(1.0,)], "Area double") == [20.0]


def test_dam_height_nan_inf_null(spark):
    h = _heights(spark, [(float("nan"), 1.0), (float("inf"), 1.0), (None, 1.0)])
    assert h == [20.0, 300.0, 20.0]


def test_dam_height_value(spark):
    v, a = 5e5, 2.0
    am2 = a * 1e6
    exp = 0.7 * 10 * math.sqrt(v / am2) + 0.2 * 2 * v / am2 + 0.1 * 5 * v ** (1 / 3)
    assert _heights(spark, [(v, a)])[0] == pytest.approx(min(300, max(5, exp)))


# --- ids and medians (B4, D6) ------------------------------------------------------------

def test_sequential_id_matches_row_number(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5003).alias("k"))
    got = sequential_id(df, ["k"], "rid").orderBy("k").select("rid").collect()
    assert [r.rid for r in got] == list(range(5000))


def test_exact_median(spark):
    vals = [3.0, 1.0, 4.0, 1.5, 9.0, 2.6]
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(3)
    assert exact_median(df, "v").first()["median"] == pytest.approx(float(np.median(vals)))
    df2 = spark.createDataFrame([(v,) for v in vals[:5]], "v double")
    assert exact_median(df2, "v").first()["median"] == pytest.approx(float(np.median(vals[:5])))


@pytest.mark.parametrize("seed", range(4))
def test_medians_by_narrowing(spark, seed):
    """Slices of a few rows force every branch: ties of a third of the rows at the middle, gaps, even counts."""
    rnd = random.Random(seed)
    vals = [rnd.choice([rnd.gauss(0, 1), 0.25, float(round(rnd.gauss(0, 2)))]) if seed % 2 else rnd.lognormvariate(0, 3) for _ in range(2001 + seed)]
    ties = [7.0 if i % 3 == 0 else rnd.uniform(0, 14) for i in range(len(vals))]
    halves = [float(i % 2) for i in range(len(vals))]
    rows = [*zip(vals, ties, halves), (None, float("nan"), None)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    got = exact_medians(df, ["a", "b", "c"], slice_rows=9)
    assert got == {k: pytest.approx(float(np.median(v)), abs=0) for k, v in (("a", vals), ("b", ties), ("c", halves))}
    assert exact_medians(df.limit(0), ["a"]) == {"a": None}
    for rank in (0, 17, len(vals) - 1):
        assert value_at_rank(df.filter("a IS NOT NULL"), "a", rank, len(vals), slice_rows=5) == sorted(vals)[rank]


def test_export_empty_keeps_schema(spark):
    df = spark.createDataFrame([(1, 1e6, 1.0, 0.0, 1.0, 0.0, 1.0)],
                               "hylak_id long, Vol_total double, Lake_area double, xmin double, xmax double, ymin double, ymax double")
    out = waterbody.export_waterbodies(df, Extent(50, 50, 51, 51))
    assert out.count() == 0
    assert {"waterbody_id", "Dam_height"} <= set(out.columns)


def test_box_touching_edge(spark):
    from hydroframe.functions.geometry import box_meets_extent, box_not_empty, clip_box
    ext = Extent(0, 0, 10, 10)
    df = spark.createDataFrame([(10.0, 11.0, 2.0, 3.0)], "xmin double, xmax double, ymin double, ymax double")
    assert df.filter(box_meets_extent(ext)).count() == 1
    assert df.filter(box_meets_extent(ext)).withColumns(clip_box(ext)).filter(box_not_empty()).count() == 0


# --- LAI selection (G3-G6, E6, Q2, Q21, Q22) ---------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 11, 12, 13, 40])
def test_lai_slots(spark, n):
    days = spark.createDataFrame([(D(2020, 1, 1) + dt.timedelta(days=4 * i),) for i in range(n)], "time date")
    got = lai.select_slots(days).orderBy("slot").collect()
    if n == 0:
        assert got == []
        return
    assert [r.slot for r in got] == list(range(12))
    real = [r for r in got if not r.is_padding]
    if n >= 12:
        idx = np.linspace(0, n - 1, 12, dtype=int)
        assert [r.time for r in real] == [D(2020, 1, 1) + dt.timedelta(days=4 * int(i)) for i in idx]
    else:
        assert len(real) == n
        pads = [r for r in got if r.is_padding]
        prev = real[-1].time
        for p in pads:
            assert p.time == prev + dt.timedelta(days=30)
            prev = p.time


def test_linspace_rule():
    for n in range(12, 3000, 7):
        assert list(np.linspace(0, n - 1, 12, dtype=int)) == [(i * (n - 1)) // 11 for i in range(12)]


def test_fallback_first_not_closest(spark):
    images = spark.createDataFrame([(D(2020, 1, 8),), (D(2020, 1, 12),), (D(2020, 1, 13),)], "time date")
    targets = spark.createDataFrame([(D(2020, 1, 10),), (D(2020, 1, 12),), (D(2020, 1, 20),)], "target_day date")
    got = {r.target_day: (r.image_day, r.exact_day)
           for r in lai.fallback_images(targets, images).collect()}
    assert got[D(2020, 1, 10)] == (D(2020, 1, 8), False)   # -2 d chosen over +2 d
    assert got[D(2020, 1, 12)] == (D(2020, 1, 12), True)
    assert got[D(2020, 1, 20)] == (None, False)


def test_fallback_plus_three_never(spark):
    images = spark.createDataFrame([(D(2020, 1, 13),)], "time date")
    targets = spark.createDataFrame([(D(2020, 1, 10),)], "target_day date")
    assert lai.fallback_images(targets, images).first().image_day is None


def test_lai_period_excludes_end(spark):
    imgs = spark.createDataFrame([(D(2020, 1, 1),), (D(2020, 1, 31),)], "image_time date")
    assert lai.images_in_period(imgs, D(2020, 1, 1), D(2020, 1, 31)).count() == 1


def test_lai_scale_and_mask(spark):
    df = spark.createDataFrame([(-5,), (0,), (55,), (100,), (101,)], "raw_lai long")
    got = [r.lai for r in df.select(lai.scaled_lai().alias("lai")).collect()]
    assert got[0] is None and got[1] == 0.0 and got[2] == pytest.approx(5.5) and got[3] == 10.0 and got[4] is None


# --- climate (Q1, Q3, Q4, Q5, Q6) ---------------------------------------------------------

def _obs(spark, rows):
    return spark.createDataFrame(
        rows, "obs_id long, time timestamp_ntz, lat double, lon double, lat_text string, band string, value double")


def test_coordinates_half_even_and_bad_text(spark):
    rows = [(1, dt.datetime(2024, 1, 1, 0), 1.0, 2.0, "1.000005", "temperature_2m", 280.0),
            (2, dt.datetime(2024, 1, 1, 0), 1.0, 2.000015, "1.000015", "temperature_2m", 280.0),
            (3, dt.datetime(2024, 1, 1, 0), 1.0, 2.0, "bad", "temperature_2m", 280.0)]
    got = climate.clean_coordinates(_obs(spark, rows)).orderBy("obs_id").collect()
    assert [(r.lat, r.lon) for r in got] == [(float(np.round(1.000005, 5)), 2.0),
                                             (float(np.round(1.000015, 5)), float(np.round(2.000015, 5)))]


def test_period_end_day_in_for_climate(spark):
    rows = [(1, dt.datetime(2024, 1, 11, 23), 26.0, 85.0, "26.0", "temperature_2m", 280.0),
            (2, dt.datetime(2024, 1, 12, 0), 26.0, 85.0, "26.0", "temperature_2m", 281.0)]
    p = JobParams.of([80, 20, 100, 70], "2024-01-05", "2024-01-11", climate_buffer=0)
    out = climate.hourly_long(spark, _obs(spark, rows), p).collect()
    assert [r.value for r in out] == [pytest.approx(280.0 - 273.15)]


def test_duplicates_keep_largest_obs_id(spark):
    t = dt.datetime(2024, 1, 1, 3)
    rows = [(5, t, 26.0, 85.0, "26.0", "temperature_2m", 300.0),
            (9, t, 26.0, 85.0, "26.0", "temperature_2m", 290.0),
            (7, t, 26.0, 85.0, "26.0", "temperature_2m", None)]
    p = JobParams.of([80, 20, 100, 70], "2024-01-01", "2024-01-01", climate_buffer=0)
    out = climate.hourly_long(spark, _obs(spark, rows), p).collect()
    assert [r.value for r in out] == [pytest.approx(290.0 - 273.15)]


def test_daily_sum_and_mean(spark):
    rows = [(i, dt.datetime(2024, 1, 1, i), 26.0, 85.0, "26.0", b, v)
            for i, (b, v) in enumerate([("total_precipitation", 0.001), ("total_precipitation", 0.002),
                                         ("temperature_2m", 280.0), ("temperature_2m", 282.0)])]
    p = JobParams.of([80, 20, 100, 70], "2024-01-01", "2024-01-01", climate_buffer=0)
    r = climate.daily_forcing(spark, _obs(spark, rows), p).first()
    assert r.precip == pytest.approx(3.0) and r.temp == pytest.approx(281.0 - 273.15)
    assert r.kin is None


def test_densify_shape_and_missing(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, t0, 1.0, 10.0, "1.0", "temperature_2m", 1.0),
            (2, t0 + dt.timedelta(hours=1), 2.0, 11.0, "2.0", "temperature_2m", None),
            (3, t0 + dt.timedelta(hours=2), 3.0, 12.0, "3.0", "temperature_2m", 3.0)]
    obs = climate.clean_coordinates(_obs(spark, rows))
    vals = obs.filter(F.col("value").isNotNull()).select("time", "lat", "lon", F.col("value").alias("v"))
    dense = climate.densify(obs, vals, ["v"])
    assert dense.count() == 27          # 3 times (one all-missing) x 3 lats x 3 lons
    assert dense.filter(F.col("v").isNotNull()).count() == 2


def test_day_gaps_reports_missing(spark):
    rows = [(1, dt.datetime(2024, 1, 1, 5), 26.0, 85.0, "26.0", "temperature_2m", 280.0)]
    p = JobParams.of([80, 20, 100, 70], "2024-01-01", "2024-01-03", climate_buffer=0)
    gaps = climate.day_gaps(climate.hourly_long(spark, _obs(spark, rows), p), p.start_date, p.end_date)
    got = {r.day: r.status for r in gaps.collect()}
    assert got == {D(2024, 1, 1): "ok", D(2024, 1, 2): "missing", D(2024, 1, 3): "missing"}


# --- discharge (E3 ties) ----------------------------------------------------------------

def test_nearest_cell_tie_takes_first(spark):
    cube = spark.createDataFrame([(dt.datetime(2020, 1, 1), 1.0, 10.0, 5.0),
                                  (dt.datetime(2020, 1, 1), 2.0, 11.0, 6.0)],
                                 "time timestamp_ntz, lat double, lon double, discharge double")
    assert discharge.nearest_cell(cube, lon=10.5, lat=1.5) == (1.0, 10.0)


def test_outlet_series_keeps_missing_steps(spark):
    t = [dt.datetime(2020, 1, d) for d in (1, 2, 3)]
    cube = spark.createDataFrame([(t[0], 1.0, 10.0, 5.0), (t[1], 2.0, 11.0, 6.0), (t[2], 1.0, 10.0, 7.0)],
                                 "time timestamp_ntz, lat double, lon double, discharge double")
    s = discharge.outlet_series(cube, lon=10.0, lat=1.0).orderBy("time").collect()
    assert [r.discharge for r in s] == [5.0, None, 7.0]
    st = discharge.series_stats(discharge.outlet_series(cube, lon=10.0, lat=1.0)).first()
    assert (st.mean_q, st.max_q, st.min_q, st.n_valid, st.n_steps) == (6.0, 7.0, 5.0, 2, 3)


# --- network (L1) -----------------------------------------------------------------------

def _brute_upstream(edges, outlet):
    up = {outlet}
    changed = True
    while changed:
        changed = False
        for c, n in edges.items():
            if n in up and c not in up:
                up.add(c)
                changed = True
    return up


@pytest.mark.parametrize("seed", [1, 2])
def test_upstream_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    n = 400
    edges = {c: c + rnd.choice([1, 2, 5, 17, 40]) for c in range(n)}  # acyclic: next > cell
    cells = spark.createDataFrame([(c, c % 20, c // 20, nxt, 7, 1.0) for c, nxt in edges.items()],
                                  "cell long, x long, y long, next_cell long, strord int, uparea double")
    outlet = rnd.randrange(n // 2, n)
    for block in (2, 5, 256):  # paths of many blocks, and all in one
        got = {r.cell for r in network.upstream_cells(cells, outlet, block=block).collect()}
        assert got == _brute_upstream(edges, outlet)
        assert outlet in got


def test_snap_outlet_prefers_high_order(spark):
    cells = spark.createDataFrame([(1, 0, 0, 2, 3, 1.0), (2, 5, 5, 3, 7, 1.0), (3, 9, 9, 4, 8, 1.0)],
                                  "cell long, x long, y long, next_cell long, strord int, uparea double")
    assert network.snap_outlet(cells, 0, 0) == 2


# --- rasters and soil (A11, C9, F11, F13) -------------------------------------------------

def test_soil_members(spark):
    t = raster.soil_member_table(spark)
    assert t.count() == 44
    names = {r.member for r in t.collect()}
    assert {"tax_usda", "soilthickness", "bd_sl1", "clyppt_sl7"} <= names


def test_mask_nodata_per_variable(spark):
    df = spark.createDataFrame([("strord", 255.0), ("flwdir", 255.0), ("flwdir", 247.0)], "variable string, value double")
    got = [r.value for r in raster.mask_nodata(df, raster.nodata_map("merit_hydro_1k")).collect()]
    assert got == [None, 255.0, None]


def test_model_grid(spark):
    ext = Extent(85.0, 26.0, 85.05, 26.03)
    g = raster.model_grid(spark, ext)
    w, h = int(0.05 / (500 / 111000)), int(0.03 / (500 / 111000))
    assert g.count() == w * h
    lats = sorted({r.lat for r in g.collect()}, reverse=True)
    assert lats[0] == pytest.approx(26.03) and lats[-1] == pytest.approx(26.0)
    np.testing.assert_allclose(lats, np.linspace(26.03, 26.0, h))


def test_koppen_nodata_parameter(spark):
    from hydroframe.sources.catalog import KOPPEN_FETCH_NODATA
    df = spark.createDataFrame([("koppen_geiger", 32.0), ("koppen_geiger", 0.0)], "variable string, value double")
    fetch = [r.value for r in raster.mask_nodata(df, {"koppen_geiger": KOPPEN_FETCH_NODATA}).collect()]
    cat = [r.value for r in raster.mask_nodata(df, raster.nodata_map("koppen_geiger")).collect()]
    assert fetch == [None, 0.0] and cat == [32.0, None]


# --- scalar functions -------------------------------------------------------------------

def test_scalar_functions(spark):
    df = spark.createDataFrame([("12.5", 1.5, 1700000000000)], "t string, x double, ms long")
    r = df.select(scalar.to_number("t").alias("n"), scalar.round_half_even(F.lit(2.5), 0).alias("b"),
                  scalar.epoch_ms_to_timestamp("ms").alias("ts"),
                  scalar.member_name(F.lit("bd"), F.lit(3)).alias("m"),
                  scalar.depth_of(F.lit("ph_sl6")).alias("d"),
                  scalar.replace_infinite(F.lit(float("inf")), 20.0).alias("inf")).first()
    assert r.n == 12.5 and r.b == 2.0 and r.ts == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert r.m == "bd_sl3" and r.d == 6 and r.inf == 20.0


# --- lookups, grid membership, merges (C11, D5, F8, J3, J6, L8) ---------------------------

def test_lookup_join_small_and_large(spark):
    from hydroframe.operators.lookup import landcover_params, lookup_join
    grid = spark.createDataFrame([(1, 10), (2, 20), (3, 99)], "cell long, landcover int")
    lut = spark.createDataFrame([(10, 0.5), (20, 0.7)], "class int, rootdepth double")
    got = {r.cell: r.rootdepth for r in landcover_params(grid, lut).collect()}
    assert got == {1: 0.5, 2: 0.7, 3: None}
    big = lookup_join(grid, lut.withColumnRenamed("class", "landcover"), "landcover")
    assert big.count() == 3


def test_in_grid_and_ordered_times(spark):
    from hydroframe.operators.lookup import in_grid, ordered_times
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (5.0, 2.0)], "lat double, lon double")
    axes = {"lat": spark.createDataFrame([(1.0,)], "lat double"),
            "lon": spark.createDataFrame([(2.0,), (3.0,)], "lon double")}
    assert in_grid(df, axes).count() == 2
    t = spark.createDataFrame([(D(2020, 1, 3),), (D(2020, 1, 1),), (D(2020, 1, 3),)], "time date")
    assert ordered_times(t).first().times == [D(2020, 1, 1), D(2020, 1, 3)]


def test_constants(spark):
    from hydroframe.operators.lookup import MODEL_CONSTANTS, with_constants
    r = with_constants(spark.range(1)).first()
    assert len(MODEL_CONSTANTS) == 15 and r.Cfmax == 3.75653 and r.rootdistpar == -500.0


def test_concat_and_static_merge(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k long, v double")
    b = spark.createDataFrame([(2, 2.0), (3, 3.0)], "k long, v double")
    assert chunks.concat_chunks([a, b]).count() == 4
    assert chunks.concat_dedupe([a, b]).count() == 3
    static = spark.createDataFrame([(0, "s0"), (1, "s1")], "chunk_id int, m string")
    forcing = spark.createDataFrame([(0, 1.0), (1, 2.0)], "chunk_id int, p double")
    s, f = chunks.merge_static_forcing(static, forcing)
    assert [r.m for r in s.collect()] == ["s0"] and f.count() == 2


def test_river_floors_and_pet(spark):
    df = spark.createDataFrame([(10.0, 0.5), (50.0, 2.0)], "rivwth double, rivdph double")
    got = [(r.rivwth, r.rivdph) for r in network.river_floors(df).collect()]
    assert got == [(30.0, 1.0), (50.0, 2.0)]
    pet = spark.range(1).select(network.pet_debruin(F.lit(20.0), F.lit(1013.0), F.lit(200.0),
                                                    F.lit(400.0)).alias("p")).first().p
    assert 0.0 < pet < 10.0   # mm/day for a mild day


def test_sequential_id_hot_key(spark):
    n = 3000
    # a third of the rows share one key
    df = spark.range(0, n, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), "id")
    out = sequential_id(df, ["k"], "rid").collect()
    assert sorted(r.rid for r in out) == list(range(n))
    by_rid = sorted(out, key=lambda r: r.rid)
    assert [r.k for r in by_rid] == sorted(r.k for r in out)


def test_pivot_latest_equals_dedupe_then_pivot(spark):
    t = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame(
        [(1, t, 1.0, 2.0, "temp", 10.0), (5, t, 1.0, 2.0, "temp", 11.0), (3, t, 1.0, 2.0, "precip", 0.5),
         (2, t, 1.0, 2.0, "precip", 0.7), (4, t, 3.0, 2.0, "temp", 9.0)],
        "obs_id long, time timestamp_ntz, lat double, lon double, variable string, value double")
    one = climate.pivot_latest(rows, climate.CUBE_KEYS, ["temp", "precip", "kin"])
    two = climate.long_to_wide(climate.resolve_duplicates(rows, ["time", "lat", "lon", "variable"]),
                               climate.CUBE_KEYS, ["temp", "precip", "kin"])
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.select(*one.columns).collect()))
    got = {r.lat: (r.temp, r.precip, r.kin) for r in one.collect()}
    assert got == {1.0: (11.0, 0.5, None), 3.0: (9.0, None, None)}


def test_daily_time_shift_option(spark):
    rows = [(1, dt.datetime(2024, 1, 1, 5), 26.0, 85.0, "26.0", "temperature_2m", 280.0)]
    p = JobParams.of([80, 20, 100, 70], "2024-01-01", "2024-01-01", climate_buffer=0)
    obs = _obs(spark, rows)
    assert climate.daily_forcing(spark, obs, p).first().day == D(2024, 1, 1)
    assert climate.daily_forcing(spark, obs, p, shift_days=1).first().day == D(2024, 1, 2)


def test_date_and_number_helpers(spark):
    df = spark.createDataFrame([("2021-03-05", "x", dt.datetime(2021, 3, 5, 6, 7, 8))],
                               "d string, bad string, ts timestamp_ntz")
    r = df.select(scalar.parse_date("d").alias("d"), scalar.parse_date("bad").alias("bad"),
                  scalar.iso_seconds("ts").alias("iso"), scalar.compact_date("ts").alias("ymd"),
                  scalar.add_days("ts", 3).alias("plus3"),
                  scalar.clip(F.lit(400.0), 5.0, 300.0).alias("hi"),
                  scalar.clip(F.lit(None).cast("double"), 5.0, 300.0).alias("null_stays"),
                  scalar.nodata_to_null(F.lit(-9999.0), -9999.0).alias("nod"),
                  scalar.linspace_value(26.0, 28.0, F.lit(2), 5).alias("lin")).first()
    assert r.d == D(2021, 3, 5) and r.bad is None
    assert r.iso == "2021-03-05T06:07:08" and r.ymd == "20210305"
    assert r.plus3 == dt.datetime(2021, 3, 8, 6, 7, 8)
    assert r.hi == 300.0 and r.null_stays is None and r.nod is None and r.lin == 27.0
    days = [x.d for x in spark.range(1).select(scalar.day_range(D(2021, 2, 27), D(2021, 3, 2)).alias("d")).collect()]
    assert days == [D(2021, 2, 27), D(2021, 2, 28), D(2021, 3, 1), D(2021, 3, 2)]


def test_parse_timestamp_and_bad_dates(spark):
    df = spark.createDataFrame([("2021-03-05T06:07:08", "2021-13-40")], "t string, d string")
    r = df.select(scalar.parse_timestamp("t").alias("ts"), scalar.parse_date(F.col("d")).alias("d")).first()
    assert r.ts == dt.datetime(2021, 3, 5, 6, 7, 8) and r.d is None


def test_discharge_nan_is_missing(spark):
    t = [dt.datetime(2020, 1, d) for d in (1, 2)]
    raw = spark.createDataFrame([(t[0], 1.0, 10.0, float("nan")), (t[0], 1.0, 10.0, 3.0), (t[1], 1.0, 10.0, float("nan"))],
                                "time timestamp_ntz, lat double, lon double, Q double")
    s = discharge.outlet_series(discharge.result_cube(raw), lon=10.0, lat=1.0).orderBy("time").collect()
    assert [r.discharge for r in s] == [3.0, None]
    # straight from the raw rows (duplicates and NaN handled by the same max)
    s = discharge.outlet_series(raw, lon=10.0, lat=1.0, value_col="Q").orderBy("time").collect()
    assert [r.discharge for r in s] == [3.0, None]


def test_upstream_hot_outlet_and_long_chain(spark):
    # a third of the cells drain straight into the outlet (a hot key), a long chain of 300
    # cells ends in it too, and a separate basin drains elsewhere
    outlet = 10_000
    edges = {outlet: outlet + 1}
    edges.update({c: outlet for c in range(0, 300)})                 # hot: direct to outlet
    edges.update({c: c + 1 for c in range(1000, 1299)})              # chain 1000 -> ... -> 1299
    edges[1299] = outlet
    edges.update({c: c + 1 for c in range(2000, 2300)})              # other basin, never reaches
    cells = spark.createDataFrame([(c, 0, 0, n, 7, 1.0) for c, n in edges.items()],
                                  "cell long, x long, y long, next_cell long, strord int, uparea double")
    got = {r.cell for r in network.upstream_cells(cells, outlet).collect()}
    assert got == _brute_upstream(edges, outlet)
    assert len(got) == 1 + 300 + 300


def test_melt_wide_bands_and_wide_units(spark):
    from hydroframe.functions.units import apply_renames, apply_units_wide
    wide = spark.createDataFrame([(1, 0.002, 280.0, 101325.0)],
                                 "obs_id long, total_precipitation double, temperature_2m double, mean_sea_level_pressure double")
    long_df = climate.melt_bands(wide, ["obs_id"])
    got = {r.variable: r.value for r in long_df.collect()}
    assert got == {"precip": 0.002, "temp": 280.0, "press_msl": 101325.0}
    conv = apply_units_wide(spark.createDataFrame([(0.002, 280.0, 5.0)], "precip double, temp double, other double"), "era5")
    r = conv.first()
    assert r.precip == pytest.approx(2.0) and r.temp == pytest.approx(6.85) and r.other == 5.0
    ren = apply_renames(spark.createDataFrame([(1.0, 2.0)], "d2m double, u10 double"), "era5_daily_zarr")
    assert ren.columns == ["temp_dew", "wind10_u"]


def test_extent_struct_and_empty_schema(spark):
    from hydroframe.functions.geometry import extent_struct
    r = spark.range(1).select(extent_struct(Extent(85, 26, 87, 28).buffer(2.0)).alias("e")).first().e
    assert (r.west, r.south, r.east, r.north) == (83.0, 24.0, 89.0, 30.0)
    sch = waterbody.empty_vector_schema(with_id=True, with_height=True)
    empty = spark.createDataFrame([], sch)
    assert empty.count() == 0 and dict(empty.dtypes) == {"geometry": "string", "waterbody_id": "bigint",
                                                          "Dam_height": "double"}


def test_lai_grid_cube(spark):
    ext = Extent(85.0, 26.0, 85.02, 26.015)        # 4 x 3 nodes at 500 m
    h, w, dlat, dlon = raster.grid_shape(ext, 500 / 111000)
    assert (h, w) == (3, 4)
    days = spark.createDataFrame([(D(2020, 1, 1) + dt.timedelta(days=4 * i),) for i in range(5)], "time date")
    slots = lai.select_slots(days)                 # 5 real + 7 padding slots
    px = spark.createDataFrame([
        (D(2020, 1, 1), 26.015, 85.0, 1, 55),      # top-left node of slot 0 -> 5.5
        (D(2020, 1, 1), 26.015, 85.0, 2, 77),      # same node, larger obs_id wins -> 7.7
        (D(2020, 1, 5), 26.0, 85.02, 3, 120),      # bottom-right node of slot 1 -> 12.0 masked
        (D(2020, 1, 5), 40.0, 85.0, 4, 10)],       # outside the grid: dropped
        "image_time date, lat double, lon double, obs_id long, raw_lai long")
    cube = lai.lai_grid_cube(px, slots, ext).collect()
    assert len(cube) == 12 * h * w
    vals = {(r.slot, round(r.lat, 4), round(r.lon, 4)): r.Lai for r in cube if r.Lai is not None}
    assert vals == {(0, 26.015, 85.0): pytest.approx(7.7)}
    assert {r.time for r in cube if r.slot == 11} == {D(2020, 1, 17) + dt.timedelta(days=30 * 7)}


def test_job_parameter_checks():
    with pytest.raises(ValueError):
        JobParams.of([1, 2, 3], "2020-01-01", "2020-01-02")
    with pytest.raises(ValueError):
        JobParams.of([1, 2, 3, 4], "2020-01-01", "2020-01-02", outlet=(1.0,))
    with pytest.raises(ValueError):
        JobParams.of([1, 2, 3, 4], "2020/01/01", "2020-01-02")
    with pytest.raises(ValueError):
        JobParams.of([1, 2, 3, 4], "2020-01-02", "2020-01-01")
    p = JobParams.of([85, 26, 87, 28], "2020-01-01", "2020-01-01")
    assert p.extent.buffer(2.0).as_list() == [83.0, 24.0, 89.0, 30.0] and p.climate_buffer == 2.0


def test_area_floor_applies_after_ids(spark):
    df = spark.createDataFrame(
        [(1, 1e6, 0.5, 0.0, 1.0, 0.0, 1.0), (2, 1e6, 2.0, 0.0, 1.0, 0.0, 1.0), (3, 1e6, None, 0.0, 1.0, 0.0, 1.0)],
        "hylak_id long, Vol_total double, Lake_area double, xmin double, xmax double, ymin double, ymax double")
    out = waterbody.export_waterbodies(df, Extent(-1, -1, 2, 2), min_area=1.0).collect()
    assert [(r.waterbody_id, r.Lake_area) for r in out] == [(1, 2.0)]   # ids from export positions


def test_wide_hourly_rows_equal_long_rows(spark):
    t = dt.datetime(2024, 1, 1, 3)
    wide = spark.createDataFrame(
        [(1, t, 26.0, 85.0, 0.001, 280.0, None, 100.0, 101000.0),
         (2, t + dt.timedelta(hours=1), 26.0, 85.0, 0.002, 282.0, 3600.0, 120.0, 101100.0)],
        "obs_id long, time timestamp_ntz, lat double, lon double, total_precipitation double, "
        "temperature_2m double, toa_incident_solar_radiation double, "
        "mean_surface_direct_short_wave_radiation_flux double, mean_sea_level_pressure double")
    long_rows = []
    for r in wide.collect():
        for b in climate.CLIMATE_BANDS:
            long_rows.append((r.obs_id, r.time, r.lat, r.lon, str(r.lat), b, r[b]))
    long_df = _obs(spark, long_rows)
    p = JobParams.of([80, 20, 100, 70], "2024-01-01", "2024-01-01", climate_buffer=0)
    a = climate.daily_forcing(spark, wide, p).collect()
    b = climate.daily_forcing(spark, long_df, p).collect()
    assert [tuple(x) for x in a] == [tuple(x) for x in b] and len(a) == 1
    assert a[0].precip == pytest.approx(3.0)


def test_orography_from_wide_rows(spark):
    t = dt.datetime(2024, 1, 1, 3)
    geo = spark.createDataFrame([(1, t, 26.0, 85.0, 9806.65), (2, t, 26.0, 85.0, 19613.3)],
                                "obs_id long, time timestamp_ntz, lat double, lon double, geopotential double")
    p = JobParams.of([80, 20, 100, 70], "2024-01-01", "2024-01-01", climate_buffer=0)
    r = climate.orography_hourly(geo, p).collect()
    assert len(r) == 1 and r[0].elevtn == pytest.approx(2000.0)   # largest obs_id wins


def test_cycles_are_not_upstream(spark):
    edges = {1: 2, 2: 3, 3: 99, 4: 5, 5: 4, 6: 4, 7: 7, 8: 1, 10: 3}
    cells = spark.createDataFrame([(c, 0, 0, n, 7, 1.0) for c, n in edges.items()],
                                  "cell long, x long, y long, next_cell long, strord int, uparea double")
    assert {r.cell for r in network.upstream_cells(cells, 3).collect()} == {1, 2, 3, 8, 10}
    assert {r.cell for r in network.upstream_cells(cells, 4).collect()} == {4, 5, 6}
    apart = spark.createDataFrame([(c, n) for c, n in [*edges.items(), (20, None), (21, 20)]], "cell long, next_cell long")
    for outlet, want in ((3, {1, 2, 3, 8, 10}), (4, {4, 5, 6}), (20, {20, 21})):  # blocks of ids, a cycle across blocks
        assert {r.cell for r in network.upstream_cells(apart, outlet, block=1).collect()} == want


def test_block_contraction_keeps_border_cells_only(spark):
    cells = spark.range(64 * 64).selectExpr("id as cell", "id % 64 as x", "id div 64 as y", "id + 1 as next_cell")
    exits = {r.cell: r.ptr for r in network.contract_blocks(cells, 64 * 64 - 1, block=16).collect()}
    assert len(exits) == 64 * 64
    assert {ptr % 16 for ptr in exits.values() if ptr != 64 * 64 - 1} == {0}  # blocks are entered at their left edge
    assert exits[5] == 16 and exits[70] == 80 and exits[64 * 64 - 3] == 64 * 64 - 1


def test_long_river_is_followed_to_its_source(spark):
    cells = spark.range(1000).selectExpr("id as cell", "id as x", "id as y", "id + 1 as next_cell", "7 as strord", "1.0 as uparea")
    assert network.upstream_cells(cells, 900).count() == 901


def test_undefined_dam_height_is_the_default(spark):
    inf = float("inf")
    df = spark.createDataFrame([(inf, inf), (inf, 1.0), (1.0, inf)], "Vol_total double, Lake_area double")
    got = [r.Dam_height for r in waterbody.with_dam_height(df).collect()]
    assert got[0] == 20.0 and got[1] == 300.0


def test_whole_domain_keeps_rows_beyond_the_fixture(spark):
    from hydroframe.functions.geometry import point_in_extent
    from hydroframe.params import WHOLE_DOMAIN_JOB
    df = spark.createDataFrame([(26.0, 85.0), (2526.0, 87.0), (-400.0, 0.0)], "lat double, lon double")
    assert df.filter(point_in_extent(WHOLE_DOMAIN_JOB.extent)).count() == 3


def test_images_with_a_time_of_day(spark):
    t = dt.datetime(2024, 1, 5, 10, 30)
    days = spark.createDataFrame([(t,), (dt.datetime(2024, 1, 5, 8, 0),)], "time timestamp_ntz")
    targets = spark.createDataFrame([(D(2024, 1, 5),), (D(2024, 1, 6),), (D(2024, 1, 9),)], "target_day date")
    got = {r.target_day: (r.image_day, r.exact_day) for r in lai.fallback_images(targets, days).collect()}
    first = dt.datetime(2024, 1, 5, 8, 0)
    assert got == {D(2024, 1, 5): (first, True), D(2024, 1, 6): (first, False), D(2024, 1, 9): (None, False)}
    slots = sorted(lai.select_slots(days).collect(), key=lambda r: r.slot)
    assert [s.time for s in slots[:3]] == [first, t, t + dt.timedelta(days=30)] and len(slots) == 12


def test_cells_off_the_grid_find_the_nearest_node(spark):
    fine = spark.createDataFrame([(1, 26.24, 85.0), (2, 26.12, 85.13), (3, 40.0, 85.0)], "cell long, lat double, lon double")
    coarse = spark.createDataFrame([(26.0, 85.0, "a"), (26.25, 85.0, "b"), (26.0, 85.25, "c")], "lat double, lon double, v string")
    got = {r.cell: r.v for r in network.attach_coarse_cell(fine, coarse, 26.0, 85.0, 0.25, ["v"]).collect()}
    assert got == {1: "b", 2: "c", 3: None}


def test_empty_basin_of_parameter_faults():
    with pytest.raises(ValueError, match="extent needs.*not a date"):
        JobParams.of([1, 2, 3], "2020-13-01", "2020-01-02")


# --- content digests (K8) and unknown properties (I18) --------------------------------------

def _digest(df):
    from hydroframe.operators.digest import content_digest
    return {r["column"]: tuple(r)[1:] for r in content_digest(df).collect()}


def test_digests_ignore_order_and_see_every_change(spark):
    rows = [(i, i * 0.5, f"s{i % 7}", dt.datetime(2024, 1, 1, i % 24), None if i % 5 == 0 else i % 2 == 0, [i]) for i in range(100)]
    schema = "a long, b double, c string, t timestamp_ntz, f boolean, arr array<long>"
    base = _digest(spark.createDataFrame(rows, schema))
    assert _digest(spark.createDataFrame(rows[::-1], schema).repartition(7)) == base
    one = [list(r) for r in rows]
    one[40][1] += 1e-5
    changed = _digest(spark.createDataFrame(one, schema))
    assert {c for c in base if base[c] != changed[c]} == {"b", "*"}
    swap = [list(r) for r in rows]
    swap[3][0], swap[4][0] = swap[4][0], swap[3][0]  # the column holds the same values
    changed = _digest(spark.createDataFrame(swap, schema))
    assert {c for c in base if base[c] != changed[c]} == {"*"}
    twice = _digest(spark.createDataFrame(rows + rows[:1], schema))
    assert all(base[c] != twice[c] for c in base)


def test_digests_of_odd_values(spark):
    odd = spark.createDataFrame([(float("nan"), float("inf")), (-0.0, 1e300), (None, None)], "a double, b double")
    same = spark.createDataFrame([(float("nan"), float("inf")), (0.0, 1e300), (None, None)], "a double, b double")
    assert _digest(odd) == _digest(same)
    assert _digest(odd)["a"][:2] == (3, 2)
    empty = _digest(odd.limit(0))
    assert empty["a"] == (0, 0, None, None) and empty["*"][0] == 0
    wide = spark.createDataFrame([(1.5, 2)], "x float, y int")
    assert _digest(wide) == _digest(wide.selectExpr("cast(x as double) x", "cast(y as long) y"))


def test_digest_differences_by_column(spark):
    from hydroframe.operators.digest import content_digest, differing_columns
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(1, 3)], "x int, y int")
    diff = lambda p, q: {r["column"] for r in differing_columns(content_digest(p), content_digest(q)).collect()}
    assert diff(a, a) == set() and diff(a, b) == {"y", "*"} and diff(a, a.withColumn("z", F.lit(1))) == {"z", "*"}


def test_property_keys_of_odd_features(spark):
    text = ['{"properties":{"a":1,"b-c":{"d":null,"e":{"f":1}},"x":[]}}', '{"properties":{"a":1.5,"b-c":2}}', '{"properties":null}',
            '{"type":"Feature"}', "no json", None, '{"properties":{"a":null,"it\'s":true}}', '{"properties":{"a":12345678901234567890}}']
    df = vector.feature_properties(spark.createDataFrame([(i, t) for i, t in enumerate(text)], "n int, feature string"), "feature")
    got = {r.path: (r.type, r.n_features, r.n_null) for r in vector.property_keys(df, depth=3).collect()}
    assert got == {"a": ("number", 4, 1), "b-c": ("mixed", 2, 0), "b-c.d": ("null", 1, 1), "b-c.e": ("object", 1, 0),
                   "b-c.e.f": ("integer", 1, 0), "x": ("array", 1, 0), "it's": ("boolean", 1, 0)}
    out = vector.with_property_columns(df).orderBy("n")
    assert out.columns == ["n", "a", "b-c", "it's", "x"]
    rows = out.collect()
    assert rows[0]["a"] == 1.0 and rows[1]["a"] == 1.5 and rows[6]["it's"] is True and rows[4]["a"] is None
    assert json.loads(rows[0]["b-c"]) == {"d": None, "e": {"f": 1}} and rows[1]["b-c"] == "2"
    assert df.select(vector.property_value("b-c.e.f", "int").alias("v")).first().v == 1
    assert vector.property_keys(df.limit(0)).count() == 0


def test_time_shift_in_seconds_moves_times_before_days(spark):
    from hydroframe.sources.catalog import RULES_SCHEMA, catalog_rule_rows_of, time_shift_seconds
    rows = [(dt.datetime(2024, 1, 2, h), 26.0, 85.0, "precip", 1.0) for h in (0, 12, 23)]
    long = spark.createDataFrame(rows, "time timestamp_ntz, lat double, lon double, variable string, value double")
    days = lambda s: {r.day: r.precip for r in climate.to_daily(long, ["precip"], shift_seconds=s).collect()}
    assert days(0) == {D(2024, 1, 2): 3.0}
    assert days(-3600) == {D(2024, 1, 1): 1.0, D(2024, 1, 2): 2.0}
    assert days(3600.5) == {D(2024, 1, 2): 2.0, D(2024, 1, 3): 1.0}
    assert days(-86400) == {D(2024, 1, 1): 3.0}
    for text, want in (("{time: -3600}", -3600.0), ("{time: 1800}", 1800.0), ("{temp: 1}", 0.0)):
        rules = spark.createDataFrame(catalog_rule_rows_of(f"era5: {{unit_add: {text}}}"), RULES_SCHEMA)
        assert time_shift_seconds(rules, "era5") == want


def test_cube_shape_of_repeated_and_sparse_points(spark):
    rnd = random.Random(8)
    t0 = dt.datetime(2024, 1, 1)
    pts = [(t0 + dt.timedelta(hours=rnd.randrange(4000)), rnd.randrange(40) / 4, rnd.randrange(30) / 4) for _ in range(3000)]
    pts += [pts[0]] * 1500  # a third of the rows is one point
    df = spark.createDataFrame([*pts, (t0, None, 1.0)], "time timestamp_ntz, lat double, lon double").repartition(4)
    r = climate.cube_shape(df).first()
    assert (r.n_points_observed, r.n_cells_observed) == (len(set(pts)), len({p[1:] for p in pts}))
    assert r.n_points_dense == r.n_time * r.n_lat * r.n_lon and r.n_lat == len({p[1] for p in pts})
    assert r.first_time == min([p[0] for p in pts] + [t0]) and r.last_time == max(p[0] for p in pts)
    empty = climate.cube_shape(df.limit(0)).first()
    assert (empty.n_time, empty.n_points_observed, empty.first_time) == (0, 0, None)


def test_summary_outputs_without_a_shuffle_use_every_slot(spark):
    from hydroframe.plans.queries import _summary_outputs
    for name in ("lakes", "glaciers", "soil"):
        out = _summary_outputs()[name][0](spark, SF_SMALL)
        assert out.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism, name
