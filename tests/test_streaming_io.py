"""Sinks and vector sources."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hydroframe.operators import climate
from hydroframe.params import WHOLE_DOMAIN_JOB, Extent
from hydroframe.sources import catalog, fixtures as fx, sinks, vector
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_cube_sink_roundtrip(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="hf-cube-", dir="/tmp"), "cube")
    daily = climate.daily_forcing(spark, fx.obs_hourly(spark, SF_SMALL), WHOLE_DOMAIN_JOB)
    sinks.write_cube(daily, path, ["precip", "temp"])
    back = spark.read.parquet(path)
    assert dict(back.dtypes)["temp"] == "float"
    assert back.count() == daily.count()
    chk = sinks.write_back_check(spark, path, ["temp"]).first()
    assert chk.n_rows == daily.count()


def test_station_csv_absent_gives_empty(spark):
    df = sinks.read_stations(spark, "/tmp/definitely-not-here/grdc.csv")
    assert df.count() == 0 and df.columns[:2] == ["grdc_no", "river"]


def test_feature_collection_file_and_basin_ids(spark):
    from hydroframe.operators.waterbody import basin_ids
    d = tempfile.mkdtemp(prefix="hf-geo-", dir="/tmp")
    ring = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"MAIN_BAS": 7, "name": "a"},
         "geometry": {"type": "Polygon", "coordinates": [ring]}},
        {"type": "Feature", "properties": {"MAIN_BAS": 9, "name": "b"},
         "geometry": {"type": "Polygon", "coordinates": [[[5, 5], [6, 5], [6, 6], [5, 5]]]}}]}
    with open(os.path.join(d, "basins.geojson"), "w") as f:
        json.dump(fc, f)
    feats = vector.read_feature_collection(spark, os.path.join(d, "basins.geojson"))
    assert feats.count() == 2
    got = basin_ids(feats).select("basid").orderBy("basid").collect()
    assert [r.basid for r in got] == [7, 9]
    no_main = feats.drop("MAIN_BAS")
    assert sorted(r.basid for r in basin_ids(no_main).collect()) == [1, 2]


def test_polygon_clip_concave_and_idempotent(spark):
    # an L-shaped polygon; clipping to x <= 1 keeps a 1 x 2 strip plus nothing else
    ring = [[0, 0], [3, 0], [3, 1], [1, 1], [1, 2], [0, 2], [0, 0]]
    props = T.StructType([T.StructField("id", T.LongType())])
    text = json.dumps({"type": "Feature", "properties": {"id": 1},
                       "geometry": {"type": "Polygon", "coordinates": [ring]}})
    df = vector.parse_features(spark.createDataFrame([(text,)], "t string"), "t", props)
    ext = Extent(-1, -1, 1, 5)
    once = vector.features_in_extent(df, ext)
    r = once.first()
    assert r.area == pytest.approx(2.0)
    assert (r.xmin, r.xmax, r.ymin, r.ymax) == (0.0, 1.0, 0.0, 2.0)
    twice = vector.features_in_extent(once.select("id", "rings"), ext).first()
    assert twice.area == pytest.approx(r.area)
    assert (twice.xmin, twice.xmax, twice.ymin, twice.ymax) == (r.xmin, r.xmax, r.ymin, r.ymax)


def test_feature_text_roundtrip(spark):
    props = T.StructType([T.StructField("hylak_id", T.LongType())])
    text = fx.waterbody_geojson_text(spark, SF_SMALL)
    feats = vector.parse_features(text, "feature", props)
    again = vector.parse_features(vector.to_feature_text(feats, ["hylak_id"]), "feature", props)
    a = vector.with_rings_bbox(feats).drop("rings")
    b = vector.with_rings_bbox(again).drop("rings")
    assert _rows(a) == _rows(b)


def test_path_template_variable(spark):
    d = tempfile.mkdtemp(prefix="hf-tpl-", dir="/tmp")
    for v in ("elevtn", "uparea"):
        spark.createDataFrame([(1, 2.0)], "cell long, value double").write.parquet(os.path.join(d, f"{v}.parquet"))
    df = spark.read.parquet(os.path.join(d, "*.parquet")).withColumn(
        "variable", catalog.variable_from_path(os.path.basename(d) + "/{variable}.parquet"))
    assert sorted(r.variable for r in df.collect()) == ["elevtn", "uparea"]


def test_catalog_rules_table(spark):
    rules = catalog.catalog_rules(spark)
    assert rules.filter("source = 'soilgrids'").count() == 44
    era5 = {r.variable: (r.mult, r.add) for r in catalog.catalog_rules(spark, "era5").collect()}
    assert era5["temp"] == (None, -273.15) and era5["precip"] == (1000.0, None)
    assert "kin" not in era5  # only the surface flux is scaled for era5 (Q11)


def test_variable_metadata(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "precip double, other double")
    out = climate.with_variable_metadata(df)
    assert out.schema["precip"].metadata["units"] == "m"
    assert out.schema["other"].metadata == {}


def test_line_clip_merges_pieces(spark):
    props = T.StructType([T.StructField("id", T.LongType())])
    feats = [
        {"type": "Feature", "properties": {"id": 1}, "geometry": {"type": "LineString",
         "coordinates": [[-1, 0.5], [0.5, 0.5], [0.5, 2], [1.5, 0.5]]}},
        {"type": "Feature", "properties": {"id": 2}, "geometry": {"type": "MultiLineString",
         "coordinates": [[[5, 5], [6, 6]], [[0.2, 0.2], [0.8, 0.8]]]}},
        {"type": "Feature", "properties": {"id": 3}, "geometry": {"type": "LineString",
         "coordinates": [[2, 2], [3, 3]]}},
        {"type": "Feature", "properties": {"id": 4}, "geometry": {"type": "LineString",
         "coordinates": [[1, -1], [1, 2]]}},
    ]
    df = spark.createDataFrame([(json.dumps(f),) for f in feats], "t string")
    out = {r.id: r for r in vector.lines_in_extent(vector.parse_line_features(df, "t", props),
                                                    Extent(0, 0, 1, 1)).collect()}
    assert set(out) == {1, 2, 4}                       # 3 misses the extent
    assert [(p.x, p.y) for p in out[1].lines[0]] == [(0.0, 0.5), (0.5, 0.5), (0.5, 1.0)]
    assert out[1].length == pytest.approx(1.0)
    assert out[2].length == pytest.approx(0.6 * 2 ** 0.5)
    assert out[4].length == pytest.approx(1.0)          # along the east edge: kept


def test_vector_sink_roundtrip_keeps_nested_geometry(spark):
    props = T.StructType([T.StructField("hylak_id", T.LongType())])
    feats = vector.parse_features(fx.waterbody_geojson_text(spark, SF_SMALL), "feature", props)
    path = os.path.join(tempfile.mkdtemp(prefix="hf-vec-", dir="/tmp"), "wb")
    sinks.write_vector(feats, path)
    back = spark.read.parquet(path)
    # parquet reads nested arrays back as nullable; the shape and leaf types are kept
    assert back.schema["rings"].dataType.simpleString() == feats.schema["rings"].dataType.simpleString()
    assert _rows(vector.with_rings_bbox(back).drop("rings")) == _rows(vector.with_rings_bbox(feats).drop("rings"))
    empty = sinks.empty_result(spark, back.schema)
    assert empty.count() == 0 and empty.schema == back.schema


def test_multipolygon_clip_area_and_holes(spark):
    props = T.StructType([T.StructField("id", T.LongType())])
    sq = lambda x0, y0, s: [[x0, y0], [x0 + s, y0], [x0 + s, y0 + s], [x0, y0 + s], [x0, y0]]
    feats = [
        # inside square with a hole: 4 - 1
        {"type": "Feature", "properties": {"id": 1},
         "geometry": {"type": "Polygon", "coordinates": [sq(1, 1, 2), sq(1.5, 1.5, 1)]}},
        # two parts: one inside (area 1), one crossing the east edge x = 10 (half kept: 2)
        {"type": "Feature", "properties": {"id": 2},
         "geometry": {"type": "MultiPolygon", "coordinates": [[sq(5, 5, 1)], [sq(8, 1, 4)]]}},
        # two parts, both outside
        {"type": "Feature", "properties": {"id": 3},
         "geometry": {"type": "MultiPolygon", "coordinates": [[sq(20, 20, 1)], [sq(30, 30, 1)]]}},
        # one part outside, one part inside
        {"type": "Feature", "properties": {"id": 4},
         "geometry": {"type": "MultiPolygon", "coordinates": [[sq(-5, -5, 1)], [sq(6, 6, 1)]]}},
    ]
    df = spark.createDataFrame([(json.dumps(f),) for f in feats], "t string")
    out = {r.id: r for r in vector.polygons_in_extent(vector.parse_polygon_features(df, "t", props),
                                                       Extent(0, 0, 10, 10)).collect()}
    assert set(out) == {1, 2, 4}
    assert out[1].area == pytest.approx(3.0) and len(out[1].polys) == 1
    assert out[2].area == pytest.approx(1.0 + 2.0 * 4.0) and len(out[2].polys) == 2
    assert (out[2].xmin, out[2].xmax, out[2].ymin, out[2].ymax) == (5.0, 10.0, 1.0, 6.0)
    assert out[4].area == pytest.approx(1.0) and len(out[4].polys) == 1


def test_catalog_yaml_rules_and_join(spark):
    from hydroframe.functions.units import apply_rules_join
    d = tempfile.mkdtemp(prefix="hf-cat-", dir="/tmp")
    path = os.path.join(d, "catalog.yml")
    with open(path, "w") as f:
        f.write("""
demo_climate:
  data_type: RasterDataset
  path: demo.nc
  rename:
    t2m: temp
  unit_add:
    temp: -273.15
    time: 86400
  unit_mult:
    precip: 1000
demo_vector:
  data_type: GeoDataFrame
  nodata: -99
demo_raster:
  nodata:
    elevtn: -9999
""")
    rows = {(r[0], r[1]): r[2:] for r in catalog.catalog_rule_rows_from_yaml(path)}
    assert rows[("demo_climate", "t2m")] == ("temp", None, None, None)
    assert rows[("demo_climate", "temp")] == (None, None, -273.15, None)
    assert rows[("demo_climate", "time")][2] == 86400.0
    assert rows[("demo_vector", "*")][3] == -99.0
    assert rows[("demo_raster", "elevtn")][3] == -9999.0
    rules = catalog.catalog_rules_from_yaml(spark, path)
    long_df = spark.createDataFrame([("precip", 0.002), ("area", -99.0), ("area", 5.0)], "variable string, value double")
    got = sorted((r.variable, r.value) for r in apply_rules_join(long_df, rules, "demo_climate").collect())
    assert got == [("area", -99.0), ("area", 5.0), ("precip", pytest.approx(2.0))]
    got = [r.value for r in apply_rules_join(long_df, rules, "demo_vector").collect() if r.variable == "area"]
    assert sorted(got, key=lambda x: (x is not None, x or 0)) == [None, 5.0]   # -99 is the source nodata


def test_build_model_inputs_writes_every_output(spark):
    from hydroframe.params import JobParams
    from hydroframe.plans.job import JobInputs, build_model_inputs
    out = os.path.join(tempfile.mkdtemp(prefix="hf-job-", dir="/tmp"), "job")
    params = JobParams.of([84, 25, 96, 40], "1995-01-01", "2001-08-01", climate_buffer=0.0)
    inputs = JobInputs(hourly_obs=fx.obs_hourly(spark, SF_SMALL),
                       geopotential=fx.geopotential_hourly(spark, SF_SMALL),
                       waterbodies=fx.waterbodies(spark, SF_SMALL),
                       glaciers=fx.waterbodies(spark, SF_SMALL),
                       terrain_long=fx.terrain_long(spark, SF_SMALL),
                       soil_wide=fx.soil_wide(spark, SF_SMALL),
                       lai_pixels=fx.lai_images(spark, SF_SMALL),
                       flow_cells=fx.flow_cells(spark, SF_SMALL), outlet_xy=(12.0, 3.0))
    manifest = build_model_inputs(spark, inputs, params, out)
    assert set(manifest) == {"reservoirs", "lakes", "glaciers", "terrain", "soil", "lai_slots", "lai",
                             "forcing", "orography", "stations", "chunks", "catalog_rules",
                             "river_cells", "subbasin"}
    assert manifest["subbasin"]["rows"] >= 1
    assert manifest["lai_slots"]["rows"] == 12
    assert manifest["stations"]["rows"] == 0
    assert manifest["chunks"]["rows"] == 27          # 1995-01 .. 2001-08 in 3-month chunks
    assert manifest["reservoirs"]["rows"] == manifest["lakes"]["rows"] > 0
    assert {"waterbody_id", "Dam_height"} <= set(manifest["reservoirs"]["columns"])
    # climate is Jan 2024, outside this job's period: the forcing output is empty but written
    assert manifest["forcing"]["rows"] == 0
    assert set(spark.read.parquet(manifest["terrain"]["path"]).columns) >= {"cell", "elevtn", "flwdir"}


def test_day_partitions_are_pruned(spark):
    from hydroframe.params import JobParams
    path = os.path.join(tempfile.mkdtemp(prefix="hf-part-", dir="/tmp"), "obs")
    obs = fx.obs_hourly(spark, SF_SMALL)
    obs.withColumn("day", F.to_date("time")).write.partitionBy("day").parquet(path)
    part = spark.read.parquet(path)
    p = JobParams.of([80, 20, 100, 70], "2024-01-05", "2024-01-07", climate_buffer=0)
    q = climate.daily_forcing(spark, part, p)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "day#" in plan
    want = climate.daily_forcing(spark, obs, p)
    assert _rows(q) == _rows(want.select(*q.columns))


def test_feature_collection_with_schema_and_multipolygons(spark):
    d = tempfile.mkdtemp(prefix="hf-geo2-", dir="/tmp")
    sq = lambda x0, y0: [[x0, y0], [x0 + 1, y0], [x0 + 1, y0 + 1], [x0, y0 + 1], [x0, y0]]
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"MAIN_BAS": 1}, "geometry": {"type": "Polygon", "coordinates": [sq(0, 0)]}},
        {"type": "Feature", "properties": {"MAIN_BAS": 2},
         "geometry": {"type": "MultiPolygon", "coordinates": [[sq(2, 2)], [sq(4, 4)]]}}]}
    with open(os.path.join(d, "b.geojson"), "w") as f:
        json.dump(fc, f)
    props = T.StructType([T.StructField("MAIN_BAS", T.LongType())])
    feats = vector.read_feature_collection(spark, os.path.join(d, "b.geojson"), props)
    polys = feats.select("MAIN_BAS", vector.polygons_of("geometry").alias("polys"))
    out = {r.MAIN_BAS: r.area for r in vector.polygons_in_extent(polys, Extent(-10, -10, 10, 10)).collect()}
    assert out == {1: pytest.approx(1.0), 2: pytest.approx(2.0)}


def test_feature_lines_file(spark):
    d = tempfile.mkdtemp(prefix="hf-seq-", dir="/tmp")
    ring = [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]
    with open(os.path.join(d, "features.geojsonl"), "w") as f:
        for i in range(5):
            f.write(json.dumps({"type": "Feature", "properties": {"id": i},
                                "geometry": {"type": "Polygon", "coordinates": [ring]}}) + "\n")
    props = T.StructType([T.StructField("id", T.LongType())])
    feats = vector.read_feature_lines(spark, os.path.join(d, "features.geojsonl"), props)
    assert sorted(r.id for r in feats.collect()) == [0, 1, 2, 3, 4]
    assert vector.features_in_extent(feats, Extent(-1, -1, 2, 2)).first().area == pytest.approx(1.0)


def test_cube_files_sorted_by_coordinates(spark):
    import glob
    import pyarrow.parquet as pq
    path = os.path.join(tempfile.mkdtemp(prefix="hf-sort-", dir="/tmp"), "cube")
    daily = climate.daily_forcing(spark, fx.obs_hourly(spark, SF_SMALL), WHOLE_DOMAIN_JOB)
    sinks.write_cube(daily.repartition(3), path, ["precip", "temp"])
    for f in glob.glob(os.path.join(path, "day=*", "*.parquet")):
        lats = pq.read_table(f, columns=["lat"]).column("lat").to_pylist()
        assert lats == sorted(lats)


def test_extract_discharge_at_outlet(spark):
    from hydroframe.plans.job import extract_discharge_at_outlet
    out = tempfile.mkdtemp(prefix="hf-q-", dir="/tmp")
    res = fx.discharge(spark, SF_SMALL)
    stats = extract_discharge_at_outlet(spark, res, 85.4, 26.6, out)
    assert stats["variable"] == "q" and stats["n_steps"] > 0
    back = spark.read.option("header", True).csv(stats["path"])
    assert back.count() == stats["n_steps"]
    assert set(back.columns) == {"time", "discharge", "longitude", "latitude"}
    assert extract_discharge_at_outlet(spark, res.withColumnRenamed("q", "other"), 85.4, 26.6, out) is None


def test_job_vectors_and_landuse(spark):
    from hydroframe.params import JobParams
    from hydroframe.plans.job import JobInputs, build_model_inputs
    out = os.path.join(tempfile.mkdtemp(prefix="hf-job2-", dir="/tmp"), "job")
    sq = lambda x0, y0: [[x0, y0], [x0 + 1, y0], [x0 + 1, y0 + 1], [x0, y0 + 1], [x0, y0]]
    poly_text = spark.createDataFrame([(json.dumps({"type": "Feature", "properties": {"MAIN_BAS": 7},
                                        "geometry": {"type": "Polygon", "coordinates": [sq(85.5, 26.5)]}}),)], "t string")
    line_text = spark.createDataFrame([(json.dumps({"type": "Feature", "properties": {"rid": 1},
                                        "geometry": {"type": "LineString", "coordinates": [[84, 27], [88, 27]]}}),)], "t string")
    basins = vector.parse_polygon_features(poly_text, "t", T.StructType([T.StructField("MAIN_BAS", T.LongType())]))
    rivers = vector.parse_line_features(line_text, "t", T.StructType([T.StructField("rid", T.LongType())]))
    lu = spark.createDataFrame([(1, 26.5, 85.5, "globcover", 0.0), (1, 26.5, 85.5, "chelsa", 12.0),
                                (1, 26.5, 85.5, "koppen_geiger", 32.0)],
                               "cell long, lat double, lon double, variable string, value double")
    params = JobParams.of([85, 26, 87, 28], "2024-01-01", "2024-01-02")
    m = build_model_inputs(spark, JobInputs(basins=basins, rivers=rivers, landuse_long=lu), params, out)
    assert m["basins"]["rows"] == 1 and m["rivers"]["rows"] == 1 and m["landuse"]["rows"] == 1
    r = spark.read.parquet(m["rivers"]["path"]).first()
    assert r.length == pytest.approx(2.0)                 # clipped to 85..87
    b = spark.read.parquet(m["basins"]["path"]).first()
    assert b.basid == 7 and b.area == pytest.approx(1.0)
    g = spark.read.parquet(m["landuse"]["path"]).first()
    assert g.globcover is None and g.chelsa == 12.0 and g.koppen_geiger == 32   # catalog nodata 0 for koppen


def test_stations_absent_or_present_by_any_scheme(spark):
    base = tempfile.mkdtemp(prefix="hf-stations-", dir="/tmp")
    g = spark.createDataFrame([(1, None, "s", "c", 1.0, 2.0, 3.0, None)], sinks.STATION_SCHEMA)
    sinks.write_series_csv(g, os.path.join(base, "there"))
    for prefix in ("", "file:", "file://"):
        assert sinks.read_stations(spark, f"{prefix}{base}/there").count() == 1
        absent = sinks.read_stations(spark, f"{prefix}{base}/not-there")
        assert absent.count() == 0 and absent.schema == sinks.STATION_SCHEMA


def test_cube_files_follow_days_not_tasks(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="hf-days-", dir="/tmp"), "cube")
    rows = spark.range(0, 6000, numPartitions=24).selectExpr(
        "date_add(date'2024-01-01', int(if(id % 3 = 0, 0, id % 20))) as day", "id * 0.1 as lat", "id % 7 * 1.0 as lon",
        "cast(id as double) as precip")
    sinks.write_cube(rows, path, ["precip"])
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) <= 2 * 20 and spark.read.parquet(path).count() == 6000


def test_chunk_without_rows_has_no_folder_and_reads_back(spark):
    from hydroframe.operators import chunks
    path = os.path.join(tempfile.mkdtemp(prefix="hf-quiet-", dir="/tmp"), "chunks")
    rows = spark.createDataFrame([(dt.datetime(2020, 1, 5),), (dt.datetime(2020, 8, 5),)], "time timestamp_ntz")
    tagged = chunks.assign_chunks(rows, dt.date(2020, 1, 1), dt.date(2020, 9, 30))
    chunks.write_chunks(tagged, path)
    back = chunks.chunk_rollup(chunks.read_chunks(spark, path, tagged.schema))
    assert sorted((r.chunk_id, r.n_rows) for r in back.collect()) == [(0, 1), (2, 1)]


def test_job_exports_polygon_layers(spark):
    from hydroframe.params import JobParams
    from hydroframe.plans.job import JobInputs, build_model_inputs
    from hydroframe.plans.queries import LAKE_PROPS
    feats = vector.parse_polygon_features(fx.waterbody_triangles_text(spark, SF_SMALL), "feature", LAKE_PROPS)
    out = os.path.join(tempfile.mkdtemp(prefix="hf-poly-", dir="/tmp"), "job")
    m = build_model_inputs(spark, JobInputs(waterbodies=feats), JobParams.of([86, 27, 94, 33], "2024-01-01", "2024-01-02"), out)
    lakes = spark.read.parquet(m["lakes"]["path"])
    assert {"waterbody_id", "polys", "area", "Dam_height"} <= set(lakes.columns) and lakes.count() > 0


# --- large FeatureCollection documents (A7) -------------------------------------------------

def _collection(n, layout):
    feats = []
    for i in range(n):
        ring = [[i, 0.0], [i + 1.0, 0.0], [i, 1.0], [i, 0.0]]
        f = {"type": "Feature", "id": i, "properties": {"key": i, "note": f'has "type" and {{braces}} {i}', "empty": None},
             "geometry": {"type": "Polygon", "coordinates": [ring]}}
        feats.append(f)
    doc = {"type": "FeatureCollection", "name": "all", "features": feats, "crs": {"type": "name", "properties": {"name": "EPSG:4326"}}}
    return json.dumps(doc, sort_keys=layout == "sorted", indent=2 if layout == "indented" else None,
                      separators=(",", ":") if layout == "compact" else None)


@pytest.mark.parametrize("layout", ["plain", "compact", "indented", "sorted"])
def test_one_large_document_is_read_by_many_tasks(spark, tmp_path, layout):
    path = tmp_path / "one.geojson"
    path.write_text(_collection(4000, layout))
    props = T.StructType([T.StructField("key", T.LongType()), T.StructField("note", T.StringType())])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = vector.read_feature_collection_split(spark, str(path), props)
        got = sorted((r.key, r.note, r.geometry.type, r.geometry.coordinates) for r in df.collect())
        tasks = df.select(F.spark_partition_id().alias("p")).distinct().count()
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    whole = vector.read_feature_collection(spark, str(path), props)
    assert [(k, n) for k, n, *_ in got] == sorted((r.key, r.note) for r in whole.collect())
    polys = lambda d: sorted(map(str, d.select("key", vector.polygons_of("geometry").alias("p")).collect()))
    assert polys(df) == polys(whole) and len(got) == 4000
    assert tasks >= 8 and max(sizes) < 4000 / 4


def test_small_and_empty_documents(spark, tmp_path):
    (tmp_path / "a.geojson").write_text(_collection(1, "plain"))
    (tmp_path / "b.geojson").write_text(_collection(0, "plain"))
    (tmp_path / "c.geojson").write_text(_collection(3, "plain") + "\n" + _collection(2, "plain") + "\n")
    props = T.StructType([T.StructField("key", T.LongType())])
    assert sorted(r.key for r in vector.read_feature_collection_split(spark, str(tmp_path), props).collect()) == [0, 0, 0, 1, 1, 2]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "b.geojson").write_text(_collection(0, "plain"))
    assert vector.read_feature_collection_split(spark, str(tmp_path / "none"), props).count() == 0


def test_an_aborted_rewrite_leaves_the_old_result(spark, tmp_path):
    from hydroframe.operators import chunks
    path = str(tmp_path / "merged")
    rows = spark.range(400).selectExpr("id", "cast(id % 4 as int) as chunk_id")
    chunks.write_chunks(rows, path)
    bad = rows.withColumn("id", F.when(F.col("id") == 399, F.raise_error(F.lit("stop"))).otherwise(F.col("id") + 1000).cast("bigint"))
    for mode in ("overwrite", "chunks"):
        with pytest.raises(Exception, match="stop"):
            chunks.write_chunks(bad, path, mode)
        back = chunks.read_chunks(spark, path)
        assert back.count() == 400 and back.agg(F.max("id")).first()[0] == 399
    assert [f for f in os.listdir(tmp_path) if f != "merged"] == []
    chunks.write_chunks(rows.filter("chunk_id = 2").withColumn("id", F.col("id") + 5000), path, "chunks")  # one chunk anew
    back = chunks.read_chunks(spark, path)
    assert back.count() == 400 and back.filter("id >= 5000").select("chunk_id").distinct().collect() == [(2,)]
    chunks.write_chunks(rows.filter("chunk_id < 2"), path)  # a whole rewrite drops chunks that are gone
    assert sorted(r.chunk_id for r in chunks.read_chunks(spark, path).select("chunk_id").distinct().collect()) == [0, 1]


def test_write_back_check_reads_footers_only(spark, tmp_path):
    path = str(tmp_path / "cube")
    spark.range(1000).selectExpr("cast(id as float) as temp", "if(id % 2 = 0, null, id) as n", "id div 500 as day").write.partitionBy("day").parquet(path)
    chk = sinks.write_back_check(spark, path, ["temp", "n"])
    row = chk.first()
    assert (row.n_rows, row.min_temp, row.max_temp, row.min_n, row.max_n, row.columns) == (1000, 0.0, 999.0, 1, 999, "day,n,temp")
    plan = chk._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(temp), MAX(temp), MIN(n), MAX(n)]" in plan
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
