"""Adapter views that give the supplied test tables the shapes hydroframe operators read.

Each adapter is pure column arithmetic over one scan (or one small equi-join), so it adds
no shuffle and Catalyst prunes the unused source columns. The same views are written in
DuckDB SQL in ``hydroframe.plans.oracle`` for the correctness gate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydroframe.sources.tables import read_table, spread


def _d(v: float) -> Column:
    return F.lit(float(v))


def _grid_lat(key: Column, per_row: int) -> Column:
    return _d(26.0) + _d(0.25) * F.floor(key / per_row)


def obs_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly climate observations in long form: one row per (obs, band)."""
    ev = read_table(spark, sf_dir, "events")
    lat = _grid_lat(F.col("user_id"), 10)
    et = F.col("event_type")
    return ev.select(
        F.col("event_id").alias("obs_id"),
        F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("time"),
        lat.alias("lat"),
        (_d(85.0) + _d(0.25) * (F.col("user_id") % 10)).alias("lon"),
        F.when(F.col("event_id") % 53 == 0, F.lit("bad")).otherwise(lat.cast("string"))
        .alias("lat_text"),
        F.when(et == "view", "total_precipitation")
        .when(et == "click", "temperature_2m")
        .when(et == "purchase", "toa_incident_solar_radiation")
        .when(et == "signup", "mean_surface_direct_short_wave_radiation_flux")
        .otherwise("mean_sea_level_pressure").alias("band"),
        F.when(F.col("event_id") % 37 == 0, F.lit(None).cast("double"))
        .when(et == "view", F.col("value") * _d(1e-5))
        .when(et == "click", _d(260.0) + F.col("value") / _d(10.0))
        .when(et == "purchase", F.col("value") * _d(3600.0))
        .when(et == "signup", F.col("value"))
        .otherwise(_d(100000.0) + F.col("value") * _d(10.0)).alias("value"),
    )


def geopotential_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly geopotential rows: the pressure rows of ``obs_hourly`` turned into m^2/s^2."""
    obs = obs_hourly(spark, sf_dir)
    return obs.filter(F.col("band") == "mean_sea_level_pressure").select(
        "obs_id", "time", "lat", "lon", "lat_text",
        F.lit("geopotential").alias("band"),
        ((F.col("value") - _d(100000.0)) * _d(9.80665)).alias("value"),
    )


def waterbodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reservoir/lake attribute table with bounding boxes (HydroLAKES-like)."""
    o = read_table(spark, sf_dir, "orders")
    ck = F.col("o_custkey")
    x0 = _d(85.0) + _d(0.25) * (ck % 40)
    y0 = _d(26.0) + _d(0.25) * (F.floor(ck / 40) % 30)
    return o.select(
        F.col("o_orderkey").alias("hylak_id"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("o_totalprice") * F.pow(_d(10.0), F.col("o_orderkey") % 5 - 1))
        .alias("Vol_total"),
        ((ck % 50) * _d(0.1)).alias("Lake_area"),
        x0.alias("xmin"), (x0 + _d(0.5)).alias("xmax"),
        y0.alias("ymin"), (y0 + _d(0.5)).alias("ymax"),
    )


def gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gauging stations (GRDC-like): supplier joined to its (25-row) nation table."""
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation")
    return s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey").alias("grdc_no"),
        F.col("s_name").alias("station"),
        F.col("n_name").alias("country"),
        (_d(26.0) + _d(0.1) * (F.col("s_suppkey") % 50)).alias("lat"),
        (_d(85.0) + _d(0.1) * (F.col("s_suppkey") % 30)).alias("lon"),
        F.col("s_acctbal").alias("area"),
    )


SOIL_FIXTURE_VARS = {"bd": 30, "ph": 2}


def soil_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Soil rasters in wide form, one ``{var}_sl{n}`` column per depth layer."""
    p = read_table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    cols = [pk.alias("cell"), _grid_lat(pk, 50).alias("lat"),
            (_d(85.0) + _d(0.25) * (pk % 50)).alias("lon")]
    for v, m in SOIL_FIXTURE_VARS.items():
        for n in range(1, 8):
            cols.append(
                F.when((pk + 1) % 11 == 0, F.lit(-32768))
                .otherwise(F.col("p_size") * m + n).cast("int").alias(f"{v}_sl{n}"))
    return p.select(*cols)


TERRAIN_VARIABLES = ["elevtn", "uparea", "strord", "flwdir"]


def terrain_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terrain rasters in long form ``(cell, lat, lon, variable, value)`` with nodata codes.

    One scan of ``part``; the four variables are produced by an ``explode`` of a literal
    array in the same stage (no join, no shuffle).
    """
    p = read_table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    var = F.col("variable")
    value = (
        F.when(var == "elevtn",
               F.when(pk % 13 == 0, _d(-9999.0)).otherwise(F.col("p_retailprice")))
        .when(var == "uparea", F.col("p_size") * _d(1.0))
        .when(var == "strord",
              F.when(pk % 17 == 0, _d(255.0)).otherwise((F.col("p_size") % 9 + 1) * _d(1.0)))
        .otherwise(F.when(pk % 19 == 0, _d(247.0)).otherwise(F.pow(_d(2.0), F.col("p_size") % 8)))
    )
    return (p.select(pk.alias("cell"), _grid_lat(pk, 50).alias("lat"),
                     (_d(85.0) + _d(0.25) * (pk % 50)).alias("lon"),
                     "p_size", "p_retailprice", pk,
                     F.explode(F.array(*[F.lit(v) for v in TERRAIN_VARIABLES])).alias("variable"))
            .select("cell", "lat", "lon", "variable", value.alias("value")))


def flow_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D8 flow network: each cell points to ``next_cell``; a pointer leaving the table is an outlet."""
    c = read_table(spark, sf_dir, "customer")
    ck = F.col("c_custkey")
    step = (F.when(F.col("c_nationkey") % 3 == 0, 1)
            .when(F.col("c_nationkey") % 3 == 1, 30).otherwise(31))
    return c.select(
        ck.alias("cell"), (ck % 30).alias("x"), F.floor(ck / 30).cast("bigint").alias("y"),
        (ck + step).alias("next_cell"),
        (F.col("c_nationkey") % 9 + 1).alias("strord"),
        F.col("c_acctbal").alias("uparea"),
    )


def lai_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf-area image pixels ``(image_time, cell, obs_id, raw_lai)``, raw scale (x10)."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderdate").cast("date").alias("image_time"),
        (F.col("o_custkey") % 25).alias("cell"),
        F.col("o_orderkey").alias("obs_id"),
        (F.floor(F.col("o_totalprice")).cast("bigint") % 130 - 5).alias("raw_lai"),
    )


def lai_images_timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lai_images`` with a time of day: the observation id, modulo a day, in minutes."""
    minutes = F.make_dt_interval(mins=(F.col("obs_id") % 1440).cast("int"))
    return lai_images(spark, sf_dir).withColumn("image_time", F.col("image_time").cast("timestamp_ntz") + minutes)


def discharge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simulated discharge in long form; keys repeat, the cube keeps max(q) per cell."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("obs_id"),
        F.col("l_shipdate").alias("time"),
        (_d(26.0) + _d(0.25) * F.floor((F.col("l_suppkey") % 100) / 10)).alias("lat"),
        (_d(85.0) + _d(0.25) * (F.col("l_suppkey") % 10)).alias("lon"),
        F.col("l_quantity").alias("q"),
    )


def waterbody_geojson_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One GeoJSON Feature per row as text (GeoJSONSeq): properties + a closed box ring."""
    # JSON text and the geometry work above it are CPU-heavy per row: spread a single-split
    # scan over all task slots first (a no-op for inputs with many splits).
    wb = spread(waterbodies(spark, sf_dir))
    corners = [("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax")]
    return _polygon_text(wb, ["hylak_id", "Vol_total", "Lake_area"], corners)


def waterbody_triangles_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Water bodies as right triangles (the lower left half of their box), GeoJSON text."""
    wb = spread(waterbodies(spark, sf_dir))
    return _polygon_text(wb, ["hylak_id", "Vol_total", "Lake_area"], [("xmin", "ymin"), ("xmax", "ymin"), ("xmin", "ymax")])


def waterbody_assorted_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Water bodies as an asset of unknown properties: keys that some features lack, nulls, a
    nested object, an array, a key of two number types and one of two types (GeoJSON text)."""
    wb = spread(waterbodies(spark, sf_dir))
    k = F.col("hylak_id")
    text = lambda c: c.cast("string")
    parts = [
        F.concat(F.lit('"hylak_id":'), text(k)),
        F.concat(F.lit('"Lake_area":'), F.coalesce(text(F.col("Lake_area")), F.lit("null"))),
        F.when(k % 3 == 0, F.concat(F.lit('"name":"lake '), text(k), F.lit('"'))),
        F.when(k % 5 == 0, F.concat(F.lit('"dam":{"year":'), text(1900 + k % 100), F.lit(',"purpose":"power"}')))
        .when(k % 5 == 1, F.lit('"dam":null')),
        F.when(k % 4 == 0, F.lit('"tags":["a","b"]')),
        F.when(k % 7 == 1, F.lit('"depth":12')).when(k % 7 == 2, F.lit('"depth":12.5')),
        F.when(k % 11 == 0, F.lit('"code":"A1"')).when(k % 11 == 1, F.lit('"code":7')),
        F.when(k % 2 == 0, F.concat(F.lit('"natural":'), text(k % 6 == 0))),
    ]
    return wb.select(F.concat(F.lit('{"type":"Feature","properties":{'), F.concat_ws(",", *parts),
                              F.lit('},"geometry":null}')).alias("feature"))


def basin_text(spark: SparkSession, sf_dir: str, key: str = "MAIN_BAS") -> DataFrame:
    """Basins as right triangles with legs of two degrees, GeoJSON text; the id property is ``key``."""
    c = spread(read_table(spark, sf_dir, "customer"))
    ck = F.col("c_custkey")
    x0, y0 = _d(85.0) + _d(0.5) * (ck % 30), _d(26.0) + _d(0.5) * (F.floor(ck / 30) % 20)
    boxes = c.select(ck.alias(key), x0.alias("xmin"), (x0 + _d(2.0)).alias("xmax"), y0.alias("ymin"), (y0 + _d(2.0)).alias("ymax"))
    return _polygon_text(boxes, [key], [("xmin", "ymin"), ("xmax", "ymin"), ("xmin", "ymax")])


def _polygon_text(df: DataFrame, properties: list[str], corners: list[tuple[str, str]]) -> DataFrame:
    """One GeoJSON Feature per row: a closed ring through pairs of coordinate columns."""
    ring = F.array(*[F.array(F.col(x), F.col(y)) for x, y in corners + corners[:1]])
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"),
                       F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    return df.select(F.to_json(feature).alias("feature"))


def river_lines_text(spark: SparkSession, sf_dir: str, min_uparea: float = 30.0) -> DataFrame:
    """River reaches as GeoJSON LineString text: every river cell (upstream area >= 30, L2)
    joined to its downstream cell (equi-join on the cell id) gives a segment from cell centre
    to cell centre, in grid units."""
    cells = flow_cells(spark, sf_dir)
    river = cells.filter(F.col("uparea") >= F.lit(min_uparea)).select("cell", "x", "y", "next_cell", "strord")
    nxt = cells.select(F.col("cell").alias("next_cell"), F.col("x").alias("nx"), F.col("y").alias("ny"))
    seg = river.join(nxt, "next_cell")
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct("cell", "strord").alias("properties"),
        F.struct(F.lit("LineString").alias("type"),
                 F.array(F.array("x", "y"), F.array("nx", "ny")).alias("coordinates")).alias("geometry"))
    return seg.select(F.to_json(feature).alias("feature"))


def lai_pixels_on_grid(spark: SparkSession, sf_dir: str, ext, deg: float) -> DataFrame:
    """Leaf-area pixels with coordinates: the 25 fixture cells placed on the nodes of a 5 x 5
    grid of ``ext`` (row = cell div 5, column = cell mod 5), derived from ``lai_images``."""
    from hydroframe.operators.raster import grid_shape
    h, w, dlat, dlon = grid_shape(ext, deg)
    px = lai_images(spark, sf_dir)
    return px.select("image_time", "obs_id", "raw_lai",
                     (F.lit(ext.north) - F.floor(F.col("cell") / 5).cast("double") * F.lit(dlat)).alias("lat"),
                     (F.lit(ext.west) + (F.col("cell") % 5).cast("double") * F.lit(dlon)).alias("lon"))


LANDUSE_VARIABLES = ["globcover", "chelsa", "koppen_geiger"]


def landuse_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land-cover, climate and climate-class rasters in long form, derived from ``part`` like
    ``terrain_long``, with each variable's nodata code present (0, -32767, and both 0 and
    32 for the climate class, the catalog's and the fetch's codes)."""
    p = read_table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    var = F.col("variable")
    value = (
        F.when(var == "globcover",
               F.when(pk % 13 == 0, _d(0.0)).otherwise((F.col("p_size") % 23 + 1) * _d(10.0)))
        .when(var == "chelsa",
              F.when(pk % 17 == 0, _d(-32767.0)).otherwise(F.floor(F.col("p_retailprice")) * _d(1.0)))
        .otherwise(F.when(pk % 19 == 0, _d(32.0)).when(pk % 23 == 0, _d(0.0))
                   .otherwise((F.col("p_size") % 30 + 1) * _d(1.0)))
    )
    return (p.select(pk.alias("cell"), _grid_lat(pk, 50).alias("lat"),
                     (_d(85.0) + _d(0.25) * (pk % 50)).alias("lon"),
                     "p_size", "p_retailprice", pk,
                     F.explode(F.array(*[F.lit(v) for v in LANDUSE_VARIABLES])).alias("variable"))
            .select("cell", "lat", "lon", "variable", value.alias("value")))
