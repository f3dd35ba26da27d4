"""DuckDB twins of the registered queries (the correctness gate).

Each string runs on DuckDB over the pre-registered test tables. The adapter views of
``hydroframe.sources.fixtures`` are repeated here as CTEs; literals are cast to DOUBLE
because DuckDB reads ``0.25`` as DECIMAL.
"""

from __future__ import annotations

from hydroframe.params import WHOLE_DOMAIN_JOB, JobParams

D = "::DOUBLE"

OBS_HOURLY = f"""obs_hourly AS (
  SELECT event_id AS obs_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS time,
    26{D} + 0.25{D} * floor(user_id / 10) AS lat, 85{D} + 0.25{D} * (user_id % 10) AS lon,
    CASE WHEN event_id % 53 = 0 THEN 'bad'
         ELSE CAST(26{D} + 0.25{D} * floor(user_id / 10) AS VARCHAR) END AS lat_text,
    CASE event_type WHEN 'view' THEN 'total_precipitation' WHEN 'click' THEN 'temperature_2m'
      WHEN 'purchase' THEN 'toa_incident_solar_radiation'
      WHEN 'signup' THEN 'mean_surface_direct_short_wave_radiation_flux'
      ELSE 'mean_sea_level_pressure' END AS band,
    CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_type = 'view' THEN value * 1e-5{D}
      WHEN event_type = 'click' THEN 260{D} + value / 10{D} WHEN event_type = 'purchase' THEN value * 3600{D}
      WHEN event_type = 'signup' THEN value ELSE 100000{D} + value * 10{D} END AS value
  FROM events)"""

GEOPOTENTIAL = f"""geo_hourly AS (
  SELECT obs_id, time, lat, lon, lat_text, 'geopotential' AS band,
         (value - 100000{D}) * 9.80665{D} AS value
  FROM obs_hourly WHERE band = 'mean_sea_level_pressure')"""

WATERBODIES = f"""waterbodies AS (
  SELECT o_orderkey AS hylak_id,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice * pow(10{D}, o_orderkey % 5 - 1) END AS Vol_total,
    (o_custkey % 50) * 0.1{D} AS Lake_area,
    85{D} + 0.25{D} * (o_custkey % 40) AS xmin, 85{D} + 0.25{D} * (o_custkey % 40) + 0.5{D} AS xmax,
    26{D} + 0.25{D} * (floor(o_custkey / 40) % 30) AS ymin,
    26{D} + 0.25{D} * (floor(o_custkey / 40) % 30) + 0.5{D} AS ymax
  FROM orders)"""

GAUGES = f"""gauges AS (
  SELECT s_suppkey AS grdc_no, s_name AS station, n_name AS country,
    26{D} + 0.1{D} * (s_suppkey % 50) AS lat, 85{D} + 0.1{D} * (s_suppkey % 30) AS lon, s_acctbal AS area
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


def _soil_cols() -> str:
    out = []
    for v, m in (("bd", 30), ("ph", 2)):
        for n in range(1, 8):
            out.append(f"CAST(CASE WHEN (p_partkey + 1) % 11 = 0 THEN -32768 ELSE p_size * {m} + {n} END AS INTEGER) AS {v}_sl{n}")
    return ",\n    ".join(out)


SOIL_WIDE = f"""soil_wide AS (
  SELECT p_partkey AS cell, 26{D} + 0.25{D} * floor(p_partkey / 50) AS lat, 85{D} + 0.25{D} * (p_partkey % 50) AS lon,
    {_soil_cols()}
  FROM part)"""

TERRAIN_LONG = f"""terrain_long AS (
  SELECT p_partkey AS cell, 26{D} + 0.25{D} * floor(p_partkey / 50) AS lat, 85{D} + 0.25{D} * (p_partkey % 50) AS lon, variable,
    CASE variable WHEN 'elevtn' THEN CASE WHEN p_partkey % 13 = 0 THEN -9999{D} ELSE p_retailprice END
      WHEN 'uparea' THEN p_size * 1{D}
      WHEN 'strord' THEN CASE WHEN p_partkey % 17 = 0 THEN 255{D} ELSE (p_size % 9 + 1) * 1{D} END
      ELSE CASE WHEN p_partkey % 19 = 0 THEN 247{D} ELSE pow(2{D}, p_size % 8) END END AS value
  FROM part CROSS JOIN (VALUES ('elevtn'), ('uparea'), ('strord'), ('flwdir')) v(variable))"""

FLOW_CELLS = """flow_cells AS (
  SELECT c_custkey AS cell, c_custkey % 30 AS x, CAST(floor(c_custkey / 30) AS BIGINT) AS y,
    c_custkey + CASE c_nationkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 30 ELSE 31 END AS next_cell,
    c_nationkey % 9 + 1 AS strord, c_acctbal AS uparea
  FROM customer)"""

LAI_IMAGES = """lai_images AS (
  SELECT CAST(o_orderdate AS DATE) AS image_time, o_custkey % 25 AS cell, o_orderkey AS obs_id,
    CAST(floor(o_totalprice) AS BIGINT) % 130 - 5 AS raw_lai
  FROM orders)"""

DISCHARGE = f"""discharge AS (
  SELECT l_orderkey * 10 + l_linenumber AS obs_id, l_shipdate AS time,
    26{D} + 0.25{D} * floor((l_suppkey % 100) / 10) AS lat, 85{D} + 0.25{D} * (l_suppkey % 10) AS lon,
    l_quantity AS q
  FROM lineitem)"""

# Fixed values, written out apart from the engine's own tables.
ORACLE_SOIL_FLAT = ["tax_usda", "soilthickness"]
ORACLE_SOIL_DEEP = ["sndppt", "sltppt", "oc", "ph", "bd", "clyppt"]
ORACLE_CONSTANTS = {
    "KsatHorFrac": 25.0, "Cfmax": 3.75653, "cf_soil": 0.038, "EoverR": 0.05, "InfiltCapPath": 5.0,
    "InfiltCapSoil": 600.0, "MaxLeakage": 0.0, "rootdistpar": -500.0, "TT": 0.0, "TTI": 2.0, "TTM": 0.0,
    "WHC": 0.1, "G_Cfmax": 5.3, "G_SIfrac": 0.002, "G_TT": 1.3}

CATALOG_ERA5 = """rules AS (
  SELECT * FROM (VALUES ('temp', NULL::DOUBLE, -273.15::DOUBLE), ('temp_max', NULL, -273.15::DOUBLE),
    ('temp_min', NULL, -273.15::DOUBLE), ('kout', 0.000277778::DOUBLE, NULL),
    ('precip', 1000::DOUBLE, NULL), ('press_msl', 0.01::DOUBLE, NULL)) r(variable, mult, "add"))"""


def _ts(d) -> str:
    return f"TIMESTAMP '{d.isoformat()} 00:00:00'"


def hourly_long_sql(p: JobParams) -> str:
    """CTE chain ending in ``units(time, lat, lon, variable, value)`` (A12 + F1 + D12 + I5)."""
    e = p.extent.buffer(p.climate_buffer)
    import datetime as dt
    end_excl = p.end_date + dt.timedelta(days=1)
    return f"""{OBS_HOURLY},
sel AS (SELECT * FROM obs_hourly
  WHERE lat BETWEEN {e.south}{D} AND {e.north}{D} AND lon BETWEEN {e.west}{D} AND {e.east}{D}
    AND time >= {_ts(p.start_date)} AND time < {_ts(end_excl)}),
clean AS (SELECT obs_id, time, round_even(TRY_CAST(lat_text AS DOUBLE), 5) AS lat,
    round_even(lon, 5) AS lon, band, value FROM sel WHERE TRY_CAST(lat_text AS DOUBLE) IS NOT NULL),
vars AS (SELECT obs_id, time, lat, lon, value,
    CASE band WHEN 'total_precipitation' THEN 'precip' WHEN 'temperature_2m' THEN 'temp'
      WHEN 'toa_incident_solar_radiation' THEN 'kin'
      WHEN 'mean_surface_direct_short_wave_radiation_flux' THEN 'kout'
      WHEN 'mean_sea_level_pressure' THEN 'press_msl' END AS variable
  FROM clean WHERE band IN ('total_precipitation', 'temperature_2m', 'toa_incident_solar_radiation',
    'mean_surface_direct_short_wave_radiation_flux', 'mean_sea_level_pressure')
    AND value IS NOT NULL AND NOT isnan(value)),
dedup AS (SELECT time, lat, lon, variable, arg_max(value, obs_id) AS value FROM vars GROUP BY time, lat, lon, variable),
{CATALOG_ERA5},
units AS (SELECT d.time, d.lat, d.lon, d.variable,
    d.value * coalesce(r.mult, 1{D}) + coalesce(r."add", 0{D}) AS value
  FROM dedup d LEFT JOIN rules r ON d.variable = r.variable)"""


def daily_forcing_sql(p: JobParams = WHOLE_DOMAIN_JOB) -> str:
    cols = []
    for v, agg in (("precip", "sum"), ("temp", "avg"), ("kin", "avg"), ("kout", "avg"), ("press_msl", "avg")):
        cols.append(f"round({agg}(CASE WHEN variable = '{v}' THEN value END), 6) AS {v}")
    return f"""WITH {hourly_long_sql(p)}
SELECT CAST(time AS DATE) AS day, lat, lon, {', '.join(cols)}
FROM units GROUP BY CAST(time AS DATE), lat, lon"""


def climate_rows_sql(p: JobParams) -> str:
    """CTE chain ending in ``rows``: region/period rows with clean coordinates, all values
    (the axes of the cube, Q3/Q4: a time counts even when its values are missing)."""
    return hourly_long_sql(p) + """,
rows AS (SELECT time, lat, lon, band, value FROM clean WHERE band IN ('total_precipitation',
    'temperature_2m', 'toa_incident_solar_radiation', 'mean_surface_direct_short_wave_radiation_flux',
    'mean_sea_level_pressure'))"""


def hourly_climate_long_sql(p: JobParams = WHOLE_DOMAIN_JOB) -> str:
    return f"""WITH {hourly_long_sql(p)}
SELECT time, lat, lon, variable, round(value, 6) AS value FROM units"""


def orography_sql(p: JobParams = WHOLE_DOMAIN_JOB) -> str:
    import datetime as dt
    e = p.extent.buffer(p.climate_buffer)
    end_excl = p.end_date + dt.timedelta(days=1)
    return f"""WITH {OBS_HOURLY}, {GEOPOTENTIAL},
sel AS (SELECT * FROM geo_hourly
  WHERE lat BETWEEN {e.south}{D} AND {e.north}{D} AND lon BETWEEN {e.west}{D} AND {e.east}{D}
    AND time >= {_ts(p.start_date)} AND time < {_ts(end_excl)}),
clean AS (SELECT obs_id, time, round_even(TRY_CAST(lat_text AS DOUBLE), 5) AS lat,
    round_even(lon, 5) AS lon, value FROM sel WHERE TRY_CAST(lat_text AS DOUBLE) IS NOT NULL
    AND value IS NOT NULL AND NOT isnan(value))
SELECT time, lat, lon, round(arg_max(value / 9.80665{D}, obs_id), 6) AS elevtn
FROM clean GROUP BY time, lat, lon"""


def cube_shape_sql(p: JobParams = WHOLE_DOMAIN_JOB) -> str:
    return f"""WITH {climate_rows_sql(p)}
SELECT count(DISTINCT time) AS n_time, count(DISTINCT lat) AS n_lat, count(DISTINCT lon) AS n_lon,
  (SELECT count(*) FROM (SELECT DISTINCT lat, lon FROM rows)) AS n_cells_observed,
  (SELECT count(*) FROM (SELECT DISTINCT time, lat, lon FROM rows)) AS n_points_observed,
  min(time) AS first_time, max(time) AS last_time,
  count(DISTINCT time) * count(DISTINCT lat) * count(DISTINCT lon) AS n_points_dense
FROM rows"""


def dense_cube_sql(p: JobParams = WHOLE_DOMAIN_JOB) -> str:
    vals = ", ".join(f"round(max(CASE WHEN variable = '{v}' THEN value END), 6) AS {v}"
                     for v in ("precip", "temp", "kin", "kout", "press_msl"))
    return f"""WITH {climate_rows_sql(p)},
wide AS (SELECT time, lat, lon, {vals} FROM units GROUP BY time, lat, lon),
t AS (SELECT DISTINCT time FROM rows), la AS (SELECT DISTINCT lat FROM rows), lo AS (SELECT DISTINCT lon FROM rows)
SELECT t.time, la.lat, lo.lon, w.precip, w.temp, w.kin, w.kout, w.press_msl
FROM t CROSS JOIN la CROSS JOIN lo
LEFT JOIN wide w ON w.time = t.time AND w.lat = la.lat AND w.lon = lo.lon"""


def day_gaps_sql(p: JobParams = WHOLE_DOMAIN_JOB) -> str:
    return f"""WITH {hourly_long_sql(p)},
cal AS (SELECT CAST(d AS DATE) AS day FROM generate_series(DATE '{p.start_date}', DATE '{p.end_date}', INTERVAL 1 DAY) g(d)),
per_day AS (SELECT CAST(time AS DATE) AS day, count(*) AS n_rows FROM units GROUP BY 1)
SELECT cal.day, coalesce(per_day.n_rows, 0) AS n_rows,
  CASE WHEN per_day.n_rows IS NULL THEN 'missing' ELSE 'ok' END AS status
FROM cal LEFT JOIN per_day USING (day)"""


def dam_height_sql_expr(v: str = "Vol_total", a: str = "Lake_area") -> str:
    am2 = f"({a} * 1e6{D})"
    prism = f"(2{D} * {v} / {am2})"
    emp = f"(10{D} * sqrt({v} / {am2}))"
    cub = f"(5{D} * pow({v}, 1{D} / 3{D}))"
    blend = (f"CASE WHEN {v} < 1e6{D} THEN 0.7{D} * {emp} + 0.2{D} * {prism} + 0.1{D} * {cub} "
             f"WHEN {v} <= 1e8{D} THEN 0.4{D} * {emp} + 0.4{D} * {prism} + 0.2{D} * {cub} "
             f"WHEN {v} > 1e8{D} THEN 0.3{D} * {emp} + 0.6{D} * {prism} + 0.1{D} * {cub} END")
    valid = f"({v} IS NOT NULL AND {a} IS NOT NULL AND {v} > 0 AND {a} > 0)"
    return (f"(CASE WHEN {valid} THEN coalesce(least(300{D}, greatest(5{D}, {blend})), 20{D}) "
            f"ELSE 20{D} END)")


def size_class_sql(v: str = "Vol_total") -> str:
    return (f"(CASE WHEN {v} < 1e6{D} THEN 'small' WHEN {v} <= 1e8{D} THEN 'medium' "
            f"WHEN {v} > 1e8{D} THEN 'large' END)")


def dam_height_sql() -> str:
    return f"""WITH {WATERBODIES}
SELECT hylak_id, Vol_total, Lake_area, {size_class_sql()} AS size_class,
  round({dam_height_sql_expr()}, 6) AS Dam_height
FROM waterbodies"""


def dam_height_stats_sql() -> str:
    return f"""WITH {WATERBODIES}, h AS (SELECT {dam_height_sql_expr()} AS h FROM waterbodies)
SELECT count(*) AS n, round(min(h), 6) AS min_height, round(max(h), 6) AS max_height,
  round(avg(h), 6) AS mean_height, round(stddev_samp(h), 6) AS std_height,
  count(*) FILTER (WHERE h > 0) AS n_positive, round(median(h), 6) AS median_height
FROM h"""


def dam_height_by_class_sql() -> str:
    return f"""WITH {WATERBODIES}, h AS (SELECT {size_class_sql()} AS size_class, {dam_height_sql_expr()} AS h FROM waterbodies)
SELECT size_class, round(avg(h), 6) AS mean_height, count(*) AS n FROM h
WHERE size_class IS NOT NULL GROUP BY size_class"""


def dam_height_first_k_sql(k: int = 5) -> str:
    v, am2 = "Vol_total", f"(Lake_area * 1e6{D})"
    return f"""WITH {WATERBODIES},
firstk AS (SELECT * FROM waterbodies ORDER BY hylak_id LIMIT {k})
SELECT hylak_id, round(2{D} * {v} / {am2}, 6) AS h_prism, round(10{D} * sqrt({v} / {am2}), 6) AS h_empirical,
  round(5{D} * pow({v}, 1{D} / 3{D}), 6) AS h_cubic, round({dam_height_sql_expr()}, 6) AS Dam_height
FROM firstk WHERE {v} IS NOT NULL AND Lake_area IS NOT NULL AND {v} > 0 AND Lake_area > 0"""


def reservoirs_sql(ext) -> str:
    w, s, e, n = (f"{x}{D}" for x in (ext.west, ext.south, ext.east, ext.north))
    return f"""WITH {WATERBODIES},
f AS (SELECT hylak_id, Vol_total, Lake_area, greatest(xmin, {w}) AS xmin, least(xmax, {e}) AS xmax,
    greatest(ymin, {s}) AS ymin, least(ymax, {n}) AS ymax
  FROM waterbodies WHERE xmax >= {w} AND xmin <= {e} AND ymax >= {s} AND ymin <= {n}),
g AS (SELECT * FROM f WHERE xmin < xmax AND ymin < ymax)
SELECT CAST(row_number() OVER (ORDER BY hylak_id) - 1 AS BIGINT) AS waterbody_id, Vol_total, Lake_area,
  xmin, xmax, ymin, ymax, round({dam_height_sql_expr()}, 6) AS Dam_height
FROM g"""


def terrain_grid_sql() -> str:
    return f"""WITH {TERRAIN_LONG},
m AS (SELECT cell, lat, lon, variable,
    CASE WHEN (variable = 'elevtn' AND value = -9999{D}) OR (variable = 'uparea' AND value = -9999{D})
      OR (variable = 'strord' AND value = 255{D}) OR (variable = 'flwdir' AND value = 247{D}) THEN NULL
      ELSE value END AS value FROM terrain_long)
SELECT cell, lat, lon, max(CASE WHEN variable = 'elevtn' THEN value END) AS elevtn,
  max(CASE WHEN variable = 'uparea' THEN value END) AS uparea,
  CAST(max(CASE WHEN variable = 'strord' THEN value END) AS INTEGER) AS strord,
  CAST(max(CASE WHEN variable = 'flwdir' THEN value END) AS INTEGER) AS flwdir
FROM m GROUP BY cell, lat, lon"""


def soil_long_sql() -> str:
    mult = {"bd": 0.001, "ph": 0.1}
    parts = []
    for v in ("bd", "ph"):
        for n in range(1, 8):
            parts.append(f"SELECT cell, lat, lon, '{v}' AS variable, CAST({n} AS INTEGER) AS depth, "
                         f"round(nullif(CAST({v}_sl{n} AS DOUBLE), -32768{D}) * {mult[v]}{D}, 6) AS value FROM soil_wide")
    return f"WITH {SOIL_WIDE}\n" + "\nUNION ALL\n".join(parts)


def soil_missing_members_sql() -> str:
    # The soil family, written out apart from the engine's own list.
    rows = [f"('{v}', '{v}', NULL::INTEGER)" for v in ORACLE_SOIL_FLAT]
    rows += [f"('{v}_sl{d}', '{v}', {d})" for v in ORACLE_SOIL_DEEP for d in (1, 2, 3, 4, 5, 6, 7)]
    present = []
    for v in ("bd", "ph"):
        for n in range(1, 8):
            present.append(f"SELECT '{v}_sl{n}' AS member FROM soil_wide WHERE {v}_sl{n} <> -32768")
    return f"""WITH {SOIL_WIDE},
expected AS (SELECT * FROM (VALUES {', '.join(rows)}) e(member, variable, depth)),
present AS ({' UNION '.join(present)})
SELECT member, variable, CAST(depth AS INTEGER) AS depth FROM expected
WHERE member NOT IN (SELECT member FROM present)"""


def _lai_slots_cte(k: int = 12, days: str | None = None, images: str = LAI_IMAGES, kind: str = "DATE") -> str:
    """Slots over the whole archive, or over the image times that ``days`` selects."""
    days = days or """SELECT DISTINCT image_time AS time FROM lai_images
  WHERE image_time < (SELECT max(image_time) FROM lai_images)"""
    return f"""{images},
days AS ({days}),
r AS (SELECT time, row_number() OVER (ORDER BY time) - 1 AS rn, count(*) OVER () AS n FROM days),
c AS (SELECT DISTINCT r.time, r.n FROM r, range({k}) t(i)
  WHERE r.n < {k} OR r.rn = CAST(floor(t.i * (r.n - 1) / {k - 1}) AS BIGINT)),
slots AS (SELECT CAST(row_number() OVER (ORDER BY time) - 1 AS INTEGER) AS slot, time, n AS n_images, false AS is_padding FROM c),
pads AS (SELECT CAST(m.m + j.j - 1 AS INTEGER) AS slot, CAST(m.last + to_days(CAST(j.j * 30 AS INTEGER)) AS {kind}) AS time,
    NULL::BIGINT AS n_images, true AS is_padding
  FROM (SELECT max(time) AS last, count(*) AS m FROM slots) m, range(1, {k + 1}) j(j)
  WHERE m.m > 0 AND j.j <= {k} - m.m),
all_slots AS (SELECT * FROM slots UNION ALL SELECT * FROM pads)"""


LAI_IMAGES_TIMED = f"""{LAI_IMAGES},
lai_timed AS (SELECT image_time + to_minutes(CAST(obs_id % 1440 AS INTEGER)) AS image_time, cell, obs_id, raw_lai
  FROM lai_images)"""


def lai_slots_short_sql(n_days: int) -> str:
    days = f"""SELECT min(image_time) AS time FROM lai_timed
  WHERE image_time < (SELECT CAST(min(image_time) AS DATE) FROM lai_timed) + INTERVAL {n_days} DAY
  GROUP BY CAST(image_time AS DATE)"""
    cte = _lai_slots_cte(days=days, images=LAI_IMAGES_TIMED, kind="TIMESTAMP")
    return f"WITH {cte}\nSELECT slot, time, n_images, is_padding FROM all_slots WHERE slot < 12"


def image_fallback_timed_sql() -> str:
    return f"""WITH {LAI_IMAGES_TIMED},
targets AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS target_day FROM lineitem),
firsts AS (SELECT CAST(image_time AS DATE) AS d, min(image_time) AS t FROM lai_timed GROUP BY 1),
hits AS (SELECT g.target_day, f.t, f.d = g.target_day AS exact FROM targets g JOIN firsts f
  ON f.d >= g.target_day - INTERVAL 2 DAY AND f.d < g.target_day + INTERVAL 3 DAY)
SELECT g.target_day, coalesce(min(h.t) FILTER (WHERE h.exact), min(h.t)) AS image_day,
  coalesce(bool_or(h.exact), false) AS exact_day
FROM targets g LEFT JOIN hits h ON h.target_day = g.target_day GROUP BY g.target_day"""


def lai_slots_sql() -> str:
    return f"WITH {_lai_slots_cte()}\nSELECT slot, time, n_images, is_padding FROM all_slots WHERE slot < 12"


def lai_cube_sql() -> str:
    return f"""WITH {_lai_slots_cte()},
p AS (SELECT s.slot, l.image_time AS time, l.cell, arg_max(l.raw_lai, l.obs_id) AS raw
  FROM lai_images l JOIN slots s ON l.image_time = s.time GROUP BY s.slot, l.image_time, l.cell)
SELECT slot, time, cell,
  CASE WHEN raw * 0.1{D} BETWEEN 0{D} AND 10{D} THEN round(raw * 0.1{D}, 6) END AS lai FROM p"""


def lai_slice_range_sql() -> str:
    return f"""WITH q AS ({lai_cube_sql()})
SELECT slot, time, min(lai) AS lai_min, max(lai) AS lai_max, count(lai) AS n_valid FROM q GROUP BY slot, time"""


def image_fallback_sql() -> str:
    return f"""WITH {LAI_IMAGES},
days AS (SELECT DISTINCT image_time AS d FROM lai_images),
targets AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS target_day FROM lineitem),
hits AS (SELECT t.target_day, d.d, d.d = t.target_day AS exact FROM targets t JOIN days d
  ON d.d >= t.target_day - INTERVAL 2 DAY AND d.d < t.target_day + INTERVAL 3 DAY)
SELECT t.target_day, CASE WHEN bool_or(h.exact) THEN t.target_day ELSE min(h.d) END AS image_day,
  coalesce(bool_or(h.exact), false) AS exact_day
FROM targets t LEFT JOIN hits h ON h.target_day = t.target_day GROUP BY t.target_day"""


def chunk_table_sql() -> str:
    return """WITH b AS (SELECT CAST(min(l_shipdate) AS DATE) AS s, CAST(max(l_shipdate) AS DATE) AS e FROM lineitem),
k AS (SELECT s, e, unnest(range(0, CAST(floor(((year(e) - year(s)) * 12 + month(e) - month(s)) / 3) AS BIGINT) + 1)) AS k FROM b),
c AS (SELECT CAST(k AS INTEGER) AS chunk_id,
    CASE WHEN k = 0 THEN s ELSE CAST(date_trunc('month', s + to_months(CAST(k * 3 AS INTEGER))) AS DATE) END AS chunk_start,
    least(last_day(s + to_months(CAST(k * 3 + 2 AS INTEGER))), e) AS chunk_end FROM k)
SELECT chunk_id, chunk_start, chunk_end, strftime(chunk_start, '%Y%m%d') || '_' || strftime(chunk_end, '%Y%m%d') AS chunk_label FROM c"""


def chunk_rows_pruned_sql() -> str:
    return f"""WITH {DISCHARGE},
b AS (SELECT CAST(min(time) AS DATE) AS s FROM discharge),
t AS (SELECT d.*, CAST(floor(((year(d.time) - year(b.s)) * 12 + month(d.time) - month(b.s)) / 3) AS INTEGER) AS chunk_id
  FROM discharge d, b)
SELECT * FROM t WHERE chunk_id % 4 = 1"""


def chunk_rollup_sql() -> str:
    return f"""WITH {DISCHARGE},
b AS (SELECT CAST(min(time) AS DATE) AS s FROM discharge),
t AS (SELECT d.time, CAST(floor(((year(d.time) - year(b.s)) * 12 + month(d.time) - month(b.s)) / 3) AS INTEGER) AS chunk_id
  FROM discharge d, b)
SELECT chunk_id, count(*) AS n_rows, count(DISTINCT time) AS n_times, min(time) AS first_time, max(time) AS last_time
FROM t GROUP BY chunk_id"""


def _outlet_cte(lon: float, lat: float) -> str:
    return f"""{DISCHARGE},
cube AS (SELECT time, lat, lon, max(q) AS discharge FROM discharge GROUP BY time, lat, lon),
la AS (SELECT lat FROM (SELECT DISTINCT lat FROM cube) ORDER BY abs(lat - {lat}{D}), lat LIMIT 1),
lo AS (SELECT lon FROM (SELECT DISTINCT lon FROM cube) ORDER BY abs(lon - {lon}{D}), lon LIMIT 1),
t AS (SELECT DISTINCT time FROM cube),
series AS (SELECT t.time, c.discharge, (SELECT lon FROM lo) AS longitude, (SELECT lat FROM la) AS latitude
  FROM t LEFT JOIN cube c ON c.time = t.time AND c.lat = (SELECT lat FROM la) AND c.lon = (SELECT lon FROM lo))"""


def outlet_series_sql(lon: float, lat: float) -> str:
    return f"WITH {_outlet_cte(lon, lat)}\nSELECT * FROM series"


def outlet_stats_sql(lon: float, lat: float) -> str:
    return f"""WITH {_outlet_cte(lon, lat)}
SELECT round(avg(discharge), 6) AS mean_q, max(discharge) AS max_q, min(discharge) AS min_q,
  count(discharge) AS n_valid, count(*) AS n_steps FROM series"""


def upstream_cells_sql(x: float, y: float, min_order: int = 7) -> str:
    return f"""WITH RECURSIVE {FLOW_CELLS},
outlet AS (SELECT cell FROM flow_cells WHERE strord >= {min_order}
  ORDER BY (x - {x}{D}) * (x - {x}{D}) + (y - {y}{D}) * (y - {y}{D}), cell LIMIT 1),
up(cell) AS (SELECT cell FROM outlet UNION SELECT f.cell FROM flow_cells f JOIN up ON f.next_cell = up.cell)
SELECT * FROM flow_cells WHERE cell IN (SELECT cell FROM up)"""


def river_cells_sql(min_uparea: float = 30.0) -> str:
    return f"WITH {FLOW_CELLS}\nSELECT cell, strord, uparea FROM flow_cells WHERE uparea >= {min_uparea}{D}"


def geojson_waterbodies_sql() -> str:
    return f"WITH {WATERBODIES}\nSELECT hylak_id, Vol_total, Lake_area, xmin, xmax, ymin, ymax FROM waterbodies"


# The asset of unknown properties, built and read with DuckDB's own JSON functions.
ASSORTED = f"""assorted AS (SELECT hylak_id AS k, json_merge_patch(
  json_object('hylak_id', hylak_id, 'Lake_area', Lake_area),
  CASE WHEN hylak_id % 3 = 0 THEN json_object('name', 'lake ' || hylak_id) ELSE '{{}}' END,
  CASE WHEN hylak_id % 4 = 0 THEN json_object('tags', ['a', 'b']) ELSE '{{}}' END,
  CASE hylak_id % 7 WHEN 1 THEN '{{"depth":12}}' WHEN 2 THEN '{{"depth":12.5}}' ELSE '{{}}' END,
  CASE hylak_id % 11 WHEN 0 THEN '{{"code":"A1"}}' WHEN 1 THEN '{{"code":7}}' ELSE '{{}}' END,
  CASE WHEN hylak_id % 2 = 0 THEN json_object('natural', hylak_id % 6 = 0) ELSE '{{}}' END,
  CASE WHEN hylak_id % 5 = 0 THEN json_object('dam', json_object('year', 1900 + hylak_id % 100, 'purpose', 'power')) ELSE '{{}}' END) AS p
  FROM waterbodies)"""


def property_keys_sql() -> str:
    kind = """CASE json_type(p, '$.' || path) WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'OBJECT' THEN 'object'
    WHEN 'ARRAY' THEN 'array' WHEN 'DOUBLE' THEN 'number' ELSE 'integer' END"""
    return f"""WITH {WATERBODIES}, {ASSORTED},
paths AS (SELECT p, unnest(json_keys(p)) AS path FROM assorted
  UNION ALL SELECT p, 'dam.' || unnest(json_keys(p, '$.dam')) FROM assorted WHERE json_type(p, '$.dam') = 'OBJECT'),
kinds AS (SELECT path, {kind} AS kind FROM paths),
found AS (SELECT path, list(DISTINCT kind) AS kinds, count(*) AS n FROM kinds GROUP BY path),
nulls AS (SELECT count(*) AS n FROM waterbodies WHERE hylak_id % 5 = 1)  -- merging drops the nulls
SELECT path, CASE WHEN len(kinds) = 1 THEN kinds[1] WHEN list_has_all(['integer', 'number'], kinds) THEN 'number' ELSE 'mixed' END AS type,
  found.n + CASE WHEN path = 'dam' THEN nulls.n ELSE 0 END AS n_features, CASE WHEN path = 'dam' THEN nulls.n ELSE 0 END AS n_null
FROM found, nulls"""


def property_columns_sql() -> str:
    return f"""WITH {WATERBODIES}
SELECT hylak_id, Lake_area, CASE WHEN hylak_id % 3 = 0 THEN 'lake ' || hylak_id END AS name,
  CASE WHEN hylak_id % 5 = 0 THEN '{{"purpose":"power","year":' || (1900 + hylak_id % 100) || '}}' WHEN hylak_id % 5 = 1 THEN 'null' END AS dam,
  CASE WHEN hylak_id % 5 = 0 THEN CAST(1900 + hylak_id % 100 AS INTEGER) END AS built,
  CASE WHEN hylak_id % 4 = 0 THEN '["a","b"]' END AS tags,
  CASE hylak_id % 7 WHEN 1 THEN 12{D} WHEN 2 THEN 12.5{D} END AS depth,
  CASE hylak_id % 11 WHEN 0 THEN '"A1"' WHEN 1 THEN '7' END AS code,
  CASE WHEN hylak_id % 2 = 0 THEN hylak_id % 6 = 0 END AS "natural"
FROM waterbodies"""


def clipped_polygons_sql(ext) -> str:
    w, s, e, n = (f"{x}{D}" for x in (ext.west, ext.south, ext.east, ext.north))
    return f"""WITH {WATERBODIES},
f AS (SELECT hylak_id, greatest(xmin, {w}) AS xmin, least(xmax, {e}) AS xmax,
    greatest(ymin, {s}) AS ymin, least(ymax, {n}) AS ymax
  FROM waterbodies WHERE xmax >= {w} AND xmin <= {e} AND ymax >= {s} AND ymin <= {n})
SELECT hylak_id, xmin, xmax, ymin, ymax, round((xmax - xmin) * (ymax - ymin), 6) AS area
FROM f WHERE xmin < xmax AND ymin < ymax"""


def gauges_in_extent_sql(ext) -> str:
    return f"""WITH {GAUGES}
SELECT grdc_no, station, country, lat, lon, area FROM gauges
WHERE lat BETWEEN {ext.south}{D} AND {ext.north}{D} AND lon BETWEEN {ext.west}{D} AND {ext.east}{D}"""


def model_cell_forcing_sql(p: JobParams = WHOLE_DOMAIN_JOB, lat0=26.0, lon0=85.0, step=0.25,
                           off_grid: bool = False) -> str:
    import datetime as dt
    e = p.extent.buffer(p.climate_buffer)
    end_excl = p.end_date + dt.timedelta(days=1)
    daily_cols = []
    for v, agg in (("precip", "sum"), ("temp", "avg"), ("kin", "avg"), ("kout", "avg"), ("press_msl", "avg")):
        daily_cols.append(f"{agg}(CASE WHEN variable = '{v}' THEN value END) AS {v}")
    pet = _pet_sql("tc", "c.press", "c.kout", "(c.kin * 0.000277778{D})".replace("{D}", D))
    shift_lat = f" + 0.06{D} * (cell % 5 - 2)" if off_grid else ""
    shift_lon = f" + 0.06{D} * (cell % 3 - 1)" if off_grid else ""
    return f"""WITH {hourly_long_sql(p)},
daily AS (SELECT CAST(time AS DATE) AS day, lat, lon, {', '.join(daily_cols)} FROM units GROUP BY 1, 2, 3),
{GEOPOTENTIAL},
gsel AS (SELECT obs_id, time, round_even(TRY_CAST(lat_text AS DOUBLE), 5) AS lat, round_even(lon, 5) AS lon, value
  FROM geo_hourly WHERE lat BETWEEN {e.south}{D} AND {e.north}{D} AND lon BETWEEN {e.west}{D} AND {e.east}{D}
    AND time >= {_ts(p.start_date)} AND time < {_ts(end_excl)} AND TRY_CAST(lat_text AS DOUBLE) IS NOT NULL
    AND value IS NOT NULL AND NOT isnan(value)),
oro AS (SELECT time, lat, lon, arg_max(value / 9.80665{D}, obs_id) AS elevtn FROM gsel GROUP BY time, lat, lon),
zf AS (SELECT lat, lon, avg(elevtn) AS z_forcing FROM oro GROUP BY lat, lon),
coarse AS (SELECT d.*, zf.z_forcing FROM daily d LEFT JOIN zf ON d.lat = zf.lat AND d.lon = zf.lon),
{TERRAIN_LONG},
fine AS (SELECT cell, lat{shift_lat} AS lat, lon{shift_lon} AS lon,
    max(CASE WHEN variable = 'elevtn' AND value <> -9999{D} THEN value END) AS elevtn
  FROM terrain_long GROUP BY cell, lat, lon),
-- the nearest node of the climate grid, looked up among all nodes around the cell
nodes AS (SELECT f.cell, min_by({lat0}{D} + {step}{D} * i.i, abs(f.lat - ({lat0}{D} + {step}{D} * i.i))) AS lat
  FROM fine f, range(-1, 3) o(o), LATERAL (SELECT CAST(floor((f.lat - {lat0}{D}) / {step}{D}) AS BIGINT) + o.o AS i) i GROUP BY f.cell),
nodes2 AS (SELECT f.cell, min_by({lon0}{D} + {step}{D} * i.i, abs(f.lon - ({lon0}{D} + {step}{D} * i.i))) AS lon
  FROM fine f, range(-1, 3) o(o), LATERAL (SELECT CAST(floor((f.lon - {lon0}{D}) / {step}{D}) AS BIGINT) + o.o AS i) i GROUP BY f.cell),
j AS (SELECT f.cell, c.day, f.elevtn, c.z_forcing, c.precip, c.kin, c.kout,
    c.press_msl * pow((288.15{D} - 0.0065{D} * f.elevtn) / 288.15{D}, 9.80665{D} * 0.0289644{D} / (8.3144621{D} * 0.0065{D})) AS press,
    c.temp - 0.0065{D} * (f.elevtn - c.z_forcing) AS tc
  FROM fine f JOIN nodes n ON n.cell = f.cell JOIN nodes2 m ON m.cell = f.cell
  LEFT JOIN coarse c ON c.lat = n.lat AND c.lon = m.lon
  WHERE f.elevtn IS NOT NULL)
SELECT cell, day, round(precip, 6) AS precip, round(tc, 6) AS temp_corr, round(press, 6) AS press_corr,
  round({pet}, 6) AS pet FROM j c"""


def _pet_sql(t: str, p: str, ks: str, kt: str) -> str:
    esat = f"(6.112{D} * exp((17.67{D} * {t}) / ({t} + 243.5{D})))"
    slope = f"({esat} * (17.269{D} / ({t} + 237.3{D})) * (1{D} - {t} / ({t} + 237.3{D})))"
    lam = f"(2.502e6{D} - 2250{D} * {t})"
    gamma = f"((1005{D} * {p}) / (0.622{D} * {lam}))"
    ep = f"(({slope} / ({slope} + {gamma})) * ((0.77{D} * {ks}) - 110{D} * ({ks} / ({kt} + 1e-5{D}))) + 20{D})"
    return f"({ep} / {lam} * 86400{D})"


def waterbodies_near_gauges_sql(half: float) -> str:
    h = f"{half}{D}"
    return f"""WITH {WATERBODIES}, {GAUGES},
a AS (SELECT grdc_no, lon - {h} AS xmin, lat - {h} AS ymin, lon + {h} AS xmax, lat + {h} AS ymax FROM gauges)
SELECT a.grdc_no, w.hylak_id, greatest(w.xmin, a.xmin) AS xmin, least(w.xmax, a.xmax) AS xmax,
  greatest(w.ymin, a.ymin) AS ymin, least(w.ymax, a.ymax) AS ymax
FROM waterbodies w JOIN a ON w.xmax >= a.xmin AND w.xmin <= a.xmax AND w.ymax >= a.ymin AND w.ymin <= a.ymax
WHERE greatest(w.xmin, a.xmin) < least(w.xmax, a.xmax) AND greatest(w.ymin, a.ymin) < least(w.ymax, a.ymax)"""


def glaciers_sql(ext, min_area: float) -> str:
    w, s, e, n = (f"{x}{D}" for x in (ext.west, ext.south, ext.east, ext.north))
    return f"""WITH {WATERBODIES},
f AS (SELECT hylak_id, Vol_total, Lake_area, greatest(xmin, {w}) AS xmin, least(xmax, {e}) AS xmax,
    greatest(ymin, {s}) AS ymin, least(ymax, {n}) AS ymax
  FROM waterbodies WHERE xmax >= {w} AND xmin <= {e} AND ymax >= {s} AND ymin <= {n})
SELECT * FROM f WHERE xmin < xmax AND ymin < ymax AND Lake_area >= {min_area}{D}"""


def forcing_write_check_sql(p: JobParams = WHOLE_DOMAIN_JOB) -> str:
    return f"""WITH q AS ({daily_forcing_sql(p)})
SELECT count(*) AS n_rows, min(CAST(temp AS FLOAT)) AS min_temp, max(CAST(temp AS FLOAT)) AS max_temp,
  min(CAST(precip AS FLOAT)) AS min_precip, max(CAST(precip AS FLOAT)) AS max_precip,
  'day,kin,kout,lat,lon,precip,press_msl,temp' AS columns FROM q"""


def content_digest_sql(sql: str, alias: str) -> str:
    """Digests of a query's columns and rows, whatever its columns: see operators.digest."""
    c = "COLUMNS(*)"
    text = (f"CASE WHEN typeof({c}) IN ('DOUBLE', 'FLOAT') OR typeof({c}) LIKE 'DECIMAL%' "
            f"THEN CAST(round(TRY_CAST({c}::VARCHAR AS DOUBLE) * 1e6{D}) AS HUGEINT)::VARCHAR "
            f"WHEN typeof({c}) = 'TIMESTAMP' THEN epoch_us(TRY_CAST({c}::VARCHAR AS TIMESTAMP))::VARCHAR ELSE {c}::VARCHAR END")

    def h(x: str) -> str:
        return f"('0x' || substr(md5({x}), 1, 15))::BIGINT"
    return f"""SELECT * FROM (
  WITH q_{alias} AS ({sql}), t_{alias} AS (SELECT {text} FROM q_{alias}),
  n_{alias} AS (SELECT row_number() OVER () AS "_r", * FROM t_{alias}),
  v_{alias} AS (FROM n_{alias} UNPIVOT INCLUDE NULLS ("_v" FOR "_c" IN (COLUMNS(* EXCLUDE "_r")))),
  r_{alias} AS (SELECT "_r", {h("coalesce(bit_xor(" + h("_v") + "), 0)::VARCHAR")} AS h FROM v_{alias} GROUP BY "_r")
  SELECT '{alias}' AS output, _c AS "column", count(*) AS n_rows, count(_v) AS n_values,
    sum({h("_v")})::VARCHAR AS hash_sum, bit_xor({h("_v")}) AS hash_xor FROM v_{alias} GROUP BY _c
  UNION ALL
  SELECT '{alias}', '*', count(*), count(h), sum(h)::VARCHAR, bit_xor(h) FROM r_{alias})"""


def model_inputs_summary_sql(outputs: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(content_digest_sql(sql, name) for name, sql in outputs.items())


def static_maps_sql() -> str:
    consts = ", ".join(f"{v}{D} AS {k}" for k, v in ORACLE_CONSTANTS.items())
    soil = ", ".join(f"round(nullif(CAST(s.{v}_sl{n} AS DOUBLE), -32768{D}) * {m}{D}, 6) AS {v}_sl{n}"
                     for v, m in (("bd", 0.001), ("ph", 0.1)) for n in range(1, 8))
    return f"""WITH t AS ({terrain_grid_sql()}), {SOIL_WIDE}
SELECT t.*, {soil}, {consts}
FROM t LEFT JOIN soil_wide s ON t.cell = s.cell"""


def lakes_sql(ext) -> str:
    w, s, e, n = (f"{x}{D}" for x in (ext.west, ext.south, ext.east, ext.north))
    return f"""WITH {WATERBODIES},
f AS (SELECT hylak_id AS waterbody_id, Vol_total, Lake_area, greatest(xmin, {w}) AS xmin, least(xmax, {e}) AS xmax,
    greatest(ymin, {s}) AS ymin, least(ymax, {n}) AS ymax
  FROM waterbodies WHERE xmax >= {w} AND xmin <= {e} AND ymax >= {s} AND ymin <= {n})
SELECT *, round({dam_height_sql_expr()}, 6) AS Dam_height FROM f
WHERE xmin < xmax AND ymin < ymax AND Lake_area >= 0{D}"""


def _triangle_clip_cte(ext, source: str, keys: str) -> str:
    """Right triangles (xmin, ymin), (xmax, ymin), (xmin, ymax) cut by a rectangle, in closed form.

    Below the hypotenuse y <= ymax - (x - xmin) (equal legs), the part inside the box is the
    box clipped to the triangle's own box, minus the corner triangle beyond the hypotenuse.
    """
    w, s, e, n = (f"{x}{D}" for x in (ext.west, ext.south, ext.east, ext.north))
    return f"""b AS (SELECT *, xmin AS ox, ymin AS oy, xmax - xmin AS leg, greatest(xmin, {w}) AS x0, least(xmax, {e}) AS x1,
    greatest(ymin, {s}) AS y0, least(ymax, {n}) AS y1 FROM {source}),
-- the hypotenuse is (x - ox) + (y - oy) = leg; room is what is left of it at the lower left corner
c AS (SELECT *, leg - (x0 - ox) - (y0 - oy) AS room, x1 - x0 AS dx, y1 - y0 AS dy FROM b
  WHERE x0 < x1 AND y0 < y1 AND leg - (x0 - ox) - (y0 - oy) > 0),
clipped AS (SELECT {keys},
    pow(room, 2) / 2 - pow(greatest(room - dx, 0{D}), 2) / 2 - pow(greatest(room - dy, 0{D}), 2) / 2
      + pow(greatest(room - dx - dy, 0{D}), 2) / 2 AS area,
    x0 AS cx0, x0 + least(dx, room) AS cx1, y0 AS cy0, y0 + least(dy, room) AS cy1 FROM c)"""


def reservoir_polygons_sql(ext) -> str:
    return f"""WITH {WATERBODIES}, {_triangle_clip_cte(ext, "waterbodies", "hylak_id, Vol_total, Lake_area")}
SELECT CAST(row_number() OVER (ORDER BY hylak_id) - 1 AS BIGINT) AS waterbody_id, Vol_total, Lake_area, round(area, 6) AS area,
  round(cx0, 6) AS xmin, round(cx1, 6) AS xmax, round(cy0, 6) AS ymin, round(cy1, 6) AS ymax,
  round({dam_height_sql_expr()}, 6) AS Dam_height, true AS has_ring
FROM clipped WHERE area > 0"""


BASINS = f"""basins AS (
  SELECT c_custkey AS key, 85{D} + 0.5{D} * (c_custkey % 30) AS xmin, 87{D} + 0.5{D} * (c_custkey % 30) AS xmax,
    26{D} + 0.5{D} * (floor(c_custkey / 30) % 20) AS ymin, 28{D} + 0.5{D} * (floor(c_custkey / 30) % 20) AS ymax
  FROM customer)"""


def basins_sql(ext) -> str:
    return f"""WITH {BASINS}, {_triangle_clip_cte(ext, "basins", "key")}
SELECT key AS basid, round(area, 6) AS area, round(cx0, 6) AS xmin, round(cx1, 6) AS xmax, round(cy0, 6) AS ymin,
  round(cy1, 6) AS ymax FROM clipped WHERE area > 0"""


def basin_positions_sql(ext) -> str:
    return f"""WITH {BASINS}, {_triangle_clip_cte(ext, "basins", "key")}
SELECT CAST(row_number() OVER (ORDER BY key) AS BIGINT) AS basid, key, round(area, 6) AS area FROM clipped WHERE area > 0"""


def river_lines_clipped_sql(ext, min_uparea: float = 30.0) -> str:
    W, S, E, N = (f"{float(v)!r}{D}" for v in (ext.west, ext.south, ext.east, ext.north))
    pq = [("(-dx)", f"(x0 - {W})"), ("dx", f"({E} - x0)"), ("(-dy)", f"(y0 - {S})"), ("dy", f"({N} - y0)")]
    enter = ", ".join(f"CASE WHEN {p} < 0 THEN {q} / {p} ELSE 0{D} END" for p, q in pq)
    leave = ", ".join(f"CASE WHEN {p} > 0 THEN {q} / {p} ELSE 1{D} END" for p, q in pq)
    outside = " OR ".join(f"({p} = 0 AND {q} < 0)" for p, q in pq)
    return f"""WITH {FLOW_CELLS},
seg AS (SELECT r.cell, CAST(r.x AS DOUBLE) AS x0, CAST(r.y AS DOUBLE) AS y0,
    CAST(n.x AS DOUBLE) - CAST(r.x AS DOUBLE) AS dx, CAST(n.y AS DOUBLE) - CAST(r.y AS DOUBLE) AS dy
  FROM flow_cells r JOIN flow_cells n ON n.cell = r.next_cell WHERE r.uparea >= {min_uparea}{D}),
t AS (SELECT *, CASE WHEN {outside} THEN 1{D} ELSE greatest(0{D}, {enter}) END AS t0,
    CASE WHEN {outside} THEN 0{D} ELSE least(1{D}, {leave}) END AS t1 FROM seg),
c AS (SELECT cell, x0 + t0 * dx AS px, y0 + t0 * dy AS py, x0 + t1 * dx AS qx, y0 + t1 * dy AS qy FROM t WHERE t0 < t1)
SELECT cell, round(sqrt(pow(qx - px, 2) + pow(qy - py, 2)), 6) AS length,
  least(px, qx) AS xmin, greatest(px, qx) AS xmax, least(py, qy) AS ymin, greatest(py, qy) AS ymax FROM c"""


def day_tally_sql(p: JobParams = WHOLE_DOMAIN_JOB) -> str:
    return f"""WITH g AS ({day_gaps_sql(p)})
SELECT count(*) AS n_days, count(*) FILTER (WHERE status = 'ok') AS n_ok,
  count(*) FILTER (WHERE status = 'missing') AS n_missing,
  coalesce(string_agg(strftime(day, '%Y-%m-%d'), ',' ORDER BY day) FILTER (WHERE status = 'missing'), '') AS missing_days
FROM g"""


def climate_coordinates_sql(p: JobParams = WHOLE_DOMAIN_JOB) -> str:
    return f"""WITH {climate_rows_sql(p)}
SELECT DISTINCT lat, lon FROM rows"""


def lai_grid_cube_sql(ext, metres: float = 500.0) -> str:
    # F13 written out: int(span / (500 m in degrees)) nodes per axis, both ends in.
    deg = metres / 111000.0
    w, h = int((ext.east - ext.west) / deg), int((ext.north - ext.south) / deg)
    dlat, dlon = (ext.north - ext.south) / (h - 1), (ext.east - ext.west) / (w - 1)
    N, W = f"{float(ext.north)!r}{D}", f"{float(ext.west)!r}{D}"
    dla, dlo = f"{dlat!r}{D}", f"{dlon!r}{D}"
    return f"""WITH {_lai_slots_cte()},
px AS (SELECT image_time, obs_id, raw_lai,
    {N} - CAST(floor(cell / 5) AS DOUBLE) * {dla} AS lat, {W} + CAST(cell % 5 AS DOUBLE) * {dlo} AS lon
  FROM lai_images),
snapped AS (SELECT s.slot, CAST(round(({N} - p.lat) / {dla}) AS BIGINT) AS r, CAST(round((p.lon - {W}) / {dlo}) AS BIGINT) AS c,
    p.obs_id, p.raw_lai FROM px p JOIN slots s ON p.image_time = s.time),
vals AS (SELECT slot, r, c, arg_max(raw_lai, obs_id) AS raw FROM snapped
  WHERE r BETWEEN 0 AND {h - 1} AND c BETWEEN 0 AND {w - 1} GROUP BY slot, r, c),
dense AS (SELECT CAST(i // {h * w} AS INTEGER) AS slot, (i % {h * w}) // {w} AS r, i % {w} AS c FROM range(0, {12 * h * w}) t(i))
SELECT d.slot, a.time, CAST({N} - CAST(d.r AS DOUBLE) * {dla} AS FLOAT) AS lat,
  CAST({W} + CAST(d.c AS DOUBLE) * {dlo} AS FLOAT) AS lon,
  CAST(CASE WHEN v.raw * 0.1{D} BETWEEN 0{D} AND 10{D} THEN v.raw * 0.1{D} END AS FLOAT) AS Lai
FROM dense d JOIN all_slots a ON a.slot = d.slot
LEFT JOIN vals v ON v.slot = d.slot AND v.r = d.r AND v.c = d.c"""


LANDUSE_LONG = f"""landuse_long AS (
  SELECT p_partkey AS cell, 26{D} + 0.25{D} * floor(p_partkey / 50) AS lat, 85{D} + 0.25{D} * (p_partkey % 50) AS lon, variable,
    CASE variable WHEN 'globcover' THEN CASE WHEN p_partkey % 13 = 0 THEN 0{D} ELSE (p_size % 23 + 1) * 10{D} END
      WHEN 'chelsa' THEN CASE WHEN p_partkey % 17 = 0 THEN -32767{D} ELSE floor(p_retailprice) * 1{D} END
      ELSE CASE WHEN p_partkey % 19 = 0 THEN 32{D} WHEN p_partkey % 23 = 0 THEN 0{D} ELSE (p_size % 30 + 1) * 1{D} END END AS value
  FROM part CROSS JOIN (VALUES ('globcover'), ('chelsa'), ('koppen_geiger')) v(variable))"""


def landuse_grid_sql() -> str:
    return f"""WITH {LANDUSE_LONG},
m AS (SELECT cell, lat, lon, variable,
    CASE WHEN (variable = 'globcover' AND value = 0{D}) OR (variable = 'chelsa' AND value = -32767{D})
      OR (variable = 'koppen_geiger' AND value = 0{D}) THEN NULL ELSE value END AS value FROM landuse_long)
SELECT cell, max(lat) AS lat, max(lon) AS lon,
  CAST(max(CASE WHEN variable = 'globcover' THEN value END) AS INTEGER) AS globcover,
  max(CASE WHEN variable = 'chelsa' THEN value END) AS chelsa,
  CAST(max(CASE WHEN variable = 'koppen_geiger' THEN value END) AS INTEGER) AS koppen_geiger
FROM m GROUP BY cell"""


def soil_grid_sql() -> str:
    mult = {"bd": 0.001, "ph": 0.1}
    cols = ", ".join(f"round(nullif(CAST({v}_sl{n} AS DOUBLE), -32768{D}) * {mult[v]}{D}, 6) AS {v}_sl{n}"
                     for v in ("bd", "ph") for n in range(1, 8))
    return f"WITH {SOIL_WIDE}\nSELECT cell, lat, lon, {cols} FROM soil_wide"


def daily_forcing_catalog_sql(p: JobParams = WHOLE_DOMAIN_JOB) -> str:
    own = f"""rules AS (
  SELECT * FROM (VALUES ('precip', 500::DOUBLE, NULL::DOUBLE), ('kout', 0.5::DOUBLE, NULL),
    ('temp', NULL, -200::DOUBLE)) r(variable, mult, "add"))"""
    sql = daily_forcing_sql(p).replace(CATALOG_ERA5, own)
    return sql.replace("CAST(time AS DATE) AS day", "CAST(time AS DATE) + 1 AS day").replace(
        "GROUP BY CAST(time AS DATE)", "GROUP BY CAST(time AS DATE) + 1")


def daily_forcing_shifted_sql(p: JobParams = WHOLE_DOMAIN_JOB) -> str:
    return daily_forcing_catalog_sql(p).replace("CAST(time AS DATE) + 1", "CAST(time - INTERVAL 1 HOUR AS DATE)")


def waterbodies_renamed_sql() -> str:
    return f"WITH {WATERBODIES}\nSELECT hylak_id, Vol_total AS volume, Lake_area AS surface FROM waterbodies"


def observations_on_axes_sql() -> str:
    return f"""WITH {OBS_HOURLY}, {DISCHARGE}
SELECT obs_id, time, lat, lon FROM obs_hourly
WHERE lat IN (SELECT lat FROM discharge) AND lon IN (SELECT lon FROM discharge)"""


def image_time_list_sql() -> str:
    return f"""WITH {LAI_IMAGES}, d AS (SELECT DISTINCT image_time AS t FROM lai_images)
SELECT count(*) AS n_images, string_agg(strftime(t, '%Y-%m-%d'), ',' ORDER BY t) AS times FROM d"""


def variable_metadata_sql(p: JobParams = WHOLE_DOMAIN_JOB) -> str:
    # Units and descriptions as the reference names them.
    rows = [("precip", "m", "Total precipitation"), ("temp", "K", "Temperature at 2m"),
            ("kin", "W/m²", "TOA incident solar radiation"),
            ("kout", "W/m²", "Mean surface direct short wave radiation flux"), ("press_msl", "Pa", "Mean sea level pressure")]
    values = ", ".join(f"('{v}', '{u}', '{n}')" for v, u, n in rows)
    return f"""WITH {hourly_long_sql(p)}
SELECT m.variable, m.units, m.long_name, count(u.value) AS n_values
FROM (VALUES {values}) m(variable, units, long_name) LEFT JOIN units u ON u.variable = m.variable GROUP BY 1, 2, 3"""


def observation_times_sql() -> str:
    return """SELECT event_id, CAST(date_trunc('millisecond', ts) AS TIMESTAMP) AS time, CAST(ts AS DATE) AS day,
  CAST(date_trunc('second', ts) AS TIMESTAMP) AS second FROM events"""


def static_and_forcing_sql() -> str:
    tagged = f"""WITH {DISCHARGE},
b AS (SELECT CAST(min(time) AS DATE) AS s FROM discharge),
t AS (SELECT d.*, CAST(floor(((year(d.time) - year(b.s)) * 12 + month(d.time) - month(b.s)) / 3) AS INTEGER) AS chunk_id
  FROM discharge d, b)
"""
    first = tagged + "SELECT DISTINCT chunk_id, lat, lon FROM t WHERE chunk_id = (SELECT min(chunk_id) FROM t)"
    return content_digest_sql(first, "static") + " UNION ALL " + content_digest_sql(tagged + "SELECT * FROM t", "forcing")


def river_dimensions_sql() -> str:
    return f"""WITH {FLOW_CELLS}
SELECT cell, greatest(strord * 8{D}, 30{D}) AS rivwth, greatest(strord * 0.25{D}, 1{D}) AS rivdph FROM flow_cells"""


def landcover_parameters_sql() -> str:
    return f"""WITH g AS ({landuse_grid_sql()})
SELECT cell, globcover AS landcover, CASE WHEN globcover BETWEEN 10 AND 230 THEN (globcover // 10) * 0.01{D} END AS N,
  CASE WHEN globcover BETWEEN 10 AND 230 THEN (globcover // 10) * 0.5{D} END AS RootingDepth FROM g"""


def empty_export_sql() -> str:
    # The FROM keeps the query on the table: no feature of it meets the extent.
    return f"""WITH {WATERBODIES}
SELECT count(*) FILTER (WHERE xmax >= -20{D} AND xmin <= -10{D}) AS n_rows,
  'Dam_height,Lake_area,Vol_total,waterbody_id,xmax,xmin,ymax,ymin' AS columns FROM waterbodies"""


def raster_files_sql() -> str:
    return f"WITH {TERRAIN_LONG}\nSELECT cell, variable, value FROM terrain_long"


def dam_height_inputs_sql() -> str:
    aggs = ", ".join(f"round({f}({c}), 6) AS {k}_{n}" for n, c in (("volume", "Vol_total"), ("area", "Lake_area"))
                     for k, f in (("min", "min"), ("max", "max"), ("mean", "avg"), ("median", "median")))
    return f"""WITH {WATERBODIES}
SELECT count(*) AS n_valid, {aggs} FROM waterbodies WHERE Vol_total > 0 AND Lake_area > 0"""
