"""Hourly climate -> daily forcing.

Long form ``(time, lat, lon, variable, value)`` is the working form. Every step is a column
expression or a grouped aggregate with partial (map-side) aggregation, so a hot cell or a
burst of duplicate rows is collapsed before the shuffle, and the dense cube is only built
when asked for (``densify``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydroframe.functions.geometry import point_in_extent
from hydroframe.functions.scalar import is_present, round_half_even, to_number
from hydroframe.functions.units import apply_rules_join
from hydroframe.params import Extent, JobParams
from hydroframe.session import ensure_checkpoint_dir, stored
from hydroframe.sources.catalog import (CLIMATE_BANDS, CLIMATE_UNITS, CLIMATE_VARIABLES,
                                        GRAVITY, catalog_rules, rules_for, time_shift_seconds)

CELL_KEYS = ["lat", "lon"]
AXIS_BROADCAST_MAX_ROWS = 2_000_000  # an axis of (value, position) pairs: ~32 MB at most
CUBE_KEYS = ["time", "lat", "lon"]


def ts_literal(d: dt.date | dt.datetime) -> Column:
    """A naive timestamp literal (inputs are timestamp_ntz; no session-zone shift)."""
    if isinstance(d, dt.datetime):
        text = d.strftime("%Y-%m-%d %H:%M:%S")
    else:
        text = d.isoformat() + " 00:00:00"
    return F.lit(text).cast("timestamp_ntz")


def climate_period(start: dt.date, end: dt.date, time_col: str = "time") -> Column:
    """C4 / Q1: ``[start, end + 1 day)``: the end day is included, every day half-open."""
    t = F.col(time_col)
    return (t >= ts_literal(start)) & (t < ts_literal(end + dt.timedelta(days=1)))


def select_region_period(df: DataFrame, ext: Extent, start: dt.date, end: dt.date) -> DataFrame:
    """The server-side part of a fetch: rows of the region and the day range.

    Both predicates are on raw scan columns, so the box reaches the parquet reader as pushed
    filters. On a table partitioned by ``day`` (the date of ``time``) the same period is also
    stated on ``day``: Spark does not derive a partition filter from a ``time`` predicate,
    and with it only the partitions of the period are listed and read.
    """
    cond = point_in_extent(ext, "lat", "lon") & climate_period(start, end)
    if "day" in df.columns:
        cond = cond & F.col("day").between(F.lit(start), F.lit(end))
    return df.filter(cond)


def clean_coordinates(df: DataFrame, lat_text: str = "lat_text", lon: str = "lon",
                      places: int = 5) -> DataFrame:
    """I1 + C6 + I2: text coordinates -> numbers, unreadable rows dropped, half-even round."""
    if lat_text not in df.columns:   # no text form of the latitude: use the numeric column
        lat_text = "lat"
    types = dict(df.dtypes)
    # Text coordinates are coerced (bad text -> NULL); numeric ones only widened.
    lat_v = to_number(lat_text) if types.get(lat_text) == "string" else F.col(lat_text).cast("double")
    lon_v = to_number(lon) if types.get(lon) == "string" else F.col(lon).cast("double")
    return (df.withColumn("lat", round_half_even(lat_v, places))
              .withColumn("lon", round_half_even(lon_v, places))
              .filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
              .drop(*([lat_text] if lat_text != "lat" else [])))


def bands_to_variables(df: DataFrame, bands: dict[str, str] = CLIMATE_BANDS,
                       band_col: str = "band") -> DataFrame:
    """F1 on long rows: keep the requested bands (F3) and rename them to model variables."""
    mapping = F.create_map(*[F.lit(x) for kv in bands.items() for x in kv])
    return (df.filter(F.col(band_col).isin(list(bands)))
              .withColumn("variable", mapping[F.col(band_col)])
              .drop(band_col))


def melt_bands(wide: DataFrame, id_cols: list[str], bands: dict[str, str] = CLIMATE_BANDS) -> DataFrame:
    """F1 on wide rows (one column per band): ``unpivot`` to ``(…, variable, value)``."""
    present = [b for b in bands if b in wide.columns]
    renamed = wide.select(*id_cols, *[F.col(b).cast("double").alias(bands[b]) for b in present])
    return renamed.unpivot(id_cols, [bands[b] for b in present], "variable", "value")


def drop_missing_values(df: DataFrame, value: str = "value") -> DataFrame:
    """Drop NULL and NaN values."""
    return df.filter(is_present(value))


def resolve_duplicates(df: DataFrame, keys: list[str], value: str = "value",
                       order: str = "obs_id") -> DataFrame:
    """One value per key, the one with the largest ``order`` (deterministic).

    ``max_by`` has a partial aggregate, so duplicates are merged map-side before the
    shuffle; a key holding a third of the rows costs one buffer row per map task.
    """
    return df.groupBy(*keys).agg(F.max_by(F.col(value), F.col(order)).alias(value))


def apply_catalog_units(spark: SparkSession, df: DataFrame, source: str,
                        rules: DataFrame | None = None) -> DataFrame:
    """E9 + I5: catalog unit rules of ``source`` on the long table (broadcast of the catalog);
    ``rules`` is a user's own rule table (A17)."""
    if rules is not None:
        return apply_rules_join(df, rules, source)
    wide_nodata = rules_for(source).get("*", {}).get("nodata")
    return apply_rules_join(df, catalog_rules(spark, source), source, default_nodata=wide_nodata)


def job_rows(obs: DataFrame, params: JobParams) -> DataFrame:
    """A12 + A14 + F1 + C7: the job's hourly rows as ``(…, variable, value)`` with usable
    values. Accepts long rows (``band``, ``value``) or wide rows (one column per band, as
    the hourly service returns them), melted here."""
    ext = params.extent.buffer(params.climate_buffer)
    rows = (obs.transform(lambda d: select_region_period(d, ext, params.start_date, params.end_date))
               .transform(clean_coordinates))
    if "band" in rows.columns:
        rows = bands_to_variables(rows)
    else:
        rows = melt_bands(rows, [c for c in ("obs_id", "time", "lat", "lon") if c in rows.columns])
    return drop_missing_values(rows)


def hourly_long(spark: SparkSession, obs: DataFrame, params: JobParams,
                source: str = "era5", rules: DataFrame | None = None) -> DataFrame:
    """A12+A14: hourly long table of the job: region/period, clean, melt, dedupe, units."""
    rows = job_rows(obs, params)
    deduped = resolve_duplicates(rows, ["time", "lat", "lon", "variable"])
    return apply_catalog_units(spark, deduped, source, rules)


# Daily aggregation rule per variable (L5): precipitation is summed, the rest averaged.
DAILY_AGG = {"precip": "sum", "temp": "avg", "kin": "avg", "kout": "avg", "press_msl": "avg"}


def to_daily(long_df: DataFrame, variables: list[str] = CLIMATE_VARIABLES,
             shift_days: int = 0, round_places: int | None = 6, shift_seconds: float = 0.0) -> DataFrame:
    """L5 + F2: hourly long rows -> one daily row per cell, one column per variable.

    Conditional aggregation is what ``pivot`` with a fixed value list compiles to; writing
    it out lets each variable carry its own rule (sum vs mean) in a single aggregate.
    ``shift_days`` and ``shift_seconds`` are the catalog's ``unit_add.time`` option (Q10), off
    by default: times are shifted first, and then fall into days.
    """
    time = F.col("time")
    if shift_days or shift_seconds:
        time = time + F.make_dt_interval(days=F.lit(shift_days), secs=F.lit(shift_seconds).cast("decimal(18,6)"))
    day = F.to_date(time)
    aggs = []
    for v in variables:
        val = F.when(F.col("variable") == v, F.col("value"))
        a = F.sum(val) if DAILY_AGG.get(v, "avg") == "sum" else F.avg(val)
        if round_places is not None:
            a = F.round(a, round_places)
        unit, desc = CLIMATE_UNITS.get(v, ("unknown", v))
        aggs.append(a.alias(v, metadata={"long_name": desc, "source_units": unit}))
    return (long_df.withColumn("day", day)
                   .groupBy("day", *CELL_KEYS)
                   .agg(*aggs))


def daily_forcing(spark: SparkSession, obs: DataFrame, params: JobParams,
                  source: str = "era5", shift_days: int = 0, rules: DataFrame | None = None) -> DataFrame:
    """Flagship: daily precipitation/temperature/radiation/pressure per cell. A user's
    ``rules`` bring their own units and time shift (Q10)."""
    seconds = 0.0 if rules is None else time_shift_seconds(rules, source)
    return to_daily(hourly_long(spark, obs, params, source, rules), shift_days=shift_days, shift_seconds=seconds)


def long_to_wide(long_df: DataFrame, keys: list[str], variables: list[str],
                 value: str = "value") -> DataFrame:
    """one column per variable; the value list is given, so no extra distinct job."""
    return long_df.groupBy(*keys).pivot("variable", variables).agg(F.first(value))


def pivot_latest(rows: DataFrame, keys: list[str], variables: list[str], value: str = "value",
                 order: str = "obs_id") -> DataFrame:
    """D12 + F2 in one aggregate: per key, one column per variable holding the value of the
    row with the largest ``order`` among that variable's rows. ``max_by`` skips rows whose
    ordering is NULL, so each column only sees its own variable; one partial-aggregated
    exchange instead of a dedupe exchange followed by a pivot exchange. Rows must already
    have usable values (C7), as a NULL value with the top ordering would win.
    """
    var = F.col("variable")
    return rows.groupBy(*keys).agg(*[
        F.max_by(F.col(value), F.when(var == v, F.col(order))).alias(v) for v in variables])


def hourly_wide(spark: SparkSession, obs: DataFrame, params: JobParams,
                source: str = "era5", variables: list[str] = CLIMATE_VARIABLES) -> DataFrame:
    """A12 + F1 + C7 + E9/I5 + D12 + F2: hourly rows of the job as one column per variable."""
    converted = apply_catalog_units(spark, job_rows(obs, params), source)
    return pivot_latest(converted, CUBE_KEYS, variables)


def with_variable_metadata(wide: DataFrame, units: dict = CLIMATE_UNITS) -> DataFrame:
    """units and description per variable as column metadata."""
    return wide.select(*[
        F.col(c).alias(c, metadata={"units": units[c][0], "long_name": units[c][1]})
        if c in units else F.col(c) for c in wide.columns])


def orography_hourly(geo: DataFrame, params: JobParams) -> DataFrame:
    """A13 + I3: hourly geopotential -> elevation ``elevtn = phi / g`` per (time, lat, lon).

    Only rows with a value count (Q3), duplicates resolved as in D12.
    """
    ext = params.extent.buffer(params.climate_buffer)
    rows = (geo.transform(lambda d: select_region_period(d, ext, params.start_date, params.end_date))
               .transform(clean_coordinates))
    # long rows (band, value) or wide rows with a ``geopotential`` column
    rows = (rows.filter(F.col("band") == "geopotential") if "band" in rows.columns
            else rows.withColumn("value", F.col("geopotential").cast("double")))
    rows = (rows.transform(drop_missing_values)
               .withColumn("value", F.col("value") / F.lit(GRAVITY)))
    return resolve_duplicates(rows, CUBE_KEYS).withColumnRenamed("value", "elevtn")


_BITMAP_BITS = 15  # positions of one bitmap of Spark's bitmap functions: 32,768


def cube_shape(long_df: DataFrame) -> DataFrame:
    """D13 (+D2): per-axis counts, dense size, observed cells and points.

    Points are counted without moving them. The axes are small tables; a row's positions on
    them make one number, its place in the dense cube, and every task sets bits of bitmaps of
    32,768 places, which are merged by ``or`` and counted. What is shuffled are the bitmaps, at
    most a bit per place of the dense cube and task, however often a point repeats. Rows with a
    missing coordinate are no points.
    """
    axes = stored(axis_table(long_df), "axes")
    size = axes.agg(*[F.count(a).alias(f"n_{a}") for a in CUBE_KEYS], F.min("time").alias("first_time"),
                    F.max("time").alias("last_time"))
    n = size.first()
    rows = long_df.select(*CUBE_KEYS)
    for a in CUBE_KEYS:
        rows = rows.join(_indexed_axis(axes.filter((F.col("axis") == a) & F.col(a).isNotNull()).select(a), a), a)
    cell = F.col("lat_i") * F.lit(n["n_lon"]).cast("bigint") + F.col("lon_i")
    point = F.col("time_i") * F.lit(n["n_lat"] * n["n_lon"]).cast("bigint") + cell
    places = rows.select(F.explode(F.array(F.struct(F.lit("cells").alias("kind"), cell.alias("at")),
                                           F.struct(F.lit("points").alias("kind"), point.alias("at")))).alias("p")).select("p.*")
    maps = (places.groupBy("kind", F.shiftright("at", _BITMAP_BITS).alias("part"))
            .agg(F.bitmap_construct_agg(F.col("at").bitwiseAND((1 << _BITMAP_BITS) - 1)).alias("map")))
    found = maps.agg(*[F.coalesce(F.sum(F.when(F.col("kind") == k, F.bitmap_count("map"))), F.lit(0)).alias(f"n_{k}_observed")
                       for k in ("cells", "points")])
    return found.select(*[F.lit(n[f"n_{a}"]).cast("bigint").alias(f"n_{a}") for a in CUBE_KEYS], "n_cells_observed", "n_points_observed",
                        F.lit(n["first_time"]).cast(size.schema["first_time"].dataType).alias("first_time"),
                        F.lit(n["last_time"]).cast(size.schema["last_time"].dataType).alias("last_time"),
                        F.lit(n["n_time"] * n["n_lat"] * n["n_lon"]).cast("bigint").alias("n_points_dense"))


def _indexed_axis(axis: DataFrame, name: str) -> DataFrame:
    """Axis values with their 0-based position. Axes are small (bounded by the grid
    resolution and the period), so a single ordered window is fine here."""
    from pyspark.sql.window import Window
    return axis.select(name, (F.row_number().over(Window.orderBy(name)) - 1).alias(f"{name}_i"))


def axis_table(axes_source: DataFrame, axes: tuple[str, ...] = ("time", "lat", "lon")) -> DataFrame:
    """D3/D4 in one pass: the distinct values of every axis as ``(axis, <one column per
    axis>)`` rows, from a single scan and a single exchange (partial distinct map-side).
    Its size is bounded by the grid and the period, not by the number of observations."""
    types = dict(axes_source.dtypes)
    fields = [F.struct(F.lit(a).alias("axis"),
                       *[(F.col(b) if b == a else F.lit(None).cast(types[b])).alias(b) for b in axes])
              for a in axes]
    return axes_source.select(F.explode(F.array(*fields)).alias("_a")).select("_a.*").distinct()


def densify(axes_source: DataFrame, values: DataFrame | None = None,
            value_cols: list[str] = (), partitions: int | None = None) -> DataFrame:
    """Scatter observed values into the dense ``time x lat x lon`` cube.

    The axes are the distinct observed times, lats and lons of ``axes_source`` (Q3/Q4),
    taken in one pass over the source and checkpointed (a small table). The dense index
    space is generated by ``spark.range`` (split over tasks, no single task holds it) and
    decomposed into axis positions; the axes, whose counts are then known, are broadcast
    when small and equi-joined on position, and the values (one row per
    ``(time, lat, lon)``) are attached by a left equi-join. Never-observed points are NULL.
    """
    spark = axes_source.sparkSession
    ensure_checkpoint_dir(spark)
    axes = axis_table(axes_source).checkpoint(eager=True)
    counts = {r["axis"]: r["n"] for r in axes.groupBy("axis").agg(F.count("*").alias("n")).collect()}
    n_t, n_la, n_lo = (counts.get(a, 0) for a in ("time", "lat", "lon"))

    def indexed(name: str, n: int) -> DataFrame:
        a = _indexed_axis(axes.filter(F.col("axis") == name).select(name), name)
        # The count is known, so the broadcast of each axis is a checked decision.
        return F.broadcast(a) if n <= AXIS_BROADCAST_MAX_ROWS else a

    t, la, lo = indexed("time", n_t), indexed("lat", n_la), indexed("lon", n_lo)
    total = n_t * n_la * n_lo
    idx = spark.range(0, total, numPartitions=partitions) if partitions else spark.range(0, total)
    per_time = n_la * n_lo
    grid = (idx.select((F.col("id") / F.lit(per_time)).cast("bigint").alias("time_i"),
                       ((F.col("id") % F.lit(per_time)) / F.lit(max(n_lo, 1))).cast("bigint").alias("lat_i"),
                       (F.col("id") % F.lit(max(n_lo, 1))).alias("lon_i"))
                .join(t, "time_i").join(la, "lat_i").join(lo, "lon_i")
                .select("time", "lat", "lon"))
    if values is None:
        return grid
    return grid.join(values.select(*CUBE_KEYS, *value_cols), CUBE_KEYS, "left")


def day_gaps(long_df: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Calendar of the period with the row count of each day; absent days have
    ``n_rows = 0`` and ``status = 'missing'`` (reported, never silent)."""
    spark = long_df.sparkSession
    cal = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))).alias("day"))
    day = F.to_date("time")
    per_day = (long_df.filter(day.between(F.lit(start), F.lit(end)))
                      .groupBy(day.alias("day")).agg(F.count("*").alias("n_rows")))
    # At most one row per day of the period: a proven bound for the broadcast.
    return (cal.join(F.broadcast(per_day), "day", "left")
               .select("day", F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
                       F.when(F.col("n_rows").isNull(), "missing").otherwise("ok").alias("status")))


def day_tally(gaps: DataFrame) -> DataFrame:
    """The success/failure tally of a period and the absent days as one sorted
    ``YYYY-MM-DD,…`` string (bounded by the number of days in the period)."""
    missing = F.col("status") == "missing"
    return gaps.agg(F.count("*").alias("n_days"),
                    F.count_if(~missing).alias("n_ok"),
                    F.count_if(missing).alias("n_missing"),
                    F.concat_ws(",", F.array_sort(F.collect_list(
                        F.when(missing, F.date_format("day", "yyyy-MM-dd"))))).alias("missing_days"))


def observed_coordinates(rows: DataFrame) -> DataFrame:
    """J1 + J3 + D2: the coordinate pairs of all days, concatenated and de-duplicated (one
    partial-aggregated exchange; every row of a coordinate counts, with or without value)."""
    return rows.select("lat", "lon").dropDuplicates(["lat", "lon"])
