"""Reading discharge results at an outlet.

The cube is long ``(time, lat, lon, value)``. The nearest cell is found per axis with one
partial aggregate (``min_by`` over distances, ties to the first = smallest coordinate of the
sorted axis), and the series is one ``groupBy(time)`` keeping the chosen cell's value: two
passes over the result rows in all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydroframe.functions.scalar import nan_to_null
from hydroframe.operators.waterbody import first_existing

# FIXED VALUES: discharge variable names tried in order.
DISCHARGE_CANDIDATES = ["Q", "q", "discharge", "q_river", "river_discharge", "runoff"]


def discharge_variable(df: DataFrame) -> str | None:
    """the first known discharge column of a result table."""
    return first_existing(df, DISCHARGE_CANDIDATES)


def result_cube(df: DataFrame, value_col: str | None = None) -> DataFrame:
    """One value per ``(time, lat, lon)``; repeated keys keep the largest value.
    NaN counts as missing (Spark orders NaN above every number, the series statistics
    must ignore it like a missing step)."""
    v = value_col or discharge_variable(df)
    return df.groupBy("time", "lat", "lon").agg(F.max(nan_to_null(F.col(v).cast("double"))).alias("discharge"))


def nearest_cell(df: DataFrame, lon: float, lat: float) -> tuple[float, float]:
    """Nearest ``(lat, lon)``, each axis chosen separately, ties to the smaller value
    (the first index of the ascending axis). One partial aggregate over the rows gives
    both (``min_by`` over all rows equals ``min_by`` over the distinct axis values)."""
    la, lo = F.col("lat"), F.col("lon")
    r = df.agg(F.min_by(la, F.struct(F.abs(la - F.lit(lat)), la)).alias("lat"),
               F.min_by(lo, F.struct(F.abs(lo - F.lit(lon)), lo)).alias("lon")).first()
    return r["lat"], r["lon"]


def outlet_series(df: DataFrame, lon: float, lat: float, value_col: str = "discharge") -> DataFrame:
    """E4 + F10 (+ A20): the whole time axis with the value at the chosen cell (missing steps
    NULL) and the cell's coordinates as constant columns.

    Works on the cube or directly on raw result rows: one ``groupBy(time)`` whose value is
    the max over the chosen cell's rows (repeated keys keep the largest, NaN is missing),
    so every time of the table appears and only one pass over the rows is needed, with a
    partial aggregate before the exchange.
    """
    cell_lat, cell_lon = nearest_cell(df, lon, lat)
    at = (F.col("lat") == F.lit(cell_lat)) & (F.col("lon") == F.lit(cell_lon))
    v = nan_to_null(F.col(value_col).cast("double"))
    return (df.groupBy("time").agg(F.max(F.when(at, v)).alias("discharge"))
              .select("time", "discharge",
                      F.lit(cell_lon).cast("double").alias("longitude"),
                      F.lit(cell_lat).cast("double").alias("latitude")))


def series_stats(series: DataFrame, value: str = "discharge") -> DataFrame:
    """Missing-ignoring mean, max, min (and counts) of the series."""
    return series.agg(F.round(F.avg(value), 6).alias("mean_q"), F.max(value).alias("max_q"),
                      F.min(value).alias("min_q"), F.count(value).alias("n_valid"),
                      F.count("*").alias("n_steps"))
