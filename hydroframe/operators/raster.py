"""Static rasters and the soil family.

Rasters are long tables ``(cell, lat, lon, variable, value)``. Putting variables side by side
is one conditional aggregation keyed by the cell (one shuffle), not one join per variable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydroframe.functions.scalar import member_name
from hydroframe.params import Extent
from hydroframe.sources.catalog import (SOIL_DEPTH_VARIABLES, SOIL_DEPTHS, SOIL_FLAT_VARIABLES,
                                        SOIL_MULT, SOIL_NODATA, rules_for)

GRID_KEYS = ["cell", "lat", "lon"]
TERRAIN_INT_VARS = ("strord", "flwdir")
# Degrees per 500 m cell used by the LAI grid (F13): 500 / 111000.
DEG_PER_500M = 500.0 / 111000.0


def nodata_map(source: str) -> dict[str, float]:
    """Nodata code per variable of one catalog source."""
    return {v: r["nodata"] for v, r in rules_for(source).items() if r.get("nodata") is not None}


def mask_nodata(long_df: DataFrame, nodata: dict[str, float], variable: str = "variable",
                value: str = "value") -> DataFrame:
    """Nodata code -> NULL, per variable (a literal map lookup, no join)."""
    if not nodata:
        return long_df
    codes = F.create_map(*[F.lit(x) for kv in nodata.items() for x in (kv[0], float(kv[1]))])
    code = codes[F.col(variable)]
    v = F.col(value)
    return long_df.withColumn(value, F.when(code.isNotNull() & (v == code), F.lit(None)).otherwise(v))


def raster_grid(long_df: DataFrame, variables: list[str], nodata: dict[str, float],
                int_vars=(), key: str = "cell", carry: tuple = ("lat", "lon")) -> DataFrame:
    """A8/A9 + E10: static variables side by side on one grid, nodata masked.

    Grouped by the cell key alone (coordinates carried along), so the result is hash
    partitioned by ``cell`` and joins with other per-cell maps need no further exchange.
    This is the conditional aggregation ``pivot`` compiles to, written out.
    """
    masked = mask_nodata(long_df, nodata)
    var, val = F.col("variable"), F.col("value")
    aggs = [F.max(c).alias(c) for c in carry]
    for v in variables:
        a = F.max(F.when(var == v, val))
        aggs.append((a.cast("int") if v in int_vars else a).alias(v))
    return masked.groupBy(key).agg(*aggs)


def soil_members() -> list[str]:
    """A11 (driver side): flat members first, then for each depth every depth variable."""
    return list(SOIL_FLAT_VARIABLES) + [f"{v}_sl{d}" for d in SOIL_DEPTHS for v in SOIL_DEPTH_VARIABLES]


def soil_member_table(spark: SparkSession) -> DataFrame:
    """A11 as a table ``(member, variable, depth)``: flat rows plus an ``explode`` of the
    depth sequence per depth variable (the 44 members of the soil family)."""
    flat = spark.createDataFrame([(v,) for v in SOIL_FLAT_VARIABLES], "variable string") \
        .withColumn("depth", F.lit(None).cast("int"))
    deep = (spark.createDataFrame([(v,) for v in SOIL_DEPTH_VARIABLES], "variable string")
            .withColumn("depth", F.explode(F.sequence(F.lit(min(SOIL_DEPTHS)), F.lit(max(SOIL_DEPTHS))))))
    return flat.unionByName(deep).withColumn("member", member_name("variable", "depth"))


def _member_parts(member: str) -> tuple[str, int | None]:
    base, sep, depth = member.rpartition("_sl")
    return (base, int(depth)) if sep and depth.isdigit() else (member, None)


def _member_value(member: str) -> Column:
    """C9 + I5 of one soil column: nodata -> NULL, catalog factor."""
    v = F.col(member).cast("double")
    return (F.when(v != F.lit(SOIL_NODATA), v) * F.lit(SOIL_MULT.get(_member_parts(member)[0], 1.0)))


def soil_long(wide: DataFrame, keys: list[str] = GRID_KEYS) -> DataFrame:
    """F11 + C9 + I5: ``{v}_sl{n}`` columns -> ``(…, variable, depth, value)``; nodata
    -32768 -> NULL; catalog factors (bd x0.001, oc/ph x0.1). Names and factors are literals
    of the plan, so the stage is one compiled projection."""
    members = [c for c in wide.columns if c not in keys]
    rows = [F.struct(F.lit(_member_parts(m)[0]).alias("variable"), F.lit(_member_parts(m)[1]).cast("int").alias("depth"),
                     _member_value(m).alias("value")) for m in members]
    return wide.select(*keys, F.inline(F.array(*rows)))


def soil_grid(wide: DataFrame, members: list[str], keys: list[str] = GRID_KEYS) -> DataFrame:
    """E10 for the soil family: one column per member in model units, nodata NULL. The
    source is wide already, so this is a projection without a shuffle."""
    return wide.select(*keys, *[_member_value(m).alias(m) for m in members])


def missing_members(spark: SparkSession, wide: DataFrame, keys: list[str] = GRID_KEYS) -> DataFrame:
    """Soil members without a single value in the wide table (skip-existing at table
    level): one ``bool_or`` per column, then the expected members that are not true."""
    present = [c for c in wide.columns if c not in keys]
    seen = wide.agg(*[F.bool_or(_member_value(m).isNotNull()).alias(m) for m in present])
    flags = F.array(*[F.struct(F.lit(m).alias("member"), F.coalesce(F.col(m), F.lit(False)).alias("there")) for m in present])
    have = seen.select(F.inline(flags)).filter("there").select("member")
    return soil_member_table(spark).join(F.broadcast(have), "member", "left_anti")  # one row per column


def grid_shape(ext: Extent, deg: float = DEG_PER_500M) -> tuple[int, int, float, float]:
    """rows, columns and node spacing of the grid of an extent: ``int(span / deg)``
    nodes per axis, both end points in."""
    w = int((ext.east - ext.west) / deg)
    h = int((ext.north - ext.south) / deg)
    dlat = (ext.north - ext.south) / (h - 1) if h > 1 else 0.0
    dlon = (ext.east - ext.west) / (w - 1) if w > 1 else 0.0
    return h, w, dlat, dlon


def model_grid(spark: SparkSession, ext: Extent, deg: float = DEG_PER_500M) -> DataFrame:
    """grid of an extent, ``int(span / deg)`` cells per axis, lat descending, lon
    ascending, both end points in. Generated by ``spark.range`` (distributed), no join."""
    h, w, dlat, dlon = grid_shape(ext, deg)
    idx = spark.range(0, h * w)
    i = (F.col("id") / F.lit(w)).cast("bigint")
    j = F.col("id") % F.lit(w)
    return idx.select(i.alias("row"), j.alias("col"),
                      (F.lit(ext.north) - i.cast("double") * F.lit(dlat)).alias("lat"),
                      (F.lit(ext.west) + j.cast("double") * F.lit(dlon)).alias("lon"))


def valid_range(value="value", lo: float = 0.0, hi: float = 10.0):
    """Values outside [lo, hi] -> NULL (both ends valid)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(v.between(F.lit(lo), F.lit(hi)), v)
