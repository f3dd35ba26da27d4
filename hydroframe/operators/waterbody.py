"""Water bodies: vector export and dam height.

Dam height is pure column logic (one ``CASE`` chain, whole-stage codegen); the export is a
chain of ``DataFrame.transform`` steps: bounds filter -> clip -> drop empty -> ids -> height.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hydroframe.operators.extent import select_in_extent
from hydroframe.functions.scalar import clip, nan_to_null
from hydroframe.operators.ids import exact_medians, sequential_id
from hydroframe.params import Extent
from hydroframe.sources.vector import polygons_in_extent

# ---------------------------------------------------------------------------------------
# FIXED VALUES (must equal the reference's dam-height model).
# ---------------------------------------------------------------------------------------
VOLUME_CANDIDATES = ["Vol_total", "Vol_res", "Volume", "vol_total", "vol_res"]
AREA_CANDIDATES = ["Lake_area", "Area", "lake_area", "area"]
DEFAULT_HEIGHT = 20.0
MIN_HEIGHT, MAX_HEIGHT = 5.0, 300.0
KM2_TO_M2 = 1e6
SMALL_MAX, LARGE_MIN = 1e6, 1e8  # small: V < 1e6; medium: 1e6 <= V <= 1e8; large: V > 1e8
# blend weights (empirical, prism, cubic) per size class
BLEND = {"small": (0.7, 0.2, 0.1), "medium": (0.4, 0.4, 0.2), "large": (0.3, 0.6, 0.1)}
# ---------------------------------------------------------------------------------------


def first_existing(df: DataFrame, candidates: list[str]) -> str | None:
    """the first candidate column present in the schema (driver-side schema lookup)."""
    return next((c for c in candidates if c in df.columns), None)


def size_class(volume: Column) -> Column:
    """H4: size class by volume; NULL volume has no class."""
    return (F.when(volume < F.lit(SMALL_MAX), "small")
             .when(volume <= F.lit(LARGE_MIN), "medium")
             .when(volume > F.lit(LARGE_MIN), "large"))


def height_estimates(volume: Column, area_km2: Column) -> dict[str, Column]:
    """H3: prism ``2V/A``, empirical ``10*sqrt(V/A)``, cubic ``5*V^(1/3)``; A in m²."""
    a_m2 = area_km2 * F.lit(KM2_TO_M2)
    ratio = F.try_divide(volume, a_m2)  # ANSI mode: a zero area gives NULL, not an error
    return {
        "prism": F.try_divide(F.lit(2.0) * volume, a_m2),
        "empirical": F.lit(10.0) * F.sqrt(ratio),
        "cubic": F.lit(5.0) * F.pow(volume, F.lit(1.0 / 3.0)),
    }


def valid_volume_area(volume: Column, area: Column) -> Column:
    """Both present and positive."""
    return volume.isNotNull() & area.isNotNull() & (volume > 0) & (area > 0)


def dam_height_expr(volume: Column, area: Column) -> Column:
    """H1: blended estimate by size class, clipped to [5, 300]; invalid rows get 20 m.

    Clipping comes before the infinity replacement, so an infinite estimate becomes 300 (Q18);
    an undefined one (both inputs infinite) is missing and gets 20.
    """
    est = height_estimates(volume, area)
    cls = size_class(volume)
    blended = None
    for name, (w_emp, w_prism, w_cubic) in BLEND.items():
        value = (F.lit(w_emp) * est["empirical"] + F.lit(w_prism) * est["prism"]
                 + F.lit(w_cubic) * est["cubic"])
        blended = (F.when(cls == name, value) if blended is None
                   else blended.when(cls == name, value))
    clipped = clip(nan_to_null(blended), MIN_HEIGHT, MAX_HEIGHT)
    return F.when(valid_volume_area(volume, area), F.coalesce(clipped, F.lit(DEFAULT_HEIGHT))) \
            .otherwise(F.lit(DEFAULT_HEIGHT))


def with_dam_height(df: DataFrame, out_col: str = "Dam_height",
                    keep_intermediate: bool = False) -> DataFrame:
    """H1 + H2: add ``Dam_height`` (double). If either input column is absent: 20 for all."""
    vcol, acol = first_existing(df, VOLUME_CANDIDATES), first_existing(df, AREA_CANDIDATES)
    if vcol is None or acol is None:
        return df.withColumn(out_col, F.lit(DEFAULT_HEIGHT))
    v, a = nan_to_null(F.col(vcol).cast("double")), nan_to_null(F.col(acol).cast("double"))
    out = df.withColumn(out_col, dam_height_expr(v, a))
    if keep_intermediate:
        est = height_estimates(v, a)
        out = out.withColumns({"size_class": size_class(v),
                               "valid": valid_volume_area(v, a),
                               "h_prism": est["prism"], "h_empirical": est["empirical"],
                               "h_cubic": est["cubic"]})
    return out


def assign_ids(df: DataFrame, mode: str, source_field: str | None = None,
               id_col: str = "waterbody_id", order_col: str | None = None) -> DataFrame:
    """Ids from position (0-based, ordered by the source id for determinism, the
    source field dropped), by renaming a field, or position as fallback when absent."""
    order_col = order_col or source_field
    if mode == "none":
        return df
    if mode == "position" or (mode == "rename" and source_field not in df.columns):
        keys = [order_col] if order_col and order_col in df.columns else list(df.columns)
        out = sequential_id(df, keys, id_col, start=0)
        if source_field and source_field in out.columns and mode == "position":
            out = out.drop(source_field)
        return out
    return df.withColumnRenamed(source_field, id_col).withColumn(id_col, F.col(id_col).cast("bigint"))


def basin_ids(df: DataFrame, main_col: str = "MAIN_BAS") -> DataFrame:
    """``MAIN_BAS`` -> ``basid``; when absent, a 1-based position."""
    if main_col in df.columns:
        return df.withColumnRenamed(main_col, "basid")
    return sequential_id(df, [c for c in df.columns if c != "geometry"][:1] or df.columns,
                         "basid", start=1)


def export_waterbodies(df: DataFrame, ext: Extent, id_mode: str = "position",
                       source_field: str = "hylak_id", add_dam_height: bool = True,
                       min_area: float | None = None) -> DataFrame:
    """Features meeting the extent, clipped to it, empty ones dropped, ids, height.

    ``min_area`` is the model builder's area floor (L4), applied after the ids are given.
    A filter keeps its schema, so an extent with no hits yields an empty table with the full
    schema (B3).
    """
    return _exported(select_in_extent(df, ext, clip=True), id_mode, source_field, add_dam_height, min_area)


def export_polygons(df: DataFrame, ext: Extent, id_mode: str = "position", source_field: str = "hylak_id",
                    add_dam_height: bool = True, min_area: float | None = None, polys: str = "polys") -> DataFrame:
    """A3-A6 with geometry: like ``export_waterbodies`` for polygon features; the clipped
    rings, their area and box are kept beside the properties."""
    return _exported(polygons_in_extent(df, ext, polys), id_mode, source_field, add_dam_height, min_area)


def _exported(out: DataFrame, id_mode: str, source_field: str, add_dam_height: bool,
              min_area: float | None) -> DataFrame:
    out = assign_ids(out, id_mode, source_field)
    out = with_dam_height(out) if add_dam_height else out
    if min_area is not None:
        # The model build applies the floor to the exported table: ids keep their export
        # positions, and features without an area do not pass it.
        acol = first_existing(out, AREA_CANDIDATES)
        if acol:
            out = out.filter(F.col(acol) >= F.lit(min_area))
    return out


def empty_vector_schema(with_id: bool, with_height: bool) -> T.StructType:
    """Schema of an empty export (``waterbody_id`` int64, ``Dam_height`` float64)."""
    fields = [T.StructField("geometry", T.StringType(), True)]
    if with_id:
        fields.append(T.StructField("waterbody_id", T.LongType(), True))
    if with_height:
        fields.append(T.StructField("Dam_height", T.DoubleType(), True))
    return T.StructType(fields)


def dam_height_summary(df: DataFrame, h: str = "Dam_height") -> DataFrame:
    """D6 + D8: count, min, max, mean, exact median, sample std, count of heights > 0."""
    med = exact_medians(df, [h])[h]
    return df.agg(
        F.count("*").alias("n"),
        F.round(F.min(h), 6).alias("min_height"), F.round(F.max(h), 6).alias("max_height"),
        F.round(F.avg(h), 6).alias("mean_height"),
        F.round(F.stddev_samp(h), 6).alias("std_height"),
        F.count_if(F.col(h) > 0).alias("n_positive"),
    ).withColumn("median_height", F.round(F.lit(med).cast("double"), 6))


def input_summary(df: DataFrame) -> DataFrame:
    """Count, range, mean and exact median of volume and area over the rows valid for an
    estimate (C10)."""
    v = nan_to_null(F.col(first_existing(df, VOLUME_CANDIDATES)).cast("double"))
    a = nan_to_null(F.col(first_existing(df, AREA_CANDIDATES)).cast("double"))
    aggs = [F.count("*").alias("n_valid")]
    for name, c in (("volume", "_v"), ("area", "_a")):
        aggs += [F.round(f(c), 6).alias(f"{kind}_{name}") for kind, f in (("min", F.min), ("max", F.max), ("mean", F.avg))]
    valid = df.filter(valid_volume_area(v, a)).select(v.alias("_v"), a.alias("_a"))
    medians = exact_medians(valid, ["_v", "_a"])
    return valid.agg(*aggs).withColumns({f"median_{name}": F.round(F.lit(medians[c]).cast("double"), 6)
                                         for name, c in (("volume", "_v"), ("area", "_a"))})


def dam_height_by_class(df: DataFrame, h: str = "Dam_height") -> DataFrame:
    """Mean height and count per size class (classes by volume, valid or not)."""
    vcol = first_existing(df, VOLUME_CANDIDATES)
    return (df.withColumn("size_class", size_class(nan_to_null(F.col(vcol).cast("double"))))
              .filter(F.col("size_class").isNotNull())
              .groupBy("size_class")
              .agg(F.round(F.avg(h), 6).alias("mean_height"), F.count("*").alias("n")))


def first_k_details(df: DataFrame, order_col: str, k: int = 5) -> DataFrame:
    """The first k rows with their intermediate estimates (a top-k report: the limit is
    the feature). Only valid rows carry estimates, as in the reference's log."""
    d = with_dam_height(df.drop("Dam_height") if "Dam_height" in df.columns else df,
                        keep_intermediate=True)
    return (d.orderBy(order_col).limit(k)
             .filter(F.col("valid"))
             .select(order_col, *[F.round(c, 6).alias(c) for c in
                                  ("h_prism", "h_empirical", "h_cubic", "Dam_height")]))
