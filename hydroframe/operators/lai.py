"""Leaf-area image selection.

The image list is an axis (bounded by the period and the revisit time), so ordering it with
one window is cheap; the pixels themselves stay distributed and are joined to the chosen
slots by an equi-join on the image day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from hydroframe.functions.scalar import evenly_spaced_index
from hydroframe.operators.raster import valid_range


# ---------------------------------------------------------------------------------------
# FIXED VALUES (must equal the reference's image selection).
# ---------------------------------------------------------------------------------------
TARGET_SLICES = 12
PAD_STEP_DAYS = 30
LAI_SCALE = 0.1
LAI_VALID = (0.0, 10.0)
FALLBACK_BEFORE_DAYS, FALLBACK_AFTER_DAYS = 2, 3  # window [day - 2, day + 3)
# ---------------------------------------------------------------------------------------


def images_in_period(images: DataFrame, start: dt.date, end: dt.date, col: str = "image_time") -> DataFrame:
    """Images in ``[start, end)``; the end day itself is out."""
    c = F.col(col)
    return images.filter((c >= F.lit(start)) & (c < F.lit(end)))


def image_days(images: DataFrame, col: str = "image_time") -> DataFrame:
    """Distinct image times (the collection's time list)."""
    return images.select(F.col(col).alias("time")).distinct()


def select_slots(days: DataFrame, k: int = TARGET_SLICES, step_days: int = PAD_STEP_DAYS) -> DataFrame:
    """Exactly k slots ``(slot, time, is_padding)``.

    n >= k: rows at positions ``linspace(0, n-1, k, dtype=int)`` = ``(i*(n-1)) div (k-1)``;
    n < k: all n, then padding slots each ``step_days`` after the previous one (G5).
    """
    w = Window.orderBy("time")
    ranked = days.select("time", (F.row_number().over(w) - 1).alias("rn"),
                         F.count("*").over(Window.partitionBy()).alias("n"))
    # rn is a pick position when some i in 0..k-1 has (i*(n-1)) div (k-1) == rn.
    picks = evenly_spaced_index(F.col("n"), k)
    chosen = ranked.filter((F.col("n") < k) | F.array_contains(picks, F.col("rn")))
    real = chosen.select((F.row_number().over(w) - 1).alias("slot"), "time",
                         F.col("n").alias("n_images"), F.lit(False).alias("is_padding"))
    # Padding (G5): one aggregate row explodes into k - n slots; empty when n >= k.
    pad = (real.agg(F.max("time").alias("last"), F.count("*").alias("m"))
               .filter(F.col("m") > 0)
               .select("last", "m", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(k) - F.col("m"), F.lit(0)))).alias("j"))
               .filter((F.col("j") >= 1) & (F.col("j") <= F.lit(k) - F.col("m")))
               .select((F.col("m") + F.col("j") - 1).alias("slot"),
                       _days_later("last", F.col("j") * step_days, days.schema["time"].dataType).alias("time"),
                       F.lit(None).cast("bigint").alias("n_images"),
                       F.lit(True).alias("is_padding")))
    return real.unionByName(pad).filter(F.col("slot") < k)


def _days_later(col: str, n: Column, kind: T.DataType) -> Column:
    """A date or time moved by whole days; a time keeps its time of day."""
    if isinstance(kind, T.DateType):
        return F.date_add(F.col(col), n.cast("int"))
    return F.col(col) + F.make_dt_interval(days=n.cast("int"))


def archive_period(images: DataFrame, col: str = "image_time") -> tuple[dt.date, dt.date]:
    """First and last image day of a table (one aggregate row)."""
    r = images.agg(F.to_date(F.min(col)).alias("a"), F.to_date(F.max(col)).alias("b")).first()
    return r["a"], r["b"]


def scaled_lai(raw: str = "raw_lai") -> F.Column:
    """I4 + C8: raw x 0.1, outside 0..10 -> missing."""
    return valid_range(F.col(raw).cast("double") * F.lit(LAI_SCALE), *LAI_VALID)


def lai_cube(pixels: DataFrame, slots: DataFrame, keys=("cell",)) -> DataFrame:
    """A15 + E5: pixel values of each chosen slot (image of that day), scaled and masked.

    A pixel observed twice on one day keeps the value of the largest ``obs_id`` (D12).
    Padding slots have no pixels and are kept as slot rows only by ``lai_slots``.
    """
    sl = slots.filter(~F.col("is_padding")).select("slot", F.col("time").alias("image_time"))
    joined = pixels.join(F.broadcast(sl), "image_time")  # at most k rows by construction
    per_pixel = joined.groupBy("slot", "image_time", *keys).agg(
        F.max_by(F.col("raw_lai"), F.col("obs_id")).alias("raw_lai"))
    return per_pixel.select("slot", F.col("image_time").alias("time"), *keys,
                            scaled_lai("raw_lai").alias("lai"))


def slice_range(cube: DataFrame) -> DataFrame:
    """Missing-ignoring value range per slice."""
    return cube.groupBy("slot", "time").agg(F.min("lai").alias("lai_min"), F.max("lai").alias("lai_max"),
                                            F.count("lai").alias("n_valid"))


def fallback_images(targets: DataFrame, days: DataFrame, target_col: str = "target_day") -> DataFrame:
    """E5 + E6 / Q21: the image of the target day, else the *first by time* image in
    ``[day - 2, day + 3)`` (not the closest); NULL when none.

    Images may have a time of day: a day stands for its first image, and ``image_day`` is
    that image's time. The range join becomes an equi-join: each target is exploded into its
    five candidate days and left-joined to the days, then one aggregate per target decides.
    """
    offs = F.sequence(F.lit(-FALLBACK_BEFORE_DAYS), F.lit(FALLBACK_AFTER_DAYS - 1))
    cand = targets.select(target_col, F.explode(offs).alias("off")) \
        .withColumn("cand_day", F.date_add(F.col(target_col), F.col("off")))
    # One row per calendar day of the archive (366 a year) by this aggregate: a proven bound.
    firsts = days.groupBy(F.to_date("time").alias("cand_day")).agg(F.min("time").alias("first_image"))
    hits = cand.join(F.broadcast(firsts), "cand_day", "left")
    on_day = F.col("off") == 0
    per_target = hits.groupBy(target_col).agg(
        F.max(F.when(on_day, F.col("first_image"))).alias("_exact"), F.min("first_image").alias("_first"))
    return per_target.select(target_col, F.coalesce("_exact", "_first").alias("image_day"),
                             F.col("_exact").isNotNull().alias("exact_day"))


def lai_grid_cube(pixels: DataFrame, slots: DataFrame, ext, deg: float | None = None) -> DataFrame:
    """A15 on the model grid (F13): the twelve slots x ``lat`` x ``lon`` cube of an extent.

    Pixels ``(image_time, lat, lon, obs_id, raw_lai)`` are snapped to the nearest node of
    the grid (integer row/column from the coordinates: an equi-key, not a nearest-neighbour
    join); a node hit twice keeps the largest ``obs_id`` (D12). The dense index space
    (slots x rows x columns) comes from ``spark.range`` and is left-joined to the values,
    so nodes without a pixel and padding slots are NULL, as in the reference's cube.
    """
    from hydroframe.operators.raster import DEG_PER_500M, grid_shape
    deg = deg or DEG_PER_500M
    h, w, dlat, dlon = grid_shape(ext, deg)
    row = F.round((F.lit(ext.north) - F.col("lat")) / F.lit(dlat if dlat else 1.0)).cast("bigint")
    col = F.round((F.col("lon") - F.lit(ext.west)) / F.lit(dlon if dlon else 1.0)).cast("bigint")
    sl = slots.select("slot", F.col("time").alias("image_time"), "time", "is_padding")
    snapped = (pixels.join(F.broadcast(sl.filter(~F.col("is_padding")).select("slot", "image_time")),
                           "image_time")  # at most k slot rows
                     .select("slot", row.alias("row"), col.alias("col"), "obs_id", "raw_lai")
                     .filter(F.col("row").between(0, h - 1) & F.col("col").between(0, w - 1)))
    values = snapped.groupBy("slot", "row", "col").agg(
        F.max_by(F.col("raw_lai"), F.col("obs_id")).alias("raw_lai"))
    n_slots = TARGET_SLICES
    dense = slots.sparkSession.range(0, n_slots * h * w).select(
        (F.col("id") / F.lit(h * w)).cast("int").alias("slot"),
        ((F.col("id") % F.lit(h * w)) / F.lit(w)).cast("bigint").alias("row"),
        (F.col("id") % F.lit(w)).alias("col"))
    times = F.broadcast(sl.select("slot", "time"))  # at most k rows
    return (dense.join(times, "slot")
                 .join(values, ["slot", "row", "col"], "left")
                 .select("slot", "time",
                         (F.lit(ext.north) - F.col("row").cast("double") * F.lit(dlat)).cast("float").alias("lat"),
                         (F.lit(ext.west) + F.col("col").cast("double") * F.lit(dlon)).cast("float").alias("lon"),
                         scaled_lai("raw_lai").cast("float").alias("Lai")))
