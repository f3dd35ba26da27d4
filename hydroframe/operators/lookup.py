"""Lookups and static model maps (C11, E9-style joins, F8, L8).

``lookup_join`` broadcasts the lookup side only after a bounded size check (it counts at
most ``max_rows + 1`` rows, stopping early); beyond the bound it falls back to a plain
equi-join and lets AQE choose from runtime statistics.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------
# FIXED VALUES: constant model parameters the model builder sets on every cell (F8).
# ---------------------------------------------------------------------------------------
MODEL_CONSTANTS = {
    "KsatHorFrac": 25.0,
    "Cfmax": 3.75653,
    "cf_soil": 0.038,
    "EoverR": 0.05,
    "InfiltCapPath": 5.0,
    "InfiltCapSoil": 600.0,
    "MaxLeakage": 0.0,
    "rootdistpar": -500.0,
    "TT": 0.0,
    "TTI": 2.0,
    "TTM": 0.0,
    "WHC": 0.1,
    "G_Cfmax": 5.3,
    "G_SIfrac": 0.002,
    "G_TT": 1.3,
}
# ---------------------------------------------------------------------------------------

def lookup_join(df: DataFrame, lut: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a lookup table. Its size is not counted beforehand: AQE broadcasts the side that turns
    out small when the query runs, and splits skewed partitions of a large one."""
    return df.join(lut, on, how)


def landcover_params(grid: DataFrame, lut: DataFrame, class_col: str = "landcover") -> DataFrame:
    """Land-cover class -> parameter columns from a user-supplied lookup table."""
    return lookup_join(grid, lut.withColumnRenamed(lut.columns[0], class_col), class_col)


def with_constants(df: DataFrame, constants: dict[str, float] = MODEL_CONSTANTS) -> DataFrame:
    """F8: constant parameters as literal columns (folded by Catalyst, no data movement)."""
    return df.withColumns({k: F.lit(float(v)) for k, v in constants.items()})


def in_grid(df: DataFrame, axes: dict[str, DataFrame]) -> DataFrame:
    """C11: keep rows whose key is on every axis (a left-semi join per axis; the axes are
    small, AQE broadcasts them)."""
    return reduce(lambda acc, kv: acc.join(kv[1].select(kv[0]).distinct(), kv[0], "left_semi"),
                  axes.items(), df)


def ordered_times(df: DataFrame, col: str = "time") -> DataFrame:
    """The ordered list of image times as one array (an image axis: bounded by the
    period and the revisit interval, not by the pixel count)."""
    return df.select(col).distinct().agg(F.array_sort(F.collect_list(col)).alias("times"))
