"""Flow network and model-cell operators.

L1: the upstream set of an outlet in a D8 network. The outlet is made absorbing, every other
cell points downstream. First each spatial block is contracted: within a block, in one task, a
cell's pointer is followed until it leaves the block, so every cell knows its exit. Only cells
that are entered from another block matter between blocks; on this border graph pointer
doubling finds the cells that reach the outlet: after r rounds a pointer has jumped 2^r blocks.
Doubling steps are equi-joins of border cells that still travel; finished cells leave them, so
the outlet and terminal cells (the hottest keys) never enter, and a hot target inside the
network is split by AQE's skew-join rule. A last join gives every cell the fate of its exit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (methods of arrays)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydroframe.session import ship_package, stored

# FIXED VALUES taken from the model-builder settings.
OUTLET_MIN_ORDER = 7      # sub-basin outlet on a stream of order >= 7
RIVER_MIN_UPAREA = 30.0   # river cells: upstream area >= 30
RIVER_MIN_WIDTH, RIVER_MIN_DEPTH = 30.0, 1.0
AREA_FLOOR = {"reservoirs": 0.0, "lakes": 0.0, "glaciers": 1.0}

BLOCK_CELLS = 256         # side of a block in grid cells: a block is one task's work, 65,536 cells


def snap_outlet(cells: DataFrame, x: float, y: float, min_order: int = OUTLET_MIN_ORDER) -> int | None:
    """L1 assumption: the outlet snaps to the nearest cell with stream order >= min_order
    (squared grid distance, ties to the smaller cell id). Returns the cell id (a scalar)."""
    d2 = (F.col("x") - F.lit(x)) ** 2 + (F.col("y") - F.lit(y)) ** 2
    row = (cells.filter(F.col("strord") >= F.lit(min_order))
                .agg(F.min_by("cell", F.struct(d2, F.col("cell"))).alias("cell")).first())
    return None if row is None else row["cell"]


def _exits(block: pa.Table, outlet: int) -> pa.Table:
    """Follow the pointers inside one block: (cell, ptr) with the first cell beyond the block.

    ``ptr`` is the outlet for cells that reach it, and null where a path ends or runs in a circle.
    """
    cell = block["cell"].to_numpy()
    known = ~block["next_cell"].is_null().to_numpy()
    nxt = block["next_cell"].fill_null(0).to_numpy()
    order = np.argsort(cell, kind="stable")
    ids = cell[order]
    at = np.minimum(np.searchsorted(ids, nxt), len(ids) - 1)
    stays = known & (ids[at] == nxt) & (cell != outlet)
    ptr = np.where(stays, order[at], np.arange(len(cell)))  # a cell whose pointer leaves points to itself
    for _ in range(len(cell).bit_length() + 1):
        ptr = ptr[ptr]
    last = np.where(cell == outlet, outlet, nxt)
    gone = ~(known | (cell == outlet)) | stays  # the path ends, or goes round
    return pa.table({"cell": cell, "ptr": pa.array(last[ptr], pa.int64(), mask=gone[ptr])})


def contract_blocks(cells: DataFrame, outlet: int, block: int = BLOCK_CELLS) -> DataFrame:
    """(cell, ptr): each cell's exit from its block of ``block`` x ``block`` grid cells.

    Any partition of the cells is a valid one, blocks only keep paths together. Without
    coordinates, and where a block holds more cells than its area, ids divide them.
    """
    ship_package(cells.sparkSession)
    most = block * block
    if {"x", "y"} <= set(cells.columns):
        keys = [F.floor(F.col("x") / block).alias("_bx"), F.floor(F.col("y") / block).alias("_by")]
    else:
        keys = [F.lit(0).alias("_bx"), F.floor(F.col("cell") / most).alias("_by")]
    own = cells.select(F.col("cell").cast("bigint").alias("cell"), F.col("next_cell").cast("bigint").alias("next_cell"), *keys)
    largest = own.groupBy("_bx", "_by").count().agg(F.max("count")).first()[0] or 0
    parts = -(-largest // most)
    own = own.withColumn("_part", F.pmod(F.col("cell"), F.lit(max(1, parts))))

    def follow(rows: pa.Table) -> pa.Table:
        return _exits(rows, outlet)

    return own.groupBy("_bx", "_by", "_part").applyInArrow(follow, "cell bigint, ptr bigint")


def upstream_cells(cells: DataFrame, outlet: int, steps_per_round: int = 2, block: int = BLOCK_CELLS) -> DataFrame:
    """L1: all cells whose downstream path reaches ``outlet`` (the outlet included).

    Each doubling step joins the border cells still travelling with the table of travelling and
    arrived ones: a pointer at an arrived cell has arrived, one that leaves both is dead. After
    log2(border cells) + 1 steps a longer path can only be a cycle, so cells that still travel
    lead into one and are not upstream of the outlet.
    """
    exits = stored(contract_blocks(cells, outlet, block), "exits")
    leaving = exits.filter(F.col("ptr") != F.lit(outlet))
    entered = leaving.select(F.col("ptr").alias("cell")).distinct()
    border = stored(exits.join(entered, "cell", "left_semi").filter(F.col("ptr").isNotNull()), "border")
    arrived = border.filter(F.col("ptr") == F.lit(outlet))
    active = border.filter(F.col("ptr") != F.lit(outlet))
    for _ in range(0, max(1, border.count()).bit_length() + 1, steps_per_round):
        if active.isEmpty():
            break
        travelling, new = active, None
        for _ in range(steps_per_round):
            seen = arrived if new is None else arrived.unionByName(new)
            stepped = _double(travelling, seen)
            home = stepped.filter(F.col("ptr") == F.lit(outlet))
            new = home if new is None else new.unionByName(home)
            travelling = stepped.filter(F.col("ptr") != F.lit(outlet))
        stamped = stored(travelling.withColumn("home", F.lit(False)).unionByName(new.withColumn("home", F.lit(True))), "round")
        active = stamped.filter(~F.col("home")).select("cell", "ptr")
        arrived = arrived.unionByName(stamped.filter("home").select("cell", "ptr"))
    reached = arrived.select(F.col("cell").alias("ptr"))
    up = exits.filter(F.col("ptr") == F.lit(outlet)).select("cell").unionByName(leaving.join(reached, "ptr", "left_semi").select("cell"))
    return cells.join(up, "cell", "left_semi")


def _double(active: DataFrame, arrived: DataFrame) -> DataFrame:
    """One doubling step, ``ptr <- ptr(ptr)``; cells whose pointer leads nowhere are gone."""
    lookup = active.unionByName(arrived).select(F.col("cell").alias("_t"), F.col("ptr").alias("_tp"))
    return active.join(lookup, active["ptr"] == lookup["_t"]).select("cell", F.col("_tp").alias("ptr"))


def river_cells(cells: DataFrame, min_uparea: float = RIVER_MIN_UPAREA) -> DataFrame:
    """L2: river mask, upstream area >= 30."""
    return cells.filter(F.col("uparea") >= F.lit(min_uparea))


def river_floors(df: DataFrame, width: str = "rivwth", depth: str = "rivdph") -> DataFrame:
    """L3: river width >= 30, depth >= 1."""
    return df.withColumns({width: F.greatest(F.col(width), F.lit(RIVER_MIN_WIDTH)),
                           depth: F.greatest(F.col(depth), F.lit(RIVER_MIN_DEPTH))})


def coarse_key(coord: str, origin: float, step: float) -> F.Column:
    """Number of the nearest node of the coarse (climate) grid; ``origin`` is a node."""
    return F.floor((F.col(coord) - F.lit(origin)) / F.lit(step) + F.lit(0.5)).cast("bigint")


def attach_coarse_cell(fine: DataFrame, coarse: DataFrame, lat0: float, lon0: float,
                       step: float, coarse_cols: list[str]) -> DataFrame:
    """Each fine model cell gets its nearest coarse climate cell (equi-join on integer
    node numbers, no range or nearest-neighbour join); a cell whose node has no climate
    rows stays, with NULLs."""
    f = fine.withColumns({"_ki": coarse_key("lat", lat0, step), "_kj": coarse_key("lon", lon0, step)})
    c = coarse.select(coarse_key("lat", lat0, step).alias("_ki"), coarse_key("lon", lon0, step).alias("_kj"),
                      *coarse_cols)
    return f.join(c, ["_ki", "_kj"], "left").drop("_ki", "_kj")


# Standard-atmosphere lapse rate (K per m); a parameter, not a reference value.
LAPSE_RATE = 0.0065


def lapse_corrected_temp(temp: str, z_model: str, z_forcing: str, lapse: float = LAPSE_RATE) -> F.Column:
    """Temperature moved from the forcing elevation to the model elevation."""
    return F.col(temp) - F.lit(lapse) * (F.col(z_model) - F.col(z_forcing))


# Barometric formula of the standard atmosphere; parameters, not reference values.
SEA_LEVEL_KELVIN, GRAVITY, GAS_CONSTANT, MOLAR_MASS = 288.15, 9.80665, 8.3144621, 0.0289644


def elevation_corrected_pressure(press_msl: str, z_model: str, lapse: float = LAPSE_RATE) -> F.Column:
    """Sea-level pressure moved to the model elevation."""
    exponent = GRAVITY * MOLAR_MASS / (GAS_CONSTANT * lapse)
    ratio = (F.lit(SEA_LEVEL_KELVIN) - F.lit(lapse) * F.col(z_model)) / F.lit(SEA_LEVEL_KELVIN)
    return F.col(press_msl) * F.pow(ratio, F.lit(exponent))


def pet_debruin(temp_c: F.Column, press_hpa: F.Column, k_surface: F.Column, k_toa: F.Column,
                timestep: float = 86400.0, cp: float = 1005.0, beta: float = 20.0,
                cs: float = 110.0, albedo: float = 0.23) -> F.Column:
    """Reference evaporation after de Bruin et al. (2016), mm per timestep.

    Fluxes in W/m², pressure in hPa, temperature in °C; every constant is a parameter.
    """
    esat = F.lit(6.112) * F.exp((F.lit(17.67) * temp_c) / (temp_c + F.lit(243.5)))
    slope = esat * (F.lit(17.269) / (temp_c + F.lit(237.3))) * (F.lit(1.0) - temp_c / (temp_c + F.lit(237.3)))
    lam = F.lit(2.502e6) - F.lit(2250.0) * temp_c
    gamma = (F.lit(cp) * press_hpa) / (F.lit(0.622) * lam)
    ep_joule = (slope / (slope + gamma)) * ((F.lit(1.0 - albedo) * k_surface)
                                            - F.lit(cs) * (k_surface / (k_toa + F.lit(1e-5)))) + F.lit(beta)
    return ep_joule / lam * F.lit(timestep)
