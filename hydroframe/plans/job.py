"""The whole model-input job (K8) as one call: every input table in, every output written.

This is the entry a user of the reference runs: given the job parameters and the input
tables (vector features, rasters, hourly climate, leaf-area pixels, stations), it runs each
operator and writes its output under ``out_dir`` (vectors and rasters as parquet, cubes
partitioned by day, zstd). Each output is one Spark job over distributed data; nothing is
collected except the per-output row counts of the returned manifest.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydroframe.operators import chunks, climate, lai, network, raster, waterbody
from hydroframe.operators.digest import content_digest
from hydroframe.operators.network import AREA_FLOOR
from hydroframe.params import JobParams
from hydroframe.sources import sinks, vector
from hydroframe.sources.catalog import catalog_rules


@dataclass
class JobInputs:
    """Input tables of one job; any may be ``None`` when the job has no such source."""

    basins: DataFrame | None = None            # polygon features: properties + polys (parse_polygon_features)
    rivers: DataFrame | None = None            # line features: properties + lines (parse_line_features)
    landuse_long: DataFrame | None = None      # (cell, lat, lon, variable, value): globcover, chelsa, koppen_geiger
    hourly_obs: DataFrame | None = None        # (obs_id, time, lat, lon, lat_text, band, value)
    geopotential: DataFrame | None = None      # same shape, band 'geopotential'
    waterbodies: DataFrame | None = None       # (hylak_id, Vol_total, Lake_area) and polys, or xmin, xmax, ymin, ymax
    glaciers: DataFrame | None = None          # polys or boxes, with an area column
    terrain_long: DataFrame | None = None      # (cell, lat, lon, variable, value)
    soil_wide: DataFrame | None = None         # (cell, lat, lon, {var}_sl{n}…)
    lai_pixels: DataFrame | None = None        # (image_time, lat, lon | cell, obs_id, raw_lai)
    flow_cells: DataFrame | None = None        # (cell, x, y, next_cell, strord, uparea)
    outlet_xy: tuple[float, float] | None = None  # sub-basin outlet in grid units
    stations_csv: str | None = None            # station CSV path (empty table when absent)


def _export_of(features: DataFrame):
    """The export for a layer with rings, or with boxes only."""
    return waterbody.export_polygons if "polys" in features.columns else waterbody.export_waterbodies


def build_model_inputs(spark: SparkSession, inputs: JobInputs, params: JobParams,
                       out_dir: str, climate_source: str = "era5",
                       rules: DataFrame | None = None, digests: bool = False) -> dict[str, dict]:
    """Run the chain and write every output; returns ``{output: {"path", "rows", "columns"}}``
    (the write-back check of B7: each output re-read, counted, its columns listed).
    ``rules`` is the user's own catalog as a table (``catalog_rules_from_yaml``). With
    ``digests`` each entry also has ``digest``: the order-free digests of what was read back,
    ``{column: (n_values, hash_sum, hash_xor)}``, to compare two runs without their data."""
    written: dict[str, dict] = {}

    def emit(name: str, df: DataFrame, cube_cols: list[str] | None = None) -> None:
        path = os.path.join(out_dir, name)
        if cube_cols is not None:
            sinks.write_cube(df, path, cube_cols)
        else:
            sinks.write_vector(df, path)
        # Read back with the written schema: an empty partitioned cube has no data files,
        # and the schema keeps it a well-typed empty table.
        back = spark.read.schema(df.schema).parquet(path)
        written[name] = {"path": path, "rows": back.count(), "columns": back.columns}
        if digests:
            written[name]["digest"] = {r["column"]: (r["n_values"], r["hash_sum"], r["hash_xor"]) for r in content_digest(back).collect()}

    ext = params.extent
    if inputs.basins is not None:
        basins = vector.polygons_in_extent(inputs.basins, ext)
        keep = [c for c in basins.columns if c in ("MAIN_BAS", "polys", "area", "xmin", "xmax", "ymin", "ymax")]
        emit("basins", waterbody.basin_ids(basins.select(*keep)))
    if inputs.rivers is not None:
        emit("rivers", vector.lines_in_extent(inputs.rivers, ext))
    if inputs.waterbodies is not None:
        # reservoirs and lakes: the same asset and the same export (ids, dam height)
        export = _export_of(inputs.waterbodies)
        emit("reservoirs", export(inputs.waterbodies, ext, min_area=AREA_FLOOR["reservoirs"]))
        emit("lakes", export(inputs.waterbodies, ext, min_area=AREA_FLOOR["lakes"]))
    if inputs.glaciers is not None:
        emit("glaciers", _export_of(inputs.glaciers)(inputs.glaciers, ext, id_mode="none", add_dam_height=False,
                                                     min_area=AREA_FLOOR["glaciers"]))
    if inputs.terrain_long is not None:
        emit("terrain", raster.raster_grid(inputs.terrain_long, ["elevtn", "uparea", "strord", "flwdir"],
                                           raster.nodata_map("merit_hydro_1k"), int_vars=raster.TERRAIN_INT_VARS))
    if inputs.landuse_long is not None:
        nodata = {**raster.nodata_map("globcover"), **raster.nodata_map("chelsa"),
                  **raster.nodata_map("koppen_geiger")}
        emit("landuse", raster.raster_grid(inputs.landuse_long, ["globcover", "chelsa", "koppen_geiger"],
                                           nodata, int_vars=("globcover", "koppen_geiger")))
    if inputs.soil_wide is not None:
        emit("soil", raster.soil_long(inputs.soil_wide))
    if inputs.lai_pixels is not None:
        imgs = lai.images_in_period(inputs.lai_pixels, params.start_date, params.end_date)
        slots = lai.select_slots(lai.image_days(imgs))
        emit("lai_slots", slots)
        if {"lat", "lon"} <= set(imgs.columns):   # pixels with coordinates: the grid cube
            emit("lai", lai.lai_grid_cube(imgs, slots, ext))
        else:
            emit("lai", lai.lai_cube(imgs, slots))
    if inputs.flow_cells is not None:
        emit("river_cells", network.river_cells(inputs.flow_cells))
        if inputs.outlet_xy is not None:
            outlet = network.snap_outlet(inputs.flow_cells, *inputs.outlet_xy)
            emit("subbasin", network.upstream_cells(inputs.flow_cells, outlet))
    if inputs.hourly_obs is not None:
        daily = climate.daily_forcing(spark, inputs.hourly_obs, params, climate_source, rules=rules)
        emit("forcing", daily, cube_cols=climate.CLIMATE_VARIABLES)
    if inputs.geopotential is not None:
        oro = climate.orography_hourly(inputs.geopotential, params).withColumn("day", F.to_date("time"))
        emit("orography", oro, cube_cols=["elevtn"])
    stations = sinks.read_stations(spark, inputs.stations_csv or os.path.join(out_dir, "_no_stations"))
    emit("stations", stations)
    emit("chunks", chunks.chunk_table(spark, chunks.period_bounds(spark, params.start_date, params.end_date)))
    emit("catalog_rules", catalog_rules(spark) if rules is None else rules)
    return written


def extract_discharge_at_outlet(spark: SparkSession, results: DataFrame, lon: float, lat: float,
                                out_dir: str) -> dict | None:
    """K5: after a run, the discharge series at the outlet written as CSV (B5) and its
    missing-ignoring statistics (D9). ``results`` is the long result table
    ``(time, lat, lon, <one of the known discharge variables>)``; ``None`` when it holds
    none of them. Only the one-row statistics reach the driver."""
    from hydroframe.operators import discharge
    var = discharge.discharge_variable(results)
    if var is None:
        return None
    series = discharge.outlet_series(results, lon, lat, var)
    path = os.path.join(out_dir, "discharge_at_outlet")
    sinks.write_series_csv(series.orderBy("time"), path)
    stats = discharge.series_stats(series).first().asDict()
    stats.update({"path": path, "variable": var})
    return stats
