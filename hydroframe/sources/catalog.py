"""Data catalog as small Spark tables.

The catalog is parsed once on the driver into ``catalog_rules``: one row per
``(source, variable)`` with ``rename_to``, ``mult``, ``add`` and ``nodata``. Its size is
fixed by the catalog (tens of rows), so joining it with ``broadcast`` is size-bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------
# FIXED VALUES (must equal the reference's catalog and fetch settings for right results).
# (source, variable, rename_to, mult, add, nodata); None = rule absent.
# ---------------------------------------------------------------------------------------
CATALOG_RULES_FIXED = [
    ("era5", "temp", None, None, -273.15, None),
    ("era5", "temp_max", None, None, -273.15, None),
    ("era5", "temp_min", None, None, -273.15, None),
    ("era5", "kout", None, 0.000277778, None, None),
    ("era5", "precip", None, 1000.0, None, None),
    ("era5", "press_msl", None, 0.01, None, None),
    ("era5_tp", "precip", None, 1000.0, None, None),
    ("era5_hourly", "temp", None, None, -273.15, None),
    ("era5_hourly", "kin", None, 0.000277778, None, None),
    ("era5_hourly", "kout", None, 0.000277778, None, None),
    ("era5_hourly", "precip", None, 1000.0, None, None),
    ("era5_hourly", "press_msl", None, 0.01, None, None),
    ("era5_daily_zarr", "d2m", "temp_dew", None, None, None),
    ("era5_daily_zarr", "u10", "wind10_u", None, None, None),
    ("era5_daily_zarr", "v10", "wind10_v", None, None, None),
    ("era5_daily_zarr", "temp_dew", None, None, -273.15, None),
    ("era5_daily_zarr", "ssr", None, 0.000277778, None, None),
    ("era5_hourly_zarr", "d2m", "temp_dew", None, None, None),
    ("era5_hourly_zarr", "u10", "wind10_u", None, None, None),
    ("era5_hourly_zarr", "v10", "wind10_v", None, None, None),
    ("era5_hourly_zarr", "temp_dew", None, None, -273.15, None),
    ("era5_hourly_zarr", "ssr", None, 0.000277778, None, None),
    ("modis_lai", "Lai_500m", "LAI", None, None, None),
    ("modis_lai", "LAI", None, 0.1, None, None),
    ("hydro_lakes", "Area_avg", None, 1000000.0, None, None),
    ("hydro_reservoirs", "*", None, None, None, -99.0),
    ("koppen_geiger", "koppen_geiger", None, None, None, 0.0),
    ("gcn250", "*", None, None, None, 255.0),
    ("grwl_mask", "*", None, None, None, 0.0),
    ("gswo", "*", None, None, None, 255.0),
    # nodata codes the raster fetch writes (not in the catalog file itself)
    ("merit_hydro_1k", "elevtn", None, None, None, -9999.0),
    ("merit_hydro_1k", "uparea", None, None, None, -9999.0),
    ("merit_hydro_1k", "strord", None, None, None, 255.0),
    ("merit_hydro_1k", "flwdir", None, None, None, 247.0),
    ("globcover", "globcover", None, None, None, 0.0),
    ("chelsa", "chelsa", None, None, None, -32767.0),
]

# Nodata code the climate-class fetch writes (the catalog says 0 instead; Q13).
KOPPEN_FETCH_NODATA = 32.0
SOIL_NODATA = -32768.0
SOIL_FLAT_VARIABLES = ["tax_usda", "soilthickness"]
SOIL_DEPTH_VARIABLES = ["sndppt", "sltppt", "oc", "ph", "bd", "clyppt"]
SOIL_DEPTHS = [1, 2, 3, 4, 5, 6, 7]
SOIL_MULT = {"bd": 0.001, "oc": 0.1, "ph": 0.1}

# Climate bands as fetched -> the names the model reads (F1).
CLIMATE_BANDS = {
    "total_precipitation": "precip",
    "temperature_2m": "temp",
    "toa_incident_solar_radiation": "kin",
    "mean_surface_direct_short_wave_radiation_flux": "kout",
    "mean_sea_level_pressure": "press_msl",
}
CLIMATE_VARIABLES = list(CLIMATE_BANDS.values())
CLIMATE_UNITS = {
    "precip": ("m", "Total precipitation"),
    "temp": ("K", "Temperature at 2m"),
    "kin": ("W/m²", "TOA incident solar radiation"),
    "kout": ("W/m²", "Mean surface direct short wave radiation flux"),
    "press_msl": ("Pa", "Mean sea level pressure"),
}
GRAVITY = 9.80665
# ---------------------------------------------------------------------------------------

RULES_SCHEMA = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("variable", T.StringType(), False),
    T.StructField("rename_to", T.StringType(), True),
    T.StructField("mult", T.DoubleType(), True),
    T.StructField("add", T.DoubleType(), True),
    T.StructField("nodata", T.DoubleType(), True),
])


def soil_rule_rows() -> list[tuple]:
    """Soil rules generated from the variable x depth rule: mult per family, one nodata."""
    rows = [("soilgrids", v, None, None, None, SOIL_NODATA) for v in SOIL_FLAT_VARIABLES]
    for v in SOIL_DEPTH_VARIABLES:
        for d in SOIL_DEPTHS:
            rows.append(("soilgrids", f"{v}_sl{d}", None, SOIL_MULT.get(v), None, SOIL_NODATA))
    return rows


def catalog_rule_rows() -> list[tuple]:
    return list(CATALOG_RULES_FIXED) + soil_rule_rows()


def catalog_rules(spark: SparkSession, source: str | None = None) -> DataFrame:
    """The catalog as a DataFrame; tiny and fixed-size, hence safe to broadcast."""
    rows = catalog_rule_rows()
    if source is not None:
        rows = [r for r in rows if r[0] == source]
    return spark.createDataFrame(rows, RULES_SCHEMA)


def rules_for(source: str) -> dict[str, dict]:
    """Driver-side view of one source's rules, for building column expressions."""
    out: dict[str, dict] = {}
    for s, v, rename_to, mult, add, nodata in catalog_rule_rows():
        if s == source:
            out[v] = {"rename_to": rename_to, "mult": mult, "add": add, "nodata": nodata}
    return out


def variable_from_path(template: str, path_col: str = "_metadata.file_path") -> F.Column:
    """The ``{variable}`` of a catalog path template such as ``dir/{variable}.tif``
    (one source, many variables), taken from each row's file path."""
    import re
    head, _, tail = template.partition("{variable}")
    pattern = re.escape(head.rstrip("/").split("/")[-1] + "/" if head else "") + r"([^/]+)" + re.escape(tail)
    return F.regexp_extract(F.col(path_col) if isinstance(path_col, str) else path_col, pattern, 1)


def catalog_rule_rows_from_yaml(path: str) -> list[tuple]:
    """The rules of a data-catalog YAML file, read once on the driver (a small config
    file, not data)."""
    with open(path, encoding="utf-8") as f:
        return catalog_rule_rows_of(f.read())


def catalog_rule_rows_of(text: str) -> list[tuple]:
    """Data-catalog YAML as ``(source, variable, rename_to, mult, add, nodata)`` rows. ``nodata`` may be one
    value for the whole source (variable ``*``) or a map per variable; ``unit_add.time`` is
    kept as a row for the time-shift option (Q10)."""
    try:
        import yaml
    except ImportError as e:  # pragma: no cover - PyYAML is optional
        raise ImportError("reading a catalog YAML needs PyYAML") from e
    doc = yaml.safe_load(text) or {}
    rows: dict[tuple[str, str], dict] = {}

    def put(src, var, **kw):
        r = rows.setdefault((src, var), {"rename_to": None, "mult": None, "add": None, "nodata": None})
        r.update({k: v for k, v in kw.items() if v is not None})

    for src, spec in doc.items():
        if not isinstance(spec, dict):
            continue
        for var, to in (spec.get("rename") or {}).items():
            put(src, str(var), rename_to=str(to))
        for var, m in (spec.get("unit_mult") or {}).items():
            put(src, str(var), mult=float(m))
        for var, a in (spec.get("unit_add") or {}).items():
            put(src, str(var), add=float(a))
        nod = spec.get("nodata")
        if isinstance(nod, dict):
            for var, v in nod.items():
                put(src, str(var), nodata=float(v))
        elif nod is not None:
            put(src, "*", nodata=float(nod))
    return [(s, v, r["rename_to"], r["mult"], r["add"], r["nodata"]) for (s, v), r in rows.items()]


def catalog_rules_from_yaml(spark: SparkSession, path: str) -> DataFrame:
    """A user's catalog file as the ``catalog_rules`` table."""
    return spark.createDataFrame(catalog_rule_rows_from_yaml(path), RULES_SCHEMA)


def time_shift_seconds(rules: DataFrame, source: str) -> float:
    """Q10: the catalog's ``unit_add.time`` of a source, in seconds (any sign); 0 without one."""
    r = rules.filter((F.col("source") == source) & (F.col("variable") == "time")).select("add").first()
    return float(r["add"] or 0.0) if r else 0.0
