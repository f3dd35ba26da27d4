"""Catalog-driven unit, rename and nodata rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydroframe.sources.catalog import rules_for


def convert(value: Column, mult: Column, add: Column) -> Column:
    """``value * mult + add`` (a missing rule is the identity)."""
    return value * F.coalesce(mult, F.lit(1.0)) + F.coalesce(add, F.lit(0.0))


_LOOKUP = object()


def apply_rules_join(long_df: DataFrame, rules: DataFrame, source: str,
                     variable_col: str = "variable", value_col: str = "value",
                     default_nodata=_LOOKUP) -> DataFrame:
    """Join a long ``(variable, value)`` table to the catalog rules of one source.

    The rules side is the catalog (fixed, tens of rows), so it is broadcast: the join
    happens inside the scan stage, no shuffle. Applies nodata -> NULL, ``mult``/``add``
    and the rename, in the catalog's order (nodata first, then units).
    """
    src = rules.filter(F.col("source") == source)
    r = (src.filter(F.col("variable") != "*")
            .select(F.col("variable").alias("_rv"), "rename_to", "mult", "add", "nodata"))
    # A source-wide nodata (variable "*") applies where a variable has none of its own.
    # Callers that know it pass it; otherwise it is looked up (one row at most).
    if default_nodata is _LOOKUP:
        wide = src.filter(F.col("variable") == "*").select("nodata").limit(1).collect()
        default_nodata = wide[0]["nodata"] if wide else None
    joined = long_df.join(F.broadcast(r), F.col(variable_col) == F.col("_rv"), "left")
    nod = F.coalesce(F.col("nodata"), F.lit(default_nodata).cast("double"))
    v = F.col(value_col)
    v = F.when(nod.isNotNull() & (v == nod), F.lit(None)).otherwise(v)
    return (joined
            .withColumn(value_col, convert(v.cast("double"), F.col("mult"), F.col("add")))
            .withColumn(variable_col, F.coalesce(F.col("rename_to"), F.col(variable_col)))
            .drop("_rv", "rename_to", "mult", "add", "nodata"))


def unit_expr(source: str, variable: str, value: Column) -> Column:
    """Driver-side rule lookup for a known column: a literal ``value*mult+add`` expression."""
    rule = rules_for(source).get(variable, {})
    out = value
    if rule.get("nodata") is not None:
        out = F.nullif(out, F.lit(rule["nodata"]))
    if rule.get("mult") is not None:
        out = out * F.lit(rule["mult"])
    if rule.get("add") is not None:
        out = out + F.lit(rule["add"])
    return out


def apply_renames(df: DataFrame, source: str, rules: DataFrame | None = None) -> DataFrame:
    """catalog renames of one source, on a wide table; ``rules`` is a user's own table
    (a few rows per variable of the schema)."""
    if rules is None:
        named = {v: r["rename_to"] for v, r in rules_for(source).items()}
    else:
        named = {r["variable"]: r["rename_to"] for r in rules.filter(F.col("source") == source).collect()}
    mapping = {v: to for v, to in named.items() if to and v in df.columns}
    return df.withColumnsRenamed(mapping) if mapping else df


def apply_units_wide(df: DataFrame, source: str, columns: list[str] | None = None) -> DataFrame:
    """I5 on a wide table: one literal expression per column that has a rule."""
    rules = rules_for(source)
    cols = columns if columns is not None else [c for c in df.columns if c in rules]
    return df.withColumns({c: unit_expr(source, c, F.col(c)) for c in cols if c in df.columns})
