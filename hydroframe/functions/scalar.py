"""Scalar column builders (I1-I19). All are built-in Spark expressions (codegen, JVM-side)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c) -> Column:
    """Text -> double; unreadable text -> NULL (``pd.to_numeric(errors='coerce')``)."""
    return F.expr(f"try_cast({_sql(c)} AS DOUBLE)") if isinstance(c, str) else c.try_cast("double")


def _sql(c: str) -> str:
    return f"`{c}`"


def round_half_even(c, places: int = 5) -> Column:
    """Numpy-style half-even rounding of coordinates (``bround``, not ``round``)."""
    return F.bround(col(c), places)


def nan_to_null(c) -> Column:
    """NaN -> NULL at the scan: Spark orders NaN above every number, so it must not reach
    ``max``/``avg`` or a ``> 0`` test."""
    return F.nanvl(col(c), F.lit(None).cast("double"))  # names its argument once, however large


def is_missing(c) -> Column:
    """NULL or NaN."""
    c = col(c)
    return c.isNull() | F.isnan(c)


def is_present(c) -> Column:
    """A usable value (not NULL, not NaN)."""
    return ~is_missing(c)


def nodata_to_null(c, nodata: float | None) -> Column:
    """A nodata code becomes NULL on read."""
    c = col(c)
    return c if nodata is None else F.nullif(c, F.lit(nodata).cast(c_type_hint(nodata)))


def c_type_hint(v) -> str:
    return "double" if isinstance(v, float) else "bigint"


def clip(c, lo: float, hi: float) -> Column:
    """Clip to [lo, hi]. NULL stays NULL (``least``/``greatest`` skip NULL otherwise)."""
    c = col(c)
    return F.when(c.isNotNull(), F.least(F.lit(hi), F.greatest(F.lit(lo), c)))


def replace_infinite(c, value: float) -> Column:
    """+-inf -> value."""
    c = col(c)
    return F.when(F.abs(c) == float("inf"), F.lit(value)).otherwise(c)


def epoch_ms_to_timestamp(c) -> Column:
    """Epoch milliseconds -> naive UTC timestamp (the session zone is UTC, see
    ``session.CORE_CONF``; the LTZ -> NTZ cast reads wall time in that zone)."""
    return F.timestamp_millis(col(c)).cast("timestamp_ntz")


def parse_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    """``YYYY-MM-DD`` text -> date (NULL when unreadable, also in ANSI mode)."""
    return F.call_function("try_to_date", col(c), F.lit(fmt))


def parse_timestamp(c, fmt: str = ISO_SECONDS) -> Column:
    """ISO ``…T%H:%M:%S`` text -> naive timestamp (NULL when unreadable)."""
    return F.try_to_timestamp(col(c), F.lit(fmt)).cast("timestamp_ntz")


def iso_seconds(c) -> Column:
    """I8: ``%Y-%m-%dT%H:%M:%S``."""
    return F.date_format(col(c), ISO_SECONDS)


def compact_date(c) -> Column:
    """I8: ``%Y%m%d``."""
    return F.date_format(col(c), "yyyyMMdd")


def add_days(c, n: int) -> Column:
    """timestamp/date + n days."""
    return col(c) + F.expr(f"INTERVAL {int(n)} DAYS")


def day_range(start: dt.date, end: dt.date) -> Column:
    """Every day from start to end, both ends in."""
    return F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY")))


def evenly_spaced_index(n: Column, k: int) -> Column:
    """``linspace(0, n-1, k, dtype=int)`` as an array; equals ``(i*(n-1)) div (k-1)``."""
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                       lambda i: F.floor(i * (n - 1) / F.lit(k - 1)).cast("bigint"))


def linspace_value(lo: float, hi: float, i: Column, n: int) -> Column:
    """The i-th of n evenly spaced numbers from lo to hi (both ends in)."""
    if n <= 1:
        return F.lit(float(lo))
    return F.lit(float(lo)) + i.cast("double") * F.lit((float(hi) - float(lo)) / (n - 1))


def member_name(variable, depth) -> Column:
    """``{variable}_sl{depth}``; a NULL depth gives the bare variable name."""
    v, d = col(variable), col(depth)
    return F.when(d.isNull(), v).otherwise(F.concat(v, F.lit("_sl"), d.cast("string")))


def depth_of(member) -> Column:
    """the depth number of ``{v}_sl{n}``; NULL for flat members."""
    d = F.regexp_extract(col(member), r"_sl(\d+)$", 1)
    return F.when(d == "", F.lit(None).cast("int")).otherwise(d.cast("int"))
