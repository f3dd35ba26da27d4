"""Distributed positions and exact medians (B4, F5, D6) without sorting or moving whole rows.

Positions: rows are stored once as they come, with a row number of their own; only the sort
columns and that number are range-partitioned, sorted and counted, and the positions are joined
back. So an expensive input (clipped polygons, say) is computed once, and its wide columns never
travel through the sort (range partitioning reads its input twice: a sample, then the data).

Medians: a quantile sketch names two values around the middle, one aggregate counts the rows
below, at and between them, and only the rows between are looked at again, until few are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hydroframe.session import stored

_LOW_BITS = 33  # monotonically_increasing_id: partition index << 33 | row position
SLICE_ROWS = 50_000       # values around the middle that the driver may sort
SKETCH_ACCURACY = 10_000  # of the quantile sketch: its rank error is 1 / accuracy


def sequential_id(df: DataFrame, order_cols: list[str], id_col: str, start: int = 0) -> DataFrame:
    """Add ``id_col`` = ``start`` + rank of the row in ``order_cols`` order.

    Rows equal in ``order_cols`` are ordered by a hash of the whole row, then as they were
    scanned. Range partitioning cannot split equal sort keys; with a row-unique key a value held
    by a third of the rows is spread over many range partitions instead of landing in one task.
    """
    rows = stored(df.withColumns({"_h": F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]),
                                  "_row": F.monotonically_increasing_id()}), "rows")
    keys = rows.select(*order_cols, "_h", "_row").orderBy(*order_cols, "_h", "_row")
    mid = F.monotonically_increasing_id()
    numbered = stored(keys.select("_row", F.shiftright(mid, _LOW_BITS).alias("_pid"),
                                  mid.bitwiseAND(F.lit((1 << _LOW_BITS) - 1)).alias("_pos")), "positions")
    # One row per partition: size bounded by the partition count, broadcast is safe.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (numbered.groupBy("_pid").agg(F.count("*").alias("_n"))
               .select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    place = (numbered.join(F.broadcast(offsets), "_pid")
             .select("_row", (F.col("_off") + F.col("_pos") + F.lit(start)).cast("bigint").alias(id_col)))
    return rows.join(place, "_row").drop("_row", "_h")


def _bracket(v, rank: int, n: int):
    """Two values of the column, from a quantile sketch, that likely enclose the rank."""
    q, slack = (rank + 0.5) / n, 2.0 / SKETCH_ACCURACY
    return F.percentile_approx(v, [max(0.0, q - slack), min(1.0, q + slack)], SKETCH_ACCURACY)


def value_at_rank(df: DataFrame, value_col: str, rank: int, n: int, slice_rows: int = SLICE_ROWS,
                  bracket: list[float] | None = None) -> float:
    """The value with ``rank`` (from 0) among the ``n`` values that are present, exactly.

    Each round narrows an open interval that holds the rank. Values at its ends are counted apart,
    so ties in any number, even of a third of the rows, end the search instead of filling a slice.
    Every round is one aggregate; the interval is a condition inside it and no filter, which
    would be pushed below the projection and copy the column's expression. ``bracket`` are two
    values to begin with, if the caller knows them.
    """
    c = F.col(value_col)
    above, below, offset, inside = None, None, 0, n

    def part():
        keep = F.lit(True)
        if above is not None:
            keep &= c > F.lit(above)
        if below is not None:
            keep &= c < F.lit(below)
        return F.when(keep, c)

    while inside > slice_rows:
        v, k = part(), rank - offset
        lo, hi = bracket or df.agg(_bracket(v, k, inside)).first()[0]
        bracket = None
        less, at_lo, mid, at_hi = df.agg(F.count_if(v < lo), F.count_if(v == lo), F.count_if((v > lo) & (v < hi)),
                                         F.count_if((v == hi) & F.lit(hi > lo))).first()
        if k < less:                       # the sketch missed: the rank lies below its bracket
            below, inside = lo, less
        elif k < less + at_lo:
            return lo
        elif k < less + at_lo + mid:
            above, below, offset, inside = lo, hi, offset + less + at_lo, mid
        elif k < less + at_lo + mid + at_hi:
            return hi
        else:
            above, offset, inside = hi, offset + less + at_lo + mid + at_hi, inside - less - at_lo - mid - at_hi
    values = sorted(df.agg(F.collect_list(part())).first()[0])  # at most slice_rows
    return values[rank - offset]


def exact_medians(df: DataFrame, value_cols: list[str], slice_rows: int = SLICE_ROWS) -> dict[str, float | None]:
    """The exact (interpolated) median of each numeric column; missing values are left out.

    Only aggregates run over the whole column: nothing is sorted but the slice in the middle.
    """
    clean = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in value_cols])
    first = clean.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(value_cols)],
                      *[_bracket(F.col(c), 1, 3).alias(f"b{i}") for i, c in enumerate(value_cols)]).first()
    medians: dict[str, float | None] = {}
    for i, name in enumerate(value_cols):
        n, c = first[f"n{i}"], F.col(name)
        if n == 0:
            medians[name] = None
            continue
        low = value_at_rank(clean, name, (n - 1) // 2, n, slice_rows, first[f"b{i}"])
        if n % 2 == 0:  # the upper middle value: the same, or the next larger one
            upto, larger = clean.agg(F.count_if(c <= low), F.min(F.when(c > low, c))).first()
            medians[name] = low if n // 2 < upto else (low + larger) / 2
        else:
            medians[name] = low
    return medians


def exact_median(df: DataFrame, value_col: str, alias: str = "median") -> DataFrame:
    """``exact_medians`` of one column as a table of one row."""
    return df.sparkSession.createDataFrame([(exact_medians(df, [value_col])[value_col],)], f"{alias} double")
