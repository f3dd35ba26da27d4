"""Order-free content digests of outputs (K8, B7): two tables agree when their digests agree.

Every value is brought to a canonical text that does not depend on the engine (numbers to a fixed
count of decimals, times to microseconds), hashed, and the hashes of a column are summed and
xor-ed. Both are commutative, so partitions, files and row order do not matter, and partial
aggregates leave one row per task. A row digest over all columns ties the values of a row
together (a hash of the xor of its values' hashes), so values that change places between rows do
not go unnoticed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DECIMALS = 6
HEX_DIGITS = 15  # of the hash of a value: 60 bits
WHOLE_ROW = "*"


def canonical_text(c: Column, kind: T.DataType, decimals: int = DECIMALS) -> Column:
    """A value as text, the same for equal values whatever their type's width; NULL stays NULL."""
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        d = c.cast("double")
        whole = F.round(d * F.lit(10.0 ** decimals)).try_cast("decimal(38,0)").cast("string")
        return F.coalesce(whole, d.cast("string"))  # NaN, infinities and what is too large as they are
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("string")
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.to_json(c)
    return F.hex(c) if isinstance(kind, T.BinaryType) else c.cast("string")


def _hash(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, HEX_DIGITS), 16, 10).cast("bigint")


def content_digest(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    """(column, n_rows, n_values, hash_sum, hash_xor): a row per column and one for whole rows (``*``).

    NULLs are counted by ``n_rows - n_values``. An empty table has n_rows 0 and empty digests.
    """
    names = df.columns
    text = df.select(*[canonical_text(F.col(f"`{f.name}`"), f.dataType, decimals).alias(f"_t{i}") for i, f in enumerate(df.schema)])
    hashes = [_hash(F.col(f"_t{i}")).alias(f"_h{i}") for i in range(len(names))]
    hashed = text.select(*hashes)
    row = F.lit(0).cast("bigint")
    for i in range(len(names)):
        row = row.bitwiseXOR(F.coalesce(f"_h{i}", F.lit(0).cast("bigint")))
    hashed = hashed.select("*", _hash(row.cast("string")).alias("_row"))
    aggs = []
    for i in [*range(len(names)), "row"]:
        h = F.col("_row" if i == "row" else f"_h{i}")
        aggs += [F.count(h).alias(f"_n{i}"), F.sum(h.cast("decimal(38,0)")).cast("string").alias(f"_s{i}"), F.bit_xor(h).alias(f"_x{i}")]
    one = hashed.agg(F.count("*").alias("_rows"), *aggs)
    rows = [F.struct(F.lit(name).alias("column"), F.col("_rows").alias("n_rows"), F.col(f"_n{i}").alias("n_values"),
                     F.col(f"_s{i}").alias("hash_sum"), F.col(f"_x{i}").alias("hash_xor"))
            for i, name in [*enumerate(names), ("row", WHOLE_ROW)]]
    return one.select(F.inline(F.array(*rows)))


def differing_columns(left: DataFrame, right: DataFrame) -> DataFrame:
    """The columns whose digests differ or that only one side has (``content_digest`` tables)."""
    keys = ["n_rows", "n_values", "hash_sum", "hash_xor"]
    a = left.select("column", F.struct(*keys).alias("a"))
    b = right.select("column", F.struct(*keys).alias("b"))
    return a.join(b, "column", "full_outer").filter(~F.col("a").eqNullSafe(F.col("b"))).select("column")
