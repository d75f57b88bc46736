"""A fixed-size bitmap of keys, to drop most rows without a partner before a shuffle.

The bitmap has ``BITS`` bits whatever the number of keys: at most 256 rows of
4 KB, so it may be broadcast.  A row whose bit is set may still have no
partner; the join behind it decides.  With very many keys it drops nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize

BITS = 1 << 23


def _place(column: str) -> str:
    return f"(pmod(xxhash64({column}), {BITS}L) + 1)"


def bitmap(keys: DataFrame, key: str, name: str) -> DataFrame:
    """The written bitmap of the ``key`` values of ``keys``."""
    return materialize(keys.selectExpr(f"{_place(key)} AS _x").groupBy(F.expr("bitmap_bucket_number(_x)").alias("_bucket"))
                       .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_x))").alias("_bits")), name)


def mark_likely(df: DataFrame, column: str, bits: DataFrame, mark: str, how: str = "left") -> DataFrame:
    """``df`` with the boolean ``mark``: whether ``column`` may be among the keys of the bitmap."""
    set_bit = ("(shiftright(CAST(conv(hex(substring(_bits, CAST(_at DIV 8 AS INT) + 1, 1)), 16, 10) AS INT), "
               "CAST(_at % 8 AS INT)) & 1) = 1")
    # Never null: a null test, pushed below ``column``, would compute it a second time for every row.
    placed = df.withColumns({"_bucket": F.expr(f"coalesce(bitmap_bucket_number({_place(column)}), 0L)"),
                             "_at": F.expr(f"bitmap_bit_position({_place(column)})")})
    # At most BITS / 32768 rows of 4 KB.
    return placed.join(F.broadcast(bits), "_bucket", how).withColumn(
        mark, F.coalesce(F.expr(set_bit), F.lit(False))).drop("_bucket", "_at", "_bits")


def likely_in(df: DataFrame, column: str, keys: DataFrame, key: str, name: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` may be among the ``key`` values of ``keys``."""
    return mark_likely(df, column, bitmap(keys, key, name), "_likely", "inner").where("_likely").drop("_likely")
