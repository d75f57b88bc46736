"""Exact sums of whole numbers of any size, added up by Spark.

A number travels as limbs of ``LIMB_BITS`` bits, ``(key, limb, value)`` with
value a long; sums of limbs stay far from the end of a long, and the driver
puts the few summed limbs of a key together again.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMB_BITS = 30
_MASK = (1 << LIMB_BITS) - 1

#: DDL of the parts of numbers within an Arrow or SQL row.
PARTS = "array<struct<key:int,limb:int,value:bigint>>"


def parts(numbers: Iterable[tuple[int, int]]) -> list[dict]:
    """Limbs of (key, number) pairs; the sign goes with every limb; zero has none."""
    out = []
    for key, number in numbers:
        number, sign = (number, 1) if number >= 0 else (-number, -1)
        limb = 0
        while number:
            if number & _MASK:
                out.append({"key": key, "limb": limb, "value": sign * (number & _MASK)})
            number >>= LIMB_BITS
            limb += 1
    return out


def total(rows: DataFrame, column: str, by: list[str] | None = None) -> dict:
    """Sums of ``column`` (PARTS) per key, or per (by..., key), as Python integers.

    One row per key and limb reaches the driver, whatever the number of rows.
    """
    by = by or []
    flat = rows.select(*by, F.explode(column).alias("p")).select(*by, "p.key", "p.limb", "p.value")
    out: dict = defaultdict(int)
    for row in flat.groupBy(*by, "key", "limb").agg(F.sum("value").alias("value")).collect():
        at = tuple(row[b] for b in by) + (row["key"],) if by else row["key"]
        out[at] += row["value"] << (LIMB_BITS * row["limb"])
    return out
