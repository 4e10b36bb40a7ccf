"""Column functions on sequences and percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A percentage 100 - x of two doubles is a whole multiple of 2**-47, so scaling by 2**47 loses nothing.
_SCALE = 1 << 47


def round_percent(col: Column) -> Column:
    """Round 100 - x (0..100) to two places by its exact binary value, ties to even.

    SQL round works on the shortest decimal text (2.675 -> 2.68); the binary value of 2.675 lies
    below the tie, and correct rounding gives 2.67. Done here in whole numbers, so it is exact.
    """
    scaled = (col * F.lit(float(_SCALE))).cast("bigint") * F.lit(100)
    low = F.shiftright(scaled, 47)
    rest = scaled - F.shiftleft(low, 47)
    half = F.lit(_SCALE // 2)
    up = (rest > half) | ((rest == half) & (low % 2 == 1))
    return (low + up.cast("bigint")) / F.lit(100.0)


def fraction_called(seq: Column, missing: str = "Nn") -> Column:
    """Percent of letters that are not the missing letter; null for an empty sequence."""
    # no CASE around it: the count is then worked out once, as a common subexpression
    n = F.length(seq)
    kept = seq
    for letter in missing:
        kept = F.replace(kept, F.lit(letter), F.lit(""))
    return round_percent(F.lit(100.0) - (n - F.length(kept)) * F.lit(100.0) / F.nullif(n, F.lit(0)))


def threshold_flag(col: Column, limit: float) -> Column:
    """1 when strictly above the limit, else 0; null counts as 0."""
    return F.coalesce((col > limit).cast("int"), F.lit(0))
