"""Guards on the number of rows or files in a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runweave.operators.topk import quoted


def exactly_one(
    df: DataFrame, keys: Sequence[str], value: str, roster: DataFrame | None = None
) -> DataFrame:
    """(keys, value, reason, n): the value of groups with one row, else null; reason one/multiple.

    With a roster of keys, keys without any row come out with reason 'none'.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(quoted(value)).alias("value"))
    if roster is not None:
        counted = roster.select(*keys).join(counted, list(keys), "left")
    n = F.coalesce("n", F.lit(0))
    reason = F.when(n == 1, "one").when(n > 1, "multiple").otherwise("none")
    return counted.select(
        *keys, F.when(n == 1, F.col("value")).alias("value"), reason.alias("reason"), n.alias("n")
    )


def singleton_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose group has no other row."""
    rest = [c for c in df.columns if c not in keys]
    counted = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*map(quoted, rest))).alias("_row")
    )
    return counted.where("_n = 1").select(*keys, *(F.col("_row").getField(c).alias(c) for c in rest))
