"""Carry values down ordered rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runweave.operators.topk import quoted


def with_order_range(df: DataFrame, order: str, groups: int, out: str) -> DataFrame:
    """Adds the range, out of at most groups * groups, that a row's `order` value lies in; nulls lie in the first.

    The bounds are quantiles of the whole table, taken in one pass, so the ranges hold about equally many rows however
    the values are spaced. They are found in two steps of at most `groups` comparisons each.
    """
    n = groups * groups
    shares = F.array(*(F.lit(k / n) for k in range(1, max(n, 2))))
    found = df.agg(F.array_sort(F.array_distinct(F.percentile_approx(quoted(order), shares))).alias("bounds"))
    parts = F.transform(
        F.sequence(F.lit(0), F.floor((F.greatest(F.size("bounds"), F.lit(1)) - 1) / groups).cast("int")),
        lambda k: F.slice("bounds", k * groups + 1, F.lit(groups)))
    cut = found.select(F.struct(F.transform(parts, lambda p: F.get(p, F.lit(0))).alias("first"), parts.alias("parts")))

    def below(bounds: Column) -> Column:
        return F.size(F.filter(bounds, lambda bound: bound <= quoted(order)))

    group = F.greatest(below(F.col(out)["first"]), F.lit(1)) - 1
    place = group * groups + below(F.get(F.col(out)["parts"], group))
    return df.withColumn(out, cut.scalar()).withColumn(out, F.coalesce(place, F.lit(0)))


def forward_fill(
    df: DataFrame, keys: Sequence[str], order: str, value: str, out: str, groups: int = 16
) -> DataFrame:
    """Last non-null value at or before each row, per key, by an order column of numbers or times.

    A prefix scan: the rows are cut into up to groups * groups ranges of the order column, alike for all keys. The last
    value of each key and range is a partial aggregate; it is carried over the ranges of its key, of which there are
    few; then each range is filled by itself. So a key that holds all rows is filled by many tasks. Rows of a key with
    equal order values have no order among themselves; those without one come first.
    """
    by = list(keys)
    rows = with_order_range(df, order, groups, "_part")
    seen = F.when(quoted(value).isNotNull(), F.struct(quoted(order)))
    ends = rows.groupBy(*by, "_part").agg(F.max_by(quoted(value), seen).alias("_end"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*by, "_part", F.last("_end", ignorenulls=True).over(before).alias("_carry"))
    inside = Window.partitionBy(*by, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    carried = carried.withColumnsRenamed({c: f"_key{i}" for i, c in enumerate(by)}).withColumnRenamed("_part", "_of")
    same = F.col("_part") == F.col("_of")
    for i, c in enumerate(by):
        same = same & quoted(c).eqNullSafe(F.col(f"_key{i}"))
    filled = rows.join(carried, same, "left").withColumn(
        out, F.coalesce(F.last(quoted(value), ignorenulls=True).over(inside), F.col("_carry"))
    )
    return filled.select(*map(quoted, df.columns), quoted(out))
