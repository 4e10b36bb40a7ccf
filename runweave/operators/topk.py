"""Row picking per group, all as partial aggregates: a very large group is cut to one row per task
before the shuffle, so no task ever holds a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def pick_rows(df: DataFrame, keys: Sequence[str], order: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per group: the one with the smallest non-null order value."""
    rest = columns or [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*map(quoted, rest)), order).alias("_row"))
    return best.select(*keys, *(F.col("_row").getField(c).alias(c) for c in rest)) if rest else best.select(*keys)


def top1_per_group(df: DataFrame, keys: Sequence[str], score: str, ties: Sequence[str]) -> DataFrame:
    """The row with the highest numeric score per group; null scores are skipped, lowest ties win.

    A group without any score is left out.
    """
    scored = df.where(quoted(score).isNotNull())
    return pick_rows(scored, keys, F.struct(-quoted(score), *map(quoted, ties)))


def last_wins_map(df: DataFrame, keys: Sequence[str], name: str, value: str, order: str | Sequence[str]) -> DataFrame:
    """(keys, name, value, first_seen): the value of the last row per name and its first order value."""
    by = [order] if isinstance(order, str) else list(order)
    rank = quoted(by[0]) if len(by) == 1 else F.struct(*map(quoted, by))
    return df.groupBy(*keys, name).agg(
        F.max_by(quoted(value), rank).alias(value), F.min(quoted(by[0])).alias("first_seen")
    )


def first_match(
    df: DataFrame, keys: Sequence[str], name: str, value: str, order: str, token: str
) -> DataFrame:
    """Per group the earliest row whose name contains the token; groups without one are left out."""
    found = df.where(F.contains(quoted(name), F.lit(token)))
    return pick_rows(found, keys, F.struct(quoted(order), quoted(name)), [name, value, order])
