"""Column sets: alignment to a schema, union by name, maps to wide columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from runweave.operators.topk import quoted


def align_to(df: DataFrame, schema: StructType) -> tuple[DataFrame, list[tuple[str, str]]]:
    """The columns of the schema in its order: missing ones null, unknown ones dropped.

    The second value lists (event_type, column) for both kinds.
    """
    have = set(df.columns)
    columns = [
        (quoted(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ]
    events = [("expected_column_missing", f.name) for f in schema if f.name not in have]
    events += [("unexpected_column_found", c) for c in df.columns if c not in schema.names]
    return df.select(*columns), events


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column absent from a frame is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def map_columns(headers: DataFrame, most: int = 10_000) -> list[str]:
    """All header names in order of first appearance by path: they become columns, so there may be `most` of them."""
    first = headers.groupBy("column_name").agg(F.min(F.struct("path", "idx")).alias("at"))
    names = [r[0] for r in first.orderBy("at").select("column_name").limit(most + 1).collect()]
    if len(names) > most:
        raise ValueError(f"the files have over {most} different columns")
    return names


def shown_names(names: Sequence[str], taken: Sequence[str]) -> dict[str, str]:
    """Column names for map keys: a name equal, but for case, to a taken or an earlier one gets a numbered suffix."""
    used, out = {c.lower() for c in taken}, {}
    for name in names:
        shown, k = name, 1
        while shown.lower() in used:
            shown, k = f"{name}.{k}", k + 1
        used.add(shown.lower())
        out[name] = shown
    return out


def widen_maps(
    df: DataFrame, column: str, names: Sequence[str], keep: Sequence[str], clean: Callable[[Column], Column],
    taken: Sequence[str] = (),
) -> DataFrame:
    """One column per map key, each value passed through `clean`; named by shown_names, so no column hides another."""
    shown = shown_names(names, [*keep, *taken])
    cells = (clean(F.try_element_at(quoted(column), F.lit(n))).alias(shown[n]) for n in names)
    return df.select(*map(quoted, keep), *cells)


def override_column(df: DataFrame, target: str, source: str, enabled: bool) -> DataFrame:
    """Replace one column by another, which stays, when enabled."""
    return df.withColumn(target, quoted(source)) if enabled else df
