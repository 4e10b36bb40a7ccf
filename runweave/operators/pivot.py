"""Long to wide: one conditional partial aggregate per output column, one shuffle per operator."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runweave.operators.topk import quoted


def pivot_last_wins(
    df: DataFrame,
    keys: Sequence[str],
    dim: str,
    values: Sequence,
    measures: Sequence[str],
    order: Sequence[str],
    default=None,
    name: Callable[[object, str], str] = "{}_{}".format,
) -> DataFrame:
    """One row per key, one column per (value, measure); of several rows the highest order wins.

    Rows of equal order are told apart by their measures, so the result never depends on row order.
    """
    row = F.struct(*(quoted(c).alias(f"o{i}") for i, c in enumerate(order)), *map(quoted, measures))
    picked = [F.max(F.when(quoted(dim) == F.lit(v), row)).alias(f"_{i}") for i, v in enumerate(values)]
    wide = df.where(quoted(dim).isin(*values)).groupBy(*keys).agg(*picked)

    def out(i: int, measure: str) -> Column:
        col = F.col(f"_{i}").getField(measure)
        return col if default is None else F.coalesce(col, F.lit(default).cast(df.schema[measure].dataType))

    return wide.select(
        *keys, *(out(i, m).alias(name(v, m)) for i, v in enumerate(values) for m in measures)
    )


#: Values that one mask tells apart: the bits of a long but its sign.
_BITS = 63


def _chunks(values: Sequence) -> list[list]:
    return [list(values[low:low + _BITS]) for low in range(0, len(values), _BITS)]


def value_masks(dim: Column, values: Sequence, condition: Column | None = None) -> list[Column]:
    """For each 63 of the values a bigint with the bit of the row's value, 0 if it has another or fails the condition."""
    masks = []
    for chunk in _chunks(values):
        at = F.array_position(F.array(*map(F.lit, chunk)), dim)
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (at - 1).cast("int"))
        known = at > 0 if condition is None else (at > 0) & condition
        masks.append(F.when(known, bit).otherwise(F.lit(0).cast("bigint")))
    return masks


def membership_matrix(
    roster: DataFrame,
    sheets: DataFrame,
    keys: Sequence[str],
    dim: str,
    values: Sequence,
    scope: Sequence[str] = (),
    name: Callable[[object], str] = "status_{}".format,
) -> DataFrame:
    """Per roster key and value: 0 when the key has a sheet row of that value, else 1.

    With a scope (a part of the keys), a value without any sheet row in the scope gives null: that
    column does not exist there. A key is a bit mask of its values, put together by one hash aggregate.
    """
    masks = value_masks(quoted(dim), values)
    per_key = sheets.groupBy(*keys).agg(*(F.bit_or(m).alias(f"_in{i}") for i, m in enumerate(masks)))
    joined = roster.join(per_key, list(keys), "left")
    if scope:  # from the per-key rows, so the sheets are read and shuffled once
        joined = joined.join(per_key.groupBy(*scope).agg(*(
            F.bit_or(f"_in{i}").alias(f"_any{i}") for i in range(len(masks))
        )), list(scope), "left")

    def has(mask: str, i: int) -> Column:
        return F.getbit(F.coalesce(F.col(f"{mask}{i // _BITS}"), F.lit(0).cast("bigint")), F.lit(i % _BITS)) == 1

    def out(i: int) -> Column:
        return F.when(has("_in", i), 0).when(has("_any", i) if scope else F.lit(True), 1)

    return joined.select(*roster.columns, *(out(i).alias(name(v)) for i, v in enumerate(values)))


def first_failing_stage(
    roster: DataFrame,
    facts: DataFrame,
    stages: Mapping[object, int],
    keys: Sequence[str],
    scope: Sequence[str],
    stage: str = "stage",
    passed: str = "passed",
    out: str = "status",
) -> DataFrame:
    """Code of the first stage a roster key lacks or fails, 0 when it passes all.

    A stage without any fact in the scope (a part of the keys) is skipped there. Stages are bits: those that a key has
    passed and those that it has a fact of are put together by one hash aggregate, and what a key lacks is
    active & ~passed, whose lowest bit is the first failing stage.
    """
    names = list(stages)
    ok = value_masks(quoted(stage), names, F.coalesce(quoted(passed), F.lit(False)))
    seen = value_masks(quoted(stage), names, quoted(passed).isNotNull())
    per_key = facts.groupBy(*keys).agg(
        *(F.bit_or(m).alias(f"_ok{i}") for i, m in enumerate(ok)), *(F.bit_or(m).alias(f"_on{i}") for i, m in enumerate(seen)))
    # from the per-key rows, so the facts are read and shuffled once
    active = per_key.groupBy(*scope).agg(*(F.bit_or(f"_on{i}").alias(f"_on{i}") for i in range(len(ok))))
    passes = per_key.select(*keys, *(f"_ok{i}" for i in range(len(ok))))
    joined = roster.join(passes, list(keys), "left").join(active, list(scope), "left")

    def failed(i: int, chunk: list) -> Column:
        none = F.lit(0).cast("bigint")
        lacking = F.coalesce(F.col(f"_on{i}"), none).bitwiseAND(F.bitwise_not(F.coalesce(F.col(f"_ok{i}"), none)))
        at = F.bit_count(lacking.bitwiseAND(F.bitwise_not(lacking - 1)) - 1)
        return F.when(lacking != 0, F.element_at(F.array(*(F.lit(stages[s]) for s in chunk)), at + 1))

    codes = (failed(i, chunk) for i, chunk in enumerate(_chunks(names)))
    return joined.select(*roster.columns, F.coalesce(*codes, F.lit(0)).alias(out))
