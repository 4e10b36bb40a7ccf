"""Left joins with defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runweave.operators.topk import quoted


def left_join_default(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    defaults: Mapping[str, object] | None = None,
    on_duplicate: str = "unique",
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Left join with at most one right row per key; defaults fill the columns of keys not found.

    A null inside a found row stays null. on_duplicate says what several right rows of a key mean:
    'unique'  the caller knows there are none (the right side is an aggregate on the key)
    'dedupe'  the row with the lowest `order` columns is taken
    'error'   the job fails
    'fanout'  the row is taken once and `n_copies` counts the rows a plain join would give: right
              rows times equal left rows. The copies are never made.

    Spark picks the strategy: a side whose measured size is under the broadcast threshold is
    broadcast, others are shuffled, with skewed left partitions split by AQE.
    """
    keys, defaults = list(on), dict(defaults or {})
    rest = [c for c in right.columns if c not in keys]
    if on_duplicate == "unique":
        single = right.withColumn("_hit", F.lit(True)) if defaults else right
    else:
        rank = F.struct(*map(quoted, order or rest)) if (order or rest) else F.lit(1)
        row = F.struct(*map(quoted, rest)) if rest else F.struct(F.lit(1).alias("_one"))
        grouped = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min_by(row, rank).alias("_row"))
        if on_duplicate == "error":
            message = F.concat(F.lit("duplicate key "), F.to_json(F.struct(*map(quoted, keys))))
            single_row = F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(True)
            grouped = grouped.where(single_row)
        hit = F.col("_n") > 0
        single = grouped.select(
            *keys, "_n", *(F.col("_row").getField(c).alias(c) for c in rest), hit.alias("_hit")
        )
    if on_duplicate == "fanout":
        copies = left.groupBy(*left.columns).agg(F.count(F.lit(1)).alias("_m"))
        joined = copies.join(single, keys, "left")
    else:
        joined = left.join(single, keys, "left")

    if on_duplicate == "fanout":
        joined = joined.withColumn("n_copies", F.col("_m") * F.coalesce("_n", F.lit(1)))
    if defaults:
        joined = joined.withColumns({
            c: F.when(F.col("_hit"), quoted(c)).otherwise(F.lit(v).cast(right.schema[c].dataType))
            for c, v in defaults.items()
        })
    return joined.drop("_hit", "_n", "_m")
