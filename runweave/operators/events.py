"""Data-quality events as a long table (run, sample, event_type, detail)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runweave.operators.align import union_by_name
from runweave.operators.topk import quoted

EVENT_SCHEMA = "run string, sample string, event_type string, detail map<string,string>"


def events(
    df: DataFrame,
    event_type: str | Column,
    sample: str | Column | None = None,
    run: str = "run",
    **detail: str | Column,
) -> DataFrame:
    """One event per row; details are column names or columns."""
    pairs = []
    for key, value in detail.items():
        col = quoted(value) if isinstance(value, str) else value
        pairs += [F.lit(key), col.cast("string")]
    bag = F.create_map(*pairs) if pairs else F.create_map()
    who = F.lit(None) if sample is None else quoted(sample) if isinstance(sample, str) else sample
    kind = F.lit(event_type) if isinstance(event_type, str) else event_type
    return df.select(
        quoted(run).cast("string").alias("run"), who.cast("string").alias("sample"), kind.alias("event_type"),
        bag.cast("map<string,string>").alias("detail"),
    )


Check = tuple[Column, str, dict[str, "str | Column"]]


def found_by(checks: Sequence[Check]) -> Column:
    """The (event_type, detail) of the checks that a row meets; details are (key, value) pairs, by which rows can be grouped."""
    def bag(detail: dict[str, str | Column]) -> Column:
        pairs = (
            F.struct(F.lit(key).alias("key"), (quoted(value) if isinstance(value, str) else value).cast("string").alias("value"))
            for key, value in detail.items()
        )
        return F.array(*pairs).cast("array<struct<key:string,value:string>>")

    return F.array_compact(F.array(*(
        F.when(condition, F.struct(F.lit(kind).alias("event_type"), bag(detail).alias("detail")))
        for condition, kind, detail in checks
    )))


def check_events(
    df: DataFrame, checks: Sequence[Check], sample: str | None = None, more: Column | None = None
) -> DataFrame:
    """Events of several (condition, event_type, details) checks in one pass over the rows; `more` are found otherwise."""
    who = (F.lit(None) if sample is None else quoted(sample)).cast("string")
    found = found_by(checks) if more is None else F.concat(found_by(checks), F.coalesce(more, found_by([])))
    return _with_maps(df.select("run", who.alias("sample"), F.inline(found)))


def _with_maps(found: DataFrame) -> DataFrame:
    return found.select("run", "sample", "event_type", F.map_from_entries("detail").alias("detail"))


def counted(rows: DataFrame) -> DataFrame:
    """The distinct rows and how often each comes (`n`), worked out once for all that read them.

    Spark shares a shuffle between readers whose plans are equal up to it. So the filters and the choice of columns of a
    reader must stay behind it: each column depends on a condition that is always true, takes `n` and isn't deterministic.
    """
    counts = rows.groupBy(*map(quoted, rows.columns)).agg(F.count(F.lit(1)).alias("n"))
    always = F.spark_partition_id() + F.col("n") > 0
    return counts.select(*(F.when(always, quoted(c)).alias(c) for c in counts.columns))


def counted_events(counts: DataFrame, sample: str = "sample") -> DataFrame:
    """The events in the column `found` of counted rows, each as often as its row came."""
    times = F.when(F.size("found") > 0, F.flatten(F.array_repeat("found", F.col("n").cast("int"))))
    return _with_maps(counts.select("run", quoted(sample).cast("string").alias("sample"), F.inline(times)))


def reject_events(all_rows: DataFrame, kept: DataFrame, keys: Sequence[str], event_type: str, **detail) -> DataFrame:
    """Events for the rows of `all_rows` whose key is not among `kept`.

    The kept keys are cut to one row each before the join, however often a key occurs.
    """
    lost = all_rows.join(kept.select(*keys).distinct(), list(keys), "left_anti")
    return events(lost, event_type, **detail)


def column_events(spark: SparkSession, found: Sequence[tuple[str, str]]) -> DataFrame:
    """Events of align_to: one row per column, valid for all runs (run is null)."""
    rows = [(None, None, kind, {"column": column}) for kind, column in found]
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def all_events(frames: Sequence[DataFrame]) -> DataFrame:
    return union_by_name(list(frames))
