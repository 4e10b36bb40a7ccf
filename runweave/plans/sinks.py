"""Writing job results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from runweave.operators.events import EVENT_SCHEMA
from runweave.sources import landings


def write_table(df: DataFrame, path: str, run: str = "run", runs: DataFrame | None = None) -> int:
    """A table that is read with `read_table`; the runs at hand are replaced, all at once.

    `runs` (run): the runs at hand; those of them that have no rows any more lose their old ones. By default the runs
    that have rows. Returns the number of rows, which the written files know.
    """
    spark, landing = df.sparkSession, landings.new_landing()
    landings.write(df, path, "rows", landing, (run,))
    written = spark.read.schema(df.schema).parquet(f"{path}/rows/landing={landing}")
    landings.commit((written.select(F.col(run).alias("run")) if runs is None else runs).select("run"), path, landing)
    return written.count()


def read_table(spark: SparkSession, path: str, run: str = "run", schema: str | None = None) -> DataFrame:
    """The rows that `write_table` last wrote for each run, as of now."""
    return landings.rows_of(landings.current(spark, path), path, "rows", schema, run)


def tidy_table(spark: SparkSession, path: str, run: str = "run", keep_seconds: float = 86_400) -> list[str]:
    """Joins the landings of a table and removes those that nobody has read for `keep_seconds`; returns their names."""
    landings.compact(spark, path, {"rows": None}, run)
    return landings.vacuum(spark, path, ["rows"], keep_seconds)


def write_text(
    df: DataFrame, path: str, order: Sequence[str], sep: str = ",", probe: DataFrame | None = None
) -> int:
    """Delimited text with header, rows in order, nulls and empty texts both as nothing.

    The order columns are not written. Nothing is written when there are no rows; `probe` is a
    cheaper frame that is empty at the same time. Returns the number of rows, counted on the way.
    """
    if (df if probe is None else probe).isEmpty():
        return 0
    counted = Observation()
    shown = [c for c in df.columns if c not in order]
    # counted above the sort, whose range sampling runs what lies below it twice
    (df.orderBy(*order).select(*(F.col(f"`{c}`") for c in shown))
     .observe(counted, F.count(F.lit(1)).alias("rows"))
     .write.mode("overwrite").option("header", True).option("sep", sep)
     .option("emptyValue", "").option("nullValue", "").csv(path))
    return counted.get["rows"]


def written_event(spark: SparkSession, event_type: str, path: str, rows: int) -> DataFrame:
    """One event for an output; run and sample are null, as it covers all runs."""
    return spark.createDataFrame([(None, None, event_type, {"output": path, "rows": str(rows)})], EVENT_SCHEMA)
