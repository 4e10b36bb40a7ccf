"""Roll up newly landed runs: the summary job, started by the arrival of runs.

A run is always rolled up as a whole, so there is no state, watermark or late row: each batch names
the runs that were landed (again) and replaces their part of the summary table.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from runweave.config import JobConfig
from runweave.plans.sinks import write_table
from runweave.plans.summary import run_summary
from runweave.sources.landings import CURRENT
from runweave.sources.tables import load_runs


def progress_folder(spark: SparkSession, name: str) -> str:
    """Folder for the progress of a stream, in the shared folder the session names."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a shared folder, or pass the progress folder")
    return f"{shared.rstrip('/')}/{name}"


def follow_landed_runs(
    spark: SparkSession, landed: str, target: str, config: JobConfig = JobConfig(), progress: str | None = None
) -> StreamingQuery:
    """Summaries of all runs landed since the last call, written to `target`, to be read with `read_table`.

    In auto mode config.pipelines must name the status columns, as one table can't change its columns by batch. Each
    pair of landed tables and target has its own progress, and other settings begin anew.
    """
    if config.auto_mode and config.pipelines is None:
        raise ValueError("auto mode needs config.pipelines here: the pipelines whose status columns the table has")
    own = hashlib.md5(repr((landed.rstrip("/"), target.rstrip("/"), config)).encode()).hexdigest()[:16]
    arrivals = spark.readStream.schema(CURRENT).parquet(f"{landed}/current")
    arrivals = arrivals.where("since = landing")  # a compaction brings nothing new

    def roll_up(batch: DataFrame, _: int) -> None:
        tables = load_runs(batch.sparkSession, landed, batch.select("run").distinct())
        write_table(run_summary(tables, config).rows, target, run="run_folder", runs=tables.runs)

    return (
        arrivals.writeStream.foreachBatch(roll_up)
        .option("checkpointLocation", progress or progress_folder(spark, f"landed_runs-{own}"))
        .trigger(availableNow=True).start()
    )
