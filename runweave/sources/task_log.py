"""Task log lines -> working folders of processes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runweave.config import COMPLETED_TASK, DATASET_FILE_IN_WORKDIR, DATASET_PROCESS
from runweave.functions.text import strip_ws
from runweave.operators.guards import exactly_one
from runweave.operators.topk import first_match, last_wins_map


def read_task_log(lines: DataFrame) -> DataFrame:
    """(run, path, line_no, process, workdir) of the finished tasks."""
    text = F.col("content")
    return lines.where(text.rlike(COMPLETED_TASK)).select(
        "run", "path",
        F.col("pos").alias("line_no"),
        strip_ws(F.regexp_extract(text, COMPLETED_TASK, 1)).alias("process"),
        strip_ws(F.regexp_extract(text, COMPLETED_TASK, 2)).alias("workdir"),
    )


def process_dirs(lines: DataFrame) -> DataFrame:
    """(run, path, process, workdir, first_seen): last working folder and first line per process."""
    return last_wins_map(read_task_log(lines), ["run", "path"], "process", "workdir", "line_no")


def dataset_files(lines: DataFrame, logs: DataFrame) -> DataFrame:
    """Per run with exactly one log: the dataset file in the folder of the first matching process."""
    log = exactly_one(logs, ["run"], "path").where("reason = 'one'").select("run", F.col("value").alias("path"))
    found = first_match(
        process_dirs(lines), ["run", "path"], "process", "workdir", "first_seen", DATASET_PROCESS
    )
    path = F.concat_ws("/", F.rtrim("workdir", F.lit("/")), F.lit(DATASET_FILE_IN_WORKDIR))
    return found.join(log, ["run", "path"], "left_semi").select(
        "run",
        F.lit("linked_datasets").alias("source"),
        path.alias("path"),
        F.element_at(F.split("workdir", "/"), -1).alias("folder"),
        F.lit(DATASET_FILE_IN_WORKDIR).alias("name"),
    )
