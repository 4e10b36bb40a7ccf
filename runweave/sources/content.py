"""Reading files whole whose paths are rows of a table: landed listings, and tables that a task log points to.

The paths stay a table: nothing is opened by the driver, and a file that is missing or not UTF-8 gives a row with a
`problem`. Task logs, the only long files of a run, are read in parts by several tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runweave.sources.run_files import TEXTS, read_text

_BATCH_BYTES = 32 << 20
#: Bytes of a task log that one task reads.
LOG_PART = 64 << 20


def _read_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in TEXTS.split(", ")]
    for batch in batches:
        out, size = [], 0
        for run, source, path, folder, name, start, end in batch.itertuples(index=False):
            for pos, content, problem in read_text(path, source, int(start), None if end < 0 else int(end)):
                out.append((run, source, path, folder, name, pos, content, problem))
                size += len(content or "")
                if size > _BATCH_BYTES:
                    yield pd.DataFrame(out, columns=columns)
                    out, size = [], 0
        yield pd.DataFrame(out, columns=columns)


def spread(df: DataFrame, *cols: str, rounds: int = 4) -> DataFrame:
    """Spread small rows that stand for much work over a fixed, not coalesced, number of tasks.

    Of these are at least as many as any shuffle has, which is what keeps the tasks of a large job small.
    """
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism * rounds, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, *cols)


def read_texts(files: DataFrame, log_part: int = LOG_PART) -> DataFrame:
    """One row per file with its whole text; for task logs, one row per line of a finished task.

    With a column `length`, logs are read in parts of `log_part` bytes. Lines are placed by their byte position, so the
    parts need not know of each other. A log of which a part can't be read has the problem and none of its lines.
    """
    length = F.col("length") if "length" in files.columns else F.lit(None)
    starts = F.when((F.col("source") == "task_log") & (length > log_part), F.sequence(F.lit(0).cast("bigint"), length - 1, F.lit(log_part).cast("bigint")))
    parts = files.select("run", "source", "path", "folder", "name",
                         F.explode(F.coalesce(starts, F.array(F.lit(0).cast("bigint")))).alias("start"), starts.isNotNull().alias("cut"))
    parts = parts.select("run", "source", "path", "folder", "name", "start",
                         F.when(F.col("cut"), F.col("start") + log_part).otherwise(-1).alias("end"))
    return spread(parts, "path", "start").mapInPandas(_read_all, TEXTS)


def whole_logs(texts: DataFrame) -> DataFrame:
    """Without the lines of task logs of which a part could not be read; their problem stays, once."""
    logs = F.col("source") == "task_log"
    broken = texts.where(logs & F.col("problem").isNotNull()).groupBy("run", "source", "path", "folder", "name").agg(
        F.lit(0).cast("bigint").alias("pos"), F.lit(None).cast("string").alias("content"), F.min("problem").alias("problem"))
    kept = texts.where(F.col("problem").isNull() | ~logs).join(broken.select("run", "path"), ["run", "path"], "left_anti")
    return kept.select(*texts.columns).unionByName(broken)
