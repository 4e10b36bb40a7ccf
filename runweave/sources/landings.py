"""Tables that are written landing by landing, in which each run is read from its latest one.

A landing writes its rows of all its runs into one folder of each table and, last of all, names these runs in the table
`current`. Readers take of each run only the rows of the landing named last, so a landing replaces its runs at once and
as wholes: until its last step nobody sees it, and nothing is deleted or rewritten for it. There are as many folders as
landings, not as runs; `compact` makes them one, and `vacuum` removes those that no run is read from any more.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CURRENT = "run string, since string, landing string"


def new_landing() -> str:
    """A name that sorts after those of earlier landings."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"


def write(df: DataFrame, root: str, table: str, landing: str, order: tuple[str, ...] = ("run",)) -> None:
    """The rows of a landing. REBALANCE splits those of a very large run over several files and joins small ones; in a
    file they lie in `order`, so that readers of some runs skip the pages of the others."""
    rows = df.hint("rebalance", order[0]).sortWithinPartitions(*order)
    rows.write.parquet(f"{root}/{table}/landing={landing}")


def commit(runs: DataFrame, root: str, landing: str) -> None:
    """From now on the runs are read from this landing, also those without any row in it."""
    named = runs.select(F.col("run").cast("string").alias("run")).distinct()
    if "since" in runs.columns:
        named = runs.select("run", "since")
    else:
        named = named.withColumn("since", F.lit(landing))
    named.write.parquet(f"{root}/current/landing={landing}")


def current(spark: SparkSession, root: str) -> DataFrame:
    """(run, since, landing): where the rows of each run lie, as of now; later landings don't change this frame.

    since: the landing that brought the run's present rows; another one may hold them since a compaction.
    """
    named = spark.read.schema(CURRENT).parquet(f"{root}/current")
    last = named.groupBy("run").agg(F.max(F.struct("since", "landing")).alias("last"))
    return last.select("run", "last.since", "last.landing")


def rows_of(now: DataFrame, root: str, table: str, schema: str | None = None, run: str = "run") -> DataFrame:
    """The rows of a table that the frame `now` of `current` names.

    `now` has to be made first: the files of a table are listed here, and a landing named in `now` is among them.
    """
    spark = now.sparkSession
    reader = spark.read.schema(f"{schema}, landing string") if schema else spark.read
    rows = reader.option("basePath", f"{root}/{table}").parquet(f"{root}/{table}")
    wanted = now.select(F.col("run").alias(run), "landing")
    return rows.withColumn("landing", F.col("landing").cast("string")).join(wanted, [run, "landing"], "left_semi").drop("landing")


def compact(spark: SparkSession, root: str, tables: dict[str, str | None], run: str = "run") -> str:
    """Writes what is current of the tables (name -> schema) into one landing, which from then on holds it.

    Runs keep their `since`, so a landing that began before and ends after the compaction is not lost: it is later.
    """
    now, landing = current(spark, root), new_landing()
    for table, schema in tables.items():
        write(rows_of(now, root, table, schema, run), root, table, landing, (run,))
    commit(now.select("run", "since"), root, landing)
    return landing


def vacuum(spark: SparkSession, root: str, tables: list[str], keep_seconds: float = 86_400) -> list[str]:
    """Removes the landings that no run is read from and that are older than `keep_seconds`, which is to be longer than
    any reader or landing takes. Returns their names. The driver sees the names of landings, never runs or rows."""
    used = {row.landing for row in current(spark, root).select("landing").distinct().collect()}
    jvm, gone = spark.sparkContext._jvm, set()
    oldest = f"{time.time_ns() - int(keep_seconds * 1e9):020d}"
    for table in ["current", *tables]:
        top = jvm.org.apache.hadoop.fs.Path(f"{root}/{table}")
        files = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for found in files.listStatus(top) if files.exists(top) else []:
            name = found.getPath().getName().removeprefix("landing=")
            if found.isDirectory() and name not in used and name < oldest and found.getPath().getName() != name:
                files.delete(found.getPath(), True)
                gone.add(name)
    return sorted(gone)
