"""Intermediate tables in the folder that the driver and all executors share.

Long jobs cut their lineage by writing a Parquet table and reading it again. Such a table survives lost executors and
is scanned by column. The folder is the one the cluster names in spark.checkpoint.dir; only a local session without
that setting gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_of_session: dict[str, str] = {}
#: Removes the shuffle files of a query when it has ended.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Unset: a new folder in local mode (kept for the session), else an error."""
    named = spark.conf.get("spark.checkpoint.dir", "")
    if named:
        return named.rstrip("/")
    if spark.sparkContext.applicationId in _of_session:
        return _of_session[spark.sparkContext.applicationId]
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _of_session.setdefault(
        spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="runweave-"))


class Workspace:
    """The tables of one run of an operator, in a folder of their own."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.names: set[str] = set()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """`df` as a written table. A name is written once.

        What the query shuffled goes when it has ended, not when the driver next collects garbage: the table replaces it.
        """
        before = self.spark.conf.get(CLEAN_UP, "false")
        self.spark.conf.set(CLEAN_UP, "true")
        try:
            df.write.parquet(self.path(name))
        finally:
            self.spark.conf.set(CLEAN_UP, before)
        self.names.add(name)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Removes a table that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self.names.discard(name)

    def clear(self, *but: str) -> None:
        """Removes all tables but those named, when what is returned reads no other."""
        for name in sorted(self.names.difference(but)):
            self.drop(name)
