"""The tables every job reads: runs, file listing, file texts and parsed texts.

They come either from a live scan of the run folders or from landed Parquet copies.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runweave.config import CONTENT_SOURCES
from runweave.sources import landings
from runweave.sources.content import read_texts, whole_logs
from runweave.sources.delimited import HEADERLESS, SEPARATORS, parse_source
from runweave.sources.run_files import LISTING, TEXTS, folders, run_files
from runweave.sources.task_log import dataset_files

PARSED = ("run string, source string, path string, folder string, name string, pos bigint, problem string, "
          "header array<string>, records array<array<string>>")
LANDED = {"listing": LISTING, "texts": TEXTS, "parsed": PARSED}


@dataclass(frozen=True)
class RunTables:
    runs: DataFrame     # run, present
    listing: DataFrame  # run, source, path, folder, name, is_dir, length
    texts: DataFrame    # run, source, path, folder, name, pos, content, problem
    known: DataFrame | None = None  # the delimited texts parsed before: header and records in place of content

    def files(self, *sources: str) -> DataFrame:
        return self.listing.where(F.col("source").isin(*sources))

    def read(self, source: str) -> DataFrame:
        """The texts of one source."""
        return self.texts.where(F.col("source") == source)

    def parsed(self, source: str) -> DataFrame:
        """The texts of one delimited source, parsed: header, records and `problem`. What was parsed before is read."""
        if self.known is not None:
            return self.known.where(F.col("source") == source)
        return parse_source(self.read(source), source)


@dataclass(frozen=True)
class LiveTables(RunTables):
    """Run folders read at each use: only the folders and files of the sources at hand are listed and opened."""

    names: tuple[str, ...] = ()

    def _load(self, content: bool, *sources: str) -> DataFrame:
        found = run_files(self.runs.sparkSession, self.names, content, push="source")
        return found.where(F.col("source").isin(*sources))

    def files(self, *sources: str) -> DataFrame:
        return self._load(False, *sources)

    def read(self, source: str) -> DataFrame:
        if source == "linked_datasets":
            return _linked(self.read("task_log"), self.files("task_log").where(~F.col("is_dir")))
        return self._load(True, source)


def parsed_texts(texts: DataFrame) -> DataFrame:
    """All delimited texts, each parsed once: what rows and events of every job are taken from."""
    return union_all([parse_source(texts.where(F.col("source").isin(*group)), group[0]) for group in parse_groups()])


def parse_groups() -> list[list[str]]:
    """Sources that are parsed alike."""
    groups: dict[tuple, list[str]] = {}
    for source, sep in SEPARATORS.items():
        groups.setdefault((sep, source in HEADERLESS), []).append(source)
    return list(groups.values())


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def as_runs(spark: SparkSession, runs: DataFrame | str | Iterable[str]) -> DataFrame:
    """Run folders as a table; `run` is the folder path without trailing slashes."""
    if not isinstance(runs, DataFrame):
        paths = [runs] if isinstance(runs, str) else list(runs)
        runs = spark.createDataFrame([(p,) for p in paths], "run string")
    found = runs.select(F.rtrim("run", F.lit("/")).alias("run")).distinct()
    return found.withColumn("present", F.lit(True))


def _linked(texts_of_logs: DataFrame, logs: DataFrame) -> DataFrame:
    return read_texts(dataset_files(texts_of_logs, logs))


def scan_runs(spark: SparkSession, runs: DataFrame | str | Iterable[str]) -> RunTables:
    """Live scan: list the run folders and read the small files on the executors, at every use.

    For more than a handful of runs use land_runs, which lists, reads and parses once.
    """
    table = as_runs(spark, runs)
    names = folders(table)
    listing, texts = run_files(spark, names, push=""), run_files(spark, names, content=True, push="")
    logs = F.col("source") == "task_log"
    linked = _linked(texts.where(logs), listing.where(logs & ~F.col("is_dir")))
    return LiveTables(table, listing, texts.unionByName(linked), names=tuple(names))


def _land(spark: SparkSession, target: str, runs: DataFrame, listing: DataFrame, texts) -> RunTables:
    """Writes the tables of a landing, each text parsed once, and names its runs. texts(listing) gives the texts."""
    landing = landings.new_landing()

    def written(df: DataFrame, name: str) -> DataFrame:
        landings.write(df, target, name, landing, ("run", "source"))
        return spark.read.schema(LANDED[name]).parquet(f"{target}/{name}/landing={landing}")

    found = written(texts(written(listing, "listing")), "texts")
    written(parsed_texts(found), "parsed")
    landings.commit(runs, target, landing)
    return load_runs(spark, target, runs)


def land_runs(spark: SparkSession, runs: DataFrame | str | Iterable[str], target: str) -> RunTables:
    """List, read and parse once and keep the tables as Parquet, replacing only the runs at hand, and these at once."""
    table = as_runs(spark, runs)

    def texts(listing: DataFrame) -> DataFrame:
        files = listing.where(F.col("source").isin(*CONTENT_SOURCES) & ~F.col("is_dir"))
        logs = files.where(F.col("source") == "task_log")
        return whole_logs(read_texts(files)).unionByName(_linked(whole_logs(read_texts(logs)), logs))

    return _land(spark, target, table, run_files(spark, folders(table)), texts)


def land_tables(tables: RunTables, target: str) -> RunTables:
    """The same for run tables that come from elsewhere than run folders."""
    return _land(tables.runs.sparkSession, target, tables.runs, tables.listing, lambda _: tables.texts)


def load_runs(spark: SparkSession, target: str, runs: DataFrame | None = None) -> RunTables:
    """The landed tables as of now, of all runs or of some."""
    now = landings.current(spark, target)
    if runs is not None:
        now = now.join(runs.select("run").distinct(), "run", "left_semi")
    listing, texts, parsed = (landings.rows_of(now, target, name, schema) for name, schema in LANDED.items())
    return RunTables(now.select("run", F.lit(True).alias("present")), listing, texts, parsed)
