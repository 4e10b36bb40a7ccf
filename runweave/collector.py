"""The jobs as one object: for users who want files out of run folders."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from runweave.config import JobConfig
from runweave.operators.events import EVENT_SCHEMA, all_events
from runweave.plans import clades, mixtures, sinks
from runweave.plans.clades import best_clades, dataset_versions, wide_clades
from runweave.plans.manifest import consensus_manifest
from runweave.plans.mixtures import wide_mixtures
from runweave.plans.roster import roster
from runweave.plans.run_events import run_events
from runweave.plans.status import pipeline_status, pipeline_status_rows
from runweave.plans.summary import run_summary
from runweave.sources.tables import RunTables, land_runs, load_runs, scan_runs


class RunCollector:
    """Summary, clade, mixture, manifest and event jobs over the same run tables."""

    def __init__(self, tables: RunTables, config: JobConfig = JobConfig(), **settings):
        self.tables = tables
        self.config = replace(config, **settings)
        self.written: list[DataFrame] = []  # one event per output written

    @classmethod
    def scan(cls, spark: SparkSession, runs: DataFrame | str | Iterable[str], **settings) -> "RunCollector":
        """Read the run folders at every job; for a few runs."""
        return cls(scan_runs(spark, runs), **settings)

    @classmethod
    def land(cls, spark: SparkSession, runs: DataFrame | str | Iterable[str], target: str, **settings):
        """Read the run folders once into Parquet tables and work on these; only the given runs."""
        landed = land_runs(spark, runs, target)
        return cls(landed, **settings)

    @classmethod
    def landed(cls, spark: SparkSession, target: str, **settings) -> "RunCollector":
        """Work on all runs landed before."""
        return cls(load_runs(spark, target), **settings)

    def summary(self) -> DataFrame:
        return run_summary(self.tables, self.config).rows

    def clades(self) -> DataFrame:
        best = best_clades(self.tables, self.config).rows
        return wide_clades(self.tables, self.config, best)

    def mixture_report(self) -> DataFrame:
        return wide_mixtures(self.tables)

    def manifest(self) -> DataFrame:
        return consensus_manifest(self.tables)

    def dataset_versions(self) -> DataFrame:
        return dataset_versions(self.tables).rows

    def pipeline_status(self) -> DataFrame:
        return pipeline_status(self.tables, self.config.pipelines).rows

    def pipeline_status_rows(self) -> DataFrame:
        return pipeline_status_rows(self.tables)

    def events(self) -> DataFrame:
        return all_events([run_events(self.tables, self.config), *self.written])

    def write_summary(self, path: str) -> int:
        probe = roster(self.tables, self.config).rows
        return self._text(self.summary(), "results_written", path, ["run_folder", "roster_pos"], probe=probe)

    def write_clades(self, path: str) -> int:
        self._renamed(clades.renamed_columns(self.tables))
        return self._text(self.clades(), "nextclade_results_written", path, ["run", "path"], sep="\t")

    def write_mixture_report(self, path: str) -> int:
        self._renamed(mixtures.renamed_columns(self.tables))
        return self._text(self.mixture_report(), "mixture_report_written", path, ["run", "path"])

    def write_manifest(self, path: str) -> int:
        return self._table(self.manifest(), "consensus_manifest_written", path)

    def write_dataset_versions(self, path: str) -> int:
        return self._table(self.dataset_versions(), "nextclade_datasets_written", path)

    def write_pipeline_status(self, path: str) -> int:
        """(run, sample, pipeline, status) rows: the form for a table that many landings are written to."""
        return self._table(self.pipeline_status_rows(), "pipeline_status_written", path)

    def write_summary_table(self, path: str) -> int:
        """In auto mode, name the status columns by `pipelines`: a table can't change its columns by landing."""
        if self.config.auto_mode and self.config.pipelines is None:
            raise ValueError("auto mode needs the setting `pipelines` for a summary table")
        return self._table(self.summary(), "results_written", path, run="run_folder")

    def _table(self, df: DataFrame, event_type: str, path: str, run: str = "run") -> int:
        rows = sinks.write_table(df, path, run, self.tables.runs)
        self.written.append(sinks.written_event(df.sparkSession, event_type, path, rows))
        return rows

    def _renamed(self, names: list[tuple[str, str]]) -> None:
        """An event for each column whose name another column has, ignoring case."""
        rows = [(None, None, "column_renamed", {"column": name, "shown": shown}) for name, shown in names]
        if rows:
            self.written.append(self.tables.runs.sparkSession.createDataFrame(rows, EVENT_SCHEMA))

    def _text(self, df: DataFrame, event_type: str, path: str, order: list[str], **options) -> int:
        rows = sinks.write_text(df, path, order, **options)
        if rows:
            self.written.append(sinks.written_event(df.sparkSession, event_type, path, rows))
        return rows
