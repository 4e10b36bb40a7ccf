"""Mixture report: the one-row mixture files of all samples, united by column name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runweave.functions.text import na_to_null
from runweave.operators.align import map_columns, shown_names, widen_maps
from runweave.operators.events import counted, counted_events, found_by, reject_events
from runweave.plans.result import Result
from runweave.sources.delimited import first_row, header_names
from runweave.sources.tables import RunTables

_SUFFIX = "_mixtures.csv"
_TAKEN = ["run", "path", "FastQID"]


def _files(tables: RunTables) -> DataFrame:
    return first_row(tables.parsed("mixtures")).withColumn(
        "sample", F.expr(f"left(name, length(name) - {len(_SUFFIX)})")
    )


def mixtures(tables: RunTables) -> Result:
    """(run, path, sample, cells) of the files with exactly one row."""
    files = _files(tables)
    good = files.where("n_records = 1")

    def found() -> list[DataFrame]:
        marked = files.select("run", "sample", (F.col("n_records") == 1).alias("good"), found_by([
            (F.col("problem").isNotNull(), "mixture_report_read_error", {"path": "path", "error": "problem"}),
            (F.col("n_records") != 1, "unexpected_mixture_report_rows", {"row_count": "n_records"}),
        ]).alias("found"))
        # files without events are counted by run
        counts = counted(marked.withColumn("sample", F.when(F.size("found") > 0, F.col("sample"))))
        return [
            counted_events(counts),
            reject_events(tables.runs, counts.where("good"), ["run"], "no_valid_mixture_reports_found"),
        ]

    return Result(good.select("run", "path", "sample", "cells"), found)


def wide_mixtures(tables: RunTables) -> DataFrame:
    """The report: all columns in order of first appearance, sample_name shown as FastQID."""
    good = _files(tables).where("n_records = 1")
    names = map_columns(header_names(good, ["run"]))
    wide = widen_maps(good, "cells", names, ["run", "path"], na_to_null, taken=["FastQID"])
    return wide.withColumnRenamed("sample_name", "FastQID")


def renamed_columns(tables: RunTables) -> list[tuple[str, str]]:
    """(column of the files, column of the report) of the names that the report has to change."""
    names = map_columns(header_names(_files(tables).where("n_records = 1"), ["run"]))
    return [(name, shown) for name, shown in shown_names(names, _TAKEN).items() if name != shown]
