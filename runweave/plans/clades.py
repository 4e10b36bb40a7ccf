"""Best clade row per sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runweave.config import DATASET_PROCESS, UNKNOWN_DATASET, JobConfig
from runweave.functions.text import na_to_null, to_double, token_at
from runweave.operators.align import map_columns, override_column, shown_names, widen_maps
from runweave.operators.events import check_events, counted, counted_events, events, found_by, reject_events
from runweave.operators.guards import exactly_one
from runweave.operators.joins import left_join_default
from runweave.operators.topk import first_match, top1_per_group
from runweave.plans.result import Result
from runweave.sources.delimited import (
    cell, column_index, compute_once, has_columns, header_names, headerless_rows, row_at,
)
from runweave.sources.tables import RunTables
from runweave.sources.task_log import process_dirs

_DATASET_COLUMNS = ["sample_name", "nextclade_dataset_name", "nextclade_dataset_version", "nextclade_filename"]
_WIDE_KEYS = ["run", "path", "sample", "segment", "dataset", "nextclade_dataset_name", "nextclade_dataset_version"]
_NEEDED = ("seqName", "clade", "alignmentScore")


def dataset_versions(tables: RunTables) -> Result:
    """(run, pos, dataset columns): the table the task log points to, else the published one."""
    linked = tables.parsed("linked_datasets")
    present = linked.where("problem is null")
    published = tables.parsed("dataset_versions").join(present.select("run").distinct(), "run", "left_anti")
    used = present.unionByName(published)
    rows = headerless_rows(used.where("problem is null"), _DATASET_COLUMNS)
    rows = rows.where("nextclade_filename is not null").select("run", "pos", *_DATASET_COLUMNS)

    def found() -> list[DataFrame]:
        logs = exactly_one(tables.files("task_log"), ["run"], "path", roster=tables.runs)
        single = logs.where("reason = 'one'").select("run", F.col("value").alias("path"))
        process = first_match(
            process_dirs(tables.read("task_log")), ["run", "path"], "process", "workdir", "first_seen", DATASET_PROCESS
        )
        no_process = single.join(process.select("run", "path"), ["run", "path"], "left_anti")
        used_runs = used.where("problem is null").select("run").distinct()
        without = tables.runs.join(used_runs, "run", "left_anti")
        repeated = rows.groupBy("run", "nextclade_filename").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        lost, always = F.col("problem") == "missing", F.lit(True)
        return [
            check_events(logs.where("reason <> 'one'"), [
                (F.col("reason") == "none", "no_files_found", {"pattern": F.lit("*nextflow.log")}),
                (F.col("reason") == "multiple", "multiple_files_found", {"file_count": "n"}),
                (always, "nextflow_log_not_found", {}),
                (always, "publish_nc_datasets_failed_file_missing", {}),
            ]),
            check_events(no_process, [
                (always, "agg_nextclade_tsv_process_not_found", {"path": "path"}),
                (always, "publish_nc_datasets_failed_no_process", {"path": "path"}),
            ]),
            check_events(linked, [
                (lost, "nc_datasets_not_found_in_work_dir", {"path": "path"}),
                (lost, "publish_nc_datasets_failed_file_missing", {"path": "path"}),
            ]),
            check_events(without, [
                (always, "nextclade_datasets_file_not_found", {}),
                (always, "no_nextclade_datasets_data", {}),
            ]),
            events(used.where("problem is not null"), "nextclade_datasets_read_error", path="path", error="problem"),
            events(repeated, "duplicate_key", source=F.lit("dataset_versions"), key="nextclade_filename", n="n"),
        ]

    return Result(rows, found)


def _parsed(tables: RunTables) -> DataFrame:
    return tables.parsed("clades")


def _with_best_record(files: DataFrame, ha_only: bool) -> DataFrame:
    """Adds, per file, whether it is `usable`, the number of candidate records and the position of the best scored one.

    A file is one row here, so this needs no shuffle; of equal scores the first record wins.
    """
    indexed = compute_once(
        files, _seq=column_index("seqName"), _clade=column_index("clade"), _score=column_index("alignmentScore")
    )

    def candidate(record, i):
        wanted = na_to_null(F.get(record, F.col("_clade"))).isNotNull()
        if ha_only:
            wanted &= token_at(F.get(record, F.col("_seq")), "_", -1) == "HA"
        score = to_double(na_to_null(F.get(record, F.col("_score"))))
        return F.when(wanted, F.struct(score.alias("score"), (-i).alias("before")))

    usable = F.col("problem").isNull() & (F.least("_seq", "_clade", "_score") >= 0)
    listed = compute_once(indexed.withColumn("usable", usable), (
        "_clade", "_score"), _found=F.when(F.col("usable"), F.array_compact(F.transform("records", candidate))))
    best = F.array_max(F.filter("_found", lambda c: c["score"].isNotNull()))
    return compute_once(listed, ("_found",), n_candidates=F.size("_found"), best=-best["before"])


def clade_facts(tables: RunTables, config: JobConfig) -> DataFrame:
    """(run, folder, sample, good, found, n): what events and rolled-up facts need of the files, from one parse.

    `sample` is that of the best record, null without one; `found` has the events of the file, whose path is in them.
    """
    files = _with_best_record(_parsed(tables), config.ha_only)
    seq_name = na_to_null(F.get(F.get("records", F.col("best")), F.col("_seq")))
    found = found_by([
        (F.col("problem").isNotNull(), "tsv_file_read_failed", {"path": "path", "error": "problem"}),
        (F.col("problem").isNull() & ~F.col("usable"), "nextclade_file_read_error",
         {"path": "path", "error": F.lit("column missing")}),
        ((F.col("n_candidates") > 0) & F.col("best").isNull(), "nextclade_file_read_error",
         {"path": "path", "error": F.lit("no score")}),
    ])
    return counted(files.select(
        "run", "folder", token_at(seq_name, "_", 0).alias("sample"), F.col("usable").alias("good"),
        found.alias("found")))


def repeated_clades(tables: RunTables, config: JobConfig) -> DataFrame:
    """(run, sample, n) of samples that have a best row in several folders."""
    rows = clade_facts(tables, config).where("sample is not null").select("run", "folder", "sample").distinct()
    return rows.groupBy("run", "sample").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def best_clades(tables: RunTables, config: JobConfig) -> Result:
    """(run, folder, path, sample, segment, dataset, clade, cells, dataset name and version).

    First the best scored row of each file, over all samples in it; then, within a folder, the best
    of these per sample. One bad file costs only itself.
    """
    files = _with_best_record(_parsed(tables), config.ha_only)
    per_file = row_at(files.where("best is not null"), F.col("best")).select(
        "run", "folder", "path", "name", "cells",
        token_at(cell("seqName"), "_", 0).alias("sample"),
        token_at(cell("seqName"), "_", -1).alias("segment"),
        cell("clade").alias("clade"),
        cell("legacy-clade").alias("legacy-clade"),
        to_double(cell("alignmentScore")).alias("score"),
    )
    best = top1_per_group(
        per_file.where("sample is not null"), ["run", "folder", "sample"], "score", ["path"]
    )
    datasets = dataset_versions(tables)
    lookup = datasets.rows.select(
        "run", F.col("nextclade_filename").alias("name"), "pos",
        "nextclade_dataset_name", "nextclade_dataset_version",
    )
    shown = ["nextclade_dataset_name", "nextclade_dataset_version"]
    best = left_join_default(
        best, lookup, ["run", "name"], dict.fromkeys(shown, UNKNOWN_DATASET),
        on_duplicate="dedupe", order=["pos"],
    )
    best = override_column(best, "clade", "legacy-clade", config.legacy_clade).select(
        "run", "folder", "path", "sample", "segment",
        F.col("nextclade_dataset_name").alias("dataset"), "clade", "cells", *shown,
    )

    def found() -> list[DataFrame]:
        facts = clade_facts(tables, config)
        per_folder = facts.groupBy("run", "folder").agg(F.max("good").alias("any_good"))
        folders = tables.files("clade_dir").where("is_dir").select("run", F.col("name").alias("folder"))
        state = folders.join(per_folder, ["run", "folder"], "left")
        return [
            *datasets.events(),
            counted_events(facts.withColumn("sample", F.lit(None))),
            check_events(state, [
                (F.col("any_good").isNull(), "no_nextclade_tsv_files_found", {"folder": "folder"}),
                (~F.col("any_good"), "no_valid_dataframes_collected", {"folder": "folder"}),
            ], "folder"),
            reject_events(tables.runs, facts.where("good"), ["run"], "no_valid_nextclade_dataframes_collected"),
        ]

    return Result(best, found)


def wide_clades(tables: RunTables, config: JobConfig, best: DataFrame) -> DataFrame:
    """The best rows with all columns of all files, in the order the columns first appear.

    `segment` and `dataset` stand before `clade`, the sample first; columns that only later files
    have follow the dataset columns.
    """
    names = _clade_names(tables)
    wide = widen_maps(best, "cells", names, _WIDE_KEYS, na_to_null)
    shown = shown_names(names, _WIDE_KEYS)
    if config.legacy_clade and "legacy-clade" in names:
        wide = override_column(wide, shown["clade"], shown["legacy-clade"], True)
    order = ["run", "path", "sample"]
    for n in names:
        order += ["segment", "dataset", shown[n]] if n == "clade" else [shown[n]]
    order += [c for c in wide.columns if c not in order]
    return wide.select(*(F.col(f"`{c}`") for c in order))


def _clade_names(tables: RunTables) -> list[str]:
    good = _parsed(tables).where(F.col("problem").isNull() & has_columns(*_NEEDED))
    return [n for n in map_columns(header_names(good, ["run"])) if n not in ("index", "sample")]


def renamed_columns(tables: RunTables) -> list[tuple[str, str]]:
    """(column of the files, column of the table) of the names that the wide table has to change."""
    return [(name, shown) for name, shown in shown_names(_clade_names(tables), _WIDE_KEYS).items() if name != shown]
