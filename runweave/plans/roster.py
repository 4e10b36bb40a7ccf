"""Samples of each run: from the read files, or from the start sheet in auto mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runweave.config import FASTQ_SUFFIX, JobConfig
from runweave.functions.sample_key import parse_sample_key
from runweave.functions.text import path_component
from runweave.operators.events import check_events, events
from runweave.operators.guards import exactly_one
from runweave.plans.result import Result
from runweave.sources.delimited import cell, delimited_rows, has_columns
from runweave.sources.tables import RunTables


def sample_of_fastq(name: Column) -> Column:
    """Paired files drop everything from the last underscore on, others only the suffix."""
    paired = F.contains(name, F.lit("_1" + FASTQ_SUFFIX)) | F.contains(name, F.lit("_2" + FASTQ_SUFFIX))
    return F.when(paired, F.regexp_replace(name, "_[^_]*$", "")).otherwise(
        F.replace(name, F.lit(FASTQ_SUFFIX), F.lit(""))
    )


def fastq_samples(tables: RunTables) -> DataFrame:
    """Distinct (run, sample) of the read files; their content is never looked at."""
    return tables.files("fastq").select("run", sample_of_fastq(F.col("name")).alias("sample")).distinct()


def sheet_samples(tables: RunTables) -> Result:
    """(run, sample, roster_pos) of the start sheet of runs that have exactly one."""
    listed = exactly_one(tables.files("start_sheet"), ["run"], "path", roster=tables.runs)
    parsed = tables.parsed("start_sheet").withColumn(
        "problem", F.coalesce("problem", F.when(~has_columns("ID"), "no ID column"))
    )
    used = parsed.join(listed.where("reason = 'one'").select("run"), "run", "left_semi")
    rows = delimited_rows(used).select("run", cell("ID").alias("sample"), F.col("pos").alias("roster_pos"))
    found = rows.where("sample is not null").groupBy("run", "sample").agg(
        F.min("roster_pos").alias("roster_pos"), F.count(F.lit(1)).alias("_n")
    )
    missed = listed.where("reason <> 'one'")
    kind = F.when(F.col("reason") == "none", "no_files_found").otherwise("multiple_files_found")
    return Result(found.drop("_n"), lambda: [
        events(missed, kind, file_count="n", pattern=F.lit("*start_samplesheet.csv")),
        events(missed, "start_samplesheet_not_found"),
        events(used.where("problem is not null"), "samplesheet_read_error", path="path", error="problem"),
        events(found.where("_n > 1"), "duplicate_key", "sample", source=F.lit("start_sheet"), n="_n"),
    ])


def roster(tables: RunTables, config: JobConfig) -> Result:
    """(run, sample, roster_pos, FastQID, CID, Plate, Index, Well, Run), one row per run and sample."""
    if config.auto_mode:
        source = sheet_samples(tables)
    else:
        source = Result(fastq_samples(tables).withColumn("roster_pos", F.lit(0).cast("bigint")))
    rows = source.rows.select(
        "run", "sample", "roster_pos",
        F.col("sample").alias("FastQID"),
        parse_sample_key(F.col("sample")).alias("_key"),
        path_component(F.col("run"), -3).alias("Run_"),
    ).select("run", "sample", "roster_pos", "FastQID", "_key.*", "Run_")
    counts = tables.runs.join(source.rows.groupBy("run").agg(F.count(F.lit(1)).alias("_n")), "run", "left")
    counts = counts.select("run", F.coalesce("_n", F.lit(0)).alias("n"))
    origin = "start_samplesheet" if config.auto_mode else "fastq_directory"
    return Result(rows, lambda: [
        *source.events(),
        check_events(counts, [
            (F.lit(True), "samples_collected", {"sample_count": "n", "source": F.lit(origin)}),
            (F.col("n") == 0, "no_samples_found", {}),
            (path_component(F.col("run"), -3).isNull(), "run_name_extraction_failed", {}),
        ]),
    ])
