"""Status codes per sample: file stages of the run and the sheets of the other pipelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runweave.config import STAGE_CODES
from runweave.functions.text import token_at
from runweave.operators.events import events, reject_events
from runweave.operators.joins import left_join_default
from runweave.operators.pivot import first_failing_stage, membership_matrix
from runweave.plans.result import Result
from runweave.plans.roster import fastq_samples, sheet_samples
from runweave.sources.delimited import cell, delimited_rows, has_columns
from runweave.sources.tables import RunTables

_KEY = ["run", "sample"]
_WHOLE_NAME = ("reference", "minimap2", "freebayes")
# fixed values: name of the file-stage status, and pattern of the sheet names
FILE_STATUS = "status_nf-flu"
_SHEET_NAME = r"(?:^|_)([^_]*)_output_samplesheet\.csv$"


def stage_facts(tables: RunTables) -> DataFrame:
    """(run, sample, stage, passed) for every artefact of the file stages."""
    name, source = F.col("name"), F.col("source")
    listed = tables.files(*(s for s in STAGE_CODES if s != "mixture")).select(
        "run",
        F.when(source.isin(*_WHOLE_NAME), name).otherwise(token_at(name, ".", 0)).alias("sample"),
        source.alias("stage"),
        F.lit(True).alias("passed"),
    )
    flags = tables.read("mixture").select(
        "run", token_at(name, "_", 0).alias("sample"), source.alias("stage"),
        F.coalesce(F.col("content") != "1", F.lit(True)).alias("passed"),
    )
    return listed.unionByName(flags)


def file_status(tables: RunTables, roster: DataFrame) -> Result:
    """Roster with the code of the first failing stage; samples without read files get 1."""
    facts = stage_facts(tables)
    active = facts.select("run", "stage").distinct()
    listed = fastq_samples(tables).join(active.select("run").distinct(), "run", "left_semi")
    codes = first_failing_stage(listed, facts, STAGE_CODES, _KEY, ["run"], out=FILE_STATUS)
    stages = tables.runs.select("run", F.explode(F.array(*map(F.lit, STAGE_CODES))).alias("stage"))
    return Result(left_join_default(roster, codes, _KEY, {FILE_STATUS: 1}), lambda: [
        reject_events(stages, active, ["run", "stage"], "no_files_found_for_stage", stage="stage"),
        reject_events(facts, fastq_samples(tables), _KEY, "artefact_without_sample", sample="sample", stage="stage"),
    ])


def pipeline_sheets(tables: RunTables) -> Result:
    """(run, sample, pipeline) of the output sheets of the other pipelines."""
    parsed = tables.parsed("output_sheet").withColumn(
        "problem", F.coalesce("problem", F.when(~has_columns("ID"), "no ID column"))
    ).withColumn("pipeline", F.regexp_extract("name", _SHEET_NAME, 1))
    named = parsed.where("pipeline <> ''")
    # file stages own the status of their pipeline; a sheet of the same name is shown apart
    own = FILE_STATUS.removeprefix("status_")
    label = F.when(F.col("pipeline") == own, F.lit(f"{own}_sheet")).otherwise(F.col("pipeline"))
    rows = delimited_rows(named).select("run", cell("ID").alias("sample"), label.alias("pipeline"))
    # a sheet without rows still gives its column, so every good sheet adds a row without sample
    headers = named.where("problem is null").select("run", F.lit(None).cast("string").alias("sample"), label.alias("pipeline"))
    return Result(rows.where("sample is not null").unionByName(headers), lambda: [
        events(parsed.where("pipeline = ''"), "samplesheet_filename_malformed", path="path"),
        events(named.where("problem is not null"), "samplesheet_read_error", path="path", error="problem"),
    ])


def pipeline_names(sheets: DataFrame, most: int = 1000) -> list[str]:
    """Distinct pipeline names: they become columns, so there may be `most` of them."""
    names = [r[0] for r in sheets.select("pipeline").distinct().orderBy("pipeline").limit(most + 1).collect()]
    if len(names) > most:
        raise ValueError(f"the sheets are of over {most} pipelines")
    return names


def pipeline_status(tables: RunTables, pipelines: Sequence[str] | None = None) -> Result:
    """(run, sample, status_{pipeline}…, status of the file stages) per start-sheet sample.

    0 when the sample is in the pipeline's sheet, else 1; null in runs without such a sheet.
    """
    sheet = sheet_samples(tables)
    roster = sheet.rows.select(*_KEY)
    sheets = pipeline_sheets(tables)
    names = list(pipelines) if pipelines is not None else pipeline_names(sheets.rows)
    with_sheets = membership_matrix(roster, sheets.rows, _KEY, "pipeline", names, ["run"]) if names else roster
    staged = file_status(tables, with_sheets)
    return Result(staged.rows, lambda: [
        *sheets.events(),
        *staged.events(),
        reject_events(tables.runs, roster, ["run"], "no_sample_names_found"),
    ])


def pipeline_status_rows(tables: RunTables) -> DataFrame:
    """(run, sample, pipeline, status): the same as rows, whose columns don't depend on the pipelines of the runs."""
    roster = sheet_samples(tables).rows.select(*_KEY).distinct()
    sheets = pipeline_sheets(tables).rows
    listed = sheets.where("sample is not null").select(*_KEY, "pipeline").distinct().withColumn("status", F.lit(0))
    asked = roster.join(sheets.select("run", "pipeline").distinct(), "run")
    rows = asked.join(listed, [*_KEY, "pipeline"], "left").withColumn("status", F.coalesce("status", F.lit(1)))
    own = file_status(tables, roster).rows.select(
        *_KEY, F.lit(FILE_STATUS.removeprefix("status_")).alias("pipeline"), F.col(f"`{FILE_STATUS}`").alias("status"))
    return rows.unionByName(own)
