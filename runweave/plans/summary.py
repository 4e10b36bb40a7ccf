"""One wide row per sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runweave.config import CLADE_COLUMNS, PRESENCE_TEXTS, SEGMENTS, JobConfig
from runweave.functions.text import presence_text, to_double
from runweave.operators.align import align_to
from runweave.operators.events import column_events, events
from runweave.operators.joins import left_join_default
from runweave.operators.topk import pick_rows
from runweave.plans.clades import best_clades, repeated_clades
from runweave.plans.facts import cleavage_sites, completeness, genotypes, mapped_reads, tree_pass
from runweave.plans.result import Result
from runweave.plans.roster import roster
from runweave.plans.status import pipeline_status
from runweave.plans.subtype import subtypes
from runweave.plans.versions import software_versions
from runweave.schemas import summary_schema
from runweave.sources.delimited import cell
from runweave.sources.tables import RunTables

_KEY = ["run", "sample"]


def _shown_clades(best: DataFrame) -> DataFrame:
    """One row per (run, sample) with the shown columns; of several folders the lowest path wins."""
    shown = {
        CLADE_COLUMNS["clade"]: F.col("clade"),
        CLADE_COLUMNS["subclade"]: cell("subclade"),
        CLADE_COLUMNS["legacy-clade"]: cell("legacy-clade"),
        CLADE_COLUMNS["qc.overallScore"]: to_double(cell("qc.overallScore")),
        CLADE_COLUMNS["qc.overallStatus"]: cell("qc.overallStatus"),
        CLADE_COLUMNS["nextclade_dataset_name"]: F.col("nextclade_dataset_name"),
        CLADE_COLUMNS["nextclade_dataset_version"]: F.col("nextclade_dataset_version"),
    }
    rows = best.select(*_KEY, "path", *(col.alias(name) for name, col in shown.items()))
    return pick_rows(rows, _KEY, F.col("path"), list(shown))


def run_summary(tables: RunTables, config: JobConfig = JobConfig()) -> Result:
    """(run_folder, roster_pos, expected columns…, status columns in auto mode).

    Every source is first cut to one row per (run, sample), so the joins share one partitioning and
    the result has one row per roster row.
    """
    names = roster(tables, config)
    calls = subtypes(tables)
    clades = best_clades(tables, config)
    reads, called = mapped_reads(tables), completeness(tables)
    sites, types = cleavage_sites(tables), genotypes(tables)
    versions = software_versions(tables)

    zeros = {f"{s}_{m}": 0 for s in SEGMENTS for m in ("reads_mapped", "seq_length")}
    wide = left_join_default(names.rows, calls.rows, _KEY)
    wide = left_join_default(wide, _shown_clades(clades.rows), _KEY)
    wide = left_join_default(wide, reads.rows, _KEY, zeros)
    wide = left_join_default(wide, called.rows, _KEY, {f"{s}_consensus_completeness": 0.0 for s in SEGMENTS})
    wide = left_join_default(wide, sites.rows, _KEY)
    wide = left_join_default(wide, types.rows, _KEY)
    status: list[str] = []
    parts = [names, calls, clades, reads, called, sites, types, versions]
    if config.auto_mode:
        codes = pipeline_status(tables, config.pipelines)
        status = [c for c in codes.rows.columns if c not in _KEY]
        wide = left_join_default(wide, codes.rows, _KEY)
        parts.append(codes)

    # all that is constant within a run, one row per run
    has_calls = calls.rows.groupBy("run").agg(F.lit(True).alias("has_calls"))
    per_run = tables.runs.select("run").join(has_calls, "run", "left").join(versions.rows, "run", "left")
    wide = left_join_default(wide, per_run, ["run"])
    text = presence_text(F.col("HA_subtype"), F.col("NA_subtype"), PRESENCE_TEXTS)
    wide = wide.withColumns({
        **tree_pass(),
        # a run without any subtype table has no status text at all
        "subtype_HA_NA_status": F.when(F.col("has_calls"), text),
    }).drop("has_calls", "sample")

    wide = wide.withColumnsRenamed({"run": "run_folder"}).withColumnsRenamed({"Run_": "Run"})
    def found() -> list[DataFrame]:
        # of several folders with a row for one sample, one is shown
        several = repeated_clades(tables, config)
        return [
            *(frame for part in parts for frame in part.events()),
            events(several, "duplicate_key", "sample", source=F.lit("clades"), key="sample", n="n"),
        ]

    keys = ["run_folder", "roster_pos"]
    if not config.expected_columns:
        rows = wide.select(*keys, *(F.col(f"`{c}`") for c in wide.columns if c not in keys))
        return Result(rows, lambda: [*found(), events(tables.runs, "no_expected_columns_defined")])
    schema = T.StructType([
        T.StructField("run_folder", T.StringType()),
        T.StructField("roster_pos", T.LongType()),
        *summary_schema(config.expected_columns),
        *(T.StructField(c, T.IntegerType()) for c in status),
    ])
    rows, gaps = align_to(wide, schema)
    return Result(rows, lambda: [*found(), column_events(rows.sparkSession, gaps)])
