"""Per-sample facts: mapped reads, completeness, cleavage site, genotype."""

from __future__ import annotations

from pyspark.sql import functions as F

from runweave.config import (
    COMPLETENESS_LIMIT, CONSENSUS_SUFFIX, RANGE_IN_HEADER, SEGMENT_IN_FILE_NAME, SEGMENTS,
)
from runweave.functions.kv import kv_list
from runweave.functions.sequence import fraction_called, threshold_flag
from runweave.functions.text import extract, na_to_null, range_of, to_long, token_at
from runweave.operators.events import check_events, events
from runweave.operators.pivot import pivot_last_wins
from runweave.plans.result import Result
from runweave.sources.delimited import (
    cell, compute_once, first_row, has_columns,
)
from runweave.sources.fasta import read_fasta
from runweave.sources.tables import RunTables

_KEY = ["run", "sample"]


def _stem(suffix: str):
    return F.expr(f"left(name, length(name) - {len(suffix)})")


def mapped_reads(tables: RunTables) -> Result:
    """(run, sample, {segment}_reads_mapped, {segment}_seq_length) from files of exactly two lines."""
    texts = tables.parsed("idxstats").where(F.startswith("name", F.col("folder")))
    parsed = texts.withColumnRenamed("folder", "sample")
    first = F.get("records", F.lit(0))
    files = compute_once(
        parsed, ("records",), n_rows=F.size("records"), width=F.size(first),
        seq_length=to_long(na_to_null(F.get(first, F.lit(1)))),
        reads_mapped=to_long(na_to_null(F.get(first, F.lit(2)))),
        segment=extract(F.col("name"), SEGMENT_IN_FILE_NAME),
    )
    unreadable = F.col("problem").isNotNull() | (F.col("n_rows") < 1)
    no_numbers = ~F.col("width").between(3, 4) | F.col("seq_length").isNull() | F.col("reads_mapped").isNull()
    files = files.withColumn(
        "reject",
        F.when(unreadable, "idxstats_file_read_error")
        .when(F.col("n_rows") != 2, "unexpected_idxstats_format")
        .when(no_numbers, "idxstats_file_read_error")
        .when(F.col("segment").isNull(), "segment_name_extraction_failed")
        .when(~F.col("segment").isin(*SEGMENTS), "unexpected_column_found"),
    )
    wide = pivot_last_wins(
        files.where("reject is null"), _KEY, "segment", SEGMENTS, ["reads_mapped", "seq_length"], ["path"], default=0
    )
    lost = files.where("reject is not null")
    return Result(wide, lambda: [events(lost, F.col("reject"), "sample", path="path", segment="segment", rows="n_rows")])


def completeness(tables: RunTables) -> Result:
    """(run, sample, {segment}_consensus_completeness, {segment}_tree_pass)."""
    texts = tables.read("bcftools").withColumn("sample", _stem(CONSENSUS_SUFFIX))
    records = read_fasta(texts).withColumn("segment", token_at(F.col("id"), "_", -1)).where(F.length("seq") > 0)
    called = records.where(F.col("segment").isin(*SEGMENTS)).select(
        *_KEY, "pos", "segment", fraction_called(F.col("seq")).alias("consensus_completeness")
    )
    wide = pivot_last_wins(
        called, _KEY, "segment", SEGMENTS, ["consensus_completeness"], ["pos"], default=0.0
    )
    unknown = records.where(~F.col("segment").isin(*SEGMENTS))
    broken = texts.where("problem is not null")
    return Result(wide, lambda: [
        events(unknown, "unknown_segment_found", "sample", segment="segment", record_id="id"),
        events(broken, "completeness_calculation_error", "sample", path="path", error="problem"),
    ])


def tree_pass() -> dict:
    """{segment}_tree_pass columns from the completeness columns."""
    return {
        f"{s}_tree_pass": threshold_flag(F.col(f"{s}_consensus_completeness"), COMPLETENESS_LIMIT)
        for s in SEGMENTS
    }


def cleavage_sites(tables: RunTables) -> Result:
    """(run, sample, HPAI_cleave_start, HPAI_cleave_end, HPAI_cleavage_site_motif) of the first row."""
    parsed = tables.parsed("cleavage").where(F.col("name") == F.concat("folder", F.lit(".cleavage.tsv")))
    files = first_row(parsed).withColumnRenamed("folder", "sample")
    motif, title = "Cleavage Sequence", "Cleavage Site Sequence Header"
    has_motif = has_columns(motif)
    span = F.when(has_motif, range_of(cell(title), RANGE_IN_HEADER))
    rows = files.select(
        *_KEY,
        span.getField("start").alias("HPAI_cleave_start"),
        span.getField("end").alias("HPAI_cleave_end"),
        F.when(has_motif, cell(motif)).alias("HPAI_cleavage_site_motif"),
    )
    return Result(rows, lambda: [
        check_events(files, [
            (F.col("problem") == "empty", "cleavage_file_empty", {"path": "path"}),
            (F.col("problem") != "empty", "cleavage_file_read_error", {"path": "path", "error": "problem"}),
            ((F.col("n_records") > 0) & ~has_columns(motif, title), "cleavage_file_read_error",
             {"path": "path", "error": F.lit("column missing")}),
        ], "sample"),
    ])


def genotypes(tables: RunTables) -> Result:
    """(run, sample, GenoFLU_Genotype, GenoFLU_{segment}) of the first row."""
    listed = "Genotype List Used, >=98.0%"
    files = first_row(tables.parsed("genotype").withColumn("sample", _stem(".genoflu.tsv"))).withColumn(
        "list", F.when(has_columns("Genotype"), cell(listed))
    )
    files = compute_once(files, pairs=kv_list(F.col("list"), {"MP": "M"}))
    rows = files.select(
        *_KEY,
        cell("Genotype").alias("GenoFLU_Genotype"),
        *(F.try_element_at("pairs", F.lit(s)).alias(f"GenoFLU_{s}") for s in SEGMENTS),
    )
    error = (
        F.when(F.col("problem").isNotNull(), F.col("problem"))
        .when(F.col("n_records") == 0, "no rows")
        .when(~has_columns("Genotype", listed), "column missing")
        .when((F.col("list") != "") & F.col("pairs").isNull(), "malformed list")
    )
    extra = F.transform(
        F.filter(F.map_keys("pairs"), lambda key: ~key.isin(*SEGMENTS)),
        lambda key: F.struct(
            F.lit("unexpected_column_found").alias("event_type"),
            F.array(F.struct(F.lit("column").alias("key"), F.concat(F.lit("GenoFLU_"), key).alias("value"))).alias("detail")),
    )
    return Result(rows, lambda: [
        check_events(files.withColumn("error", error), [
            (F.col("error").isNotNull(), "genoflu_file_read_error", {"path": "path", "error": "error"}),
        ], "sample", extra),
    ])
