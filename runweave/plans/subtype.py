"""Subtype calls per sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runweave.functions.text import joined_text, prefixed_int
from runweave.operators.events import counted, counted_events, events, found_by
from runweave.operators.topk import pick_rows
from runweave.plans.result import Result
from runweave.sources.delimited import compute_once, picked_cells
from runweave.sources.tables import RunTables

_NEEDED = ("sample", "Genotype", "H_type", "N_type")


def subtypes(tables: RunTables) -> Result:
    """(run, sample, HA_subtype, NA_subtype, subtype); the first column of the file is its index."""
    columns = F.slice("header", F.lit(2), F.greatest(F.size("header") - 1, F.lit(0)))
    lacking = F.size(F.array_intersect(columns, F.array(*map(F.lit, _NEEDED)))) < len(_NEEDED)
    parsed = tables.parsed("subtype").withColumn(
        "problem", F.coalesce("problem", F.when(lacking, "column missing"))
    )
    picked = picked_cells(parsed, sample="sample", h_cell="H_type", n_cell="N_type")
    called = compute_once(picked.where("problem is not null or sample is not null"), **{
        "HA_subtype": prefixed_int("H", F.col("h_cell")),
        "NA_subtype": prefixed_int("N", F.col("n_cell")),
    })
    rows = called.where("problem is null").withColumn("subtype", joined_text(F.col("HA_subtype"), F.col("NA_subtype")))
    shown = ["HA_subtype", "NA_subtype", "subtype"]
    single = pick_rows(rows, ["run", "sample"], F.struct("path", "pos"), shown)

    def found() -> list[DataFrame]:
        bad_cell = F.expr("(h_cell is not null and HA_subtype is null) or (n_cell is not null and NA_subtype is null)")
        marked = called.select("run", "sample", found_by([
            (F.col("problem").isNotNull(), "subtype_file_read_error", {"path": "path", "error": "problem"}),
            (F.col("problem").isNull() & bad_cell, "subtype_file_read_error", {"H_type": "h_cell", "N_type": "n_cell"}),
        ]).alias("found"))
        counts = counted(marked)
        repeated = counts.where("sample is not null").groupBy("run", "sample").agg(F.sum("n").alias("n")).where("n > 1")
        return [
            counted_events(counts),
            events(repeated, "duplicate_key", "sample", source=F.lit("subtype"), n="n"),
        ]

    return Result(single, found)
