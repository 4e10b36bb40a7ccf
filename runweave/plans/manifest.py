"""Consensus files handed on: a table of paths in place of links on a disk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runweave.config import CONSENSUS_SUFFIX
from runweave.sources.tables import RunTables


def consensus_manifest(tables: RunTables) -> DataFrame:
    """(run, sample, path, length) of the consensus files."""
    sample = F.expr(f"left(name, length(name) - {len(CONSENSUS_SUFFIX)})")
    return tables.files("bcftools").select("run", sample.alias("sample"), "path", "length")
