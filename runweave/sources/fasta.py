"""FASTA texts -> one row per record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def read_fasta(texts: DataFrame, content: str = "content") -> DataFrame:
    """(…, pos, id, seq): records start at '>' in column 0; text before the first one is ignored."""
    keep = [c for c in texts.columns if c not in (content, "pos", "problem")]
    records = F.split(F.concat(F.lit("\n"), F.col(content)), "\n>")
    body = F.slice(records, F.lit(2), F.greatest(F.size(records) - 1, F.lit(0)))
    rows = texts.where(F.col(content).isNotNull()).select(*keep, F.posexplode(body).alias("pos", "_record"))
    head = F.substring_index("_record", "\n", 1)
    lines = F.expr("substring(_record, length(substring_index(_record, '\n', 1)) + 1)")
    return rows.select(
        *keep,
        F.col("pos").cast("bigint").alias("pos"),
        F.regexp_extract(head, r"^\s*(\S*)", 1).alias("id"),
        F.translate(lines, "\n\r ", "").alias("seq"),
    )
