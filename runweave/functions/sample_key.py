"""Cascade of name patterns: whole forms first, then salvage of tail and head."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from runweave.config import CONTROL_NAME, SALVAGE_HEADS, SALVAGE_TAIL, STANDARD_NAME
from runweave.functions.text import extract


@dataclass(frozen=True)
class KeyPatterns:
    """whole: patterns with one group per field; tail: all fields but the first; heads: the first field."""

    fields: tuple[str, ...]
    whole: tuple[str, ...]
    tail: str
    heads: tuple[str, ...]


SAMPLE_KEY = KeyPatterns(
    ("CID", "Plate", "Index", "Well"), (STANDARD_NAME, CONTROL_NAME), SALVAGE_TAIL, SALVAGE_HEADS
)


def parse_sample_key(col: Column, patterns: KeyPatterns = SAMPLE_KEY) -> Column:
    """struct of the pattern fields; the first falls back to the name itself, the others to null."""
    matched = None
    for pattern in patterns.whole:
        fields = F.struct(
            *(F.regexp_extract(col, pattern, i).alias(f) for i, f in enumerate(patterns.fields, 1))
        )
        matched = F.when(col.rlike(pattern), fields) if matched is None else matched.when(
            col.rlike(pattern), fields
        )
    head = F.coalesce(*(extract(col, p) for p in patterns.heads), col)
    tail = (extract(col, patterns.tail, i).alias(f) for i, f in enumerate(patterns.fields[1:], 1))
    salvaged = F.struct(head.alias(patterns.fields[0]), *tail)
    return matched.otherwise(salvaged)
