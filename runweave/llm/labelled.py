"""Bounded samples of labelled documents, on which the classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(modulus))


def training_texts(docs: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int,
                   max_chars: int) -> list[tuple[str, int]]:
    """The rows of training_rows, in order."""
    rows = training_rows(docs, labels, label, usable, per_class, max_chars)
    return [(row.text, row.y) for row in rows.orderBy("draw").select("text", "y").collect()]


def training_rows(docs: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int,
                  max_chars: int) -> DataFrame:
    """(text, y, draw) of at most `per_class` documents of either label, drawn by a hash of the id, which orders them.

    usable: a condition on doc_id for rows that may be learned from. Texts over `max_chars` characters are left out of
    the sample. A document with contradicting labels counts as 1; null labels and ids are ignored. The sample is at
    most 2 * per_class * max_chars characters long, whatever the size of the tables.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & usable)
    known = known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
    draw = F.xxhash64("doc_id")
    drawn = known.where("y = 1").orderBy(draw).limit(per_class).union(
        known.where("y = 0").orderBy(draw).limit(per_class))
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(drawn), "doc_id")
    rows = rows.where(F.length("text") <= max_chars).dropDuplicates(["doc_id"])
    return rows.select("text", "y", draw.alias("draw"))
