"""Column functions on text cells, names and paths."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from runweave.config import NA_TOKENS

_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
_WHOLE = r"^\s*[+-]?\d+\s*$"
_SPACE = " \t\n\r\f\x0b"


def na_to_null(col: Column) -> Column:
    """Null for the missing-value tokens of delimited files; use on CSV/TSV cells only."""
    # position in a comma list, one literal in place of one per token; no token holds a comma
    return F.when(F.find_in_set(col, F.lit(",".join(NA_TOKENS))) == 0, col)


def strip_ws(col: Column) -> Column:
    return F.btrim(col, F.lit(_SPACE))


def to_double(col: Column) -> Column:
    """Decimal text to double, null for anything else (Java suffixes such as 5d included)."""
    return F.when(col.rlike(_NUMBER), strip_ws(col)).try_cast("double")


def to_long(col: Column) -> Column:
    """Whole or decimal text to long; decimals are cut towards zero."""
    whole = F.when(col.rlike(_WHOLE), strip_ws(col)).try_cast("bigint")
    return F.coalesce(whole, to_double(col).try_cast("bigint"))


def token_at(col: Column, sep: str, index: int) -> Column:
    """The index-th token of a separated text, counted from the end when negative."""
    parts = F.split(col, re.escape(sep))
    return F.get(parts, F.lit(index)) if index >= 0 else F.try_element_at(parts, F.lit(index))


def path_component(col: Column, index: int) -> Column:
    """One component of a path, trailing slashes ignored; null when there are too few."""
    return token_at(F.rtrim(col, F.lit("/")), "/", index)


def extract(col: Column, pattern: str, group: int = 1) -> Column:
    """regexp_extract that gives null, not an empty string, when nothing matches."""
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, group))


def range_of(col: Column, pattern: str) -> Column:
    """struct<start,end> of the two number groups of a pattern; both null when there is no match."""
    return F.struct(
        extract(col, pattern, 1).try_cast("int").alias("start"),
        extract(col, pattern, 2).try_cast("int").alias("end"),
    )


def prefixed_int(prefix: str, col: Column) -> Column:
    """prefix + whole number ('5.0' -> H5); null for missing and for non-numbers."""
    return F.concat(F.lit(prefix), to_long(col).cast("string"))


def presence_text(first: Column, second: Column, texts: tuple[str, ...]) -> Column:
    """One of four texts by which of two values are present (code = first + 2 * second)."""
    return (
        F.when(first.isNotNull() & second.isNotNull(), texts[3])
        .when(second.isNotNull(), texts[2])
        .when(first.isNotNull(), texts[1])
        .otherwise(texts[0])
    )


def joined_text(first: Column, second: Column) -> Column:
    """Both values one after the other, a missing one as empty text."""
    return F.concat(F.coalesce(first, F.lit("")), F.coalesce(second, F.lit("")))
