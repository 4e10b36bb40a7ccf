"""Two-level 'section: / key: value' texts -> long table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runweave.functions.text import strip_ws

_ENTRY = r"""^\s*(?:"([^"]*)"|'([^']*)'|([^\s"'#](?:[^:]|:(?=\S))*?))\s*:(?:\s+(.*))?\s*$"""
_NOTHING = ("", "~", "null", "Null", "NULL")


def _name(line: Column) -> Column:
    return F.concat(*(F.regexp_extract(line, _ENTRY, i) for i in (1, 2, 3)))


def _value(line: Column) -> Column:
    raw = strip_ws(F.regexp_extract(line, _ENTRY, 4))
    quoted = raw.rlike("""^("[^"]*"|'[^']*')\\s*(#.*)?$""")
    inner = F.regexp_extract(raw, """^["']([^"']*)["']""", 1)
    plain = strip_ws(F.regexp_replace(raw, r"(^|\s)#.*$", ""))
    return F.when(quoted, inner).otherwise(F.when(~plain.isin(*_NOTHING), plain))


def read_sections(texts: DataFrame, content: str = "content") -> DataFrame:
    """(…, section, key, value, line): a line in column 0 opens a section for the lines below it.

    The text is cut at the section lines, so the section name needs no carry-down over rows.
    Values stay text.
    """
    keep = [c for c in texts.columns if c not in (content, "pos", "problem")]
    blocks = F.split(F.col(content), r"\n(?=[^\s#])")
    rows = texts.select(*keep, F.posexplode(blocks).alias("_block", "_text")).select(
        *keep, "_block", F.posexplode(F.split("_text", "\n")).alias("_line", "_entry"),
        F.substring_index("_text", "\n", 1).alias("_head"),
    )
    rows = rows.where((F.col("_line") > 0) & F.col("_entry").rlike(_ENTRY) & F.col("_head").rlike(_ENTRY))
    return rows.select(
        *keep,
        _name(F.col("_head")).alias("section"),
        _name(F.col("_entry")).alias("key"),
        _value(F.col("_entry")).alias("value"),
        F.struct("_block", "_line").alias("line"),
    )
