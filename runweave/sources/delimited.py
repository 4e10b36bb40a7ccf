"""Delimited files whose header differs from file to file.

Works on whole texts in Catalyst expressions: line 0 is the header, each further line becomes a
map from header name to cell. A quoted cell starts with a quote and ends with the next one that is not doubled, right
before a separator, a line break or the end; it may hold separators, breaks and doubled quotes. Other quotes are text.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runweave.functions.kv import let
from runweave.functions.text import na_to_null

#: What separates the cells of each delimited source, and those without a header; fixed values.
SEPARATORS = {"subtype": ",", "mixtures": ",", "start_sheet": ",", "output_sheet": ",", "clades": "\t",
              "cleavage": "\t", "genotype": "\t", "dataset_versions": ",", "linked_datasets": ",", "idxstats": "\t"}
HEADERLESS = ("dataset_versions", "linked_datasets", "idxstats")


def compute_once(df: DataFrame, drop: tuple[str, ...] = (), **columns: Column) -> DataFrame:
    """Adds costly columns behind a condition that is always true, but isn't deterministic.

    The optimizer would else copy their expressions into every filter and lambda that uses them. Columns that nobody
    reads are not worked out.
    """
    keep = [c for c in df.columns if c not in (*drop, *columns)]
    always = F.spark_partition_id() >= 0
    return df.select(*keep, *(F.when(always, c).alias(n) for n, c in columns.items()))


def _tokens(text: Column, sep: str) -> Column:
    """The cells of a text, each with the separator or line break behind it."""
    end = f"[{re.escape(sep)}\n]"
    quoted = f'"(?:[^"]++|"")*+"(?={end})'
    cells = f"(?:{quoted}|[^{re.escape(sep)}\n]*+){end}"
    return F.regexp_extract_all(F.concat(F.rtrim(text, F.lit("\n")), F.lit("\n")), F.lit(cells), F.lit(0))


def _is_quoted(cell: Column) -> Column:
    return F.startswith(cell, F.lit('"')) & F.rlike(cell, F.lit(r'\A"(?:[^"]++|"")*+"\z'))


def _raw(token: Column) -> Column:
    return F.left(token, F.length(token) - 1)


def _unclosed(tokens: Column) -> Column:
    """True when a cell opens with a quote that never closes: one that starts with a quote and holds an odd number."""
    return F.exists(tokens, lambda token: F.startswith(token, F.lit('"')) & (
        F.regexp_count(token, F.lit('"')) % 2 == 1) & ~_is_quoted(_raw(token)))


def _cut(tokens: Column) -> Column:
    """array<array<string>> of the cells of all lines that are not blank, from the tokens of a text with quotes."""
    def value(token: Column) -> Column:
        cell = _raw(token)
        inner = F.replace(cell.substr(F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))
        return F.when(_is_quoted(cell), inner).otherwise(cell)

    def records(tokens: Column) -> Column:
        ends = F.array_compact(F.transform(tokens, lambda t, i: F.when(F.endswith(t, F.lit("\n")), i)))

        def cut(ends: Column) -> Column:
            return F.transform(ends, lambda end, k: F.slice(
                tokens, F.coalesce(F.get(ends, k - 1), F.lit(-1)) + 2, end - F.coalesce(F.get(ends, k - 1), F.lit(-1))))

        rows = F.transform(F.array(ends), cut)[0]
        full = F.filter(rows, lambda row: (F.size(row) > 1) | (F.length(F.trim(_raw(row[0]))) > 0))
        return F.transform(full, lambda row: F.transform(row, value))

    return F.transform(F.array(tokens), records)[0]


def _parsed(sep: str, content: str) -> Column:
    """struct<lines, unclosed>: the records of a text, and whether one of its quotes never closes.

    A text with quotes is cut once into tokens, whatever is taken from them.
    """
    lines = F.filter(F.split(F.col(content), "\n"), lambda line: F.trim(line) != "")
    plain = F.struct(
        F.transform(lines, lambda line: F.split(line, re.escape(sep))).alias("lines"), F.lit(False).alias("unclosed"))
    quoted = let(_tokens(F.col(content), sep), lambda tokens: F.struct(
        _cut(tokens).alias("lines"), _unclosed(tokens).alias("unclosed")))
    return F.when(F.contains(F.col(content), F.lit('"')), quoted).otherwise(plain)


def _header(lines: Column) -> Column:
    """Names of line 0, unnamed columns numbered, repeats given a suffix."""
    cells = F.get(lines, F.lit(0))
    named = F.transform(
        cells, lambda c, i: F.when(c == "", F.concat(F.lit("Unnamed: "), i.cast("string"))).otherwise(c)
    )

    def repeats(named: Column) -> Column:
        def repeat(name: Column, i: Column) -> Column:
            before = F.size(F.filter(F.slice(named, F.lit(1), i), lambda other: other == name))
            return F.when(before > 0, F.concat_ws(".", name, before.cast("string"))).otherwise(name)

        return F.transform(named, repeat)

    def last_resorts(names: Column) -> Column:
        def last_resort(name: Column, i: Column) -> Column:  # a name may look like a suffixed repeat
            return F.when(F.array_position(names, name) <= i, F.concat_ws("#", name, i.cast("string"))).otherwise(name)

        return F.transform(names, last_resort)

    def unless_distinct(names: Column, otherwise: Column) -> Column:
        return F.when(F.size(F.array_distinct(names)) == F.size(names), names).otherwise(otherwise)

    plain = (F.size(F.array_distinct(cells)) == F.size(cells)) & ~F.array_contains(cells, F.lit(""))
    return F.when(plain, cells).otherwise(let(named, lambda named: unless_distinct(named, let(
        repeats(named), lambda names: unless_distinct(names, last_resorts(names))))))


def parse_delimited(texts: DataFrame, sep: str, content: str = "content") -> DataFrame:
    """Adds header, records (without the header) and `problem` for texts that are no table.

    A text without any line is 'empty'; one with a line longer than its header is 'ragged'; one in which a quote opens
    a cell and never closes is 'unclosed quote'.
    Shorter lines are filled with nulls.
    """
    keep = [c for c in texts.columns if c not in (content, "problem")]
    known = F.col("problem") if "problem" in texts.columns else F.lit(None).cast("string")
    lines = F.col("_parsed.lines")
    below = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
    ragged = F.array_max(F.transform(lines, F.size)) > F.size(F.get(lines, F.lit(0)))
    problem = F.coalesce(
        known, F.when(F.col("_parsed.unclosed"), "unclosed quote").when(F.size(lines) == 0, "empty").when(ragged, "ragged"))
    return compute_once(
        compute_once(texts, (content,), _parsed=_parsed(sep, content)), ("_parsed",),
        header=_header(lines), records=F.when(F.size(lines) > 0, below), problem=problem,
    ).select(*keep, "header", "records", "problem")


def delimited_rows(parsed: DataFrame) -> DataFrame:
    """One row per record of the good texts: pos and `cells`, a map from header name to cell."""
    keep = [c for c in parsed.columns if c not in ("header", "records", "problem", "pos")]
    rows = parsed.where(F.col("problem").isNull()).select(
        *keep, "header", F.posexplode("records").alias("pos", "_record")
    )
    cells = F.transform("header", lambda _, i: F.get("_record", i))
    return rows.select(*keep, F.col("pos").cast("bigint").alias("pos"),
                       F.map_from_arrays("header", cells).alias("cells"))


def picked_cells(parsed: DataFrame, **cells: str) -> DataFrame:
    """One row per record, as of delimited_rows, with some cells named by their headers, and one per text with a problem."""
    keep = [c for c in parsed.columns if c not in ("header", "records", "pos")]
    at = {name: column_index(title) for name, title in cells.items()}
    records = F.when(F.col("problem").isNull(), F.col("records"))
    rows = compute_once(parsed, ("header", "records", "pos"), _records=records, **{f"_at_{n}": i for n, i in at.items()})
    rows = rows.select(*keep, *(f"_at_{n}" for n in at), F.posexplode_outer("_records").alias("pos", "_record"))
    rows = rows.where(F.col("problem").isNotNull() | F.col("pos").isNotNull())
    return compute_once(
        rows.withColumn("pos", F.col("pos").cast("bigint")), ("_record", *(f"_at_{n}" for n in at)),
        **{n: na_to_null(F.get("_record", F.col(f"_at_{n}"))) for n in at})


def row_at(parsed: DataFrame, index: Column) -> DataFrame:
    """Adds `cells`, the map of one record, and `n_records`; null for texts with a problem."""
    good = F.col("problem").isNull()
    rows = parsed.withColumn("_record", F.when(good, F.get("records", index)))
    cells = F.map_from_arrays("header", F.transform("header", lambda _, i: F.get("_record", i)))
    return compute_once(
        rows, ("_record",), n_records=F.when(good, F.size("records")),
        cells=F.when(F.col("_record").isNotNull(), cells),
    )


def first_row(parsed: DataFrame) -> DataFrame:
    """Adds `cells`, the map of the first record, and `n_records`."""
    return row_at(parsed, F.lit(0))


def column_index(name: str) -> Column:
    """Position of a column in the header, -1 when absent."""
    return F.array_position("header", F.lit(name)).cast("int") - 1


def has_columns(*names: str) -> Column:
    """True when the header holds all the names."""
    return reduce(and_, (F.array_contains("header", F.lit(n)) for n in names))


def cell(name: str, cells: str = "cells") -> Column:
    """One cell by header name; null when the column or the value is missing."""
    return na_to_null(F.try_element_at(F.col(cells), F.lit(name)))


def parse_headerless(texts: DataFrame, sep: str, content: str = "content") -> DataFrame:
    """Adds records, the cells of all lines that are not blank."""
    return compute_once(texts, (content,), _parsed=_parsed(sep, content)).withColumn(
        "records", F.col("_parsed.lines")).drop("_parsed")


def parse_source(texts: DataFrame, source: str) -> DataFrame:
    """`texts` of one kind of source with header (null for sources without one), records and `problem`."""
    if source in HEADERLESS:
        return parse_headerless(texts, SEPARATORS[source]).withColumn("header", F.lit(None).cast("array<string>"))
    return parse_delimited(texts, SEPARATORS[source])


def headerless_rows(parsed: DataFrame, names: list[str]) -> DataFrame:
    """One row per record of texts without header, cells named by position."""
    keep = [c for c in parsed.columns if c not in ("records", "header", "pos", "problem")]
    rows = parsed.select(*keep, F.posexplode("records").alias("pos", "_record"))
    cells = (na_to_null(F.get("_record", F.lit(i))).alias(n) for i, n in enumerate(names))
    return rows.select(*keep, F.col("pos").cast("bigint").alias("pos"), F.size("_record").alias("width"), *cells)


def read_headerless(texts: DataFrame, sep: str, names: list[str], content: str = "content") -> DataFrame:
    """headerless_rows of texts that are not parsed yet."""
    return headerless_rows(parse_headerless(texts, sep, content), names)


def header_names(parsed: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, path, idx, name) of the headers of the good texts, also of those without records."""
    return parsed.where(F.col("problem").isNull()).select(
        *keys, "path", F.posexplode("header").alias("idx", "column_name")
    )
