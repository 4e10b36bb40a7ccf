"""The queries on delimited texts parse whole documents."""

import pytest

from runweave.plans import table_queries
from runweave.sources.delimited import cell, delimited_rows, parse_delimited

TEXTS = ["short", 'a "quoted", part\n' * 3000, '"' * 20_001, "x" * 399 + '"\n,' + "y" * 90_000, ("line, " * 9 + "\n") * 900 + '"']


@pytest.fixture
def parsed(spark, tmp_path, monkeypatch):
    rows = [(k, text, "en", "web") for k, text in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(
        str(tmp_path / "documents.parquet"))
    seen = []

    def parse(texts, sep):
        seen.append(parse_delimited(texts, sep))
        return seen[-1]
    monkeypatch.setattr(table_queries, "parse_delimited", parse)

    def run(name):
        return table_queries.QUERIES[name](spark, str(tmp_path)).collect(), seen[-1]
    return run


def test_whole_texts_are_rows(parsed):
    rows, tables = parsed("c33_delimited_rows")
    assert {r.problem for r in tables.collect()} == {None}
    assert {r.doc_id: r.text for r in rows if r.pos == 0} == {k: text + ' say "hi", en' for k, text in enumerate(TEXTS)}
    assert {(r.id, r.text, r.size) for r in rows if r.pos == 1} == {(str(k), None, 'web"s') for k in range(len(TEXTS))}


def test_lines_of_whole_texts_are_counted(parsed):
    rows, tables = parsed("c32_delimited_shape")
    assert {r.doc_id: r.n_records for r in rows} == {k: len(text.split("\n")) for k, text in enumerate(TEXTS)}
    assert {(r.problem, r.n_columns) for r in rows} == {(None, 2)}
    first = delimited_rows(tables).select("doc_id", "pos", cell("line").alias("line")).where("pos = 0").collect()
    assert {r.doc_id: r.line for r in first} == {k: text.split("\n")[0] for k, text in enumerate(TEXTS)}
