import random

import pytest

import corpus_pipeline
from runweave.llm import mixing
from runweave.llm.store import Workspace

SCHEMA = "doc_id long, text string, lang string, source string, topic string, kept long"


def rows(n=3000):
    rng = random.Random(4)
    out = [(None, "null id", "en", "a", "x", 1), (1, None, "en", "a", "x", 1), (2, "", None, None, "x", 1),
           (3, " \n", "en", "b", "x", 1), (4, "one word of a null source", None, None, "x", 1), (5, "long " * 50_000, "en", "a", "x", 1)]
    for k in range(10, n):
        source = rng.choice(["a"] * 6 + ["b", "c"])  # a hot source
        text = "word " * rng.randrange(1, 60) + rng.choice(["", "", "| x | y", "me@example.com", "Licensed under"])
        out.append((k, text, rng.choice(["en", "en", "de"]), source, "x", 1))
    return out + [out[20], out[20]]


def test_raked_weights_meet_the_targets(spark):
    work = Workspace(spark, "test")
    cells = mixing.cells_of(spark.createDataFrame(rows(), SCHEMA))
    target = lambda shares: spark.createDataFrame(list(shares.items()), "level string, share double")
    shares = {"source": {"a": 0.3, "b": 0.3, "c": 0.3, "(none)": 0.1}, "lang": {"en": 0.5, "de": 0.4, "(none)": 0.1}}
    raked = mixing.rake(work, cells, {d: target(s) for d, s in shares.items()}).collect()
    for dimension, wanted in shares.items():
        for level, share in wanted.items():
            assert sum(r.weight for r in raked if r[dimension] == level) == pytest.approx(share, abs=1e-6)


def test_sample_is_calibrated(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    out = mixing.mixed(docs).collect()
    assert len(out) == docs.count() and max(r.keep_probability for r in out) == pytest.approx(1)
    assert {(r.doc_id, r.kept) for r in out if r.doc_id in (1, 2, 3)} <= {(1, False), (1, True), (2, False), (2, True), (3, False), (3, True)}
    expected = sum(r.keep_probability for r in out if r.doc_id and r.doc_id >= 10)
    kept = sum(r.kept for r in out if r.doc_id and r.doc_id >= 10)
    assert abs(kept - expected) < 4 * len(out) ** 0.5
    share = lambda rows, s: sum(r.keep_probability * len(r.text.split()) for r in rows if r.source == s)
    full = [r for r in out if r.text]
    before = sum(len(r.text.split()) for r in full if r.source == "a") / sum(len(r.text.split()) for r in full if r.source == "b")
    assert share(full, "a") / share(full, "b") == pytest.approx(before ** 0.5, rel=1e-3)


def test_no_targets_no_tokens_no_rows(spark):
    docs = spark.createDataFrame(rows(40), SCHEMA)
    missing = {"source": spark.createDataFrame([("zzz", 1.0)], "level string, share double")}
    assert mixing.mixed(docs, missing).where("kept").count() == 0
    assert mixing.mixed(docs.where("doc_id in (1, 2, 3)")).where("kept").count() == 0
    assert mixing.mixed(docs.limit(0)).collect() == []


def test_plan_is_native(spark):
    plan = mixing.mixed(spark.createDataFrame(rows(30), SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_stray_document_takes_nothing_from_the_others(spark, monkeypatch):
    rng = random.Random(7)
    docs = [(k, "word " * rng.randrange(200, 400), rng.choice(["en", "de", "fr"]), "s%d" % max(0, rng.randrange(-6, 12)), "x", 1)
            for k in range(2000)]
    seen = []
    monkeypatch.setattr(corpus_pipeline.mixing, "mixed", lambda *a, run=mixing.mixed, **k: seen.append(run(*a, **k)) or seen[-1])
    for rows in (docs, docs + [(5000, "word " * 30, "en", "stray", "x", 1)]):
        table = spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id", "text", "lang", "source", "1L as n_chars")
        corpus_pipeline.mix_sources(spark, table, "")
        found = seen[-1].collect()
        size = {r.doc_id: len(r.text.split()) for r in found}
        kept = {r.doc_id: r.keep_probability * size[r.doc_id] for r in found}
        assert sum(kept.values()) / sum(size.values()) == pytest.approx(0.75, abs=1e-3)
        power = lambda s: sum(size[r.doc_id] for r in found if r.source == s) ** 0.9  # noqa: E731,B023
        of = lambda s: sum(kept[r.doc_id] for r in found if r.source == s)  # noqa: E731,B023
        assert of("s0") / of("s1") == pytest.approx(power("s0") / power("s1"), rel=1e-2)
    assert kept[5000] == pytest.approx(30)


def test_plans_of_raking_do_not_grow_with_the_dimensions(spark, monkeypatch):
    joins, keep = [], Workspace.keep
    monkeypatch.setattr(Workspace, "keep", lambda self, df, name: joins.append(
        (name, df._jdf.queryExecution().optimizedPlan().toString().count("Join "))) or keep(self, df, name))
    mixing.mixed(spark.createDataFrame(rows(300), SCHEMA), power=0.9, kept_share=0.75)
    steps = [n for name, n in joins if name.startswith("weights-") and name != "weights-0"]
    assert steps and set(steps) == {1}
