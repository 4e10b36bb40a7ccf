"""Operators and column functions on small frames, also against brute force on skewed keys."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runweave.config import NA_TOKENS, PRESENCE_TEXTS
from runweave.functions.kv import kv_list, kv_list_valid
from runweave.functions.sample_key import parse_sample_key
from runweave.functions.sequence import fraction_called, round_percent, threshold_flag
from runweave.functions.text import (
    na_to_null, path_component, prefixed_int, presence_text, range_of, to_double, to_long, token_at,
)
from runweave.operators.align import align_to, map_columns, override_column, union_by_name, widen_maps
from runweave.operators.events import (
    check_events, column_events, counted, counted_events, events, found_by, reject_events,
)
from runweave.operators.fill import forward_fill, with_order_range
from runweave.operators.guards import exactly_one, singleton_groups
from runweave.operators.joins import left_join_default
from runweave.operators.pivot import first_failing_stage, membership_matrix, pivot_last_wins
from runweave.operators.topk import first_match, last_wins_map, top1_per_group
from runweave.sources.delimited import delimited_rows, parse_delimited, picked_cells, read_headerless
from runweave.sources.fasta import read_fasta
from runweave.sources.run_files import _children
from runweave.sources.sections import read_sections
from runweave.sources.task_log import process_dirs


def column(spark, values, fn, kind="string"):
    """The function on each value, in order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", fn(F.col("v")).alias("out"))
    return [r["out"] for r in df.orderBy("i").collect()]


def tuples(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def skewed(seed, n=3000):
    """(key, dim, score, tie, value) rows, a third of them on key 0, with equal scores and nulls."""
    rng = random.Random(seed)
    return [
        (0 if rng.random() < 0.33 else rng.randrange(1, 40), rng.choice("abc"),
         rng.choice([None, *map(float, range(8))]), i, f"v{i}")
        for i in range(n)
    ]


SKEWED = "k int, dim string, score double, tie int, v string"


# ---- column functions --------------------------------------------------------------------------

def test_na_tokens(spark):
    assert column(spark, [*NA_TOKENS, None], na_to_null) == [None] * (len(NA_TOKENS) + 1)
    assert column(spark, ["HA", " NA", "na", "0", "a,b"], na_to_null) == ["HA", " NA", "na", "0", "a,b"]


def test_numbers(spark):
    assert column(spark, ["5", "5.0", " 7 ", "1e2", "5d", "x", "", None], to_double) == [5, 5, 7, 100, None, None, None, None]
    assert column(spark, ["5", "5.9", "-5.9", "9007199254740993", "inf", "x"], to_long) == [
        5, 5, -5, 9007199254740993, None, None]
    assert column(spark, ["5.0", "1", None, "x"], lambda c: prefixed_int("H", c)) == ["H5", "H1", None, None]


def test_tokens_and_paths(spark):
    assert column(spark, ["a_b_c", "a", ""], lambda c: token_at(c, "_", -1)) == ["c", "a", ""]
    assert column(spark, ["a.b", "a"], lambda c: token_at(c, ".", 1)) == ["b", None]
    assert column(spark, ["/d/RUN/x/out/", "/d/RUN/x/out", "a/b", "x/y/z"], lambda c: path_component(c, -3)) == [
        "RUN", "RUN", None, "x"]


def test_range(spark):
    got = column(spark, ["s|f|HA|1035..1061 site", "none", None, "|1..99999999999"], lambda c: range_of(c, r"\|(\d+)\.\.(\d+)"))
    assert [tuple(g) for g in got] == [(1035, 1061), (None, None), (None, None), (1, None)]


@pytest.mark.parametrize("name, key", [
    ("R1234567890-2404-A-D09", ("R1234567890", "2404", "A", "D09")),
    ("POS20240101-abc-2404-A-D09", ("POS20240101", "2404", "A", "D09")),
    ("R1234567890-x-2404-A-D09", ("R1234567890", "2404", "A", "D09")),
    ("NEG20240101-2404-A-D09", ("NEG20240101", "2404", "A", "D09")),
    ("R1234567890-rerun", ("R1234567890", None, None, None)),
    ("R1234567890-1234567890-A-D09", ("R1234567890", "1234567890", "A", "D09")),
    ("foo-1234567890-A-D09", ("foo-1234567890-A-D09", None, None, None)),
    ("foo", ("foo", None, None, None)),
])
def test_sample_key(spark, name, key):
    assert tuple(column(spark, [name], parse_sample_key)[0]) == key


def test_presence_text(spark):
    rows = spark.createDataFrame([(None, None), ("a", None), (None, "b"), ("a", "b")], "a string, b string")
    got = [r[0] for r in rows.select(presence_text(F.col("a"), F.col("b"), PRESENCE_TEXTS)).collect()]
    assert got == list(PRESENCE_TEXTS)


def test_rounding_equals_python(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(0, n + 1), n) for n in (8, 40, 800, 1701, 2341, 16000, 99991) for _ in range(150)]
    df = spark.createDataFrame([(i, a, n) for i, (a, n) in enumerate(pairs)], "i int, a bigint, n bigint")
    got = [r[0] for r in df.orderBy("i").select(round_percent(100.0 - F.col("a") * 100.0 / F.col("n"))).collect()]
    assert got == [round(100 - a * 100.0 / n, 2) for a, n in pairs]


def test_fraction_called(spark):
    assert column(spark, ["ACGTNnAC", "NN", "--RY", "", None], fraction_called) == [75.0, 0.0, 100.0, None, None]
    assert column(spark, [90.0, 90.01, None], lambda c: threshold_flag(c, 90), "double") == [0, 1, 0]


def test_kv_list(spark):
    texts = ["PB2:a, MP:x, HA:b", "M:own, HA:1, HA:2", "HA:1, broken", "a:b:c", "", None, "NA: v"]
    assert column(spark, texts, lambda c: kv_list(c, {"MP": "M"})) == [
        {"PB2": "a", "M": "x", "HA": "b"}, {"HA": "2"}, None, None, None, None, {"NA": " v"}]
    assert column(spark, texts, kv_list_valid) == [True, True, False, False, None, None, True]


# ---- row picking and guards --------------------------------------------------------------------

@pytest.mark.parametrize("seed", [1, 2])
def test_top1_against_brute_force(spark, seed):
    rows = skewed(seed)
    got = tuples(top1_per_group(spark.createDataFrame(rows, SKEWED).repartition(7), ["k"], "score", ["tie"]), "k")
    best = {}
    for k, dim, score, tie, v in rows:
        if score is not None and (k not in best or (-score, tie) < (-best[k][2], best[k][3])):
            best[k] = (k, dim, score, tie, v)
    assert got == [best[k] for k in sorted(best)]


def test_top1_leaves_out_groups_without_score(spark):
    df = spark.createDataFrame([(1, None, 0), (2, 3.0, 1)], "k int, s double, t int")
    assert tuples(top1_per_group(df, ["k"], "s", ["t"]), "k") == [(2, 3.0, 1)]


def test_last_wins_and_first_match(spark):
    df = spark.createDataFrame([
        ("r", "p1", "a", 1), ("r", "AGG x", "b", 2), ("r", "AGG y", "c", 3), ("r", "AGG x", "d", 9), ("q", "p1", "e", 1),
    ], "run string, name string, dir string, line int")
    last = last_wins_map(df, ["run"], "name", "dir", "line")
    assert ("r", "AGG x", "d", 2) in tuples(last, "run", "name")
    assert tuples(first_match(last, ["run"], "name", "dir", "first_seen", "AGG"), "run") == [("r", "AGG x", "d", 2)]


def test_guards(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("b", "z")], "k string, v string")
    roster = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    assert tuples(exactly_one(df, ["k"], "v", roster), "k") == [
        ("a", "x", "one", 1), ("b", None, "multiple", 2), ("c", None, "none", 0)]
    assert tuples(singleton_groups(df, ["k"]), "k") == [("a", "x")]


@pytest.mark.parametrize("groups, spacing, kind", [
    (1, 1, "bigint"), (2, 1, "bigint"), (5, 1_000_003, "bigint"), (16, 7, "timestamp"), (3, 1, "double")])
def test_forward_fill_against_brute_force(spark, groups, spacing, kind):
    rng = random.Random(groups)
    # one key holds most rows; order values far apart, and in clusters
    times = {0: sorted(rng.sample(range(400), 300)) + [10_000 + 90_000 * t for t in range(40)], 1: range(5), None: range(3, 40), 3: [5]}
    rows = [(k, t * spacing, f"{k}.{t}" if rng.random() < 0.2 else None) for k, ts in times.items() for t in ts]
    df = spark.createDataFrame(rows, "k int, t bigint, v string").withColumn(
        "t", F.timestamp_micros("t") if kind == "timestamp" else F.col("t").cast(kind)).repartition(3)
    filled = forward_fill(df, ["k"], "t", "v", "out", groups)
    got = {(r["k"], r["t"]): (r["v"], r["out"]) for r in filled.collect()}
    last, want = {}, []
    for k, t, v in rows:
        last[k] = v if v is not None else last.get(k)
        want.append((v, last[k]))
    keys = sorted(got, key=lambda r: (r[0] is None, r))
    assert len(got) == len(rows)
    by_key = {k: [w for r, w in zip(rows, want) if r[0] == k] for k in times}
    for k in times:
        assert [got[key] for key in keys if key[0] == k] == by_key[k]


def test_a_key_that_holds_all_rows_is_filled_by_many_tasks(spark):
    df = spark.range(20_000).select(F.lit(1).alias("k"), (F.col("id") * 1_000_000_007).alias("t"),
                                    F.when(F.col("id") % 5000 == 3, F.col("id")).alias("v"))
    sizes = [r["count"] for r in with_order_range(df, "t", 8, "p").groupBy("p").count().collect()]
    assert len(sizes) == 64 and max(sizes) < 2 * 20_000 / 64
    filled = forward_fill(df, ["k"], "t", "v", "out", 8)
    bad = filled.where("not (out <=> case when t div 1000000007 >= 3 then ((t div 1000000007 - 3) div 5000) * 5000 + 3 end)")
    assert bad.count() == 0 and filled.count() == 20_000
    assert forward_fill(df.limit(0), ["k"], "t", "v", "out").count() == 0
    nulls = spark.createDataFrame([(1, None, "a"), (1, 5, None), (1, None, "a")], "k int, t bigint, v string")
    assert {r.out for r in forward_fill(nulls, ["k"], "t", "v", "out").collect()} == {"a"}


# ---- pivots ------------------------------------------------------------------------------------

def test_pivot_against_brute_force(spark):
    rows = skewed(5)
    df = spark.createDataFrame(rows, SKEWED).repartition(5)
    got = tuples(pivot_last_wins(df, ["k"], "dim", ["a", "b", "zz"], ["score", "tie"], ["tie"], default=-1), "k")
    last = {}
    for k, dim, score, tie, _ in rows:
        last[k, dim] = (score, tie)
    def cells(k):
        return tuple(-1 if x is None else x for d in ("a", "b", "zz") for x in last.get((k, d), (None, None)))
    assert got == [(k, *cells(k)) for k in sorted({r[0] for r in rows if r[1] in "ab"})]


def test_membership(spark):
    roster = spark.createDataFrame([("r", "a"), ("r", "b"), ("q", "a")], "run string, id string")
    sheets = spark.createDataFrame([("r", "a", "p"), ("r", "a", "p"), ("q", "z", "o")], "run string, id string, pipe string")
    got = tuples(membership_matrix(roster, sheets, ["run", "id"], "pipe", ["o", "p"], ["run"]), "run", "id")
    assert got == [("q", "a", 1, None), ("r", "a", None, 0), ("r", "b", None, 1)]


def test_masks_of_many_values(spark):
    """More stages and values than a long has bits, against brute force."""
    rng = random.Random(8)
    stages = {f"s{i}": 2 + i for i in range(130)}
    facts = [(run, k, s, rng.choice([True, True, True, False, None])) for run in "ab" for k in range(12) for s in stages
             if rng.random() < (0.995 if k < 9 else 0.5) and not (run == "b" and s in ("s0", "s64", "s129"))]
    facts += [("a", 0, s, True) for s in stages] + [("a", 1, "other", True), ("a", 2, None, True)]
    df = spark.createDataFrame(facts, "run string, id int, stage string, passed boolean")
    roster = spark.createDataFrame([(r, k) for r in "abc" for k in range(13)], "run string, id int")
    codes = {(r.run, r.id): r.status for r in first_failing_stage(roster, df, stages, ["run", "id"], ["run"]).collect()}
    for run in "abc":
        active = {s for r, _, s, p in facts if r == run and p is not None}
        for k in range(13):
            passed = {s for r, i, s, p in facts if (r, i) == (run, k) and p}
            assert codes[run, k] == next((c for s, c in stages.items() if s in active and s not in passed), 0)
    wide = membership_matrix(roster, df, ["run", "id"], "stage", list(stages), ["run"])
    for row in wide.collect():
        mine = {s for r, i, s, _ in facts if (r, i) == (row.run, row.id)}
        there = {s for r, _, s, _ in facts if r == row.run}
        assert [row[f"status_{s}"] for s in stages] == [0 if s in mine else 1 if s in there else None for s in stages]


def test_first_failing_stage_is_per_run(spark):
    roster = spark.createDataFrame([(r, s) for r in "xy" for s in "abc"], "run string, id string")
    facts = spark.createDataFrame([
        ("x", "a", "s1", True), ("x", "a", "s3", True), ("x", "b", "s3", False), ("x", "stray", "s2", True),
        ("y", "a", "s1", True), ("y", "b", "s1", True), ("y", "b", "s1", False),
    ], "run string, id string, stage string, passed boolean")
    codes = first_failing_stage(roster, facts, {"s1": 2, "s2": 3, "s3": 4}, ["run", "id"], ["run"])
    assert tuples(codes, "run", "id") == [
        ("x", "a", 3), ("x", "b", 2), ("x", "c", 2), ("y", "a", 0), ("y", "b", 0), ("y", "c", 2)]


# ---- joins, columns, events --------------------------------------------------------------------

def test_left_join_modes(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "k string")
    right = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, None)], "k string, o int, v string")
    joined = left_join_default(left, right, ["k"], {"v": "N/A"}, "dedupe", ["o"])
    assert tuples(joined, "k") == [("a", 1, "x"), ("a", 1, "x"), ("b", 3, None), ("c", None, "N/A")]
    fan = left_join_default(left, right, ["k"], on_duplicate="fanout", order=["o"]).select("k", "n_copies")
    assert tuples(fan, "k") == [("a", 4), ("b", 1), ("c", 1)]
    with pytest.raises(PySparkException):
        left_join_default(left, right, ["k"], on_duplicate="error").collect()


def test_align_union_override(spark):
    df = spark.createDataFrame([(1, "x", "y")], "`a.b` int, c string, extra string")
    schema = T.StructType.fromDDL("c string, `a.b` bigint, gone double")
    rows, found = align_to(df, schema)
    assert rows.schema.names == ["c", "a.b", "gone"] and tuples(rows) == [("x", 1, None)]
    assert found == [("expected_column_missing", "gone"), ("unexpected_column_found", "extra")]
    assert column_events(spark, found).count() == 2
    both = union_by_name([df.select("c"), df.select("extra")])
    assert tuples(both, "c") == [(None, "y"), ("x", None)]
    assert tuples(override_column(df, "c", "extra", True)) == [(1, "y", "y")]
    assert tuples(override_column(df, "c", "extra", False)) == [(1, "x", "y")]


def test_events(spark):
    df = spark.createDataFrame([("r", "s1", 1), ("r", "s2", 2), ("r", "s3", 2)], "run string, id string, n int")
    assert tuples(events(df.where("n = 1"), "one", "id", n="n")) == [("r", "s1", "one", {"n": "1"})]
    kept = df.where("id = 's2'")
    assert [r[1] for r in tuples(reject_events(df, kept, ["id"], "lost", sample="id"), "sample")] == ["s1", "s3"]
    many = check_events(df, [(F.col("n") > 0, "any", {}), (F.col("n") > 1, "two", {"n": "n"})], "id")
    assert many.count() == 5 and many.where("event_type = 'two'").count() == 2


# ---- sources on texts --------------------------------------------------------------------------

def texts(spark, *contents):
    rows = [("r", f"p{i}", 0, c, None) for i, c in enumerate(contents)]
    return spark.createDataFrame(rows, "run string, path string, pos bigint, content string, problem string")


def test_counted_events_keep_every_row(spark):
    df = spark.createDataFrame(
        [("r", "a", 2), ("r", "a", 2), ("r", "b", 0), ("r", None, 3), (None, "c", 3), ("r", "d", None)], "run string, sample string, n int")
    marked = df.select("run", "sample", (F.col("n") > 0).alias("good"), found_by([
        (F.col("n") > 1, "two", {"n": "n"}), (F.col("n") > 2, "three", {}), (F.col("n").isNull(), "none", {"n": "n"}),
    ]).alias("found"))
    counts = counted(marked)
    assert counts.agg(F.sum("n")).first()[0] == 6
    assert counts.where("good").agg(F.sum("n")).first()[0] == 4
    got = [(r["run"], r["sample"], r["event_type"], r["detail"]) for r in counted_events(counts).collect()]
    want = [("r", "a", "two", {"n": "2"})] * 2 + [("r", None, "two", {"n": "3"}), ("r", None, "three", {}),
            (None, "c", "two", {"n": "3"}), (None, "c", "three", {}), ("r", "d", "none", {"n": None})]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_names_that_look_like_repeats_stay_apart(spark):
    header = parse_delimited(texts(spark, "a,,a,a.1,\n1"), ",").first()["header"]
    assert header == ["a", "Unnamed: 1", "a.1", "a.1#3", "Unnamed: 4"]


def test_picked_cells(spark):
    parsed = parse_delimited(texts(spark, ",b,a\n0,NA,x\n1", "a,b\n1,2,3", "a,b\n"), ",")
    rows = {(r["path"], r["pos"]): (r["a"], r["b"], r["z"], r["problem"])
            for r in picked_cells(parsed, a="a", b="b", z="z").collect()}
    assert sorted(rows.values(), key=str) == sorted([("x", None, None, None), (None, None, None, None), (None, None, None, "ragged")], key=str)


def test_delimited(spark):
    parsed = parse_delimited(texts(
        spark, 'a,b,a,\n1,"x, ""y""\nz",3,4\n\n5,6\n', "", "a,b\n1,2,3\n", "a,b\n", "x,x,x.1\n1,2,3",
    ), ",")
    state = {r["path"]: r for r in parsed.collect()}
    assert [state[f"p{i}"]["problem"] for i in range(5)] == [None, "empty", "ragged", None, None]
    assert state["p0"]["header"] == ["a", "b", "a.1", "Unnamed: 3"]
    assert len(set(state["p4"]["header"])) == 3
    rows = {(r["path"], r["pos"]): r["cells"] for r in delimited_rows(parsed).collect()}
    assert rows["p0", 0] == {"a": "1", "b": 'x, "y"\nz', "a.1": "3", "Unnamed: 3": "4"}
    assert rows["p0", 1] == {"a": "5", "b": "6", "a.1": None, "Unnamed: 3": None}
    assert {p for p, _ in rows} == {"p0", "p4"}


def test_wide_union_of_drifting_headers(spark):
    rows = delimited_rows(parse_delimited(texts(spark, "b,a\n1,2", "a,c\n3,NA"), ","))
    headers = spark.createDataFrame([("p0", 0, "b"), ("p0", 1, "a"), ("p1", 0, "a"), ("p1", 1, "c")],
                                    "path string, idx int, column_name string")
    names = map_columns(headers)
    assert names == ["b", "a", "c"]
    assert tuples(widen_maps(rows, "cells", names, ["path"], na_to_null), "path") == [
        ("p0", "1", "2", None), ("p1", None, "3", None)]


def test_headerless(spark):
    rows = read_headerless(texts(spark, "s,n,1,f\nt,NA,2"), ",", ["a", "b", "c", "d"])
    assert [(r["pos"], r["width"], r["a"], r["b"], r["d"]) for r in rows.orderBy("pos").collect()] == [
        (0, 4, "s", "n", "f"), (1, 3, "t", None, None)]


def test_fasta(spark):
    rows = read_fasta(texts(spark, "lost\n>a_HA x y\nAC\nGT \n>b_NA\n>c\nA>C\n"))
    assert [(r["pos"], r["id"], r["seq"]) for r in rows.orderBy("pos").collect()] == [
        (0, "a_HA", "ACGT"), (1, "b_NA", ""), (2, "c", "A>C")]
    assert read_fasta(texts(spark, "", "no record")).count() == 0


def test_sections(spark):
    text = ("# note\nA:\n  k: 1.10\n  'q/r': \"x: y\"\n\nTOP: v\n\"B:C\":\n    k: z # c\n  e:\nA2:\n  k: ~\n")
    rows = {(r["section"], r["key"]): r["value"] for r in read_sections(texts(spark, text)).collect()}
    assert rows == {("A", "k"): "1.10", ("A", "q/r"): "x: y", ("B:C", "k"): "z", ("B:C", "e"): None, ("A2", "k"): None}


def test_task_log(spark):
    lines = spark.createDataFrame([
        ("r", "l", 1, "Task completed > TaskHandler[id: 1; name:  P (1) ; status: X; workDir: /a b"),
        ("r", "l", 2, "Task submitted; name: Q; workDir: /c"),
        ("r", "l", 5, "Task completed > TaskHandler[name: P (1); workDir: /d]"),
    ], "run string, path string, pos bigint, content string")
    assert tuples(process_dirs(lines)) == [("r", "l", "P (1)", "/d]", 1)]


# ---- listing -----------------------------------------------------------------------------------

def test_folder_entries(tmp_path):
    (tmp_path / "real").mkdir()
    (tmp_path / "real" / "a.txt").write_text("hi")
    (tmp_path / "_b.txt").write_text("")
    (tmp_path / ".hidden.txt").write_text("x")
    (tmp_path / "folder.txt").symlink_to(tmp_path / "real")
    (tmp_path / "gone.txt").symlink_to(tmp_path / "nowhere")
    base = str(tmp_path)
    assert sorted(_children(base, "*.txt")) == [
        (f"{base}/_b.txt", False, 0), (f"{base}/folder.txt", True, -1), (f"{base}/gone.txt", False, -1)]
    assert list(_children(f"{base}/folder.txt", "a.txt")) == [(f"{base}/folder.txt/a.txt", False, 2)]
    assert list(_children(base, "none.txt")) == [] and list(_children(f"{base}/none", "*")) == []
    assert list(_children(f"{base}/_b.txt", "*")) == []
