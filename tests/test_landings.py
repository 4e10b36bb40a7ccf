"""Landings replace whole runs at once; readers see the old or the new rows, never both or none."""

import os

import pytest
import run_tree as tree
from pyspark.sql import functions as F
from run_tree import S1

from runweave.collector import RunCollector
from runweave.plans.sinks import read_table, tidy_table, write_table
from runweave.sources import landings
from runweave.sources.tables import LANDED, land_runs, load_runs


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs) or [], "run string, n long")


def content(spark, path):
    return sorted(map(tuple, read_table(spark, path).collect()))


def test_runs_are_replaced_as_wholes(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_table(rows(spark, ("a", 1), ("a", 2), ("b", 3)), path) == 3
    assert write_table(rows(spark, ("b", 4), ("c", 5)), path) == 2
    assert content(spark, path) == [("a", 1), ("a", 2), ("b", 4), ("c", 5)]
    at_hand = spark.createDataFrame([("a",), ("c",)], "run string")
    assert write_table(rows(spark, ("c", 6)), path, runs=at_hand) == 1  # a has no rows any more
    assert content(spark, path) == [("b", 4), ("c", 6)]
    assert write_table(rows(spark), path) == 0
    assert content(spark, path) == [("b", 4), ("c", 6)]


def test_a_reader_sees_old_or_new(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(rows(spark, *[("a", k) for k in range(50)], ("b", 1)), path)
    before = read_table(spark, path)
    landing = landings.new_landing()
    landings.write(rows(spark, *[("a", 100 + k) for k in range(9)]), path, "rows", landing)
    # all rows are there, the landing is not named yet
    during = read_table(spark, path)
    assert during.count() == 51 and content(spark, path)[:1] == [("a", 0)]
    landings.commit(rows(spark, ("a", 0)), path, landing)
    assert content(spark, path) == [("a", 100 + k) for k in range(9)] + [("b", 1)]
    assert before.count() == 51 and during.count() == 51  # frames made before stay as they were
    assert before.where("run = 'a' and n < 100").count() == 50


def test_a_landing_is_a_folder_whatever_its_runs(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(3000).selectExpr("concat('run', id) as run", "id as n"), path)
    assert len([f for f in os.listdir(f"{path}/rows") if f.startswith("landing=")]) == 1
    assert sum(len(files) for _, _, files in os.walk(path)) < 60
    assert read_table(spark, path).count() == 3000


def test_compaction_and_vacuum(spark, tmp_path):
    path = str(tmp_path / "t")
    slow = landings.new_landing()  # begins now, ends after the compaction
    for k in range(4):
        write_table(rows(spark, (f"r{k}", k), ("hot", k)), path)
    want = content(spark, path)
    landings.write(rows(spark, ("late", 7), ("hot", -1)), path, "rows", slow)
    assert tidy_table(spark, path) == []  # all younger than a day
    landings.commit(rows(spark, ("late", 0), ("hot", 0)), path, slow)
    want = sorted([*want, ("late", 7)])  # the newer rows of `hot` stay
    assert content(spark, path) == want
    gone = landings.vacuum(spark, path, ["rows"], keep_seconds=0)
    assert len(gone) == 4 and slow not in gone
    assert content(spark, path) == want
    assert len(os.listdir(f"{path}/rows")) == len(os.listdir(f"{path}/current")) == 2
    write_table(rows(spark, ("hot", 9)), path)
    assert ("hot", 9) in content(spark, path)


def test_landed_runs_are_parsed_once(spark, tmp_path):
    one, two = tree.write_run_one(tmp_path), tree.write_run_two(tmp_path)
    target = str(tmp_path / "landed")
    land_runs(spark, [one, two], target)
    old = load_runs(spark, target)
    tree.put(tmp_path, "RUN2/out/analysis/fastq/new.merged.fastq.gz")
    jobs = RunCollector.land(spark, two, target)
    assert {r.run for r in jobs.tables.runs.collect()} == {two}
    assert sorted(r["FastQID"] for r in jobs.summary().collect()) == sorted([S1, "new"])
    now = load_runs(spark, target)
    for name in LANDED:
        assert len(os.listdir(f"{target}/{name}")) == 2
    assert old.files("fastq").count() + 1 == now.files("fastq").count()
    # header and records come from the landed table: the jobs on parsed sources read no text
    for source in ("clades", "subtype", "idxstats", "mixtures"):
        assert {f.removeprefix(f"file://{target}/").split("/")[0] for f in now.parsed(source).inputFiles()} == {"parsed", "current"}
    landings.compact(spark, target, LANDED)
    assert load_runs(spark, target).files("fastq").count() == now.files("fastq").count()


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("both")
    runs = [tree.write_run_one(base), tree.write_run_two(base)]
    return RunCollector.scan(spark, runs), RunCollector.land(spark, runs, str(base / "landed"))


@pytest.mark.parametrize("name", ["summary", "events", "clades", "mixture_report"])
def test_scan_gives_what_landing_gives(both, name):
    live, landed = both
    key = lambda df: sorted(str(sorted(r.asDict(True).items(), key=str)) for r in df.collect())
    assert key(getattr(live, name)()) == key(getattr(landed, name)())


def test_a_frame_of_a_live_scan_may_be_filtered_twice(both):
    jobs = both[0]
    runs = [r.run for r in jobs.tables.runs.collect()]
    table, texts = jobs.manifest(), jobs.tables.texts
    assert table.where(F.col("run") == runs[0]).union(table.where(F.col("run") == runs[1])).count() == table.count() > 0
    halves = [texts.where(F.col("source") == s) for s in ("clades", "subtype")]
    assert halves[0].union(halves[1]).groupBy("source").count().count() == 2
