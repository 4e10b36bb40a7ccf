"""The data source of run folders: filters decide what is listed and opened."""

import json
import random

import pytest
import run_tree as tree
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull

from runweave.config import CONTENT_SOURCES
from runweave.sources import content, run_files as source
from runweave.sources.run_files import RunFilesReader, run_files
from runweave.sources.task_log import process_dirs


@pytest.fixture(scope="module")
def runs(tmp_path_factory):
    base = tmp_path_factory.mktemp("files")
    return [tree.write_run_one(base), tree.write_run_two(base)]


def read(reader):
    parts = reader.partitions()
    return parts, [row for part in parts for batch in reader.read(part) for row in batch.to_pylist()]


def test_only_what_is_asked_for_is_listed_and_opened(runs, monkeypatch):
    opened, listed = [], []
    texts, children = source.read_text, source._children
    monkeypatch.setattr(source, "read_text", lambda path, kind: opened.append(path) or texts(path, kind))
    monkeypatch.setattr(source, "_children", lambda folder, pattern: listed.append(folder) or children(folder, pattern))
    options = {"runs": json.dumps(runs), "content": "true", "shares": "3"}

    _, every = read(RunFilesReader(options))
    assert len(opened) == len(set(opened)) == len({r["path"] for r in every}) > 20
    all_listed = len(listed)
    opened.clear()
    listed.clear()

    reader = RunFilesReader(options)
    kept = [In(("source",), ("subtype", "clades", "fastq")), IsNotNull(("run",)), GreaterThan(("pos",), 0)]
    assert list(reader.pushFilters(kept)) == [kept[2]]
    parts, some = read(reader)
    want = {r["path"] for r in every if r["source"] in ("subtype", "clades")}
    assert set(opened) == {r["path"] for r in some} == want and len(opened) == len(want)
    assert len(listed) < all_listed / 3

    opened.clear()
    reader = RunFilesReader(options)
    assert not list(reader.pushFilters([EqualTo(("source",), "clades"), EqualTo(("run",), runs[1])]))
    parts, one = read(reader)
    assert {p.runs for p in parts} == {(runs[1],)} and len(opened) == len(one) == 1
    reader = RunFilesReader(options)
    list(reader.pushFilters([EqualTo(("source",), "fastq")]))  # has no texts
    assert reader.partitions() == [] and list(reader.read(None)) == []


def test_tasks_carry_their_own_runs():
    names = [f"/r{k}" for k in range(1000)]
    reader = RunFilesReader({"runs": json.dumps(names), "shares": "2", "tasks": "8"})
    parts = reader.partitions()
    assert sorted(r for p in parts if p.share == 0 for r in p.runs) == sorted(names)
    assert max(len(p.runs) for p in parts) <= 64 and reader.__getstate__()["runs"] == []


def test_filters_are_in_the_plan_and_rows_are_equal(spark, runs, capsys):
    texts = run_files(spark, runs, content=True)
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    every = rows(texts)
    for name in CONTENT_SOURCES:
        assert rows(texts.where(F.col("source") == name)) == [r for r in every if r[1] == name]
    assert rows(texts.where(F.col("run") == runs[1])) == [r for r in every if r[0] == runs[1]]
    asked = texts.where(F.col("source").isin("clades", "versions")).where(F.col("run") == runs[0])
    assert rows(asked) == [r for r in every if r[1] in ("clades", "versions") and r[0] == runs[0]]
    asked.explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedFilters: [" in plan and "clades" in plan.split("PushedFilters: ")[1] and "Filter [" not in plan, plan
    assert run_files(spark, []).count() == 0 and run_files(spark, ["/nowhere"]).count() == 0


def test_one_run_is_shared_by_tasks(spark, tmp_path):
    for k in range(200):
        tree.put(tmp_path, f"mapping/s{k}/s{k}.x.idxstats", "a\t1\t2\t3\n")
    df = run_files(spark, [str(tmp_path)], content=True, shares=5).where("source = 'idxstats'")
    per_task = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 200 and len(per_task) == 5 and max(per_task) < 80
    assert df.select("path").distinct().count() == 200


def test_too_many_runs_are_refused(spark, monkeypatch):
    monkeypatch.setattr(source, "MOST_RUNS", 3)
    with pytest.raises(ValueError):
        source.folders(spark.range(4).selectExpr("string(id) as run"))
    assert source.folders(spark.range(3).selectExpr("string(2 - id) as run")) == ["0", "1", "2"]


def log(spark, path, length, part):
    files = spark.createDataFrame([("r", "task_log", str(path), "f", path.name, length)],
                                  "run string, source string, path string, folder string, name string, length bigint")
    return content.read_texts(files, part)


@pytest.mark.parametrize("part", [1, 7, 100, 1000, 1 << 20])
def test_a_log_is_read_in_parts(spark, tmp_path, part):
    rng = random.Random(part)
    lines = [rng.choice(["", "x", "noise é" * 3, f"Task completed > name: P{rng.randrange(5)}; workDir: /w/{k} é"]) for k in range(60)]
    text = "\n".join(lines) + rng.choice(["", "\n"])
    path = tmp_path / "1.nextflow.log"
    path.write_text(text, encoding="utf-8")
    size = len(text.encode())
    rows = log(spark, path, size, part)
    assert rows.rdd.getNumPartitions() > 1
    found = sorted((r.pos, r.content.rstrip("\n")) for r in rows.collect())
    assert [line for _, line in found] == [line for line in lines if "Task completed" in line]
    assert found == sorted((r.pos, r.content.rstrip("\n")) for r in log(spark, path, size, size + 1).collect())
    last = {r.process: r.workdir for r in process_dirs(rows).collect()}
    want = {}
    for line in lines:
        if "Task completed" in line:
            want[line.split("name: ")[1].split(";")[0]] = line.split("workDir: ")[1].split()[0]
    assert last == want


def test_a_log_that_breaks_is_broken_as_a_whole(spark, tmp_path):
    path = tmp_path / "1.nextflow.log"
    path.write_bytes(b"Task completed > name: A; workDir: /w/1 x\n" * 50 + b"Task completed \xff\n" + b"Task completed > name: B; workDir: /w/2 x\n")
    rows = content.whole_logs(log(spark, path, path.stat().st_size, 500)).collect()
    assert [(r.content, r.problem) for r in rows] == [(None, "UnicodeDecodeError")]
