"""What must not be lost: quoted cells, clashing column names, rows of vanished files, columns of other landings."""

from __future__ import annotations

import shutil

import pytest
import run_tree as tree
from pyspark.sql import functions as F
from run_tree import S1, S2

from runweave.collector import RunCollector
from runweave.plans.sinks import read_table
from runweave.sources.delimited import delimited_rows, parse_delimited
from runweave.sources.tables import land_runs
from runweave.streaming import incremental


@pytest.mark.parametrize("text, records, problem", [
    ('a,b\n5" x,2\n3,4', [{"a": '5" x', "b": "2"}, {"a": "3", "b": "4"}], None),
    ('a,b\n"x, y","1\n2"\n', [{"a": "x, y", "b": "1\n2"}], None),
    ('a,b\n"""q""",""\n', [{"a": '"q"', "b": ""}], None),
    ('a,b\n"q" r,2\n3,"4"', [{"a": '"q" r', "b": "2"}, {"a": "3", "b": "4"}], None),
    ('a,b\n"open,2\n3,4', [], "unclosed quote"),
    ('a,b\n\n"1"\n', [{"a": "1", "b": None}], None),
])
def test_quotes(spark, text, records, problem):
    parsed = parse_delimited(spark.createDataFrame([(text,)], "content string"), ",")
    assert parsed.first()["problem"] == problem
    assert [r["cells"] for r in delimited_rows(parsed).orderBy("pos").collect()] == records


def test_names_that_clash_keep_their_columns(spark, tmp_path):
    run = tree.write_run_one(tmp_path)
    tree.put(tmp_path, f"RUN1/out/analysis/mixtures/{S2}/{S2}_mixtures.csv",
             f"sample_name,path,Run,HA_read_ratio,ha_read_ratio\n{S2},p,r,1,2\n")
    tree.put(tmp_path, f"RUN1/out/analysis/nextclade/{S1}/c.h5.nextclade.tsv",
             f"seqName\tclade\talignmentScore\tdataset\tSegment\tClade\n{S1}_segment4_HA\tbest\t9999\td\ts\tc\n")
    jobs = RunCollector.land(spark, run, str(tmp_path / "landed"))
    row = jobs.mixture_report().where(F.col("FastQID") == S2).first().asDict()
    assert [row[c] for c in ("path.1", "Run.1", "HA_read_ratio", "ha_read_ratio.1")] == ["p", "r", "1", "2"] or \
        [row[c] for c in ("path.1", "Run.1", "ha_read_ratio", "HA_read_ratio.1")] == ["p", "r", "2", "1"]
    best = jobs.clades().where(F.col("sample") == S1).first().asDict()
    assert best["clade"] == "best" and best["dataset.1"] == "d" and best["Segment.1"] == "s" and best["Clade.1"] == "c"
    jobs.write_mixture_report(str(tmp_path / "mixtures"))
    jobs.write_clades(str(tmp_path / "clades"))
    renamed = {r["detail"]["column"] for r in jobs.events().where("event_type = 'column_renamed'").collect()}
    assert {"path", "Run", "dataset", "Segment", "Clade"} <= renamed


def test_vanished_files_leave_no_rows(spark, tmp_path):
    landed, manifest = str(tmp_path / "landed"), str(tmp_path / "manifest")
    run = tree.write_run_one(tmp_path)
    RunCollector.land(spark, run, landed).write_manifest(manifest)
    assert read_table(spark, manifest).count() > 0
    for folder in ("consensus", "nextclade", "fastq"):
        shutil.rmtree(f"{run}/{folder}")
    jobs = RunCollector.land(spark, run, landed)
    assert jobs.tables.texts.where("source in ('consensus', 'clades')").count() == 0
    assert jobs.summary().count() == 0
    assert jobs.write_manifest(manifest) == 0
    assert read_table(spark, manifest).count() == 0
    kinds = {r["detail"]["rows"] for r in jobs.events().where("event_type = 'consensus_manifest_written'").collect()}
    assert kinds == {"0"}


def test_status_of_different_pipelines_in_one_table(spark, tmp_path):
    landed, status = str(tmp_path / "landed"), str(tmp_path / "status")
    jobs = RunCollector.land(spark, tree.write_run_one(tmp_path), landed, auto_mode=True)
    jobs.write_pipeline_status(status)
    with pytest.raises(ValueError):
        jobs.write_summary_table(str(tmp_path / "summary"))
    tree.put(tmp_path, "RUN3/out/samplesheets/r_start_samplesheet.csv", f"ID\n{S1}\n")
    tree.put(tmp_path, "RUN3/out/samplesheets/X_other_output_samplesheet.csv", f"ID\n{S1}\n")
    run = tmp_path / "RUN3" / "out" / "analysis"
    run.mkdir(parents=True)
    RunCollector.land(spark, str(run), landed, auto_mode=True).write_pipeline_status(status)
    rows = read_table(spark, status)
    assert {"typing", "trees", "other", "nf-flu"} <= {r["pipeline"] for r in rows.select("pipeline").distinct().collect()}
    wide = jobs.pipeline_status()
    for name in ("typing", "trees"):
        long = {(r["sample"], r["status"]) for r in rows.where(F.col("pipeline") == name).collect()}
        assert long == {(r["sample"], r[f"status_{name}"]) for r in wide.collect()}


def test_two_folders_with_a_clade_give_an_event(spark, tmp_path):
    run = tree.write_run_two(tmp_path)
    tree.put(tmp_path, "RUN2/out/analysis/nextclade/zz/b.nextclade.tsv",
             f"seqName\tclade\talignmentScore\n{S1}_segment4_HA\tlost\t99\n")
    jobs = RunCollector.land(spark, run, str(tmp_path / "landed"))
    found = jobs.events().where("event_type = 'duplicate_key' and detail['source'] = 'clades'").collect()
    assert [(r["sample"], r["detail"]["n"]) for r in found] == [(S1, "2")]


def test_each_target_has_its_own_progress(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "progress_folder", lambda session, name: str(tmp_path / name))
    landed = str(tmp_path / "landed")
    land_runs(spark, tree.write_run_two(tmp_path), landed)
    for target in ("one", "two"):
        incremental.follow_landed_runs(spark, landed, str(tmp_path / target)).awaitTermination()
        assert read_table(spark, str(tmp_path / target), run="run_folder").count() == 1
