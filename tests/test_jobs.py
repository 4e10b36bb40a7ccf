"""Golden tests of the jobs on a two-run tree; expected values are worked out by hand."""

from __future__ import annotations

import csv
import glob

import pytest
import run_tree as tree
from run_tree import S1, S2, S3, S4, S5

from runweave.collector import RunCollector
from runweave.config import EXPECTED_COLUMNS


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    return tmp_path_factory.mktemp("runs")


@pytest.fixture(scope="module")
def collector(spark, base):
    runs = [tree.write_run_one(base) + "/", tree.write_run_two(base)]
    return RunCollector.land(spark, runs, str(base / "landed"))


@pytest.fixture(scope="module")
def summary(collector):
    return {(r["Run"], r["FastQID"]): r for r in collector.summary().collect()}


@pytest.fixture(scope="module")
def events(collector):
    return [(r["run"].split("/")[-3] if r["run"] else None, r["sample"], r["event_type"], r["detail"])
            for r in collector.events().collect()]


def test_listing_sees_folders_empty_and_underscore_files(collector):
    names = {r["name"]: r for r in collector.tables.listing.collect()}
    assert f"{S5}.merged.fastq.gz" in names
    assert names[f"{S2}.cleavage.tsv"]["length"] == 0
    assert names["nofiles"]["is_dir"]
    assert "other.txt" not in names


def test_scan_and_landed_tables_agree(spark, collector):
    live = RunCollector.scan(spark, collector.tables.runs.select("run"))
    columns = ["run", "source", "path", "folder", "name", "pos", "content", "problem"]
    key = lambda rows: sorted(tuple(map(str, r)) for r in rows)
    assert key(live.tables.texts.select(*columns).collect()) == key(collector.tables.texts.select(*columns).collect())


def test_one_row_per_sample_and_fixed_columns(collector, summary):
    assert set(summary) == {("RUN1", s) for s in (S1, S2, S3, S4, S5)} | {("RUN2", S1)}
    assert collector.summary().columns == ["run_folder", "roster_pos", *EXPECTED_COLUMNS]
    assert len(EXPECTED_COLUMNS) == 64


@pytest.mark.parametrize("sample, key", [
    (S1, ("R1234567890", "2404", "A", "D09")),
    (S2, ("POS20240101", "2404", "A", "D10")),
    (S3, ("R1234567890", "2404", "A", "D11")),
    (S4, ("foo", None, None, None)),
    (S5, ("_odd", None, None, None)),
])
def test_sample_key(summary, sample, key):
    row = summary["RUN1", sample]
    assert (row["CID"], row["Plate"], row["Index"], row["Well"]) == key


@pytest.mark.parametrize("run, sample, expected", [
    ("RUN1", S1, ("H5N1", "H5", "N1", "HA and NA subtype successful")),
    ("RUN1", S2, ("H5", "H5", None, "HA subtype successful")),
    ("RUN1", S3, ("N1", None, "N1", "NA subtype successful")),
    ("RUN1", S4, ("", None, None, "No subtype for HA or NA")),
    ("RUN1", S5, (None, None, None, "No subtype for HA or NA")),
    ("RUN2", S1, (None, None, None, None)),   # no subtype table in the run
])
def test_subtype(summary, run, sample, expected):
    row = summary[run, sample]
    assert (row["subtype"], row["HA_subtype"], row["NA_subtype"], row["subtype_HA_NA_status"]) == expected


def test_mapped_reads(summary):
    row = summary["RUN1", S1]
    assert (row["HA_reads_mapped"], row["HA_seq_length"]) == (99, 1702)   # the later file name wins
    assert (row["NA_reads_mapped"], row["M_reads_mapped"]) == (0, 0)      # one row, three rows
    assert summary["RUN1", S2]["NA_reads_mapped"] == 0                    # length is no number
    assert summary["RUN1", S5]["PB2_seq_length"] == 2341
    assert summary["RUN2", S1]["HA_seq_length"] == 0


def test_completeness_and_tree_pass(summary):
    row = summary["RUN1", S1]
    assert (row["HA_consensus_completeness"], row["HA_tree_pass"]) == (95.0, 1)   # last record wins
    assert row["NA_consensus_completeness"] == 100.0                              # gaps and codes count
    assert (row["M_consensus_completeness"], row["M_tree_pass"]) == (0.0, 0)      # empty sequence
    row = summary["RUN1", S2]
    assert (row["HA_consensus_completeness"], row["HA_tree_pass"]) == (90.0, 0)   # 90 is not above 90
    assert (row["PA_consensus_completeness"], row["PA_tree_pass"]) == (99.9, 1)


@pytest.mark.parametrize("sample, expected", [
    (S1, (1035, 1061, "PLREKRRKR")), (S2, (None, None, None)), (S3, (None, None, None)),
    (S4, (None, None, "MOTIF")), (S5, (None, None, None)),
])
def test_cleavage(summary, sample, expected):
    row = summary["RUN1", sample]
    assert (row["HPAI_cleave_start"], row["HPAI_cleave_end"], row["HPAI_cleavage_site_motif"]) == expected


@pytest.mark.parametrize("sample, genotype, segments", [
    (S1, "B3.2", {"PB2": "am1.2", "PB1": "am4", "PA": "ea1", "HA": "ea1", "NP": "am8", "NA": "ea1", "M": "ea1",
                  "NS": "am1.1"}),
    (S2, "Not assigned", {}),
    (S3, "A1", {}),                       # malformed list
    (S4, "A1", {"HA": "last"}),           # last entry wins; an own M entry does not count
    (S5, None, {}),
])
def test_genotype(summary, sample, genotype, segments):
    row = summary["RUN1", sample]
    assert row["GenoFLU_Genotype"] == genotype
    assert {s: row[f"GenoFLU_{s}"] for s in ("HA", "NA", "M", "NP", "NS", "PA", "PB1", "PB2")
            if row[f"GenoFLU_{s}"] is not None} == segments


def test_versions_stay_text(summary):
    row = summary["RUN1", S4]
    assert (row["genoflu_version"], row["nextclade_version"], row["nfflu_version"]) == ("1.10", "3.8.2", "v3.5.0")
    assert summary["RUN2", S1]["genoflu_version"] is None


def test_clades_in_summary(summary):
    row = summary["RUN1", S1]
    assert [row[c] for c in EXPECTED_COLUMNS if c.startswith("Nextclade_")] == [
        "2.3.4.4b", "s1", None, 1.5, "good", "flu_h5_all", "2024-05-08"]
    assert summary["RUN1", S2]["Nextclade_clade"] is None     # its file's best row is another sample's
    assert summary["RUN2", S1]["Nextclade_dataset_name"] == "N/A"


def test_best_clade_table(collector):
    table = collector.clades()
    assert [c for c in table.columns if c not in ("run", "path")] == [
        "sample", "seqName", "segment", "dataset", "clade", "alignmentScore", "legacy-clade",
        "subclade", "qc.overallScore", "qc.overallStatus", "nextclade_dataset_name", "nextclade_dataset_version"]
    rows = {r["sample"]: r for r in table.where("run like '%RUN1%'").collect()}
    assert set(rows) == {S1, "other"}
    assert rows["other"]["legacy-clade"] == 'tab\there "q"'
    assert rows["other"]["dataset"] == "N/A"


def test_legacy_clade_and_all_segments(collector):
    legacy = RunCollector(collector.tables, legacy_clade=True).clades().where("sample = 'other'").first()
    assert legacy["clade"] == legacy["legacy-clade"]
    every = RunCollector(collector.tables, ha_only=False).clades().where("run like '%RUN1%'").collect()
    assert {r["sample"]: r["clade"] for r in every}[S1] == "never"


def test_mixture_report(collector):
    rows = {r["FastQID"]: r for r in collector.mixture_report().collect()}
    assert set(rows) == {S1, S2}
    assert rows[S2]["extra"] == "a, b" and rows[S2]["mixture_present"] is None
    assert rows[S1]["ha_read_ratio"] == "0.62"


def test_auto_mode_roster_and_status(collector):
    table = RunCollector(collector.tables, auto_mode=True).summary()
    assert table.columns[-4:] == ["status_nf-flu_sheet", "status_trees", "status_typing", "status_nf-flu"]
    rows = table.orderBy("roster_pos").collect()
    assert [(r["Run"], r["FastQID"]) for r in rows] == [("RUN1", s) for s in (S4, S1, S2, S3, "late")]
    assert [r["status_nf-flu"] for r in rows] == [0, 0, 9, 2, 1]
    assert [r["status_typing"] for r in rows] == [1, 0, 0, 1, 1]
    assert [r["status_trees"] for r in rows] == [1, 0, 1, 1, 1]
    assert [r["status_nf-flu_sheet"] for r in rows] == [0, 1, 1, 1, 1]


def test_manifest(collector):
    rows = {r["sample"]: r["length"] for r in collector.manifest().collect()}
    assert set(rows) == {S1, S2, S3, S4} and rows[S3] == 0


@pytest.mark.parametrize("event", [
    ("RUN1", None, "samples_collected"), ("RUN1", S2, "cleavage_file_empty"),
    ("RUN1", S2, "idxstats_file_read_error"), ("RUN1", S1, "unexpected_idxstats_format"),
    ("RUN1", S1, "segment_name_extraction_failed"), ("RUN1", S1, "unexpected_column_found"),
    ("RUN1", S1, "unknown_segment_found"), ("RUN1", S3, "genoflu_file_read_error"),
    ("RUN1", S3, "subtype_file_read_error"), ("RUN1", S4, "duplicate_key"),
    ("RUN1", S3, "unexpected_mixture_report_rows"), ("RUN1", "nofiles", "no_nextclade_tsv_files_found"),
    ("RUN1", S4, "no_valid_dataframes_collected"), ("RUN1", None, "nextclade_file_read_error"),
    ("RUN1", None, "tsv_file_read_failed"), ("RUN2", None, "nextflow_log_not_found"),
    ("RUN2", None, "no_nextclade_datasets_data"), ("RUN2", None, "no_valid_mixture_reports_found"),
])
def test_events(events, event):
    assert event in {(run, sample, kind) for run, sample, kind, _ in events}


def test_events_of_auto_mode(collector):
    found = {(r["run"].split("/")[-3] if r["run"] else None, r["sample"], r["event_type"])
             for r in RunCollector(collector.tables, auto_mode=True).events().collect()}
    assert {("RUN1", S1, "duplicate_key"), ("RUN1", None, "samplesheet_read_error"),
            ("RUN1", None, "no_files_found_for_stage"), ("RUN2", None, "multiple_files_found"),
            ("RUN2", None, "start_samplesheet_not_found"), ("RUN2", None, "no_samples_found"),
            ("RUN2", None, "no_sample_names_found")} <= found


def test_text_outputs(collector, base):
    out = str(base / "summary")
    assert collector.write_summary(out) == 6
    rows = [r for part in sorted(glob.glob(f"{out}/*.csv")) for r in csv.DictReader(open(part, encoding="utf-8"))]
    assert list(rows[0]) == list(EXPECTED_COLUMNS)
    by = {(r["Run"], r["FastQID"]): r for r in rows}
    assert by["RUN1", S4]["subtype"] == "" and by["RUN1", S5]["subtype"] == ""
    none = RunCollector(collector.tables, auto_mode=True)
    empty = none.summary().where("FastQID = 'nobody'")
    from runweave.plans.sinks import write_text
    assert not write_text(empty, str(base / "nothing"), ["run_folder", "roster_pos"])
    assert not (base / "nothing").exists()
    assert (collector.write_clades(str(base / "clades")), collector.write_mixture_report(str(base / "mix"))) == (3, 2)
    collector.write_dataset_versions(str(base / "datasets"))
    kinds = {r["event_type"]: r["detail"]["rows"] for r in collector.events().where("detail['output'] is not null").collect()}
    assert kinds == {"results_written": "6", "nextclade_results_written": "3", "mixture_report_written": "2",
                     "nextclade_datasets_written": "1"}


def test_versions_table_and_status_table(collector):
    table = collector.dataset_versions().where("nextclade_dataset_name = 'flu_h5_all'")
    assert [r["nextclade_filename"] for r in table.collect()] == ["a.h5.nextclade.tsv"]
    assert collector.pipeline_status().count() == 5


def test_custom_and_empty_column_lists(collector):
    some = RunCollector(collector.tables, expected_columns=("CID", "nowhere")).summary()
    assert some.columns == ["run_folder", "roster_pos", "CID", "nowhere"]
    assert {r["nowhere"] for r in some.collect()} == {None}
    free = RunCollector(collector.tables, expected_columns=()).summary()
    assert set(EXPECTED_COLUMNS) <= set(free.columns)


def test_landing_replaces_only_the_given_runs(spark, base):
    one, two = tree.write_run_one(base / "again"), tree.write_run_two(base / "again")
    target = str(base / "landed_again")
    RunCollector.land(spark, [one, two], target)
    tree.put(__import__("pathlib").Path(two), "fastq/new.merged.fastq.gz")
    RunCollector.land(spark, two, target)
    names = [(r["Run"], r["FastQID"]) for r in RunCollector.landed(spark, target).summary().collect()]
    assert sorted(names) == sorted([("RUN1", s) for s in (S1, S2, S3, S4, S5)] + [("RUN2", S1), ("RUN2", "new")])
