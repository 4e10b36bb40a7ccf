from types import SimpleNamespace

import pytest
import run_tree as tree
from run_tree import S1

from runweave.plans.sinks import read_table
from runweave.sources.tables import land_runs
from runweave.streaming.incremental import follow_landed_runs, progress_folder


def test_new_and_changed_runs_are_rolled_up(spark, tmp_path):
    landed, target, progress = (str(tmp_path / n) for n in ("landed", "summary", "progress"))

    def follow():
        follow_landed_runs(spark, landed, target, progress=progress).awaitTermination()
        table = read_table(spark, target, run="run_folder")
        return {(r["Run"], r["FastQID"]) for r in table.select("Run", "FastQID").collect()}

    two = tree.write_run_two(tmp_path)
    land_runs(spark, two, landed)
    assert follow() == {("RUN2", S1)}
    land_runs(spark, tree.write_run_one(tmp_path), landed)
    assert len(follow()) == 6
    tree.put(tmp_path, "RUN2/out/analysis/fastq/new.merged.fastq.gz")
    land_runs(spark, two, landed)
    assert ("RUN2", "new") in follow()


@pytest.mark.parametrize("shared, folder", [("/shared/", "/shared/x"), (None, None)])
def test_progress_folder_comes_from_the_session(shared, folder):
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: shared))
    if folder:
        assert progress_folder(session, "x") == folder
    else:
        with pytest.raises(ValueError):
            progress_folder(session, "x")
