"""Files and folders, and the lifecycle of scratch."""

from __future__ import annotations

import os
from pathlib import Path

import pytest

from skygauge import files
from skygauge.session import STALE_SECONDS, materialize, scratch_of, scratch_path, scratch_root, settle


def test_texts_listings_moves(spark, tmp_path):
    root = str(tmp_path / "a")
    assert files.entries(spark, root) == [] and files.files_below(spark, root) == []
    assert files.read_text(spark, f"{root}/x") is None and not files.exists(spark, f"{root}/x")
    files.write_text(spark, f"{root}/b/x", "é\n")
    files.write_text(spark, f"{root}/_hidden", "1")
    files.write_text(spark, f"{root}/_hidden", "22")
    assert [(e.name, e.folder) for e in files.entries(spark, root)] == [("_hidden", False), ("b", True)]
    assert files.read_text(spark, f"{root}/b/x") == "é\n" and files.read_text(spark, f"{root}/_hidden") == "22"
    files.move(spark, f"{root}/b/x", f"{root}/c/d/y")
    assert [(e.name, e.size) for e in files.files_below(spark, root)] == [("_hidden", 2), ("y", 3)]
    with pytest.raises(OSError):
        files.move(spark, f"{root}/b/x", f"{root}/c/z")
    assert files.remove(spark, root) and not files.remove(spark, root)


def folder_of(spark, job):
    return Path(scratch_root(spark)) / "skygauge" / job


def test_a_run_has_a_folder_of_its_own_and_removes_it(spark):
    with scratch_of(spark, "job-a") as outer:
        kept = materialize(spark.range(3), "x")
        with scratch_of(spark, "job-a") as inner:
            assert inner != outer and scratch_path(spark, "y").startswith(inner)
        assert not Path(inner).exists() and Path(outer).exists()
        assert kept.table.count() == 3 and scratch_path(spark, "y").startswith(outer)
    assert list(folder_of(spark, "job-a").iterdir()) == []


def test_a_failing_run_removes_its_folder(spark):
    with pytest.raises(ValueError), scratch_of(spark, "job-b"):
        materialize(spark.range(3), "x")
        raise ValueError
    assert list(folder_of(spark, "job-b").iterdir()) == []


def test_folders_of_dead_runs_go_with_age(spark):
    old, fresh = folder_of(spark, "job-c") / "old", folder_of(spark, "job-c") / "fresh"
    for folder in (old, fresh):
        folder.mkdir(parents=True)
        (folder / "_owner").write_text("gone")
    past = (old / "_owner").stat().st_mtime - STALE_SECONDS - 10
    os.utime(old / "_owner", (past, past))
    os.utime(old, (past, past))
    with scratch_of(spark, "job-c"):
        assert not old.exists() and fresh.exists()


def test_settle_keeps_the_answer_only(spark):
    with scratch_of(spark, "job-d") as folder:
        def build():
            first = materialize(spark.range(10), "first").table
            second = settle(lambda: materialize(first.filter("id > 3"), "inner").table.filter("id > 4"), "second").table
            return first.join(second, "id")

        done = settle(build, "done")
        assert done.rows == 5 and done.table.count() == 5
        names = [e.name.split("-", 1)[1] for e in files.entries(spark, folder) if e.folder]
        assert names == ["done"]
        done.release()
        assert [e.name for e in files.entries(spark, folder)] == ["_owner"]


def test_steps_without_a_run_belong_to_the_session(spark):
    path = materialize(spark.range(1), "z").path
    assert f"/sessions/{spark.sparkContext.applicationId}/z-" in path
