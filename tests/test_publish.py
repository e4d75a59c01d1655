"""Runs that are published at once: one takes the version, the other fails and changes nothing."""

import threading

import pytest

from shelfcast.sources import files
from shelfcast.sources.runs import PublishConflictError, RunFolder


def test_the_second_of_two_runs_loses(spark, tmp_path):
    out = str(tmp_path / "out")
    first, second = RunFolder.create(spark, out), RunFolder.create(spark, out)
    first.publish()
    with pytest.raises(PublishConflictError, match="version 1 was taken by another run"):
        second.publish()
    assert RunFolder.published(spark, out).run_id == first.run_id
    third = RunFolder.create(spark, out)
    third.publish()
    assert RunFolder.published(spark, out).run_id == third.run_id
    assert sorted(files.names(spark, f"{out}/CURRENT")) == [f"{v:020d}" for v in (1, 2)]


def test_many_publishers_at_once(spark, tmp_path):
    out = str(tmp_path / "out")
    runs = [RunFolder.create(spark, out) for _ in range(12)]
    start, won, lost = threading.Barrier(len(runs)), [], []

    def publish(run):
        start.wait()
        try:
            run.publish()
            won.append(run.run_id)
        except PublishConflictError:
            lost.append(run.run_id)

    threads = [threading.Thread(target=publish, args=(run,)) for run in runs]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and len(lost) == 11
    assert RunFolder.published(spark, out).run_id == won[0]
    assert files.names(spark, f"{out}/CURRENT") == [f"{1:020d}"]


def test_an_unfinished_manifest_is_passed_over(spark, tmp_path):
    out = str(tmp_path / "out")
    run = RunFolder.create(spark, out)
    run.publish()
    (tmp_path / "out" / "CURRENT" / f"{2:020d}").write_text("")
    (tmp_path / "out" / "CURRENT" / f"{3:020d}").write_text('{"version": 3, "ru')
    assert RunFolder.published(spark, out).run_id == run.run_id
    later = RunFolder.create(spark, out)
    later.publish()
    assert later.version == 4 and RunFolder.published(spark, out).run_id == later.run_id


def test_create_new_on_other_file_systems(spark, tmp_path):
    """The way that HDFS and object stores take, here on a view of the local disk."""
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.pub.link./out", tmp_path.as_uri())
    path = "viewfs://pub/out/a"
    assert files.create_new(spark, path, "one\n") and not files.create_new(spark, path, "two\n")
    assert files.read_text(spark, path) == "one\n"
