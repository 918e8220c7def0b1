"""Publishing by a commit log: what readers see whenever a writer stops."""

from __future__ import annotations

import threading

import pytest

from covermonth.plans import layers
from covermonth.plans.layers import Options, Paths
from covermonth.sinks import commits, tables
from covermonth.sinks.commits import (
    CommitConflict,
    commit_version,
    current_commit,
    new_version,
    sweep,
)
from covermonth.sinks.tables import last_commit, published, write_report
from covermonth.sources.parquet_files import read_consolidated, report_paths
from verification.files import write_core_folders
from verification.inputs import RUN_DATE, core_raw
from conftest import SF_DIR


def seen(spark, path):
    return spark.read.parquet(published(spark, path)).count()


def test_commits_replace_each_other(spark, tmp_path):
    path = f"{tmp_path}/r.parquet"
    for rows in (3, 5, 2):
        assert write_report(spark.range(rows), path, by_log=True) == rows
        assert seen(spark, path) == rows
    assert current_commit(spark, path).number == 3
    # A path that has a log keeps it.
    write_report(spark.range(7), path)
    assert seen(spark, path) == 7 and last_commit(spark, path) == 4


@pytest.mark.parametrize("step", ["_write_counted", "commit_version", "sweep"])
def test_a_writer_may_stop_between_any_two_steps(spark, tmp_path, monkeypatch, step):
    path = f"{tmp_path}/r.parquet"
    write_report(spark.range(3), path, by_log=True)

    def stop(*args, **kwargs):
        raise KeyboardInterrupt(step)

    with monkeypatch.context() as patch:
        patch.setattr(tables, step, stop)
        with pytest.raises(KeyboardInterrupt):
            write_report(spark.range(5), path, by_log=True)
    # Only the entry in the log publishes; sweeping comes after it.
    assert seen(spark, path) == (5 if step == "sweep" else 3)
    write_report(spark.range(4), path, by_log=True)
    assert seen(spark, path) == 4


def test_a_writer_may_stop_inside_its_commit(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/r.parquet"
    write_report(spark.range(3), path, by_log=True)
    whole = '{"number": 2, "version": "x", "rows": 5, "end": true}'
    for cut in range(0, len(whole) - 1, 7):
        (tmp_path / "r.parquet/_commits" / f"{2:020}.json").write_text(whole[:cut])
        (tmp_path / "r.parquet/_commits" / f".{2:020}.json.crc").unlink(missing_ok=True)
        assert seen(spark, path) == 3
    write_report(spark.range(4), path, by_log=True)
    assert seen(spark, path) == 4 and last_commit(spark, path) == 3


def test_nothing_is_renamed_and_old_readers_go_on(spark, tmp_path):
    path = f"{tmp_path}/r.parquet"
    write_report(spark.range(3), path, by_log=True)
    reader = spark.read.parquet(published(spark, path))
    files = {f for f in tmp_path.rglob("part-*") if f.suffix == ".parquet"}
    write_report(spark.range(4), path, by_log=True)
    assert files < set(tmp_path.rglob("part-*"))
    assert reader.count() == 3


def test_of_two_writers_with_one_start_the_second_is_refused(spark, tmp_path):
    path = f"{tmp_path}/r.parquet"
    write_report(spark.range(3), path, by_log=True)
    start = last_commit(spark, path)
    versions = [new_version(path), new_version(path)]
    for rows, version in zip((5, 6), versions, strict=True):
        spark.range(rows).write.parquet(version)
    commit_version(spark, path, versions[0], 5, start)
    with pytest.raises(CommitConflict):
        commit_version(spark, path, versions[1], 6, start)
    assert seen(spark, path) == 5
    # Without a start the later one wins.
    commit_version(spark, path, versions[1], 6)
    assert seen(spark, path) == 6


def test_many_writers_at_once_get_numbers_of_their_own(spark, tmp_path):
    path = f"{tmp_path}/r.parquet"
    write_report(spark.range(1), path, by_log=True)
    versions = [new_version(path) for _ in range(8)]
    found = []
    threads = [threading.Thread(
        target=lambda v=v: found.append(commit_version(spark, path, v, 1).number)) for v in versions]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(found) == list(range(2, 10))


def test_of_writers_that_meet_at_a_number_one_wins(spark, tmp_path):
    meet, won = threading.Barrier(4), []

    def race(writer):
        for number in range(100):
            meet.wait()
            if commits._create(spark, f"{tmp_path}/r/_commits/{number}", f"{writer}"):
                won.append((number, writer))

    threads = [threading.Thread(target=race, args=(i,)) for i in range(4)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(n for n, _ in won) == list(range(100))
    folder = tmp_path / "r/_commits"
    assert all((folder / f"{n}").read_text() == f"{writer}" for n, writer in won)
    assert len(list(folder.iterdir())) == 100


def test_sweeping_keeps_what_commits_name_and_what_may_be_in_writing(spark, tmp_path):
    path = f"{tmp_path}/r.parquet"
    for rows in (1, 2, 3, 4):
        write_report(spark.range(rows), path, by_log=True)
    spark.range(9).write.parquet(new_version(path))  # not committed
    assert sweep(spark, path, keep=2) and seen(spark, path) == 4
    assert len(list((tmp_path / "r.parquet/_versions").iterdir())) == 5
    sweep(spark, path, keep=2, grace_seconds=-60)
    assert len(list((tmp_path / "r.parquet/_versions").iterdir())) == 2
    assert seen(spark, path) == 4 and last_commit(spark, path) == 4


def test_an_empty_or_failing_run_publishes_nothing(spark, tmp_path):
    path = f"{tmp_path}/r.parquet"
    with pytest.raises(ValueError, match="no rows"):
        write_report(spark.range(0), path, by_log=True)
    with pytest.raises(FileNotFoundError):
        commits.current_version(spark, path)
    assert published(spark, path) == path


def test_a_layered_run_by_log(spark, tmp_path):
    write_core_folders(core_raw(spark, SF_DIR), f"{tmp_path}/core", [{}])
    paths = Paths(core=f"{tmp_path}/core", lake=f"{tmp_path}/lake", reports=f"{tmp_path}/gold")
    for _ in range(2):
        rows = layers.run_layers(spark, paths, sources=("core",), run_date=RUN_DATE,
                                 options=Options(by_log=True))
    assert read_consolidated(spark, paths.reports).count() == rows["gold", "core"]
    (report,) = report_paths(spark, paths.reports)
    assert last_commit(spark, report) == 2
    layers.reprocess_reports(spark, paths.reports, f"{tmp_path}/again")
    layers.sort_reports(spark, paths.reports, f"{tmp_path}/sorted")
    assert spark.read.parquet(*report_paths(spark, f"{tmp_path}/sorted")).count() == rows["gold", "core"]


@pytest.mark.parametrize("path,log", [
    ("s3a://b/t", True), ("gs://b/t", True), ("hdfs://n/t", False), ("/t", False), ("file:///t", False)])
def test_object_stores_are_published_by_log(path, log):
    assert commits.is_object_store(path) is log
