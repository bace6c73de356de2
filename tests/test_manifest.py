"""Numbered manifest versions: exclusive commits, conflicts, checkpoints."""

import threading

import pytest
from pyspark.sql import functions as F

from rankflow.plans import manifest
from rankflow.plans.cleansed import read_cleansed, write_cleansed
from rankflow.plans.manifest import (
    CommitConflict, Files, commit, head, newest_snapshots, read_manifest,
)
from rankflow.plans.queries import _cleansed

SF = "/root/testdata/sf0.001"
ROWS = "dataset string, season int, snapshot string, folder string, rows long, format string"


def snap(spark, season, stamp, rows=1):
    return spark.createDataFrame(
        [("cleansed", season, stamp, f"season={season}/snapshot={stamp}", rows, "parquet")], ROWS)


def test_versions_count_up_and_can_be_read_as_of_then(spark, tmp_path):
    root = str(tmp_path)
    assert head(spark, root) == -1 and read_manifest(spark, root).collect() == []
    assert [commit(snap(spark, 2024, f"s{i}"), root) for i in range(3)] == [0, 1, 2]
    assert head(spark, root) == 2
    assert newest_snapshots(spark, root, "cleansed").first().snapshot == "s2"
    assert newest_snapshots(spark, root, "cleansed", version=1).first().snapshot == "s1"
    assert newest_snapshots(spark, root, "cleansed", version=-1).collect() == []


def test_a_file_is_created_once_and_whole(spark, tmp_path):
    files = Files(spark, str(tmp_path))
    assert files.create("a/b.json", "first") and not files.create("a/b.json", "second")
    assert files.read("a/b.json") == "first" and files.names("a") == ["b.json"]
    files.replace("a/b.json", "third")
    assert files.read("a/b.json") == "third"
    assert files.read("a/none") is None and files.names("none") == []


def test_the_later_of_two_writers_of_a_season_is_refused(spark, tmp_path):
    root = str(tmp_path)
    base = head(spark, root)
    commit(snap(spark, 2024, "mine"), root, base)
    with pytest.raises(CommitConflict, match="2024"):
        commit(snap(spark, 2024, "theirs"), root, base)
    assert commit(snap(spark, 2023, "other season"), root, base) == 1
    assert commit(snap(spark, 2024, "after reading"), root, head(spark, root)) == 2
    assert {r.snapshot for r in read_manifest(spark, root).collect()} == {
        "mine", "other season", "after reading"}


def test_many_writers_at_once_get_versions_of_their_own(spark, tmp_path):
    root, got, frames = str(tmp_path), [], [snap(spark, i, "s") for i in range(8)]
    threads = [threading.Thread(target=lambda f=f: got.append(commit(f, root))) for f in frames]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == list(range(8))
    rows = read_manifest(spark, root).collect()
    assert sorted(r.season for r in rows) == list(range(8))
    assert sorted(r.version for r in rows) == list(range(8))


def test_one_of_two_concurrent_writes_of_a_season_wins(spark, tmp_path):
    """Both compute first; whoever commits first is served whole, the other's
    folder is never read."""
    out = str(tmp_path / "store")
    rows = _cleansed(spark, SF).where("season = 1995").cache()
    meet, ended = threading.Barrier(2), {}

    def write(name, stamp, points):
        real = manifest.head(spark, out)
        meet.wait()  # both have begun
        try:
            write_cleansed(rows.withColumn("points", F.lit(points)), out, stamp)
            ended[name] = "won"
        except CommitConflict:
            ended[name] = "refused"
        assert real == -1

    writers = [threading.Thread(target=write, args=a) for a in
               (("a", "2024-01-01T00-00-00Z", 1), ("b", "2024-02-01T00-00-00Z", 2))]
    for t in writers:
        t.start()
    for t in writers:
        t.join()
    served = read_cleansed(spark, out).collect()
    assert len(served) == rows.count() and len({r.points for r in served}) == 1
    if sorted(ended.values()) == ["refused", "won"]:  # they did overlap
        winner = 1 if ended["a"] == "won" else 2
        assert {r.points for r in served} == {winner}
    assert "won" in ended.values()


def test_a_stamp_is_one_writers(spark, tmp_path):
    out = str(tmp_path / "store")
    rows = _cleansed(spark, SF).where("season = 1995")
    write_cleansed(rows, out, "2024-01-01T00-00-00Z")
    before = read_cleansed(spark, out).count()
    with pytest.raises(CommitConflict, match="2024-01-01"):
        write_cleansed(rows, out, "2024-01-01T00-00-00Z")
    assert read_cleansed(spark, out).count() == before == rows.count()


def test_a_lookup_reads_a_bounded_number_of_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(manifest, "FOLDER", 5)
    root = str(tmp_path)
    for i in range(23):
        commit(snap(spark, i % 3, f"s{i:03d}"), root)
        assert len(read_manifest(spark, root).inputFiles()) <= 2 * 5
    assert head(spark, root) == 22
    assert sorted(r.version for r in read_manifest(spark, root).collect()) == list(range(23))
    newest = {r.season: r.snapshot for r in newest_snapshots(spark, root, "cleansed").collect()}
    assert newest == {0: "s021", 1: "s022", 2: "s020"}
    old = newest_snapshots(spark, root, "cleansed", version=7).collect()
    assert {r.season: r.snapshot for r in old} == {0: "s006", 1: "s007", 2: "s005"}


def test_a_conflict_is_seen_across_a_checkpoint(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(manifest, "FOLDER", 4)
    root = str(tmp_path)
    base = head(spark, root)
    for i in range(6):
        commit(snap(spark, 2000 + i, "s"), root)
    with pytest.raises(CommitConflict, match="2001"):
        commit(snap(spark, 2001, "late"), root, base)


def test_a_failed_checkpoint_does_not_undo_its_commit(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(manifest, "FOLDER", 2)

    def broken(*_):
        raise OSError("no room")

    monkeypatch.setattr(manifest, "checkpoint", broken)
    commit(snap(spark, 1, "a"), str(tmp_path))
    with pytest.warns(UserWarning, match="no checkpoint at version 1"):
        assert commit(snap(spark, 2, "b"), str(tmp_path)) == 1
    assert read_manifest(spark, str(tmp_path)).count() == 2
