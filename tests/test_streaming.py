"""Incremental cleansed build: each committed snapshot is built once, whole."""

import json

import pytest

from rankflow.plans.cleansed import read_cleansed
from rankflow.sources.readers import land_raw
from rankflow.streaming.ingest import start_cleansed_stream


def _doc(season, points, week=1):
    return json.dumps({"season": season, "seasonType": "regular", "week": week,
                       "polls": [{"poll": "AP Top 25", "ranks": [
                           {"school": "A", "rank": 1, "points": points},
                           {"school": "B", "rank": 2}]}]})


def _land(spark, root, season, snapshot, points, weeks=1):
    lines = [(_doc(season, points, w + 1),) for w in range(weeks)]
    land_raw(spark.createDataFrame(lines, "v string").repartition(weeks), str(root), "rankings",
             season, snapshot)


def _teams(spark, root, snapshot, conference):
    line = json.dumps({"id": 1, "school": "A", "conference": conference})
    land_raw(spark.createDataFrame([(line,)], "v string"), str(root), "teams", None, snapshot)


@pytest.fixture
def run(spark, tmp_path):
    def go(**options):
        q = start_cleansed_stream(spark, str(tmp_path / "raw"), str(tmp_path / "out"),
                                  str(tmp_path / "ckpt"), **options)
        q.awaitTermination()
        assert q.exception() is None
        return q
    return go


def test_stream_processes_new_snapshots_once(spark, tmp_path, run):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    _teams(spark, raw, "2024-01-01T00-00-00Z", "X")
    _land(spark, raw, 2024, "2024-09-02T12-00-00Z", 10)
    run()
    got = {(r.school, r.points, r.conference_right) for r in read_cleansed(spark, out).collect()}
    assert got == {("A", 10, "X"), ("B", None, None)}

    _teams(spark, raw, "2024-09-03T00-00-00Z", "Y")  # a newer team snapshot is seen
    _land(spark, raw, 2024, "2024-09-09T12-00-00Z", 20)
    _land(spark, raw, 2023, "2023-12-01T12-00-00Z", 5)
    run()
    got = {(r.season, r.school, r.points, r.conference_right)
           for r in read_cleansed(spark, out).collect()}
    assert got == {(2024, "A", 20, "Y"), (2024, "B", None, None),
                   (2023, "A", 5, "Y"), (2023, "B", None, None)}
    # the first snapshot was written once and not again
    assert spark.read.parquet(out).where("season = 2024").count() == 4


def test_snapshots_of_several_files_are_built_whole(spark, tmp_path, run):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    _teams(spark, raw, "2024-01-01T00-00-00Z", "X")
    for i, season in enumerate([2021, 2022, 2023]):
        _land(spark, raw, season, f"{season}-09-0{i + 1}T00-00-00Z", season, weeks=3)
    q = run(max_commits_per_trigger=1)
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) >= 3
    rows = read_cleansed(spark, out).collect()
    assert sorted((r.season, r.week, r.school) for r in rows) == [
        (s, w, x) for s in (2021, 2022, 2023) for w in (1, 2, 3) for x in "AB"]


def test_uncommitted_landing_is_not_processed(spark, tmp_path, run):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    _teams(spark, raw, "2024-01-01T00-00-00Z", "X")
    _land(spark, raw, 2024, "2024-09-02T12-00-00Z", 10)
    half = raw / "rankings" / "season=2024" / "snapshot=2099-01-01T00-00-00Z"
    half.mkdir(parents=True)
    (half / "part-0.txt").write_text(_doc(2024, 99) + "\n")
    run()
    assert {(r.snapshot, r.points) for r in read_cleansed(spark, out).collect()} == {
        ("2024-09-02T12-00-00Z", 10), ("2024-09-02T12-00-00Z", None)}


def test_empty_snapshot_replaces_the_older_one(spark, tmp_path, run):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    _teams(spark, raw, "2024-01-01T00-00-00Z", "X")
    _land(spark, raw, 2024, "2024-09-02T12-00-00Z", 10)
    land_raw(spark.createDataFrame([], "v string"), str(raw), "rankings", 2024,
             "2024-09-09T12-00-00Z")
    run()
    assert read_cleansed(spark, out).count() == 0
