"""The cleansed store: immutable snapshots, newest per season, formats."""

import json

import pytest
from pyspark.sql import functions as F

from rankflow.plans.cleansed import (
    latest_poll_rows, poll_table, read_cleansed, write_cleansed,
)
from rankflow.plans.queries import _cleansed
from rankflow.sources.readers import land_raw

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return _cleansed(spark, SF).cache()


OLD, NEW = "2024-01-01T00-00-00Z", "2024-02-01T00-00-00Z"


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("fmt", ["parquet", "columnar-json"])
def test_newest_snapshot_per_season_in_both_formats(spark, rows, tmp_path, fmt):
    """The null season is one of them."""
    out = str(tmp_path / fmt)
    write_cleansed(rows.withColumn("points", F.col("points") + 100), out, OLD, fmt)
    write_cleansed(rows, out, NEW, fmt)
    assert rows.where("season is null").count() > 0
    assert same(read_cleansed(spark, out).drop("snapshot").select(*rows.columns), rows)


def test_formats_may_differ_between_snapshots(spark, rows, tmp_path):
    out = str(tmp_path / "mixed")
    write_cleansed(rows.where("season <= 1997"), out, OLD, "columnar-json")
    write_cleansed(rows.where("season > 1997 or season is null"), out, NEW)
    assert same(read_cleansed(spark, out).drop("snapshot").select(*rows.columns), rows)


def test_only_chosen_folders_are_opened(spark, rows, tmp_path):
    out = str(tmp_path / "pruned")
    write_cleansed(rows, out, OLD)
    write_cleansed(rows, out, NEW)
    files = read_cleansed(spark, out).inputFiles()
    assert files and all(NEW in f for f in files)
    season = rows.agg(F.max("season")).first()[0]
    one = poll_table(spark, out, "1-URGENT", "regular", seasons=[season]).inputFiles()
    assert one and all(f"season={season}/" in f for f in one)


def test_empty_newest_snapshot_is_served_as_empty(spark, rows, tmp_path):
    out = str(tmp_path / "emptied")
    season = rows.agg(F.max("season")).first()[0]
    write_cleansed(rows, out, OLD)
    seasons = rows.select("season").distinct()
    write_cleansed(rows.where(F.col("season") != season), out, NEW, seasons=seasons)
    got = read_cleansed(spark, out)
    assert got.where(F.col("season") == season).count() == 0
    assert got.where("season is null").count() == 0  # emptied as well
    assert same(got.drop("snapshot").select(*rows.columns), rows.where(F.col("season") != season))


def test_uncommitted_folders_are_not_served(spark, rows, tmp_path):
    """A half-moved or failed write has no manifest row."""
    out = tmp_path / "store"
    write_cleansed(rows, str(out), OLD)
    season = rows.agg(F.max("season")).first()[0]
    torn = out / f"season={season}" / "snapshot=2099-01-01T00-00-00Z"
    torn.mkdir(parents=True)
    (torn / "part-0.parquet").write_text("not a footer")
    got = read_cleansed(spark, str(out)).select("snapshot").distinct().collect()
    assert [r.snapshot for r in got] == [OLD]


def test_replace_takes_its_own_folder_over(spark, rows, tmp_path):
    out = str(tmp_path / "again")
    for _ in range(2):
        write_cleansed(rows, out, OLD, replace=True)
    assert same(read_cleansed(spark, out).drop("snapshot").select(*rows.columns), rows)


def test_manifest_is_all_that_is_read_to_pick(spark, rows, tmp_path):
    from rankflow.plans.manifest import newest_snapshots, read_manifest

    out = str(tmp_path / "picked")
    assert read_manifest(spark, out).count() == 0
    write_cleansed(rows, out, OLD)
    write_cleansed(rows, out, NEW)
    assert all("_manifest" in f for f in read_manifest(spark, out).inputFiles())
    newest = {r.season: (r.snapshot, r.rows) for r in newest_snapshots(spark, out, "cleansed").collect()}
    want = {r.season: (NEW, r["count"]) for r in rows.groupBy("season").count().collect()}
    assert newest == want
    assert newest_snapshots(spark, out, "cleansed", per_season=False).first().season is None


def test_poll_table_and_latest_poll_rows(spark, rows, tmp_path):
    out = str(tmp_path / "store")
    seasons = sorted(r.season for r in rows.select("season").distinct().collect() if r.season)
    write_cleansed(rows, out, OLD)
    write_cleansed(rows.where(F.col("season") == seasons[1]), out, NEW)
    one = poll_table(spark, out, "1-URGENT", "regular", seasons=[seasons[-1]])
    assert {r.season for r in one.select("season").distinct().collect()} == {seasons[-1]}
    assert {(r.poll, r.seasonType) for r in one.select("poll", "seasonType").distinct().collect()} \
        == {("1-URGENT", "regular")}
    newest = latest_poll_rows(spark, out, None)
    assert {r.season for r in newest.select("season").distinct().collect()} == {seasons[1]}
    s2 = latest_poll_rows(spark, out, seasons[-1])
    assert s2.count() == rows.where(F.col("season") == seasons[-1]).count()


def test_land_raw_never_overwrites(spark, tmp_path):
    payload = spark.createDataFrame([("x",)], "v string")
    land_raw(payload, str(tmp_path), "teams", None, "2024-01-01T00-00-00Z")
    with pytest.raises(Exception):
        land_raw(payload, str(tmp_path), "teams", None, "2024-01-01T00-00-00Z")


def _land_json(spark, root, dataset, season, snapshot, docs):
    lines = spark.createDataFrame([(json.dumps(x),) for x in docs], "v string")
    land_raw(lines, str(root), dataset, season, snapshot)


def test_build_cleansed_teams_per_season_and_newest_only(spark, tmp_path):
    from rankflow.plans.cleansed import build_cleansed

    doc = lambda season, pts: {"season": season, "seasonType": "regular", "week": 1,
                               "polls": [{"poll": "P", "ranks": [{"school": "A", "rank": 1,
                                                                  "points": pts}]}]}
    _land_json(spark, tmp_path, "rankings", 2023, "2023-01-01T00-00-00Z", [doc(2023, 1)])
    _land_json(spark, tmp_path, "rankings", 2023, "2023-02-01T00-00-00Z", [doc(2023, 2)])
    # the document says 2099: the folder's season is stamped on the rows
    _land_json(spark, tmp_path, "rankings", 2024, "2024-01-01T00-00-00Z", [doc(2099, 3)])
    _land_json(spark, tmp_path, "teams", 2023, "2023-01-01T00-00-00Z", [{"id": 1, "school": "A", "color": "#023"}])
    _land_json(spark, tmp_path, "teams", 2024, "2024-01-01T00-00-00Z", [{"id": 1, "school": "A", "color": "#024"}])
    rows = build_cleansed(spark, str(tmp_path), teams_per_season=True).collect()
    assert sorted((r.season, r.points, r.color) for r in rows) == [(2023, 2, "#023"), (2024, 3, "#024")]
    newest_teams = build_cleansed(spark, str(tmp_path)).collect()
    assert sorted((r.season, r.color) for r in newest_teams) == [(2023, "#024"), (2024, "#024")]


def test_land_raw_files_keeps_payload(spark, tmp_path):
    from rankflow.sources.readers import land_raw_files, read_rankings

    src = tmp_path / "fetched.json"
    payload = '[{"season": 2024, "seasonType": "regular", "week": 1, "polls": []},\n {"season": 2024}]'
    src.write_text(payload)
    target = land_raw_files(spark, str(src), str(tmp_path / "raw"), "rankings", 2024,
                            "2024-09-02T12-00-03Z")
    landed = "".join(p.read_text() for p in __import__("pathlib").Path(target).glob("part-*"))
    assert landed == payload + "\n"
    assert read_rankings(spark, target, multi_line=True).count() == 2


def test_build_reads_arrays_over_several_lines(spark, tmp_path):
    from rankflow.plans.cleansed import build_cleansed
    from rankflow.sources.readers import land_raw_files

    for i, season in enumerate((2023, 2024)):
        src = tmp_path / f"fetched{i}.json"
        doc = {"season": season, "seasonType": "regular", "week": 1,
               "polls": [{"poll": "P", "ranks": [{"school": "A", "rank": 1}, {"school": "B"}]}]}
        src.write_text(json.dumps([doc, doc | {"week": 2}], indent=1))
        land_raw_files(spark, str(src), str(tmp_path / "raw"), "rankings", season, OLD)
    _land_json(spark, tmp_path / "raw", "teams", None, OLD, [{"id": 1, "school": "A"}])
    rows = build_cleansed(spark, str(tmp_path / "raw")).collect()
    assert sorted((r.season, r.week, r.school, r.id) for r in rows) == [
        (s, w, x, 1 if x == "A" else None) for s in (2023, 2024) for w in (1, 2) for x in "AB"]


def test_malformed_documents_fail_or_are_left_out(spark, tmp_path):
    from rankflow.plans.cleansed import build_cleansed
    from rankflow.schemas import SEASON
    from rankflow.sources.readers import bad_documents, good_documents, parse_documents

    good = json.dumps({"season": 2024, "seasonType": "regular", "week": 1,
                       "polls": [{"poll": "P", "ranks": [{"school": "A", "rank": 1}]}]})
    bad = [good[:-9], "<html>", good.replace("2024", '"x"')]
    lines = spark.createDataFrame([(x,) for x in [good, *bad]], "v string")
    target = land_raw(lines, str(tmp_path), "rankings", 2024, OLD)
    _land_json(spark, tmp_path, "teams", None, OLD, [{"id": 1, "school": "A"}])
    with pytest.raises(Exception, match="malformed document in .*snapshot="):
        build_cleansed(spark, str(tmp_path)).collect()
    assert build_cleansed(spark, str(tmp_path), on_bad="skip").count() == 1
    parsed = parse_documents(spark, [target], SEASON)
    assert good_documents(parsed, "skip").count() == 1
    assert sorted(r.reason for r in bad_documents(parsed).collect()) == [
        "not JSON", "truncated", "wrong type"]
