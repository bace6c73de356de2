"""The command line drives the same plans end to end."""

import json

import pytest

from rankflow.__main__ import main


def _store(tmp_path, fmt):
    raw, store = str(tmp_path / "raw"), str(tmp_path / "store")
    docs = [{"season": 2024, "seasonType": "regular", "week": w,
             "polls": [{"poll": "AP Top 25", "ranks": [{"school": "A", "rank": w},
                                                        {"school": "B", "rank": 3 - w}]}]}
            for w in (1, 2)]
    (tmp_path / "rankings.json").write_text(json.dumps(docs, indent=1))
    (tmp_path / "teams.json").write_text(json.dumps([{"id": 1, "school": "A", "color": "#0a0"}]))
    main(["land", "--raw", raw, "--src", str(tmp_path / "rankings.json"),
          "--dataset", "rankings", "--season", "2024"])
    main(["land", "--raw", raw, "--src", str(tmp_path / "teams.json"), "--dataset", "teams"])
    main(["build", "--raw", raw, "--store", store, "--format", fmt])
    return store


@pytest.mark.parametrize("fmt", ["parquet", "columnar-json"])
def test_land_build_and_read(spark, tmp_path, capsys, fmt):
    store = _store(tmp_path, fmt)
    main(["seasons", "--store", store])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"seasons": [2024]}
    for cmd in ("movers", "trajectories", "latest-poll"):
        main([cmd, "--store", store, "--out", str(tmp_path / cmd)])
    rows = {r.school: r.delta for r in spark.read.json(str(tmp_path / "movers")).collect()}
    assert rows == {"A": 1, "B": -1}
    assert spark.read.json(str(tmp_path / "trajectories")).count() == 4
    latest = spark.read.json(str(tmp_path / "latest-poll")).collect()
    assert sorted((r.week, r.school, r.season) for r in latest) == [
        (w, s, 2024) for w in (1, 2) for s in "AB"]


def test_season_files(spark, tmp_path):
    from pyspark.sql import functions as F

    from rankflow.plans.cleansed import write_cleansed
    from rankflow.plans.queries import _cleansed

    rows = _cleansed(spark, "/root/testdata/sf0.001")
    season = rows.agg(F.max("season")).first()[0]
    store = tmp_path / "store"
    write_cleansed(rows, str(store), "2024-01-01T00-00-00Z")
    write_cleansed(rows, str(store), "2024-02-01T00-00-00Z")
    torn = store / f"season={season}" / "snapshot=2099-01-01T00-00-00Z"
    torn.mkdir()
    (torn / "part-0.parquet").write_text("x")
    out = str(tmp_path / "files")
    main(["season-files", "--store", str(store), "--season", str(season), "--out", out])
    files = spark.read.json(out).collect()
    assert {f.snapshot for f in files} == {"2024-01-01T00-00-00Z", "2024-02-01T00-00-00Z"}
    assert all(f.size > 0 and f.key.endswith(".parquet") and f.lastModified for f in files)


def test_stores_of_objects(spark, tmp_path):
    root = tmp_path / "bucket"
    (root / "2024" / "raw").mkdir(parents=True)
    doc = {"season": 2024, "seasonType": "regular", "week": 1,
           "polls": [{"poll": "AP Top 25", "ranks": [{"school": "A", "rank": 1}]}]}
    (root / "2024" / "raw" / "rankings_2024-01-01T00-00-00Z.json").write_text(json.dumps([doc]))
    (root / "2024" / "raw" / "teams_2024-01-01T00-00-00Z.json").write_text(
        json.dumps([{"id": 1, "school": "A"}]))
    store = str(tmp_path / "store")
    main(["build", "--raw", str(root), "--store", store, "--objects", "2024"])
    (root / "cleansed" / "2024").mkdir(parents=True)
    (root / "cleansed" / "2024" / "poll_x.json").write_text(json.dumps(
        {"columns": [{"name": "school", "values": ["A"]}, {"name": "rank", "values": [1.0]}]}))
    main(["latest-poll", "--store", str(root), "--objects", "--season", "2024",
          "--out", str(tmp_path / "lp")])
    row = spark.read.json(str(tmp_path / "lp")).first()
    assert (row.school, row["rank"], row.season) == ("A", 1, 2024)
