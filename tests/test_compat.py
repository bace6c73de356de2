"""Reading stores in the original one-object-per-snapshot layout."""

import json
import os
import time

from rankflow.plans.compat import build_cleansed_from_objects, latest_poll_from_objects


def _put(root, key, obj, mtime):
    path = root / key
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(obj))
    os.utime(path, (mtime, mtime))


def test_raw_objects_to_cleansed(spark, tmp_path):
    now = time.time()
    ranks = [{"season": 2024, "seasonType": "regular", "week": 1,
              "polls": [{"poll": "AP Top 25", "ranks": [{"school": "A", "rank": 1}]}]}]
    _put(tmp_path, "2024/raw/rankings_2024-09-01T00-00-00Z.json", [], now - 100)
    _put(tmp_path, "2024/raw/rankings_2024-09-08T00-00-00Z.json", ranks, now)
    _put(tmp_path, "2024/raw/teams_2024-09-08T00-00-00Z.json",
         [{"id": 7, "school": "A", "conference": "X", "logos": ["a.png"]}], now)
    rows = build_cleansed_from_objects(spark, str(tmp_path), 2024).collect()
    assert [(r.school, r.id, r.conference_right, r.logos) for r in rows] == [("A", 7, "X", ["a.png"])]


def test_latest_cleansed_object_decoded(spark, tmp_path):
    now = time.time()
    columnar = {"columns": [{"name": "school", "values": ["A", "B"]},
                            {"name": "rank", "values": [1, 2]},
                            {"name": "logos", "values": [["a.png"]]}]}
    _put(tmp_path, "cleansed/2024/poll_2024-09-01T00-00-00Z.json", [{"school": "OLD"}], now - 100)
    _put(tmp_path, "cleansed/2024/poll_2024-09-08T00-00-00Z.json", columnar, now)
    _put(tmp_path, "cleansed/2023/poll_2023-12-01T00-00-00Z.json", [{"school": "C", "rank": 3}],
         now - 50)
    got = latest_poll_from_objects(spark, str(tmp_path), 2024).orderBy("school").collect()
    assert [(r.season, r.school, r.rank, r.logos) for r in got] == [
        (2024, "A", 1, ["a.png"]), (2024, "B", 2, None)]
    old = latest_poll_from_objects(spark, str(tmp_path), 2023).collect()
    assert [(r.season, r.school) for r in old] == [(2023, "C")]
    newest = latest_poll_from_objects(spark, str(tmp_path)).collect()
    assert sorted(r.school for r in newest) == ["A", "B"]
