"""Flatten, nest and the rankings x teams left join."""

import json

from pyspark.sql import functions as F

from rankflow.operators.flatten import flatten_rankings, nest_rankings
from rankflow.operators.merge import duplicate_keys, merge_teams
from rankflow.plans import fixtures
from rankflow.schemas import CLEANSED_COLS, FLAT_COLS, TEAM
from rankflow.sources.readers import read_rankings


def test_flatten_nest_is_identity(spark, sf_small):
    rows = fixtures.poll_rows(spark, sf_small)
    back = flatten_rankings(nest_rankings(rows))
    assert back.columns == FLAT_COLS
    assert rows.exceptAll(back).count() == 0 and back.exceptAll(rows).count() == 0


def test_empty_null_missing_polls_yield_no_rows(spark, tmp_path):
    docs = [
        {"season": 2024, "seasonType": "regular", "week": 1, "polls": []},
        {"season": 2024, "seasonType": "regular", "week": 2, "polls": None},
        {"season": 2024, "seasonType": "regular", "week": 3},
        {"season": 2024, "seasonType": "regular", "week": 4,
         "polls": [{"poll": "P", "ranks": [{"school": "A", "rank": 1}]}, {"poll": "Q"}]},
    ]
    p = tmp_path / "rankings.json"
    p.write_text(json.dumps(docs))  # one top-level array, as landed
    rows = flatten_rankings(read_rankings(spark, str(p), multi_line=True)).collect()
    assert [(r.week, r.poll, r.school, r.rank, r.points) for r in rows] == [(4, "P", "A", 1, None)]


def _team(spark, rows):
    full = [dict(zip(TEAM.fieldNames(), [None] * len(TEAM.fields))) | r for r in rows]
    return spark.createDataFrame(full, TEAM)


def test_left_join_keeps_unmatched_and_fans_out_duplicates(spark):
    ranks = spark.createDataFrame(
        [(2024, "regular", 1, "P", "A", 1, "C1", 0, 10),
         (2024, "regular", 1, "P", "Z", 2, "C1", 0, 9)],
        "season int, seasonType string, week int, poll string, school string, rank int, "
        "conference string, firstPlaceVotes int, points int")
    teams = _team(spark, [{"id": 1, "school": "A", "conference": "T1", "color": "#0a0"},
                          {"id": 2, "school": "A", "conference": "T2"}])
    out = merge_teams(ranks, teams)
    assert out.columns == CLEANSED_COLS
    rows = out.orderBy("school", "id").collect()
    assert [(r.school, r.id, r.conference, r.conference_right) for r in rows] == [
        ("A", 1, "C1", "T1"), ("A", 2, "C1", "T2"), ("Z", None, "C1", None)]
    assert [r.school for r in duplicate_keys(teams).collect()] == ["A"]


def test_left_join_never_loses_a_row(spark, sf_small):
    rows = fixtures.poll_rows(spark, sf_small)
    out = merge_teams(rows, fixtures.teams(spark, sf_small))
    assert out.count() == rows.count()
    unmatched = out.where(F.col("id").isNull()).select("school").distinct().collect()
    assert {r.school for r in unmatched} == {"NATION_24", None}
