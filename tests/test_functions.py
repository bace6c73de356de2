"""Column functions on hand-made values."""

import datetime as dt

from pyspark.sql import functions as F

from rankflow.functions import (
    default_color, default_logos, delta_label, delta_title, iso_utc, point_label,
    season_week_label, snapshot_key, tooltip,
)


def test_labels_and_defaults(spark):
    df = spark.createDataFrame(
        [(2024, 1, None, None, None, "A"), (None, 3, "", ["x"], 7, "B"), (2023, 2, "#0a0", [], 2, None)],
        "season int, week int, color string, logos array<string>, rank int, school string")
    got = df.select(season_week_label().alias("sw"), default_color().alias("c"),
                    F.size(default_logos()).alias("nl"), point_label().alias("pl")).collect()
    assert [tuple(r) for r in got] == [("2024/1", "#ccc", 0, ""), ("null/3", "#ccc", 1, "7"),
                                       ("2023/2", "#0a0", 0, "2")]
    tips = df.select(tooltip("school", "rank", season_week_label()).alias("t")).collect()
    assert [r.t for r in tips] == ["A: Rank null (2024/1)", "B: Rank 7 (null/3)",
                                   "null: Rank 2 (2023/2)"]


def test_delta_words(spark):
    df = spark.createDataFrame([("A", -1), ("B", 3), ("C", 0)], "school string, delta int")
    got = {r.school: (r.l, r.t) for r in df.select(
        "school", delta_label().alias("l"), delta_title(poll_label="X").alias("t")).collect()}
    assert got["A"] == ("1 🔼", "A rose 1 place since entering the X poll")
    assert got["B"] == ("3 🔽", "B fell 3 places since entering the X poll")
    assert got["C"] == ("0 ➖", "C held steady since entering the X poll")


def test_stamps_and_iso(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 9, 2, 12, 0, 3),)], "ts timestamp_ntz")
    r = df.select(snapshot_key(F.lit(2024), "rankings", "ts").alias("k"),
                  iso_utc("ts").alias("iso")).first()
    assert r.k == "2024/raw/rankings_2024-09-02T12-00-03Z.json"
    assert r.iso == "2024-09-02T12:00:03+00:00"


def test_shape_check_stamp_and_union(spark):
    import re

    import pytest

    from rankflow.operators.seasons import require_columns, union_by_name
    from rankflow.sources.readers import stamp_now

    df = spark.createDataFrame([(1, "a")], "season int, school string")
    assert require_columns(df, ["season"]) is df
    with pytest.raises(ValueError, match="rank"):
        require_columns(df, ["season", "rank"])
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d-\d\d-\d\dZ", stamp_now(spark))
    other = spark.createDataFrame([(2, 5)], "season int, rank int")
    got = sorted(tuple(r) for r in union_by_name([df, other]).collect())
    assert got == [(1, "a", None), (2, None, 5)]
