"""Tie-aware visual ranks on hand-made edge rows."""

import pytest
from pyspark.sql import functions as F

from rankflow.operators.ranks import tie_groups, visual_rank

SCHEMA = "season int, week int, school string, rank int"


def _vr(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return {(r.week, r.school): r.visualRank for r in visual_rank(df).collect()}


def test_three_way_tie_in_week_one(spark):
    got = _vr(spark, [(2024, 1, "A", 5), (2024, 1, "B", 5), (2024, 1, "C", 5)])
    assert got[(1, "A")] == pytest.approx(4.9)
    assert got[(1, "B")] == pytest.approx(5.0)
    assert got[(1, "C")] == pytest.approx(5.1)


def test_two_way_tie_in_week_one(spark):
    got = _vr(spark, [(2024, 1, "A", 2), (2024, 1, "B", 2)])
    assert got[(1, "A")] == pytest.approx(1.95)
    assert got[(1, "B")] == pytest.approx(2.05)


def test_ties_and_gaps_outside_week_one(spark):
    got = _vr(spark, [(2024, 2, "B", 1), (2024, 2, "A", 1), (2024, 2, "C", 3),
                      (2024, 3, "X", 1), (2024, 3, "Y", 4)])
    assert [got[(2, s)] for s in "ABC"] == [1.0, 2.0, 3.0]
    assert [got[(3, s)] for s in "XY"] == [1.0, 2.0]


def test_null_rank_alone_in_week_one_is_zero_and_first(spark):
    got = _vr(spark, [(2024, 1, "N", None), (2024, 1, "A", 1)])
    assert got[(1, "N")] == 0.0
    got2 = _vr(spark, [(2024, 2, "N", None), (2024, 2, "A", 1)])
    assert got2[(2, "N")] == 1.0 and got2[(2, "A")] == 2.0


def test_tie_order_uses_unicode_collation(spark):
    names = ["texas a", "Texas B", "álamo", "Hawai'i", "Hawaii", "Zed"]
    got = _vr(spark, [(2024, 2, n, 1) for n in names])
    order = [n for n, _ in sorted(((n, got[(2, n)]) for n in names), key=lambda x: x[1])]
    assert order == ["álamo", "Hawai'i", "Hawaii", "texas a", "Texas B", "Zed"]


def test_partitions_are_independent(spark):
    got = _vr(spark, [(2023, 2, "A", 1), (2024, 2, "B", 1), (2024, 2, "C", 2)])
    assert got[(2, "A")] == 1.0 and got[(2, "B")] == 1.0 and got[(2, "C")] == 2.0


def test_properties_on_fixture(spark, sf_small):
    from rankflow.plans.queries import _slice

    vr = visual_rank(_slice(spark, sf_small))
    # weeks other than 1: visualRank is a permutation of 1..N
    perm = (vr.where("week != 1").groupBy("season", "week")
            .agg(F.count("*").alias("n"), F.sum("visualRank").alias("s"),
                 F.countDistinct("visualRank").alias("d"), F.max("visualRank").alias("m")))
    for r in perm.collect():
        assert r.d == r.n and r.m == r.n and r.s == pytest.approx(r.n * (r.n + 1) / 2)
    # week 1: the mean visualRank of a tie group is its rank
    mean = (vr.where("week = 1").groupBy("season", "rank")
            .agg(F.avg("visualRank").alias("a")).collect())
    assert mean and all(r.a == pytest.approx(r.rank) for r in mean)


def test_tie_groups(spark):
    df = spark.createDataFrame([(2024, 1, "A", 5), (2024, 1, "B", 5), (2024, 1, "C", 7)], SCHEMA)
    got = {r.rank: (r.tieSize, r.isTie) for r in tie_groups(df).collect()}
    assert got == {5: (2, True), 7: (1, False)}
