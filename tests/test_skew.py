"""Hot keys: salted joins, and ranks of ties of any size by range partitions."""

import pytest
from pyspark.sql import functions as F

from rankflow.operators.merge import merge_teams
from rankflow.operators.ranks import tie_positions, tie_positions_by_range, visual_rank
from rankflow.operators.skew import salted_join


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in names:
        spark.conf.set(k, "-1")
    yield
    for k in names:
        spark.conf.unset(k)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def facts(spark, n=3000):
    """A third of the rows has one school, a third has none."""
    return spark.range(n).selectExpr(
        "case id % 3 when 0 then 'hot' when 1 then null else concat('s', id % 50) end as school",
        "cast(id % 10 as int) as rank", "'left' as conference")


def teams(spark):
    return spark.createDataFrame(
        [("hot", 1, "x"), ("hot", 2, "y"), (None, 3, "z"), ("nobody", 4, "w")]
        + [(f"s{i}", 10 + i, "v") for i in range(0, 50, 2)], "school string, id int, conference string")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_equal_to_the_plain_join(spark, no_broadcast, how):
    left, right = facts(spark), teams(spark).drop("conference")
    got = salted_join(left, right, "school", how, share=100, parts=16)
    want = left.join(right, "school", how)
    assert got.columns == want.columns and same(got, want)


def test_merge_with_salts_keeps_layout_and_fan_out(spark, no_broadcast):
    plain, salted = (merge_teams(facts(spark), teams(spark), salted=s) for s in (False, True))
    assert salted.columns == plain.columns and same(salted, plain)


def test_two_keys_and_no_hot_ones(spark):
    left = spark.range(100).selectExpr("cast(id % 4 as int) a", "cast(id % 2 as string) b", "id")
    right = spark.createDataFrame([(1, "1", "x"), (2, "0", "y"), (None, None, "z")],
                                  "a int, b string, v string")
    for share in (1, 1000):  # none hot, all hot
        got = salted_join(left, right, ["a", "b"], share=share, parts=8)
        assert same(got, left.join(right, ["a", "b"], "left"))
    assert salted_join(left.limit(0), right, ["a", "b"]).collect() == []
    with pytest.raises(ValueError):
        salted_join(left, right, "a", how="full")


def test_largest_task_is_bounded(spark, no_broadcast):
    """Rows of the joined result by partition, with the AQE skew join off."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left, right = facts(spark, 6000), teams(spark).where("id <> 2").drop("conference")

        def largest(df):
            return (df.groupBy(F.spark_partition_id().alias("p")).count()
                    .agg(F.max("count")).first()[0])

        spark.conf.set("spark.sql.shuffle.partitions", "40")
        plain = largest(left.join(right, "school", "left"))
        salted = largest(salted_join(left, right, "school", share=100))
        assert plain >= 2000 and salted <= 6000 / 40 * 6
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.enabled")


def ranked(spark, n=900):
    """One tie group with a third of all rows, null keys, copies."""
    return spark.range(n).selectExpr(
        "case when id % 3 = 0 then 2024 when id % 11 = 0 then null else cast(2020 + id % 4 as int) end"
        " as season",
        "cast(case when id % 3 = 0 then 1 else id % 5 end as int) as week",
        "case when id % 17 = 0 then null else concat('school ', id % 400) end as school",
        "cast(case when id % 3 = 0 then 7 when id % 13 = 0 then null else id % 4 end as int) as rank")


def test_places_by_range_equal_those_by_window(spark):
    df = ranked(spark).repartition(3)
    assert same(tie_positions_by_range(df, parts=8), tie_positions(df))
    assert tie_positions_by_range(df.limit(0)).collect() == []


def test_visual_rank_by_range(spark, no_broadcast):
    df = ranked(spark).repartition(3)
    got, want = visual_rank(df, by_range=True), visual_rank(df)
    assert got.columns == want.columns and same(got, want)
    plan = visual_rank(df, by_range=True)._jdf.queryExecution().executedPlan().toString()
    assert "Window [row_number()" not in plan
