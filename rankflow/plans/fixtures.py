"""Deterministic mapping of the shared test tables onto the ranking domain.

poll rows   orders x customer x nation x region, one row per
            (season=year, week=month, poll=priority, seasonType, school=nation)
            (1998 and December stand for a null season and week, one nation
            for a null school)
teams       nation x region (one nation under another name: an unmatched school)
listing     events as snapshot-file metadata (key, last_modified, size)

Every step is a Spark join / aggregate / window, so the work grows with the
tables. ``rankflow.plans.oracle`` holds the same mapping in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankflow.schemas import FLAT_COLS, TEAM
from rankflow.session import table

# Fixed values of the fixture mapping.
FIRST_PLACE_PRICE = 200000
POSTSEASON_STATUS = "P"
RENAMED_NATION = 24
NULL_SCHOOL_NATION = 23
NULL_SEASON_YEAR = 1998
NULL_WEEK_MONTH = 12
LISTING_BASE_SEASON = 2020
LISTING_SEASONS = 5

# Declared (pruned) schemas of the shared tables this mapping reads.
ORDERS = ("o_custkey bigint, o_orderstatus string, o_totalprice double, "
          "o_orderdate timestamp_ntz, o_orderpriority string")
CUSTOMER = "c_custkey bigint, c_nationkey int"
NATION = "n_nationkey int, n_name string, n_regionkey int"
REGION = "r_regionkey int, r_name string"
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string"


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation", NATION)
    r = table(spark, sf_dir, "region", REGION)
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", F.col("n_name").alias("school"), F.col("r_name").alias("conference"))


def poll_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat poll rows (the FLAT schema). Orders join customers on the
    customer key (shuffle join; AQE splits a hot customer), nations come in by
    a join that AQE broadcasts by their bytes, then one partial+final aggregate
    and a rank window per poll (bounded by the number of nations)."""
    o = table(spark, sf_dir, "orders", ORDERS).select(
        "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice")
    c = table(spark, sf_dir, "customer", CUSTOMER)
    geo = _geo(spark, sf_dir).withColumn(
        "school", F.when(F.col("n_nationkey") != NULL_SCHOOL_NATION, F.col("school")))
    year, month = F.year("o_orderdate"), F.month("o_orderdate")
    facts = (o.join(c, o.o_custkey == c.c_custkey)
             .join(geo, F.col("c_nationkey") == F.col("n_nationkey")))
    agg = facts.groupBy(
        F.when(year != NULL_SEASON_YEAR, year).alias("season"),
        F.when(month != NULL_WEEK_MONTH, month).alias("week"),
        F.col("o_orderpriority").alias("poll"),
        F.when(F.col("o_orderstatus") == POSTSEASON_STATUS, "postseason").otherwise("regular")
        .alias("seasonType"),
        "school", "conference",
    ).agg(
        F.count(F.lit(1)).cast("int").alias("points"),
        F.count(F.when(F.col("o_totalprice") > FIRST_PLACE_PRICE, 1)).cast("int")
        .alias("firstPlaceVotes"),
    )
    w = Window.partitionBy("season", "week", "poll", "seasonType").orderBy(F.col("points").desc())
    return agg.withColumn("rank", F.rank().over(w).cast("int")).select(*FLAT_COLS)


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team dimension (TEAM schema) with null / empty / set colours and
    null / one / two logos."""
    k = F.col("n_nationkey")
    g = _geo(spark, sf_dir)
    name = F.concat(F.col("school"), F.when(k == RENAMED_NATION, " (renamed)").otherwise(""))
    ks = k.cast("string")
    logo = F.concat(F.lit("logos/"), ks, F.lit(".png"))
    dark = F.concat(F.lit("logos/"), ks, F.lit("-dark.png"))
    out = g.select(
        k.cast("int").alias("id"),
        name.alias("school"),
        F.concat(F.lit("Mascot "), ks).alias("mascot"),
        F.concat(F.lit("N"), ks).alias("abbreviation"),
        F.lower("school").alias("alt_name1"),
        F.lit(None).cast("string").alias("alt_name2"),
        F.lit(None).cast("string").alias("alt_name3"),
        F.col("conference"),
        F.when(k % 2 == 0, "East").otherwise("West").alias("division"),
        F.lit("fbs").alias("classification"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).when(k % 5 == 1, F.lit(""))
        .otherwise(F.concat(F.lit("#"), F.lpad((k * 7).cast("string"), 3, "0"))).alias("color"),
        F.lit("#ffffff").alias("alt_color"),
        F.when(k % 3 == 0, F.lit(None).cast("array<string>"))
        .when(k % 3 == 1, F.array(logo)).otherwise(F.array(logo, dark)).alias("logos"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in TEAM.fields])


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot listing rows (key, last_modified, size) from events."""
    e = table(spark, sf_dir, "events", EVENTS)
    season = (F.lit(LISTING_BASE_SEASON) + F.col("user_id") % LISTING_SEASONS).cast("string")
    suffix = F.when(F.col("event_type") == "error", ".csv").otherwise(".json")
    return e.select(
        F.concat(F.lit("cleansed/"), season, F.lit("/poll_"), F.col("event_id").cast("string"), suffix)
        .alias("key"),
        F.col("ts").cast("timestamp_ntz").alias("last_modified"),
        (F.col("event_id") % 1000).cast("long").alias("size"),
    )
