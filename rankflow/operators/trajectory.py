"""Trajectories: chart rows, top-k of the final week, per-school series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.functions.scalar import MUTED_COLOR, default_color, default_logos
from rankflow.operators.ranks import rank_order, school_order, visual_rank
from rankflow.operators.weeks import attach_weeks, week_dimension

# Fixed values of the chart.
TOP_K = 12
TOP_STROKE_WIDTH, OTHER_STROKE_WIDTH = 2, 1
TOP_LINE_OPACITY, OTHER_LINE_OPACITY = 0.7, 0.3
TOP_POINT_OPACITY, OTHER_POINT_OPACITY = 0.95, 0.3

CHART_COLS = ["season", "week", "seasonWeek", "weekIndex", "rank", "visualRank", "school",
              "color", "logos", "isCurrent", "yMax"]


def chart_rows(ranked: DataFrame, weeks: DataFrame) -> DataFrame:
    """Visual-ranked rows + their week ordinal, default colour and logos
    (``color`` and ``logos`` are optional input columns)."""
    rows = attach_weeks(ranked, weeks)
    color = F.col("color") if "color" in rows.columns else F.lit(None).cast("string")
    logos = F.col("logos") if "logos" in rows.columns else F.lit(None).cast("array<string>")
    return rows.select(
        "season", "week", "seasonWeek", "weekIndex", "rank", "visualRank", "school",
        default_color(color).alias("color"), default_logos(logos).alias("logos"),
        "isCurrent", "yMax")


def top_schools(rows: DataFrame, k: int = TOP_K) -> DataFrame:
    """First ``k`` rows of the final week by rank (stable: school order within
    a tie). Plans as TakeOrderedAndProject: each task keeps its own top k."""
    final = rows.where(F.col("isCurrent"))
    # visualRank is unique within the week: a deterministic last key
    return (final.orderBy(*rank_order("rank"), *school_order("school"), F.col("visualRank"))
            .limit(k).select("school", "rank", "visualRank"))


def top_flag(rows: DataFrame, top: DataFrame, name: str = "isTop") -> DataFrame:
    """``topSchools.includes(school)`` as a column: left join against the
    distinct top-k names (at most k rows by construction, so broadcast)."""
    names = F.broadcast(top.select(F.col("school").alias("_top"), F.lit(True).alias("_hit"))
                        .distinct())
    return (rows.join(names, F.col("school").eqNullSafe(F.col("_top")), "left")
            .withColumn(name, F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit", "_top"))


def trajectories(slice_rows: DataFrame, k: int = TOP_K, path: str | None = None) -> DataFrame:
    """Poll rows of one poll / season type (all seasons) -> chart rows with
    ``visualRank``, ``weekIndex``, default colour and the top-k flag.

    The visual-ranked rows feed the week table, the chart rows and the top-k
    list. A caller that reuses them, or reads large facts, gives a ``path`` of
    its own: they are written there once, right after the rank windows, and
    every consumer scans that. The folder is the caller's to keep or remove.
    Without a path nothing is written.
    """
    ranked = visual_rank(slice_rows)
    # only what the chart reads is written
    keep = ["season", "week", "seasonWeek", "rank", "visualRank", "school"]
    ranked = ranked.select(*keep, *[c for c in ("color", "logos") if c in ranked.columns])
    if path:
        ranked.write.mode("errorifexists").parquet(path)
        ranked = ranked.sparkSession.read.schema(ranked.schema).parquet(path)
    weeks = week_dimension(ranked)
    rows = chart_rows(ranked, weeks)
    return top_flag(rows, top_schools(rows, k)).select(*CHART_COLS, "isTop")


def team_series(rows: DataFrame, order: str = "week") -> DataFrame:
    """One row per school: its points in order, the colour of the first point
    and the top flag.

    ``order="week"`` sorts by week number then ordinal (several seasons
    interleave: 2023/1, 2024/1, 2023/2 ...) as the chart does; ``"time"`` sorts
    by the ordinal. A series holds one point per week the school was ranked,
    so it is bounded by the number of weeks, not by the table.
    """
    if order == "week":
        key = [F.col("week").alias("k1"), F.col("weekIndex").alias("k2")]
    elif order == "time":
        key = [F.col("weekIndex").alias("k1"), F.col("week").alias("k2")]
    else:
        raise ValueError(f"order must be 'week' or 'time', not {order!r}")
    point = F.struct(*key, "season", "week", "weekIndex", "seasonWeek", "rank", "visualRank", "color")
    series = rows.groupBy("school").agg(
        F.array_sort(F.collect_list(point)).alias("_pts"), F.max("isTop").alias("isTop"))
    return series.select(
        "school",
        F.transform("_pts", lambda p: p.dropFields("k1", "k2")).alias("ranks"),
        F.col("_pts")[0]["color"].alias("color"),
        "isTop")


def emphasis(rows: DataFrame, flag: str = "isTop") -> DataFrame:
    """Stroke / fill / width / opacity chosen by the top flag."""
    top = F.col(flag)
    return rows.select(
        "*",
        F.when(top, F.col("color")).otherwise(F.lit(MUTED_COLOR)).alias("stroke"),
        F.when(top, TOP_STROKE_WIDTH).otherwise(OTHER_STROKE_WIDTH).alias("strokeWidth"),
        F.when(top, TOP_LINE_OPACITY).otherwise(OTHER_LINE_OPACITY).alias("lineOpacity"),
        F.when(top, F.col("color")).otherwise(F.lit(MUTED_COLOR)).alias("fill"),
        F.when(top, TOP_POINT_OPACITY).otherwise(OTHER_POINT_OPACITY).alias("pointOpacity"),
    )


def plot_rank(rows: DataFrame) -> DataFrame:
    """Plotted y value: ``visualRank ?? yMax``, and whether the line draws it."""
    return rows.select("*", F.coalesce(F.col("visualRank"), F.col("yMax")).alias("plotRank"),
                       F.col("visualRank").isNotNull().alias("drawable"))
