"""The week dimension: one row per distinct (season, week) of the facts.

Ordinal, season boundaries, current-week flag and axis maxima are computed
here, on a table bounded by the calendar (seasons x weeks), and reach the
facts through an equi-join on (season, week). No window ever runs over the
facts without a partition key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankflow.functions.scalar import season_week_label

# Fixed values of the chart axes.
EMPTY_Y_MAX = 25
AXIS_PAD = 0.5


def week_dimension(df: DataFrame, season: str = "season", week: str = "week",
                   value: str | None = "visualRank") -> DataFrame:
    """Distinct weeks in time order (season, then week as a number).

    ``weekIndex`` 0-based ordinal; ``isCurrent`` last week; ``seasonChange``
    true where the season differs from the previous week's and ``boundary`` =
    weekIndex - 0.5 there; ``maxWeekIndex`` and ``yMax`` are the axis maxima.
    """
    aggs = [F.max(value).alias("_wmax")] if value else [F.lit(None).cast("double").alias("_wmax")]
    weeks = df.groupBy(season, week).agg(*aggs)
    in_time = Window.orderBy(F.col(season).asc_nulls_first(), F.col(week).asc_nulls_first())
    everything = Window.partitionBy()
    prev = F.lag(season).over(in_time)
    out = (weeks
           .withColumn("weekIndex", (F.row_number().over(in_time) - 1).cast("int"))
           .withColumn("_prev_season", prev)
           .withColumn("maxWeekIndex", F.max("weekIndex").over(everything))
           .withColumn("_ymax", F.max("_wmax").over(everything)))
    change = F.col("_prev_season").isNotNull() & (F.col(season) != F.col("_prev_season"))
    return out.select(
        F.col(season), F.col(week),
        season_week_label(season, week).alias("seasonWeek"),
        "weekIndex",
        (F.col("weekIndex") == F.col("maxWeekIndex")).alias("isCurrent"),
        change.alias("seasonChange"),
        F.when(change, F.col("weekIndex") - AXIS_PAD).alias("boundary"),
        "maxWeekIndex",
        F.coalesce(F.nullif(F.col("_ymax"), F.lit(0.0)), F.lit(float(EMPTY_Y_MAX))).alias("yMax"),
    )


def attach_weeks(df: DataFrame, weeks: DataFrame, season: str = "season",
                 week: str = "week") -> DataFrame:
    """Join the facts to the week dimension; a null season or week is one like
    any other.

    The week table is derived from the facts, so its size is known only at
    run time: the join is left to AQE, which turns it into a broadcast when
    the materialized week table is under
    ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and keeps a shuffle
    join above it. (A count check up front would recompute the facts.)
    """
    dim = weeks.drop("seasonWeek") if "seasonWeek" in df.columns else weeks
    dim = dim.withColumnsRenamed({season: "_dim_season", week: "_dim_week"})
    same = (F.col(season).eqNullSafe(F.col("_dim_season"))
            & F.col(week).eqNullSafe(F.col("_dim_week")))
    return df.join(dim, same).drop("_dim_season", "_dim_week")


def axis_bounds(weeks: DataFrame) -> DataFrame:
    """One row: maxWeekIndex (0 when empty), yMax (25 when empty or 0) and the
    y domain [0.5, yMax + 0.5]. A global aggregate over the week table."""
    agg = weeks.agg(F.max("weekIndex").alias("_mwi"), F.max("yMax").alias("_ym"))
    return agg.select(
        F.coalesce(F.col("_mwi"), F.lit(0)).cast("int").alias("maxWeekIndex"),
        F.coalesce(F.col("_ym"), F.lit(float(EMPTY_Y_MAX))).alias("yMax"),
        F.lit(1 - AXIS_PAD).alias("yDomainLow"),
        (F.coalesce(F.col("_ym"), F.lit(float(EMPTY_Y_MAX))) + AXIS_PAD).alias("yDomainHigh"),
    )


def season_changes(weeks: DataFrame) -> DataFrame:
    return weeks.where("seasonChange").select("weekIndex", "season", "seasonWeek", "boundary")
