"""Tie-aware visual ranks within a week (or any partition)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.functions.scalar import season_week_label
from rankflow.operators.numbering import with_positions
from rankflow.operators.skew import salted_join

# Fixed values of the chart's tie spreading.
TIE_OFFSET = 0.1
SPREAD_WEEK = 1
SCHOOL_COLLATION = "UNICODE"


def school_order(school: str = "school") -> list[Column]:
    """Locale-aware order (UNICODE collation), binary order as tiebreak."""
    return [F.collate(F.col(school), SCHOOL_COLLATION).asc(), F.col(school).asc()]


def rank_order(rank: str = "rank") -> list[Column]:
    """JS arithmetic sorts a null rank as 0; nulls first among equal keys."""
    return [F.coalesce(F.col(rank), F.lit(0)).asc(), F.col(rank).asc_nulls_first()]


def tie_positions(df: DataFrame, partition_by: Sequence[str] = ("season", "week"),
                  rank: str = "rank", school: str = "school") -> DataFrame:
    """Adds ``_tie_i`` (0-based place in the tie group by school), ``_tie_n``
    (tie size) and ``_pos`` (0-based place in the partition by rank, school).

    Place and size come from one shuffle by tie group, the offset of the tie
    group from a running sum over the ranks of the partition: one pass over the
    facts, no join. A partition is one poll of one week, so what a task sorts is
    bounded by the schools of a poll. Window keys treat nulls as equal, so null
    ranks and keys are groups of their own.
    """
    pb = [F.col(c) for c in partition_by]
    # last sort key: a hash of the whole row, so rows sharing a school (team
    # fan-out) are numbered the same way on every run, retries included
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
    tie = Window.partitionBy(*pb, rank)
    place = F.row_number().over(tie.orderBy(*school_order(school), row_hash)) - 1
    # each tie group counts once, with its first row
    once = F.when(F.col("_tie_i") == 0, F.col("_tie_n")).otherwise(0)
    upto = (Window.partitionBy(*pb).orderBy(*rank_order(rank))
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return (df.withColumn("_tie_i", place).withColumn("_tie_n", F.count(F.lit(1)).over(tie))
            .withColumn("_pos", F.sum(once).over(upto) - F.col("_tie_n") + F.col("_tie_i")))


def tie_positions_by_range(df: DataFrame, partition_by: Sequence[str] = ("season", "week"),
                           rank: str = "rank", school: str = "school",
                           parts: int | None = None) -> DataFrame:
    """:func:`tie_positions` for polls without a bound on their schools.

    The rows are numbered in one order (partition, rank, school) over range
    partitions, so that a tie group of any size is sorted by many tasks. A place
    is then the row's number less the first number of its group, which with its
    size comes from partial and final aggregates; a group with many rows meets
    its one row of those by a salted join.
    """
    pb = [F.col(c) for c in partition_by]
    order = [*[c.asc_nulls_first() for c in pb], *rank_order(rank), *school_order(school),
             F.xxhash64(*[F.col(c) for c in df.columns])]
    key = F.struct(*pb, F.col(rank))  # struct keys match nulls
    placed = with_positions(df, "_p", order, parts).withColumn("_tie", key)
    ties = placed.groupBy("_tie").agg(F.min("_p").alias("_t0"),
                                      F.count(F.lit(1)).alias("_tie_n"))
    whole = F.struct(*[F.col("_tie")[c] for c in partition_by]).alias("_whole")
    ties = ties.select("*", whole)
    firsts = ties.groupBy("_whole").agg(F.min("_t0").alias("_p0"))
    found = salted_join(placed, ties.join(firsts, "_whole").drop("_whole"), "_tie", "inner",
                        salt=F.col("_p"), parts=parts)
    return found.select(*df.columns, (F.col("_p") - F.col("_t0")).alias("_tie_i"), "_tie_n",
                        (F.col("_p") - F.col("_p0")).alias("_pos"))


def visual_rank(df: DataFrame, partition_by: Sequence[str] = ("season", "week"),
                rank: str = "rank", school: str = "school", week: str = "week",
                season: str = "season", spread_week: int = SPREAD_WEEK,
                offset: float = TIE_OFFSET, keep_position: bool = False,
                by_range: bool = False) -> DataFrame:
    """Adds ``visualRank`` (double) and ``seasonWeek``.

    In ``spread_week``: ``rank + offset * (i - (n - 1) / 2)`` with ``i`` the
    place in the tie group by school and ``n`` the tie size (a null rank counts
    as 0). Other weeks: a 1..N counter over (rank, school), no gaps.
    Callers filter to one poll and season type first (or widen ``partition_by``).
    ``by_range`` bounds what a task sorts however many rows share a rank
    (:func:`tie_positions_by_range`), for a few more shuffles and a write.
    """
    positions = tie_positions_by_range if by_range else tie_positions
    tp = positions(df, partition_by, rank=rank, school=school)
    key = F.coalesce(F.col(rank), F.lit(0))
    spread = key + F.lit(float(offset)) * (F.col("_tie_i") - (F.col("_tie_n") - 1) / 2.0)
    counter = (F.col("_pos") + 1).cast("double")
    out = (tp.withColumn("visualRank", F.when(F.col(week) == spread_week, spread).otherwise(counter)
                         .cast("double"))
           .withColumn("seasonWeek", season_week_label(season, week)))
    drop = ["_tie_i", "_tie_n"] + ([] if keep_position else ["_pos"])
    return out.drop(*drop)


def tie_groups(df: DataFrame, partition_by: Sequence[str] = ("season", "week"),
               rank: str = "rank") -> DataFrame:
    """One row per (partition, rank) with its size; partial + final aggregate."""
    return (df.groupBy(*partition_by, rank)
            .agg(F.count(F.lit(1)).cast("int").alias("tieSize"))
            .withColumn("isTie", F.col("tieSize") > 1))


def week_groups(ranked: DataFrame, season: str = "season", week: str = "week",
                also_by: Sequence[str] = ()) -> DataFrame:
    """Group visual-ranked rows (``keep_position=True``) into one row per
    (season, week, and ``also_by``, e.g. poll and season type) with the ordered
    ``ranks`` list, which is bounded by the poll size."""
    color = F.col("color") if "color" in ranked.columns else F.lit(None).cast("string")
    logos = F.col("logos") if "logos" in ranked.columns else F.lit(None).cast("array<string>")
    entry = F.struct(F.col("_pos"), F.col("rank"), F.col("visualRank"), F.col("school"),
                     color.alias("color"),
                     F.coalesce(logos, F.array().cast("array<string>")).alias("logos"),
                     F.col(season).alias("season"))
    grouped = ranked.groupBy(season, week, *also_by).agg(
        F.array_sort(F.collect_list(entry)).alias("_ranks"), F.first("seasonWeek").alias("seasonWeek"))
    return grouped.select(
        F.col(week).cast("string").alias("week"), F.col(season).alias("season"), *also_by,
        "seasonWeek", F.transform("_ranks", lambda r: r.dropFields("_pos")).alias("ranks"))
