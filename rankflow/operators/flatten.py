"""Season documents <-> flat poll rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.schemas import FLAT_COLS, HEADER_COLS, RANK


def flatten_rankings(docs: DataFrame, keep: list[str] | tuple = ()) -> DataFrame:
    """season -> polls -> ranks, one row per rank with the header repeated.

    Two narrow ``inline`` generators (no shuffle). A null, missing or empty
    ``polls``/``ranks`` list yields no rows for that parent. Only the columns
    each level needs are carried into the generators; ``keep`` names extra
    document columns to carry along (e.g. a snapshot id).
    """
    extra = list(keep)
    polls = docs.select(*HEADER_COLS, *extra, F.inline(F.col("polls")))
    ranks = polls.select(*HEADER_COLS, *extra, "poll", F.inline(F.col("ranks")))
    return ranks.select(*FLAT_COLS, *extra)


def nest_rankings(rows: DataFrame) -> DataFrame:
    """Inverse of :func:`flatten_rankings`: rows -> one document per
    (season, seasonType, week). Each collected list is one poll (bounded by
    the poll size) or the polls of one week (bounded by the number of polls),
    so no group grows with the table.
    """
    rank_fields = [f.name for f in RANK.fields]
    per_poll = rows.groupBy(*HEADER_COLS, "poll").agg(
        F.array_sort(F.collect_list(F.struct(*rank_fields))).alias("ranks"))
    return per_poll.groupBy(*HEADER_COLS).agg(
        F.array_sort(F.collect_list(F.struct("poll", "ranks"))).alias("polls"))
