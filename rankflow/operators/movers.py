"""Movers: final-week rank against the rank at first appearance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.functions.scalar import DEFAULT_POLL_LABEL, delta_label, delta_title


def first_ranks(rows: DataFrame) -> DataFrame:
    """Rank at each school's smallest weekIndex (``min`` over a struct:
    partial + final aggregate, so a school with many rows never lands whole
    in one task)."""
    first = F.min(F.struct(F.col("weekIndex").alias("w"),
                           F.coalesce(F.col("rank"), F.lit(0)).alias("r")))
    # ties in the first week (a school listed twice): the smaller rank, which
    # comes first in chart order, so the result never depends on row order
    return rows.groupBy("school").agg(first["r"].alias("firstRank"))


def with_first_rank(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """``rows`` with each school's ``firstRank``."""
    firsts = firsts.withColumnRenamed("school", "_school")
    return rows.join(firsts, F.col("school").eqNullSafe(F.col("_school"))).drop("_school")


def rank_delta(rows: DataFrame) -> DataFrame:
    """Final-week rows joined to their first appearance (inner: a missing
    history drops the row; a null school is one like any other). delta = final
    rank - first rank (null rank = 0)."""
    final = rows.where(F.col("isCurrent")).select("school", "rank", "visualRank")
    return with_first_rank(final, first_ranks(rows)).select(
        "school", "visualRank", "rank", "firstRank",
        (F.coalesce(F.col("rank"), F.lit(0)) - F.col("firstRank")).cast("int").alias("delta"))


def movers(rows: DataFrame, poll_label: str = DEFAULT_POLL_LABEL) -> DataFrame:
    """The delta table with its label (``"2 🔼"``) and sentence."""
    d = rank_delta(rows)
    return d.select("*", delta_label("delta").alias("deltaLabel"),
                    delta_title("school", "delta", poll_label).alias("deltaTitle"))
