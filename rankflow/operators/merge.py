"""Rankings x teams left join (the cleansed table)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.operators.skew import salted_join


def merge_teams(rankings: DataFrame, teams: DataFrame, on: str | list[str] = "school",
                suffix: str = "_right", salted: bool = False) -> DataFrame:
    """Left equi-join keeping every team column.

    Output layout: every left column in order, then every right column except
    the key; right names that clash with a left name get ``suffix``. Null keys
    never match; duplicate teams fan out (plain left-join semantics). There is
    no hint: AQE broadcasts the teams when their bytes at run time allow it.
    ``salted`` is for teams beyond any broadcast and a school with a large part
    of all rows (see :func:`rankflow.operators.skew.salted_join`).
    """
    keys = [on] if isinstance(on, str) else list(on)
    left_cols = rankings.columns
    right = teams.select(*[
        F.col(c).alias(c + suffix if (c in left_cols and c not in keys) else c)
        for c in teams.columns])
    right_cols = [c for c in right.columns if c not in keys]
    joined = (salted_join(rankings, right, keys) if salted
              else rankings.join(right, on=keys, how="left"))
    return joined.select(*left_cols, *right_cols)


def duplicate_keys(teams: DataFrame, on: str = "school") -> DataFrame:
    """Keys present more than once in the dimension (each fans out a left row)."""
    return teams.groupBy(on).count().where(F.col("count") > 1)
