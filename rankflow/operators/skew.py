"""Equi-joins whose left side has hot keys, with a right side of any size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: keys with more than this part of the rows are salted: fewer than 1000 of them
HOT_SHARE = 1000


def hot_keys(left: DataFrame, on: list[str], share: int = HOT_SHARE) -> tuple[DataFrame, int]:
    """Keys (null ones too) with more than a ``share``-th of the rows, with
    their counts ``_n``, and the number of rows. One partial and final count of
    the key columns."""
    counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = left.count()
    return counts.where(F.col("_n") > total / share), total


def salted_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "left",
                salt: Column | None = None, share: int = HOT_SHARE,
                parts: int | None = None) -> DataFrame:
    """``left.join(right, on, how)`` for how "left" or "inner", where a key may
    hold a large part of the left rows and the right side is too large to be
    broadcast.

    The rows of a hot key are dealt over as many salts as it has partitions'
    worth of rows, by ``salt`` (a whole number; by default the row's place in
    its partition, for a ``left`` that is read in the same order each time) and
    the right rows of that key are repeated once a salt. Hot null keys are
    dealt out too, though they match nothing. Counting the keys runs now.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    keys = [on] if isinstance(on, str) else list(on)
    spark = left.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot, total = hot_keys(left, keys, share)
    rows = hot.collect()  # fewer than ``share``
    if not rows:
        return left.join(right, keys, how)
    names = [f"_k{i}" for i in range(len(keys))]
    salts = spark.createDataFrame(
        [(*r[:-1], max(1, -(-r[-1] * parts // total))) for r in rows],
        ", ".join([f"{n} {left.schema[k].dataType.simpleString()}"
                   for n, k in zip(names, keys, strict=True)] + ["_salts int"]))

    def with_salts(df: DataFrame) -> DataFrame:
        same = reduce(lambda a, b: a & b,
                      [df[k].eqNullSafe(salts[n]) for n, k in zip(names, keys, strict=True)])
        return df.join(F.broadcast(salts), same, "left").drop(*names)

    number = F.monotonically_increasing_id() if salt is None else salt
    dealt = with_salts(left.withColumn("_number", number)).withColumn(
        "_salt", F.coalesce(F.pmod(F.col("_number"), F.col("_salts")), F.lit(0)).cast("int"))
    repeated = with_salts(right).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
    return (dealt.drop("_number", "_salts")
            .join(repeated.drop("_salts"), [*keys, "_salt"], how).drop("_salt"))
