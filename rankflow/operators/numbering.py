"""Gapless row numbers over a whole table or within groups, without putting a
table or a hot group into one task.

Rows are written once with an id that holds their partition and their place in
it. Rows a partition (or a group and partition) are counted; a running sum over
those few counts gives each partition its first number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankflow.session import materialize

#: ``monotonically_increasing_id`` keeps the place in the low 33 bits.
_PLACE_BITS = 33


def with_row_ids(df: DataFrame, name: str = "_row") -> DataFrame:
    """``df`` written to the shared folder with a unique long a row, ascending
    in the order of its partitions and of the rows within them."""
    return materialize(df.withColumn(name, F.monotonically_increasing_id()), "numbered")


def with_positions(df: DataFrame, name: str = "_position", order: Sequence = (),
                   partitions: int | None = None) -> DataFrame:
    """``df`` with its 0-based position, in the order given or, without one, in
    the order in which its partitions hold the rows now. An order is kept by
    range partitions, so rows that tie are numbered in any order among
    themselves; repeated rows get positions of their own."""
    if order:
        n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    rows = with_row_ids(df, "_rid")
    part = F.shiftright("_rid", _PLACE_BITS).alias("_part")
    # one row a partition: small enough for a window without a key
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = (rows.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
             .select("_part", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_first")))
    place = F.col("_rid").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (rows.withColumn("_part", part).join(first, "_part")
            .withColumn(name, (F.col("_first") + place).cast("long"))
            .drop("_rid", "_part", "_first"))


def with_group_positions(df: DataFrame, group: Sequence[str],
                         name: str = "_position") -> DataFrame:
    """``df`` with its 0-based position within ``group`` (nulls are a group), in
    the order in which the partitions hold the rows now. A group is numbered
    partition by partition, so a task never holds more of it than one input
    partition does."""
    rows = with_row_ids(df, "_rid")
    part = F.shiftright("_rid", _PLACE_BITS).alias("_part")
    key = F.struct(*[F.col(c) for c in group]).alias("_g")  # struct keys match nulls
    keyed = rows.select("*", part, key)
    # a row a group and partition, summed within the group
    upto = Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = (keyed.groupBy("_g", "_part").agg(F.count(F.lit(1)).alias("_n"))
             .select("_g", "_part", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_first")))
    here = F.row_number().over(Window.partitionBy("_g", "_part").orderBy("_rid")) - 1
    return (keyed.withColumn("_here", here).join(first, ["_g", "_part"])
            .withColumn(name, (F.col("_first") + F.col("_here")).cast("long"))
            .drop("_rid", "_part", "_g", "_here", "_first"))
