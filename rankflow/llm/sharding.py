"""Shards of near equal bytes by k-d tree partitioning, with built-in functions only.

A node of the tree that is to become k shards is split at the weighted median
(the point of k // 2 of k shares of its bytes) along its widest dimension, until
each leaf holds the target bytes. Dimensions are metadata: source, language,
size, doc_id, each as a whole number; a dimension's width in a node is its range
there over its range in the table.

Medians are distributed: all nodes of a level are handled at once by partial
and final sums of bytes over at most ``BINS`` bins a node, which narrow around
the median until the bin that holds it weighs less than ``SLACK`` of a shard, or
is one row. Where one value of a dimension weighs more (a source with a third of
all rows), its rows are split by a hash of the row, and copies of one row by the
number that it got when the narrow table was written. So a split never depends
on what a task happens to see first, and no node is ever gathered anywhere.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.llm.common import as_row, partitions
from rankflow.session import materialize

DIMENSIONS = ("source", "lang", "size", "doc_id")
BINS = 4096
#: at most so many histogram rows come to the driver in one step
MOST_ROWS = 1 << 18
#: part of a shard's bytes by which a split may miss the median
SLACK = 0.001
#: a tree is kept on the driver and stands in the plan
MOST_SHARDS = 1 << 12
OVERHEAD = 16
_CODE_BITS, _TIE_BITS = 24, 40
_FAR, _LEAST = 1 << 62, -(1 << 63)


@dataclass
class Node:
    """``shards`` shards from ``first`` on; once split, along ``dim`` at the
    point (value, tie, row): what is less goes to node 2 * id."""

    id: int
    first: int
    shards: int
    dim: int = 0
    at: tuple[int, int, int] | None = None


def code(column: Column, kind: T.DataType) -> Column:
    """A column as a whole number of at most 62 bits: numbers and times as they
    are, anything else as a hash of its text. A null is below everything."""
    if isinstance(kind, T.IntegralType):
        value = column.cast("long")
    elif isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        number = column.cast("double")
        value = F.when(~F.isnan(number), F.floor(F.least(F.greatest(
            number, F.lit(float(-_FAR))), F.lit(float(_FAR - 1024)))).cast("long"))
    elif isinstance(kind, (T.DateType, T.TimestampType)):
        value = F.unix_seconds(column.cast("timestamp"))
    else:
        value = F.when(column.isNotNull(), F.pmod(F.xxhash64(column.cast("string")),
                                                  F.lit(1 << _CODE_BITS)))
    return F.coalesce(F.least(F.greatest(value, F.lit(-_FAR + 1)), F.lit(_FAR - 1)),
                      F.lit(-_FAR))


def keys(docs: DataFrame, dims: Sequence[str] = DIMENSIONS) -> list[Column]:
    """doc_id, size, text_crc32, dims (array of long), tie and row of ``docs``."""
    text = F.col("text").cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD
    crc = F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long")
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    codes = [code(size, T.LongType()) if d == "size" else code(F.col(f"`{d}`"), kinds[d])
             for d in dims]
    doc_id = F.col("doc_id").cast("long")
    tie = F.pmod(F.xxhash64(doc_id, crc, size), F.lit(1 << _TIE_BITS))
    return [doc_id.alias("doc_id"), size.alias("size"), crc.alias("text_crc32"),
            F.array(*codes).alias("dims"), tie.alias("tie"),
            F.monotonically_increasing_id().alias("row")]


def narrow(docs: DataFrame, dims: Sequence[str] = DIMENSIONS) -> DataFrame:
    """What the tree is grown on. The texts are read here and nowhere else."""
    return docs.select(*keys(docs, dims))


def _descend(levels: Sequence[Sequence[Node]], level: Sequence[Node] = (),
             leaves: dict[int, int] | None = None) -> Column:
    """Down the split ``levels``: the place in ``level``, the one below them, of
    the node that a row is in, or -1 less its shard where that is a leaf. A fold
    over the levels, which stand in the plan as one constant."""
    places = {n.id: k for nodes in [*levels, level] for k, n in enumerate(nodes)}

    def child(k: int) -> int:
        return places[k] if k in places else -1 - (leaves or {}).get(k, 0)

    tree = [[{"d": n.dim, "v": n.at[0], "t": n.at[1], "r": n.at[2],
              "l": child(2 * n.id), "g": child(2 * n.id + 1)} for n in nodes]
            for nodes in levels]
    start = F.lit(child(1)).cast("long")
    if not tree:
        return start

    def step(at: Column, nodes: Column) -> Column:
        cut = F.get(nodes, F.greatest(at, F.lit(0)).cast("int"))
        x = F.get("dims", cut["d"])
        less = (x < cut["v"]) | (x == cut["v"]) & (
            (F.col("tie") < cut["t"])
            | (F.col("tie") == cut["t"]) & (F.col("row") < cut["r"]))
        return F.when(at < 0, at).otherwise(F.when(less, cut["l"]).otherwise(cut["g"]))

    kind = "array<array<struct<d:int,v:bigint,t:bigint,r:bigint,l:bigint,g:bigint>>>"
    return F.aggregate(F.from_json(F.lit(json.dumps(tree)), kind), start, step)


def _split_level(rows: DataFrame, nodes: list[Node], dims: int, whole: list[int] | None,
                 share: float, slack: float) -> list[int]:
    """Find the split of every node of a level, all of them at once. ``rows``
    have ``node``: the place of their node in ``nodes``, negative in a leaf."""
    x = [F.get("dims", F.lit(i)) for i in range(dims)]
    stats = rows.groupBy("node").agg(
        F.sum("size").alias("bytes"), *[F.min(c).alias(f"low{i}") for i, c in enumerate(x)],
        *[F.max(c).alias(f"high{i}") for i, c in enumerate(x)])
    found = {r.node: r for r in stats.collect()}  # a row a node
    whole = whole or [found[0][f"high{i}"] - found[0][f"low{i}"] for i in range(dims)]
    # a search: stage (0 value, 1 tie, 2 row), fixed value and tie, range, bytes before it
    search: dict[int, Search] = {}
    for k, n in enumerate(nodes):
        s = found.get(k)
        if s is None:  # no rows: any point will do
            n.at = (0, 0, 0)
            continue
        wide = [(s[f"high{i}"] - s[f"low{i}"]) / whole[i] if whole[i] else 0.0
                for i in range(dims)]
        n.dim = max(range(dims), key=lambda i: (wide[i], -i))
        search[k] = Search(s["bytes"] * (n.shards // 2) / n.shards,
                           s[f"low{n.dim}"], s[f"high{n.dim}"])
    while search:
        bins = max(16, min(BINS, MOST_ROWS // len(search)))
        sums: dict[int, list] = {k: [] for k in search}
        for r in _histogram(rows, nodes, search, bins).collect():  # at most MOST_ROWS
            if r.bin is not None:
                sums[r.node].append((r.bin, r.bytes, r.n))
        for k, got in sums.items():
            nodes[k].at = search[k].narrowed(sorted(got), bins, slack * share)
        search = {k: s for k, s in search.items() if nodes[k].at is None}
    return whole


@dataclass
class Search:
    """The median of a node: ``goal`` bytes lie before it, ``before`` of them
    before the range from ``low`` to ``high``."""

    goal: float
    low: int
    high: int
    stage: int = 0
    value: int = 0
    tie: int = 0
    before: int = 0

    def width(self, bins: int) -> int:
        return (self.high - self.low) // bins + 1

    def narrowed(self, sums: list[tuple[int, int, int]], bins: int,
                 spare: float) -> tuple[int, int, int] | None:
        """The split, once the bin that holds the median is one row or small;
        else the range becomes that bin."""
        for b, size, count in sums:
            if self.before + size >= self.goal:
                break
            self.before += size
        else:  # the whole range lies before the goal
            self.before -= size
        start = self.low + b * self.width(bins)
        end = min(start + self.width(bins) - 1, self.high)
        if count == 1 or size <= spare:
            near_end = self.before + size - self.goal < self.goal - self.before
            point = end + 1 if near_end else start
            return ((point, _LEAST, _LEAST), (self.value, point, _LEAST),
                    (self.value, self.tie, point))[self.stage]
        if start < end:
            self.low, self.high = start, end
        elif self.stage == 0:
            self.stage, self.value, self.low, self.high = 1, start, 0, (1 << _TIE_BITS) - 1
        else:
            self.stage, self.tie, self.low, self.high = 2, start, 0, _FAR
        return None


def _histogram(rows: DataFrame, nodes: list[Node], search: dict[int, Search],
               bins: int) -> DataFrame:
    """node, bin, bytes, n: partial and final sums over each node's range."""
    state = [None] * len(nodes)
    for k, s in search.items():
        state[k] = {"d": nodes[k].dim, "s": s.stage, "v": s.value, "t": s.tie, "l": s.low,
                    "w": s.width(bins)}
    kind = "array<struct<d:int,s:int,v:bigint,t:bigint,l:bigint,w:bigint>>"
    at = F.get(F.from_json(F.lit(json.dumps(state)), kind),
               F.when(F.col("node") >= 0, F.col("node").cast("int")))
    x = F.get("dims", F.col("at.d"))
    key = (F.when(F.col("at.s") == 0, x)
           .when((F.col("at.s") == 1) & (x == F.col("at.v")), F.col("tie"))
           .when((F.col("at.s") == 2) & (x == F.col("at.v"))
                 & (F.col("tie") == F.col("at.t")), F.col("row")))
    place = F.call_function("div", key - F.col("at.l"), F.col("at.w"))
    inside = (key >= F.col("at.l")) & (place < bins)
    return (rows.withColumn("at", at).withColumn("bin", F.when(inside, place))
            .groupBy("node", "bin").agg(F.sum("size").alias("bytes"),
                                        F.count(F.lit(1)).alias("n")))


def grow(rows: DataFrame, shards: int | None = None, target_bytes: int | None = None,
         slack: float = SLACK) -> tuple[list[list[Node]], dict[int, int]]:
    """The tree over ``rows`` (a written table of :func:`narrow`), level by
    level, and the shard of each leaf. Give ``shards``, or ``target_bytes`` for
    as many as it takes."""
    total = rows.agg(F.sum("size").alias("s")).first().s or 0
    if shards is None:
        shards = max(1, -(-total // target_bytes))
    if not 1 <= shards <= MOST_SHARDS:
        raise ValueError(f"from 1 to {MOST_SHARDS} shards, not {shards}")
    dims = len(rows.select("dims").first().dims) if total else 0
    level, levels, leaves, whole = [Node(1, 0, shards)], [], {}, None
    while level:
        for n in level:
            if n.shards == 1 or not total:
                leaves[n.id] = n.first
        inner = [n for n in level if n.shards > 1 and total]
        if inner:
            here = rows.withColumn("node", _descend(levels, inner, leaves))
            whole = _split_level(here, inner, dims, whole, total / shards, slack)
            levels.append(inner)
        level = [child for n in inner for child in (
            Node(2 * n.id, n.first, n.shards // 2),
            Node(2 * n.id + 1, n.first + n.shards // 2, n.shards - n.shards // 2))]
    return levels, leaves


def assign(rows: DataFrame, levels: Sequence[Sequence[Node]], leaves: dict[int, int]) -> DataFrame:
    """``rows`` (with dims, tie, row) and the ``shard`` of each."""
    return rows.withColumn("shard", (-1 - _descend(levels, leaves=leaves)).cast("int"))


def with_slots(rows: DataFrame, buckets: int | None = None) -> DataFrame:
    """``rows`` (tie, row, shard) with ``slot``, gapless from 0 in each shard: a
    shard is numbered in buckets, so that it is never sorted in one task."""
    buckets = buckets or partitions(rows.sparkSession)
    dealt = rows.withColumn("bucket", F.pmod(F.col("tie") + F.col("row"), F.lit(buckets)))
    upto = Window.partitionBy("shard").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = (dealt.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
             .select("shard", "bucket", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base")))
    place = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("tie", "row")) - 1
    return (dealt.withColumn("place", place).join(bases, ["shard", "bucket"])
            .withColumn("slot", (F.col("base") + F.col("place")).cast("long"))
            .drop("bucket", "place", "base"))


def shards(docs: DataFrame, shards: int = 40, dims: Sequence[str] = DIMENSIONS,
           slack: float = SLACK) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: a row for each
    input row.

    The law is ``bytes``: shards differ by a few documents' sizes and ``slack``
    for each level of the tree. A null text has no bytes and the checksum 0,
    like an empty one; a null source, language or doc_id is a value below all
    others. Repeated rows are rows like any other and may fall into different
    shards, as copies must where a group of them outweighs a shard. With fewer
    rows than shards, some shards are empty; an empty table gives no rows.
    Columns other than text, doc_id and the dimensions are ignored.
    """
    rows = materialize(narrow(docs, dims), "sharding_rows")
    levels, leaves = grow(rows, shards=shards, slack=slack)
    # written once: the slots below are counted and given on the same rows
    placed = materialize(assign(rows, levels, leaves)
                         .select("doc_id", "size", "text_crc32", "tie", "row", "shard"),
                         "sharding_placed")
    return with_slots(placed).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, target_bytes: int,
                 dims: Sequence[str] = DIMENSIONS, files: int = 1,
                 by: str = "shard") -> dict[int, int]:
    """Write whole documents as ``path/shard=N/`` (Parquet, all their columns;
    ``by`` is the folders' name), as many shards as ``target_bytes`` asks for,
    each in up to ``files`` files. Gives the shard of each leaf of the tree.
    ``docs`` must give the same rows in the same order when read again, as a
    scan does."""
    rows = materialize(narrow(docs, dims), "sharding_rows")
    levels, leaves = grow(rows, target_bytes=target_bytes)
    placed = assign(docs.select(as_row().alias("whole"), *keys(docs, dims)), levels, leaves)
    file = F.pmod(F.col("tie") + F.col("row"), F.lit(files))
    (placed.select("whole", "shard", file.alias("file"))
     .repartition(max(partitions(docs.sparkSession), len(leaves) * files), "shard", "file")
     .select("whole.*", F.col("shard").alias(by)).write.partitionBy(by).parquet(path))
    return leaves
