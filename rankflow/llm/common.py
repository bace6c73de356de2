"""What the operators share: the text column, worker set-up, tokenizer files."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, a null text as the empty one. Any other
    column, whatever its name, stays out of the operator's way."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. ``lower`` is faster, and the same on a
    text of ASCII characters only."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, LOWER)))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package, also when the driver's program
    put it on ``sys.path`` by itself."""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if ROOT not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, have) if x)


def map_rows(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
             schema: str) -> DataFrame:
    """``mapInArrow`` of a per-batch function that ``make()`` builds once a task."""
    on_workers(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            if batch.num_rows:
                yield each(batch)

    return df.mapInArrow(run, schema)


def raw_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a text column; a null gives the empty text."""
    column = batch.column(batch.schema.get_field_index(name))
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    elif pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    return [x or b"" for x in column.to_pylist()]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class FileBytes:
    """A vocabulary file (a fixed size, a few MB), read on the driver and sent
    to each executor once, so that executors need no file of their own."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, "rb") as f:
            data = f.read()
        self.size = len(data)
        self._sent = spark.sparkContext.broadcast(data)

    @property
    def value(self) -> bytes:
        return self._sent.value


def join_hot(left: DataFrame, right: DataFrame, key: str, weight: str, total: int,
             share: int = 1000) -> DataFrame:
    """Inner join of many rows a key with one row a key (``weight``: how many
    rows ``left`` has for it, ``total`` over all keys). Keys with more than a
    ``share``-th of the rows, so fewer than ``share`` of them at any size, are
    broadcast; the others are shuffled."""
    is_hot = F.col(weight) > F.lit(total / share)
    hot = F.broadcast(right.filter(is_hot).drop(weight).withColumn("__hot", F.lit(True)))
    cold = right.filter(~is_hot).drop(weight)
    values = [c for c in right.columns if c not in (key, weight)]
    flagged = left.join(hot, key, "left")
    return (flagged.filter("__hot").select(*left.columns, *values)
            .unionByName(flagged.filter("__hot is null").select(*left.columns).join(cold, key)
                         .select(*left.columns, *values)))


class Remembered(dict):
    """``make(key)`` by key, for the keys of late: two generations of at most
    ``most`` entries each. Keys longer than ``longest`` are not kept, so memory
    is bounded however many keys come and however long they are."""

    def __init__(self, make: Callable, most: int = 150_000, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest, self.before = make, most, longest, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        self[key] = value
        return value


def as_row() -> Column:
    """All columns as one struct, out of the way of any other name."""
    return F.struct("*")


def whole_row(row: str, docs: DataFrame) -> list[Column]:
    """The columns of ``docs`` out of the struct ``row``, under their names."""
    return [F.col(row)[c].alias(c) for c in docs.columns]


def without(docs: DataFrame, mark: Column, gone: DataFrame) -> DataFrame:
    """``docs`` less the rows whose doc_id and ``mark`` are among the two columns
    of ``gone``, nulls equal, and less repeated rows of one doc_id and mark.

    Of these the one with the least hash of all its columns stays, so that it
    does not depend on a task's order; rows equal in all columns are told apart
    by their place in ``docs``, which a scan gives each time alike. They are
    found by partial and final aggregates: a doc_id and text that a third of all
    rows repeat are never in one task."""
    key = F.struct(F.col("doc_id").cast("long").alias("id"), mark.alias("mark"))
    rows = docs.select(as_row().alias("row"), key.alias("key"), _row_hash(docs).alias("hash"),
                       F.monotonically_increasing_id().alias("place"))
    first = (rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"),
                                     F.min(F.struct("hash", "place")).alias("stays"))
             .filter("n > 1").select("key", F.lit(False).alias("gone"), "stays.place"))
    out = gone.toDF("id", "mark").select(F.struct("id", "mark").alias("key"),
                                         F.lit(True).alias("gone"),
                                         F.lit(None).cast("long").alias("place"))
    # one decision a key, so that whole rows are shuffled once
    decided = (out.unionByName(first).groupBy(F.col("key").alias("of"))
               .agg(F.max("gone").alias("gone"), F.max("place").alias("stays")))
    return (rows.join(decided, F.col("key") == F.col("of"), "left")
            .filter(F.col("of").isNull()
                    | ~F.col("gone") & (F.col("stays") == F.col("place")))
            .select(*whole_row("row", docs)))


def _row_hash(docs: DataFrame) -> Column:
    """Of all columns; maps and variants, which no hash takes, as JSON."""
    def hashable(kind: T.DataType) -> bool:
        if isinstance(kind, T.StructType):
            return all(hashable(f.dataType) for f in kind.fields)
        if isinstance(kind, T.ArrayType):
            return hashable(kind.elementType)
        return not isinstance(kind, (T.MapType, T.VariantType))

    whole = as_row()
    return F.xxhash64(*[whole[f.name] if hashable(f.dataType) else F.to_json(F.struct(whole[f.name]))
                        for f in docs.schema.fields])
