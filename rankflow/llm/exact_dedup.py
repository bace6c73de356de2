"""Exact duplicates by skew-safe combining, with built-in functions only.

1. Local: the partial side of ``groupBy(digest, salt, content)`` leaves one row
   a distinct text, salt and input partition before any text is shuffled.
2. Salted: its final side merges those rows by (digest, salt). Only the digests
   that hold more than a thousandth of all rows are salted, so there are fewer
   than a thousand of them at any size, and the rest are final here.
3. Global: the salt winners of the hot digests are combined by (digest,
   content).

The content itself is a grouping key at every stage, so two texts with equal
digests are never merged. A row's salt is the hash of its block of neighbouring
doc_ids: copies that one partition holds mostly share one, so that the local
stage still merges them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import ascii_lower, id_text, partitions, without
from rankflow.session import materialize

BLOCK = 256
HOT_SHARE = 1000


def exact_duplicates(docs: DataFrame, salts: int | None = None, block: int = BLOCK,
                     hot_share: int = HOT_SHARE) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: a row for each input row.

    Texts are equal when identical after lower-casing A-Z only; a null text
    equals the empty one. The largest doc_id of a group stays, a null doc_id
    counts as the smallest (a group of null doc_ids only has a null keep_id).
    Rows that repeat both doc_id and text all come back, and exactly one of
    them is kept. An empty table gives no rows; other columns are ignored.

    ``salts`` (the session's shuffle partitions by default) spreads each digest
    that has more than 1 / ``hot_share`` of all rows.
    """
    spark = docs.sparkSession
    salts = salts or partitions(spark)
    rows = (
        id_text(docs)
        .select("doc_id", ascii_lower(F.col("text")).alias("content"))
        # coalesce: never null, so no join adds a filter that hashes each text again
        .withColumn("digest", F.coalesce(F.unhex(F.sha2("content", 256)), F.lit(b"")))
    )
    # narrow rows, written once; ``part`` tells apart different texts of one digest
    keys = materialize(rows.select("doc_id", "digest", F.xxhash64("content").alias("part"),
                                   F.monotonically_increasing_id().alias("row")), "exact_keys")
    least = keys.count() / hot_share
    hot = F.broadcast(  # fewer than hot_share rows
        keys.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > least).select("digest", F.lit(True).alias("hot")))

    block_hash = F.xxhash64(F.floor(F.col("doc_id") / F.lit(block)))
    salted = (
        rows.join(hot, "digest", "left")
        .withColumn("salt", F.when(F.col("hot"), F.pmod(block_hash, F.lit(salts))).otherwise(-1))
        .groupBy("digest", "salt", "content")
        # the filters below are on ``mark``, not on the key: both read one shuffle
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
             F.max("salt").alias("mark"))
    )
    part = F.xxhash64("content").alias("part")
    cold_groups = salted.filter("mark < 0").select("digest", part, "keep_id", "group_size")
    hot_groups = (
        salted.filter("mark >= 0").groupBy("digest", "content")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
        .select("digest", part, "keep_id", "group_size")
    )
    # the one row that stays, by partial and final aggregate, whoever repeats it
    first = (keys.groupBy("digest", "part").agg(F.max(F.struct("doc_id", "row")).alias("w"))
             .select("digest", "part", F.col("w.row").alias("first")))
    hot_first = F.broadcast(first.join(hot, "digest").drop("hot"))  # of the hot digests only
    flagged = keys.join(hot, "digest", "left")
    same = ["digest", "part"]
    members = (
        flagged.filter("hot is null").drop("hot").join(cold_groups, same).join(first, same)
        .unionByName(flagged.filter("hot").drop("hot")
                     .join(F.broadcast(hot_groups), same).join(hot_first, same))
    )
    return members.select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("first")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_distinct(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay (see ``exact_duplicates``), all columns as
    they came."""
    found = exact_duplicates(docs, **options)
    gone = found.filter(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    text = ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return without(docs, F.sha2(text, 256), gone.select("doc_id", "text_sha256"))
