"""SimHash near-duplicates, verified through pivot distance tables.

Fingerprints are made once per row; equal ones are collapsed before anything is
compared. A pivot table holds each distinct fingerprint's Hamming distances to
``PIVOTS`` reference fingerprints, packed eight to a bigint. By the triangle
inequality two fingerprints within ``max_bits`` differ by no more than that in
any coordinate, so a pair whose largest coordinate difference is above it is
discarded, and only survivors are compared bit by bit.

A table alone would have to be held against all pairs, so the pairs come from a
join: ``max_bits`` flips touch at most ``max_bits`` of ``max_bits + 2`` blocks
of the 64 bits, so a linked pair agrees on two whole blocks. Each fingerprint
is dealt to a bucket for every two blocks. A bucket of more than ``BUCKET``
distinct fingerprints is not paired; its members go the exact way through
common neighbours instead: two fingerprints are within two bits if and only if
some 64-bit value lies within one bit of both, so 65 rows each, grouped by that
value, link all of them to the group's least member without any pair.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.common import id_text, join_hot, map_rows, raw_texts, without
from rankflow.session import materialize

PIVOTS = 16
BUCKET = 64
PIECE = 1 << 16


def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints, the same everywhere: hashes of 0, 1, 2, ..."""
    return [xxhash.xxh64_intdigest(str(i), 1) for i in range(n)]


def fingerprint(raw: bytes, words: int = 3) -> int:
    """64 bits as a signed integer. A bit is 1 if more than half of the word
    shingles' XXH64 have it; no words give 0, fewer than ``words`` one shingle."""
    tokens = raw.lower().split()  # on bytes: A-Z only, and ASCII white space
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles, n = iter([b" ".join(tokens)]), 1
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
        n = len(tokens) - words + 1
    hashes = np.frombuffer(b"".join(map(xxhash.xxh64_digest, shingles, repeat(42))), np.uint8)
    hashes = hashes.reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, PIECE):
        ones += np.unpackbits(hashes[i:i + PIECE], axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n).view(">i8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, fp, text_hash: a row for each input row."""

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            fps = [fingerprint(x, words) for x in raw_texts(batch)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps, pa.int64()), batch.column(2)],
                ["doc_id", "fp", "text_hash"])
        return each

    rows = id_text(docs).withColumn("text_hash", F.xxhash64("text"))
    return map_rows(rows, make, "doc_id long, fp long, text_hash long")


def _bits(fp: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))


def pivot_table(fps: DataFrame) -> DataFrame:
    """``fps`` with t0, t1, ...: distances to the references, a byte each."""
    refs = [r - (1 << 64) if r >> 63 else r for r in pivots()]
    far = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(r).cast("long"))).cast("long") for r in refs]
    out = fps
    for t in range(0, len(far), 8):
        packed = far[t]
        for k, d in enumerate(far[t + 1:t + 8], 1):
            packed = packed.bitwiseOR(F.shiftleft(d, 8 * k))
        out = out.withColumn(f"t{t // 8}", packed)
    return out


def _largest_difference(n: int = PIVOTS) -> Column:
    each = [F.abs(_bits(F.col(f"a.t{k // 8}"), 8 * (k % 8), 8)
                  - _bits(F.col(f"b.t{k // 8}"), 8 * (k % 8), 8)) for k in range(n)]
    return F.greatest(*each)


def _buckets(fps: DataFrame, max_bits: int) -> DataFrame:
    blocks = max_bits + 2
    edges = [64 * i // blocks for i in range(blocks + 1)]
    part = [_bits(F.col("fp"), a, b - a) for a, b in zip(edges, edges[1:], strict=False)]
    keys = [F.struct(F.lit(n).alias("pair"), part[i].alias("x"), part[j].alias("y"))
            for n, (i, j) in enumerate(combinations(range(blocks), 2))]
    return fps.withColumn("key", F.explode(F.array(*keys)))


def links(distinct: DataFrame, max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """a, b (a < b): links between distinct fingerprints (column fp). Every
    pair within ``max_bits`` is there, or joined through others that are."""
    keyed = _buckets(pivot_table(distinct), max_bits)
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    full = materialize(keyed.join(sizes, "key"), "simhash_buckets")
    small = full.filter(F.col("n") <= bucket).drop("n")
    paired = (
        small.alias("a").join(small.alias("b"), "key")
        .filter((F.col("a.fp") < F.col("b.fp")) & (_largest_difference() <= max_bits)
                & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits))
        .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    )
    crowded = full.filter(F.col("n") > bucket).select("fp").distinct()
    return paired.unionByName(_through_neighbours(crowded, max_bits)).distinct()


def _through_neighbours(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links by common values within one bit: exact for two bits. For one bit
    the value is one of the two fingerprints, for none there are no links."""
    if max_bits > 2:
        raise ValueError("common neighbours decide up to two bits")
    if max_bits == 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).filter("false")
    flips = [0] + [1 << i if i < 63 else -(1 << 63) for i in range(64)]
    near = fps.select("fp", F.explode(F.array(
        *[F.col("fp").bitwiseXOR(F.lit(f).cast("long")) for f in flips])).alias("value"))
    if max_bits == 1:
        own = fps.select(F.col("fp").alias("value"), F.col("fp").alias("other"))
        return (near.join(own, "value").filter("fp <> other")
                .select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b")))
    least = F.min("fp").over(Window.partitionBy("value"))  # of 65 rows at most
    return near.select(least.alias("a"), F.col("fp").alias("b")).filter("a < b")


def components(edges: DataFrame) -> DataFrame:
    """fp, root: for each end of an edge the least fingerprint that it reaches.

    Rounds of least label among neighbours, then the label's own label; each
    round is a table in the shared folder, so a lost executor costs a re-read.
    """
    both = materialize(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
                       .unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))),
                       "simhash_links")
    labels = materialize(both.groupBy(F.col("u").alias("fp"))
                         .agg(F.min("v").alias("v"))
                         .select("fp", F.least("fp", "v").alias("root")), "simhash_labels")
    count = labels.count()
    while True:
        offered = (both.join(labels, both.u == labels.fp)
                   .groupBy(F.col("v").alias("fp")).agg(F.min("root").alias("offer")))
        lower = labels.join(offered, "fp").select(
            "fp", F.col("root").alias("old"), F.least("root", "offer").alias("root"))
        # a giant component's label is the key of all its members
        sizes = lower.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
        own = sizes.join(labels.select(F.col("fp").alias("root"), F.col("root").alias("next")),
                         "root")
        moved = materialize(
            join_hot(lower, own, "root", "members", count)
            .select("fp", "old", F.least("root", "next").alias("root")), "simhash_labels")
        labels = moved.drop("old")
        if moved.filter("root <> old").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, text_hash, kept: a row
    for each input row.

    Fingerprints link at ``max_bits`` or fewer differing bits; component_id is
    the smallest doc_id reachable by links, itself included, and that document
    is ``kept`` (of several texts with this doc_id the least text_hash; all
    rows that repeat it). Null and empty texts have fingerprint zero and link
    like any other. A null doc_id is a component's id, and kept, only if all
    are null. An empty table gives no rows; other columns are ignored.
    """
    fps = materialize(fingerprints(docs, words), "simhash_fingerprints")
    total = fps.count()
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    distinct = materialize(
        fps.groupBy("fp").agg(F.min(row).alias("least"), F.count(F.lit(1)).alias("n")),
        "simhash_distinct")
    labels = components(links(distinct.select("fp"), max_bits))
    rooted = materialize(
        distinct.join(labels, "fp", "left")
        .select("fp", "least", "n", F.coalesce("root", "fp").alias("root")), "simhash_roots")
    groups = rooted.groupBy("root").agg(F.min("least").alias("stays"),
                                        F.count(F.lit(1)).alias("members"))
    named = join_hot(rooted, groups, "root", "members", total)
    return join_hot(fps, named.select("fp", "stays", "n"), "fp", "n", total).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("stays.doc_id").alias("component_id"), "text_hash",
        (F.col("doc_id").eqNullSafe(F.col("stays.doc_id"))
         & (F.col("text_hash") == F.col("stays.text_hash"))).alias("kept"))


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay (see ``near_duplicates``), all columns as
    they came."""
    gone = near_duplicates(docs, words, max_bits).filter(~F.col("kept"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return without(docs, F.xxhash64(text), gone.select("doc_id", "text_hash"))
