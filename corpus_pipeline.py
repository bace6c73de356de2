"""From raw documents to packed training sequences, in five stages.

A stage gets what the one before it has written. All but the last give the
columns of ``documents`` back: a stage drops documents or changes their text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm import exact_dedup, packing, secret_scan, simhash_dedup, toxicity
from rankflow.llm.common import as_row, documents, tokenizer_path
from rankflow.session import materialize

#: Toxicity, near duplicates, secret models and packing are beyond SQL.
ORACLE_SQL = None


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go. Without labels none does."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z the largest doc_id stays."""
    return exact_dedup.keep_distinct(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash the smallest doc_id stays."""
    return simhash_dedup.keep_one(docs, words=3, max_bits=2)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each secret becomes a mark; every document stays. ``n_chars`` follows
    the text where that has changed."""
    # the row is set aside as one column, so that no name of it is in the way
    held = docs.select(as_row().alias("row"), F.col("text"))
    out = secret_scan.mask(held, secret_scan.train(docs))
    changed = F.col("text") != F.col("row")["text"]
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(changed, length).otherwise(F.col("row")["n_chars"])
    return out.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their ids and places in sequences of 2,048 ids. The workers
    hold what the stages before have left in them, so they remember fewer words."""
    path = tokenizer_path("word_bpe_49k.json")
    return packing.pack_documents(docs, path, capacity=2048, with_ids=True, remember=160_000)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
