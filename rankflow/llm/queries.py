"""The registered query of each operator, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rankflow.llm import bpe_codec, fim, license_scan, secret_scan, sharding, toxicity, whitening
from rankflow.llm.common import documents, tokenizer_path
from rankflow.llm.exact_dedup import exact_duplicates
from rankflow.llm.lm_scoring import score_documents
from rankflow.llm.packing import pack_documents
from rankflow.llm.simhash_dedup import near_duplicates
from rankflow.llm.spotsigs import edited_fingerprints
from rankflow.llm.token_count import count_tokens

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), tokenizer_path(WORD_BPE), capacity=2048)


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), words=3, max_bits=2)


def op3_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(documents(spark, sf_dir))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.digests(documents(spark, sf_dir), tokenizer_path(WORD_BPE))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir), tokenizer_path(WORD_BPE))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.scores(docs, toxicity.train(docs, labels))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))


def op9_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), tokenizer_path(BYTE_BPE), limit=1024)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return secret_scan.report(secret_scan.scan(docs, secret_scan.train(docs)))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(documents(spark, sf_dir), shards=40)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(documents(spark, sf_dir))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), components=8)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_spotsigs": op3_spotsigs,
    "op4_license_scan": op4_license_scan,
    "op5_bpe_codec": op5_bpe_codec,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_toxicity": op7_toxicity,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_token_count": op9_token_count,
    "op10_secret_scan": op10_secret_scan,
    "op11_sharding": op11_sharding,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL = {
    "op4_license_scan": license_scan.oracle_sql(),
    "op8_exact_dedup": """
with t as (
  select doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') as content
  from documents)
select doc_id,
       max(doc_id) over w as keep_id,
       count(*) over w as group_size,
       coalesce(doc_id = max(doc_id) over w, true) as kept,
       sha256(content) as text_sha256
from t window w as (partition by content)
""",
}
