"""Session construction and a few cluster-safe helpers."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "rankflow",
                extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    AQE stays on so joins against derived dimensions can turn into broadcasts
    from runtime sizes, small shuffle partitions are coalesced and skewed join
    partitions are split.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.optimizer.dynamicPartitionPruning.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    The setting is read from the session; where it is unset, a folder of the
    session's warehouse, which is shared as well.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    leaf = "/".join(p.strip("/") for p in parts if p) or "scratch"
    return f"{base}/rankflow/{leaf}/{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder: the session's ``spark.checkpoint.dir``,
    or, where that is unset, a folder under ``spark.sql.warehouse.dir``."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    spark.sparkContext.setCheckpointDir(base)
    return base


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared checkpoint folder
    and read it back: the lineage is cut, every later consumer reads the
    columnar files (with pruning), and a lost executor costs a re-read, not a
    recompute of the upstream plan. (``Dataset.checkpoint`` without a persist
    would run the plan twice.)"""
    path = shared_dir(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    # the schema is known: no footer job to infer it again
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str, schema: str | None = None) -> DataFrame:
    """A shared table. With ``schema`` (the needed columns only) no footer
    is read to infer one, and the scan is pruned to those columns."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))
