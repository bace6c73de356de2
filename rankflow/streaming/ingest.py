"""Incremental cleansed build with Structured Streaming.

The stream reads the raw store's manifest: a rankings snapshot arrives as one
row, appended after its data is complete. Each new snapshot is therefore built
whole, whatever number of files it has, joined to the teams snapshot that is
newest when its batch runs, and committed to the cleansed store's manifest
under its own stamp. A batch that is repeated after a failure replaces the
folders it has written before. There is no aggregation, so no state and no
watermark; readers are those of the batch store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rankflow.operators.flatten import flatten_rankings
from rankflow.operators.merge import merge_teams
from rankflow.operators.seasons import stamp_season
from rankflow.plans.cleansed import (
    PARQUET, RANKINGS, TEAMS, read_newest, read_snapshots, write_cleansed,
)
from rankflow.plans.manifest import MANIFEST, log_path
from rankflow.schemas import CLEANSED_COLS, SEASON, TEAM


def committed_rankings(spark: SparkSession, raw_root: str,
                       max_commits_per_trigger: int | None = None) -> DataFrame:
    """Stream of the raw store's committed rankings snapshots."""
    reader = spark.readStream.schema(MANIFEST).option("recursiveFileLookup", "true")
    if max_commits_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_commits_per_trigger)
    return reader.json(log_path(raw_root)).where(F.col("dataset") == RANKINGS)


def build_snapshots(spark: SparkSession, raw_root: str, out_root: str, commits: DataFrame,
                    fmt: str = PARQUET) -> None:
    """Build each committed (season, snapshot) of a batch and commit it."""
    rows = commits.drop("committed", "version").distinct().collect()  # manifest rows
    teams = read_newest(spark, raw_root, TEAMS, TEAM, per_season=False).drop("_path_season")
    for stamp in sorted({r.snapshot for r in rows}):
        own = [r for r in rows if r.snapshot == stamp]
        docs = read_snapshots(spark, raw_root, SEASON, own)
        flat = flatten_rankings(stamp_season(docs, F.coalesce("_path_season", "season")))
        seasons = spark.createDataFrame([(r.season,) for r in own], "season int").distinct()
        write_cleansed(merge_teams(flat, teams).select(*CLEANSED_COLS), out_root, stamp, fmt,
                       seasons=seasons, replace=True)


def start_cleansed_stream(spark: SparkSession, raw_root: str, out_root: str,
                          checkpoint_location: str, available_now: bool = True,
                          processing_time: str | None = None,
                          max_commits_per_trigger: int | None = None,
                          fmt: str = PARQUET) -> StreamingQuery:
    """Start the incremental build. ``available_now`` processes everything
    committed so far in bounded batches and stops (a scheduled run); otherwise
    it keeps running with ``processing_time`` triggers."""
    def batch(commits: DataFrame, _: int) -> None:
        build_snapshots(commits.sparkSession, raw_root, out_root, commits, fmt)

    writer = (committed_rankings(spark, raw_root, max_commits_per_trigger)
              .writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint_location))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
