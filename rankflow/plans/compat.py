"""Readers for stores laid out by the original application, one object per
snapshot:

  raw:      {year}/raw/rankings_{stamp}.json   (a top-level JSON array)
            {year}/raw/teams_{stamp}.json
  cleansed: cleansed/{season}/poll_{stamp}.json (columnar or row-oriented)

These let an existing bucket be read as it is. A raw object is split over tasks
(:mod:`rankflow.sources.arrays`); a cleansed one is a single document and so one
task; the native store (:mod:`rankflow.plans.cleansed`) has no such limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.operators.flatten import flatten_rankings
from rankflow.operators.merge import merge_teams
from rankflow.operators.seasons import stamp_season
from rankflow.schemas import CLEANSED
from rankflow.sources.columnar import decode_snapshot
from rankflow.sources.readers import read_documents, read_rankings, read_teams
from rankflow.sources.snapshots import latest_poll, latest_snapshot, list_files


def _path(root: str, key: str) -> str:
    return f"{root.rstrip('/')}/{key}"


def build_cleansed_from_objects(spark: SparkSession, root: str, year: int) -> DataFrame:
    """Newest raw rankings and teams objects of a year -> cleansed rows."""
    listing = list_files(spark, root)
    rk = latest_snapshot(listing, f"{year}/raw/rankings_").first()["key"]
    tk = latest_snapshot(listing, f"{year}/raw/teams_").first()["key"]
    rows = flatten_rankings(read_rankings(spark, _path(root, rk), multi_line=True))
    return merge_teams(rows, read_teams(spark, _path(root, tk), multi_line=True))


def latest_poll_from_objects(spark: SparkSession, root: str,
                             season: int | None = None) -> DataFrame:
    """Rows of the newest ``cleansed/{season}/poll_*.json`` object (or the
    newest over all seasons), decoded by shape; stamped with ``season`` when
    one was asked for."""
    key = latest_poll(list_files(spark, root), season).first()["key"]
    rows = decode_snapshot(read_documents(spark, _path(root, key), whole_file=True), CLEANSED)
    return stamp_season(rows, F.lit(season)) if season is not None else rows
