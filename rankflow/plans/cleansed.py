"""The cleansed snapshot: land -> pick newest -> flatten -> join -> write.

Store layout (one layout for writer and readers):
  raw:      {raw}/{dataset}/[season={Y}/]snapshot={STAMP}/part-*
  cleansed: {out}/season={Y}/snapshot={STAMP}/part-*   (Parquet by default)
Both have a manifest of committed snapshots (:mod:`rankflow.plans.manifest`),
which is what every reader goes by.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rankflow.operators.flatten import flatten_rankings
from rankflow.operators.merge import merge_teams
from rankflow.operators.seasons import require_columns, stamp_season
from rankflow.plans.manifest import claim, commit, head, newest_snapshots, season_folder
from rankflow.schemas import CLEANSED, CLEANSED_COLS, SEASON, TEAM
from rankflow.sources.columnar import decode_columnar, encode_columnar
from rankflow.sources.readers import good_documents, parse_documents

RANKINGS, TEAMS, CLEANSED_SET = "rankings", "teams", "cleansed"
PARQUET, COLUMNAR = "parquet", "columnar-json"
_STORED = "snapshot string, season int"


def read_newest(spark: SparkSession, root: str, dataset: str, schema, per_season: bool = True,
                on_bad: str = "raise") -> DataFrame:
    """Documents of the newest committed snapshot per season (or of the one
    newest) of a raw dataset. ``_path_season`` is the season of the folder a
    row was read from. ``on_bad``: see :func:`good_documents`."""
    chosen = newest_snapshots(spark, root, dataset, per_season).collect()  # a row a season
    if not chosen:
        raise FileNotFoundError(f"No {dataset} snapshot under {root}")
    return read_snapshots(spark, root, schema, chosen, on_bad)


def read_snapshots(spark: SparkSession, root: str, schema, chosen: Sequence[Row],
                   on_bad: str = "raise") -> DataFrame:
    """Documents of the given manifest rows' folders."""
    parts = []
    for whole in (False, True):
        paths = [f"{root.rstrip('/')}/{r.folder}" for r in chosen
                 if r.rows and (r.format == "whole") == whole]
        if paths:
            parts.append(good_documents(parse_documents(spark, paths, schema, whole), on_bad))
    if not parts:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn("_path_season", F.lit(None).cast("int"))
    docs = reduce(DataFrame.unionByName, parts)
    found = F.regexp_extract("_file", r"/season=(-?[0-9]+)/", 1)
    return docs.withColumn("_path_season", F.when(found != "", found.cast("int"))).drop("_file")


def build_cleansed(spark: SparkSession, raw_root: str, teams_per_season: bool = False,
                   on_bad: str = "raise") -> DataFrame:
    """Newest rankings snapshot of every season, flattened, stamped with the
    season of its folder and left-joined to the newest teams snapshot (the
    same season's when ``teams_per_season``)."""
    docs = read_newest(spark, raw_root, RANKINGS, SEASON, on_bad=on_bad)
    rows = flatten_rankings(stamp_season(docs, F.coalesce("_path_season", "season")))
    teams = read_newest(spark, raw_root, TEAMS, TEAM, teams_per_season, on_bad)
    if teams_per_season:
        teams = teams.withColumn("season", F.col("_path_season")).drop("_path_season")
        merged = merge_teams(rows, teams.select("season", *TEAM.fieldNames()),
                             on=["season", "school"])
        return merged.select(*CLEANSED_COLS)
    return merge_teams(rows, teams.drop("_path_season"), on="school")


def raw_seasons(spark: SparkSession, raw_root: str) -> DataFrame:
    """Seasons that the raw store has a rankings snapshot of, empty ones too."""
    return newest_snapshots(spark, raw_root, RANKINGS).select("season")


def write_cleansed(df: DataFrame, out_root: str, stamp: str | Sequence[str], fmt: str = PARQUET,
                   seasons: DataFrame | None = None, replace: bool = False) -> str:
    """Write one immutable snapshot per season, then commit it.

    Several stamps mean that a ``snapshot`` column says which row is whose. A
    season of ``seasons`` without rows gets an empty snapshot, so that an older
    one is not served in its place. ``replace`` lets a repeated write of the
    same snapshot take its folder over. ``columnar-json`` writes the
    compatibility encoding (bounded documents, one per line).

    A stamp is one write's: a second one with the same stamp is refused before
    it writes anything, and of two concurrent writes of a season, whatever
    their stamps, the first to commit wins (:class:`CommitConflict`).
    """
    spark = df.sparkSession
    stamps = [stamp] if isinstance(stamp, str) else list(stamp)
    base = head(spark, out_root)
    for s in stamps:
        claim(spark, out_root, s, again=replace)
    out = df.withColumn("snapshot", F.lit(stamp)) if isinstance(stamp, str) else df
    if fmt == PARQUET:
        # rebalance by the partition columns: AQE splits a hot season over
        # several tasks and merges small ones
        rows = out.hint("rebalance", "season", "snapshot")
    elif fmt == COLUMNAR:
        rows = encode_columnar(out, ["season", "snapshot"]).select("season", "snapshot", "doc")
    else:
        raise ValueError(f"unknown format {fmt!r}")
    writer = rows.write.partitionBy("season", "snapshot")
    writer = (writer.mode("overwrite").option("partitionOverwriteMode", "dynamic") if replace
              else writer.mode("append"))
    writer.parquet(out_root) if fmt == PARQUET else writer.text(out_root)

    # the folders of these stamps only, partition values and row counts only
    paths = [f"{out_root.rstrip('/')}/season=*/snapshot={s}" for s in stamps]
    counts = _counts(spark, out_root, paths, fmt)
    if seasons is not None:
        every = seasons.withColumn("snapshot", F.explode(F.array(*map(F.lit, stamps))))
        same = (F.col("e.season").eqNullSafe(F.col("c.season"))
                & (F.col("e.snapshot") == F.col("c.snapshot")))
        empty = every.alias("e").join(counts.alias("c"), same, "left_anti")
        counts = counts.unionByName(empty.withColumn("rows", F.lit(0).cast("long")))
    commit(counts.withColumn("dataset", F.lit(CLEANSED_SET)).withColumn("format", F.lit(fmt))
           .withColumn("folder", season_folder()), out_root, base)
    return out_root


def _counts(spark: SparkSession, root: str, paths: list[str], fmt: str) -> DataFrame:
    """season, snapshot, rows of the folders that ``paths`` match."""
    reader = spark.read.option("basePath", root)
    stored = [p for p in paths if _exists(spark, p)]
    if not stored:
        return spark.createDataFrame([], "season int, snapshot string, rows long")
    data = (reader.schema(f"school string, {_STORED}").parquet(*stored) if fmt == PARQUET
            else reader.schema(f"value string, {_STORED}").text(stored))
    return data.groupBy("season", "snapshot").agg(F.count(F.lit(1)).alias("rows"))


def _exists(spark: SparkSession, glob: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(glob)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def read_cleansed(spark: SparkSession, out_root: str,
                  chosen: DataFrame | Sequence[Row] | None = None,
                  ignore_strays: bool = False) -> DataFrame:
    """Rows (with ``snapshot``) of the newest committed snapshot of every
    season, or of the ``chosen`` manifest rows, in whatever format each was
    written. Only their folders are opened. Columnar documents are decoded
    after the scan (narrow, no shuffle). ``ignore_strays`` passes over files
    that are no Parquet, for callers that have counted the rows."""
    rows = chosen if chosen is not None else newest_snapshots(spark, out_root, CLEANSED_SET)
    if isinstance(rows, DataFrame):
        rows = rows.collect()  # a row a season
    picked = [r for r in rows if r.rows]
    reader = spark.read.option("basePath", out_root)
    if ignore_strays:
        reader = reader.option("ignoreCorruptFiles", "true")
    names = [*CLEANSED_COLS, "snapshot"]
    parts = []
    for fmt in (PARQUET, COLUMNAR):
        paths = [f"{out_root.rstrip('/')}/{r.folder}" for r in picked if r.format == fmt]
        if not paths:
            continue
        if fmt == PARQUET:
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in CLEANSED.fields)
            parts.append(reader.schema(f"{schema}, snapshot string").parquet(*paths).select(*names))
        else:
            docs = reader.schema(f"doc string, {_STORED}").text(paths)
            docs = docs.withColumnRenamed("season", "_dir_season")
            rows_of = decode_columnar(docs, CLEANSED, keep=["_dir_season", "snapshot"])
            parts.append(rows_of.withColumn("season", F.col("_dir_season")).select(*names))
    if not parts:
        return spark.createDataFrame([], CLEANSED).withColumn(
            "snapshot", F.lit(None).cast("string"))
    return reduce(DataFrame.unionByName, parts)


def poll_table(spark: SparkSession, out_root: str, poll: str, season_type: str,
               seasons: list[int] | None = None, version: int | None = None) -> DataFrame:
    """The multi-season poll table: newest snapshot of each (or each given)
    season, one poll and season type. Other seasons' folders are not opened.
    With ``version``, of the store as of then."""
    chosen = newest_snapshots(spark, out_root, CLEANSED_SET, version=version)
    if seasons is not None:
        chosen = chosen.where(F.col("season").isin([int(s) for s in seasons]))
    rows = read_cleansed(spark, out_root, chosen)
    rows = rows.where((F.col("poll") == poll) & (F.col("seasonType") == season_type))
    return require_columns(rows, CLEANSED_COLS)


def latest_poll_rows(spark: SparkSession, out_root: str, season: int | None = None) -> DataFrame:
    """Rows of the newest snapshot of one season, or of the single newest
    snapshot over all seasons (``season=None``)."""
    if season is None:
        return read_cleansed(spark, out_root,
                             newest_snapshots(spark, out_root, CLEANSED_SET, per_season=False))
    chosen = newest_snapshots(spark, out_root, CLEANSED_SET)
    return read_cleansed(spark, out_root, chosen.where(F.col("season") == season))


__all__ = ["CLEANSED_SET", "COLUMNAR", "PARQUET", "RANKINGS", "TEAMS",
           "build_cleansed", "latest_poll_rows", "poll_table", "raw_seasons", "read_cleansed",
           "read_newest", "read_snapshots", "write_cleansed"]
