"""Snapshot listings: list, pick the newest, list seasons.

Everything works on a listing DataFrame ``(key, last_modified, size)`` so the
same plans run on a real file listing (:func:`list_files`) or on a table.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.functions.scalar import iso_utc

# Fixed values of the snapshot layout.
CLEANSED_AREA = "cleansed"
POLL_MARK = "poll_"
SNAPSHOT_SUFFIX = ".json"
FALLBACK_SEASONS = (2024,)


class NoSnapshotError(FileNotFoundError):
    pass


def _root_prefix(root: str) -> str:
    """The listing root as listed paths spell it: ``/abs/path/`` for local
    roots (``file:`` URIs and relative paths included), ``scheme://…/`` else."""
    r = root.rstrip("/") + "/"
    if r.startswith("file:"):
        return "/" + r[len("file:"):].lstrip("/")
    if "://" not in r:
        return os.path.abspath(r).rstrip("/") + "/"
    return r


def list_files(spark: SparkSession, root: str, glob: str | None = None,
               recursive: bool = True) -> DataFrame:
    """File listing with metadata. ``binaryFile`` with the content column
    pruned reads no file bodies; Spark lists directories in parallel."""
    if "://" not in root and not root.startswith(("/", "file:")):
        root = os.path.abspath(root)  # one resolution for the reader and the prefix
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(root).select("path", "modificationTime", "length")
    prefix = _root_prefix(root)
    session_tz = spark.conf.get("spark.sql.session.timeZone")
    # listed local paths read "file:/a/b"; keys are relative to the root
    rel = F.regexp_replace(F.col("path"), r"^file:/+", "/")
    rel = F.when(F.instr(rel, prefix) == 1,
                 F.substring(rel, len(prefix) + 1, 1 << 30)).otherwise(rel)
    return files.select(
        rel.alias("key"),
        F.convert_timezone(F.lit(session_tz), F.lit("UTC"),
                           F.col("modificationTime").cast("timestamp_ntz")).alias("last_modified"),
        F.col("length").cast("long").alias("size"))


def key_part(i: int, key: str = "key"):
    """0-based ``/``-separated part of a key (null when absent)."""
    return F.try_element_at(F.split(F.col(key), "/"), F.lit(i + 1))


def _newest_first(df: DataFrame, ts: str):
    """A long that sorts the newest time first (nulls last)."""
    t = F.col(ts)
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), t)
    else:
        micros = F.unix_micros(t.cast("timestamp"))
    return F.coalesce(-micros, F.lit(2**63 - 1))


def latest_per_group(listing: DataFrame, group_cols: Sequence[str],
                     ts: str = "last_modified", key: str = "key") -> DataFrame:
    """Newest row per group; on equal times the first key in listing order
    (ascending) wins.

    One partial + final aggregate: ``min(struct(-time, key, row))``. Each
    task reduces its own rows per group before the shuffle, so a season with
    a third of all files never lands whole in one task (a window would sort
    it there).
    """
    best = F.min(F.struct(_newest_first(listing, ts).alias("_t"), F.col(key).alias("_k"),
                          F.struct(*[F.col(c) for c in listing.columns]).alias("_row")))
    return (listing.groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)])
            .agg(best.alias("_b")).select("_b._row.*"))


def newest(listing: DataFrame, ts: str = "last_modified", key: str = "key") -> DataFrame:
    """The single newest row (top-1: every task keeps its own best row)."""
    return listing.orderBy(F.col(ts).desc_nulls_last(), F.col(key).asc()).limit(1)


def _ensure(df: DataFrame, on_missing: str, what: str) -> DataFrame:
    if on_missing == "raise":
        if df.isEmpty():
            raise NoSnapshotError(f"No files found for {what}")
    elif on_missing != "empty":
        raise ValueError("on_missing must be 'raise' or 'empty'")
    return df


def latest_snapshot(listing: DataFrame, prefix: str, on_missing: str = "raise") -> DataFrame:
    """Newest key under a prefix (e.g. ``2024/raw/rankings_``)."""
    picked = newest(listing.where(F.col("key").startswith(prefix)))
    return _ensure(picked, on_missing, f"prefix {prefix}")


def with_season(listing: DataFrame, area: str = CLEANSED_AREA) -> DataFrame:
    """Season parsed from ``{area}/{season}/...`` keys (null when not numeric)."""
    part = key_part(1)
    return listing.withColumn(
        "season", F.when(F.col("key").startswith(area + "/") & part.rlike("^[0-9]+$"),
                         part.try_cast("int")))


def poll_files(listing: DataFrame, area: str = CLEANSED_AREA) -> DataFrame:
    """Snapshot keys: contain ``poll_`` and end with ``.json``."""
    return listing.where(F.col("key").contains(POLL_MARK) & F.col("key").endswith(SNAPSHOT_SUFFIX)
                         & F.col("key").startswith(area + "/"))


def _season_prefixed(listing: DataFrame, area: str) -> DataFrame:
    """Keys under ``{area}/{season}/poll_`` with a canonical season number."""
    s = with_season(listing, area)
    prefix = F.concat(F.lit(area + "/"), F.col("season").cast("string"), F.lit("/" + POLL_MARK))
    return s.where(F.col("season").isNotNull() & F.col("key").startswith(prefix))


def latest_poll(listing: DataFrame, season: int | None = None, area: str = CLEANSED_AREA,
                on_missing: str = "raise") -> DataFrame:
    """Newest poll snapshot of one season, or the one newest over all seasons
    (``season=None``)."""
    files = poll_files(listing, area)
    if season is not None:
        files = files.where(F.col("key").startswith(f"{area}/{season}/{POLL_MARK}"))
    return _ensure(newest(files), on_missing, f"season {season}")


def latest_poll_per_season(listing: DataFrame, area: str = CLEANSED_AREA) -> DataFrame:
    """``latest_poll(season)`` for every season at once."""
    files = poll_files(_season_prefixed(listing, area), area)
    return latest_per_group(files, ["season"])


def season_files(listing: DataFrame, season: int | None = None,
                 area: str = CLEANSED_AREA) -> DataFrame:
    """File metadata (key, ISO mtime, size) of the poll snapshots of a season
    (all seasons when ``season`` is None)."""
    files = _season_prefixed(listing, area).where(F.col("key").endswith(SNAPSHOT_SUFFIX))
    if season is not None:
        files = files.where(F.col("season") == season)
    return files.select("season", "key", iso_utc("last_modified").alias("lastModified"), "size")


def available_seasons(listing: DataFrame, area: str = CLEANSED_AREA,
                      default: Sequence[int] | None = None) -> DataFrame:
    """Distinct numeric directory names directly under ``{area}/``, newest
    first. With ``default``, those seasons are returned when none is found."""
    part = key_part(1)
    is_dir = F.col("key").startswith(area + "/") & (F.size(F.split(F.col("key"), "/")) >= 3)
    seasons = (listing.where(is_dir & part.rlike("^[0-9]+$"))
               .select(part.try_cast("int").alias("season")).where("season IS NOT NULL").distinct())
    if default is not None:
        spark = listing.sparkSession
        fallback = spark.createDataFrame([(int(s),) for s in default], "season int")
        both = (seasons.withColumn("_real", F.lit(True))
                .unionByName(fallback.withColumn("_real", F.lit(False))))
        # The union has (distinct seasons + a few) rows: a whole-table window is fine.
        any_real = F.max("_real").over(Window.partitionBy())
        seasons = (both.withColumn("_any", any_real).where(F.col("_real") | ~F.col("_any"))
                   .select("season").distinct())
    return seasons.orderBy(F.col("season").desc())
