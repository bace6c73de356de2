"""Reads that serve what can be served, and say what was left out and why.

The newest snapshot of each season is probed on its own: its folder must be
there, and Spark must be able to read exactly the rows that its commit counted.
A torn, replaced or vanished file then costs its own season and no other. The
probe is one pass over the chosen folders that decodes every column and keeps a
row a folder; nothing but those rows comes to the driver.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rankflow.operators.seasons import filter_poll, require_columns
from rankflow.plans.cleansed import CLEANSED_SET, PARQUET, _exists, read_cleansed
from rankflow.plans.manifest import newest_snapshots
from rankflow.schemas import CLEANSED, CLEANSED_COLS
from rankflow.sources.columnar import columnar_shape

# Reasons of a skipped season.
NO_SNAPSHOT, NO_FOLDER = "no snapshot", "folder is missing"
SKIPPED = "season int, snapshot string, reason string"


class SkippedSeasons(UserWarning):
    """Seasons were left out of a best-effort read."""


@dataclass(frozen=True)
class BestEffort:
    """``rows`` of the seasons that could be read; ``skipped`` (season,
    snapshot, reason) of the others."""

    rows: DataFrame
    skipped: DataFrame


def _folder_counts(spark: SparkSession, root: str, chosen: Sequence[Row]) -> dict[str, int]:
    """Readable rows (of columnar documents: documents) by folder. Files that
    cannot be read to their end give the rows before the damage, or none."""
    parts = []
    for parquet in (True, False):
        paths = [f"{root.rstrip('/')}/{r.folder}" for r in chosen
                 if (r.format == PARQUET) == parquet]
        if not paths:
            continue
        reader = spark.read.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
        if parquet:
            data = reader.schema(CLEANSED).parquet(*paths)
            value = F.xxhash64(*[F.col(f"`{c}`") for c in data.columns])  # decodes every column
            whole = F.lit(True)
        else:
            data = reader.text(paths)
            columnar = [r.folder for r in chosen if r.format == "columnar-json"]
            value = F.xxhash64("value")
            whole = columnar_shape(F.col("value")) if columnar else F.lit(True)
        folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
        parts.append(data.select(folder.alias("folder"), value.alias("v"), whole.alias("whole"))
                     .groupBy("folder").agg(F.count(F.when(F.col("whole"), 1)).alias("n"),
                                            F.bit_xor("v").alias("seen")))
    if not parts:
        return {}
    found = reduce(DataFrame.unionByName, parts).collect()  # a row a folder
    out: dict[str, int] = {}
    for r in chosen:
        out[r.folder] = sum(x.n for x in found if x.folder.endswith("/" + r.folder))
    return out


def probe(spark: SparkSession, root: str, chosen: Sequence[Row]) -> dict[str, str]:
    """Folder to reason, of the manifest rows whose snapshots cannot be served.
    A snapshot committed without rows needs no folder."""
    reasons = {r.folder: NO_FOLDER for r in chosen
               if r.rows and not _exists(spark, f"{root.rstrip('/')}/{r.folder}")}
    there = [r for r in chosen if r.rows and r.folder not in reasons]
    counts = _folder_counts(spark, root, there)
    for r in there:
        if counts[r.folder] != r.rows:
            reasons[r.folder] = f"{counts[r.folder]} of {r.rows} rows are readable"
    return reasons


def best_effort_snapshots(spark: SparkSession, root: str, dataset: str = CLEANSED_SET,
                          seasons: Sequence[int] | None = None,
                          version: int | None = None) -> tuple[list[Row], DataFrame]:
    """The manifest rows to read, and the skipped seasons. Asked-for seasons
    that were never committed are skipped ones as well."""
    newest = newest_snapshots(spark, root, dataset, version=version)
    if seasons is not None:
        newest = newest.where(F.col("season").isin([int(s) for s in seasons]))
    chosen = newest.collect()  # a row a season
    reasons = probe(spark, root, chosen)
    skipped = [(r.season, r.snapshot, reasons[r.folder]) for r in chosen if r.folder in reasons]
    known = {r.season for r in chosen}
    skipped += [(int(s), None, NO_SNAPSHOT) for s in seasons or () if int(s) not in known]
    if skipped:
        warnings.warn(f"left out of {root}: " + "; ".join(
            f"season {s}: {reason}" for s, _, reason in skipped), SkippedSeasons, stacklevel=3)
    return ([r for r in chosen if r.folder not in reasons], spark.createDataFrame(skipped, SKIPPED))


def best_effort_poll_table(spark: SparkSession, root: str, poll: str, season_type: str,
                           seasons: Sequence[int] | None = None) -> BestEffort:
    """The multi-season poll table of every season that can be read (see
    :func:`rankflow.plans.cleansed.poll_table`, which fails as a whole)."""
    chosen, skipped = best_effort_snapshots(spark, root, seasons=seasons)
    rows = filter_poll(read_cleansed(spark, root, chosen, ignore_strays=True), poll, season_type)
    return BestEffort(require_columns(rows, CLEANSED_COLS), skipped)


def season_list(spark: SparkSession, seasons: Callable[[], DataFrame],
                default: Sequence[int] = (2024,)) -> DataFrame:
    """``seasons()`` (one ``season`` column, newest first), or ``default`` with a
    warning where listing them fails. A list that is there but empty stays
    empty: the default is for a failure. The listing is run here, so that a
    failure shows here; what it gives is a row a season."""
    try:
        found = [(r.season,) for r in seasons().select("season").collect()]
    except (PySparkException, OSError) as e:
        warnings.warn(f"no season list ({type(e).__name__}); taking {list(default)}",
                      SkippedSeasons, stacklevel=2)
        found = [(int(s),) for s in default]
    return spark.createDataFrame(found, "season int").orderBy(F.col("season").desc())
