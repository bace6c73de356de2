"""JSON sources and sinks: raw landing, ranking/team scans, envelopes."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.functions.scalar import snapshot_stamp
from rankflow.plans.manifest import commit
from rankflow.schemas import CLEANSED, SEASON, TEAM
from rankflow.sources.arrays import BLANK, read_elements


def read_rankings(spark: SparkSession, path: str, multi_line: bool = False,
                  on_bad: str = "raise") -> DataFrame:
    """Season documents with the declared schema. ``multi_line=True`` reads
    files holding one JSON value (an array gives one row per element, and a
    large file goes to many tasks); the default reads JSON lines."""
    parsed = parse_documents(spark, [path], SEASON, multi_line)
    return good_documents(parsed, on_bad).drop("_file")


def read_teams(spark: SparkSession, path: str, multi_line: bool = False,
               on_bad: str = "raise") -> DataFrame:
    return good_documents(parse_documents(spark, [path], TEAM, multi_line), on_bad).drop("_file")


def read_documents(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Raw JSON text, one row per line (splittable) or per file
    (``whole_file=True``), with the file it came from."""
    df = spark.read.text(path, wholetext=whole_file)
    return df.select(F.col("value").alias("doc"), F.col("_metadata.file_path").alias("file"))


def parse_documents(spark: SparkSession, paths: list[str], schema: T.StructType,
                    whole: bool = False) -> DataFrame:
    """Documents with ``_bad`` (the text that could not be parsed, else null)
    and ``_file``. A line, or with ``whole`` a file (split over many tasks, see
    :mod:`rankflow.sources.arrays`), holds a document or an array of them; blank
    ones are skipped. The text is parsed
    against the whole schema whatever columns are used later, so that what
    counts as bad never depends on the query."""
    marked = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    if whole:
        elements = read_elements(spark, paths).select("_file", "v")
    else:
        text = spark.read.text(paths).select(
            F.trim("value", F.lit(BLANK)).alias("v"), F.col("_metadata.file_path").alias("_file"))
        each = F.when(F.col("v").startswith("["),
                      F.from_json("v", "array<string>", {"mode": "PERMISSIVE"}))
        elements = text.where("v <> ''").select(
            "_file", F.explode(F.coalesce(each, F.array("v"))).alias("v"))
    return (elements
            .select("_file", F.from_json("v", marked, options).alias("d")).select("d.*", "_file"))


def good_documents(parsed: DataFrame, on_bad: str = "raise") -> DataFrame:
    """Parsed documents without ``_bad``. ``on_bad="raise"`` fails the job with
    the file's name as soon as a bad one is met; ``"skip"`` leaves bad ones out
    (see :func:`bad_documents` for what was left out)."""
    if on_bad == "skip":
        return parsed.where(F.col("_bad").isNull()).drop("_bad")
    if on_bad != "raise":
        raise ValueError("on_bad must be 'raise' or 'skip'")
    message = F.concat(F.lit("malformed document in "), F.col("_file"), F.lit(": "),
                       F.substring("_bad", 1, 80))
    checked = F.when(F.col("_bad").isNotNull(), F.raise_error(message).cast("string")
                     ).otherwise(F.col("_file"))
    return parsed.withColumn("_file", checked).where(F.col("_file").isNotNull()).drop("_bad")


def bad_documents(parsed: DataFrame) -> DataFrame:
    """The quarantine: file, reason and text of each bad document, and as JSON
    what of it could be read."""
    text = F.trim("_bad")
    fields = [c for c in parsed.columns if c not in ("_bad", "_file")]
    reason = (F.when(~text.rlike(r"^[\[{]"), "not JSON")
              .when(~text.rlike(r"[\]}]$"), "truncated")
              .when(F.greatest(F.lit(False), *[F.col(c).isNotNull() for c in fields]), "wrong type")
              .otherwise("malformed"))
    read = F.to_json(F.struct(*fields))
    return parsed.where(F.col("_bad").isNotNull()).select(
        F.col("_file").alias("file"), reason.alias("reason"), F.col("_bad").alias("doc"),
        read.alias("readable"))


def land_raw(payload: DataFrame, dest_root: str, dataset: str, season: int | str | None,
             stamp: str, fmt: str = "lines") -> str:
    """Write a payload (a one-column string DataFrame, e.g. from
    ``spark.read.text``) unmodified as an immutable snapshot
    ``{dest_root}/{dataset}/[season={season}/]snapshot={stamp}`` and commit it.
    Existing snapshots are never overwritten. ``fmt`` is "lines" (a document a
    line) or "whole" (each file one JSON value)."""
    spark = payload.sparkSession
    season = None if season is None else int(season)
    part = f"season={season}/" if season is not None else ""
    folder = f"{dataset}/{part}snapshot={stamp}"
    target = f"{dest_root.rstrip('/')}/{folder}"
    payload.select(F.col(payload.columns[0]).cast("string").alias("value")) \
        .write.mode("errorifexists").text(target)
    landed = spark.read.schema("value string").text(target).agg(F.count(F.lit(1)).alias("rows"))
    commit(landed.select(F.lit(dataset).alias("dataset"), F.lit(season).cast("int").alias("season"),
                         F.lit(stamp).alias("snapshot"), F.lit(folder).alias("folder"), "rows",
                         F.lit(fmt).alias("format")),
           dest_root)
    return target


def land_raw_files(spark: SparkSession, src: str, dest_root: str, dataset: str,
                   season: int | str | None, stamp: str) -> str:
    """Land fetched payload files as they are: each file is read whole
    (``wholetext``, one row per file, no re-encoding) and written as a file of
    its own under the snapshot folder, so that a JSON value over several lines
    stays readable. The text writer ends each payload with a newline."""
    files = spark.read.text(src, wholetext=True)
    n = max(1, files.count())
    spread = files.select("value", F.col("_metadata.file_path").alias("f")).repartitionByRange(n, "f")
    return land_raw(spread.select("value"), dest_root, dataset, season, stamp, "whole")


def stamp_now(spark: SparkSession) -> str:
    """Current UTC time in the snapshot stamp format (one tiny query)."""
    ts = F.convert_timezone(F.lit(spark.conf.get("spark.sql.session.timeZone")), F.lit("UTC"),
                            F.current_timestamp().cast("timestamp_ntz"))
    return spark.range(1).select(snapshot_stamp(ts).alias("s")).first()["s"]


def _rows_type(row_schema: T.StructType) -> T.ArrayType:
    return T.ArrayType(row_schema)


# Shapes of a response document.
ENVELOPE, BARE, ODD = "envelope", "rows", "odd"


def _response(doc: str, row_schema: T.StructType) -> tuple[Column, Column]:
    """Shape and rows of a response document."""
    env_t = T.StructType([T.StructField("season", T.IntegerType()),
                          T.StructField("data", _rows_type(row_schema))])
    text = F.trim(F.col(doc))
    env = F.from_json(F.when(text.startswith("{"), text), env_t)
    bare = F.from_json(F.when(text.startswith("["), text), _rows_type(row_schema))
    enveloped = (env.isNotNull() & (F.coalesce(env["season"], F.lit(0)) != 0)
                 & env["data"].isNotNull())
    shape = F.when(enveloped, ENVELOPE).when(bare.isNotNull(), BARE).otherwise(ODD)
    return shape, F.when(enveloped, env["data"]).otherwise(bare)


def unwrap_envelope(docs: DataFrame, row_schema: T.StructType = CLEANSED,
                    doc: str = "doc", seen: Observation | None = None) -> DataFrame:
    """Accept ``{"season": s, "data": [rows]}`` (season non-zero, data
    present) or a bare array of rows; anything else yields no rows.

    ``seen`` (an ``Observation``) counts documents by shape, the kept and the
    dropped, in the very pass that reads the rows; see :func:`warn_skipped`."""
    shape, rows = _response(doc, row_schema)
    read = docs.select(shape.alias("_shape"), rows.alias("_rows"))
    if seen is not None:
        count = lambda s: F.count(F.when(F.col("_shape") == s, 1)).alias(s)
        read = read.observe(seen, F.count(F.lit(1)).alias("documents"), count(ENVELOPE),
                            count(BARE), count(ODD),
                            F.coalesce(F.sum(F.size("_rows")), F.lit(0)).alias("data_rows"))
    return read.select(F.inline("_rows"))


class SkippedDocuments(UserWarning):
    """Documents of another shape were left out."""


def warn_skipped(seen: Observation, what: str = "read") -> dict[str, int]:
    """The counts of :func:`unwrap_envelope`, once an action has run on its rows;
    warns when documents were dropped."""
    counts = dict(seen.get)
    if counts[ODD]:
        warnings.warn(f"{counts[ODD]} of {counts['documents']} documents left out of the {what}: "
                      "neither an envelope nor an array of rows", SkippedDocuments, stacklevel=2)
    return counts
