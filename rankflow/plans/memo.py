"""Results kept by query, parameters and store version.

    {root}/_results/{name}-{parameters}/{version}.json     points to the result
    {root}/_results/{name}-{parameters}/data-*             its rows (Parquet)

The first call at a version computes and writes the result, later ones read it,
in any session. A commit makes a new version, so that what it changed is seen at
once. The pointer is created exclusively once the rows are there: of two callers
that compute at the same time one is kept, and nobody reads half a result.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rankflow.plans.cleansed import poll_table
from rankflow.plans.manifest import Files, head

RESULTS_DIR = "_results"


def _folder(name: str, parameters: dict) -> str:
    text = json.dumps(parameters, sort_keys=True, default=str)
    return f"{RESULTS_DIR}/{name}-{hashlib.sha256(text.encode()).hexdigest()[:16]}"


def memoised(spark: SparkSession, root: str, name: str, build: Callable[[int], DataFrame],
             **parameters) -> DataFrame:
    """The rows of ``build(version)`` for the store's present version. ``build``
    must read the store as of the version that it is given, and what else its
    rows depend on must be among the ``parameters``."""
    files, folder = Files(spark, root), _folder(name, parameters)
    version = head(spark, root)
    pointer = f"{folder}/{version + 1:012d}.json"  # a store without commits is version -1
    known = files.read(pointer)
    if known is None:
        rows = build(version)
        data = f"{folder}/data-{uuid.uuid4().hex}"
        rows.write.mode("errorifexists").parquet(f"{root.rstrip('/')}/{data}")
        mine = json.dumps({"data": data, "schema": rows.schema.jsonValue()})
        if not files.create(pointer, mine):
            files.delete(data)
        known = files.read(pointer)
    kept = json.loads(known)
    schema = T.StructType.fromJson(kept["schema"])
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{kept['data']}")


def forget(spark: SparkSession, root: str, name: str, keep: int = 1, **parameters) -> int:
    """Delete all but the newest ``keep`` results of a query, and give how many
    went. Whoever still reads one of those fails and has to ask again."""
    files, folder = Files(spark, root), _folder(name, parameters)
    pointers = [x for x in files.names(folder) if x.endswith(".json")]
    old = pointers[:max(0, len(pointers) - keep)]
    for pointer in old:
        data = json.loads(files.read(f"{folder}/{pointer}"))["data"]
        files.delete(f"{folder}/{pointer}")
        files.delete(data)
    return len(old)


def memoised_poll_table(spark: SparkSession, root: str, poll: str, season_type: str,
                        seasons: list[int] | None = None) -> DataFrame:
    """:func:`rankflow.plans.cleansed.poll_table`, kept until the next commit."""
    return memoised(
        spark, root, "poll_table",
        lambda version: poll_table(spark, root, poll, season_type, seasons, version),
        poll=poll, season_type=season_type, seasons=seasons)
