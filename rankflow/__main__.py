"""Command line: landing, the weekly batch and the read queries.

    python -m rankflow land         --raw RAW --src FILES --dataset D [--season S] [--stamp T]
    python -m rankflow build        --raw RAW --store STORE [--format F] [--teams-per-season]
    python -m rankflow trajectories --store STORE --out OUT [--poll P --season-type T]
    python -m rankflow movers       --store STORE --out OUT [--poll P --season-type T]
    python -m rankflow latest-poll  --store STORE --out OUT [--season S]
    python -m rankflow seasons      --store STORE
    python -m rankflow season-files --store STORE --out OUT [--season S]

``build --objects YEAR`` and ``latest-poll --objects`` read a store of one
object per snapshot as it is. Row outputs are written by Spark as JSON lines
under ``--out`` (nothing is pulled to the driver); ``seasons`` prints its few.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from rankflow.functions.scalar import iso_utc
from rankflow.operators.movers import movers
from rankflow.operators.seasons import DEFAULT_POLL, DEFAULT_SEASON_TYPE
from rankflow.operators.trajectory import trajectories
from rankflow.plans.cleansed import (
    CLEANSED_SET, build_cleansed, latest_poll_rows, poll_table, raw_seasons, write_cleansed,
)
from rankflow.plans.compat import build_cleansed_from_objects, latest_poll_from_objects
from rankflow.plans.manifest import read_manifest
from rankflow.session import get_session
from rankflow.sources.readers import land_raw_files, stamp_now
from rankflow.sources.snapshots import list_files


def _write(df, out: str) -> None:
    df.write.mode("errorifexists").json(out)
    print(json.dumps({"written": out}))


def _files_of_season(spark, store: str, season: int | None):
    """Key, time and size of the committed snapshots' files; a committed season
    without files gives no rows."""
    files = list_files(spark, store).where(~F.col("key").rlike(r"(^|/)[_.]"))
    part = lambda name: F.regexp_extract("key", f"(^|/){name}=([^/]+)/", 2)
    files = files.select(part("season").try_cast("int").alias("season"),
                         part("snapshot").alias("snapshot"), "key",
                         iso_utc("last_modified").alias("lastModified"), "size")
    done = (read_manifest(spark, store).where(F.col("dataset") == CLEANSED_SET)
            .select("season", "snapshot").distinct().alias("m"))
    rows = files.alias("f").join(done, F.col("f.season").eqNullSafe(F.col("m.season"))
                                 & (F.col("f.snapshot") == F.col("m.snapshot")), "left_semi")
    return rows if season is None else rows.where(F.col("season") == season)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="rankflow")
    sub = p.add_subparsers(dest="cmd", required=True)
    la = sub.add_parser("land")
    la.add_argument("--raw", required=True)
    la.add_argument("--src", required=True)
    la.add_argument("--dataset", required=True)
    la.add_argument("--season", type=int)
    la.add_argument("--stamp")
    b = sub.add_parser("build")
    b.add_argument("--raw", required=True)
    b.add_argument("--store", required=True)
    b.add_argument("--format", default="parquet", choices=["parquet", "columnar-json"])
    b.add_argument("--teams-per-season", action="store_true")
    b.add_argument("--skip-bad", action="store_true")
    b.add_argument("--objects", type=int, metavar="YEAR")
    for name in ("trajectories", "movers"):
        c = sub.add_parser(name)
        c.add_argument("--store", required=True)
        c.add_argument("--out", required=True)
        c.add_argument("--poll", default=DEFAULT_POLL)
        c.add_argument("--season-type", default=DEFAULT_SEASON_TYPE)
    lp = sub.add_parser("latest-poll")
    lp.add_argument("--store", required=True)
    lp.add_argument("--out", required=True)
    lp.add_argument("--season", type=int)
    lp.add_argument("--objects", action="store_true")
    s = sub.add_parser("seasons")
    s.add_argument("--store", required=True)
    sf = sub.add_parser("season-files")
    sf.add_argument("--store", required=True)
    sf.add_argument("--out", required=True)
    sf.add_argument("--season", type=int)
    args = p.parse_args(argv)

    spark = get_session()
    if args.cmd == "land":
        stamp = args.stamp or stamp_now(spark)
        target = land_raw_files(spark, args.src, args.raw, args.dataset, args.season, stamp)
        print(json.dumps({"landed": target}))
    elif args.cmd == "build":
        stamp = stamp_now(spark)
        if args.objects is not None:
            rows, seasons = build_cleansed_from_objects(spark, args.raw, args.objects), None
        else:
            rows = build_cleansed(spark, args.raw, args.teams_per_season,
                                  "skip" if args.skip_bad else "raise")
            seasons = raw_seasons(spark, args.raw)
        write_cleansed(rows, args.store, stamp, args.format, seasons=seasons)
        print(json.dumps({"snapshot": stamp, "store": args.store}))
    elif args.cmd in ("trajectories", "movers"):
        traj = trajectories(poll_table(spark, args.store, args.poll, args.season_type))
        _write(traj if args.cmd == "trajectories" else movers(traj), args.out)
    elif args.cmd == "latest-poll":
        read = latest_poll_from_objects if args.objects else latest_poll_rows
        _write(read(spark, args.store, args.season), args.out)
    elif args.cmd == "seasons":
        seasons = (read_manifest(spark, args.store).where("season IS NOT NULL")
                   .select("season").distinct().orderBy(F.col("season").desc()))
        print(json.dumps({"seasons": [r.season for r in seasons.collect()]}))
    elif args.cmd == "season-files":
        _write(_files_of_season(spark, args.store, args.season), args.out)


if __name__ == "__main__":
    main()
