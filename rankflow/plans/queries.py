"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
computed from the shared tables (or from files Spark wrote from them).

Column names and types match ``rankflow.plans.oracle``; array columns are
rendered as strings (``|``-joined) so results compare by value.
"""

from __future__ import annotations

from collections.abc import Callable

import warnings

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.functions.scalar import (
    default_color, default_logos, delta_label, iso_utc, point_label, season_week_label,
    snapshot_key, tooltip,
)
from rankflow.operators.flatten import flatten_rankings, nest_rankings
from rankflow.operators.merge import merge_teams
from rankflow.operators.movers import first_ranks, movers, rank_delta, with_first_rank
from rankflow.operators.ranks import tie_groups, visual_rank, week_groups
from rankflow.operators.seasons import (
    filter_poll, json_type_report, sample_rows, stamp_season,
)
from rankflow.operators.trajectory import (
    chart_rows, emphasis, plot_rank, team_series, top_schools, trajectories,
)
from rankflow.operators.weeks import axis_bounds, season_changes, week_dimension
from rankflow.plans import fixtures
from rankflow.plans.besteffort import SkippedSeasons, best_effort_poll_table, season_list
from rankflow.plans.cleansed import (
    COLUMNAR, PARQUET, RANKINGS, TEAMS, build_cleansed, latest_poll_rows, poll_table, raw_seasons,
    read_cleansed, read_newest, write_cleansed,
)
from rankflow.plans.manifest import CommitConflict, commit, head, season_folder
from rankflow.plans.memo import memoised_poll_table
from rankflow.plans.oracle import SLICE_POLL, SLICE_TYPE
from rankflow.schemas import CLEANSED, CLEANSED_COLS, SEASON, TEAM
from rankflow.session import shared_dir
from rankflow.sources.columnar import decode_columnar, decode_snapshot, encode_columnar, encode_rows
from rankflow.sources.readers import (
    bad_documents, good_documents, land_raw, parse_documents, read_documents, read_rankings,
    unwrap_envelope,
)
from rankflow.sources.snapshots import (
    FALLBACK_SEASONS, available_seasons, latest_per_group, latest_poll, latest_poll_per_season,
    list_files,
    season_files, with_season,
)

Query = Callable[[SparkSession, str], DataFrame]
# Fixed stamps of the fixture landings: an older and a newer snapshot.
OLD_STAMP, NEW_STAMP = "2024-09-02T12-00-00Z", "2024-09-09T12-00-00Z"
TORN_STAMP = "2024-09-16T12-00-00Z"  # written in part, never committed
FIRST_SEASON, EMPTIED_SEASON = 1995, 1900
EVERY_POLL = ("season", "week", "poll", "seasonType")
# Small documents in the codec round trips, so every season spans many blocks.
FIXTURE_BLOCK_ROWS = 500


def _logos_str(df: DataFrame) -> DataFrame:
    return df.withColumn("logos", F.array_join("logos", "|"))


def _cleansed(spark, sf):
    return merge_teams(fixtures.poll_rows(spark, sf), fixtures.teams(spark, sf))


def _slice(spark, sf):
    return filter_poll(_cleansed(spark, sf), SLICE_POLL, SLICE_TYPE)


def _traj(spark, sf):
    return trajectories(_slice(spark, sf))


# -- sources / sinks -------------------------------------------------------

def _land_teams(spark: SparkSession, sf: str, root: str) -> None:
    teams_json = fixtures.teams(spark, sf).select(F.to_json(F.struct("*")).alias("v"))
    land_raw(teams_json, root, TEAMS, None, OLD_STAMP)
    land_raw(teams_json, root, TEAMS, None, NEW_STAMP)


def _land_rankings(spark: SparkSession, sf: str, shift: int = 0) -> str:
    """Rankings landed as ``rankings/season=Y/snapshot=S`` text files: a stale
    and a newer snapshot of every season, the null one included, one season
    whose newest snapshot is empty, and a half-written one that was never
    committed. ``shift`` makes the documents' own season differ from their
    folder's."""
    root = shared_dir(spark, "raw")
    docs = nest_rankings(fixtures.poll_rows(spark, sf))
    gone = nest_rankings(fixtures.poll_rows(spark, sf).where(F.col("season") == FIRST_SEASON)
                         .withColumn("season", F.lit(EMPTIED_SEASON)))
    stale = nest_rankings(flatten_rankings(docs).withColumn("points", F.col("points") - 1))
    half = nest_rankings(flatten_rankings(docs).withColumn("points", F.col("points") + 1)
                         .where("week = 1"))
    frames = [(OLD_STAMP, stale.unionByName(gone)), (NEW_STAMP, docs), (TORN_STAMP, half)]
    # all snapshots in one write job: the shared upstream exchange is reused
    parts = None
    for stamp, frame in frames:
        own = frame.withColumn("_folder", F.col("season")).withColumn(
            "season", F.col("season") + shift)
        part = own.select(F.col("_folder").alias("season"), F.lit(stamp).alias("snapshot"),
                          F.to_json(F.struct(*[f.name for f in SEASON.fields])).alias("value"))
        parts = part if parts is None else parts.unionByName(part)
    parts.write.mode("errorifexists").partitionBy("season", "snapshot").text(f"{root}/{RANKINGS}")
    landed = (spark.read.schema("value string, season int, snapshot string")
              .text(f"{root}/{RANKINGS}").where(F.col("snapshot") != TORN_STAMP)
              .groupBy("season", "snapshot").agg(F.count(F.lit(1)).alias("rows")))
    empty = spark.createDataFrame([(EMPTIED_SEASON, NEW_STAMP, 0)],
                                  "season int, snapshot string, rows long")
    commit(landed.unionByName(empty).withColumn("dataset", F.lit(RANKINGS))
           .withColumn("format", F.lit("lines"))
           .withColumn("folder", season_folder(f"{RANKINGS}/")), root)
    _land_teams(spark, sf, root)
    return root


def q_land_raw(spark, sf):
    """A raw payload landed unmodified: header, polls and ranks of each
    document, parsed from the landed text."""
    root = shared_dir(spark, "land")
    docs = nest_rankings(fixtures.poll_rows(spark, sf))
    payload = docs.select(F.to_json(F.struct(*[f.name for f in SEASON.fields])).alias("v"))
    target = land_raw(payload, root, RANKINGS, None, NEW_STAMP)
    doc = F.from_json("value", SEASON)
    return spark.read.text(target).select(doc.alias("d")).select(
        "d.season", "d.seasonType", "d.week", F.size("d.polls").alias("n_polls"),
        F.aggregate("d.polls", F.lit(0), lambda n, p: n + F.size(p["ranks"])).alias("n_ranks"))


def q_read_rankings(spark, sf):
    docs = read_newest(spark, _land_rankings(spark, sf), RANKINGS, SEASON)
    return flatten_rankings(docs)


def q_read_teams(spark, sf):
    root = shared_dir(spark, "raw_teams")
    _land_teams(spark, sf, root)
    teams = read_newest(spark, root, TEAMS, TEAM, per_season=False)
    return _logos_str(teams.select(*TEAM.fieldNames()))


def q_list_snapshots(spark, sf):
    """Snapshots in the file listing (key, mtime, size) of a landed store."""
    files = list_files(spark, _land_rankings(spark, sf))
    key = F.col("key")
    part = lambda name: F.regexp_extract(key, f"(^|/){name}=([^/]+)/", 2)
    return files.where(~key.rlike(r"(^|/)[_.]")).groupBy(
        F.split(key, "/")[0].alias("dataset"), part("season").try_cast("int").alias("season"),
        part("snapshot").alias("snapshot"),
    ).agg(F.bool_and(F.col("size") > 0).alias("hasSize"),
          F.bool_and(F.col("last_modified").isNotNull()).alias("hasTime"))


def q_bad_documents(spark, sf):
    """Documents by what became of them: every week-2 document is cut short and
    every week-3 one replaced by text that is no JSON."""
    path = shared_dir(spark, "mixed")
    docs = nest_rankings(fixtures.poll_rows(spark, sf))
    text = F.to_json(F.struct(*[f.name for f in SEASON.fields]))
    week = F.col("week")
    broken = (F.when(week == 2, F.expr("substring(v, 1, length(v) - 5)"))
              .when(week == 3, F.concat(F.lit("<html> "), F.col("season").cast("string")))
              .otherwise(F.col("v")))
    docs.withColumn("v", text).select(F.coalesce(broken, F.lit("<html>"))).write.text(path)
    parsed = parse_documents(spark, [path], SEASON)
    kept = good_documents(parsed, "skip").select(F.lit("kept").alias("reason"), "season")
    gone = bad_documents(parsed).select("reason", F.lit(None).cast("int").alias("season"))
    return kept.unionByName(gone).groupBy("reason", "season").agg(F.count(F.lit(1)).alias("n"))


def q_build_cleansed(spark, sf):
    raw = _land_rankings(spark, sf)
    out = shared_dir(spark, "cleansed")
    write_cleansed(build_cleansed(spark, raw), out, NEW_STAMP, seasons=raw_seasons(spark, raw))
    return _logos_str(read_cleansed(spark, out).select(*CLEANSED_COLS))


def _cleansed_store(spark, sf, fmt: str = PARQUET) -> str:
    """Cleansed store with a stale and a newer snapshot per season. Each season
    has a stamp of its own; the newest is neither the smallest season's nor
    the largest's."""
    out = shared_dir(spark, "cleansed")
    rows = _cleansed(spark, sf)
    stale = rows.withColumn("points", F.col("points") - 1).withColumn("snapshot", F.lit(OLD_STAMP))
    stamps = [f"2024-09-{day:02d}T12-00-00Z" for day in range(9, 16)]
    turn = F.pmod((F.col("season") - FIRST_SEASON) * 3, F.lit(7))
    own = F.element_at(F.array(*map(F.lit, stamps)), F.coalesce(turn, F.lit(0)) + 1)
    both = stale.unionByName(rows.withColumn("snapshot", own))
    write_cleansed(both, out, [OLD_STAMP, *stamps], fmt)
    return out


def q_union_seasons(spark, sf):
    out = _cleansed_store(spark, sf)
    rows = poll_table(spark, out, SLICE_POLL, SLICE_TYPE)
    return _logos_str(rows.select(*CLEANSED_COLS))


def q_latest_poll_rows(spark, sf):
    """Rows of the one newest snapshot over all seasons."""
    out = _cleansed_store(spark, sf)
    return _logos_str(latest_poll_rows(spark, out, None).select(*CLEANSED_COLS))


def q_latest_poll_columnar(spark, sf):
    """The same from a store of columnar documents."""
    out = _cleansed_store(spark, sf, COLUMNAR)
    return _logos_str(latest_poll_rows(spark, out, None).select(*CLEANSED_COLS))


def q_stamp_season(spark, sf):
    """Rows stamped with the season of the folder they were read from; the
    documents say another one."""
    docs = read_newest(spark, _land_rankings(spark, sf, shift=100), RANKINGS, SEASON)
    rows = flatten_rankings(stamp_season(docs, F.col("_path_season")))
    return filter_poll(rows, SLICE_POLL, SLICE_TYPE)


def q_encode_columnar(spark, sf):
    """encode -> decode round trip in one plan (no files)."""
    docs = encode_columnar(_cleansed(spark, sf), ["season"], block_rows=FIXTURE_BLOCK_ROWS)
    return _logos_str(decode_columnar(docs, CLEANSED).select(*CLEANSED_COLS))


def q_decode_columnar(spark, sf):
    """Regular-season rows stored columnar, postseason rows row-oriented
    (every row is in one of the two); written as text, read back and decoded
    by shape."""
    rows = _cleansed(spark, sf)
    regular = rows.where(F.col("seasonType") == "regular")
    other = rows.where(~F.col("seasonType").eqNullSafe(F.lit("regular")))
    path = shared_dir(spark, "snapshots")
    docs = (encode_columnar(regular, ["season"], block_rows=FIXTURE_BLOCK_ROWS)
            .select("season", "doc")
            .unionByName(encode_rows(other, ["season"], block_rows=FIXTURE_BLOCK_ROWS)
                         .select("season", "doc")))
    docs.write.mode("errorifexists").partitionBy("season").text(path)
    back = read_documents(spark, path)
    return _logos_str(decode_snapshot(back, CLEANSED).select(*CLEANSED_COLS))


def q_unwrap_envelope(spark, sf):
    rows = _cleansed(spark, sf)
    # regular-season documents in an envelope, the rest (and rows without a
    # season, which an envelope cannot state) as bare arrays
    in_env = F.col("seasonType").eqNullSafe(F.lit("regular")) & F.col("season").isNotNull()
    env = encode_rows(rows.where(in_env), ["season"], block_rows=FIXTURE_BLOCK_ROWS, envelope=True)
    bare = encode_rows(rows.where(~in_env), ["season"], block_rows=FIXTURE_BLOCK_ROWS)
    docs = env.select("doc").unionByName(bare.select("doc"))
    return _logos_str(unwrap_envelope(docs, CLEANSED).select(*CLEANSED_COLS))


# -- listing ---------------------------------------------------------------

def _listing_out(df: DataFrame, with_season_col: bool = True) -> DataFrame:
    cols = (["season"] if with_season_col else []) + [
        "key", iso_utc("last_modified").alias("lastModified"), "size"]
    return df.select(*cols)


def q_latest_raw_snapshot(spark, sf):
    lst = with_season(fixtures.listing(spark, sf))
    return _listing_out(latest_per_group(lst, ["season"]))


def q_latest_poll_season(spark, sf):
    return _listing_out(latest_poll_per_season(fixtures.listing(spark, sf)))


def q_latest_poll_any(spark, sf):
    return _listing_out(latest_poll(fixtures.listing(spark, sf), None), with_season_col=False)


def q_season_files(spark, sf):
    return season_files(fixtures.listing(spark, sf))


def q_available_seasons(spark, sf):
    return available_seasons(fixtures.listing(spark, sf), default=FALLBACK_SEASONS)


def q_snapshot_key(spark, sf):
    e = fixtures.table(spark, sf, "events", fixtures.EVENTS)
    season = F.lit(fixtures.LISTING_BASE_SEASON) + F.col("user_id") % fixtures.LISTING_SEASONS
    return e.select("event_id", snapshot_key(season, "rankings", F.col("ts")).alias("key"))


# -- rows, ranks, weeks ------------------------------------------------------

def q_flatten_rankings(spark, sf):
    return flatten_rankings(nest_rankings(fixtures.poll_rows(spark, sf)))


def q_merge_teams(spark, sf):
    return _logos_str(_cleansed(spark, sf))


def q_filter_poll(spark, sf):
    return filter_poll(fixtures.poll_rows(spark, sf), SLICE_POLL, SLICE_TYPE)


def q_sample_rows(spark, sf):
    return sample_rows(q_filter_poll(spark, sf), 3, ["season", "week", "rank", "school"])


def q_season_week_label(spark, sf):
    return fixtures.poll_rows(spark, sf).select(
        "season", "week", "poll", "seasonType", "school", season_week_label().alias("seasonWeek"))


def q_default_color(spark, sf):
    return fixtures.teams(spark, sf).select("id", "school", default_color().alias("color"))


def q_default_logos(spark, sf):
    t = fixtures.teams(spark, sf)
    return t.select("id", "school", F.array_join(default_logos(), "|").alias("logos"),
                    F.size(default_logos()).alias("n_logos"))


def q_visual_rank(spark, sf):
    return visual_rank(_cleansed(spark, sf), EVERY_POLL).select(
        "season", "week", "poll", "seasonType", "school", "rank", "visualRank", "seasonWeek")


def q_tie_groups(spark, sf):
    return tie_groups(_cleansed(spark, sf), EVERY_POLL)


def q_week_groups(spark, sf):
    ranked = visual_rank(_cleansed(spark, sf), EVERY_POLL, keep_position=True)
    g = week_groups(ranked, also_by=("poll", "seasonType"))
    return g.select("week", "season", "poll", "seasonType", "seasonWeek",
                    F.size("ranks").alias("n_ranks"),
                    F.array_join(F.transform("ranks", lambda r: r["school"]), ",").alias("schools"))


def _weeks(spark, sf):
    return week_dimension(visual_rank(_slice(spark, sf)))


def q_week_index(spark, sf):
    return _weeks(spark, sf).select("season", "week", "seasonWeek", "weekIndex")


def q_season_changes(spark, sf):
    return season_changes(_weeks(spark, sf))


def q_current_week(spark, sf):
    return _weeks(spark, sf).select("season", "week", "weekIndex", "isCurrent")


def q_axis_bounds(spark, sf):
    return axis_bounds(_weeks(spark, sf))


def q_trajectories(spark, sf):
    return _logos_str(_traj(spark, sf))


def q_top_schools(spark, sf):
    ranked = visual_rank(_slice(spark, sf))
    rows = chart_rows(ranked, week_dimension(ranked))
    top = top_schools(rows)
    # twelve rows at most: numbering them needs no partition key
    pos = Window.orderBy(F.coalesce("rank", F.lit(0)), F.col("rank").asc_nulls_first(),
                         F.collate("school", "UNICODE"), "school")
    return top.withColumn("position", F.row_number().over(pos))


def q_top_flag(spark, sf):
    return _traj(spark, sf).select("school", "isTop").distinct()


def q_team_series(spark, sf):
    series = team_series(_traj(spark, sf))
    return series.select("school", F.col("color").alias("seriesColor"), "isTop",
                         F.posexplode("ranks").alias("pos", "p")).select(
        "school", "seriesColor", "isTop", "pos", "p.season", "p.week", "p.weekIndex",
        "p.seasonWeek", "p.rank", "p.visualRank")


def q_emphasis(spark, sf):
    return emphasis(_traj(spark, sf)).select(
        "school", "weekIndex", "stroke", "strokeWidth", "lineOpacity", "fill", "pointOpacity")


def q_plot_rank(spark, sf):
    return plot_rank(_traj(spark, sf)).select("school", "weekIndex", "plotRank", "drawable")


def q_point_labels(spark, sf):
    return _traj(spark, sf).select("school", "weekIndex", point_label().alias("label"),
                                   tooltip().alias("tooltip"))


def q_rank_delta(spark, sf):
    return rank_delta(_traj(spark, sf))


def q_movers(spark, sf):
    return movers(_traj(spark, sf))


def q_delta_label(spark, sf):
    rows = _traj(spark, sf)
    d = with_first_rank(rows, first_ranks(rows)).select(
        "school", "weekIndex",
        (F.coalesce(F.col("rank"), F.lit(0)) - F.col("firstRank")).cast("int").alias("delta"))
    return d.withColumn("deltaLabel", delta_label("delta"))


QUERIES: dict[str, Query] = {
    "trajectories": q_trajectories,
    "movers": q_movers,
    "build_cleansed": q_build_cleansed,
    "land_raw": q_land_raw,
    "read_rankings": q_read_rankings,
    "read_teams": q_read_teams,
    "list_snapshots": q_list_snapshots,
    "latest_raw_snapshot": q_latest_raw_snapshot,
    "latest_poll_season": q_latest_poll_season,
    "latest_poll_any": q_latest_poll_any,
    "decode_columnar": q_decode_columnar,
    "unwrap_envelope": q_unwrap_envelope,
    "encode_columnar": q_encode_columnar,
    "season_files": q_season_files,
    "available_seasons": q_available_seasons,
    "flatten_rankings": q_flatten_rankings,
    "filter_poll": q_filter_poll,
    "stamp_season": q_stamp_season,
    "season_week_label": q_season_week_label,
    "default_color": q_default_color,
    "default_logos": q_default_logos,
    "plot_rank": q_plot_rank,
    "emphasis": q_emphasis,
    "point_labels": q_point_labels,
    "merge_teams": q_merge_teams,
    "top_flag": q_top_flag,
    "rank_delta": q_rank_delta,
    "week_groups": q_week_groups,
    "tie_groups": q_tie_groups,
    "team_series": q_team_series,
    "axis_bounds": q_axis_bounds,
    "visual_rank": q_visual_rank,
    "week_index": q_week_index,
    "season_changes": q_season_changes,
    "current_week": q_current_week,
    "top_schools": q_top_schools,
    "sample_rows": q_sample_rows,
    "union_seasons": q_union_seasons,
    "latest_poll_rows": q_latest_poll_rows,
    "snapshot_key": q_snapshot_key,
    "delta_label": q_delta_label,
}


def q_build_cleansed_stream(spark, sf):
    """Landed raw snapshots processed by the streaming build (available-now
    trigger), then read back as the newest snapshot per season."""
    from rankflow.streaming.ingest import start_cleansed_stream

    raw = _land_rankings(spark, sf)
    out = shared_dir(spark, "cleansed_stream")
    query = start_cleansed_stream(spark, raw, out, shared_dir(spark, "stream_checkpoint"))
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return _logos_str(read_cleansed(spark, out).select(*CLEANSED_COLS))


QUERIES["build_cleansed_stream"] = q_build_cleansed_stream
QUERIES["bad_documents"] = q_bad_documents
QUERIES["latest_poll_columnar"] = q_latest_poll_columnar


# -- what goes on where something is broken, kept results, places, types -------

GONE_SEASON, TORN_SEASON, NEVER_SEASON = 1996, 1997, 1900


def _broken_store(spark, sf) -> str:
    """The cleansed store, with one season whose newest commit has no folder
    and one whose newest folder holds a file that is no Parquet."""
    out = _cleansed_store(spark, sf)
    late = "2025-01-01T00-00-00Z"
    base = spark.createDataFrame([(GONE_SEASON, 10), (TORN_SEASON, 20)], "season int, rows long")
    rows = base.withColumn("snapshot", F.lit(late)).withColumn("dataset", F.lit("cleansed"))
    folder = season_folder()
    torn = rows.where(F.col("season") == TORN_SEASON).select(folder.alias("f")).first().f
    spark.range(1).select(F.lit("half a file")).write.text(f"{out}/{torn}")
    commit(rows.withColumn("format", F.lit(PARQUET)).withColumn("folder", folder), out)
    return out


def _best_effort(spark, sf):
    out = _broken_store(spark, sf)
    years = fixtures.table(spark, sf, "orders", "o_orderdate timestamp_ntz").select(
        F.year("o_orderdate").alias("y")).distinct()
    seasons = sorted(r.y for r in years.collect() if r.y != fixtures.NULL_SEASON_YEAR)
    with warnings.catch_warnings():  # the skipped seasons are a result here
        warnings.simplefilter("ignore", SkippedSeasons)
        return best_effort_poll_table(spark, out, SLICE_POLL, SLICE_TYPE, [*seasons, NEVER_SEASON])


def q_union_best_effort(spark, sf):
    """The poll table of all seasons but the two that cannot be read."""
    return _logos_str(_best_effort(spark, sf).rows.select(*CLEANSED_COLS))


def q_skipped_seasons(spark, sf):
    """Which seasons a best-effort read left out, and why."""
    return _best_effort(spark, sf).skipped


def q_unwrap_skips(spark, sf):
    """Documents by shape and rows of data, counted in the pass that writes the
    rows. A document's shape goes by its week."""
    docs = nest_rankings(fixtures.poll_rows(spark, sf))
    rows = F.flatten(F.transform("polls", lambda p: p["ranks"]))
    data, turn = F.to_json(rows), F.pmod(F.coalesce("week", F.lit(4)), F.lit(5))
    envelope = lambda season: F.concat(
        F.lit('{"season": '), F.coalesce(season.cast("string"), F.lit("null")),
        F.lit(', "data": '), data, F.lit("}"))
    doc = (F.when(turn == 0, envelope(F.lit(2024))).when(turn == 1, data)
           .when(turn == 2, envelope(F.lit(0))).when(turn == 3, F.lit('{"season": 2024}'))
           .otherwise(F.lit("<html>")))
    seen = Observation()
    row = T.StructType([f for f in CLEANSED.fields if f.name in ("school", "rank", "points")])
    unwrap_envelope(docs.select(doc.alias("doc")), row, seen=seen).write.parquet(
        shared_dir(spark, "unwrapped"))
    counts = seen.get
    return spark.createDataFrame([(k, int(v)) for k, v in counts.items()], "what string, n long")


def q_season_list(spark, sf):
    """The seasons of a listing, and the default where listing them fails."""
    def broken():
        return available_seasons(list_files(spark, shared_dir(spark, "nothing")))

    found = season_list(spark, lambda: available_seasons(fixtures.listing(spark, sf)))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", SkippedSeasons)
        default = season_list(spark, broken, FALLBACK_SEASONS)
    return (found.withColumn("source", F.lit("listing"))
            .unionByName(default.withColumn("source", F.lit("default"))))


def q_memo_poll_table(spark, sf):
    """A kept result read again, after a commit that made an older one stale."""
    out = shared_dir(spark, "cleansed")
    rows = _cleansed(spark, sf)
    write_cleansed(rows.withColumn("points", F.col("points") - 1), out, OLD_STAMP)
    memoised_poll_table(spark, out, SLICE_POLL, SLICE_TYPE)
    write_cleansed(rows, out, NEW_STAMP)
    memoised_poll_table(spark, out, SLICE_POLL, SLICE_TYPE)
    again = memoised_poll_table(spark, out, SLICE_POLL, SLICE_TYPE)
    return _logos_str(again.select(*CLEANSED_COLS))


def q_concurrent_writes(spark, sf):
    """Two writers that began at one version: the first to commit is served,
    the other is refused."""
    out = shared_dir(spark, "cleansed")
    rows = _cleansed(spark, sf)
    base = head(spark, out)
    write_cleansed(rows, out, OLD_STAMP)
    late = rows.select("season").distinct().select(
        F.lit("cleansed").alias("dataset"), "season", F.lit(NEW_STAMP).alias("snapshot"),
        F.lit("lost").alias("folder"), F.lit(1).cast("long").alias("rows"),
        F.lit(PARQUET).alias("format"))
    try:
        commit(late, out, base)
    except CommitConflict:
        return _logos_str(read_cleansed(spark, out).select(*CLEANSED_COLS))
    raise AssertionError("the second writer was not refused")


def q_encode_in_place(spark, sf):
    """Rows in a stated order, encoded and decoded, with their positions."""
    order = [F.col(c).asc_nulls_first() for c in ("season", "week", "poll", "seasonType", "school")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _cleansed(spark, sf).repartitionByRange(n, *order).sortWithinPartitions(*order)
    docs = encode_columnar(rows, ["season"], block_rows=FIXTURE_BLOCK_ROWS, in_place=True)
    return _logos_str(decode_columnar(docs, CLEANSED, position="position")
                      .select(*CLEANSED_COLS, "position"))


def q_decode_json_types(spark, sf):
    """An undeclared column of mixed JSON types, by what it comes back as."""
    kind = F.pmod(F.coalesce("rank", F.lit(0)), F.lit(5))
    points = F.col("points").cast("string")
    mixed = (F.when(kind == 0, F.concat(F.lit('"'), points, F.lit('"'))).when(kind == 1, points)
             .when(kind == 2, F.concat(F.lit("["), points, F.lit(', null]')))
             .when(kind == 3, F.concat(F.lit('{"p": '), points, F.lit("}"))).otherwise("null"))
    rows = fixtures.poll_rows(spark, sf).select(
        "season", "week", "poll", "seasonType", F.struct(
            F.coalesce(F.to_json(F.struct("school")), F.lit("{}")).alias("k"),
            F.coalesce(F.concat(F.lit('"'), F.col("school"), F.lit('"')), F.lit("null")).alias("s"),
            mixed.alias("m")).alias("r"))
    by = ["season", "week", "poll", "seasonType"]  # a poll of a week is one document
    docs = rows.groupBy(*by).agg(F.array_sort(F.collect_list("r")).alias("r")).select(
        *by, F.concat(
            F.lit('{"columns": [{"name": "school", "values": ['),
            F.array_join(F.transform("r", lambda x: x["s"]), ","),
            F.lit(']}, {"name": "mixed", "values": ['),
            F.array_join(F.transform("r", lambda x: x["m"]), ","), F.lit("]}]}")).alias("doc"))
    school = T.StructType([T.StructField("school", T.StringType())])
    back = decode_columnar(docs, school, keep=by, undeclared="more", json_types=True)
    value = F.col("more")["mixed"]
    return back.select(*by, "school",
                       F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0).alias("kind"),
                       F.to_json(value).alias("value"))


def q_json_type_report(spark, sf):
    """Row objects whose fields came in another JSON type than the declared."""
    week = F.coalesce(F.col("week"), F.lit(0))
    fields = lambda *more: F.to_json(F.struct("school", *more))
    row = (F.when(week == 2, fields(F.col("rank").cast("string").alias("rank"), "points"))
           .when(week == 3, fields("rank", "points", F.lit(True).alias("extra")))
           .when(week == 4, fields("rank", (F.col("points") + 0.5).alias("points")))
           .otherwise(fields("rank", "points")))
    docs = fixtures.poll_rows(spark, sf).select("season", "week", "poll", "seasonType",
                                                row.alias("row")).groupBy(
        "season", "week", "poll", "seasonType").agg(F.array_join(F.collect_list("row"), ",").alias("r"))
    doc = F.when(F.col("week") == 5, F.lit("{}")).otherwise(F.concat(F.lit("["), "r", F.lit("]")))
    schema = T.StructType([f for f in CLEANSED.fields if f.name in ("school", "rank", "points")])
    return json_type_report(docs.select(doc.alias("doc")), schema)


def q_read_array(spark, sf):
    """All rankings as one array in one file, read by its pieces."""
    path = shared_dir(spark, "array")
    docs = nest_rankings(fixtures.poll_rows(spark, sf)).select(
        F.to_json(F.struct(*[f.name for f in SEASON.fields])).alias("v"))
    # documents are bounded by the calendar: a window without a key numbers them
    n = F.row_number().over(Window.orderBy("v")).alias("n")
    lines = docs.select(n, "v").select(
        "n", F.concat(F.when(F.col("n") == 1, F.lit("[")).otherwise(F.lit(",")), "v").alias("v"))
    end = spark.createDataFrame([(2**31 - 1, "]")], "n int, v string")
    (lines.unionByName(end).coalesce(1).sortWithinPartitions("n").select("v")
     .write.option("lineSep", "\n ").text(path))
    return flatten_rankings(read_rankings(spark, path, multi_line=True))


def q_merge_teams_salted(spark, sf):
    """The left join with a salt on every school that is hot at this size."""
    return _logos_str(merge_teams(fixtures.poll_rows(spark, sf), fixtures.teams(spark, sf),
                                  salted=True))


def q_visual_rank_by_range(spark, sf):
    """Visual ranks from range-partitioned positions instead of windows."""
    return visual_rank(_cleansed(spark, sf), EVERY_POLL, by_range=True).select(
        "season", "week", "poll", "seasonType", "school", "rank", "visualRank", "seasonWeek")


QUERIES |= {
    "union_best_effort": q_union_best_effort,
    "skipped_seasons": q_skipped_seasons,
    "unwrap_skips": q_unwrap_skips,
    "season_list": q_season_list,
    "memo_poll_table": q_memo_poll_table,
    "concurrent_writes": q_concurrent_writes,
    "encode_in_place": q_encode_in_place,
    "decode_json_types": q_decode_json_types,
    "json_type_report": q_json_type_report,
    "read_array": q_read_array,
    "merge_teams_salted": q_merge_teams_salted,
    "visual_rank_by_range": q_visual_rank_by_range,
}
