"""The same queries in plain SQL (DuckDB dialect) over the shared tables.

The fixture mapping is written once as CTEs; each query appends its SELECT.
"""

from __future__ import annotations

SLICE_POLL = "1-URGENT"
SLICE_TYPE = "regular"

_BASE = f"""
geo AS (
  SELECT n.n_nationkey, n.n_name AS school, r.r_name AS conference
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
agg AS (
  SELECT CAST(nullif(year(o.o_orderdate), 1998) AS INTEGER) AS season,
         CAST(nullif(month(o.o_orderdate), 12) AS INTEGER) AS week,
         o.o_orderpriority AS poll,
         CASE WHEN o.o_orderstatus = 'P' THEN 'postseason' ELSE 'regular' END AS seasonType,
         CASE WHEN g.n_nationkey <> 23 THEN g.school END AS school, g.conference,
         CAST(count(*) AS INTEGER) AS points,
         CAST(count(CASE WHEN o.o_totalprice > 200000 THEN 1 END) AS INTEGER) AS firstPlaceVotes
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN geo g ON c.c_nationkey = g.n_nationkey
  GROUP BY 1, 2, 3, 4, 5, 6
),
poll_rows AS (
  SELECT season, seasonType, week, poll, school,
         CAST(rank() OVER (PARTITION BY season, week, poll, seasonType
                           ORDER BY points DESC) AS INTEGER) AS rank,
         conference, firstPlaceVotes, points
  FROM agg
),
teams AS (
  SELECT CAST(n_nationkey AS INTEGER) AS id,
         school || CASE WHEN n_nationkey = 24 THEN ' (renamed)' ELSE '' END AS school,
         'Mascot ' || CAST(n_nationkey AS VARCHAR) AS mascot,
         'N' || CAST(n_nationkey AS VARCHAR) AS abbreviation,
         lower(school) AS alt_name1,
         CAST(NULL AS VARCHAR) AS alt_name2, CAST(NULL AS VARCHAR) AS alt_name3,
         conference,
         CASE WHEN n_nationkey % 2 = 0 THEN 'East' ELSE 'West' END AS division,
         'fbs' AS classification,
         CASE WHEN n_nationkey % 5 = 0 THEN NULL WHEN n_nationkey % 5 = 1 THEN ''
              ELSE '#' || lpad(CAST(n_nationkey * 7 AS VARCHAR), 3, '0') END AS color,
         '#ffffff' AS alt_color,
         CASE WHEN n_nationkey % 3 = 0 THEN NULL
              WHEN n_nationkey % 3 = 1 THEN ['logos/' || CAST(n_nationkey AS VARCHAR) || '.png']
              ELSE ['logos/' || CAST(n_nationkey AS VARCHAR) || '.png',
                    'logos/' || CAST(n_nationkey AS VARCHAR) || '-dark.png'] END AS logos
  FROM geo
),
cleansed AS (
  SELECT p.season, p.seasonType, p.week, p.poll, p.school, p.rank, p.conference,
         p.firstPlaceVotes, p.points, t.id, t.mascot, t.abbreviation, t.alt_name1,
         t.alt_name2, t.alt_name3, t.conference AS conference_right, t.division,
         t.classification, t.color, t.alt_color, t.logos
  FROM poll_rows p LEFT JOIN teams t ON p.school = t.school
),
slice AS (
  SELECT * FROM cleansed WHERE poll = '{SLICE_POLL}' AND seasonType = '{SLICE_TYPE}'
),
vr_all AS (
  SELECT *,
    CAST(CASE WHEN week = 1 THEN
      coalesce(rank, 0) + CAST(0.1 AS DOUBLE) * (
        CAST(row_number() OVER (PARTITION BY season, week, poll, seasonType, rank
                                ORDER BY school NULLS FIRST) - 1 AS DOUBLE)
        - CAST(count(*) OVER (PARTITION BY season, week, poll, seasonType, rank) - 1 AS DOUBLE) / 2)
    ELSE CAST(row_number() OVER (PARTITION BY season, week, poll, seasonType
              ORDER BY coalesce(rank, 0), rank NULLS FIRST, school NULLS FIRST) AS DOUBLE) END AS DOUBLE)
      AS visualRank,
    coalesce(CAST(season AS VARCHAR), 'null') || '/' || coalesce(CAST(week AS VARCHAR), 'null') AS seasonWeek
  FROM cleansed
),
vr AS (
  SELECT * FROM vr_all WHERE poll = '{SLICE_POLL}' AND seasonType = '{SLICE_TYPE}'
),
weeks0 AS (
  SELECT season, week,
         CAST(row_number() OVER (ORDER BY season NULLS FIRST, week NULLS FIRST) - 1 AS INTEGER) AS weekIndex,
         lag(season) OVER (ORDER BY season NULLS FIRST, week NULLS FIRST) AS prev_season,
         max(visualRank) AS wmax
  FROM vr GROUP BY season, week
),
weeks AS (
  SELECT season, week, coalesce(CAST(season AS VARCHAR), 'null') || '/' || coalesce(CAST(week AS VARCHAR), 'null') AS seasonWeek,
         weekIndex,
         weekIndex = max(weekIndex) OVER () AS isCurrent,
         (prev_season IS NOT NULL AND season <> prev_season) AS seasonChange,
         CASE WHEN prev_season IS NOT NULL AND season <> prev_season
              THEN CAST(weekIndex AS DOUBLE) - 0.5 END AS boundary,
         max(weekIndex) OVER () AS maxWeekIndex,
         coalesce(nullif(max(wmax) OVER (), 0), 25.0) AS yMax
  FROM weeks0
),
chart AS (
  SELECT v.season, v.week, v.seasonWeek, w.weekIndex, v.rank, v.visualRank, v.school,
         coalesce(nullif(v.color, ''), '#ccc') AS color,
         coalesce(v.logos, CAST([] AS VARCHAR[])) AS logos,
         w.isCurrent, w.yMax
  FROM vr v JOIN weeks w ON v.season IS NOT DISTINCT FROM w.season
    AND v.week IS NOT DISTINCT FROM w.week
),
top AS (
  SELECT school, rank, visualRank,
         row_number() OVER (ORDER BY coalesce(rank, 0), rank NULLS FIRST, school NULLS FIRST) AS position
  FROM chart WHERE isCurrent
  QUALIFY position <= 12
),
traj AS (
  SELECT c.*, EXISTS (SELECT 1 FROM top WHERE top.school IS NOT DISTINCT FROM c.school) AS isTop FROM chart c
),
firsts AS (
  SELECT school, arg_min(coalesce(rank, 0), (weekIndex, coalesce(rank, 0))) AS firstRank
  FROM traj GROUP BY school
),
deltas AS (
  SELECT t.school, t.visualRank, t.rank, f.firstRank,
         CAST(coalesce(t.rank, 0) - f.firstRank AS INTEGER) AS delta
  FROM traj t JOIN firsts f ON t.school IS NOT DISTINCT FROM f.school WHERE t.isCurrent
),
listing AS (
  SELECT 'cleansed/' || CAST(2020 + user_id % 5 AS VARCHAR) || '/poll_' || CAST(event_id AS VARCHAR)
         || CASE WHEN event_type = 'error' THEN '.csv' ELSE '.json' END AS key,
         CAST(ts AS TIMESTAMP) AS last_modified,
         CAST(event_id % 1000 AS BIGINT) AS size,
         CAST(2020 + user_id % 5 AS INTEGER) AS season
  FROM events
)
"""

_ISO = ("CASE WHEN {t} IS NULL THEN NULL ELSE strftime({t}, '%Y-%m-%dT%H:%M:%S') || "
        "CASE WHEN microsecond({t}) % 1000000 = 0 THEN '' "
        "ELSE '.' || lpad(CAST(microsecond({t}) % 1000000 AS VARCHAR), 6, '0') END || '+00:00' END")


def iso(t: str) -> str:
    return _ISO.format(t=t)


_DELTA_LABEL = ("CAST(abs(delta) AS VARCHAR) || ' ' || CASE WHEN delta > 0 THEN '🔽' "
                "WHEN delta < 0 THEN '🔼' ELSE '➖' END")
_DELTA_TITLE = ("CASE WHEN delta = 0 THEN coalesce(school, 'null') || ' held steady since entering "
                "the AP Top 25 poll' ELSE coalesce(school, 'null') || CASE WHEN delta < 0 THEN ' rose ' "
                "ELSE ' fell ' END || CAST(abs(delta) AS VARCHAR) || ' place' || CASE WHEN abs(delta) = 1 "
                "THEN '' ELSE 's' END || ' since entering the AP Top 25 poll' END")

_CLEANSED_SELECT = ("season, seasonType, week, poll, school, rank, conference, firstPlaceVotes, "
                    "points, id, mascot, abbreviation, alt_name1, alt_name2, alt_name3, "
                    "conference_right, division, classification, color, alt_color, "
                    "array_to_string(logos, '|') AS logos")
_FLAT_SELECT = "season, seasonType, week, poll, school, rank, conference, firstPlaceVotes, points"

# each season's stamp goes by its turn, see queries._cleansed_store
_NEWEST = ("(SELECT season FROM cleansed WHERE season IS NOT NULL GROUP BY season "
           "ORDER BY ((season - 1995) * 3 % 7 + 7) % 7 DESC, season LIMIT 1)")

_SELECTS = {
    "flatten_rankings": f"SELECT {_FLAT_SELECT} FROM poll_rows",
    "read_rankings": f"SELECT {_FLAT_SELECT} FROM poll_rows",
    "read_teams": ("SELECT id, school, mascot, abbreviation, alt_name1, alt_name2, alt_name3, "
                   "conference, division, classification, color, alt_color, "
                   "array_to_string(logos, '|') AS logos FROM teams"),
    "merge_teams": f"SELECT {_CLEANSED_SELECT} FROM cleansed",
    "build_cleansed": f"SELECT {_CLEANSED_SELECT} FROM cleansed",
    "build_cleansed_stream": f"SELECT {_CLEANSED_SELECT} FROM cleansed",
    "union_seasons": f"SELECT {_CLEANSED_SELECT} FROM slice",
    "latest_poll_rows": f"SELECT {_CLEANSED_SELECT} FROM cleansed WHERE season = {_NEWEST}",
    "latest_poll_columnar": f"SELECT {_CLEANSED_SELECT} FROM cleansed WHERE season = {_NEWEST}",
    "land_raw": ("SELECT season, seasonType, week, CAST(count(DISTINCT poll) AS INTEGER) AS n_polls, "
                 "CAST(count(*) AS INTEGER) AS n_ranks FROM poll_rows GROUP BY 1, 2, 3"),
    "list_snapshots": (
        "SELECT 'rankings' AS dataset, season, snapshot, true AS hasSize, true AS hasTime "
        "FROM (SELECT DISTINCT season FROM poll_rows) "
        "CROSS JOIN (VALUES ('2024-09-02T12-00-00Z'), ('2024-09-09T12-00-00Z')) v(snapshot) "
        "UNION ALL SELECT DISTINCT 'rankings', season, '2024-09-16T12-00-00Z', true, true "
        "FROM poll_rows WHERE week = 1 "
        "UNION ALL SELECT DISTINCT 'rankings', 1900, '2024-09-02T12-00-00Z', true, true "
        "FROM poll_rows WHERE season = 1995 "
        "UNION ALL SELECT 'teams', NULL, snapshot, true, true "
        "FROM (VALUES ('2024-09-02T12-00-00Z'), ('2024-09-09T12-00-00Z')) v(snapshot)"),
    "bad_documents": (
        "SELECT reason, season, count(*) AS n FROM (SELECT "
        "CASE week WHEN 2 THEN 'truncated' WHEN 3 THEN 'not JSON' ELSE 'kept' END AS reason, "
        "CASE WHEN week IN (2, 3) THEN NULL ELSE season END AS season "
        "FROM (SELECT DISTINCT season, seasonType, week FROM poll_rows)) GROUP BY 1, 2"),
    "encode_columnar": f"SELECT {_CLEANSED_SELECT} FROM cleansed",
    "decode_columnar": f"SELECT {_CLEANSED_SELECT} FROM cleansed",
    "unwrap_envelope": f"SELECT {_CLEANSED_SELECT} FROM cleansed",
    "filter_poll": (f"SELECT {_FLAT_SELECT} FROM poll_rows "
                    f"WHERE poll = '{SLICE_POLL}' AND seasonType = '{SLICE_TYPE}'"),
    "stamp_season": (f"SELECT {_FLAT_SELECT} FROM poll_rows "
                     f"WHERE poll = '{SLICE_POLL}' AND seasonType = '{SLICE_TYPE}'"),
    "season_week_label": ("SELECT season, week, poll, seasonType, school, "
                          "coalesce(CAST(season AS VARCHAR), 'null') || '/' || coalesce(CAST(week AS VARCHAR), 'null') AS seasonWeek "
                          "FROM poll_rows"),
    "default_color": "SELECT id, school, coalesce(nullif(color, ''), '#ccc') AS color FROM teams",
    "default_logos": ("SELECT id, school, "
                      "array_to_string(coalesce(logos, CAST([] AS VARCHAR[])), '|') AS logos, "
                      "CAST(len(coalesce(logos, CAST([] AS VARCHAR[]))) AS INTEGER) AS n_logos "
                      "FROM teams"),
    "visual_rank": ("SELECT season, week, poll, seasonType, school, rank, visualRank, seasonWeek "
                    "FROM vr_all"),
    "tie_groups": ("SELECT season, week, poll, seasonType, rank, "
                   "CAST(count(*) AS INTEGER) AS tieSize, count(*) > 1 AS isTie FROM cleansed "
                   "GROUP BY season, week, poll, seasonType, rank"),
    "week_groups": ("SELECT CAST(week AS VARCHAR) AS week, season, poll, seasonType, "
                    "coalesce(CAST(season AS VARCHAR), 'null') || '/' || coalesce(CAST(week AS VARCHAR), 'null') AS seasonWeek, "
                    "CAST(count(*) AS INTEGER) AS n_ranks, "
                    "coalesce(string_agg(school, ',' ORDER BY coalesce(rank, 0), rank NULLS FIRST, "
                    "school NULLS FIRST), '') AS schools FROM cleansed GROUP BY season, week, poll, seasonType"),
    "week_index": "SELECT season, week, seasonWeek, weekIndex FROM weeks",
    "season_changes": ("SELECT weekIndex, season, seasonWeek, boundary FROM weeks "
                       "WHERE seasonChange"),
    "current_week": "SELECT season, week, weekIndex, isCurrent FROM weeks",
    "axis_bounds": ("SELECT CAST(coalesce(max(weekIndex), 0) AS INTEGER) AS maxWeekIndex, "
                    "coalesce(max(yMax), 25.0) AS yMax, CAST(0.5 AS DOUBLE) AS yDomainLow, "
                    "coalesce(max(yMax), 25.0) + 0.5 AS yDomainHigh FROM weeks"),
    "trajectories": ("SELECT season, week, seasonWeek, weekIndex, rank, visualRank, school, color, "
                     "array_to_string(logos, '|') AS logos, isCurrent, yMax, isTop FROM traj"),
    "top_schools": "SELECT school, rank, visualRank, CAST(position AS INTEGER) AS position FROM top",
    "top_flag": "SELECT DISTINCT school, isTop FROM traj",
    "team_series": (
        "SELECT school, first_value(color) OVER (PARTITION BY school ORDER BY week NULLS FIRST, weekIndex) "
        "AS seriesColor, isTop, "
        "CAST(row_number() OVER (PARTITION BY school ORDER BY week NULLS FIRST, weekIndex) - 1 AS INTEGER) AS pos, "
        "season, week, weekIndex, seasonWeek, rank, visualRank FROM traj"),
    "emphasis": ("SELECT school, weekIndex, "
                 "CASE WHEN isTop THEN color ELSE '#444' END AS stroke, "
                 "CAST(CASE WHEN isTop THEN 2 ELSE 1 END AS INTEGER) AS strokeWidth, "
                 "CAST(CASE WHEN isTop THEN 0.7 ELSE 0.3 END AS DOUBLE) AS lineOpacity, "
                 "CASE WHEN isTop THEN color ELSE '#444' END AS fill, "
                 "CAST(CASE WHEN isTop THEN 0.95 ELSE 0.3 END AS DOUBLE) AS pointOpacity FROM traj"),
    "plot_rank": ("SELECT school, weekIndex, coalesce(visualRank, yMax) AS plotRank, "
                  "visualRank IS NOT NULL AS drawable FROM traj"),
    "point_labels": ("SELECT school, weekIndex, coalesce(CAST(rank AS VARCHAR), '') AS label, "
                     "coalesce(school, 'null') || ': Rank ' || coalesce(CAST(rank AS VARCHAR), 'null') "
                     "|| ' (' || coalesce(seasonWeek, 'null') || ')' AS tooltip FROM traj"),
    "rank_delta": "SELECT school, visualRank, rank, firstRank, delta FROM deltas",
    "movers": (f"SELECT school, visualRank, rank, firstRank, delta, {_DELTA_LABEL} AS deltaLabel, "
               f"{_DELTA_TITLE} AS deltaTitle FROM deltas"),
    "delta_label": (
        "SELECT school, weekIndex, delta, " + _DELTA_LABEL + " AS deltaLabel FROM ("
        "SELECT t.school, t.weekIndex, CAST(coalesce(t.rank, 0) - f.firstRank AS INTEGER) AS delta "
        "FROM traj t JOIN firsts f ON t.school IS NOT DISTINCT FROM f.school)"),
    "sample_rows": (f"SELECT {_FLAT_SELECT} FROM poll_rows "
                    f"WHERE poll = '{SLICE_POLL}' AND seasonType = '{SLICE_TYPE}' "
                    "ORDER BY season NULLS FIRST, week NULLS FIRST, rank NULLS FIRST, "
                    "school NULLS FIRST LIMIT 3"),
    "snapshot_key": ("SELECT event_id, CAST(2020 + user_id % 5 AS VARCHAR) || '/raw/rankings_' || "
                     "strftime(ts, '%Y-%m-%dT%H-%M-%SZ') || '.json' AS key FROM events"),
    "latest_raw_snapshot": (
        f"SELECT season, key, {iso('last_modified')} AS lastModified, size FROM listing "
        "QUALIFY row_number() OVER (PARTITION BY season ORDER BY last_modified DESC, key) = 1"),
    "latest_poll_season": (
        f"SELECT season, key, {iso('last_modified')} AS lastModified, size FROM listing "
        "WHERE key LIKE '%poll\\_%' ESCAPE '\\' AND key LIKE '%.json' "
        "QUALIFY row_number() OVER (PARTITION BY season ORDER BY last_modified DESC, key) = 1"),
    "latest_poll_any": (
        f"SELECT key, {iso('last_modified')} AS lastModified, size FROM listing "
        "WHERE key LIKE '%poll\\_%' ESCAPE '\\' AND key LIKE '%.json' "
        "ORDER BY last_modified DESC, key LIMIT 1"),
    "season_files": (f"SELECT season, key, {iso('last_modified')} AS lastModified, size "
                     "FROM listing WHERE key LIKE '%.json'"),
    "available_seasons": "SELECT DISTINCT season FROM listing",
    "union_best_effort": f"SELECT {_CLEANSED_SELECT} FROM slice WHERE season NOT IN (1996, 1997)",
    "skipped_seasons": (
        "SELECT 1996 AS season, '2025-01-01T00-00-00Z' AS snapshot, 'folder is missing' AS reason "
        "UNION ALL SELECT 1997, '2025-01-01T00-00-00Z', '0 of 20 rows are readable' "
        "UNION ALL SELECT 1900, NULL, 'no snapshot' "
        # asked for by the years of the orders, so a season may lack rows and commits
        "UNION ALL SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER), NULL, 'no snapshot' "
        "FROM orders WHERE year(o_orderdate) NOT IN (1996, 1997, 1998) "
        "AND year(o_orderdate) NOT IN (SELECT season FROM cleansed WHERE season IS NOT NULL)"),
    "unwrap_skips": (
        "SELECT * FROM (WITH d AS (SELECT season, seasonType, week, coalesce(week, 4) % 5 AS turn, count(*) AS n "
        "FROM poll_rows GROUP BY 1, 2, 3) "
        "SELECT 'documents' AS what, count(*) AS n FROM d "
        "UNION ALL SELECT 'envelope', count(*) FROM d WHERE turn = 0 "
        "UNION ALL SELECT 'rows', count(*) FROM d WHERE turn = 1 "
        "UNION ALL SELECT 'odd', count(*) FROM d WHERE turn > 1 "
        "UNION ALL SELECT 'data_rows', CAST(coalesce(sum(n), 0) AS BIGINT) FROM d WHERE turn < 2)"),
    "season_list": ("SELECT DISTINCT season, 'listing' AS source FROM listing "
                    "UNION ALL SELECT 2024, 'default'"),
    "memo_poll_table": f"SELECT {_CLEANSED_SELECT} FROM slice",
    "concurrent_writes": f"SELECT {_CLEANSED_SELECT} FROM cleansed",
    "encode_in_place": (
        f"SELECT {_CLEANSED_SELECT}, row_number() OVER (PARTITION BY season ORDER BY "
        "week NULLS FIRST, poll NULLS FIRST, seasonType NULLS FIRST, school NULLS FIRST) - 1 "
        "AS position FROM cleansed"),
    "decode_json_types": (
        "SELECT season, week, poll, seasonType, school, "
        "CASE coalesce(rank, 0) % 5 WHEN 0 THEN 'STRING' WHEN 1 THEN 'BIGINT' WHEN 2 THEN 'ARRAY' "
        "WHEN 3 THEN 'OBJECT' ELSE 'VOID' END AS kind, "
        "CASE coalesce(rank, 0) % 5 WHEN 0 THEN '\"' || points || '\"' "
        "WHEN 1 THEN CAST(points AS VARCHAR) WHEN 2 THEN '[' || points || ',null]' "
        "WHEN 3 THEN '{\"p\":' || points || '}' ELSE 'null' END AS value FROM poll_rows"),
    "json_type_report": (
        "SELECT * FROM (WITH r AS (SELECT *, coalesce(week, 0) AS w FROM poll_rows) "
        "SELECT * FROM (SELECT 'rank' AS column, 'BIGINT' AS expected, 'STRING' AS found, "
        "count(rank) AS n FROM r WHERE w = 2 "
        "UNION ALL SELECT 'extra', NULL, 'BOOLEAN', count(*) FROM r WHERE w = 3 "
        "UNION ALL SELECT 'points', 'BIGINT', 'DECIMAL', count(points) FROM r WHERE w = 4 "
        "UNION ALL SELECT NULL, 'ARRAY', 'OBJECT', count(*) FROM "
        "(SELECT DISTINCT season, poll, seasonType FROM r WHERE w = 5)) WHERE n > 0)"),
    "read_array": f"SELECT {_FLAT_SELECT} FROM poll_rows",
    "merge_teams_salted": f"SELECT {_CLEANSED_SELECT} FROM cleansed",
    "visual_rank_by_range": ("SELECT season, week, poll, seasonType, school, rank, visualRank, "
                             "seasonWeek FROM vr_all"),
}


def oracle_sql() -> dict[str, str]:
    return {name: f"WITH {_BASE}\n{select}" for name, select in _SELECTS.items()}
