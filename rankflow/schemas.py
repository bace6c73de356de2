"""Declared schemas. Every JSON read uses one of these; nothing is inferred.

The field names are fixed values: they are the wire names of the documents.
"""

from pyspark.sql import types as T

RANK = T.StructType([
    T.StructField("school", T.StringType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("conference", T.StringType()),
    T.StructField("firstPlaceVotes", T.IntegerType()),
    T.StructField("points", T.IntegerType()),
])

POLL = T.StructType([
    T.StructField("poll", T.StringType()),
    T.StructField("ranks", T.ArrayType(RANK)),
])

SEASON = T.StructType([
    T.StructField("season", T.IntegerType()),
    T.StructField("seasonType", T.StringType()),
    T.StructField("week", T.IntegerType()),
    T.StructField("polls", T.ArrayType(POLL)),
])

TEAM = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("school", T.StringType()),
    T.StructField("mascot", T.StringType()),
    T.StructField("abbreviation", T.StringType()),
    T.StructField("alt_name1", T.StringType()),
    T.StructField("alt_name2", T.StringType()),
    T.StructField("alt_name3", T.StringType()),
    T.StructField("conference", T.StringType()),
    T.StructField("division", T.StringType()),
    T.StructField("classification", T.StringType()),
    T.StructField("color", T.StringType()),
    T.StructField("alt_color", T.StringType()),
    T.StructField("logos", T.ArrayType(T.StringType())),
])

HEADER_COLS = ["season", "seasonType", "week"]
FLAT_COLS = ["season", "seasonType", "week", "poll", "school", "rank",
             "conference", "firstPlaceVotes", "points"]
_FIELDS = {f.name: f for f in [*SEASON.fields, *POLL.fields, *RANK.fields]}
FLAT = T.StructType([_FIELDS[c] for c in FLAT_COLS])

# Left join on school: left columns first, then every team column except the
# key; a clashing name gets the "_right" suffix.
TEAM_RIGHT_COLS = [f.name if f.name != "conference" else "conference_right"
                   for f in TEAM.fields if f.name != "school"]
CLEANSED_COLS = FLAT_COLS + TEAM_RIGHT_COLS
CLEANSED = T.StructType(
    list(FLAT.fields)
    + [T.StructField("conference_right" if f.name == "conference" else f.name, f.dataType)
       for f in TEAM.fields if f.name != "school"]
)

LISTING = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("last_modified", T.TimestampNTZType()),
    T.StructField("size", T.LongType()),
])
