"""Per-season filtering, stamping and the union over seasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The slice the chart shows.
DEFAULT_POLL = "AP Top 25"
DEFAULT_SEASON_TYPE = "regular"


def filter_poll(df: DataFrame, poll: str = DEFAULT_POLL,
                season_type: str = DEFAULT_SEASON_TYPE) -> DataFrame:
    """Equality conjunction; pushed to the scan on Parquet."""
    return df.where((F.col("poll") == poll) & (F.col("seasonType") == season_type))


def stamp_season(df: DataFrame, season: int | Column) -> DataFrame:
    """Overwrite ``season`` with the season that was requested."""
    value = season if isinstance(season, Column) else F.lit(season)
    return df.withColumn("season", value.cast("int"))


def sample_rows(df: DataFrame, n: int = 3, order: list[str] | None = None) -> DataFrame:
    """First ``n`` rows in a stated order (TakeOrderedAndProject)."""
    order = order or ["season", "week", "rank", "school"]
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(n)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Bag union of per-season frames; missing columns become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Result-shape check: the loaded rows must carry the columns a later
    step reads. Schema-only (no job); raises with the missing names."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"loaded data lacks columns {missing}; has {df.columns}")
    return df


def schema_differences(actual: T.StructType, expected: T.StructType) -> list[tuple]:
    """(column, expected type, actual type) where they differ: a column that is
    missing has no actual type, one that nobody declared no expected type.
    Nullability and order do not count."""
    have = {f.name: f.dataType.simpleString() for f in actual.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    return [(c, want.get(c), have.get(c)) for c in [*want, *(c for c in have if c not in want)]
            if want.get(c) != have.get(c)]


def require_schema(df: DataFrame, expected: T.StructType, extra: bool = True) -> DataFrame:
    """Result-shape check with types: every expected column is there in its
    type (``extra`` columns may be there as well). Schema-only (no job)."""
    wrong = [d for d in schema_differences(df.schema, expected) if d[1] is not None or not extra]
    if wrong:
        raise TypeError("loaded data differs from the declared schema: " + "; ".join(
            f"{c} is {have or 'missing'}, not {want or 'declared'}" for c, want, have in wrong))
    return df


def json_type_report(docs: DataFrame, expected: T.StructType, doc: str = "doc") -> DataFrame:
    """column, expected, found, n: over all row objects of the documents (an
    array of them each), how often a declared column came in another JSON type
    than its own, and how often an undeclared one came at all. A missing or null
    value fits any column; a whole number fits a fractional one. What is no array
    of objects is reported under the column ``null``."""
    parsed = docs.select(F.try_parse_json(doc).alias("v"))
    kind = F.coalesce(F.schema_of_variant("v"), F.lit("no JSON"))
    rows = parsed.select(kind.alias("kind"), F.try_variant_get("v", "$", "array<variant>").alias("a"))
    odd = rows.where(F.col("a").isNull()).select(
        F.lit(None).cast("string").alias("column"), F.lit("ARRAY").alias("expected"),
        F.regexp_extract("kind", "^[A-Za-z ]+", 0).alias("found"))
    items = rows.select(F.explode("a").alias("r"))
    fields = items.select(
        F.try_variant_get("r", "$", "map<string,variant>").alias("m"),
        F.regexp_extract(F.schema_of_variant("r"), "^[A-Za-z]+", 0).alias("found"))
    no_object = fields.where(F.col("m").isNull()).select(
        F.lit(None).cast("string").alias("column"), F.lit("OBJECT").alias("expected"), "found")
    pairs = fields.select(F.explode("m").alias("column", "value")).select(
        "column", F.regexp_extract(F.schema_of_variant("value"), "^[A-Za-z]+", 0).alias("found"))
    declared = F.create_map(*[F.lit(x) for f in expected.fields for x in (f.name, _json_type(f.dataType))])
    typed = pairs.select("column", F.get(F.array(declared[F.col("column")]), F.lit(0)).alias("expected"),
                         "found")
    fits = ((F.col("found") == "VOID") | F.col("expected").eqNullSafe(F.col("found"))
            | (F.col("expected") == "DOUBLE") & F.col("found").isin("BIGINT", "DECIMAL"))
    wrong = typed.where(~fits)
    return (odd.unionByName(no_object).unionByName(wrong)
            .groupBy("column", "expected", "found").agg(F.count(F.lit(1)).alias("n")))


def _json_type(kind: T.DataType) -> str:
    if isinstance(kind, T.IntegralType):
        return "BIGINT"
    if isinstance(kind, (T.FractionalType,)):
        return "DOUBLE"
    if isinstance(kind, T.BooleanType):
        return "BOOLEAN"
    if isinstance(kind, T.ArrayType):
        return "ARRAY"
    return "OBJECT" if isinstance(kind, (T.StructType, T.MapType)) else "STRING"
