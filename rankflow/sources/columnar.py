"""Column-oriented JSON documents: ``{"columns": [{"name", "values"}]}``.

Encoding keeps every document bounded: rows are spread over
``ceil(rows_in_group / block_rows)`` blocks (see :func:`_blocks`), so a season
of any size becomes many documents (one per line) instead of one object that
would pass whole through one task. Decoding is narrow (no shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.operators.numbering import with_group_positions

DEFAULT_BLOCK_ROWS = 50_000


def _doc_type(value: T.DataType) -> T.StructType:
    column = T.StructType([T.StructField("name", T.StringType()),
                           T.StructField("values", T.ArrayType(value))])
    return T.StructType([T.StructField("columns", T.ArrayType(column)),
                         T.StructField("first", T.LongType())])


_DOC_T, _VARIANT_DOC_T = _doc_type(T.StringType()), _doc_type(T.VariantType())


def _field(name: str):
    return lambda r: r[name]


def _blocks(df: DataFrame, gcols: list[str], order: list[str], block_rows: int) -> DataFrame:
    """Rows of ``df`` grouped into bounded blocks: one row per (group, block)
    with ``_r``, the block's rows as structs (``_o*`` order fields, then
    ``_c*`` values) sorted by the order fields.

    Deterministic and skew-proof: identical rows are first collapsed into
    (row, copies) by a partial + final aggregate, a large copy group is cut
    into pieces of at most ``block_rows`` copies, and each piece goes to the
    block ``xxhash64(row, piece) mod blocks_of_group`` with
    ``blocks_of_group = ceil(rows / block_rows)``. Re-running a task gives
    the same assignment, and no block holds a whole hot group.
    """
    cols = df.columns
    distinct = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_m"))
    gkey = F.struct(*[F.col(c) for c in gcols]).alias("_g")  # struct keys match nulls too
    counts = distinct.groupBy(gkey).agg(F.sum("_m").alias("_n")).select(
        "_g", F.greatest(F.lit(1), F.ceil(F.col("_n") / block_rows)).cast("long").alias("_nb"))
    last_piece = F.floor((F.col("_m") - 1) / block_rows).cast("long")
    pieces = (distinct.withColumn("_j", F.explode(F.sequence(F.lit(0).cast("long"), last_piece)))
              .withColumn("_mj", F.least(F.lit(block_rows).cast("long"),
                                         F.col("_m") - F.col("_j") * block_rows).cast("int"))
              .withColumn("_g", gkey))
    # one row per group, known only at run time: AQE broadcasts it when small
    keyed = pieces.join(counts, on="_g", how="inner")
    keyed = keyed.withColumn(
        "_block", F.pmod(F.xxhash64(*[F.col(c) for c in cols], F.col("_j")), F.col("_nb")))
    piece = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                     *[F.col(c).alias(f"_c{i}") for i, c in enumerate(cols)], F.col("_mj"))
    grouped = keyed.groupBy(*[F.col(c) for c in gcols], "_block").agg(
        F.array_sort(F.collect_list(piece)).alias("_p"))
    expand = F.flatten(F.transform("_p", lambda p: F.array_repeat(p.dropFields("_mj"), p["_mj"])))
    return grouped.select(*gcols, "_block", expand.alias("_r"))


def encode_columnar(df: DataFrame, group_cols: Sequence[str] = ("season",),
                    order_cols: Sequence[str] | None = None,
                    block_rows: int = DEFAULT_BLOCK_ROWS, in_place: bool = False) -> DataFrame:
    """One row per (group, block): ``doc`` (columnar JSON), ``n_rows``.

    Inside a document rows are ordered by ``order_cols`` (all columns by
    default), so a round trip is reproducible. Nulls are kept: structs are
    collected, not bare values (``collect_list`` drops null values).

    With ``in_place`` the rows keep the order that they come in: block ``b`` of
    a group holds its rows from ``b * block_rows`` on, in order, and says so in
    its ``first`` key, from which :func:`decode_columnar` gives every row its
    position back. A group, hot or full of copies, is numbered by partitions
    (:mod:`rankflow.operators.numbering`) and never passes through one task.
    """
    gcols = list(group_cols)
    cols = df.columns
    if in_place:
        return _in_place(df, gcols, block_rows)
    blocks = _blocks(df, gcols, list(order_cols) if order_cols else cols, block_rows)
    doc = F.concat(F.lit("{"), _columns_json(cols))
    return blocks.select(*gcols, F.col("_block").alias("block"),
                         F.size("_r").alias("n_rows"), doc.alias("doc"))


def _columns_json(cols: Sequence[str]) -> Column:
    """The text of ``"columns": [...]`` of the rows ``_r``."""
    parts = [F.to_json(F.struct(F.lit(c).alias("name"),
                                F.transform("_r", _field(f"_c{i}")).alias("values")))
             for i, c in enumerate(cols)]
    return F.concat(F.lit('"columns":['), F.concat_ws(",", *parts), F.lit("]}"))


def _in_place(df: DataFrame, gcols: list[str], block_rows: int) -> DataFrame:
    cols = df.columns
    placed = with_group_positions(df, gcols, "_at")
    row = F.struct(F.col("_at"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(cols)])
    blocks = (placed.groupBy(*gcols, F.floor(F.col("_at") / block_rows).cast("long").alias("_block"))
              .agg(F.array_sort(F.collect_list(row)).alias("_r")))
    doc = F.concat(F.lit('{"first":'), (F.col("_block") * block_rows).cast("string"), F.lit(","),
                   _columns_json(cols))
    return blocks.select(*gcols, F.col("_block").alias("block"), F.size("_r").alias("n_rows"),
                         doc.alias("doc"))


def columnar_shape(text: Column) -> Column:
    """Whether a document is a columnar one."""
    return F.coalesce(F.from_json(text, _DOC_T)["columns"].isNotNull(), F.lit(False))


def _named(name: str):
    return lambda c: c["name"] == name


def _variant_text(v: Column) -> Column:
    """What reading the value as text gives: a string itself, other values as
    their JSON; null stays null."""
    plain = F.schema_of_variant(v) == "STRING"
    return F.when(plain, F.try_variant_get(v, "$", "string")).when(
        ~F.is_variant_null(v), F.to_json(v))


def _typed(values: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.StringType):
        return values
    if isinstance(dt, (T.ArrayType, T.StructType, T.MapType)):
        return F.transform(values, lambda v: F.from_json(v, dt))
    # try_cast: a malformed value becomes null instead of failing the job (ANSI)
    if isinstance(dt, T.IntegralType):
        def whole(v: Column) -> Column:  # JSON writes the number 5 as 5.0 as well
            number = v.try_cast("decimal(38,18)")
            return F.coalesce(v.try_cast(dt), F.when(number == F.floor(number),
                                                     F.floor(number).try_cast(dt)))
        return F.transform(values, whole)
    return F.transform(values, lambda v: v.try_cast(dt))


def decode_columnar(docs: DataFrame, schema: T.StructType, doc: str = "doc",
                    keep: Sequence[str] = (), undeclared: str | None = None,
                    json_types: bool = False, position: str | None = None) -> DataFrame:
    """Rows of columnar documents. Row count of a document is its longest
    column; shorter or missing columns are padded with null; a name given
    twice keeps the last. With ``undeclared`` (a column name) the columns that
    the schema lacks are kept, as a map of name to text, or with ``json_types``
    to VARIANT: strings, numbers, arrays, objects and null as the document has
    them. With ``position`` (a column name) each row's position in its group is
    given, for documents that were encoded ``in_place`` (null for others).
    Documents without ``columns`` yield no rows (see :func:`decode_snapshot`
    for the others)."""
    read = F.from_json(F.col(doc), _VARIANT_DOC_T if undeclared and json_types else _DOC_T)
    parsed = docs.select(*keep, read["columns"].alias("_cols"), read["first"].alias("_first"))
    arrays = []
    for f in schema.fields:
        hit = F.try_element_at(F.filter("_cols", _named(f.name)), F.lit(-1))
        vals = hit["values"]
        if undeclared and json_types:
            vals = F.transform(vals, _variant_text)
        vals = F.coalesce(vals, F.array().cast("array<string>"))
        arrays.append(_typed(vals, f.dataType).alias(f.name))
    if undeclared:
        names = [f.name for f in schema.fields]
        kind = "variant" if json_types else "string"
        other = F.filter("_cols", lambda c: ~c["name"].isin(names))
        longest = F.array_max(F.transform("_cols", lambda c: F.size(c["values"])))
        last = lambda i: F.aggregate(  # noqa: E731  a name given twice keeps the last
            other, F.create_map().cast(f"map<string,{kind}>"),
            lambda m, c: F.map_concat(F.map_filter(m, lambda k, _: k != c["name"]),
                                      F.create_map(c["name"], F.get(c["values"], i))))
        extra = F.when(longest > 0, F.transform(
            F.sequence(F.lit(0), F.greatest(longest - 1, F.lit(0))), last)).otherwise(
            F.array().cast(f"array<map<string,{kind}>>"))
        arrays.append(extra.alias(undeclared))
    zipped = F.arrays_zip(*arrays)
    found = parsed.where(F.col("_cols").isNotNull())
    if position is None:
        return found.select(*keep, F.inline(zipped))
    names = [f.name for f in schema.fields] + ([undeclared] if undeclared else [])
    rows = found.select(*keep, "_first", F.posexplode(zipped).alias("_i", "_row"))
    return rows.select(*keep, *[F.col("_row")[c].alias(c) for c in names],
                       (F.col("_first") + F.col("_i")).alias(position))


def decode_snapshot(docs: DataFrame, schema: T.StructType, doc: str = "doc",
                    keep: Sequence[str] = (), on_bad: str = "raise") -> DataFrame:
    """Dispatch on shape: columnar documents are decoded; an array of row
    objects, bare or in an envelope's ``data``, is passed through. Anything
    else fails the job with the start of the document (``on_bad="raise"``) or
    is left out (``"skip"``)."""
    if on_bad not in ("raise", "skip"):
        raise ValueError("on_bad must be 'raise' or 'skip'")
    text = F.trim(F.col(doc))
    rows_t = T.ArrayType(schema)
    is_col = text.startswith("{") & F.get_json_object(text, "$.columns").isNotNull()
    columnar = decode_columnar(docs.where(is_col), schema, doc, keep)
    bare = F.from_json(F.when(text.startswith("["), text), rows_t)
    inner = F.from_json(F.when(text.startswith("{"), F.get_json_object(text, "$.data")), rows_t)
    found = F.coalesce(bare, inner)
    if on_bad == "raise":
        message = F.concat(F.lit("neither columns nor rows in document: "),
                           F.substring(F.coalesce(text, F.lit("null")), 1, 80))
        found = F.coalesce(found, F.raise_error(message).cast(rows_t))
    rows = docs.where(~F.coalesce(is_col, F.lit(False))).select(*keep, F.inline(found))
    return columnar.unionByName(rows)


def encode_rows(df: DataFrame, group_cols: Sequence[str] = ("season",),
                order_cols: Sequence[str] | None = None,
                block_rows: int = DEFAULT_BLOCK_ROWS, envelope: bool = False) -> DataFrame:
    """Row-oriented documents (a JSON array of row objects), or
    ``{"season": s, "data": [...]}`` envelopes, in the same bounded blocks as
    :func:`encode_columnar`. Null fields are written as ``null``."""
    gcols = list(group_cols)
    cols = df.columns
    blocks = _blocks(df, gcols, list(order_cols) if order_cols else cols, block_rows)
    data = F.transform("_r", lambda r: F.struct(*[r[f"_c{i}"].alias(c) for i, c in enumerate(cols)]))
    opts = {"ignoreNullFields": "false"}
    if envelope:
        doc = F.to_json(F.struct(F.col(gcols[0]).alias("season"), data.alias("data")), opts)
    else:
        doc = F.to_json(data, opts)
    return blocks.select(*gcols, F.col("_block").alias("block"), F.size("_r").alias("n_rows"),
                         doc.alias("doc"))
