"""Elements of large JSON array files, read by many tasks.

A file with one top-level array of objects has no line structure, so a reader
that needs whole lines or whole files gives it to one task. Here the text source
splits the file at closing braces, at any byte range and on any file system, and
three running sums over narrow numbers tell what each piece is:

- unescaped quotes before it: does it begin inside a string?
- brackets outside strings before it: how deep does it begin?
- pieces before it that end an element: which element does it belong to?

A running sum goes block by block: sums within a byte range of the file, and a
sum over the few ranges before it. Pieces of an element are then put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankflow.session import materialize

BLANK = " \n\r\t"


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """value (text up to a closing brace), where it is, and its quotes and
    change of depth, should it begin outside or inside a string."""
    text = spark.read.option("lineSep", "}").text(paths)
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    strings = r'"[^"]*("|$)'
    outside = F.regexp_replace("plain", strings, "")
    inside = F.regexp_replace(F.concat(F.lit('"'), F.col("plain")), strings, "")
    depth = lambda x: _count(x, "{[") - _count(x, "]")
    return (text.select("value", F.col("_metadata.file_path").alias("_file"),
                        F.col("_metadata.file_size").alias("size"),
                        F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("id"), plain.alias("plain"))
            .select("value", "_file", "size", "block", "id",
                    _count(F.col("plain"), '"').alias("quotes"),
                    depth(outside).alias("outside"), depth(inside).alias("inside"),
                    F.octet_length("value").alias("bytes"),
                    F.trim("value", F.lit(BLANK)).alias("trimmed"))
            .withColumn("opens", F.when(F.col("trimmed") != "", F.col("trimmed").startswith("[")))
            .drop("trimmed"))


def _upto(rows: DataFrame, value: str, name: str, inclusive: bool = False) -> DataFrame:
    """Running sum of ``value`` over each file, before each row or with it."""
    blocks = rows.groupBy("_file", "block").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy("_file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    first = blocks.select("_file", "block",
                          F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_first"))
    here = Window.partitionBy("_file", "block").orderBy("id").rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    return (rows.withColumn("_here", F.coalesce(F.sum(value).over(here), F.lit(0)))
            .join(first, ["_file", "block"])
            .withColumn(name, F.col("_first") + F.col("_here")).drop("_first", "_here"))


def read_elements(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``_file``, ``element`` (its number in the file, from 0) and ``v``, the
    text of each element.

    A file holds an array of objects, or one object, or several one after the
    other; blank files give nothing. What is no object (numbers between the
    elements, text after them) comes back as part of an element that will not
    parse, and a file that ends too early, even between two elements, gives one
    more element, ``[``, so that no part of it passes for the whole.
    """
    pieces = materialize(_pieces(spark, paths), "array_pieces")
    narrow = pieces.drop("value")
    # a row a file: is it an array, where does it end, and was its last brace there
    left = F.max("size") - F.sum("bytes") - F.count(F.lit(1))
    files = narrow.groupBy("_file").agg(
        F.coalesce(F.min_by("opens", F.when(F.col("opens").isNotNull(), F.struct("block", "id"))),
                   F.lit(False)).alias("array"),
        F.max(F.struct("block", "id")).alias("end"),
        # of a plain file, with or without a byte order mark
        (~left.isin(-1, 2)).alias("closed"))
    rows = narrow.select("_file", "block", "id", "quotes", "outside", "inside").join(files, "_file")
    last = (F.col("end.block") == F.col("block")) & (F.col("end.id") == F.col("id"))
    rows = rows.withColumn("brace", ~last | F.col("closed")).drop("end", "closed")

    rows = _upto(rows, "quotes", "before")
    odd = lambda x: F.pmod(x, F.lit(2)) == 1
    closes = F.col("brace") & ~odd(F.col("before") + F.col("quotes"))
    rows = rows.select(
        "_file", "block", "id", "array", "brace", closes.alias("closes"),
        (F.when(odd(F.col("before")), F.col("inside")).otherwise(F.col("outside"))
         - closes.cast("int")).alias("step"),
        odd(F.col("before") + F.col("quotes")).alias("in_string"))
    rows = _upto(rows, "step", "depth", inclusive=True)
    ends = F.col("closes") & (F.col("depth") == F.col("array").cast("int"))
    rows = _upto(rows.withColumn("ends", ends.cast("int")), "ends", "element")
    rows = materialize(rows.select("_file", "block", "id", "array", "brace", "depth", "in_string",
                                   "ends", "element"), "array_elements")

    text = F.concat("value", F.when(F.col("brace"), "}").otherwise(""))
    whole = (rows.select("id", "_file", "array", "brace", "element", "ends")
             .join(pieces.select("id", "value"), "id")
             .groupBy("_file", "array", "element")
             .agg(F.array_sort(F.collect_list(F.struct("id", text.alias("t")))).alias("p"),
                  F.max("ends").alias("done"))
             .withColumn("v", F.array_join(F.transform("p", lambda x: x["t"]), "")))
    # the separators around an element are no part of it
    begin = F.when(F.col("array") & (F.col("element") == 0), r"^\s*\[\s*").when(
        F.col("array"), r"^\s*,\s*").otherwise(r"^\s*")
    v = F.regexp_replace("v", begin, F.lit(""))
    v = F.when(F.col("done") == 1, v).otherwise(F.regexp_replace(v, r"\s*\]?\s*$", ""))
    found = whole.select("_file", "element", v.alias("v")).where("v <> ''")
    # the depth and state at the end of each file
    final = rows.groupBy("_file").agg(
        F.max_by(F.struct("depth", "in_string", "element", "ends"), F.struct("block", "id"))
        .alias("f"))
    # ``v`` is null, not a constant behind a filter, where a file is whole: a
    # caller's check of it may be evaluated before the filter
    torn = F.when((F.col("f.depth") != 0) | F.col("f.in_string"), F.lit("["))
    return found.unionByName(final.select(
        "_file", (F.col("f.element") + F.col("f.ends") + 1).alias("element"), torn.alias("v"))
        .where("v is not null"))
