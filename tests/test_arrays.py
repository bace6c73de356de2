"""Array files split over tasks; columnar documents with positions and JSON types."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.operators.numbering import with_group_positions, with_positions
from rankflow.schemas import SEASON
from rankflow.sources.arrays import read_elements
from rankflow.sources.columnar import decode_columnar, encode_columnar
from rankflow.sources.readers import good_documents, parse_documents, read_rankings

NASTY = ['"', "\\", "}", "{", "]", "[", ",", "\\\"", "}\"", "a", "é", "漢", "🙂", "\n", "\t", " "]


def value(rnd, depth=0):
    kind = rnd.randrange(6 if depth < 3 else 4)
    if kind == 0:
        return "".join(rnd.choices(NASTY, k=rnd.randrange(12)))
    if kind == 1:
        return rnd.choice([None, True, False])
    if kind == 2:
        return rnd.randrange(-10**6, 10**6)
    if kind == 3:
        return ""
    if kind == 4:
        return [value(rnd, depth + 1) for _ in range(rnd.randrange(4))]
    return {"k" + "".join(rnd.choices(NASTY, k=2)) + str(i): value(rnd, depth + 1)
            for i in range(rnd.randrange(4))}


def document(rnd, i):
    return {"i": i, **{f"f{j}": value(rnd) for j in range(rnd.randrange(5))}}


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "1500b", "spark.sql.files.openCostInBytes": "64"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def elements(spark, paths):
    got = {}
    for r in read_elements(spark, [str(p) for p in paths]).collect():
        got.setdefault(r._file.rsplit("/", 1)[1], []).append((r.element, r.v))
    return {k: [v for _, v in sorted(x)] for k, x in got.items()}


@pytest.mark.parametrize("seed", range(4))
def test_elements_equal_those_of_a_whole_parse(spark, tmp_path, small_splits, seed):
    rnd = random.Random(seed)
    want = {}
    for n, (style, ascii_only) in enumerate([({}, True), ({"indent": 1}, False),
                                             ({"separators": (",", ":")}, False)]):
        docs = [document(rnd, i) for i in range(rnd.randrange(1, 60))]
        path = tmp_path / f"{n}.json"
        path.write_text(rnd.choice(["", "\n \t"]) + json.dumps(docs, ensure_ascii=ascii_only, **style)
                        + rnd.choice(["", "\n\n"]))
        want[path.name] = docs
    got = elements(spark, tmp_path.glob("*.json"))
    assert {k: [json.loads(x) for x in v] for k, v in got.items()} == want


def test_one_file_goes_to_many_tasks(spark, tmp_path, small_splits):
    docs = [{"season": 2024, "seasonType": "regular", "week": i, "polls": [
        {"poll": "P } \" {", "ranks": [{"school": "A", "rank": i}]}]} for i in range(300)]
    path = tmp_path / "large.json"
    path.write_text(json.dumps(docs, indent=2))
    blocks = (spark.read.option("lineSep", "}").text(str(path))
              .select(F.spark_partition_id().alias("p")).distinct().count())
    assert blocks > 20
    got = read_rankings(spark, str(path), multi_line=True).collect()
    assert sorted(r.week for r in got) == list(range(300))
    assert {r.polls[0].poll for r in got} == {"P } \" {"}
    whole = spark.read.schema(SEASON).json(str(path), multiLine=True)
    split = read_rankings(spark, str(path), multi_line=True)
    assert split.exceptAll(whole).count() == 0 == whole.exceptAll(split).count()


def test_odd_files(spark, tmp_path, small_splits):
    texts = {
        "empty": "", "blank": " \n ", "none": "[]", "spaced": " [ \n ] ",
        "object": '{"a": 1}', "object_line": '{"a": {"b": "}"}}\n', "lines": '{"a":1}\n{"a":2}\n',
        "numbers": "[1, 2]", "mixed": '[{"a": 1}, 7, {"a": 2}]', "after": '[{"a": 1}] x',
        "bom": "﻿" + '{"a": 1}',
    }
    for k, v in texts.items():
        (tmp_path / k).write_text(v)
    got = elements(spark, tmp_path.iterdir())
    assert got == {
        "object": ['{"a": 1}'], "object_line": ['{"a": {"b": "}"}}'],
        "lines": ['{"a":1}', '{"a":2}'], "numbers": ["1, 2"],
        "mixed": ['{"a": 1}', '7, {"a": 2}'], "after": ['{"a": 1}', "] x"], "bom": ['{"a": 1}']}


def test_a_file_that_ends_too_early_fails(spark, tmp_path, small_splits):
    text = json.dumps([{"season": 2024, "seasonType": "a } b", "week": i} for i in range(9)])
    ends = [len(text) - 1, text.index("a }", 200) + 3, text.index("}, {", 300) + 1]
    for n, end in enumerate(ends):
        path = tmp_path / f"{n}.json"
        path.write_text(text[:end])
        with pytest.raises(Exception, match="malformed document in"):
            read_rankings(spark, str(path), multi_line=True).collect()
        kept = good_documents(parse_documents(spark, [str(path)], SEASON, True), "skip")
        assert kept.count() == len([i for i in range(9) if f'"week": {i}}}' in text[:end]])


# -- positions ---------------------------------------------------------------------

def test_positions_without_gaps(spark):
    df = spark.range(1000).selectExpr("id % 7 as k", "cast(id as string) as v").repartition(5)
    got = with_positions(df).collect()
    assert sorted(r._position for r in got) == list(range(1000))
    ordered = with_positions(df, "at", ["k", F.col("v").desc()], partitions=6)
    rows = sorted(ordered.collect(), key=lambda r: r.at)
    assert [(r.k, r.v) for r in rows] == sorted(
        [(i % 7, str(i)) for i in range(1000)], key=lambda x: (x[0], [-ord(c) for c in x[1]] + [1]))
    assert with_positions(df.limit(0)).collect() == []


def test_group_positions_of_a_hot_and_a_null_group(spark):
    df = spark.range(900).selectExpr(
        "case when id % 3 = 0 then 1 when id % 30 = 1 then null else cast(id % 5 as int) end as g",
        "id").repartitionByRange(6, "id").sortWithinPartitions("id")
    got = with_group_positions(df, ["g"], "at").collect()
    by = {}
    for r in sorted(got, key=lambda r: r.id):
        by.setdefault(r.g, []).append(r.at)
    assert len(got) == 900 and None in by
    for at in by.values():
        assert at == list(range(len(at)))


def test_decoded_rows_are_in_their_places(spark):
    """decode(encode(x)) by position is x, copies and nulls included."""
    n = 700
    x = [(2024 if i % 3 else None, "copy" if i % 2 else None, i // 10, [str(i % 4)] if i % 5 else None)
         for i in range(n)]
    random.Random(5).shuffle(x)
    schema = "season int, school string, rank int, logos array<string>"
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(x)], f"i int, {schema}")
    df = df.repartitionByRange(5, "i").sortWithinPartitions("i").drop("i")
    docs = encode_columnar(df, ["season"], block_rows=64, in_place=True)
    assert docs.agg(F.max("n_rows")).first()[0] == 64
    back = decode_columnar(docs.select("doc"), df.schema, position="at").collect()
    for season in (2024, None):
        got = sorted((r for r in back if r.season == season), key=lambda r: r.at)
        assert [r.at for r in got] == list(range(len(got)))
        assert [tuple(r)[:4] for r in got] == [r for r in x if r[0] == season]
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.replace("SinglePartition, ENSURE_REQUIREMENTS", "", 1)


def test_documents_without_places(spark):
    docs = spark.createDataFrame([('{"columns": [{"name": "a", "values": [1, 2]}]}',)], "doc string")
    got = decode_columnar(docs, T.StructType([T.StructField("a", T.IntegerType())]), position="at")
    assert [(r.a, r.at) for r in got.collect()] == [(1, None), (2, None)]


# -- JSON types ----------------------------------------------------------------------

MIXED = ["x", "5", 5, 5.25, True, None, ["a", 1, None], {"k": [1]}, "", []]


def test_undeclared_columns_keep_their_json_types(spark):
    doc = json.dumps({"columns": [
        {"name": "school", "values": [str(i) for i in range(len(MIXED) + 1)]},
        {"name": "rank", "values": [1, "2", None, 4.0]},
        {"name": "odd", "values": MIXED},
        {"name": "twice", "values": [1]}, {"name": "twice", "values": ["last"]}]})
    docs = spark.createDataFrame([(doc,)], "doc string")
    schema = T.StructType([T.StructField("school", T.StringType()),
                           T.StructField("rank", T.IntegerType())])
    got = decode_columnar(docs, schema, undeclared="extra", json_types=True).select(
        "school", "rank", F.to_json(F.col("extra")["odd"]).alias("odd"),
        F.schema_of_variant(F.col("extra")["odd"]).alias("kind"),
        F.to_json(F.col("extra")["twice"]).alias("twice"), F.size("extra").alias("n")).collect()
    got = sorted(got, key=lambda r: int(r.school))
    assert [json.loads(r.odd) for r in got[:-1]] == MIXED
    assert [r.kind.split("<")[0].split("(")[0] for r in got[:-1]] == [
        "STRING", "STRING", "BIGINT", "DECIMAL", "BOOLEAN", "VOID", "ARRAY", "OBJECT", "STRING",
        "ARRAY"]
    assert got[-1].odd is None  # beyond the end of that column
    assert [r.rank for r in got[:4]] == [1, 2, None, 4]
    assert json.loads(got[0].twice) == "last" and {r.n for r in got} == {2}


def test_declared_columns_read_alike_with_and_without_json_types(spark):
    doc = json.dumps({"columns": [{"name": "s", "values": MIXED}, {"name": "i", "values": MIXED},
                                  {"name": "a", "values": [["x", "y"], None, [], "z", 3]}]})
    docs = spark.createDataFrame([(doc,)], "doc string")
    schema = T.StructType([T.StructField("s", T.StringType()), T.StructField("i", T.IntegerType()),
                           T.StructField("a", T.ArrayType(T.StringType()))])
    plain = [tuple(r) for r in decode_columnar(docs, schema).collect()]
    typed = decode_columnar(docs, schema, undeclared="extra", json_types=True).drop("extra")
    assert [tuple(r) for r in typed.collect()] == plain
