import zlib
from collections import Counter, defaultdict

import pytest

from rankflow.llm import sharding
from rankflow.llm.queries import op11_sharding

from .conftest import ODD_IDS, ODD_TEXTS, docs_of


def size_of(text):
    return len((text or "").encode()) + 16


def check(found, ids, texts, shards, spare):
    """Whole, gapless and as even as one document a level allows."""
    want = Counter((i, size_of(t), zlib.crc32((t or "").encode()))
                   for i, t in zip(ids, texts, strict=True))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == want
    assert {(r.law, r.grown_shard) for r in found} <= {("bytes", None)}
    slots, size = defaultdict(list), defaultdict(int)
    for r in found:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    mean = sum(size.values()) / shards
    assert max(abs(size[s] - mean) for s in range(shards)) <= spare(mean)
    return size


def most(texts, levels=3.0):
    """A split misses by half a document at most; the misses halve downwards."""
    return lambda mean: levels * max(map(size_of, texts)) + 0.01 * mean


@pytest.mark.parametrize("shards", [1, 2, 3, 7, 40])
def test_even_shards(spark, shards):
    texts = ["word " * (1 + i * 37 % 50) for i in range(1500)]
    ids = list(range(1500))
    docs = docs_of(spark, texts, ids).repartition(3)
    found = sharding.shards(docs, shards=shards).collect()
    check(found, ids, texts, shards, most(texts, 1.0))


def test_splits_are_exact_medians(spark):
    """Rows of one size: the splits are those of the sorted order."""
    ids = list(range(64))
    docs = docs_of(spark, ["same size"] * 64, ids).repartition(3)
    found = sharding.shards(docs, shards=8, dims=("doc_id",)).collect()
    assert {(r.doc_id, r.shard) for r in found} == {(i, i // 8) for i in ids}


def test_widest_dimension_first(spark):
    """Root: both dimensions span the table; the first listed is taken. Its
    halves are narrow in it, so the other one is next."""
    ids = [i for i in range(16)]
    rows = [(i, "x" * 10, i % 4, i // 4) for i in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string, a int, b int")
    by = defaultdict(set)
    placed = sharding.narrow(docs, ("a", "b"))
    levels, leaves = sharding.grow(placed, shards=4)
    assert [[n.dim for n in level] for level in levels] == [[0], [1, 1]]
    for r in sharding.assign(placed, levels, leaves).collect():
        by[r.shard].add((r.doc_id % 4 // 2, r.doc_id // 8))
    assert {s: len(x) for s, x in by.items()} == {0: 1, 1: 1, 2: 1, 3: 1}


def test_hot_value_and_copies_of_one_row(spark):
    """A third of all rows has one source; another third is one row over and over."""
    n = 1200
    ids = [9 if i % 3 == 1 else i for i in range(n)]
    texts = ["the very same row" if i % 3 == 1 else f"text {i} " * (i % 7) for i in range(n)]
    docs = docs_of(spark, texts, ids).repartition(4)  # source is the same everywhere
    found = sharding.shards(docs, shards=40).collect()
    check(found, ids, texts, 40, most(texts))


def test_nulls_long_texts_and_repeated_rows(odd):
    found = sharding.shards(odd, shards=5).collect()
    check(found, ODD_IDS, ODD_TEXTS, 5, lambda mean: 2 * max(map(size_of, ODD_TEXTS)))
    nulls = [r for r in found if r.size == 16]
    assert {r.text_crc32 for r in nulls} == {0}


def test_empty_table_and_more_shards_than_rows(spark, none):
    assert sharding.shards(none).collect() == []
    found = sharding.shards(docs_of(spark, ["a", "bb"]), shards=40).collect()
    assert len(found) == 2 and len({r.shard for r in found}) == 2


def test_null_dimensions(spark):
    docs = spark.createDataFrame([(i, "t" * i, None, None) for i in range(30)],
                                 "doc_id long, text string, source string, lang string")
    found = sharding.shards(docs, shards=3).collect()
    check(found, list(range(30)), ["t" * i for i in range(30)], 3, most(["t" * 30]))


def test_every_type_of_dimension(spark):
    docs = spark.range(50).selectExpr(
        "id as doc_id", "repeat('x', cast(id as int)) as text",
        "cast(id * 1.5e300 as double) as big", "cast('nan' as double) as nan",
        "date_add(date'2020-01-01', cast(id as int)) as day", "array(id) as list",
        "cast(id as decimal(20,4)) as exact", "9223372036854775807 - id as far")
    for dim in ("big", "nan", "day", "exact", "far"):
        found = sharding.shards(docs, shards=4, dims=(dim,)).collect()
        assert len(found) == 50 and {r.shard for r in found} == {0, 1, 2, 3}


def test_target_bytes_and_whole_documents_on_disk(spark, small, tmp_path):
    total = sum(size_of(r.text) for r in small.select("text").collect())
    path = str(tmp_path / "shards")
    leaves = sharding.write_shards(small, path, target_bytes=total // 10, files=2)
    assert sorted(leaves.values()) == list(range(len(leaves))) and 10 <= len(leaves) <= 11
    back = spark.read.parquet(path)
    assert back.drop("shard").exceptAll(small).count() == 0 == small.exceptAll(
        back.drop("shard")).count()
    by = [r["count"] for r in back.groupBy("shard").count().collect()]
    assert len(by) == len(leaves)


def test_plan_has_no_python(odd):
    plan = sharding.shards(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_query_over_the_whole_table(spark, sf_small, small):
    found = op11_sharding(spark, sf_small).collect()
    docs = small.select("doc_id", "text").collect()
    check(found, [d.doc_id for d in docs], [d.text for d in docs], 40,
          most([d.text for d in docs]))
