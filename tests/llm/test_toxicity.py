import math
import random

import numpy as np
import pyarrow as pa
import pytest

from rankflow.llm import toxicity as T

from .conftest import ODD_IDS, docs_of


@pytest.mark.parametrize("seed", range(6))
def test_block_max_search_is_exact(seed):
    """Against the cosine with every entry; all ties at the k-th are found."""
    rng = random.Random(seed)
    rows, count = [], []
    for _ in range(rng.randint(1, 300)):
        ids = sorted(rng.sample(range(40), rng.randint(1, 6)))
        v = [rng.random() + 0.1 for _ in ids]
        norm = math.sqrt(sum(x * x for x in v))
        rows.append((tuple(ids), tuple(x / norm for x in v)))
        count.append([rng.randint(0, 2), rng.randint(1, 2)])
    index = T.BlockMaxIndex(40, rows, np.array(count, float), block=rng.choice([4, 16, 64]))
    for _ in range(25):
        query = {t: rng.random() + 0.1 for t in rng.sample(range(40), rng.randint(1, 6))}
        sims = [(round(sum(query.get(t, 0) * x for t, x in zip(*r, strict=True)), 9), e)
                for e, r in enumerate(rows)]
        sims = sorted([s for s in sims if s[0] > 0], key=lambda s: (-s[0], s[1]))
        k, n, want = rng.choice([1, 5, 25]), 0, []
        for s, e in sims:
            if n >= k and s < want[-1][0]:
                break
            want.append((s, e))
            n += sum(count[e])
        got = index.nearest(query, k)
        assert [e for _, e in got] == [e for _, e in want]


def labelled(spark, docs, toxic):
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    return spark.createDataFrame([(i, 1, int(toxic(i))) for i in ids],
                                 "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_evidence(spark):
    rng = random.Random(0)
    words = ["".join(rng.choice("abcdeiou") for _ in range(6)) for _ in range(400)]
    texts = []
    for i in range(600):
        text = rng.choices(words, k=40)
        if i % 4 == 0:
            text[rng.randrange(40)] = rng.choice(["Idiot,", "moron", "zqrtsen", "zqrtson."])
            text[rng.randrange(40)] = rng.choice(["idiot", "moron", "zqrtsund", "zqrtsik"])
        texts.append(" ".join(text))
    docs = docs_of(spark, texts)
    model = T.train(docs, labelled(spark, docs, lambda i: i % 4 == 0))
    rows = T.scores(docs, model).collect()
    assert len(rows) == 600 and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert held and sum(r.predicted == (r.doc_id % 4 == 0) for r in held) / len(held) > 0.97
    # a form that only shares its beginning with the examples is caught too
    one = T.scores(docs_of(spark, ["calm words and a zqrtsheit here", "calm words"]), model)
    a, b = one.orderBy("doc_id").collect()
    assert a.predicted == 1 and any(t.endswith("*") for t in a.evidence) and a.nearest
    assert b.predicted == 0 and not b.evidence
    kept = T.drop_toxic(docs, model)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if not r.predicted}


def test_odd_rows_labels_and_empty_tables(spark, odd, none):
    labels = spark.createDataFrame([(5, None, 1), (7, 0, None), (None, 1, 1), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    for model in (T.train(odd, labels), T.train(none, labels.limit(0))):
        rows = T.scores(odd, model).collect()
        assert sorted(map(repr, (r.doc_id for r in rows))) == sorted(map(repr, ODD_IDS))
        assert all(0 <= r.score <= 1 for r in rows)
        assert T.scores(none, model).collect() == [] and T.drop_toxic(none, model).collect() == []
        assert T.drop_toxic(odd, model, threshold=1.1).count() == len(ODD_IDS)


@pytest.mark.parametrize("share", [0, 0.1, 2])
def test_search_is_exact_with_lists_in_and_out_of_the_matrix(share, monkeypatch):
    """``share`` decides which lists are rows of the matrix: all, some, none."""
    monkeypatch.setattr(T, "LIGHT", 0.1)
    rng = np.random.default_rng(3)
    terms, entries = 60, 400
    often = 1 / np.arange(1, terms + 1)
    counts = [rng.poisson(4 * often) for _ in range(entries)]
    pairs = [(np.flatnonzero(c), c[np.flatnonzero(c)] - 1) for c in counts]
    book, scale = 1 + np.log(np.arange(1, 50)), rng.random(terms) + 0.1
    dense = np.zeros((entries, terms))
    for own, (t, n) in zip(dense, pairs, strict=True):
        own[t] = book[n] * scale[t]
    dense /= np.maximum(np.sqrt((dense ** 2).sum(axis=1)), 1e-9)[:, None]
    index = T.BlockMaxIndex(terms, T.Rows.of(pairs, np.uint8), np.ones((entries, 2)) / 2, block=16,
                            share=share, book=book, scale=scale)
    inside = np.count_nonzero(index.place >= 0)
    assert inside == 0 if share == 2 else 0 < inside <= terms and (share > 0) == (inside < terms)
    queries = [(t, rng.random(len(t)) + 0.1) for t in
               (np.sort(rng.choice(terms, n, replace=False)) for n in rng.integers(0, 30, 300))]
    for (ids, values), (near, entry) in zip(queries, index.search(queries, 10), strict=True):
        sims = np.round(dense[:, ids] @ values, 9)
        least = max(np.sort(sims)[-10], 1e-9)
        want = np.flatnonzero(sims >= least)
        assert set(entry) == set(want) and np.allclose(np.sort(near), np.sort(sims[want]), atol=2e-9)


def test_terms_are_counted_as_words_and_beginnings():
    """Many texts at a time, over chunks, against one word after the other."""
    rng = random.Random(1)
    words = ["".join(rng.choice("abÀßi ") for _ in range(rng.randint(1, 9))).strip() for _ in range(60)]
    texts = [None, "", " \x0b\t", "12 ,a. \x00abab\x1c1", "(Abab) ABAB abab\x0cabÀßi abÀß"]
    texts += [" ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(1500)]
    texts += ["abab " * (T.CHUNK_BYTES // 4), "abab abababa"]
    known = sorted({t for x in words[:40] for t in T.all_terms(T.word_counts(x.encode()))}
                   | {(0, b"abab"), (4, b"abab")})
    names = pa.array([n for _, n in known], pa.large_binary())
    terms = T.Terms(np.array([k for k, _ in known]), names)
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    got = []
    for chunk in T._chunks(batch):
        ids, n, ends = terms.counts(chunk)
        got += [{known[i]: m for i, m in zip(ids[a:b].tolist(), n[a:b].tolist(), strict=True)}
                for a, b in zip(ends, ends[1:], strict=False)]
    assert len(got) == len(texts)
    for text, found in zip(texts, got, strict=True):
        want = {}
        for w, m in T.word_counts((text or "").encode()).items():
            for t in T.all_terms({w: m}):
                if t in set(known):
                    want[t] = want.get(t, 0) + m
        assert found == want


def test_the_index_holds_each_weight_in_few_bytes():
    """Two workers an executor hold one each: about 20 bytes a posting, as the
    rows are numbers of weights and no list is kept twice."""
    rng = np.random.default_rng(5)
    pairs = [(np.sort(rng.choice(20_000, 500, replace=False)), rng.integers(0, 3, 500))
             for _ in range(1000)]
    index = T.BlockMaxIndex(20_000, T.Rows.of(pairs, np.uint8), np.ones((1000, 2)),
                            book=1 + np.log(np.arange(1, 4)), scale=np.ones(20_000))
    arrays = [x for o in (index, index.rows) for x in vars(o).values() if isinstance(x, np.ndarray)]
    postings = 500 * 1000
    fixed = 8 * 8 * 20_000  # of the terms
    assert sum(x.nbytes for x in arrays) < 20 * postings + fixed


def test_dropping_gives_rows_back_a_chunk_at_a_time(monkeypatch, spark):
    """The worker never holds an Arrow batch and its filtered copy."""
    model = T.train(docs_of(spark, []), spark.createDataFrame([], "doc_id long, toxic int"))
    run = []
    docs = docs_of(spark, ["a"])
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: run.append(f) or self)
    T.drop_toxic(docs, model)
    name = f"c{docs.columns.index('text')}"
    batch = pa.RecordBatch.from_arrays([pa.array([f"text {i}" for i in range(3000)])], [name])
    got = list(run[0]([batch]))
    assert pa.Table.from_batches(got).column(0).to_pylist() == batch.column(0).to_pylist()
    assert max(x.num_rows for x in got) <= T.CHUNK
