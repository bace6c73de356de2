from hashlib import sha256
from itertools import combinations

from pyspark.sql import functions as F

from rankflow.llm import spotsigs as S

from .conftest import ODD_IDS, ODD_TEXTS, docs_of


def sigs(fingerprint):
    return {fingerprint[i:i + 8] for i in range(0, len(fingerprint), 8)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def check(rows, docs):
    """``docs``: distinct (doc_id, text) in the order of the operator."""
    by = {(r.doc_id, r.edited_sha256): r for r in rows}
    prints = {}
    for j, (i, t) in enumerate(docs):
        following = docs[(j + 1) % len(docs)][1]
        k = len(t) // 2
        edited = t[:len(t) - k] + following[:k]
        r = by[i, sha256(edited.encode()).hexdigest()]
        assert r.n_chars == len(t)
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
    for j, (i, t) in enumerate(docs):
        following = docs[(j + 1) % len(docs)][1]
        k = len(t) // 2
        r = by[i, sha256((t[:len(t) - k] + following[:k]).encode()).hexdigest()]
        own = sigs(r.fingerprint)
        assert abs(r.near_edited - jaccard(own, sigs(r.edited_fingerprint))) < 1e-12
        assert abs(r.near_next - jaccard(own, sigs(prints[following]))) < 1e-12


def test_documents(small):
    rows = S.edited_fingerprints(small).collect()
    docs = sorted((r.doc_id, r.text or "") for r in small.collect())
    assert len(rows) == len(docs)
    check(rows, docs)
    assert sum(r.near_edited > r.near_next for r in rows) > 0.95 * len(rows)


def test_odd_rows(spark, odd, none):
    rows = S.edited_fingerprints(odd).collect()
    assert sorted(repr(r.doc_id) for r in rows) == sorted(map(repr, ODD_IDS))
    distinct = {(i, t or "") for i, t in zip(ODD_IDS, ODD_TEXTS, strict=True)}
    # nulls first; equal doc_ids by the hash of their text, as in the operator
    hashed = {r.t: r.h for r in spark.createDataFrame([(t,) for _, t in distinct], "t string")
              .select("t", F.xxhash64("t").alias("h")).collect()}
    check(rows, sorted(distinct, key=lambda d: (d[0] is not None, d[0] or 0, hashed[d[1]])))
    assert S.edited_fingerprints(none).collect() == []


def test_a_document_alone_is_followed_by_itself(spark):
    row = S.edited_fingerprints(docs_of(spark, ["the cat sat on the mat"])).first()
    assert row.edited_sha256 == sha256(b"the cat sat" + b"the cat sat").hexdigest()
    assert row.near_next == 1.0


def test_signatures_follow_anchors(spark):
    df = spark.createDataFrame([("THE cat, sat on the big mat",), ("the cat sat on the big mat!",),
                                ("",), ("...",)], "t string")
    a, b, c, d = (r.s for r in df.select(S.signatures(F.col("t")).alias("s")).collect())
    assert a == b and len(a) >= 3 and a == sorted(set(a))
    assert len(c) == len(d) == 1 and c != d


def test_pruned_likeness(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], [1, 2, 3, 4, 5]), ([1], [1, 2, 3])],
                               "a array<int>, b array<int>")
    rows = df.select(S.likeness(F.col("a"), F.col("b"), 0.8).alias("p"),
                     S.likeness(F.col("a"), F.col("b")).alias("e")).collect()
    assert [(r.p, round(r.e, 6)) for r in rows] == [(0.8, 0.8), (0.0, round(1 / 3, 6))]


def test_near_pairs_against_all_pairs(spark, none):
    base = [f"the item{i} word{i} of other{i} thing{i}" for i in range(30)]
    texts = []
    for g in range(6):
        words = base[g:] + base[:g]
        for e in range(5):
            changed = list(words)
            for j in range(e * 2):
                changed[(7 * j + g) % 30] = f"the new{g}{e}{j} part{j} of fresh{e}{j} bit{g}"
            texts.append(" ".join(changed))
    texts += [texts[0], "", None, "no", "no"]
    docs = docs_of(spark, texts)
    members, pairs = S.near_pairs(docs, 0.6)
    set_of = {r.doc_id: r.set_id for r in members.collect()}
    prints = {r.doc_id: set(r.s) for r in docs.select("doc_id", S.signatures(
        F.coalesce("text", F.lit(""))).alias("s")).collect()}
    one = {set_of[i]: s for i, s in prints.items()}
    assert len(one) == len({frozenset(s) for s in prints.values()})
    want = {tuple(sorted(p)) for p in combinations(one, 2)
            if jaccard(one[p[0]], one[p[1]]) >= 0.6 - 1e-12}
    assert want and {(r.a, r.b) for r in pairs.collect()} == want
    members, pairs = S.near_pairs(none)
    assert members.collect() == [] and pairs.collect() == []
