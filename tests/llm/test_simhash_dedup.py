import random
import re

import xxhash
from pyspark.sql import functions as F

from rankflow.llm import simhash_dedup as S

from .conftest import ODD_IDS, ODD_TEXTS


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    n = max(1, len(words) - 2)
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(fps, bits=2):
    """Least index reachable, by comparing all pairs."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


def test_odd_rows(odd):
    found = S.near_duplicates(odd).collect()
    assert len(found) == len(ODD_IDS)
    want = {(i, f"{brute_fingerprint(t):016x}") for i, t in zip(ODD_IDS, ODD_TEXTS, strict=True)}
    assert {(r.doc_id, r.fingerprint) for r in found} == want
    empty = [r.component_id for r in found if r.fingerprint == "0" * 16]
    assert len(empty) == 4 and set(empty) == {3}
    assert {r.component_id for r in found if r.doc_id is None} == {None}


def test_documents_against_all_pairs(small):
    rows = sorted((r.doc_id, r.text) for r in small.collect())
    fps = [brute_fingerprint(t) for _, t in rows]
    want = {rows[i][0]: (f"{fps[i]:016x}", rows[r][0]) for i, r in enumerate(roots(fps))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.near_duplicates(small).collect()}
    assert got == want


def test_crowded_buckets_lose_no_link(spark):
    """Flips of one fingerprint crowd its buckets; both ways must agree."""
    rng = random.Random(5)
    base = rng.getrandbits(64)
    fps = {rng.getrandbits(64) for _ in range(100)}
    for _ in range(300):
        fps.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    fps = sorted(fps)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    want = roots(fps)
    sizes = sorted(want.count(r) for r in set(want) if want.count(r) > 1)
    for bucket in (2, 10_000):
        edges = S.links(spark.createDataFrame(signed, "fp long"), bucket=bucket)
        labels = S.components(edges)
        got = sorted(r["count"] for r in labels.groupBy("root").count().collect())
        assert got == sizes


def test_pivot_differences_never_exceed_the_distance(spark):
    pairs = spark.createDataFrame([(0, 0), (0, 3), (-1, -8), (12345, 12344)], "x long, y long")
    a = S.pivot_table(pairs.select(F.col("x").alias("fp"))).collect()
    b = S.pivot_table(pairs.select(F.col("y").alias("fp"))).collect()
    for p, q in zip(a, b, strict=True):
        for t in ("t0", "t1"):
            for k in range(8):
                far = abs((p[t] >> 8 * k & 255) - (q[t] >> 8 * k & 255))
                assert far <= ((p.fp ^ q.fp) & (1 << 64) - 1).bit_count()


def test_keep_one_and_empty_table(odd, none):
    assert S.near_duplicates(none).collect() == []
    assert S.keep_one(none).collect() == []
    kept = S.keep_one(odd)
    assert kept.schema == odd.schema
    fps = [brute_fingerprint(r.text) for r in kept.collect()]
    assert len(fps) == len(set(roots(fps)))
