import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankflow.llm import whitening
from rankflow.llm.queries import op13_whitening

SCHEMA = ("vec_id long, embedding array<float>, label int, index long, x string, spread int, "
          "_position long, projected string")


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame(
        [(i, v, 1, 2, "x", 3, 4, "p") for i, v in zip(ids, vectors, strict=True)], SCHEMA)


def brute(ids, vectors, k=8):
    """Exact sums and deviations, covariance by numpy; whitened up to its sign."""
    rows = []
    for i, v in zip(ids, vectors, strict=True):
        if v and all(c is not None and math.isfinite(c) for c in v):
            c32 = np.asarray(v, np.float32).astype(float)
            rows.append((i, [math.floor(1024 * c) + 100000 for c in c32.tolist()]))
    n, d = len(rows), len(rows[0][1])
    s = [sum(x[j] for _, x in rows) for j in range(d)]
    centred = np.array([[(n * x[j] - s[j]) / n for j in range(d)] for _, x in rows])
    cov = centred.T @ centred / n
    e, vec = np.linalg.eigh(cov)
    e, vec = e[::-1], vec[:, ::-1]
    out = []
    for (i, x), c in zip(rows, centred, strict=True):
        dev = sum((n * x[j] - s[j]) ** 2 for j in range(d))
        for q in range(min(k, d)):
            out.append((i, q + 1, n, dev, c @ vec[:, q] / math.sqrt(e[q]), e[q] / np.trace(cov)))
    return out


def check(found, want, close=1e-7):
    assert len(found) == len(want)
    key = lambda r: (repr(r[0]), r[1], r[3], round(abs(r[4]), 6))
    got = sorted(([r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained]
                  for r in found), key=key)
    signs = defaultdict(set)
    for a, b in zip(got, sorted(want, key=key), strict=True):
        assert a[:4] == list(b[:4])
        assert abs(abs(a[4]) - abs(b[4])) < close and abs(a[5] / b[5] - 1) < 1e-6
        if abs(b[4]) > 1e-3:
            signs[a[1]].add(np.sign(a[4]) == np.sign(b[4]))
    assert all(len(x) == 1 for x in signs.values())
    errors = {r.identity_error for r in found}
    assert len(errors) == 1 and errors.pop() < 1e-6


@pytest.mark.parametrize("block_rows", [7, 4096])
def test_against_brute_force(spark, block_rows):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(90, 5)) * [3, 2, 1, 0.5, 0.1] + 2).tolist()
    ids = list(range(90))
    vectors[10] = vectors[11]
    ids[10] = ids[11]  # a repeated row
    ids[12] = None
    vectors[20], vectors[21], vectors[22] = None, [1.0, None, 1.0, 1.0, 1.0], [math.nan] * 5
    vectors[23], vectors[24], vectors[25] = [math.inf] + [0.0] * 4, [], [-math.inf] * 5
    docs = table(spark, vectors, ids).repartition(3)
    found = whitening.whiten(docs, block_rows=block_rows).collect()
    check(found, brute(ids, vectors))
    assert {r.component for r in found} == {1, 2, 3, 4, 5}


def test_a_third_of_all_rows_is_one_vector(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(120, 3)).tolist()
    for i in range(0, 120, 3):
        vectors[i] = [0.5, -0.25, 4.0]
    ids = [5 if i % 3 == 0 else i for i in range(120)]
    found = whitening.whiten(table(spark, vectors, ids), components=2, block_rows=16).collect()
    check(found, [r for r in brute(ids, vectors) if r[1] <= 2])


def test_no_rows_one_row_and_no_variance(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [None, []])).collect() == []
    for vectors in ([[1.0, 2.0]], [[1.0, 2.0]] * 3):
        found = whitening.whiten(table(spark, vectors)).collect()
        assert len(found) == 2 * len(vectors)
        assert {(r.deviation, r.whitened, r.explained, r.identity_error) for r in found} == {
            (0, None, None, None)}


def test_dependent_dimensions_have_null_components(spark):
    found = whitening.whiten(table(spark, [[float(i), 2.0 * i] for i in range(9)])).collect()
    assert {r.component for r in found if r.whitened is None} == {2}
    assert max(r.identity_error for r in found) < 1e-9


def test_other_lengths_and_very_large_entries(spark):
    vectors = [[1.0, 2.0], [2.0, 1.0], [4.0, 4.0], [1.0], [3e38, 0.0], [0.0, -3e38]]
    found = whitening.whiten(table(spark, vectors)).collect()
    assert {r.vec_id for r in found} == {0, 1, 2} and {r.n for r in found} == {3}
    big = whitening.whiten(table(spark, [[4e12, 1.0], [-4e12, 2.0], [0.0, 3.0]])).collect()
    # beyond a long but for the middle one
    assert {(r.vec_id, r.deviation) for r in big} == {(0, None), (1, None), (2, 3 * 3 * 1024 ** 2)}


def test_products_are_dealt_over_row_blocks(spark):
    rows = whitening.with_positions(whitening.whole_numbers(
        table(spark, [[float(i), float(-i)] for i in range(50)])))
    values = F.transform("x", lambda v: v.cast("double"))
    matrix = whitening._blocks(rows, values, 50, 2, 5)
    assert matrix.numRowBlocks == 10
    x = np.array([[1024 * i + 100000, -1024 * i + 100000] for i in range(50)], float)
    for blocks_a_task in (1, 3, 100):
        assert np.array_equal(whitening.scatter(matrix, blocks_a_task), x.T @ x)


def test_query_over_the_whole_table(spark, sf_small):
    found = op13_whitening(spark, sf_small).collect()
    rows = spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()
    check(found, brute([r.vec_id for r in rows], [r.embedding for r in rows]))
