import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from rankflow.llm import attention as A
from rankflow.llm import lm_scoring as L
from rankflow.llm.common import FileBytes, tokenizer_path
from rankflow.llm.lm_scoring import score_documents

from .conftest import ODD_IDS, ODD_TEXTS

PATH = tokenizer_path("word_bpe_49k.json")


def new_model(seed=0, ids=200):
    rng = np.random.default_rng(seed)
    counts = np.zeros(ids)
    counts[:150] = rng.integers(1, 50, 150)
    before, after = rng.integers(0, 9, (2, ids, 16)).astype(np.float32)
    return A.AttentionModel.new(counts, A.classes_of(counts, before, after)), rng


def test_gradients():
    model, rng = new_model()
    model.params = {k: v.astype(np.float64) for k, v in model.params.items()}
    ids = rng.integers(0, 200, (3, A.SPAN + 1))
    _, grads = model.step(ids)
    for name, g in grads.items():
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        kept = model.params[name][at]
        loss = []
        for e in (1e-5, -1e-5):
            model.params[name][at] = kept + e
            loss.append(model.step(ids)[0])
        model.params[name][at] = kept
        assert abs((loss[0] - loss[1]) / 2e-5 - g[at]) < 1e-3 * abs(g[at]) + 1e-7, name


def test_windows_score_each_id_once_and_never_look_ahead():
    model, rng = new_model(1)
    rows = [rng.integers(0, 200, n) for n in (2, 1, A.HALF, A.HALF + 1, A.HALF + 2, 7 * A.HALF + 5)]
    got = model.log_probs(rows, most=3)
    assert [len(x) for x in got] == [len(r) - 1 for r in rows]
    p = model.params
    for r, logs in zip(rows, got, strict=True):
        for t in range(len(r) - 1):
            seen = r[max(0, (t // A.HALF - 1) * A.HALF):t + 1]
            x = p["E"][model.input_of[seen]]
            s = x @ p["K"] @ (x[-1] @ p["Q"]) / math.sqrt(A.DIM) + p["D"][:len(seen)][::-1]
            w = np.exp(s - s.max())
            c = w / w.sum() @ (x @ p["V"])
            z = np.maximum(x[-1] @ p["X"] + c @ p["C"] + p["h"], 0) @ p["U"] + p["u"]
            z = z - z.max()
            want = z[model.class_of[r[t + 1]]] - np.log(np.exp(z).sum())
            assert abs(want - logs[t]) < 1e-4


def test_large_values_stay_finite():
    model, rng = new_model(2)
    model.params["U"] = model.params["U"] * 1e4
    model.params["Q"] = model.params["Q"] * 1e4
    assert np.isfinite(model.log_probs([rng.integers(0, 200, 100)])[0]).all()


def test_training_lowers_the_loss():
    model, rng = new_model(3)
    stream = np.tile(np.arange(40), 400)
    windows = stream[: len(stream) // (A.SPAN + 1) * (A.SPAN + 1)].reshape(-1, A.SPAN + 1)
    losses = model.train(windows, 60)
    assert np.mean(losses[-5:]) < 0.5 * losses[0]


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def check_base(rows, docs):
    """Base columns against counts in plain Python, with repeated rows."""
    train = Counter()
    for i, t in docs:
        if i is None or zlib.crc32(str(i).encode()) % 10:
            train.update(tokens(t))
    n, v = sum(train.values()), len(train)
    want = []
    for i, t in docs:
        own = tokens(t)
        base = sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        held = i is not None and zlib.crc32(str(i).encode()) % 10 == 0
        want.append((repr(i), held, len(own), sum(train[w] > 0 for w in own), n, round(base, 6)))
    got = [(repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens,
            round(r.base_score, 6)) for r in rows]
    assert sorted(got) == sorted(want)


def test_documents(small):
    rows = score_documents(small, PATH, sample_rows=150, common=500, steps=150).collect()
    check_base(rows, [(r.doc_id, r.text) for r in small.collect()])
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    held = [r for r in rows if r.held_out]
    # comparable with the base on texts that it has not seen
    assert sum(r.score for r in held) > 1.15 * sum(r.base_score for r in held)


def test_odd_rows_and_empty_table(odd, none):
    rows = score_documents(odd, PATH, steps=2).collect()
    check_base(rows, list(zip(ODD_IDS, ODD_TEXTS, strict=True)))
    assert all(math.isfinite(r.score) for r in rows)
    assert score_documents(none, PATH, steps=2).collect() == []


def test_windows_cover_every_id_of_a_task():
    rng = np.random.default_rng(4)
    for lengths in ((3,), (0, 1), (62, 1, 0), (63,), (500, 7, 64, 200)):
        ids = [rng.integers(0, 1000, n).astype("<u2") for n in lengths]
        batches = [pa.RecordBatch.from_arrays([pa.array([0]), pa.array([x.tobytes()], pa.binary())],
                                              ["row", "ids"]) for x in ids]
        stream = np.concatenate([L._sequence(x.tobytes(), "<u2") for x in ids])
        got = np.concatenate(list(L._windows(batches)))
        assert got.shape[1] == A.SPAN + 1
        pairs = {(a, b) for w in got.tolist() for a, b in zip(w, w[1:], strict=False)}
        assert {*zip(stream[:-1].tolist(), stream[1:].tolist(), strict=True)} <= pairs
    assert list(L._windows([])) == []


def test_classes_and_training_use_rows_outside_the_sample(spark, small):
    tokens = L.tokenize(small, FileBytes(spark, PATH), [])
    rows = [L._sequence(r.ids, "<u2") for r in L._training(tokens).collect()]
    counts = np.bincount(np.concatenate(rows), minlength=L.IDS)
    got = {r.key: r.n for r in tokens.filter("kind = 2").groupBy("key").agg({"n": "sum"})
           .toDF("key", "n").collect()}
    assert got == {i: counts[i] for i in np.flatnonzero(counts)}
    model = L.untrained(tokens, counts)
    assert (model.class_of[counts > 0] < A.CLASSES - 1).all()
    assert (model.class_of[counts == 0] == A.CLASSES - 1).all()
    loss = {}
    for rounds in (0, L.ROUNDS):  # a start of two steps on a few windows, then all rows
        trained = L.learn(tokens, model, counts, steps=2, windows=8, rounds=rounds)
        loss[rounds] = -np.concatenate(trained.log_probs(rows)).mean()
    assert loss[L.ROUNDS] < loss[0] - 0.02


def test_better_than_the_base_on_held_out_rows(spark):
    """Of 1,000 documents, a corpus large enough to learn from."""
    assert A.CLASSES >= 128
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = score_documents(docs, PATH).filter("held_out").collect()
    assert sum(r.score for r in held) > 0.985 * sum(r.base_score for r in held)
