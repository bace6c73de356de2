"""Language-model scores by causal self-attention over subword ids.

1. Every document is turned into ids once and written as a table, together with
   what the whole training part is counted for: each id, and the words that are
   common in a bounded sample. The other words are counted by a shuffle.
2. The classes of the ids come from counts over all training rows. The attention
   model (``attention``) is trained in numpy: a bounded draw of windows starts it
   in one task, then every training row is learned from once, in ``ROUNDS``
   rounds. In a round each task trains a copy of the model on its part of the
   rows, and the copies are averaged, weighted by their windows.
3. The ids are scored in overlapping windows, each id once. The probability of
   an id is its class's by the attention model, times its share of the class
   after the id before it (its context class), by the counts of the whole
   training part.

The base score needs each word's count. The sample's common words, a bounded
list, are looked up; the others, rare by that, are joined. The sample decides
which way a word is counted, and no result.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.llm import attention
from rankflow.llm.attention import CLASSES, CONTEXTS, SPAN, Adam, AttentionModel
from rankflow.llm.common import FileBytes, id_text, map_rows, on_workers, raw_texts
from rankflow.llm.packing import encoder
from rankflow.session import shared_dir

FOLDS = 10
SAMPLE_ROWS = 6000
COMMON = 1 << 17
WINDOWS = 40_000  # at most, of those that training starts with
STEPS = 400  # of the start
ROUNDS = 8
RATE = 2e-3  # of the first round, falling to a 16th of it
BUFFER = 96 * 16  # windows that a task holds
MARKS = 128  # frequent ids that the others are clustered by
SLICE = 1000  # rows that a worker turns into ids at a time
IDS = 1 << 16  # ids are stored in two bytes
START, END = 49406, 49407
MIX = 5.0  # counts' weight of a share that ignores the class before


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from. A null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def sample_documents(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``rows`` training documents by a hash of the doc_id, written once."""
    texts = id_text(docs)
    every = max(1, texts.count() // rows)
    chosen = F.pmod(F.xxhash64(F.lit("lm"), "doc_id"), F.lit(every)) == 0
    path = shared_dir(docs.sparkSession, "lm_sample")
    texts.filter(~held_out(F.col("doc_id")) & chosen).write.parquet(path)
    return docs.sparkSession.read.schema("doc_id long, text string").parquet(path)


def common_words(sample: DataFrame, common: int = COMMON) -> list[bytes]:
    """The most frequent words of the sample: at most ``common`` come to the driver."""
    def count():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            n = Counter(w for raw in raw_texts(batch) for w in raw.lower().split())
            return pa.RecordBatch.from_arrays(
                [pa.array(n.keys(), pa.binary()), pa.array(n.values(), pa.int64())], ["word", "n"])
        return each

    words = (map_rows(sample.select("text"), count, "word binary, n long").groupBy("word")
             .agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(common).toArrow())
    return words.column("word").to_pylist()


def _training(tokens: DataFrame) -> DataFrame:
    return tokens.filter("kind = 0 and not held").select("row", "ids")


def _streams(batches) -> Iterator[np.ndarray]:
    """The ids of row, ids batches, about a million at a time, each document
    with its start and end."""
    pending, size = [], 0
    for batch in batches:
        for ids in batch.column(1).to_pylist():
            pending.append(_sequence(ids, "<u2"))
            size += len(pending[-1])
            if size > 1_000_000:
                yield np.concatenate(pending)
                pending, size = [], 0
    if pending:
        yield np.concatenate(pending)


def _windows(batches) -> Iterator[np.ndarray]:
    """The same ids in windows of SPAN + 1 that share their end places; the last
    one of a task overlaps the one before, or repeats ids if there are too few."""
    rest, last = np.zeros(0, np.int64), None
    for stream in _streams(batches):
        rest = np.concatenate([rest, stream])
        n = (len(rest) - 1) // SPAN
        if n > 0:
            yield rest[np.arange(n)[:, None] * SPAN + np.arange(SPAN + 1)]
            last = rest[(n - 1) * SPAN:]
            rest = rest[n * SPAN:]
    if last is None and len(rest) > 1:
        yield np.resize(rest, (1, SPAN + 1))
    elif last is not None and len(rest) > 1:
        yield last[-SPAN - 1:][None]


def _count_pairs(tokens: DataFrame, keys_of: Callable[..., np.ndarray], sent) -> pa.Table:
    """key, n: how often each key occurs that ``keys_of(left, right, sent's value)``
    gives for the ids that stand side by side in all training rows."""
    def run(batches):
        keys, n = np.zeros(0, np.int32), np.zeros(0, np.int64)
        for stream in _streams(batches):
            inside = stream[:-1] != END  # not across documents
            found, m = np.unique(keys_of(stream[:-1][inside], stream[1:][inside], sent.value)
                                 .astype(np.int32), return_counts=True)
            keys, at = np.unique(np.concatenate([keys, found]), return_inverse=True)
            n = np.bincount(at, weights=np.concatenate([n, m]), minlength=len(keys)).astype(np.int64)
        for lo in range(0, len(keys), 100_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[lo:lo + 100_000], pa.int32()), pa.array(n[lo:lo + 100_000])],
                ["key", "n"])

    return (_training(tokens).mapInArrow(run, "key int, n long").groupBy("key")
            .agg(F.sum("n").alias("n")).toArrow())


def _marked(left: np.ndarray, right: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Keys of an id and the mark before it, and of an id and the mark after it."""
    before, after = number[left], number[right]
    return np.concatenate([(right * MARKS + before)[before >= 0],
                           (IDS * MARKS + left * MARKS + after)[after >= 0]])


def _in_context(left: np.ndarray, right: np.ndarray, context_of: np.ndarray) -> np.ndarray:
    return context_of[left] * IDS + right


def untrained(tokens: DataFrame, counts: np.ndarray) -> AttentionModel:
    """Classes of the ids and a new model, from counts over all training rows."""
    number = np.full(IDS, -1)
    marks = np.argsort(-counts, kind="stable")[:MARKS]
    number[marks] = np.arange(MARKS)
    found = _count_pairs(tokens, _marked, tokens.sparkSession.sparkContext.broadcast(number))
    tables = np.zeros((2, IDS, MARKS), np.float32)
    tables.reshape(-1)[found.column("key").to_numpy()] = found.column("n").to_numpy()
    return AttentionModel.new(counts, attention.classes_of(counts, *tables))


def learn(tokens: DataFrame, model: AttentionModel, counts: np.ndarray, steps: int = STEPS,
          windows: int = WINDOWS, rounds: int = ROUNDS) -> AttentionModel:
    """The trained model. ``counts``: of each id, over all training rows."""
    spark = tokens.sparkSession
    rows = _training(tokens)
    if not counts.any():
        return model
    spread = 1 << 30  # of which a share starts the training: about 1000 rows or more
    share = math.ceil(spread * min(1.0, max(windows * SPAN / counts.sum(), 1000 / counts[START])))

    def cut(batches):
        for part in _windows(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.astype("<u2").tobytes() for x in part], pa.binary())], ["ids"])

    def start(batches):
        ids = b"".join(x for batch in batches for x in batch.column(0).to_pylist())
        own, adam = model, Adam.new(model.params)
        own.train(np.frombuffer(ids, "<u2").astype(np.int64).reshape(-1, SPAN + 1), steps, adam=adam)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((own, adam))])], ["model"])

    drawn = (rows.filter(F.pmod(F.xxhash64(F.lit("lm"), "row"), F.lit(spread)) < share)
             .mapInArrow(cut, "ids binary").orderBy(F.xxhash64("ids"), "ids").limit(windows))
    # in a task of its own: Spark gives it one thread, and another one if it is lost
    got = drawn.repartition(1).mapInArrow(start, "model binary").first()
    model, adam = pickle.loads(got.model)
    for r in range(rounds):
        part = rows.filter(F.pmod(F.xxhash64(F.lit("round"), "row"), F.lit(rounds)) == r)
        rate = RATE * (1 - r / rounds * 15 / 16)
        model, adam = _round(part, model, adam, rate)
    return model


def _round(rows: DataFrame, model: AttentionModel, adam: Adam, rate: float,
           sums: int = 16) -> tuple[AttentionModel, Adam]:
    """The model after each task trained a copy on its rows, each of them once.
    At most ``sums`` sums of copies come to the driver."""
    sent = rows.sparkSession.sparkContext.broadcast(pickle.dumps((model, adam)))
    schema = "windows long, steps long, state binary"

    def out(windows: int, steps: int, state: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([windows]), pa.array([steps]), pa.array([state.tobytes()], pa.binary())],
            ["windows", "steps", "state"])

    def run(batches):
        own, moments = pickle.loads(sent.value)
        first, seen, held, size = moments.n, 0, [], 0
        for part in _windows(batches):
            held.append(part)
            size += len(part)
            if size >= BUFFER:
                own.train_once(np.concatenate(held), moments, rate)
                seen, held, size = seen + size, [], 0
        if held:
            own.train_once(np.concatenate(held), moments, rate)
            seen += size
        if seen:
            yield out(seen, moments.n - first, seen * _flat(own, moments).astype(np.float64))

    def add(batches):
        windows, steps, state = 0, 0, np.zeros(1)
        for batch in batches:
            for w, n, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                windows, steps, state = windows + w, max(steps, n), state + np.frombuffer(x)
        if windows:
            yield out(windows, steps, state)

    found = rows.mapInArrow(run, schema).repartition(sums).mapInArrow(add, schema).collect()
    sent.destroy()
    if found:
        windows = sum(x.windows for x in found)
        state = sum(np.frombuffer(x.state) for x in found) / windows
        at = 0
        for table in (model.params, adam.m, adam.s):
            for k, v in table.items():
                table[k] = state[at:at + v.size].reshape(v.shape).astype(np.float32)
                at += v.size
        adam.n += max(x.steps for x in found)
    return model, adam


def _flat(model: AttentionModel, adam: Adam) -> np.ndarray:
    return np.concatenate([v.ravel() for t in (model.params, adam.m, adam.s) for v in t.values()])


def _sequence(ids: bytes, kind: str) -> np.ndarray:
    return np.concatenate([[START], np.frombuffer(ids, kind), [END]]).astype(np.int64)


TOKENS = ("row long, doc_id long, held boolean, n_tokens long, ids binary, common binary, "
          "rare array<struct<word:binary,n:long>>, kind int, key long, n long")


def tokenize(docs: DataFrame, vocabulary: FileBytes, common: list[bytes]) -> DataFrame:
    """The token table, written to the shared folder: a row of kind 0 for each
    document; kinds 1 and 2 are each partition's counts of common words and of
    ids, of training rows only."""
    spark = docs.sparkSession
    on_workers(spark)
    sent = spark.sparkContext.broadcast(common)

    def run(batches):
        encode = encoder(vocabulary.value).encode
        number = {w: i for i, w in enumerate(sent.value)}.get
        n_common = np.zeros(len(sent.value), np.int64)
        n_ids = np.zeros(IDS, np.int64)
        pending: list[np.ndarray] = []
        words_seen: list[np.ndarray] = []
        waiting = 0

        def settle() -> None:
            nonlocal n_common, n_ids
            if pending:
                n_common += np.bincount(np.concatenate(words_seen), minlength=len(n_common))
                n_ids += np.bincount(np.concatenate(pending), minlength=IDS)
                words_seen.clear()
                pending.clear()

        for batch in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
            held = batch.column(3).to_pylist()
            n_tokens, ids_of, common_of, words_of, n_of, ends = [], [], [], [], [], [0]
            for raw, out in zip(raw_texts(batch), held, strict=True):
                words = raw.lower().split()
                ids = np.frombuffer(encode(raw), "<u4")
                found = [*map(number, words)]
                known = [i for i in found if i is not None]
                if len(known) < len(words):
                    rare = Counter(w for w, i in zip(words, found, strict=True) if i is None)
                    words_of += rare.keys()
                    n_of += rare.values()
                ends.append(len(words_of))
                known = np.array(known, "<u4")
                n_tokens.append(len(words) + 1)
                ids_of.append(ids.astype("<u2").tobytes())
                common_of.append(known.tobytes())
                if not out:
                    words_seen.append(known)
                    pending.append(np.concatenate([[START], ids, [END]]).astype(np.int32))
                    waiting += len(ids) + 2
                    if waiting > 1_000_000:
                        settle()
                        waiting = 0
            rare = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(words_of, pa.binary()), pa.array(n_of, pa.int64())], ["word", "n"]))
            yield _batch(len(held), row=batch.column(0), doc_id=batch.column(1),
                         held=batch.column(3), n_tokens=n_tokens, ids=ids_of,
                         common=common_of, rare=rare, kind=[0] * len(held))
        settle()
        for kind, n in ((1, n_common), (2, n_ids)):
            used = np.flatnonzero(n)
            if len(used):
                yield _batch(len(used), kind=[kind] * len(used), key=used, n=n[used])

    path = shared_dir(spark, "lm_tokens")
    rows = id_text(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text",
                                held_out(F.col("doc_id")).alias("held"))
    rows.mapInArrow(run, TOKENS).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(TOKENS).parquet(path)


_TYPES = {"row": pa.int64(), "doc_id": pa.int64(), "held": pa.bool_(), "n_tokens": pa.int64(),
          "ids": pa.binary(), "common": pa.binary(),
          "rare": pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])),
          "kind": pa.int32(), "key": pa.int64(), "n": pa.int64()}


def _batch(rows: int, **columns) -> pa.RecordBatch:
    arrays = []
    for name, kind in _TYPES.items():
        x = columns.get(name)
        arrays.append(pa.nulls(rows, kind) if x is None
                      else x if isinstance(x, pa.Array) else pa.array(x, kind))
    return pa.RecordBatch.from_arrays(arrays, list(_TYPES))


def _shares(class_of: np.ndarray, counted: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Log share of its class that an id has after a context class: rows are
    those, a column for each counted id and a last one for all others; column of
    each id."""
    keys = counted.column("key").to_numpy()
    before, ids = keys // IDS, keys % IDS
    seen, at = np.unique(ids, return_inverse=True)
    table = np.zeros((CONTEXTS, len(seen) + 1))
    table[before, at] = counted.column("n").to_numpy()
    column = np.full(IDS, len(seen))
    column[seen] = np.arange(len(seen))
    kind = np.append(class_of[seen], CLASSES - 1)
    total = table.sum(axis=0)
    size = np.bincount(class_of, minlength=CLASSES)
    plain = (total + 0.1) / (np.bincount(kind, weights=total, minlength=CLASSES)
                             + 0.1 * size)[kind]
    by_class = np.zeros((CONTEXTS, CLASSES))
    for k in range(CLASSES):
        by_class[:, k] = table[:, kind == k].sum(axis=1)
    table += MIX * plain
    table /= by_class[:, kind] + MIX
    return np.log(table, out=table).astype(np.float32), column


def _scored(tokens: DataFrame, model: AttentionModel, shares: np.ndarray, column: np.ndarray,
            n_common: np.ndarray) -> DataFrame:
    """row, doc_id, held, n_tokens, known, base, score: common words only in
    ``known`` and in ``base``, which is the sum of log10(count + 0.1)."""
    sent = tokens.sparkSession.sparkContext.broadcast((model, shares, column, n_common))

    def make():
        model, shares, column, n_common = sent.value
        logs = np.log10(n_common + 0.1)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            known, base, score = [], [], []
            for common in batch.column(5).to_pylist():
                at = np.frombuffer(common, "<u4")
                known.append(int(np.count_nonzero(n_common[at])))
                base.append(float(logs[at].sum()))
            pending, size = [], 0
            for ids in batch.column(4).to_pylist():
                pending.append(_sequence(ids, "<u2"))
                size += len(pending[-1])
                if size > 100_000:
                    score += _text_scores(pending, model, shares, column)
                    pending, size = [], 0
            score += _text_scores(pending, model, shares, column)
            return pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(known, pa.int64()), pa.array(base, pa.float64()),
                 pa.array(score, pa.float64())],
                ["row", "doc_id", "held", "n_tokens", "known", "base", "score"])
        return each

    rows = tokens.filter("kind = 0").select("row", "doc_id", "held", "n_tokens", "ids", "common")
    return map_rows(rows, make, "row long, doc_id long, held boolean, n_tokens long, "
                                "known long, base double, score double")


def _text_scores(rows: list[np.ndarray], model: AttentionModel, shares: np.ndarray,
                 column: np.ndarray) -> list[float]:
    """log10 probability of each sequence after its first id."""
    out = []
    for seq, logs in zip(rows, model.log_probs(rows), strict=True):
        own = shares[model.context_of[seq[:-1]], column[seq[1:]]]
        out.append((float(logs.sum(dtype=np.float64)) + float(own.sum(dtype=np.float64)))
                   / math.log(10))
    return out


def score_documents(docs: DataFrame, path: str, sample_rows: int = SAMPLE_ROWS,
                    common: int = COMMON, steps: int = STEPS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a
    row for each input row.

    Whole texts; a null text is empty and has its end as the one token. Without
    training rows every word is unknown and the model untrained, its scores
    still log10 probabilities. Repeated rows and null doc_ids all come back (a
    null doc_id is a training row), an empty table gives no rows, other columns
    are ignored. ``path`` is a vocabulary with word ends and ids below 65,536.
    """
    spark = docs.sparkSession
    vocabulary = FileBytes(spark, path)
    words = common_words(sample_documents(docs, sample_rows), common)
    tokens = tokenize(docs, vocabulary, words)
    counted = (tokens.filter("kind > 0").groupBy("kind", "key")  # common + ids rows
               .agg(F.sum("n").alias("n")).toArrow())

    def of(kind: int, size: int) -> np.ndarray:
        own = counted.filter(pa.compute.equal(counted.column("kind"), kind))
        out = np.zeros(size, np.int64)
        out[own.column("key").to_numpy()] = own.column("n").to_numpy()
        return out

    n_common, n_ids = of(1, len(words)), of(2, IDS)
    model = untrained(tokens, n_ids)
    contexts = spark.sparkContext.broadcast(model.context_of)
    shares, column = _shares(model.class_of, _count_pairs(tokens, _in_context, contexts))
    model = learn(tokens, model, n_ids, steps)

    rare = (tokens.filter("kind = 0").select("row", "held", F.explode("rare").alias("x"))
            .select("row", "held", "x.*"))
    path = shared_dir(spark, "lm_words")
    (rare.filter(~F.col("held")).groupBy("word").agg(F.sum("n").alias("c"))
     .write.option("compression", "zstd").parquet(path))
    words = spark.read.schema("word binary, c long").parquet(path)
    total = tokens.filter("kind = 0 and not held").agg(
        F.count(F.lit(1)).alias("ends"), F.sum("n_tokens").alias("n")).first()
    ends, train_tokens = total.ends, total.n or 0
    distinct = int(np.count_nonzero(n_common)) + words.count() + (ends > 0)
    least = math.log10(train_tokens + 0.1 * (distinct + 1))

    seen = F.coalesce(F.col("c"), F.lit(0))
    of_rare = (rare.join(words, "word", "left").groupBy("row").agg(
        F.sum(F.when(seen > 0, F.col("n")).otherwise(0)).alias("rare_known"),
        F.sum(F.log10(seen + 0.1) * F.col("n")).alias("rare_base")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return _scored(tokens, model, shares, column, n_common).join(of_rare, "row", "left").select(
        "doc_id", F.col("held").alias("held_out"), "n_tokens",
        (F.col("known") + zero("rare_known") + F.lit(int(ends > 0))).cast("long").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("rare_base") + F.lit(math.log10(ends + 0.1))
         - F.col("n_tokens") * F.lit(least)).alias("base_score"),
        "score")
