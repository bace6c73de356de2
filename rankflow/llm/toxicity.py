"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

* Examples: at most ``examples`` labelled rows of each class, the first by a
  hash of their doc_id, one a distinct text. That sample is the only bound;
  document counts and frequencies are taken over all documents.
* Terms: all words of the examples, and word beginnings of ``BEGINNINGS``
  characters; their number is bounded by the examples alone. A term weighs its
  inverse document frequency times chi2 / (chi2 + ``HALF``), chi2 (with Yates'
  correction, as many terms are rare) telling how far it keeps the classes of
  the examples apart: without that the cosine would mostly measure the prose. A
  term spread over the classes as chance would has weight zero, adds nothing to
  any cosine, and so is not stored.
* Index: examples with equal vectors are one entry; entries lie in blocks of
  ``BLOCK``, and each posting list knows its largest weight in each block. The
  longest lists, of terms in a ``SHARE`` of the entries or more, are also kept
  as rows of a matrix and summed for ``TEXTS`` queries at a time by one product.
  The other terms of a query are summed over their postings, but for the light
  ones, which can add ``LIGHT`` of the whole at most and the least for a
  posting: of them only the block's largest weights are. The best k sums are
  compared in full; an entry whose sum and block bound cannot reach the least of
  these is left and the others are compared in full too, so the neighbours are
  exact. All examples at the k-th similarity count, so ties do not depend on any
  order.
* Score: votes weighted by similarity, each class weighted back to its share of
  the labelled rows, shrunk towards the share of toxic rows among examples
  without any term, which is also the score of texts without one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import id_text, map_rows, on_workers, raw_texts
from rankflow.session import materialize

EXAMPLES = 4096
BEGINNINGS = (4, 5, 6)
HALF = 30.0
NEIGHBOURS = 25
BLOCK = 64
LIGHT = 0.003
SHARE, LONGEST_LISTS = 1 / 16, 1024  # lists that are rows of a matrix, and how many at most
TEXTS = 128  # scored at a time
CHUNK, CHUNK_BYTES = 512, 1 << 20  # texts whose terms are counted at a time
MARGIN = 1e-5  # more than single precision and rounding lose in a cosine
SHRINK = 0.5
CLEAN_PRIOR = 10  # clean examples assumed besides, so that a few labels reject nobody
FOLDS = 5

EDGES = bytes(b for b in range(128) if not chr(b).isalpha())


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from. A null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def word_counts(raw: bytes) -> Counter:
    """Words without the ASCII signs and digits around them, A-Z lower-cased."""
    words = Counter([w.strip(EDGES) for w in raw.lower().split()])
    words.pop(b"", None)
    return words


def all_terms(words: Counter) -> set[tuple[int, bytes]]:
    """Kind 0 is a word, kind k the first k bytes of a longer one."""
    out = {(0, w) for w in words}
    for k in BEGINNINGS:
        out.update((k, w[:k]) for w in words if len(w) > k)
    return out


class Terms:
    """The terms of the examples, by number."""

    def __init__(self, kinds: np.ndarray, names: pa.Array):
        self.size = len(names)
        self.by_kind = {}  # names and their numbers; the last number is of all other words
        for k in (0, *BEGINNINGS):
            own = np.flatnonzero(kinds == k)
            self.by_kind[k] = (names.take(pa.array(own)), np.append(own, -1).astype(np.int32))

    def _numbers(self, words: pa.Array, kind: int) -> np.ndarray:
        names, numbers = self.by_kind[kind]
        return numbers[pc.index_in(words, value_set=names).fill_null(-1).to_numpy()]

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ascending numbers of the terms in each text, how often each is there,
        and where a text's own begin and end."""
        tokens = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        coded = tokens.flatten().dictionary_encode()  # a word is looked up once
        words = pc.ascii_trim(coded.dictionary, EDGES.decode()).cast(pa.large_binary())
        size = pc.binary_length(words).to_numpy()
        terms = [self._numbers(words, 0)]
        for k in BEGINNINGS:
            terms.append(np.where(size > k, self._numbers(pc.binary_slice(words, 0, k), k), -1))
        ids = np.stack(terms, axis=1)[coded.indices.to_numpy()]
        text = np.repeat(np.arange(len(texts)), pc.list_value_length(tokens).to_numpy())
        key = np.sort((ids + text[:, None] * self.size)[ids >= 0])
        first = np.flatnonzero(np.diff(key, prepend=-1))
        n = np.diff(first, append=len(key))
        key = key[first]
        return (key % max(1, self.size), n,
                np.searchsorted(key, np.arange(len(texts) + 1) * self.size))


def _chunks(batch: pa.RecordBatch, name: str = "text") -> Iterator[pa.Array]:
    """A text column, nulls empty, in parts of bounded rows and bytes (a longer
    text is a part of its own)."""
    column = batch.column(batch.schema.get_field_index(name))
    column = pc.cast(column, options=pc.CastOptions(pa.large_string(), allow_invalid_utf8=True))
    column = column.fill_null("")
    first, held = 0, 0
    for i, size in enumerate(pc.binary_length(column).to_pylist()):
        if i > first and (i - first == CHUNK or held + size > CHUNK_BYTES):
            yield column[first:i]
            first, held = i, 0
        held += size
    if len(column):
        yield column[first:]


@dataclass
class Rows:
    """Pairs of arrays, one after the other: those of an entry by number."""

    start: np.ndarray
    term: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, pairs: list[tuple], value_type: np.dtype) -> Rows:
        out = cls(np.cumsum([0] + [len(t) for t, _ in pairs]), None, None)
        out.term = np.empty(out.start[-1], np.int32)
        out.value = np.empty(out.start[-1], value_type)
        for (t, v), lo in zip(pairs, out.start.tolist(), strict=False):
            out.term[lo:lo + len(t)] = t
            out.value[lo:lo + len(t)] = v
        return out

    def __len__(self) -> int:
        return len(self.start) - 1

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.start[i], self.start[i + 1])
        return self.term[at], self.value[at]


@dataclass
class BlockMaxIndex:
    """Exact cosine neighbours of sparse vectors of length one."""

    terms: int
    rows: Rows | list[tuple]  # of each entry, ascending terms and their weights
    weights: np.ndarray  # of each entry, toxic and clean votes
    block: int = BLOCK
    share: float = SHARE
    book: np.ndarray | None = None  # where rows have numbers of weights, the weights
    scale: np.ndarray | None = None  # of terms, that weights are to be multiplied by

    def __post_init__(self):
        if not isinstance(self.rows, Rows):
            self.rows = Rows.of(self.rows, np.float64)
        if self.scale is None:
            self.scale = np.ones(self.terms)
        entries, kind = len(self.rows), np.min_scalar_type(len(self.rows))
        self.blocks = -(-entries // self.block)
        self.count = self.weights.sum(axis=1)
        self.of_row = np.arange(entries) // self.block
        often = np.zeros(self.terms, np.int64)
        for e in range(entries):
            often[self.rows[e][0]] += 1
        longest = np.argsort(-often, kind="stable")[:LONGEST_LISTS]
        longest = longest[(often[longest] > 0) & (often[longest] >= self.share * entries)]
        self.place = np.full(self.terms, -1, np.int32)  # of a term's list in the matrix
        self.place[longest] = np.arange(len(longest))
        self.matrix = np.zeros((len(longest), entries), np.float32)  # for bounds, with a margin
        often[longest] = 0
        self.list = np.concatenate([[0], np.cumsum(often)])
        self.entry = np.empty(self.list[-1], kind)
        self.value = np.empty(self.list[-1], np.float32)
        self.norm = np.ones(entries)
        free = self.list[:-1].copy()
        for e in range(entries):  # one at a time: a worker's memory holds the index once
            ids, v = self.rows[e]
            v = self._plain(v) * self.scale[ids]
            self.norm[e] = np.sqrt(np.sum(v * v)) or 1.0
            v /= self.norm[e]
            place = self.place[ids]
            inside = place >= 0
            self.matrix[place[inside], e] = v[inside]
            ids, v = ids[~inside], v[~inside]
            self.entry[free[ids]] = e
            self.value[free[ids]] = v
            free[ids] += 1
        # a run is one term's postings in one block, with the largest weight there
        place = np.floor_divide(self.entry, self.block, dtype=np.int32)
        first = np.diff(place, prepend=place[:1]) != 0
        first[self.list[:-1][often > 0]] = True
        first = np.flatnonzero(first)
        self.run_block = place[first]
        self.run_top = np.maximum.reduceat(self.value, first) if len(first) else self.value
        self.runs = np.searchsorted(first, self.list)
        self.top = np.zeros(self.terms)
        if len(first):
            self.top[often > 0] = np.maximum.reduceat(self.run_top, self.runs[:-1][often > 0])
        self.top[longest] = self.matrix.max(axis=1, initial=0)
        self.query = np.zeros(self.terms)

    def nearest(self, query: dict[int, float], k: int) -> list[tuple[float, int]]:
        """(similarity, entry) of the entries that hold the k nearest examples,
        and of all others as near as the last of these; zero similarity never."""
        ids = np.array(sorted(query), np.int64)
        score, entry = self.search([(ids, np.array([query[t] for t in ids.tolist()]))], k)[0]
        return list(zip(score.tolist(), entry.tolist(), strict=True))

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]],
               k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of each query's ascending terms and their weights, as two
        arrays. Working memory is a number for each query and entry."""
        asked = np.zeros((len(queries), len(self.matrix)), np.float32)
        for own, (ids, values) in zip(asked, queries, strict=True):
            place = self.place[ids]
            own[place[place >= 0]] = values[place >= 0]
        return [self._search(ids, values, k, sums)
                for sums, (ids, values) in zip(asked @ self.matrix, queries, strict=True)]

    def _search(self, ids: np.ndarray, values: np.ndarray, k: int,
                sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``sums``: over the terms of the matrix, for each entry."""
        limit = LIGHT * (values @ self.top[ids])
        self.query[ids] = values * self.scale[ids]
        all_ids, other = ids, self.place[ids] < 0
        ids, values = ids[other], values[other]
        most, long = values * self.top[ids], self.list[ids + 1] - self.list[ids]
        order = np.argsort(most / np.maximum(long, 1))
        light = np.zeros(len(ids), bool)
        light[order] = np.cumsum(most[order]) <= limit
        entry, part = self._postings(self.list, self.entry, self.value, ids[~light], values[~light])
        sums += np.bincount(entry, part, len(sums))
        place, part = self._postings(self.runs, self.run_block, self.run_top, ids[light],
                                     values[light])
        bound = np.bincount(place, part, self.blocks).astype(np.float32)
        # an entry holds an example at least, so k entries hold the k nearest
        first = (np.argpartition(sums, -k)[-k:] if len(sums) > k else np.arange(len(sums)))
        score = self._cosine(first)
        least = score.min() - MARGIN if len(sums) > k else 0.0
        sums += bound[self.of_row]
        sums[first] = 0.0
        rest = np.flatnonzero((sums > 0) & (sums >= least))
        score = np.round(np.concatenate([score, self._cosine(rest)]), 9)
        entry = np.concatenate([first, rest])
        self.query[all_ids] = 0.0
        best = np.lexsort((entry, -score))
        best = best[score[best] > 0]
        score, entry = score[best], entry[best]
        enough = int(np.searchsorted(np.cumsum(self.count[entry]), k))
        if enough < len(score):
            stay = int(np.searchsorted(-score, -score[enough], side="right"))
            score, entry = score[:stay], entry[:stay]
        return score, entry

    @staticmethod
    def _postings(start: np.ndarray, where: np.ndarray, value: np.ndarray, ids: np.ndarray,
                  weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of some terms' postings or runs, and what they add."""
        first, size = start[ids], start[ids + 1] - start[ids]
        at = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
        part = value.take(at, mode="clip")
        part *= np.repeat(weights.astype(np.float32), size)
        return where.take(at, mode="clip"), part

    def has(self, entry: int, ids: np.ndarray) -> np.ndarray:
        """Which of ascending terms an entry has."""
        own = self.rows[entry][0]
        return own[np.minimum(np.searchsorted(own, ids), len(own) - 1)] == ids

    def _plain(self, value: np.ndarray) -> np.ndarray:
        return value if self.book is None else self.book.take(value, mode="clip")

    def _cosine(self, entry: np.ndarray) -> np.ndarray:
        """Of the query with each of the entries, over all their terms."""
        rows = map(self.rows.__getitem__, entry.tolist())
        return np.array([self.query.take(t, mode="clip") @ self._plain(v) for t, v in rows]
                        ) / self.norm[entry]


@dataclass
class ToxicityModel:
    """The weighted terms and the labelled examples."""

    kinds: np.ndarray
    names: pa.Array
    term_weight: np.ndarray
    rows: Rows  # of each entry, terms and numbers of 1 + log of how often each is there
    book: np.ndarray  # these by number
    votes: np.ndarray  # toxic and clean examples of each entry
    witnesses: list[list[int]]  # doc_ids of up to three examples of each entry
    class_weight: tuple[float, float]
    prior: float
    neighbours: int = NEIGHBOURS

    def ready(self) -> None:
        self.terms = Terms(self.kinds, self.names)
        self.index = BlockMaxIndex(len(self.names), self.rows, self.votes, book=self.book,
                                   scale=self.term_weight)

    def vector(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        w = (1 + np.log(counts)) * self.term_weight[ids]
        norm = np.sqrt(np.sum(w * w))
        return w / norm if norm else w

    def score(self, texts: pa.Array) -> list[tuple[float, list[int], list[bytes]]]:
        """Of each text the score, doc_ids of the nearest examples, and the terms
        shared with them."""
        terms, counts, ends = self.terms.counts(texts)
        queries = [(terms[lo:hi], self.vector(terms[lo:hi], counts[lo:hi]))
                   for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        return [self._vote(*query, *near) for lo in range(0, len(queries), TEXTS)
                for some in [queries[lo:lo + TEXTS]]
                for query, near in zip(some, self.index.search(some, self.neighbours), strict=True)]

    def _vote(self, ids: np.ndarray, query: np.ndarray, near: np.ndarray,
              entry: np.ndarray) -> tuple[float, list[int], list[bytes]]:
        if not len(near):
            return self.prior, [], []
        yes, no = near @ self.votes[entry] * self.class_weight
        score = float((yes + SHRINK * self.prior) / (yes + no + SHRINK))
        first = int(entry[0])
        shared = np.flatnonzero(self.index.has(first, ids))
        shared = ids[shared[np.argsort(-query[shared], kind="stable")[:5]]].tolist()
        return score, self.witnesses[first], [self.names[t].as_py() + b"*" * bool(self.kinds[t])
                                              for t in shared]


def _local(model: ToxicityModel) -> ToxicityModel:
    if not hasattr(model, "index"):
        model.ready()
    return model


def train(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES,
          neighbours: int = NEIGHBOURS) -> ToxicityModel:
    """Learn from the labelled rows that are not held out. Null labels and
    labels without a document teach nothing; of several labels of one doc_id a
    toxic one holds. Without any labelled row every score is 0."""
    spark = docs.sparkSession
    texts = id_text(docs)
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.col("toxic").cast("int").alias("toxic"))
             .dropna().filter(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    have = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    draw = [known.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples)
            for y in (1, 0)]
    chosen = materialize(
        texts.join(F.broadcast(draw[0].unionByName(draw[1])), "doc_id")
        # 2 * examples rows, as a doc_id is an example with one of its texts at most
        .groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("one"),
                               F.max("toxic").alias("toxic"))
        .select("doc_id", "one.text", "toxic").groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")),
        "toxicity_examples")
    got = {r.toxic: r.n for r in chosen.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    weight = tuple(have.get(y, 0) / got[y] if got.get(y) else 0.0 for y in (1, 0))
    kinds, names, apart = _weigh_terms(chosen, got)
    total = texts.count()
    idf = np.log((total + 1) / (_frequencies(texts, kinds, names) + 0.5))
    model = ToxicityModel(kinds, names, idf * apart, Rows.of([], np.uint8), np.zeros(0),
                          np.zeros((0, 2)), [], weight, 0.0, neighbours)
    _add_examples(model, chosen)
    return model


def _weigh_terms(chosen: DataFrame,
                 got: dict[int, int]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Kind, name and share of the weight of each term of the examples, those
    that tell the classes apart best first. To the driver come at most the
    distinct terms of 2 * ``examples`` texts."""
    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            n: tuple[Counter, Counter] = (Counter(), Counter())
            for raw, y in zip(raw_texts(batch), batch.column(1).to_pylist(), strict=True):
                n[y].update(all_terms(word_counts(raw)))
            keys = list({**n[0], **n[1]})
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in keys], pa.int32()),
                 pa.array([t for _, t in keys], pa.binary()),
                 pa.array([n[1][x] for x in keys], pa.int64()),
                 pa.array([n[0][x] for x in keys], pa.int64())],
                ["kind", "term", "toxic", "clean"])
        return each

    yes, no = got.get(1, 0), got.get(0, 0)
    if not yes or not no:
        return np.zeros(0, np.int64), pa.array([], pa.large_binary()), np.zeros(0)
    a, b = F.col("toxic"), F.col("clean")
    c, d = F.lit(yes) - a, F.lit(no) - b
    apart = F.greatest(F.abs(a * d - b * c) - (yes + no) / 2, F.lit(0.0))
    chi2 = (F.lit(yes + no) * F.pow(apart, F.lit(2))
            / ((a + b) * (c + d + 1e-9) * F.lit(yes) * F.lit(no)))
    found = (map_rows(chosen.select("text", "toxic"), make,
                      "kind int, term binary, toxic long, clean long")
             .groupBy("kind", "term").agg(F.sum("toxic").alias("toxic"),
                                          F.sum("clean").alias("clean"))
             .withColumn("chi2", chi2).filter("chi2 > 0")
             .orderBy(F.desc("chi2"), "kind", "term").select("kind", "term", "chi2").toArrow())
    chi2 = found["chi2"].to_numpy()
    names = found["term"].cast(pa.large_binary()).combine_chunks()
    return found["kind"].to_numpy().astype(np.int64), names, chi2 / (chi2 + HALF)


def _frequencies(texts: DataFrame, kinds: np.ndarray, names: pa.Array) -> np.ndarray:
    """In how many documents each term occurs: one row a term to the driver."""
    # terms of the examples' texts
    sent = texts.sparkSession.sparkContext.broadcast((kinds, names))

    def make():
        terms = Terms(*sent.value)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            n = np.zeros(len(sent.value[1]), np.int64)
            for texts in _chunks(batch):
                n += np.bincount(terms.counts(texts)[0], minlength=len(n))
            seen = np.flatnonzero(n)
            return pa.RecordBatch.from_arrays(
                [pa.array(seen, pa.int32()), pa.array(n[seen], pa.int64())], ["term", "n"])
        return each

    out = np.zeros(len(names))
    if len(names):
        found = map_rows(texts.select("text"), make, "term int, n long")
        found = found.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
        out[found["term"].to_numpy()] = found["n"].to_numpy()
    return out


def _add_examples(model: ToxicityModel, chosen: DataFrame) -> None:
    """The examples' vectors: at most 2 * ``examples`` rows of a text's terms.
    Equal vectors become one entry; entries in the order of their strongest
    terms make alike ones neighbours."""
    sent = chosen.sparkSession.sparkContext.broadcast((model.kinds, model.names))

    def make():
        terms = Terms(*sent.value)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = []
            for texts in _chunks(batch):
                ids, n, ends = terms.counts(texts)
                found += [(ids[lo:hi], n[lo:hi]) for lo, hi in
                          zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            return pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2),
                 pa.array([t.astype(np.int32).tobytes() for t, _ in found], pa.binary()),
                 pa.array([n.astype(np.int32).tobytes() for _, n in found], pa.binary())],
                ["doc_id", "toxic", "term", "n"])
        return each

    rows = map_rows(chosen.select("text", "doc_id", "toxic"), make,
                    "doc_id long, toxic int, term binary, n binary").toArrow()
    groups: dict[tuple[bytes, bytes], tuple[list[int], list[int]]] = {}
    for doc_id, toxic, term, n in zip(*[rows[c].to_pylist() for c in rows.column_names],
                                      strict=True):
        groups.setdefault((term, n), ([], []))[toxic != 1].append(doc_id)
    bare = groups.pop((b"", b""), ([], []))
    yes, no = (len(x) * w for x, w in zip(bare, model.class_weight, strict=True))
    model.prior = yes / (yes + no + CLEAN_PRIOR)
    entries = sorted(((np.frombuffer(term, np.int32), np.frombuffer(n, np.int32), votes)
                      for (term, n), votes in groups.items()),
                     key=lambda e: (e[0].tolist()[:16], e[0].tobytes(), e[1].tobytes()))
    often = np.unique(np.concatenate([np.zeros(0, np.int32)]
                                     + [np.unique(n) for _, n, _ in entries]))
    model.book = 1 + np.log(often)
    model.rows = Rows.of([(t, np.searchsorted(often, n)) for t, n, _ in entries],
                         np.min_scalar_type(len(often)))
    model.votes = np.array([[len(g[0]), len(g[1])] for *_, g in entries], float).reshape(-1, 2)
    model.witnesses = [sorted(g[0] + g[1])[:3] for *_, g in entries]


def scores(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, predicted, nearest, evidence: a row for each
    input row.

    Whole texts; null and empty texts have no terms and the score of such texts
    among the examples. ``nearest`` has doc_ids of up to three nearest labelled
    examples, ``evidence`` the terms shared with them. Repeated rows and null
    doc_ids all come back, an empty table gives no rows, other columns are
    ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        score = _local(sent.value).score

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            got = [x for texts in _chunks(batch) for x in score(texts)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2),
                 pa.array([g[0] for g in got], pa.float64()),
                 pa.array([int(g[0] >= 0.5) for g in got], pa.int32()),
                 pa.array([g[1] for g in got], pa.list_(pa.int64())),
                 pa.array([[t.decode(errors="replace") for t in g[2]] for g in got],
                          pa.list_(pa.string()))],
                ["doc_id", "held_out", "score", "predicted", "nearest", "evidence"])
        return each

    rows = id_text(docs).withColumn("held_out", held_out(F.col("doc_id")))
    return map_rows(rows, make, "doc_id long, held_out boolean, score double, predicted int, "
                                "nearest array<long>, evidence array<string>")


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns as they
    came. Rows are decided in place: nothing is shuffled or joined."""
    on_workers(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    # ``mapInArrow`` looks columns up by name, which dots and quotes would break
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = plain.columns[docs.columns.index("text")]

    def run(batches):
        score = _local(sent.value).score
        for batch in batches:
            first = 0
            for texts in _chunks(batch, text):  # a chunk at a time: no batch is held twice
                keep = [got < threshold for got, *_ in score(texts)]
                yield batch.slice(first, len(texts)).filter(pa.array(keep, pa.bool_()))
                first += len(texts)

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
