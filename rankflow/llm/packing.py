"""Best-fit packing of token sequences, planned on a histogram of lengths.

1. Every document becomes ids and an end id; longer ones are cut.
2. The number of pieces of each length, at most ``capacity`` rows, goes to the
   driver, which plays best-fit decreasing on these counts: bins with the same
   room are one entry, however many they are.
3. The plan says which ranks within a length go to which bins. Pieces are
   ranked within their length, by bucket so that a length with a third of all
   rows is no single task, and take their slots by a join on length and rank.

An entry's room falls below half with each visit, and a length leaves at most
three new entries, so the plan has fewer than 3 * capacity * log2(capacity) + 3
* capacity rows (75,000 at 2,048): that bounds the broadcast.
"""

from __future__ import annotations

import json
import struct
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import astuple, dataclass
from itertools import accumulate, groupby

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.bpe_codec import byte_symbols
from rankflow.llm.common import FileBytes, Remembered, id_text, on_workers, partitions, raw_texts
from rankflow.session import materialize

CAPACITY = 2048
#: documents that a worker holds as objects at a time, and bytes of ids it holds back
READ_ROWS, EMIT_BYTES = 500, 4 << 20
#: words that a worker remembers
REMEMBER = 400_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class LibraryEncoder:
    """The tokenizers library's ids of whole texts. No token of a vocabulary
    with word ends crosses white space, so each chunk between is encoded once
    and remembered, A-Z already lower-cased."""

    def __init__(self, data: bytes, remember: int = REMEMBER):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(data.decode())
        self.marks = [t["content"].lower().encode() for t in json.loads(data)["added_tokens"]]
        # signs and letters that are NFC already and lower-cased one by one
        self.simple = regex.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
        letters = "a-z\u00df-\u00f6\u00f8-\u00ff"
        self.plain = regex.compile(
            rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[0-9]|[^{letters}0-9]+")
        self.symbols = dict(enumerate(byte_symbols()))
        self.pieces = Remembered(self._piece, remember // 2)
        self.chunks = Remembered(self._chunk, remember)

    def _piece(self, piece: str) -> bytes:
        ids = [t.id for t in self.tokenizer.model.tokenize(piece)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if self.simple.fullmatch(text):
            pieces = self.plain.findall(text.lower())
            if not text.isascii():
                pieces = [p.encode().decode("latin-1").translate(self.symbols) for p in pieces]
        else:
            text = self.tokenizer.normalizer.normalize_str(text)
            pieces = [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        return b"".join(map(self.pieces.__getitem__, pieces))

    def encode(self, raw: bytes) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        low = raw.lower()
        if any(m in low for m in self.marks):  # special strings are the library's matter
            ids = self.tokenizer.encode(raw.decode(), add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        return b"".join(map(self.chunks.__getitem__, low.split()))


_encoders: dict[tuple[int, int], LibraryEncoder] = {}


def encoder(data: bytes, remember: int = REMEMBER) -> LibraryEncoder:
    """One a worker, vocabulary and size of its memory."""
    key = hash(data), remember
    if key not in _encoders:
        _encoders[key] = LibraryEncoder(data, remember)
    return _encoders[key]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0,
           with_ids: bool = False, remember: int = REMEMBER) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and with ``with_ids`` ids: each
    document's ids and ``end_id``, cut every ``capacity`` ids. A worker keeps
    the ids of up to twice ``remember`` words (80 MB at the default)."""
    data = FileBytes(docs.sparkSession, path)
    schema = PIECES + (", ids array<int>" if with_ids else "")
    names = [x.split()[0] for x in schema.split(", ")]
    end = struct.pack("<I", end_id)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True))
        arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                  *[pa.array(c, pa.int64()) for c in cols[2:5]]]
        if with_ids:
            flat = pa.Array.from_buffers(pa.int32(), sum(cols[3]),
                                         [None, pa.py_buffer(b"".join(cols[5]))])
            ends = [0, *accumulate(cols[3])]
            arrays.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat))
        return pa.RecordBatch.from_arrays(arrays, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(data.value, remember).encode
        for whole in batches:
            for low in range(0, whole.num_rows, READ_ROWS):
                batch, rows, held = whole.slice(low, READ_ROWS), [], 0
                for doc, raw in zip(batch.column(0).to_pylist(), raw_texts(batch), strict=True):
                    ids = encode(raw) + end
                    for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at:at + 4 * capacity]
                        row = (doc, n, at // 4, len(part) // 4, zlib.crc32(part))
                        rows.append((*row, part) if with_ids else row)
                        held += len(part) if with_ids else 0
                        if held >= EMIT_BYTES:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    on_workers(docs.sparkSession)
    return id_text(docs).mapInArrow(run, schema)


@dataclass(frozen=True)
class Slots:
    """Ranks from ``first_rank`` on of pieces of ``length`` fill ``bins`` bins
    from ``first_bin`` on, ``per_bin`` side by side in each from ``offset`` on."""

    length: int
    first_rank: int
    ranks: int
    per_bin: int
    first_bin: int
    offset: int


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Slots]:
    """Best-fit decreasing over counts: the longest first, each to the fullest
    bin that it fits in, all bins with equal room at a time."""
    out: list[Slots] = []
    by_room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room: (first bin, bins)
    rooms: list[int] = []
    opened = 0

    def put(room: int, first: int, bins: int) -> None:
        if bins and room:
            if not by_room[room]:
                insort(rooms, room)
            by_room[room].append((first, bins))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            k = bisect_left(rooms, length)
            if k < len(rooms):
                room = rooms[k]
                first, bins = by_room[room].pop()
                if not by_room[room]:
                    del rooms[k]
            else:
                room, first = capacity, opened
                bins = -(-left // (capacity // length))
                opened += bins
            each = room // length
            full = min(bins, left // each)
            rest = min(left - full * each, each - 1) if full < bins else 0
            taken = full * each + rest
            out.append(Slots(length, rank, taken, each, first, capacity - room))
            put(room - each * length, first, full)
            used = full + (rest > 0)
            if rest:
                put(room - rest * length, first + full, 1)
            put(room, first + used, bins - used)
            rank, left = rank + taken, left - taken
    return out


def rank_blocks(slots: list[Slots], counts: dict[int, int]) -> list[tuple]:
    """``slots`` by (length, block of ranks): a length with k entries has blocks
    of about a k-th of its ranks, and an entry is repeated for each block that it
    reaches into. A length has fewer than 2 k + 1 such rows, and its pieces meet
    about two entries each, however many k is."""
    out = []
    for length, own in groupby(slots, key=lambda s: s.length):
        entries = list(own)
        size = max(1, counts[length] // len(entries))
        for s in entries:
            last = (s.first_rank + s.ranks - 1) // size
            out += [(*astuple(s), size, k) for k in range(s.first_rank // size, last + 1)]
    return out


def pack(cut: DataFrame, capacity: int = CAPACITY, buckets: int | None = None) -> DataFrame:
    """``cut`` (a written table of pieces) with sequence_id and offset.

    Pieces of a sequence lie side by side from offset 0 on. Sequences are as
    few as best-fit decreasing makes them. Repeated rows and null doc_ids are
    pieces like any other, an empty text is a piece of its end id alone, no
    pieces make no sequences.

    Ranks and places are found on narrow rows; what else a piece has, its ids
    above all, is not sorted and joins its place at the end, by a number of its
    own from the table's place in ``cut``.
    """
    spark = cut.sparkSession
    buckets = buckets or partitions(spark)
    names = ["doc_id", "piece", "length"]
    wide = [c for c in cut.columns if c not in (*names, "start", "ids_crc32")]
    if wide:
        cut = materialize(cut.withColumn("__row", F.monotonically_increasing_id()),
                          "packing_numbered")
        dealt = cut.select(*names, "__row")
    else:
        dealt = cut
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).alias("__bucket")
    dealt = dealt.select("*", bucket)
    sizes = materialize(dealt.groupBy("length", "__bucket").agg(F.count(F.lit(1)).alias("n")),
                        "packing_sizes")
    counts = {r.length: r.n for r in  # one row a length, so at most capacity
              sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = F.broadcast(spark.createDataFrame(
        rank_blocks(plan(counts, capacity), counts),
        "length long, first_rank long, ranks long, per_bin long, first_bin long, base long, "
        "__size long, __block long"))
    earlier = Window.partitionBy("length").orderBy("__bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = sizes.select("length", "__bucket",
                         F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__base"))
    block_size = slots.select("length", "__size").distinct()  # a row a length
    bases = bases.join(F.broadcast(block_size), "length")
    within = Window.partitionBy("length", "__bucket").orderBy("doc_id", "piece")
    ranked = (dealt.join(bases, ["length", "__bucket"])
              .withColumn("__rank", F.col("__base") + F.row_number().over(within) - 1)
              .withColumn("__block", F.floor(F.col("__rank") / F.col("__size")).cast("long")))
    at = F.col("__rank") - F.col("first_rank")
    placed = (
        ranked.drop("__size").join(slots.drop("__size"), ["length", "__block"])
        .filter((at >= 0) & (at < F.col("ranks")))
        .withColumn("sequence_id", F.col("first_bin") + F.floor(at / F.col("per_bin")))
        .withColumn("offset", F.col("base") + at % F.col("per_bin") * F.col("length")))
    if wide:
        places = placed.select("__row", "sequence_id", "offset")
        placed = cut.join(places, "__row")
    return placed.select(*[c for c in cut.columns if c != "__row"], "sequence_id", "offset")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY,
                   with_ids: bool = False, remember: int = REMEMBER) -> DataFrame:
    """Pieces of all documents (see ``pieces``) with their places (see
    ``pack``). The pieces are written once, so that a rank never changes."""
    cut = pieces(docs, path, capacity, with_ids=with_ids, remember=remember)
    if with_ids:  # numbered and written by ``pack``
        return pack(cut, capacity)
    return pack(materialize(cut, "packing_pieces"), capacity)
