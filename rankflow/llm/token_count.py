"""Token counts of a byte-level BPE vocabulary, without making any ids.

A piece's symbols form a doubly linked list, and a heap holds the adjacent
pairs by rank and place. The lowest is popped and merged until none is left;
the piece has as many tokens as it had symbols, less the merges.
"""

from __future__ import annotations

import json
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from rankflow.llm.bpe_codec import byte_symbols
from rankflow.llm.common import FileBytes, Remembered, id_text, map_rows, raw_texts

#: What the rules call white space.
WIDE_SPACE = r"\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = r"\t-\r " + WIDE_SPACE
#: Texts whose white space is other than single blanks and line feeds between
#: words go through the whole pattern.
ODD = regex.compile(rb"[ \n][ \n]|[\t\x0b-\r]|\A[ \n]|[ \n]\Z")
ODD_WIDE = regex.compile(f"[{WIDE_SPACE}]")


class Counter:
    """Counts tokens by a vocabulary file's merges, text rules and special strings."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        ids = spec["model"]["vocab"]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.merges.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
        self.symbols = [ids[s] for s in byte_symbols()]
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        self.cut = regex.compile(b"|".join(map(regex.escape, self.special)))
        letters = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
        self.pattern = regex.compile(
            rf"{letters}| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
        self.plain = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+")
        self.piece = Remembered(lambda p: self.count_piece(p.encode()))
        self.first = Remembered(self._chunk)
        self.spaced = Remembered(lambda c: self._chunk(b" " + c))

    def count_piece(self, piece: bytes) -> int:
        """Symbols less merges, by heap and linked list."""
        sym = [self.symbols[b] for b in piece]
        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        look = self.merges.get
        heap = []
        for i in range(n - 1):
            two = look((sym[i], sym[i + 1]))
            if two:
                heap.append(two[0] * n + i)
        heapify(heap)
        left = n
        while heap:
            rank, i = divmod(heappop(heap), n)
            j = after[i]
            two = look((sym[i], sym[j])) if j < n else None
            if not two or two[0] != rank:
                continue  # one of the two is gone or has grown
            sym[i], sym[j] = two[1], -1
            j = after[i] = after[j]
            left -= 1
            if j < n:
                before[j] = i
                two = look((sym[i], sym[j]))
                if two:
                    heappush(heap, two[0] * n + i)
            h = before[i]
            if h >= 0:
                two = look((sym[h], sym[i]))
                if two:
                    heappush(heap, two[0] * n + h)
        return left

    def _chunk(self, chunk: bytes) -> int:
        text = chunk.decode()
        pattern = self.plain if text.isascii() else self.pattern
        return sum(map(self.piece.__getitem__, pattern.findall(text)))

    def _segment(self, raw: bytes) -> int:
        if ODD.search(raw) or not (raw.isascii() or not ODD_WIDE.search(raw.decode())):
            return sum(map(self.piece.__getitem__, self.pattern.findall(raw.decode())))
        # a line feed before a word is a piece of its own; a blank joins the word
        total = raw.count(b"\n")
        for line in raw.split(b"\n"):
            chunks = line.split(b" ")
            total += self.first[chunks[0]]
            if len(chunks) > 1:
                del chunks[0]
                total += sum(map(self.spaced.__getitem__, chunks))
        return total

    def count(self, raw: bytes) -> int:
        if not raw:
            return 0
        if any(s in raw for s in self.special):
            parts = self.cut.split(raw)
            return len(parts) - 1 + sum(self._segment(p) for p in parts if p)
        return self._segment(raw)


_counters: dict[int, Counter] = {}


def counter(data: bytes) -> Counter:
    key = hash(data)
    if key not in _counters:
        _counters[key] = Counter(data)
    return _counters[key]


def count_tokens(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``): a row for
    each input row.

    Whole texts; null and empty ones have 0 bytes and tokens. A special string
    inside a text is one token. Repeated rows and null doc_ids all come back,
    an empty table gives no rows, other columns are ignored. ``path`` is read on
    the driver.
    """
    data = FileBytes(docs.sparkSession, path)

    def make():
        count = counter(data.value).count

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = raw_texts(batch)
            n = [count(x) for x in texts]
            return pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(map(len, texts), pa.int64()),
                 pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])
        return each

    return map_rows(id_text(docs), make,
                    "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
