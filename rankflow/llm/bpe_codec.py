"""BPE encoding and decoding of a vocabulary with word ends.

The text rules are those of the vocabulary file: special strings are cut out as
they stand, then NFC, white space to one blank, lower case; then words, single
digits and runs of other signs, each as byte symbols, the last with the word's
end mark.

A word is merged on a contiguous array of its parts' ranks: the parts lie
between boundaries, ``ranks[i]`` belongs to parts i and i + 1. The array is
scanned for its minimum, that boundary is deleted, and the ranks on both sides
are looked up anew. Long words keep the array in blocks under a tree of their
minima, so that a merge costs a scan of one block and of one node a level, and
not the word.

The rules decide by Unicode's classes and case tables, whose editions differ
between libraries, so beyond Latin-1 they are applied by the tokenizers library
itself; the merging is done here.
"""

from __future__ import annotations

import hashlib
import json
import struct

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from rankflow.llm.common import FileBytes, Remembered, id_text, map_rows, raw_texts

NONE = 1 << 30
LONG = 256
BLOCK = 128
FAN_OUT = 64


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is
    printable in Latin-1, else the next free one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


class Minima:
    """The leftmost least of many values that change, by a tree of minima."""

    def __init__(self, values: list[int]):
        self.levels = [values]
        while len(values) > 1:
            values = [min(values[i:i + FAN_OUT]) for i in range(0, len(values), FAN_OUT)]
            self.levels.append(values)

    def where(self) -> int | None:
        """Place of the least value, None where all are ``NONE``."""
        low = self.levels[-1][0]
        if low == NONE:
            return None
        k = 0
        for level in reversed(self.levels[:-1]):
            k = level.index(low, k * FAN_OUT)
        return k

    def set(self, k: int, value: int) -> None:
        self.levels[0][k] = value
        for level, above in zip(self.levels, self.levels[1:], strict=False):
            k //= FAN_OUT
            value = min(level[k * FAN_OUT:(k + 1) * FAN_OUT])
            if above[k] == value:
                return
            above[k] = value


class Vocabulary:
    """Tokens, merge ranks and text rules of a vocabulary file."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        #: rank and resulting id of two adjacent ids
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges.setdefault((self.ids[a], self.ids[b]), (rank, self.ids[a + b]))
        symbols = byte_symbols()
        self.first = [self.ids[s] for s in symbols]
        self.last = [self.ids[s + self.end] for s in symbols]
        rules = Tokenizer.from_str(data.decode())
        self.normal, self.split = rules.normalizer, rules.pre_tokenizer
        self.bytes = {s: b for b, s in enumerate(symbols)}
        # signs and letters that are NFC already and lower-cased one by one
        self.simple = regex.compile("[ -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
        letters = "a-z\u00df-\u00f6\u00f8-\u00ff"
        self.words = regex.compile(
            rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[0-9]|[^{letters}0-9 ]+")
        self.ascii_words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9 ]+")
        self.cut = regex.compile("|".join(map(regex.escape, self.special)))
        self.merged = Remembered(self.merge, 200_000)

    def pieces(self, text: str) -> list[bytes]:
        """The words of a text without special strings, in UTF-8."""
        if text.isascii() and text.isprintable():
            return [w.encode() for w in self.ascii_words.findall(text.lower())]
        if self.simple.fullmatch(text):
            return [w.encode() for w in self.words.findall(text.lower())]
        found = self.split.pre_tokenize_str(self.normal.normalize_str(text))
        return [bytes(map(self.bytes.__getitem__, w)) for w, _ in found]

    def merge(self, word: bytes) -> list[int]:
        parts = [self.first[b] for b in word]
        parts[-1] = self.last[word[-1]]
        return self._merge_long(parts) if len(parts) > LONG else self._merge(parts)

    def _merge(self, parts: list[int]) -> list[int]:
        look, no = self.merges.get, (NONE, 0)
        ranks = [look(two, no)[0] for two in zip(parts, parts[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least == NONE:
                break
            i = ranks.index(least)
            parts[i] = look((parts[i], parts[i + 1]))[1]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = look((parts[i], parts[i + 1]), no)[0]
            if i:
                ranks[i - 1] = look((parts[i - 1], parts[i]), no)[0]
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """As ``_merge``, with parts and ranks in blocks. The rank of a block's
        last part is that with the first part of the next block that holds one."""
        look, no = self.merges.get, (NONE, 0)
        flat = [look(two, no)[0] for two in zip(parts, parts[1:], strict=False)] + [NONE]
        blocks = [parts[i:i + BLOCK] for i in range(0, len(parts), BLOCK)]
        ranks = [flat[i:i + BLOCK] for i in range(0, len(parts), BLOCK)]
        # neighbours that are not empty; -1 and len(blocks) are the ends
        after, before = [i + 1 for i in range(len(blocks))], [i - 1 for i in range(len(blocks))]
        least = Minima([min(r) for r in ranks])
        while (k := least.where()) is not None:
            i = ranks[k].index(least.levels[0][k])
            b, j = (k, i + 1) if i + 1 < len(blocks[k]) else (after[k], 0)
            merged = blocks[k][i] = look((blocks[k][i], blocks[b][j]))[1]
            # the boundary goes; the merged part's right neighbour is the next one's
            del blocks[b][j], ranks[b][j]
            if not blocks[b]:
                after[k] = after[b]
                if after[b] < len(blocks):
                    before[after[b]] = k
                least.set(b, NONE)
            elif b != k:
                least.set(b, min(ranks[b]))
            c, j = (k, i + 1) if i + 1 < len(blocks[k]) else (after[k], 0)
            ranks[k][i] = look((merged, blocks[c][j]), no)[0] if c < len(blocks) else NONE
            c, j = (k, i - 1) if i else (before[k], -1)
            if c >= 0:
                ranks[c][j] = look((blocks[c][j], merged), no)[0]
                if c != k:
                    least.set(c, min(ranks[c]))
            least.set(k, min(ranks[k]))
        return [p for block in blocks for p in block]

    def encode_piece(self, text: str) -> list[int]:
        """Ids of a text without special strings."""
        return [i for w in self.pieces(text) for i in self.merged[w]]

    def encode(self, text: str) -> list[int]:
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += [*self.encode_piece(text[at:m.start()]), self.special[m[0]]]
            at = m.end()
        return out + self.encode_piece(text[at:])

    def decode(self, ids: list[int]) -> str:
        """The vocabulary file names no decoder: tokens with blanks between."""
        return " ".join(self.names[i] for i in ids if i in self.names)


class Codec:
    """Encodes whole texts. No token crosses white space, so what stands
    between is encoded once and remembered, A-Z already lower-cased."""

    def __init__(self, data: bytes):
        self.vocabulary = Vocabulary(data)
        self.marks = [s.lower().encode() for s in self.vocabulary.special]
        self.known = Remembered(self._one, 300_000)

    def _one(self, chunk: bytes) -> tuple[bytes, bytes]:
        return self._both(self.vocabulary.encode_piece(chunk.decode()))

    def _both(self, ids: list[int]) -> tuple[bytes, bytes]:
        return struct.pack(f"<{len(ids)}I", *ids), self.vocabulary.decode(ids).encode()

    def run(self, raw: bytes) -> tuple[bytes, bytes]:
        """Little-endian ids, and the decoded text in UTF-8."""
        low = raw.lower()
        if any(m in low for m in self.marks):
            return self._both(self.vocabulary.encode(raw.decode()))
        chunks = low.split()
        if not chunks:
            return b"", b""
        ids, decoded = zip(*map(self.known.__getitem__, chunks), strict=True)
        return b"".join(ids), b" ".join(filter(None, decoded))


_codecs: dict[int, Codec] = {}


def codec(data: bytes) -> Codec:
    """One a worker and vocabulary."""
    key = hash(data)
    if key not in _codecs:
        _codecs[key] = Codec(data)
    return _codecs[key]


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit, binary), decoded: a row for
    each input row.

    Whole texts; a null text is empty and has no ids and an empty decoded text.
    Repeated rows and null doc_ids all come back, an empty table gives no rows,
    other columns are ignored. ``path`` is read on the driver.
    """
    return _each(docs, path, "doc_id long, ids binary, decoded string",
                 lambda ids, text: (ids, text.decode()), (pa.binary(), pa.string()))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``encode_decode`` as doc_id, n_tokens, ids_sha256, decoded_sha256; the ids
    and texts themselves never leave the worker."""
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return _each(docs, path, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                 lambda ids, text: (len(ids) // 4, sha(ids), sha(text)),
                 (pa.int64(), pa.string(), pa.string()))


def _each(docs: DataFrame, path: str, schema: str, result, types) -> DataFrame:
    data = FileBytes(docs.sparkSession, path)
    names = [x.split()[0] for x in schema.split(", ")]

    def make():
        run = codec(data.value).run

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [result(*run(raw)) for raw in raw_texts(batch)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()),
                 *[pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]], names)
        return each

    return map_rows(id_text(docs), make, schema)
