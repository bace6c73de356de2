"""Fill-in-the-middle texts by secondary-sort assembly.

1. Emit: each document becomes pieces of at most ``chunk`` code points and the
   marks between them, keyed by its row and their place in the output.
2. Assemble: pieces are shuffled by row and sorted by (row, place) within each
   partition, so that a task streams the output of one document after another,
   piece by piece, into an incremental digest. No text is put together whole
   for that, and Spark's sorter spills what memory does not hold.
3. Restore: the same stream is parsed at its marks, as anyone would parse the
   output who knows its form; each part gets its place in the original text.
   The rows are sorted within their partitions once more, by original place,
   without another shuffle, and streamed into the digest of the restored text.

A row has a number of its own, so repeated or null doc_ids stay apart, and a
doc_id with a third of all rows is spread like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import id_text, on_workers, partitions

# Fixed values of the output format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: marks in the order of the output, and which part of the text follows each
ORDER = {PSM: ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)),
         SPM: ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1)),
         PLAIN: ()}
PLAIN_FROM, SPM_BELOW = 90, 20  # per cent

CHUNK = 2048
PIECES = ("row long, at long, doc_id long, n long, form string, prefix_chars long, "
          "middle_chars long, text string")
RESTORED = PIECES + ", output_sha256 string"
DIGESTS = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, "
           "output_sha256 string, restored_sha256 string")
OUTPUTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def cut(doc_id: int | None, text: str, seed: str = "1") -> tuple[str, int, int]:
    """Form, and where prefix and middle end. A null doc_id hashes as no text."""
    n = len(text)
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or h3 % 100 >= PLAIN_FROM or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return PLAIN, a, b
    return (SPM if h4 % 100 < SPM_BELOW else PSM), a, b


def parts_of(text: str, form: str, a: int, b: int) -> list[tuple[str, int, int]]:
    """(mark, start, end) in output order."""
    if form == PLAIN:
        return [("", 0, len(text))]
    ends = ((0, a), (a, b), (b, len(text)))
    return [(mark, *ends[part]) for mark, part in ORDER[form]]


@dataclass
class Parser:
    """Incremental parse of an output of a known form: ``feed`` gives (part,
    text) as soon as it is sure that the text holds no mark. A mark's first two
    characters may be the end of one piece, so as many are held back."""

    form: str
    part: int = 0
    held: str = ""
    left: list[tuple[str, int]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.left = list(ORDER[self.form])

    def feed(self, text: str) -> Iterator[tuple[int, str]]:
        buffer = self.held + text
        while self.left:
            mark, part = self.left[0]
            at = buffer.find(mark)
            if at < 0:
                break
            if at:
                yield self.part, buffer[:at]
            buffer, self.part = buffer[at + len(mark):], part
            self.left.pop(0)
        keep = 2 if self.left else 0
        sure = len(buffer) - min(keep, len(buffer))
        if sure:
            yield self.part, buffer[:sure]
        self.held = buffer[sure:]

    def end(self) -> Iterator[tuple[int, str]]:
        if self.held:
            yield self.part, self.held
        self.held = ""


class Rows:
    """Arrow batches of bounded rows and characters."""

    def __init__(self, schema: str, rows: int = 4096, chars: int = 1 << 20):
        kinds = {"long": pa.int64(), "string": pa.string()}
        fields = [x.split() for x in schema.split(", ")]
        self.schema = pa.schema([(name, kinds[kind]) for name, kind in fields])
        self.most, self.most_chars, self.rows, self.chars = rows, chars, [], 0

    def add(self, row: tuple, chars: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.chars += chars
        if len(self.rows) >= self.most or self.chars >= self.most_chars:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            arrays = [pa.array(c, f.type)
                      for c, f in zip(zip(*self.rows, strict=True), self.schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)
        self.rows, self.chars = [], 0


def _tuples(batches: Iterator[pa.RecordBatch], size: int = 512) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, size).columns), strict=True)


def pieces(docs: DataFrame, chunk: int = CHUNK, seed: str = "1") -> DataFrame:
    """The output pieces of every document; what describes the document is on
    its first piece alone. ``row`` is made of the input partition and the place
    in it, so ``docs`` must give its rows in the same order when read again, as
    a scan does."""
    on_workers(docs.sparkSession)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(PIECES)
        row = TaskContext.get().partitionId() << 40
        for doc_id, text in _tuples(batches):
            text = text or ""
            form, a, b = cut(doc_id, text, seed)
            ends = (None, None) if form == PLAIN else (a, b - a)
            head: tuple = (doc_id, len(text), form, *ends)
            at = 0
            for mark, start, end in parts_of(text, form, a, b):
                first = True
                while first or start < end:
                    piece = mark * first + text[start:min(start + chunk, end)]
                    yield from out.add((row, at, *head, piece), len(piece))
                    head, at, start, first = (None,) * 5, at + 1, start + chunk, False
            row += 1
        yield from out.flush()

    return id_text(docs).mapInArrow(emit, PIECES)


def in_output_order(cut_up: DataFrame, parts: int | None = None) -> DataFrame:
    """Pieces by row, sorted by place: the one shuffle of the texts."""
    parts = parts or partitions(cut_up.sparkSession)
    return cut_up.repartition(parts, "row").sortWithinPartitions("row", "at")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted output pieces to the parts of the original texts and, placed
    before them, a row with the output's digest."""
    out, now, head, digest, parser, count = Rows(RESTORED), None, (), None, None, [0, 0, 0]

    def placed(found):
        for part, text in found:
            yield from out.add((now, (part << 48) + count[part], *(None,) * 5, text, None),
                               len(text))
            count[part] += 1

    def done():
        yield from placed(parser.end())
        yield from out.add((now, -1, *head, None, digest.hexdigest()))

    for row, _, doc_id, n, form, prefix, middle, text in _tuples(batches):
        if row != now:
            if now is not None:
                yield from done()
            now, head, digest = row, (doc_id, n, form, prefix, middle), sha256()
            parser, count = Parser(form), [0, 0, 0]
        digest.update(text.encode())
        yield from placed(parser.feed(text))
    if now is not None:
        yield from done()
    yield from out.flush()


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted parts of the original texts to one row a document."""
    out, head, digest, of_output = Rows(DIGESTS), None, None, None
    for _, at, *described, text, output in _tuples(batches):
        if at < 0:
            if head is not None:
                yield from out.add((*head, of_output, digest.hexdigest()))
            head, of_output, digest = tuple(described), output, sha256()
        else:
            digest.update(text.encode())
    if head is not None:
        yield from out.add((*head, of_output, digest.hexdigest()))
    yield from out.flush()


def digests(docs: DataFrame, chunk: int = CHUNK, seed: str = "1",
            parts: int | None = None) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256,
    restored_sha256: a row for each input row.

    A null text is the empty one, which stays plain, as does a text that holds a
    mark. Rows that repeat a doc_id are cut alike but for the length of their
    texts; all of them come back. An empty table gives no rows; other columns
    are ignored. A long text is held whole only where it is read and cut.
    """
    streamed = in_output_order(pieces(docs, chunk, seed), parts).mapInArrow(_parse, RESTORED)
    return streamed.sortWithinPartitions("row", "at").mapInArrow(_restore, DIGESTS)


def outputs(docs: DataFrame, chunk: int = CHUNK, seed: str = "1",
            parts: int | None = None) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the output text itself
    of every row (see :func:`digests`)."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, head, texts = Rows(OUTPUTS), None, (), []
        for row, _, *described, text in _tuples(batches):
            if row != now:
                if now is not None:
                    yield from out.add((*head, "".join(texts)), sum(map(len, texts)))
                now, head, texts = row, tuple(described), []
            texts.append(text)
        if now is not None:
            yield from out.add((*head, "".join(texts)), sum(map(len, texts)))
        yield from out.flush()

    return in_output_order(pieces(docs, chunk, seed), parts).mapInArrow(join, OUTPUTS)


def restored(output: str = "output", form: str = "form") -> Column:
    """The original text of an output of a known form, by built-in functions."""
    parts = F.split(output, "<[PSM]>", -1)

    def of(*order: int) -> Column:
        return F.concat(*[F.get(parts, F.lit(i)) for i in order])

    return (F.when(F.col(form) == PSM, of(1, 3, 2)).when(F.col(form) == SPM, of(2, 3, 1))
            .otherwise(F.col(output)))
