"""Fill-in-middle over piece tables.

A document is never copied while it is rearranged. It becomes a table of descriptors (buffer,
start, end) over two immutable buffers: the text's UTF-8 bytes and the sentinels. Cutting
splits descriptors at line ends, an arrangement permutes them, the inverse permutation
restores the text, and hashes and outputs stream the descriptors.

The cuts and the form follow from a hash of seed and id alone, so a repeated or moved row gets
the same output. Lines are the units: ``[^\\n]*\\n`` or what is left at the end.

* ``plain``: the text as it is, for empty texts, texts that hold a sentinel, and the share of
  documents beyond ``rate`` percent.
* ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle.
* ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle.

Restoring reads nothing but output and form: the output is cut at its sentinels, which a text
cannot hold, and the pieces go back by the inverse permutation.

Cases: a NULL text counts as empty, so does not become NULL; a NULL id hashes like an id
without digits; rows that repeat an id and its text get the same result each; texts of any
length are cut whole, one text at a time in memory; an empty table gives no rows; only the two
named columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

NEWLINE, CONTINUES, LEAD = 10, 0x80, 0xC0
TEXT, MARKS = 0, 1
# Place of each piece of (prefix, middle, suffix, <P>, <S>, <M>) in the output.
ORDERS = {"psm": (3, 0, 4, 2, 5, 1), "spm": (4, 2, 3, 0, 5, 1)}


@dataclass(frozen=True)
class Settings:
    seed: int = 7
    rate: int = 100
    spm: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def sentinels(self) -> list[bytes]:
        return [s.encode() for s in (self.prefix, self.suffix, self.middle)]


class Piece(NamedTuple):
    buffer: int
    start: int
    end: int


class PieceTable:
    """Descriptors over immutable buffers; every change makes new descriptors only."""

    def __init__(self, buffers: list[bytes], pieces: Iterable[Piece]):
        self.buffers = buffers
        self.pieces = list(pieces)

    def cut(self, offsets: list[int]) -> PieceTable:
        """Split at ascending offsets of the whole; an offset at a piece's end, or one that
        repeats, gives an empty piece."""
        out, at, rest = [], 0, list(offsets)
        for buffer, start, end in self.pieces:
            while rest and rest[0] <= at + end - start:
                middle = start + rest[0] - at
                out.append(Piece(buffer, start, middle))
                at, start = rest.pop(0), middle
            out.append(Piece(buffer, start, end))
            at += end - start
        if rest:
            raise ValueError(f"cannot cut at {rest[0]}, behind the end {at}")
        return PieceTable(self.buffers, out)

    def join(self, more: Iterable[Piece]) -> PieceTable:
        return PieceTable(self.buffers, [*self.pieces, *more])

    def arrange(self, order: Iterable[int]) -> PieceTable:
        return PieceTable(self.buffers, [self.pieces[i] for i in order])

    def first(self, count: int) -> PieceTable:
        return PieceTable(self.buffers, self.pieces[:count])

    def stream(self) -> Iterator[memoryview]:
        views = [memoryview(b) for b in self.buffers]
        for buffer, start, end in self.pieces:
            yield views[buffer][start:end]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.stream():
            digest.update(part)
        return digest.hexdigest()

    def data(self) -> bytes:
        return b"".join(self.stream())


def inverse(order: Iterable[int]) -> list[int]:
    """Places that undo an order."""
    back = {piece: place for place, piece in enumerate(order)}
    return [back[i] for i in range(len(back))]


def line_ends(data: bytes) -> np.ndarray:
    """Offset behind each unit of a text."""
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == NEWLINE) + 1
    if len(data) and (not len(ends) or ends[-1] < len(data)):
        ends = np.append(ends, len(data))
    return ends


def code_points(data: bytes, start: int, end: int) -> int:
    part = np.frombuffer(data, np.uint8)[start:end]
    return int(np.count_nonzero((part & LEAD) != CONTINUES))


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four unsigned 32-bit numbers of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


class Cut(NamedTuple):
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: PieceTable


def arranged(doc_id: int | None, data: bytes, settings: Settings) -> Cut:
    """The document's cuts, form and rearranged table."""
    ends = line_ends(data)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, settings.seed)
    marks = settings.sentinels()
    whole = PieceTable([data, b"".join(marks)], [Piece(TEXT, 0, len(data))])
    if not data or h3 % 100 >= settings.rate or any(m in data for m in marks):
        return Cut(n, "plain", None, None, whole)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (int(ends[i - 1]) if i else 0 for i in (low, high))
    form = "spm" if h4 % 100 < settings.spm else "psm"
    bounds = np.cumsum([0, *map(len, marks)]).tolist()
    sentinels = [Piece(MARKS, s, e) for s, e in zip(bounds, bounds[1:])]
    output = whole.cut([a, b]).join(sentinels).arrange(ORDERS[form])
    return Cut(n, form, code_points(data, 0, a), code_points(data, a, b), output)


def restored(output: bytes, form: str, settings: Settings) -> PieceTable:
    """The text's table, from output and form alone."""
    whole = PieceTable([output], [Piece(TEXT, 0, len(output))])
    if form == "plain":
        return whole
    order, marks = ORDERS[form], settings.sentinels()
    bounds, at = [], 0
    for piece in order:
        if piece >= 3:
            mark = marks[piece - 3]
            found = output.find(mark, at)
            if found < 0:
                raise ValueError(f"the output has no {mark.decode()} where {form} needs it")
            bounds += [found, found + len(mark)]
            at = found + len(mark)
    if bounds[0]:
        raise ValueError(f"the output does not start as {form} does")
    return whole.cut(bounds[1:]).arrange(inverse(order)).first(3)


def _texts(column: pa.Array) -> Iterator[bytes]:
    for value in column.cast(pa.large_string()).cast(pa.large_binary()):
        yield value.as_py() or b""


def _kind(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def transform(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rearranged texts: (id, n, form, prefix_chars, middle_chars, output)."""

    def run(batches):
        for batch in batches:
            for i, data in zip(batch.column(0), _texts(batch.column(1))):
                cut = arranged(i.as_py(), data, settings)
                row = [i.as_py(), *cut[:4], cut.output.data().decode()]
                yield pa.RecordBatch.from_pylist([dict(zip(names.names, row))], names)

    schema = f"{id_col} {_kind(docs, id_col)}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    names = _arrow(id_col, docs, [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def restore(rows: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id") -> DataFrame:
    """Texts of :func:`transform`'s rows, from ``output`` and ``form``: (id, text)."""

    def run(batches):
        for batch in batches:
            for i, data, form in zip(batch.column(0), _texts(batch.column(1)), batch.column(2)):
                text = restored(data, form.as_py(), settings).data().decode()
                yield pa.RecordBatch.from_pylist([{id_col: i.as_py(), "text": text}], names)

    names = _arrow(id_col, rows, [("text", pa.string())])
    return rows.select(id_col, "output", "form").mapInArrow(run, f"{id_col} {_kind(rows, id_col)}, text string")


def _arrow(id_col: str, df: DataFrame, more: list[tuple[str, pa.DataType]]) -> pa.Schema:
    return pa.schema([(id_col, to_arrow_type(df.schema[id_col].dataType)), *more])


def digests(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rearrange and restore in one pass: (id, n, form, prefix_chars, middle_chars,
    output_sha256, restored_sha256, round_trip). One text and its output are in memory at a time."""

    def run(batches):
        for batch in batches:
            rows = []
            for i, data in zip(batch.column(0).to_pylist(), _texts(batch.column(1))):
                cut = arranged(i, data, settings)
                back = restored(cut.output.data(), cut.form, settings).sha256()
                rows.append((*cut[:4], cut.output.sha256(), back, back == hashlib.sha256(data).hexdigest()))
            values = list(zip(*rows)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, values, kinds)], [id_col, *names])

    names = ["n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256", "round_trip"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
    schema = (
        f"{id_col} {_kind(docs, id_col)}, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
        "output_sha256 string, restored_sha256 string, round_trip boolean"
    )
    return docs.select(id_col, text_col).mapInArrow(run, schema)
