"""Byte-level BPE over Arrow batches with the tokenizers library.

The rank file lists tokens as bytes. Byte-level models work on characters, so each byte is
mapped to a printable character (the public byte table); decoding reverses the table on
bytes, so a character that was split between tokens comes back whole.

Cases: a NULL or empty text has no tokens and decodes to no bytes; the text is encoded
whole, whatever its length; repeated rows give repeated rows; an empty table gives an empty
result; other columns of the input are not read, so their names cannot clash. A NULL id is
passed through.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

ROWS_AT_ONCE = 64
# Texts of more characters are encoded so many pieces at a time.
SHORT = 1 << 20
PIECES_AT_ONCE = 100_000
# Bounds of a worker's memory of encoded pieces, not of what is encoded.
CACHED_PIECES = 300_000
CACHED_LENGTH = 64


@lru_cache(maxsize=1)
def byte_characters() -> list[str]:
    """Character of each byte: printable Latin-1 stands for itself, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    out = [""] * 256
    for b in plain:
        out[b] = chr(b)
    for i, b in enumerate(rest):
        out[b] = chr(256 + i)
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The pair each token was merged from: the merges of lower rank, applied to its bytes, leave it."""
    out = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        if len(token) < 2:
            continue
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = rank, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1], rank)
                if r < best:
                    best, at = r, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            out.append((parts[0], parts[1]))
    return out


class Codec:
    """Encoder and decoder of one rank file.

    Texts are split by the pattern; each piece is encoded by the library's BPE model. Pieces
    repeat, so a worker remembers the ids of up to CACHED_PIECES of them.
    """

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers.models import BPE

        ranks = read_ranks(path)
        table = byte_characters()
        spell = lambda token: "".join(table[b] for b in token)
        vocab = {spell(t): r for t, r in ranks.items()}
        merges = [(spell(a), spell(b)) for a, b in merges_of(ranks)]
        # The piece cache below takes the place of the model's own.
        self.model = BPE(vocab, merges, cache_capacity=0, ignore_merges=True)
        self.pattern = regex.compile(pattern)
        self.characters = str.maketrans({chr(b): c for b, c in enumerate(table)})
        self.known: dict[str, list[int]] = {}
        size = max(ranks.values()) + 1
        byte_of = {c: b for b, c in enumerate(table)}
        self.pieces: list[bytes] = [b""] * size
        for token, rank in vocab.items():
            self.pieces[rank] = bytes(byte_of[c] for c in token)
        self.digits = [str(i) for i in range(size)]

    def piece_ids(self, piece: str) -> list[int]:
        ids = self.known.get(piece)
        if ids is None:
            # One character per byte, so that the model sees bytes.
            spelt = piece.encode().decode("latin-1").translate(self.characters)
            ids = [t.id for t in self.model.tokenize(spelt)]
            if len(piece) <= CACHED_LENGTH:
                if len(self.known) >= CACHED_PIECES:
                    self.known.clear()
                self.known[piece] = ids
        return ids

    def parts(self, text: str) -> Iterator[list[int]]:
        """Ids of a text, PIECES_AT_ONCE pieces at a time, whatever the text's length."""
        if len(text) <= SHORT:
            found, step = self.pattern.findall(text), None
        else:
            found, step = (m.group() for m in self.pattern.finditer(text)), PIECES_AT_ONCE
        while True:
            ids: list[int] = []
            known, empty = self.known, True
            for piece in found if step is None else islice(found, step):
                empty = False
                ids += known.get(piece) or self.piece_ids(piece)
            if not empty:
                yield ids
            if step is None or empty:
                return

    def encode(self, text: str) -> list[int]:
        return [i for part in self.parts(text) for i in part]

    def decode(self, ids: list[int]) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[i] for i in ids])

    def ends(self, ids: list[int]) -> list[int]:
        """End of each token in bytes of the encoded text."""
        return np.cumsum([len(self.pieces[i]) for i in ids], dtype=np.int64).tolist()


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker and rank file."""
    return Codec(path, pattern)


def few_rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that are small enough for their token lists."""
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        yield batch.slice(at, ROWS_AT_ONCE)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids and the end offset in bytes of each token: (id, ids, ends)."""

    def run(batches):
        model = codec(path, pattern)
        for batch in batches:
            for rows in few_rows(batch):
                ids = [model.encode(text or "") for text in rows.column(1).to_pylist()]
                ends = pa.array([model.ends(x) for x in ids], pa.list_(pa.int64()))
                columns = [rows.column(0), pa.array(ids, pa.list_(pa.int32())), ends]
                yield pa.RecordBatch.from_arrays(columns, [id_col, "ids", "ends"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, ids array<int>, ends array<bigint>")


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """Bytes of each row's ids: (id, bytes). A NULL list gives no bytes; an unknown id raises."""

    def run(batches):
        model = codec(path, pattern)
        for batch in batches:
            for rows in few_rows(batch):
                out = [model.decode(x or []) for x in rows.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(out, pa.binary())], [id_col, "bytes"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, "ids").mapInArrow(run, f"{id_col} {kind}, bytes binary")


def encode_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass: (id, n_tokens, ids_sha256, decoded_sha256, round_trip).

    ``round_trip`` is true if the decoded bytes are the text's UTF-8 bytes.
    """

    def run(batches):
        model = codec(path, pattern)
        digits = model.digits
        for batch in batches:
            for rows in few_rows(batch):
                out = []
                for text in rows.column(1).to_pylist():
                    n, ids_sha, bytes_sha = 0, hashlib.sha256(), hashlib.sha256()
                    for ids in model.parts(text or ""):
                        ids_sha.update((" " if n else "").encode() + " ".join([digits[i] for i in ids]).encode())
                        bytes_sha.update(model.decode(ids))
                        n += len(ids)
                    back = bytes_sha.hexdigest()
                    same = back == hashlib.sha256((text or "").encode()).hexdigest()
                    out.append((n, ids_sha.hexdigest(), back, same))
                columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.string(), pa.bool_()))]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"]
                yield pa.RecordBatch.from_arrays([rows.column(0), *columns], names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, round_trip boolean"
    return docs.select(id_col, text_col).mapInArrow(run, schema)
