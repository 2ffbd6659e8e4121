"""Word hashing over Arrow text columns, a bounded number of bytes at a time.

A word is a run of bytes that a 256-entry table marks; A-Z count as a-z. Its hash is a
polynomial over a random value per byte, taken for all words of a chunk by prefix sums, so
no Python object is made per word. The hash of a word never depends on its chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


BYTE_VALUES = _byte_values()


def not_bytes(separators: bytes) -> np.ndarray:
    """Table of word bytes: all but the given ones."""
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


# Words end at ASCII white space.
SPACED = not_bytes(b" \t\n\x0b\x0c\r")
# Words are runs of ASCII letters and digits and of all non-ASCII bytes.
ALPHANUMERIC = not_bytes(bytes(b for b in range(128) if not chr(b).isalnum()))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64."""
    have = _POWERS.get(0)
    if have is None or len(have[0]) < size:
        out = []
        for base in (_MULTIPLIER, _INVERSE):
            powers = np.full(size, np.uint64(base), dtype=np.uint64)
            powers[0] = 1
            out.append(np.multiply.accumulate(powers))
        have = (out[0], out[1])
        if size <= 2 * CHUNK_BYTES:
            _POWERS[0] = have
    return have


def _hash_piece(data: np.ndarray, starts_of_texts: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each word of a byte array; no word crosses a text's start."""
    inside = table[data]
    before = np.empty(len(data), dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[starts_of_texts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(data), dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[starts_of_texts[starts_of_texts > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    powers, inverse = _powers(max(len(data), CHUNK_BYTES) + 1)
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(BYTE_VALUES[data] * powers[: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    return starts, ends, mix(hashes + (ends - starts).astype(np.uint64))


def _cut(data: np.ndarray, at: int, table: np.ndarray) -> int:
    """End of a piece that begins at ``at``: about a chunk, but never inside a word."""
    end = min(at + CHUNK_BYTES, len(data))
    if end == len(data):
        return end
    gaps = np.flatnonzero(~table[data[at:end]])
    if len(gaps):
        return at + int(gaps[-1]) + 1
    while end < len(data) and table[data[end]]:
        end += 1
    return end


class Words:
    """Word hashes of consecutive rows: row i holds hashes[bounds[i]:bounds[i + 1]]."""

    def __init__(self, first: int, hashes: np.ndarray, bounds: np.ndarray, lengths: np.ndarray, data: np.ndarray, offsets: np.ndarray):
        self.first = first
        self.hashes = hashes
        self.bounds = bounds
        self.lengths = lengths
        self.data = data
        self.offsets = offsets

    def __len__(self) -> int:
        return len(self.bounds) - 1


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole, at


def words(column: pa.Array, table: np.ndarray = SPACED) -> Iterator[Words]:
    """Word hashes of every text, in groups of rows of about CHUNK_BYTES.

    A longer text forms a group of its own and is read in pieces that end between words.
    ``lengths`` has the bytes of each word, ``data`` and ``offsets`` the group's bytes.
    """
    whole, at = texts_of(column)
    n, first = len(at) - 1, 0
    while first < n:
        last = int(np.searchsorted(at, at[first] + CHUNK_BYTES, side="right")) - 1
        last = min(max(last, first + 1), n)
        data = whole[at[first] : at[last]]
        offsets = at[first : last + 1] - at[first]
        if len(data) <= CHUNK_BYTES:
            if len(data):
                begins = offsets[:-1]
                starts, ends, hashes = _hash_piece(data, begins[begins < len(data)], table)
            else:
                starts = ends = np.empty(0, np.int64)
                hashes = np.empty(0, np.uint64)
            bounds = np.searchsorted(starts, offsets)
            yield Words(first, hashes, bounds, ends - starts, data, offsets)
        else:
            parts, sizes, pos = [], [], 0
            while pos < len(data):
                end = _cut(data, pos, table)
                s, e, h = _hash_piece(data[pos:end], np.zeros(1, np.int64), table)
                parts.append(h)
                sizes.append(e - s)
                pos = end
            hashes = np.concatenate(parts)
            yield Words(first, hashes, np.array([0, len(hashes)]), np.concatenate(sizes), data, offsets)
        first = last


_PLACES = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive words."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    total = np.zeros(len(hashes) - n + 1, dtype=np.uint64)
    for i in range(n):
        place = np.uint64(_PLACES[i % len(_PLACES)] + 2 * (i // len(_PLACES)))
        total += hashes[i : len(hashes) - n + 1 + i] * place
    return mix(total + np.uint64(n))


def shingle_set(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-word shingles; fewer words form one shingle, no word none."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    return np.unique(grams(hashes, n) if len(hashes) >= n else grams(hashes, len(hashes)))
