"""Vectorised word work on Arrow batches, shared by the operators that run in
``mapInArrow``.

A batch is cut into slices of bounded bytes (a single longer text makes a
slice of its own), so memory follows the slice and the longest text, not the
batch. Words are maximal runs of bytes for which a 256-entry table is true;
every hash is a function of the bytes of a word and of nothing else.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21

# The word contract: a word is a maximal run of [^\x20\x09-\x0D].
SPACE_TABLE = np.ones(256, bool)
SPACE_TABLE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

_U = np.uint64


def _random_table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up = _series(self.base, size)
            self.down = _series(self.inverse, size)
        return self.up[:n], self.down[:n]


def _series(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BYTE_POWERS = _Powers(0x9E3779B97F4A7C15)
_WORD_POWERS = _Powers(0xC2B2AE3D27D4EB4F)
_TABLES = {seed: _random_table(seed) for seed in (1, 2)}


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: _Powers) -> np.ndarray:
    """Hash of values[starts:ends] for every span: equal content, equal hash,
    wherever the span stands."""
    up, down = powers.get(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Texts:
    """The texts of a slice as one byte buffer with offsets."""

    def __init__(self, column: pa.Array, lower: bool = False):
        column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
        self.n = len(column)
        self.null = np.asarray(column.is_null()) if column.null_count else np.zeros(self.n, bool)
        if self.null.any():
            column = column.fill_null(b"")
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + self.n + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None and self.n else np.zeros(0, np.uint8)
        self.raw = data
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets - offsets[0] if self.n else np.zeros(1, np.int64)

    def runs(self, inside: np.ndarray, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, first run of each text) of the runs of True, which
        never cross from one text into the next, nor a place in ``cuts``
        (True where a new run starts; one place more than ``inside``)."""
        n = len(inside)
        edge = np.zeros(n + 1, bool) if cuts is None else cuts.copy()
        edge[self.offsets] = True
        start, end = inside.copy(), inside.copy()
        if n:
            start[1:] &= ~inside[:-1] | edge[1:n]
            end[:-1] &= ~inside[1:] | edge[1:n]
        starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
        """Hash of each byte span (see :func:`span_hash`)."""
        return span_hash(_TABLES[seed][self.data], starts, ends, _BYTE_POWERS)


def packed_hashes(data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes of words that stand one behind the other, as of the same words in a text."""
    ends = np.cumsum(sizes, dtype=np.int64)
    return span_hash(_TABLES[1][data], ends - sizes, ends, _BYTE_POWERS)


OUTSIDE, LETTER, ALONE = 0, 1, 2

# Scripts written without spaces between words, as ranges of code points: each character is a word.
_UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x2E80, 0x2FDF), (0x3005, 0x3007),
             (0x3021, 0x3029), (0x3031, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA9E0, 0xA9FF), (0xAA60, 0xAADF),
             (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x16FE0, 0x18CFF), (0x1AFF0, 0x1B2FF), (0x20000, 0x3FFFD))
_INVISIBLE = (0x200B, 0x2060, 0xFEFF)  # breaks and joints without width, and the byte order mark


@functools.cache
def kinds_of() -> np.ndarray:
    """For every code point whether it stands outside words (spaces, punctuation,
    control characters), is a letter of a word, or is a word alone (characters
    of unspaced scripts, and symbols)."""
    out = np.full(0x110000, LETTER, np.uint8)
    for a, b in _UNSPACED:
        out[a:b + 1] = ALONE
    for c in (*range(0x80, 0x20000), *range(0xE0000, 0xE0200)):
        kind = unicodedata.category(chr(c))
        if kind[0] in "ZP" or kind == "Cc" or c in _INVISIBLE:
            out[c] = OUTSIDE
        elif kind[0] == "S":
            out[c] = ALONE
    return out


def _beyond_ascii(data: np.ndarray, inside: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``inside`` and ``cuts`` for :meth:`Texts.runs` by the kinds of the characters in UTF-8."""
    inside, cuts = inside.copy(), np.zeros(len(data) + 1, bool)
    at = np.flatnonzero(data >= 0xC0)
    lead = data[at]
    size = 2 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
    code = lead.astype(np.int64) & np.array([0, 0, 0x1F, 0x0F, 0x07])[size]
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    for k in (1, 2, 3):
        code = np.where(size > k, code << 6 | padded[at + k] & 0x3F, code)
    kind = kinds[np.minimum(code, len(kinds) - 1)]
    for k in range(4):
        spot = at[(kind == OUTSIDE) & (size > k)] + k
        inside[spot[spot < len(data)]] = False
    alone = kind == ALONE
    cuts[at[alone]] = True
    cuts[np.minimum(at[alone] + size[alone], len(data))] = True
    return inside, cuts


class Words:
    """Words of every text: byte spans, word hashes and the first word of each text."""

    def __init__(self, texts: Texts, table: np.ndarray = SPACE_TABLE, kinds: np.ndarray | None = None):
        """``kinds`` tells characters beyond ASCII apart (see :func:`kinds_of`); without it the table does for their bytes."""
        self.texts = texts
        inside, cuts = table[texts.data], None
        if kinds is not None and (texts.data >= 0x80).any():
            inside, cuts = _beyond_ascii(texts.data, inside, kinds)
        self.starts, self.ends, self.first = texts.runs(inside, cuts)
        self.counts = np.diff(self.first)

    def hashes(self, seed: int = 1) -> np.ndarray:
        return self.texts.span_hashes(self.starts, self.ends, seed)

    def text(self, i: int) -> list[bytes]:
        """The words of text i as they stand in it."""
        base = int(self.texts.offsets[i])
        raw = self.texts.raw[base:int(self.texts.offsets[i + 1])].tobytes()
        a, b = self.first[i], self.first[i + 1]
        return [raw[s - base:e - base] for s, e in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist(), strict=True)]


def shingles(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive words of one word sequence. Over a
    whole slice, runs that cross a text's end have to be left out by the caller."""
    n = len(word_hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    at = np.arange(n)
    return span_hash(word_hashes, at, at + k, _WORD_POWERS)


def word_span_hash(word_hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(word_hashes, starts, ends, _WORD_POWERS)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, again as batches, each with at most ``limit``
    bytes of text or one row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index(column)))
        total = np.concatenate([[0], np.cumsum(np.asarray(sizes.fill_null(0)).astype(np.int64))])
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(total, total[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark longs."""
    return x.view(np.int64)
