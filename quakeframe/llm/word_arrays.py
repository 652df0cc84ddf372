"""Hashes of words and of runs of words for whole Arrow batches at once.

Texts of an Arrow column lie one after the other in one buffer of UTF-8 bytes.
Words are found in it by array operations, and the hash of any stretch of bytes
or of words is a difference of two prefix sums of a polynomial modulo 2 ** 64,
passed through a mixing function. No Python object is made for a word.

A word is a maximal stretch of bytes other than ``[\\x20\\x09-\\x0D]``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Odd multipliers of the polynomials and of the mixing function.
BASE_BYTES, BASE_WORDS = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
MIX_1, MIX_2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
#: Bytes of text worked on at a time: arrays of this length stay in a core's cache.
PIECE = 1 << 18
_BYTE = np.random.default_rng(20240502).integers(0, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * MIX_1
    x = (x ^ (x >> U(27))) * MIX_2
    return x ^ (x >> U(31))


def _powers(base: int, n: int) -> np.ndarray:
    got = _POWERS.get(base)
    if got is None or len(got) < n:
        p = np.empty(max(n, PIECE + 1), U)
        p[0] = U(1)
        p[1:] = U(base)
        got = _POWERS[base] = np.cumprod(p, dtype=U)
    return got


def _prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values * _powers(base, len(values))[: len(values)], dtype=U, out=out[1:])
    return out


def _stretches(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    inverse = pow(base, -1, 1 << 64)
    return mix((sums[ends] - sums[starts]) * _powers(inverse, len(sums))[starts])


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without nulls."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    every = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return every, at


class Words:
    """Words of a run of texts: ``hash`` of each, its ``start`` and ``end`` byte,
    and ``first``, the number of the first word of each text (one more at the end)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        b = data[offsets[0] : offsets[-1]]
        bounds = offsets - offsets[0]
        if lower:
            b = np.where((b >= 65) & (b <= 90), b | 32, b)
        n = len(b)
        word = ~((b == 32) | ((b >= 9) & (b <= 13)))
        edge = np.zeros(n + 1, bool)
        edge[bounds] = True
        opens, closes = word.copy(), word.copy()
        if n:
            opens[1:] &= ~word[:-1] | edge[1:n]
            closes[:-1] &= ~word[1:] | edge[1:n]
        self.start, self.end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        sums = _prefix_sums(_BYTE[b], BASE_BYTES)
        self.hash = _stretches(sums, self.start, self.end, BASE_BYTES)
        self.first = np.searchsorted(self.start, bounds)
        self.bytes, self.bounds = b, bounds
        self._sums: np.ndarray | None = None

    def runs(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, text number, place of the first word in its text) of all runs of
        ``k`` consecutive words of one text, in order."""
        n = len(self.hash)
        per_text = np.maximum(np.diff(self.first) - k + 1, 0)
        text = np.repeat(np.arange(len(per_text)), per_text)
        place = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        at = self.first[text] + place
        if self._sums is None:
            self._sums = _prefix_sums(self.hash, BASE_WORDS)
        if not n or not len(at):
            return np.zeros(0, U), text, place
        return _stretches(self._sums, at, at + k, BASE_WORDS), text, place


def pieces(batches: Iterator[pa.RecordBatch], text: str, lower: bool = False) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Batches cut into runs of rows of about ``PIECE`` bytes of text (a longer
    text makes a run of its own), with their words."""
    for batch in batches:
        data, offsets = text_buffers(batch.column(batch.schema.get_field_index(text)))
        at, n = 0, batch.num_rows
        while at < n:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE, side="right")) - 1)
            yield batch.slice(at, to - at), Words(data, offsets[at : to + 1], lower)
            at = to


def gathered(arrays: Iterator[np.ndarray], least: int = 1 << 16) -> Iterator[np.ndarray]:
    """Arrays joined until they have at least ``least`` elements."""
    held, n = [], 0
    for a in arrays:
        held.append(a)
        n += len(a)
        if n >= least:
            yield np.concatenate(held)
            held, n = [], 0
    if n:
        yield np.concatenate(held)


def packed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary column: row i holds ``values[bounds[i]:bounds[i + 1]]`` as bytes."""
    raw = np.ascontiguousarray(values)
    width = raw.dtype.itemsize
    offsets = (np.asarray(bounds, np.int64) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw.tobytes())])


def by_bucket(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For sorted 64-bit ``keys``: the buckets (top ``bits`` bits) that occur, and
    where each begins (one more at the end)."""
    bucket = (keys >> U(64 - bits)).astype(np.int64)
    begins = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return bucket[begins], np.concatenate((begins, [len(keys)]))
