"""Vectorised word tokens over Arrow string columns.

A word is a run of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` after A-Z is lower-cased. In UTF-8 that is a run of
digits, ASCII letters and bytes of 0x80 and above, so whole columns are cut at byte level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def is_word(lower: np.ndarray) -> np.ndarray:
    return _WORD[lower]


_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
#: Bytes of text that one vectorised step works on; a longer document is one step of its own.
STEP_BYTES = 1 << 20


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n; kept for the next call while short."""
    if len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            made = np.full(size, base, np.uint64)
            made[0] = 1
            _powers[key] = np.multiply.accumulate(made)
    up, down = _powers["up"][:n], _powers["down"][:n]
    if len(_powers["up"]) > 4 * STEP_BYTES:
        _powers["up"], _powers["down"] = up[: 1 << 16], down[: 1 << 16]
    return up, down


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values (multiply and xor-shift)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end], starts ascending; the same bytes have the same hash anywhere."""
    if len(data) <= 2 * STEP_BYTES:
        return _span_hashes(data, starts, ends)
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):  # a long text a stretch at a time: the sums take eight bytes for each of its bytes
        low = int(starts[i])
        j = int(np.searchsorted(starts, low + STEP_BYTES))
        out[i:j] = _span_hashes(data[low : int(ends[i:j].max())], starts[i:j] - low, ends[i:j] - low)
        i = j
    return out


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(data):
        return np.zeros(len(starts), np.uint64)
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Texts:
    """Consecutive texts of a column: bytes, and where each text starts (len + 1 offsets)."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def raw(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and its offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[at[0] : at[-1]], at - at[0]


def steps(column: pa.Array | pa.ChunkedArray, limit: int = STEP_BYTES, most: int = 1 << 14):
    """Texts of at most limit bytes and most documents each, or of one document."""
    data, offsets = column_bytes(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, i + most)
        yield Texts(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], i)
        i = j


@dataclass
class Words:
    """Words of some texts: byte spans, hash, owning text, and the index of each text's first word (len + 1)."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    text: np.ndarray
    first: np.ndarray
    lower: np.ndarray


def words(texts: Texts) -> Words:
    lower = _LOWER[texts.data]
    inside = _WORD[lower]
    before = np.empty(len(inside), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    begins = texts.offsets[:-1][texts.offsets[:-1] < len(inside)]
    before[begins] = False
    start = np.flatnonzero(inside & ~before)
    last = np.ones(len(inside), bool)
    last[:-1] = ~inside[1:]
    ends = texts.offsets[1:-1]
    last[ends[ends > 0] - 1] = True
    end = np.flatnonzero(inside & last) + 1
    first = np.searchsorted(start, texts.offsets)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(start, end, span_hashes(lower, start, end), text, first, lower)


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words; entry i covers words i .. i+k-1 (callers drop those that cross a text's end)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = mix(out * np.uint64(3) + hashes[j : j + n] + np.uint64(j))
    return out
