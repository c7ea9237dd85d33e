"""Numpy helpers for Arrow batches of text: words, hashes, windows. No Spark in here."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at a time; a longer single text is taken alone.
PIECE = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: A random 64-bit value for each byte, so that close bytes are not close in a sum.
BYTE = np.random.Generator(np.random.PCG64(20240611)).integers(0, 2**64, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, nulls as empty, and the place where each row starts (n + 1)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    at = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches so that each has about PIECE bytes of text, and at least one row."""
    for batch in batches:
        _, at = utf8(batch.column(text))
        start, n = 0, batch.num_rows
        while start < n:
            end = int(np.searchsorted(at, at[start] + PIECE, side="right")) - 1
            end = min(n, max(end, start + 1))
            yield batch.slice(start, end - start)
            start = end


def word_bounds(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; a word ends with its row."""
    inside = ~_SPACE[raw]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    inner = at[1:-1]
    cut = inner[(inner > 0) & (inner < len(raw))]
    starts[cut] = inside[cut]
    ends[cut - 1] = inside[cut - 1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def runs(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of marked bytes; a run ends with its row."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[at] = True
    before = np.concatenate([[False], inside[:-1]]) & ~edge[:-1]
    after = np.concatenate([inside[1:], [False]]) & ~edge[1:]
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def strings(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.LargeStringArray:
    """The runs as an Arrow array; they do not overlap and are in order."""
    edge = np.zeros(len(raw) + 1, np.int8)
    edge[starts] += 1
    edge[ends] -= 1
    kept = raw[np.cumsum(edge[:-1], dtype=np.int8) > 0]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(kept))


def ascii_lower(raw: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lower-cased."""
    return _LOWER[raw]


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word's bytes: a polynomial in them, then mixed."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    place = np.arange(int(ends[-1]), dtype=np.int64)
    begin = np.zeros(len(place), dtype=np.int64)
    begin[starts[1:]] = np.diff(starts)
    begin[starts[0]] += starts[0]
    np.cumsum(begin, out=begin)
    inside = ~_SPACE[raw[: len(place)]]
    place = (place - begin)[inside]
    term = BYTE[raw[: len(inside)][inside]]
    term *= powers(BASE, int(lengths.max()))[place]
    first = np.zeros(len(lengths), dtype=np.int64)
    np.cumsum(lengths[:-1], out=first[1:])
    return mix(np.add.reduceat(term, first) ^ (lengths.astype(np.uint64) * INVERSE))


def hashed_words(
    column: pa.Array, lower: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a text column, and the place where each row's words start (n + 1)."""
    raw, at = utf8(column)
    if lower:
        raw = _LOWER[raw]
    starts, ends = word_bounds(raw, at)
    return word_hashes(raw, starts, ends), np.searchsorted(starts, at)


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)
