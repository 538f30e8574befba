"""Vectorised helpers over Arrow string columns, used inside Spark tasks.

All work is on the UTF-8 bytes of a whole record batch: no per-word Python objects are made.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text handled at once inside a task; a longer single text is handled alone.
SLICE_BYTES = 2 << 20

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
_BASE = int(_rng.integers(2**40, 2**63, dtype=np.uint64)) | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POW: dict[int, np.ndarray] = {}

ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64, at least n of them; kept between calls."""
    have = _POW.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = _POW[base] = np.multiply.accumulate(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums of byte codes times powers of the base; n + 1 values, for span_hash."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], equal for equal bytes wherever they stand."""
    value = (prefix[end] - prefix[start]) * _powers(_BASE_INV, len(prefix))[start]
    return mix(value + (end - start).astype(np.uint64) * U64(0x9E3779B97F4A7C15))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None and len(column) else np.zeros(0, np.uint8)
    return data, (offsets - offsets[0]) if len(column) else np.zeros(1, np.int64)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = flat(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word (maximal run of bytes that are no separators, cut at texts' ends), and the text it is in."""
    n = len(data)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    inside = ~separator[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def windows(word_hash: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words within one text, and the first word of each."""
    n = len(word_hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(doc[:n] == doc[k - 1 :])
    value = np.zeros(len(at), np.uint64)
    for i in range(k):
        value = value * U64(0x9E3779B97F4A7C15 | 1) + word_hash[at + i]
        value ^= value >> U64(29)
    return mix(value), at


def per_text(flags: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Sum of flags for each text."""
    return np.bincount(doc, weights=flags, minlength=n).astype(np.int64) if len(doc) else np.zeros(n, np.int64)


def arrow_map(fn: Callable[[pa.RecordBatch], pa.RecordBatch], column: str = "text"):
    """For mapInArrow: fn over slices of bounded text size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            yield fn(batch)

    return run


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows sorted by keys, in tables that never end within a group; one holds a batch or a group, whichever is larger."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k) for k in keys]
        end = tuple(c[-1].as_py() for c in columns)
        same = np.ones(batch.num_rows, bool)
        for c, x in zip(columns, end):
            same &= c.to_numpy(zero_copy_only=False) == x
        cut = int(np.argmax(same))
        if cut or held and last != end:
            ready = [*held, batch.slice(0, cut)] if cut else held
            yield pa.Table.from_batches(ready).combine_chunks()
            held = []
        held.append(batch.slice(cut))
        last = end
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
