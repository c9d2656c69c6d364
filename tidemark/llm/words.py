"""Words of an Arrow string column as numpy arrays.

A word is a maximal run of bytes outside ``\\x20`` and ``\\x09-\\x0D``.  UTF-8 never uses those bytes inside
a longer character, so the cut can be made on bytes.  A null text has no words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_M = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD1342543DE82EF95)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z, all other bytes as they are
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
BLOCK = 1 << 20  #: bytes hashed at a time, unless one word has more
_BYTE_CODE = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


class Words(NamedTuple):
    data: np.ndarray  #: bytes of all texts
    start: np.ndarray  #: first byte of each word
    end: np.ndarray  #: byte after each word
    doc: np.ndarray  #: row of each word
    first: np.ndarray  #: index of each row's first word; one more entry than rows


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = powers(_BASE, BLOCK + 1), powers(_BASE_INVERSE, BLOCK + 1)
_owner: list[tuple[str, Callable[[], None]]] = []


def remember(owner: str, forget: Callable[[], None]) -> None:
    """A worker keeps what one operator remembers between its tasks: that of the operator before is dropped."""
    if _owner and _owner[0][0] != owner:
        _owner.pop()[1]()
    if not _owner:
        _owner.append((owner, forget))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and n + 1 offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(batch: pa.RecordBatch, column: str = "_text", max_bytes: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most so many bytes of text, or one row."""
    size = np.diff(text_bytes(batch.column(column))[1])
    total = np.concatenate([[0], np.cumsum(size)])
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(total, total[at] + max_bytes, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def split(column: pa.Array, lower: bool = False) -> Words:
    """The words of every row of a string column."""
    data, at = text_bytes(column)
    if lower:
        data = LOWER[data]
    blank = _BLANK[data]
    edge = np.ones(len(data) + 1, bool)  # a word may begin here: after a blank or at a row's start
    edge[1:] = blank
    edge[at] = True
    start = np.flatnonzero(edge[:-1] & ~blank)
    stop = np.ones(len(data) + 1, bool)
    stop[:-1] = blank
    stop[at] = True
    stop = np.flatnonzero(stop)
    end = stop[np.searchsorted(stop, start, "right")] if len(start) else start
    first = np.searchsorted(start, at)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(first))
    return Words(data, start, end, doc, first)


def word_hashes(w: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes, from differences of a running polynomial over blocks of whole words."""
    n = len(w.start)
    out = np.zeros(n, np.uint64)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(w.end, w.start[at] + BLOCK, "right")))
        low, size = w.start[at], int(w.end[to - 1] - w.start[at])
        up, down = (_POWERS if size <= BLOCK else (powers(_BASE, size + 1), powers(_BASE_INVERSE, size + 1)))
        total = np.zeros(size + 1, np.uint64)
        np.multiply(_BYTE_CODE[w.data[low : low + size]], up[:size], out=total[1:])
        np.cumsum(total, out=total)
        start, end = w.start[at:to] - low, w.end[at:to] - low
        out[at:to] = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * _M)
        at = to
    return out


def runs(h: np.ndarray, k: int, base: np.uint64 = _M) -> np.ndarray:
    """A hash of the k values from each position on; the last k - 1 positions are left out."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    out = h[: len(h) - k + 1].copy()
    for j in range(1, k):
        out *= base
        out += h[j : len(h) - k + 1 + j]
    return mix(out)


def word_texts(w: Words, which: np.ndarray) -> pa.Array:
    """The chosen words as an Arrow binary column."""
    n = (w.end - w.start)[which]
    top = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    flat = np.arange(top[-1]) + np.repeat(w.start[which] - top[:-1], n)
    return pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(top.tobytes()), pa.py_buffer(w.data[flat].tobytes())])
