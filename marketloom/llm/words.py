"""Words of many texts at once: NumPy over the bytes of an Arrow text column.

Texts are UTF-8. Both word rules used here keep every byte from 0x80 on inside
words, so cutting bytes cuts the same words as cutting code points.
"""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Executors need no installed package: this module travels with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Text handled at one time, so that temporaries stay at some tens of MB.
PIECE_BYTES = 1 << 20

_SHARED = "words"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


def worker_cache(owner: str) -> dict:
    """What one Python process keeps between tasks for one operator; never sent with a task.

    An operator that starts to use its cache drops those of all others, as a
    worker process outlives the stage that filled it.
    """
    name = "_marketloom_worker_cache"
    kept = sys.modules.setdefault(name, types.ModuleType(name)).__dict__.setdefault("owners", {})
    if owner not in kept:
        for other in [o for o in kept if o != _SHARED and owner != _SHARED]:
            del kept[other]
        kept[owner] = {}
    return kept[owner]


def release_memory() -> None:
    """Give freed memory back, so that an idle worker process stays small."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def start_in_worker(owner: str) -> None:
    """Drop what other operators keep in this worker process, and give the memory back."""
    worker_cache(owner)
    release_memory()


def power_tables(n: int) -> list[np.ndarray]:
    """Powers 0 to n-1 of an odd number, and of its inverse, modulo 2^64."""
    cache = worker_cache(_SHARED)
    if len(cache.get("powers", [()])[0]) < n:
        tables = []
        for base in (_ODD, _INVERSE):
            row = np.full(max(n, PIECE_BYTES + 1), base, np.uint64)
            row[0] = 1
            with np.errstate(over="ignore"):
                tables.append(np.multiply.accumulate(row))
        cache["powers"] = tables
    return cache["powers"]


def byte_class(*spans: tuple[int, int]) -> np.ndarray:
    """Which of the 256 bytes lie in none of the (first, last) spans."""
    inside = np.ones(256, bool)
    for first, last in spans:
        inside[first : last + 1] = False
    return inside


SPACED = byte_class((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


@dataclass
class Words:
    """Words of a run of texts: bytes, word bounds in them, first word of each text."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    codes: np.ndarray

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def joined(self, keep: np.ndarray, text: int) -> bytes:
        """The kept words of one text, joined by single spaces."""
        lo, hi = self.first[text], self.first[text + 1]
        raw = self.data[self.starts[lo] : self.ends[hi - 1]].tobytes() if hi > lo else b""
        base = self.starts[lo] if hi > lo else 0
        bounds = zip(self.starts[lo:hi][keep[lo:hi]] - base, self.ends[lo:hi][keep[lo:hi]] - base, strict=True)
        return b" ".join(raw[a:b] for a, b in bounds)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; NULL counts as empty."""
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def _cut(data: np.ndarray, breaks: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, ends and codes; `breaks` are offsets where a text starts."""
    n = len(data)
    inside = np.zeros(n + 1, bool)
    inside[:n] = word[data]
    before = np.zeros(n + 1, bool)
    before[1:] = inside[:n]
    is_break = np.zeros(n + 1, bool)
    is_break[breaks] = True
    starts = np.flatnonzero(inside & (~before | is_break))
    ends = np.flatnonzero(before & (~inside | is_break))
    power, inverse = power_tables(n + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_CODES[data] * power[:n], out=total[1:])
        codes = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return starts, ends, codes


def find_words(column: pa.Array, word: np.ndarray, lower: bool = False) -> Words:
    """Words of every text of a column, in order, each with a 64-bit code."""
    data, bounds = column_bytes(column)
    if lower:
        data = _LOWER[data]
    parts, at = [], 0
    while at < len(data):
        stop = min(at + PIECE_BYTES, len(data))
        while stop < len(data):  # cut only where no word goes on
            outside = np.flatnonzero(~word[data[stop : stop + PIECE_BYTES]])
            stop += outside[0] if len(outside) else min(PIECE_BYTES, len(data) - stop)
            if len(outside):
                break
        lo, hi = np.searchsorted(bounds, [at, stop])
        starts, ends, codes = _cut(data[at:stop], bounds[lo:hi] - at, word)
        parts.append((starts + at, ends + at, codes))
        at = stop
    if parts:
        starts, ends, codes = (np.concatenate(x) for x in zip(*parts, strict=True))
    else:
        starts = ends = np.zeros(0, np.int64)
        codes = np.zeros(0, np.uint64)
    return Words(data, starts, ends, np.searchsorted(starts, bounds), codes)


def runs(codes: np.ndarray, length: int) -> np.ndarray:
    """Code of every run of `length` words, at its first word (texts not regarded)."""
    n = max(0, len(codes) - length + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(length):
            out = out * _ODD + codes[k : k + n]
    return mix(out)


def whole_runs(first: np.ndarray, n_words: int, length: int) -> np.ndarray:
    """Which words start a run of `length` words inside one text."""
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n_words)
    return (left >= length)[: max(0, n_words - length + 1)]


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in one of the half-open ranges."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step)[:n] > 0


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` bytes of text, or of one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, stop - at)
            at = stop
    release_memory()


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated integer ranges start, start+1, ... of the given lengths."""
    total = int(counts.sum())
    out = np.arange(total)
    return out + np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
