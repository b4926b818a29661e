"""Vectorised scans of whole texts inside Spark tasks, shared by the operators of this subpackage.

A scan works on Arrow batches, cut into chunks of a few megabytes so that a task's memory stays
bounded whatever a partition or a text holds.  Words are the runs of bytes outside space and
``\\x09-\\x0D``; nulls count as empty texts.  All hashes are 64 bits wide and depend on content alone,
so every executor and every retry computes the same values.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4 << 20
#: For operators that work on a text through many arrays.
SMALL_CHUNK_BYTES = 3 << 19
#: Words whose bytes are worked on together where each byte takes several numbers of 64 bits.
BLOCK_WORDS = 1 << 15

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE_KEY = np.random.Generator(np.random.PCG64(20240117)).integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Words:
    """The words of a chunk: byte spans in ``data`` and the row that each belongs to (ascending)."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    n_rows: int

    def first(self) -> np.ndarray:
        """For each row the index of its first word, and at the end the number of words."""
        return np.searchsorted(self.row, np.arange(self.n_rows + 1))


def small_batches(spark) -> None:
    """From now on this session sends Python about a chunk of text at a time, instead of up to 64 MB, which the JVM (whose
    buffers double as they grow) and the worker would both hold."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(CHUNK_BYTES))


@cache
def _libc():
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:
        return None


def release() -> None:
    """Gives memory that is free back to the system, since Spark keeps its Python workers for later stages."""
    pa.default_memory_pool().release_unused()
    if _libc() is not None and hasattr(_libc(), "malloc_trim"):
        _libc().malloc_trim(0)


def chunks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that the texts of a chunk hold about ``limit`` bytes, one row at least."""
    try:
        yield from _cut(batches, column, limit)
    finally:
        release()


def _cut(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = np.nan_to_num(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)).cumsum()
        at = 0
        while at < batch.num_rows:
            base = size[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(size, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def text_bytes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and each row's offsets in them; nulls are empty."""
    column = pa.concat_arrays([pc.fill_null(column.cast(pa.large_string()), "")])
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
    return (_LOWER[data] if lower else data), offsets - offsets[0]


def words(column: pa.Array, lower: bool = False, word_bytes: np.ndarray = _IS_WORD) -> Words:
    """All words of a string column; ``lower`` maps A-Z to a-z first and nothing else.  ``word_bytes`` tells of each byte
    whether it belongs to words."""
    data, offsets = text_bytes(column, lower)
    inside = word_bytes[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty(len(data), dtype=bool)
    if len(data):
        before[0] = False
        before[1:] = inside[:-1]
    after = np.empty(len(data), dtype=bool)
    if len(data):
        after[-1] = False
        after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | cut[:-1]))
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return Words(data, start, end, row, len(column))


_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))
#: The powers of a step that were needed so far; the longest array serves all.
_POWERS: dict[int, np.ndarray] = {}


def _powers(step: np.uint64, n: int) -> np.ndarray:
    found = _POWERS.get(int(step))
    if found is None or len(found) < n:
        found = np.full(1 << max(8, int(n).bit_length()), step, dtype=np.uint64)
        found[0] = 1
        found = _POWERS[int(step)] = np.cumprod(found, dtype=np.uint64)
    return found[:n]


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the hashing step, modulo 2^64."""
    return _powers(_STEP, n)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over 64 bits."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(w: Words) -> np.ndarray:
    """A 64-bit hash of each word."""
    out = np.zeros(len(w.start), np.uint64)
    for k in range(0, len(out), BLOCK_WORDS):
        start = w.start[k : k + BLOCK_WORDS]
        size = w.end[k : k + BLOCK_WORDS] - start
        at = np.concatenate([[0], np.cumsum(size)[:-1]])
        place = np.arange(int(size.sum())) - np.repeat(at, size)
        value = _BYTE_KEY[w.data[np.repeat(start, size) + place]] * powers(int(size.max()))[place]
        out[k : k + BLOCK_WORDS] = mix(np.add.reduceat(value, at) + size.astype(np.uint64))
    return out


def run_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of ``n`` consecutive word hashes; rows are not told apart."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    step = powers(len(h) + 1)
    total = np.concatenate([[np.uint64(0)], np.cumsum(h * step[: len(h)], dtype=np.uint64)])
    back = _powers(_BACK, len(h) - n + 1)
    return mix((total[n:] - total[:-n]) * back + np.uint64(n))


def span_hashes(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of each span of ``h``, which may overlap."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(h * powers(len(h)), dtype=np.uint64)])
    back = _powers(_BACK, len(h) + 1)
    return mix((total[end] - total[start]) * back[start] + (end - start).astype(np.uint64))


def whole_hashes(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The hash of each row's whole sequence of word hashes; ``first`` as from :meth:`Words.first`."""
    size = np.diff(first)
    place = np.arange(len(h)) - np.repeat(first[:-1], size)
    return mix(row_sums(h * powers(int(size.max(initial=0)) + 1)[place], first) + size.astype(np.uint64))


def row_sums(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``value`` over the spans from each ``first`` to the next, 0 over empty ones."""
    total = np.concatenate([np.zeros(1, value.dtype), np.cumsum(value, dtype=value.dtype)])
    return total[first[1:]] - total[first[:-1]]


def scaled(h: np.ndarray, n_buckets: int) -> np.ndarray:
    """The bucket of each hash in the upper 32 bits, its place within the bucket in the lower 32; rises with the hash.

    Buckets are equal ranges of hashes, less than 2^31 of them.
    """
    n, low = np.uint64(n_buckets), np.uint64(0xFFFFFFFF)
    return (h >> np.uint64(32)) * n + (((h & low) * n) >> np.uint64(32))


def filled(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that occur in ascending places of :func:`scaled`, and where each begins (and the end)."""
    bucket = (place >> np.uint64(32)).astype(np.int64)
    start = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    return bucket[start], np.append(start, len(bucket))


def by_bucket(h: np.ndarray, n_buckets: int) -> np.ndarray:
    """Where each of a few buckets begins in an ascending array of hashes (and the end)."""
    return np.searchsorted(scaled(h, n_buckets) >> np.uint64(32), np.arange(n_buckets + 1, dtype=np.uint64))


def binary(parts: list[np.ndarray]) -> pa.Array:
    """A binary column of the arrays' bytes."""
    return pa.array([p.tobytes() for p in parts], type=pa.binary())


def join_words(w: Words, keep: np.ndarray) -> pa.Array:
    """Each row's kept words, joined by single spaces, as a string column."""
    start, end, row = w.start[keep], w.end[keep], w.row[keep]
    size = end - start + 1
    count = np.bincount(row, minlength=w.n_rows)
    length = np.bincount(row, weights=size, minlength=w.n_rows).astype(np.int64) - (count > 0)
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(length)])
    data, last, parts = np.append(w.data, np.uint8(0x20)), np.append(row[1:] != row[:-1], True), [np.zeros(0, np.uint8)]
    for k in range(0, len(start), BLOCK_WORDS):
        mine = size[k : k + BLOCK_WORDS]
        at = np.concatenate([[0], np.cumsum(mine)[:-1]])
        spot = np.repeat(start[k : k + BLOCK_WORDS] - at, mine) + np.arange(int(mine.sum()))
        spot[at + mine - 1] = -1
        parts.append(np.delete(data[spot], (at + mine - 1)[last[k : k + BLOCK_WORDS]]))
    out = np.concatenate(parts)
    joined = pa.Array.from_buffers(pa.large_string(), w.n_rows, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes())])
    return joined.cast(pa.string())
