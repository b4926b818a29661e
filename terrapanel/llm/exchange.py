"""Packed exchange: one row for each chunk of documents and range of hashes.

A row carries many hashes with the ids they belong to, so a shuffle of hundreds of millions of hashes
moves a few thousand rows, and a task that gets a range of hashes sorts it as numpy arrays.

Where there are more ranges than ``FAN_OUT`` a chunk's rows would hold few hashes each.  Then chunks deal
their hashes into wide ranges first; each wide range goes to as many tasks as it has parts, and those
cut what they get from many chunks into the final ranges.  So what a chunk does and the size of rows
do not depend on the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textscan as ts

FAN_OUT = 2048
AGAIN_HASHES = 2_000_000
EXCHANGE = "bucket int, hashes binary, owner binary, ids binary, extra binary"


def bucket_rows(n_buckets: int, hashes: np.ndarray, row: np.ndarray, ids: np.ndarray, extra: np.ndarray, key: np.ndarray | None = None, narrow: bool = False) -> pa.RecordBatch:
    """The hashes in order of ``key`` (themselves, if none), cut into buckets, with the id and the extra
    number of each hash's row.  ``narrow`` sends 32 bits of each hash besides its bucket."""
    order = np.argsort(hashes if key is None else key, kind="stable")
    hashes, row = hashes[order], row[order]
    place = ts.scaled(hashes if key is None else key[order], n_buckets)
    full, edge = ts.filled(place)
    parts = []
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        used, index = np.unique(row[a:b], return_inverse=True)
        mine = place[a:b].astype(np.uint32) if narrow else hashes[a:b]
        parts.append((mine, index.astype(np.uint32 if len(used) > 65535 else np.uint16), ids[used], extra[used]))
    return pa.record_batch([pa.array(full, pa.int32()), *(ts.binary([p[i] for p in parts]) for i in range(4))], names=["bucket", "hashes", "owner", "ids", "extra"])


def gathered(batches: Iterable[pa.RecordBatch], narrow: bool = False, most: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each bucket that the task holds: hashes, and each one's id (int64) and extra (uint64).

    With ``most`` a bucket comes in parts of about so many hashes, as they arrive.
    """
    try:
        yield from _gather(batches, narrow, most)
    finally:
        ts.release()


def _gather(batches: Iterable[pa.RecordBatch], narrow: bool, most: int | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    found: dict[int, list] = {}
    size: dict[int, int] = {}
    for b in batches:
        for k, hashes, owner, ids, extra in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
            n = len(hashes) // (4 if narrow else 8)
            index = np.frombuffer(owner, np.uint16 if len(owner) == 2 * n else np.uint32)
            found.setdefault(k, []).append((np.frombuffer(hashes, np.uint32 if narrow else np.uint64), np.frombuffer(ids, np.int64)[index], np.frombuffer(extra, np.uint64)[index]))
            size[k] = size.get(k, 0) + n
            if most and size[k] >= most:
                yield tuple(np.concatenate(x) for x in zip(*found.pop(k), strict=True))
                size[k] = 0
    for k in list(found):
        yield tuple(np.concatenate(x) for x in zip(*found.pop(k), strict=True))


def deal(source: DataFrame, rows_of, n: int, narrow: bool = False, documents: bool = False) -> DataFrame:
    """Sends the rows of ``rows_of(buckets, narrow)``, a function over Arrow batches of ``source``, to ``n`` tasks by
    bucket; ``documents`` tells that buckets go by :func:`by_document`."""
    if n <= FAN_OUT:
        return source.mapInArrow(rows_of(n, narrow), EXCHANGE).repartitionById(n, F.col("bucket"))
    wide = math.isqrt(n - 1) + 1
    first = source.mapInArrow(rows_of(wide, False), EXCHANGE)
    first = first.repartition(n, "bucket", F.pmod(F.xxhash64("hashes"), F.lit(-(-n // wide))))

    def again(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, ids, extra in gathered(batches, most=AGAIN_HASHES):
            own, row = np.unique(np.stack([ids.view(np.uint64), extra]), axis=1, return_inverse=True)
            yield bucket_rows(n, hashes, row.ravel(), own[0].view(np.int64), own[1], ts.mix(ids.view(np.uint64)) if documents else None, narrow)

    return first.mapInArrow(again, EXCHANGE).repartitionById(n, F.col("bucket"))


def by_document(n_buckets: int, ids: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    """Hashes with their documents' ids, dealt out by document."""
    own, row = np.unique(ids, return_inverse=True)
    return bucket_rows(n_buckets, hashes, row, own, np.zeros(len(own), np.uint64), ts.mix(ids.view(np.uint64)))


def document_rows(name: str):
    """One row for each document that :func:`by_document` dealt to this task: ``doc_id`` and its hashes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, ids, _ in gathered(batches):
            order = np.argsort(ids, kind="stable")
            ids, hashes = ids[order], hashes[order]
            start = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            yield pa.record_batch([pa.array(ids[start], pa.int64()), ts.binary(np.split(hashes, start[1:]))], names=["doc_id", name])

    return run
