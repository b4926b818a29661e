"""A Bloom filter over document ids, to leave out before a shuffle most rows that a join would drop.

It never holds more than ``MAX_BITS``: beyond that it lets more rows through, and the join that follows
still decides exactly.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textscan as ts

MAX_BITS = 1 << 26
SLICES = 64
PROBES = 3


def _spots(ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The slice of each id, and its bits within the slice."""
    h = ts.mix(ids.astype(np.int64).view(np.uint64) + np.uint64(0xA5A5))
    h2 = ts.mix(h)
    return (h >> np.uint64(58)).astype(np.int64), np.stack([((h2 >> np.uint64(20 * k)) & np.uint64(bits - 1)).astype(np.int64) for k in range(PROBES)])


class IdFilter:
    """``slices`` of ``bits`` each; ``holds`` may say yes to a few ids that are not there."""

    def __init__(self, slices: dict[int, bytes], bits: int):
        self.bits = bits
        self.field = np.frombuffer(b"".join(slices.get(k, b"").ljust(bits // 8, b"\0") for k in range(SLICES)), np.uint8)

    def holds(self, ids: np.ndarray) -> np.ndarray:
        part, spot = _spots(ids, self.bits)
        return (self.field[part * (self.bits // 8) + (spot >> 3)] >> (spot & 7).astype(np.uint8) & 1).all(axis=0)


def build(ids: DataFrame, column: str) -> IdFilter:
    """A filter of the non-null whole numbers in a column."""
    ids = ids.select(F.col(column).cast("long").alias("id")).where("id is not null")
    count = ids.count()
    bits = min(MAX_BITS // SLICES, max(64, 1 << int(16 * count // SLICES).bit_length()))

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mine = b.column(0).to_numpy()
            part, _ = _spots(mine, bits)
            for k in np.unique(part):
                yield pa.record_batch({"slice": pa.array([int(k)], pa.int32()), "ids": pa.array([mine[part == k].tobytes()], pa.binary())})

    def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for b in batches:
            for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                field = found.setdefault(k, np.zeros(bits, bool))
                field[_spots(np.frombuffer(x, np.int64), bits)[1].ravel()] = True
        for k, field in found.items():
            yield pa.record_batch({"slice": pa.array([k], pa.int32()), "bits": pa.array([np.packbits(field, bitorder="little").tobytes()], pa.binary())})

    slices = ids.mapInArrow(deal, "slice int, ids binary").repartitionById(SLICES, F.col("slice")).mapInArrow(fill, "slice int, bits binary")
    return IdFilter(dict(slices.collect()), bits)


def _flags(column: pa.Array, filter_: IdFilter) -> np.ndarray:
    known = column.is_valid().to_numpy(zero_copy_only=False)
    return known & filter_.holds(pc.fill_null(column.cast(pa.int64()), 0).to_numpy())


def held_first(run, sent, column: str = "doc_id", held: bool = True):
    """``run``, a function over Arrow batches, on the rows that :func:`keep_held` would leave by the broadcast filter ``sent``:
    for one Python worker a task, where ``run`` after :func:`keep_held` takes two."""

    def left(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(_flags(b.column(column), sent.value) == held))
        ts.release()

    return lambda batches: run(left(batches))


def keep_held(docs: DataFrame, filter_: IdFilter, column: str = "doc_id", held: bool = True) -> DataFrame:
    """The rows of ``docs`` whose id the filter holds, or those whose id it doesn't (null ids among them)."""
    sent = docs.sparkSession.sparkContext.broadcast(filter_)
    return docs.mapInArrow(held_first(lambda batches: batches, sent, column, held), docs.schema)


def without(docs: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is not in the one column of ``ids``; rows without an id stay.

    Only rows that a filter of the ids holds are joined, so the other texts are not shuffled.
    """
    gone = ids.toDF("gone").where("gone is not null").distinct()
    filter_ = build(gone, "gone")
    asked = keep_held(docs, filter_, column).join(gone, F.col(column) == F.col("gone"), "left_anti")
    return keep_held(docs, filter_, column, held=False).unionByName(asked)
