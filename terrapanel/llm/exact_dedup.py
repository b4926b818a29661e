"""Exact duplicates by a tree merge of sorted digest runs.

Every task sorts the digests of its documents into runs that hold each digest once, with the id to keep and
the number of documents.  Runs are then exchanged in rounds: in each round ``FAN_IN`` neighbouring nodes form one,
whose runs are merged and cut into ``FAN_IN`` parts by the next bits of the digest, one part for each task
(recursive halving, three binomial rounds at a time).  Equal digests meet at every level, so a text that a third
of all documents have is at most ``FAN_IN`` entries of a merge, and runs keep their size whatever the corpus.  After
the last round each part is one run; only its groups of two or more come back as rows.

Runs are sorted by the first 8 bytes of SHA-256 and entries are merged only where all 32 bytes agree; texts themselves
never leave the JVM and are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapanel.sources.shared import partitions, table

from . import textscan as ts
from .hotkeys import look_up

FAN_BITS = 3
FAN_IN = 1 << FAN_BITS
#: Entries of 49 bytes in a run before it is closed.
RUN_ROWS = 1 << 17
RUN = "node long, part long, digests binary, ids binary, known binary, counts binary"


class Run:
    """Entries in the order of their digests: digest (four words), id to keep, whether there is one, documents."""

    def __init__(self, digests: np.ndarray, ids: np.ndarray, known: np.ndarray, counts: np.ndarray):
        self.digests, self.ids, self.known, self.counts = digests, ids, known, counts

    def cut(self, first: int, last: int) -> tuple[bytes, bytes, bytes, bytes]:
        return tuple(x[first:last].tobytes() for x in (self.digests, self.ids, self.known, self.counts))


def merge(runs: list[Run], largest: bool) -> Run:
    """One run of many; of equal digests the largest (or smallest) known id stays and the counts add up."""
    digests, ids, known, counts = (np.concatenate([getattr(r, k) for r in runs]) for k in ("digests", "ids", "known", "counts"))
    order = np.argsort(digests[:, 0], kind="stable")  # finds the runs and merges them
    near = digests[order[1:], 0] == digests[order[:-1], 0]
    same = (digests[order[1:]] == digests[order[:-1]]).all(axis=1)
    if (near & ~same).any():  # different digests that begin alike
        order = np.lexsort(digests.T[::-1])
        same = (digests[order[1:]] == digests[order[:-1]]).all(axis=1)
    start = np.flatnonzero(np.concatenate([[True], ~same])) if len(order) else np.zeros(0, np.int64)
    if not len(start):
        return Run(digests, ids, known, counts)
    worst = np.iinfo(np.int64).min if largest else np.iinfo(np.int64).max
    held = np.where(known, ids, worst)[order]
    best = (np.maximum if largest else np.minimum).reduceat(held, start)
    return Run(digests[order[start]], best, np.maximum.reduceat(known[order], start), np.add.reduceat(counts[order], start))


def _leaves(largest: bool, n_parts: int, nodes: int, fan: Callable[[int, int, Run], Iterator[pa.RecordBatch]]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, k = [], 0, 0
        mine = TaskContext.get().partitionId()

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal held, size, k
            yield from fan((mine + k * n_parts) % nodes, 0, merge(held, largest))
            held, size, k = [], 0, k + 1

        for b in batches:
            n = b.num_rows
            if not n:
                continue
            words = np.frombuffer(b.column(1).cast(pa.binary(32)).buffers()[1], ">u8")[4 * b.column(1).offset :][: 4 * n].reshape(n, 4).astype(np.uint64)
            known = b.column(0).is_valid().to_numpy(zero_copy_only=False)
            held.append(Run(words, b.column(0).fill_null(0).to_numpy(), known.astype(np.uint8), np.ones(n, np.int64)))
            size += n
            if size >= RUN_ROWS:
                yield from close()
        if held:
            yield from close()
        ts.release()

    return run


def _fan(level: int) -> Callable[[int, int, Run], Iterator[pa.RecordBatch]]:
    """Sends a node's run on to the next level: its parts by the next bits of the digest."""
    shift = np.uint64(64 - FAN_BITS * (level + 1))

    def run(node: int, part: int, held: Run) -> Iterator[pa.RecordBatch]:
        edge = np.searchsorted(held.digests[:, 0] >> shift, np.arange(FAN_IN + 1, dtype=np.uint64) + np.uint64(part << FAN_BITS))
        full = [s for s in range(FAN_IN) if edge[s] < edge[s + 1]]
        cuts = [held.cut(edge[s], edge[s + 1]) for s in full]
        heads = [pa.array([node >> FAN_BITS] * len(full), pa.int64()), pa.array([(part << FAN_BITS) + s for s in full], pa.int64())]
        yield pa.record_batch([*heads, *(pa.array([c[i] for c in cuts], pa.binary()) for i in range(4))], names=["node", "part", "digests", "ids", "known", "counts"])

    return run


def _groups(node: int, part: int, held: Run) -> Iterator[pa.RecordBatch]:
    """After the last round: the groups of two or more, a row each."""
    many = np.flatnonzero(held.counts > 1)
    raw = held.digests[many].astype(">u8").tobytes()
    digests = pa.Array.from_buffers(pa.binary(32), len(many), [None, pa.py_buffer(raw)]).cast(pa.binary())
    ids = pa.array(held.ids[many], pa.int64(), mask=held.known[many] == 0)
    yield pa.record_batch([digests, ids, pa.array(held.counts[many])], names=["digest", "keep_id", "group_size"])


def _round(largest: bool, then: Callable[[int, int, Run], Iterator[pa.RecordBatch]]):
    """Merges the runs of each node and part that this task got, and passes the merged run on."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[Run]] = {}
        for b in batches:
            for node, part, *raw in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                digests, ids, known, counts = (np.frombuffer(x, kind) for x, kind in zip(raw, (np.uint64, np.int64, np.uint8, np.int64), strict=True))
                held.setdefault((node, part), []).append(Run(digests.reshape(-1, 4), ids, known, counts))
        for key in list(held):
            yield from then(*key, merge(held.pop(key), largest))
        ts.release()

    return run


def duplicate_groups(digests: DataFrame, largest: bool = True) -> tuple[DataFrame, int]:
    """``digest, keep_id, group_size`` of every digest that several rows of ``id, digest`` share, and the number of rows.

    ``digests`` is a written table of a long and 32 bytes.  ``keep_id`` is the largest (or smallest) id, null if all are.
    """
    spark, n_rows, n_parts = digests.sparkSession, digests.count(), digests.rdd.getNumPartitions()
    levels = 1
    while FAN_IN**levels < n_parts + n_rows // RUN_ROWS:
        levels += 1
    tasks = partitions(spark, n_rows, RUN_ROWS)
    runs = digests.mapInArrow(_leaves(largest, max(1, n_parts), FAN_IN**levels, _fan(0)), RUN)
    for level in range(1, levels):
        runs = runs.repartition(tasks, "node", "part").mapInArrow(_round(largest, _fan(level)), RUN)
    return runs.repartition(tasks, "node", "part").mapInArrow(_round(largest, _groups), "digest binary, keep_id long, group_size long"), n_rows


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", largest: bool = True, normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, a row for each row of ``docs``.

    Texts are equal when they are identical after ``normalise`` (no change, if none); null counts as empty.  Of equal
    texts the row with the largest id stays (the smallest, without ``largest``).  Rows without an id count in their group and
    never stay where another row has an id; a group without any id stays whole, with a null ``keep_id``.  Rows that
    repeat both id and text are one document: each counts and they share their fate.  Rows that repeat an id with another
    text are judged by their own text.  An empty table gives no rows; other columns are not read.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    plain = F.coalesce(normalise(whole), F.lit("")) if normalise else whole
    digests = table(docs.select(F.col(id_column).cast("long").alias("id"), F.unhex(F.sha2(plain.cast("binary"), 256)).alias("digest")), "digests")
    groups, n_rows = duplicate_groups(digests, largest)
    found = look_up(digests, table(groups, "groups"), "digest", n_rows, "group_size")
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return found.select(F.col("id").alias("doc_id"), keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), F.col("id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
