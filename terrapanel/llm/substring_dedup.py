"""Substring dedup with difference-cover anchors.

A passage of ``window`` words that starts at i in one document and at j in another has, for a perfect
difference cover D modulo v, an offset d < v with both i + d and j + d in D modulo v.  So it suffices
to hash short anchors (``window - v + 1`` words) at the cover's positions: an anchor seen in two
different texts marks the places that may repeat, and only the windows around those are hashed whole
and compared.  With v = 31 one position in five is hashed.

The anchors travel as one packed row per chunk of documents and range of hashes, so a frequent passage
adds ten bytes for each document to a task that holds one range of hashes, and never makes pairs.
Equal texts are found first by a fingerprint of their words; a text's copies then count as one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapanel.sources.shared import discard, partitions, table

from . import idfilter
from . import textscan as ts
from .exchange import bucket_rows, by_document, deal, document_rows, gathered

#: Perfect difference covers by their period.
COVERS = {31: (0, 1, 3, 8, 12, 18), 13: (0, 1, 3, 9), 7: (0, 1, 3), 3: (0, 1), 1: (0,)}
WORDS_PER_TASK = 4_000_000
SALTS = 16


def cover_for(window: int) -> tuple[int, np.ndarray]:
    """The largest period that leaves anchors of two fifths of the window, and its cover as a mask."""
    period = next(v for v in COVERS if v == 1 or 5 * (window - v + 1) >= 2 * window)
    mask = np.zeros(period, dtype=bool)
    mask[list(COVERS[period])] = True
    return period, mask


def _anchors(w: ts.Words, h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes and first words of the anchors, and an anchor's words."""
    period, cover = cover_for(window)
    size = window - period + 1
    run = ts.run_hashes(h, size)
    if not len(run):
        return run, np.zeros(0, np.int64), size
    at = np.arange(len(run))
    place = at - w.first()[w.row[: len(run)]]
    ok = cover[place % period] & (w.row[: len(run)] == w.row[size - 1 :])
    return run[ok], at[ok], size


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for c in ts.chunks(batches, limit=ts.SMALL_CHUNK_BYTES):
        w = ts.words(c.column("text"))
        h, first = ts.word_hashes(w), w.first()
        yield pa.record_batch({"doc_id": c.column("doc_id"), "n_words": np.diff(first), "print": ts.whole_hashes(h, first).view(np.int64), "print2": ts.whole_hashes(ts.mix(h + np.uint64(1)), first).view(np.int64)})


def _anchor_rows(window: int, n_buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in ts.chunks(batches, limit=ts.SMALL_CHUNK_BYTES):
            w = ts.words(c.column("text"))
            h = ts.word_hashes(w)
            anchors, at, _ = _anchors(w, h, window)
            if len(anchors):
                yield bucket_rows(n_buckets, anchors, w.row[at], c.column("doc_id").to_numpy(), ts.whole_hashes(h, w.first()))

    return run


def _shared_anchors(n_buckets: int):
    """The anchors found in two different texts, for the first document of each text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, ids, prints in gathered(batches):
            order = np.lexsort((ids, prints, hashes))
            hashes, ids, prints = hashes[order], ids[order], prints[order]
            new = np.concatenate([[True], hashes[1:] != hashes[:-1]])
            first = new | np.concatenate([[True], prints[1:] != prints[:-1]])
            hashes, ids, new = hashes[first], ids[first], new[first]
            start = np.flatnonzero(new)
            shared = np.repeat(np.diff(np.append(start, len(hashes))) > 1, np.diff(np.append(start, len(hashes))))
            yield by_document(n_buckets, ids[shared], hashes[shared])

    return run


def _window_rows(window: int, n_buckets: int):
    """Hashes of the whole windows that hold a shared anchor."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in ts.chunks(batches, limit=ts.SMALL_CHUNK_BYTES):
            w = ts.words(c.column("text"))
            h = ts.word_hashes(w)
            anchors, at, size = _anchors(w, h, window)
            shared = np.frombuffer(b"".join(c.column("shared").to_pylist()), np.uint64)
            at = at[np.isin(anchors, shared)]
            first = w.first()
            low = np.maximum(at - (window - size), first[w.row[at]])
            high = np.minimum(at, first[w.row[at] + 1] - window) + 1
            ok = low < high
            edge = np.bincount(low[ok], minlength=len(h) + 1) - np.bincount(high[ok], minlength=len(h) + 1)
            begin = np.flatnonzero(np.cumsum(edge) > 0)
            if len(begin):
                yield bucket_rows(n_buckets, ts.run_hashes(h, window)[begin], w.row[begin], c.column("doc_id").to_numpy(), np.zeros(c.num_rows, np.uint64))

    return run


def _later_windows(n_buckets: int):
    """The windows that also start in a document with a smaller id."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, ids, _ in gathered(batches):
            order = np.lexsort((ids, hashes))
            hashes, ids = hashes[order], ids[order]
            start = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
            least = np.repeat(ids[start], np.diff(np.append(start, len(ids))))
            later = (ids > least) & np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (ids[1:] != ids[:-1])])
            yield by_document(n_buckets, ids[later], hashes[later])

    return run


def _removed(window: int, carry: Sequence[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in ts.chunks(batches, limit=ts.SMALL_CHUNK_BYTES):
            w = ts.words(c.column("text"))
            first = w.first()
            gone = np.zeros(len(w.start) + 1, np.int64)
            copies, windows = c.column("copies").to_pylist(), c.column("windows").to_pylist()
            if any(copies) or any(windows):
                h = ts.word_hashes(w)
                prints, run_h = ts.whole_hashes(h, first), ts.run_hashes(h, window)
                for k in range(c.num_rows):
                    a, b = first[k], first[k + 1]
                    if copies[k] and b - a >= window and prints[k].view(np.int64) in copies[k]:
                        gone[a] += 1
                        gone[b] -= 1
                    elif windows[k] and b - a >= window:
                        hit = a + np.flatnonzero(np.isin(run_h[a : b - window + 1], np.frombuffer(windows[k], np.uint64)))
                        gone[hit] += 1
                        gone[hit + window] -= 1
            keep = np.cumsum(gone)[:-1] <= 0
            kept = ts.join_words(w, keep)
            yield pa.record_batch({"doc_id": c.column("doc_id"), "n_words": np.diff(first), "n_removed": ts.row_sums((~keep).astype(np.int64), first), "kept_text": kept} | {x: c.column(f"carry_{x}") for x in carry})

    return run


def remove_repeats(docs: DataFrame, window: int = 50, carry: Sequence[str] = ()) -> DataFrame:
    """Removes each word covered by a window that also starts in a document with a smaller id.

    ``docs`` needs ``doc_id`` (whole number) and ``text``; of other columns only those in ``carry`` are
    looked at and returned.  Result: ``doc_id, n_words, n_removed, kept_text`` and the carried columns;
    ``kept_text`` holds the words that stay, joined by single spaces.

    Null and empty texts have no words and give an empty ``kept_text``.  Rows with a null ``doc_id``
    come after all others and before none: they stay whole and remove nothing.  Repeated rows share an
    id, so neither removes the other.  An empty table gives an empty result.  Texts of any length are
    read whole.  Windows are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("doc_id").isNotNull())
    texts = table(slim.mapInArrow(_texts, "doc_id long, n_words long, print long, print2 long"), "texts")
    total = texts.agg(F.sum("n_words")).first()[0] or 0
    n = partitions(spark, total, WORDS_PER_TASK)

    anchors = deal(slim, lambda k, _: _anchor_rows(window, k), n)
    shared = deal(anchors, lambda k, _: _shared_anchors(k), n, documents=True).mapInArrow(document_rows("shared"), "doc_id long, shared binary")
    shared = table(shared, "shared")
    near = idfilter.keep_held(slim, idfilter.build(shared, "doc_id"))
    windows = deal(near.join(shared.hint("merge"), "doc_id"), lambda k, _: _window_rows(window, k), n)
    later = deal(windows, lambda k, _: _later_windows(k), n, documents=True).mapInArrow(document_rows("windows"), "doc_id long, windows binary")

    long_texts = texts.where(F.col("n_words") >= window)
    least = long_texts.groupBy("print", "print2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    # A text with very many copies is dealt out by salt.
    least = least.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    salted = long_texts.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    copies = salted.join(least, ["print", "print2", "salt"]).where("doc_id > least").groupBy("doc_id").agg(F.collect_set("print").alias("copies"))

    marks = table(copies.join(later, "doc_id", "full_outer").select(F.col("doc_id").alias("mark_id"), "copies", "windows"), "marks")
    discard(texts, shared)
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *(F.col(x).alias(f"carry_{x}") for x in carry))
    types = dict(docs.dtypes)
    out = "doc_id long, n_words long, n_removed long, kept_text string" + "".join(f", `{x}` {types[x]}" for x in carry)
    # Only texts that may have marks are shuffled to them.
    marked = idfilter.build(marks, "mark_id")
    # By a merge, which parts the two steps in Python; so a task never has two workers.
    some = idfilter.keep_held(whole, marked).join(marks.hint("merge"), F.col("doc_id") == F.col("mark_id"), "left").drop("mark_id")
    rest = whole.withColumns({x: F.lit(None).cast(marks.schema[x].dataType) for x in ("copies", "windows")})
    unmarked = idfilter.held_first(_removed(window, carry), spark.sparkContext.broadcast(marked), held=False)
    return rest.mapInArrow(unmarked, out).unionByName(some.mapInArrow(_removed(window, carry), out))


def query(spark, sf_dir: str) -> DataFrame:
    """op6: the digest of the kept words of every document."""
    kept = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
