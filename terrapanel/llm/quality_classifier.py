"""Quality classifier: ridge regression on random Fourier features of document statistics.

Each document is described by ``STATISTICS``.  Cosines of random projections approximate a Gaussian
kernel over the standardised statistics; every partition adds up its part of the normal equations,
the parts are summed row by row in Spark, and the small system is solved on the driver.  The ridge
scores are then calibrated by isotonic regression over ``BINS`` bins of scores that documents get from
ridges which have not seen them: the equations are summed by fold, so each fold's can be left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapanel.sources.shared import table

from . import textscan as ts

STATISTICS = (
    "log_words", "mean_word", "spread_word", "long_words", "upper", "digits", "non_ascii", "end_marks", "commas",
    "shouts", "symbols", "bars", "quotes", "brackets", "distinct_words", "same_as_before", "lines_per_word", "distinct_lines", "doubled_marks", "word_end_symbols",
)
N_FEATURES = 192
RIDGE = 1e-3
BINS = 1000
FOLDS = 4
#: The part of a score that follows the ridge score itself, so that documents on one step are still ranked.
TILT = 0.01
SEED = 20240501


def _classes() -> np.ndarray:
    out = np.zeros(256, np.uint8)
    for k, chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", bytes(range(128, 256)), b".?", b",;:", b"!", b"#*$%&<>^~_=+@\\/", b"|", b"\"'`", b"()[]{}"), 1):
        out[list(chars)] = k
    return out


_CLASS = _classes()


def _hits(hit: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes are marked between each offset and the next."""
    return np.diff(np.searchsorted(np.flatnonzero(hit), offsets))


def statistics(column: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` for each text; all 0 for texts without words."""
    w = ts.words(column)
    data, offsets = ts.text_bytes(column)
    first = w.first()
    n = np.diff(first)
    some = np.maximum(n, 1)
    size = (w.end - w.start).astype(np.float64)
    chars = np.maximum(ts.row_sums(size, first), 1)
    kind = _CLASS[data]
    share = [_hits(kind == k, offsets) / chars for k in range(1, 11)]
    h = ts.word_hashes(w)
    order = np.lexsort((h, w.row))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (w.row[order][1:] != w.row[order][:-1])
    distinct = np.bincount(w.row[order][new], minlength=w.n_rows)
    same = np.zeros(len(h), np.int64)
    same[1:] = (h[1:] == h[:-1]) & (w.row[1:] == w.row[:-1])
    lines = 1 + _hits(data == 0x0A, offsets)
    doubled = np.zeros(len(data), bool)
    doubled[1:] = (data[1:] == data[:-1]) & (kind[1:] >= 4)
    last = _CLASS[data[w.end - 1]] if len(h) else np.zeros(0, np.uint8)
    mean = ts.row_sums(size, first) / some
    # Lines without a new line at the end, by what their words hash to.
    line = np.searchsorted(np.flatnonzero(data == 0x0A), w.start)
    key = w.row.astype(np.int64) * (len(data) + 1) + line
    _, at, code = np.unique(key, return_index=True, return_inverse=True)
    whole = np.zeros(len(at), np.uint64)
    np.add.at(whole, code, h * ts.powers(int(np.max(np.arange(len(h)) - at[code], initial=0)) + 1)[np.arange(len(h)) - at[code]])
    row = w.row[at]
    _, one = np.unique(ts.mix(whole) ^ ts.mix(row.astype(np.uint64)), return_index=True)
    filled, own = np.bincount(row, minlength=w.n_rows), np.bincount(row[one], minlength=w.n_rows)
    out = np.stack(
        [
            np.log1p(n), mean, np.sqrt(np.maximum(ts.row_sums(size**2, first) / some - mean**2, 0)), ts.row_sums((size > 12).astype(np.int64), first) / some, *share,
            distinct / some, ts.row_sums(same, first) / some, lines / some, own / np.maximum(filled, 1), _hits(doubled, offsets) / chars, ts.row_sums((last == 7).astype(np.int64), first) / some,
        ],
        axis=1,
    )
    out[n == 0] = 0
    return out


def _describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for c in ts.chunks(batches, limit=ts.SMALL_CHUNK_BYTES):
        x = statistics(c.column("text")).astype(np.float32)
        flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))
        yield pa.record_batch({"doc_id": c.column("doc_id"), "x": flat})


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS)).astype(np.float64)


class Features:
    """Cosines of random projections of the standardised statistics."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, n: int = N_FEATURES, width: float = 4.0):
        rng = np.random.Generator(np.random.PCG64(SEED))
        self.mean, self.spread = mean, spread
        self.w = rng.normal(0, 1 / width, (len(mean), n))
        self.b = rng.uniform(0, 2 * np.pi, n)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.concatenate([np.sqrt(2 / len(self.b)) * np.cos(z @ self.w + self.b), np.ones((len(x), 1))], axis=1)


def _normal_rows(features: Features):
    """A partition's part of the normal equations, one row for each fold and feature."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(features.b) + 1
        total = np.zeros((FOLDS, n, n + 1))
        for b in batches:
            if b.num_rows:
                z, fold = features(_matrix(b.column("x"))), b.column("fold").to_numpy()
                both = np.concatenate([z, b.column("y").to_numpy()[:, None]], axis=1)
                for k in range(FOLDS):
                    total[k] += z[fold == k].T @ both[fold == k]
        rows = total.reshape(FOLDS * n, n + 1)
        yield pa.record_batch({"feature": pa.array(np.arange(len(rows)), pa.int32()), "part": pa.array([r.tobytes() for r in rows], pa.binary())})

    return run


def _sum_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for k, part in zip(b.column("feature").to_pylist(), b.column("part").to_pylist(), strict=True):
            total[k] = total.get(k, 0) + np.frombuffer(part)
    yield pa.record_batch({"feature": pa.array(list(total), pa.int32()), "part": pa.array([x.tobytes() for x in total.values()], pa.binary())})


def isotonic(score: np.ndarray, weight: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """The rising steps nearest to ``mean`` by pooling adjacent violators; ``score`` ascends."""
    pools: list[list[float]] = []
    for w, m in zip(weight, mean, strict=True):
        pools.append([w, m, 1])
        while len(pools) > 1 and pools[-2][1] >= pools[-1][1]:
            w2, m2, n2 = pools.pop()
            w1, m1, n1 = pools.pop()
            pools.append([w1 + w2, (w1 * m1 + w2 * m2) / (w1 + w2), n1 + n2])
    return np.concatenate([np.full(n, m) for _, m, n in pools]) if pools else np.zeros(0)


class Model:
    """Calibrated scores from statistics; without any label every score is 1."""

    def __init__(self, features: Features | None, weights: np.ndarray, knots: np.ndarray, values: np.ndarray):
        self.features, self.weights, self.knots, self.values = features, weights, knots, values

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.features is None:
            return np.ones(len(x))
        raw = self.raw(x)
        return np.clip((1 - TILT) * np.interp(raw, self.knots, self.values) + TILT * np.clip((raw + 0.5) / 2, 0, 1), 0, 1)


def fit(described: DataFrame, labels: DataFrame) -> Model:
    """A model of the labels of the described documents that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y")).where("y is not null")
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    taught = table(described.where(~F.col("held_out")).join(known, "doc_id").select("x", "y", fold), "taught")
    d = len(STATISTICS)
    moments = taught.agg(F.count("*"), *(F.avg(F.col("x")[k]) for k in range(d)), *(F.stddev_pop(F.col("x")[k].cast("double")) for k in range(d))).first()
    if not moments[0]:
        return Model(None, np.zeros(0), np.zeros(1), np.ones(1))
    features = Features(np.array(moments[1 : d + 1]), np.maximum(np.array(moments[d + 1 :]), 1e-6))
    n = N_FEATURES + 1
    rows = taught.mapInArrow(_normal_rows(features), "feature int, part binary").repartition("feature").mapInArrow(_sum_rows, "feature int, part binary").collect()
    part = np.stack([np.frombuffer(x) for _, x in sorted(rows)]).reshape(FOLDS, n, n + 1)
    solve = lambda a: np.linalg.solve(a[:, :n] + RIDGE * moments[0] * np.eye(n) / n, a[:, n])
    weights = solve(part.sum(axis=0))
    unseen = np.stack([solve(part.sum(axis=0) - x) for x in part])

    def raw(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch({"s": (features(_matrix(b.column("x"))) * unseen[b.column("fold").to_numpy()]).sum(axis=1), "y": b.column("y")})

    scored = taught.mapInArrow(raw, "s double, y double")
    step = F.floor(F.least(F.greatest((F.col("s") + 0.5) / 2, F.lit(0.0)), F.lit(1.0)) * BINS)
    bins = scored.groupBy(step.alias("bin")).agg(F.avg("s"), F.count("*"), F.avg("y")).orderBy("bin").collect()
    knots, many, mean = (np.array([float(b[k]) for b in bins]) for k in (1, 2, 3))
    return Model(features, weights, knots, isotonic(knots, many, mean))


def _described(docs: DataFrame, held_out: str) -> DataFrame:
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return table(slim.mapInArrow(_describe, "doc_id long, x array<float>"), "statistics").withColumn("held_out", F.coalesce(F.expr(held_out), F.lit(False)))


HELD_OUT = "crc32(CAST(doc_id AS STRING)) % 4 = 2"
THRESHOLD = 0.7


def score_quality(docs: DataFrame, labels: DataFrame, held_out: str = HELD_OUT, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs`` (``doc_id, text``).

    ``labels`` has ``doc_id, quality`` (0 or 1); labels are learned from where ``held_out``, an SQL
    condition on ``doc_id``, is not true.  Other columns are not looked at.  ``predicted`` is 1 from
    ``threshold`` on.

    Null, empty and blank texts have all statistics 0 and a score like any other text.  Null labels and
    ids teach nothing; a null id counts as not held out.  Repeated rows count as often as they occur.
    Without any label every score is 1, so that nothing is rejected; labels of one class alone give
    scores near that class.  An empty table gives an empty
    result.
    """
    described = _described(docs, held_out)
    model = fit(described, labels)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch({"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "score": model.scores(_matrix(b.column("x")))})

    out = described.select("doc_id", "held_out", "x").mapInArrow(run, "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_quality(docs: DataFrame, labels: DataFrame, held_out: str = HELD_OUT, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the classifier does not reject.

    As :func:`score_quality`, but the documents are described again where they are filtered, which
    spares a shuffle of all texts.
    """
    model = fit(_described(docs, held_out), labels)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in ts.chunks(batches, limit=ts.SMALL_CHUNK_BYTES):
            yield c.filter(pa.array(model.scores(statistics(c.column("text")).astype(np.float32).astype(np.float64)) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op5: quality of every document."""
    return score_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
