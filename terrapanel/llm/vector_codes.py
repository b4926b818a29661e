"""Codes of vectors by parts: integer k-means with balls around the entries of each part's codebook.

A part's last known entry is its ball.  Distances between entries say what can be nearer: an entry at distance
``g`` from the ball's centre can be as near as the centre only to parts that lie ``g / 2`` or more from it.  So a ball's radius
gives its neighbours; parts within half the distance to the nearest neighbour are the ball's stable core and need
no further distance; the others lie in rings, and a part in the ring between two neighbours' half distances meets the
nearer neighbours only.  All of it is whole-number arithmetic, so ties are exact.

The vectors are written once, with the entries of the first assignment as balls; each round reads them and brings back
one row for each entry and task with its sums.  Codebooks (at most 8 x 16 entries) are all that the driver holds.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapanel.sources.shared import table

from . import textscan as ts
from .hotkeys import look_up

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6

Codebooks = list[np.ndarray]


def whole_numbers(flat: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)`` of finite floats: 64-bit where squared distances surely fit, Python's whole numbers otherwise."""
    scaled = np.floor(flat.astype(np.float64) * scale)
    if not len(flat) or np.abs(scaled).max() < 1 << 26:
        return scaled.astype(np.int64)
    return np.array([math.floor(x * scale) if abs(x) < 1 << 40 else int(x) * scale for x in flat.astype(np.float64).tolist()], dtype=object)


def spans(dim: int, n_parts: int = PARTS) -> list[tuple[int, int]]:
    """Where each part begins and ends: equal parts; where ``dim`` can't be divided, the first are longer by one."""
    size = [dim // n_parts + (k < dim % n_parts) for k in range(n_parts)]
    edge = np.concatenate([[0], np.cumsum(size)])
    return [(int(a), int(b)) for a, b in zip(edge[:-1], edge[1:], strict=True)]


class Balls:
    """The geometry of one codebook: for each entry the others by distance."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        gap = ((entries[:, None] - entries[None]) ** 2).sum(axis=2)
        for k in range(len(entries)):
            gap[k, k] = -1
        self.near = np.argsort(gap, axis=1, kind="stable")[:, 1:]
        self.gap = np.take_along_axis(gap, self.near, axis=1)

    def nearest(self, x: np.ndarray, ball: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's nearest entry (ties to the lower index) and its squared distance, starting from its ball."""
        apart = ((x - self.entries[ball]) ** 2).sum(axis=1)
        best, least = ball.copy(), apart.copy()
        if not self.near.shape[1]:
            return best, least
        radius = np.full(len(self.entries), -1, dtype=apart.dtype)
        np.maximum.at(radius, ball, apart)
        neighbours = (self.gap <= 4 * radius[:, None]).sum(axis=1).astype(np.int64)
        open_ = np.flatnonzero((neighbours[ball] > 0) & (self.gap[ball, 0] <= 4 * apart))
        for k in range(int(neighbours.max(initial=0))):
            open_ = open_[(self.gap[ball[open_], k] <= 4 * apart[open_]).astype(bool)]
            if not len(open_):
                break
            other = self.near[ball[open_], k]
            d = ((x[open_] - self.entries[other]) ** 2).sum(axis=1)
            better = ((d < least[open_]) | ((d == least[open_]) & (other < best[open_]))).astype(bool)
            best[open_[better]], least[open_[better]] = other[better], d[better]
        return best, least


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return whole_numbers(column.flatten().to_numpy(zero_copy_only=False)).reshape(len(column), dim)


def _parts(batch: pa.RecordBatch, cut: list[tuple[int, int]], balls: list[Balls]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each part position: the parts, their nearest entries and squared distances."""
    x = _matrix(batch.column("vector"), cut[-1][1])
    known = np.frombuffer(b"".join(batch.column("ball").to_pylist()), np.uint8).reshape(-1, len(cut)) if "ball" in batch.schema.names else np.zeros((len(x), len(cut)), np.uint8)
    for p, (a, b) in enumerate(cut):
        part, entries = x[:, a:b], balls[p].entries
        if part.dtype != entries.dtype:
            part = part.astype(object)
        yield part, *balls[p].nearest(part, known[:, p].astype(np.int64))


def _sums(cut: list[tuple[int, int]], balls: list[Balls]):
    """``spot, total``: for each entry (part * ENTRIES + entry) the number of this task's parts and their sums, as text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[int]] = {}
        for b in batches:
            if not b.num_rows:
                continue
            for p, (part, code, _) in enumerate(_parts(b, cut, balls)):
                for e in np.unique(code).tolist():
                    mine = part[code == e]
                    held = found.setdefault(p * ENTRIES + e, [0] * (part.shape[1] + 1))
                    for i, v in enumerate([len(mine), *mine.sum(axis=0).tolist()]):
                        held[i] += int(v)
        yield from _totals(found)
        ts.release()

    return run


def _totals(found: dict[int, list[int]]) -> Iterator[pa.RecordBatch]:
    yield pa.record_batch({"spot": pa.array(list(found), pa.int32()), "total": pa.array([",".join(map(str, v)) for v in found.values()], pa.string())})


def _add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The totals of each spot added up, in whole numbers of any size."""
    found: dict[int, list[int]] = {}
    for b in batches:
        for spot, total in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            new = list(map(int, total.split(",")))
            found[spot] = [x + y for x, y in zip(found[spot], new, strict=True)] if spot in found else new
    yield from _totals(found)


def _with_balls(cut: list[tuple[int, int]], balls: list[Balls]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                code = np.stack([c for _, c, _ in _parts(b, cut, balls)], axis=1).astype(np.uint8)
                yield b.append_column("ball", pa.array([x.tobytes() for x in code], pa.binary()))

    return run


def _codes(cut: list[tuple[int, int]], balls: list[Balls]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            found = [(c, d) for _, c, d in _parts(b, cut, balls)]
            code = np.stack([c for c, _ in found], axis=1).astype(np.uint8).tobytes().hex()
            error = sum(d.astype(object) for _, d in found).tolist()
            width = 2 * len(cut)
            yield pa.record_batch(
                [b.column("vec_id"), b.column("label"), pa.array([code[k * width : (k + 1) * width] for k in range(b.num_rows)]), pa.array([int(e) if e < 1 << 63 else None for e in error], pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )
        ts.release()

    return run


def _array(values: list[list[int]]) -> np.ndarray:
    """Entries as 64-bit numbers, or as Python's own where they are large."""
    large = any(abs(x) >= 1 << 26 for row in values for x in row)
    return np.array(values, dtype=object if large else np.int64).reshape(len(values), len(values[0]) if values else 0)


def _first_entries(vectors: DataFrame, cut: list[tuple[int, int]]) -> Codebooks:
    ids = [r[0] for r in vectors.where("vec_id is not null").select("vec_id").distinct().orderBy("vec_id").limit(ENTRIES).collect()]
    rows = vectors.where(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("vector").alias("vector")).orderBy("vec_id").collect()
    whole = [whole_numbers(np.array(r["vector"], np.float64)).tolist() for r in rows]
    return [_array([v[a:b] for v in whole]) for a, b in cut]


def finite_vectors(vectors: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """``vec_id, label, vector`` of the rows whose vector has finite components only, one at least."""
    x = F.col(vector)
    ok = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    kept = vectors.where(x.isNotNull()).where(ok & (F.size(x) > 0))
    return kept.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), x.alias("vector"))


def train(vectors: DataFrame, rounds: int = ROUNDS, n_parts: int = PARTS) -> tuple[DataFrame, list[tuple[int, int]], Codebooks]:
    """Codebooks after ``rounds`` rounds, the vectors with their balls as a written table, and the parts' spans.

    The entries start as the parts of the ``ENTRIES`` smallest ids; of rows that repeat an id the smallest vector counts,
    and rows without an id are coded but never start an entry.  Vectors of another length than most (ties: the shorter)
    can't be compared and are left out.
    """
    sizes = vectors.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    cut = spans(sizes["dim"] if sizes else n_parts, n_parts)
    vectors = vectors.where(F.size("vector") == cut[-1][1])
    books = _first_entries(vectors, cut)
    if not len(books[0]):  # no vector has an id: nothing to start from
        return vectors.limit(0).withColumn("ball", F.lit(None).cast("binary")), cut, books
    balls = [Balls(b) for b in books]
    schema = f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, label {vectors.schema['label'].dataType.simpleString()}, vector {vectors.schema['vector'].dataType.simpleString()}, ball binary"
    held = table(vectors.mapInArrow(_with_balls(cut, balls), schema), "vectors")
    for _ in range(rounds):
        totals = held.mapInArrow(_sums(cut, balls), "spot int, total string").repartition("spot").mapInArrow(_add, "spot int, total string").collect()
        values = [b.tolist() for b in books]
        for spot, total in totals:
            n, *sums = map(int, total.split(","))
            values[spot // ENTRIES][spot % ENTRIES] = [s // n for s in sums]
        new = [_array(v) for v in values]
        if all((a == b).all() for a, b in zip(new, books, strict=True)):
            break  # every further round would give the same
        books, balls = new, [Balls(b) for b in new]
    return held, cut, books


def codebooks_digest(books: Codebooks) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for row in b.tolist() for x in row).encode()).hexdigest()


def encode(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for each row with a finite vector.

    Rows whose vector is null, empty or has a null or non-finite component are left out, and so are those whose length is not
    the commonest.  Repeated rows are coded as often as they occur.  With fewer than 16 different ids there are fewer entries.
    An empty table, or one without any id, gives no rows.  ``label_error`` adds up the errors of equal labels, nulls together; an error beyond 64
    bits is null.  Other columns are not read.
    """
    held, cut, books = train(finite_vectors(vectors, vec_id, vector, label), rounds)
    balls = [Balls(b) for b in books]
    kind = f"vec_id {held.schema['vec_id'].dataType.simpleString()}, label {held.schema['label'].dataType.simpleString()}, code string, error long"
    coded = table(held.mapInArrow(_codes(cut, balls), kind), "codes")
    sums = table(coded.groupBy("label").agg(F.try_sum("error").alias("label_error"), F.count("*").alias("n")), "label-errors")
    found = look_up(coded, sums, "label", coded.count(), "n")
    return found.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql() -> str:
    """Every round as two steps: distances to all entries, then means."""
    steps = [
        "kept AS MATERIALIZED (SELECT vec_id, label, [CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)",
        "comp AS MATERIALIZED (SELECT vec_id, i // 8 AS part, i % 8 AS pos, v[i + 1] AS x FROM (SELECT vec_id, v, unnest(range(64)) AS i FROM kept))",
        "c0 AS MATERIALIZED (SELECT part, entry, pos, x FROM comp JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < 16) USING (vec_id))",
    ]
    for r in range(ROUNDS + 1):
        steps.append(f"a{r} AS MATERIALIZED (SELECT vec_id, part, min_by(entry, d * 16 + entry) AS entry, min(d) AS d FROM (SELECT vec_id, comp.part, entry, sum((comp.x - c.x) * (comp.x - c.x)) AS d FROM comp JOIN c{r} c ON comp.part = c.part AND comp.pos = c.pos GROUP BY ALL) GROUP BY 1, 2)")
        if r < ROUNDS:
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT part, entry, pos, coalesce(m, x) AS x FROM c{r} LEFT JOIN (SELECT part, entry, pos, CAST(floor(sum(x) / count(*)) AS BIGINT) AS m FROM comp JOIN a{r} USING (vec_id, part) GROUP BY ALL) USING (part, entry, pos))")
    return f"""WITH {", ".join(steps)}, done AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY 1)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM c{ROUNDS}) AS codebooks_sha256
FROM done JOIN kept USING (vec_id)"""


SQL = _sql()
