"""N-gram Jaccard join by vertical partitioning.

The hashes of the shingles are one global order, and a document's set is cut into fragments, equal
ranges of that order.  Two sets of J >= t differ in at most d = (1 - t) / (1 + t) * (|x| + |y|)
shingles, so of more than d fragments at least one is the same in both: fragments with the same
content propose pairs.  Pairs that a sketch does not rule out have their sets cut again into a few
fragments, the overlaps are counted in each on its own, and the counts are summed for each pair.

A frequent shingle alone proposes nothing, since it shares its fragment with a document's own ones.
Copies are one node from the start.  Among documents with the same fragment only pairs with the
best-connected one are proposed at first; what that links is one component.  Where a fragment's
documents are then still in several components, shingles that none of these documents has in common
with another bound what each can share: most stand alone.  The rest are compared by parity sketches,
within their fragment and a bounded number of them at a time; of the pairs between components that the
sketches do not rule out only those become rows and are counted that would join two components.  What then still has such a
pair to another component is compared by its set.  So a group of n near copies makes about n rows, and no
link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapanel.operators.components import connected_components
from terrapanel.sources.shared import discard, partitions, table

from . import idfilter
from . import textscan as ts
from .exchange import bucket_rows, by_document, deal, gathered

SHINGLES_PER_TASK = 2_000_000
#: Sets take several times the memory of their texts.
CHUNK_BYTES = 1 << 20
PAIR_FRAGMENTS = 8
#: Bits of a sketch: a power of two, twice the shingles at least.
LEAST_BITS = 1024
#: So many documents of a fragment, and shingles (8 bytes each), are compared in one task; larger groups are dealt out in pairs of blocks.
BLOCK = 4096
BLOCK_SHINGLES = 1_000_000
#: So many rows' names (8 bytes each) are left out by a broadcast.
BROADCAST_IDS = 1_000_000
_TOP = np.uint64(32)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row, ascending, and where each row's begin (and the end)."""
    w = ts.words(column, lower=True)
    h, first = ts.word_hashes(w), w.first()
    run = ts.run_hashes(h, size)
    same = w.row[: len(run)] == w.row[size - 1 :] if len(run) else np.zeros(0, bool)
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < size))
    whole = ts.whole_hashes(h, first)
    value = np.concatenate([run[same], whole[short]])
    row = np.concatenate([w.row[: len(run)][same], short])
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[new], row[new]
    return value, np.searchsorted(row, np.arange(w.n_rows + 1))


def _prints(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return tuple(ts.mix(ts.row_sums(ts.mix(value ^ np.uint64(k)), first) + np.diff(first).astype(np.uint64)).view(np.int64) for k in (0x5DEECE66D, 0xB504F333))


def _set_rows(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in ts.chunks(batches, limit=CHUNK_BYTES):
            value, first = shingle_sets(c.column("text"), size)
            a, b = _prints(value, first)
            yield pa.record_batch({"doc_id": c.column("doc_id"), "n_shingles": np.diff(first), "node": a, "node2": b})

    return run


def levels(n_max: int, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The least size of each level, the fragments that its sets are cut into, and how many are to spare.

    A level reaches to 1/t times its least size, so linked sets are at most one level apart; the number
    of fragments is over the most that two linked sets can differ in, with room for empty fragments.
    """
    least, cut, spare = [1], [], []
    while least[-1] <= n_max:
        top = least[-1] * den // num
        most = top + top * den // num
        differ = most * (den - num) // (den + num)
        spare.append(1 + differ // 20)
        cut.append(differ + 1 + spare[-1])
        least.append(top + 1)
    return np.array(least[:-1] or [1]), np.array(cut or [1]), np.array(spare or [0])


def _signatures(size: int, num: int, den: int, n_max: int, n_buckets: int, narrow: bool):
    least, cut, spare = levels(n_max, num, den)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in ts.chunks(batches, limit=CHUNK_BYTES):
            value, first = shingle_sets(c.column("text"), size)
            count = np.diff(first)
            node, _ = _prints(value, first)
            _, one = np.unique(node, return_index=True)
            mine = np.zeros(len(count), bool)
            mine[one] = True
            mine &= count > 0
            pick = np.repeat(mine, count)
            row = np.repeat(np.arange(len(count)), count)[pick]
            value = value[pick]
            own = np.searchsorted(least, count, side="right") - 1
            sums = ts.mix(value ^ np.uint64(0x5851F42D4C957F2D))
            found, owner = [], []
            for below in (0, 1):
                level = own - below
                ok = level[row] >= 0
                r, lv = row[ok], level[row[ok]]
                k = cut[lv].astype(np.uint64)
                part = ((value[ok] >> _TOP) * k) >> _TOP
                start = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (part[1:] != part[:-1])])) if len(r) else np.zeros(0, np.int64)
                if not len(start):
                    continue
                label = part[start] + (lv[start].astype(np.uint64) << _TOP)
                found.append(ts.mix(np.add.reduceat(sums[ok], start) ^ ts.mix(label + np.uint64(1))))
                owner.append(r[start])
                shown, fragment = r[start], part[start]
                # A set with more empty fragments than the spare ones must show them too.
                used = np.bincount(shown, minlength=len(count))
                bare = np.flatnonzero(mine & (level >= 0) & (cut[np.maximum(level, 0)] - used > spare[np.maximum(level, 0)]))
                for x in bare:
                    empty = np.setdiff1d(np.arange(cut[level[x]], dtype=np.uint64), fragment[shown == x])
                    found.append(ts.mix(ts.mix(empty + (np.uint64(level[x]) << _TOP) + np.uint64(1))))
                    owner.append(np.full(len(empty), x))
            if found:
                owner = np.concatenate(owner)
                yield bucket_rows(n_buckets, np.concatenate(found), owner, node, count.astype(np.uint64), narrow=narrow)

    return run


def _linkable(a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    a, b = a.astype(np.int64), b.astype(np.int64)
    return den * np.minimum(a, b) >= num * np.maximum(a, b)


def _proposals(num: int, den: int):
    """Pairs with the best-connected node of each fragment's group, and the groups of three or more."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sig, node, size in gathered(batches, narrow=True):
            order = np.lexsort((node, sig))
            sig, node, size = sig[order], node[order], size[order]
            new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])])
            sig, node, size = sig[new], node[new], size[new]
            start = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            many = np.diff(np.append(start, len(sig)))
            ok = np.repeat(many > 1, many)
            sig, node, size, many = sig[ok], node[ok], size[ok], many[many > 1]
            if not len(sig):
                continue
            group = np.repeat(np.arange(len(many)), many)
            _, who = np.unique(node, return_inverse=True)
            support = np.bincount(who, weights=np.repeat(many, many))[who]
            best = np.lexsort((node, -support, group))
            start = np.concatenate([[0], np.cumsum(many)[:-1]])
            pivot = best[start][group]
            pair = (node != node[pivot]) & _linkable(size, size[pivot], num, den)
            a, b = np.minimum(node, node[pivot])[pair], np.maximum(node, node[pivot])[pair]
            key, one = np.unique(ts.mix(a.view(np.uint64)) + b.view(np.uint64), return_index=True)
            big = many > 2
            # Groups of the same nodes count once.
            total = np.add.reduceat(ts.mix(node.view(np.uint64)), start)
            _, once = np.unique(total[big], return_index=True)
            chosen = np.flatnonzero(big)[once]
            packed = [np.stack([node[s : s + m], size[s : s + m].view(np.int64)]) for s, m in zip(start[chosen], many[chosen], strict=True)]
            yield pa.record_batch(
                [pa.array([0] + [1] * len(packed), pa.int8()), ts.binary([np.stack([a[one], b[one]]), *packed]), pa.array([0, *total[chosen].view(np.int64).tolist()], pa.int64())],
                names=["kind", "packed", "group_id"],
            )

    return run


def _unpack_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for x in batch.column(0).to_pylist():
            a, b = np.frombuffer(x, np.int64).reshape(2, -1)
            yield pa.record_batch({"a": a, "b": b})


def _unpack_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for g, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            node, size = np.frombuffer(x, np.int64).reshape(2, -1)
            yield pa.record_batch({"group_id": np.full(len(node), g), "node": node, "size": size})


def _fragments(size: int, held):
    """The sets of the documents that the filter holds: a sketch, and the set cut into ``PAIR_FRAGMENTS`` ranges."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 36
        for batch in batches:
            some = batch.filter(pa.array(held.value.holds(batch.column("doc_id").to_numpy())))
            for c in ts.chunks([some], limit=CHUNK_BYTES):
                value, first = shingle_sets(c.column("text"), size)
                node, _ = _prints(value, first)
                _, one = np.unique(node, return_index=True)
                full = one[np.diff(first)[one] > 0]
                sketches, parts = [], []
                for k in full:
                    mine = value[first[k] : first[k + 1]]
                    sketches.append(_sketch(mine).tobytes())
                    edge = ts.by_bucket(mine, PAIR_FRAGMENTS)
                    parts.append([mine[edge[f] : edge[f + 1]].tobytes() for f in range(PAIR_FRAGMENTS)])
                uid += len(full)
                yield pa.record_batch({"uid": np.arange(uid - len(full), uid), "node": node[full], "size": np.diff(first)[full], "sketch": pa.array(sketches, pa.binary()), "parts": pa.array(parts, pa.list_(pa.binary()))})

    return run


SETS = "uid long, node long, size long, sketch binary, parts array<binary>"


def _once(found: DataFrame) -> DataFrame:
    """Each node's set once; only the names of rows move, not their sets, unless there are very many to leave out."""
    rows = found.select("node", "uid")
    first = rows.groupBy("node").agg(F.min("uid").alias("first"), F.count("*").alias("n")).where("n > 1")
    again = table(rows.join(first, "node").where("uid <> first").select(F.col("uid").alias("again")), "again")
    if again.count() <= BROADCAST_IDS:
        return found.join(F.broadcast(again), F.col("uid") == F.col("again"), "left_anti").drop("uid")
    return table(idfilter.without(found, again, "uid").drop("uid"), "fragments")


def _sketch(value: np.ndarray) -> np.ndarray:
    """For each of 2^k ranges of mixed shingles whether an odd number of them is in it.

    Two sketches differ in no more bits than the sets differ in shingles.  Ranges are told by the last
    bits, so a sketch of half the width is the two halves by exclusive or.
    """
    bits = max(LEAST_BITS, 1 << int(2 * len(value) - 1).bit_length())
    odd = np.bincount((ts.mix(value) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _as_wide(sketches: list[bytes]) -> np.ndarray:
    """The sketches as rows of the width that the narrowest has."""
    n = min(map(len, sketches)) // 8
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(x, np.uint64).reshape(-1, n), axis=0) for x in sketches])


def _may_link(x: np.ndarray, y: np.ndarray, total: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether sets of so many shingles together may link, going by their sketches."""
    least = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
    return den * (total - least) >= num * (total + least)


def _plausible(num: int, den: int):
    """The pairs that their sketches do not rule out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, y = b.column("x").to_pylist(), b.column("y").to_pylist()
            width = np.array([min(len(p), len(q)) for p, q in zip(x, y, strict=True)])
            total = b.column("total").to_numpy()
            ok = np.zeros(b.num_rows, bool)
            for n in np.unique(width):
                mine = np.flatnonzero(width == n)
                both = _as_wide([x[k] for k in mine] + [y[k] for k in mine])
                ok[mine] = _may_link(both[: len(mine)], both[len(mine) :], total[mine], num, den)
            yield b.select(["a", "b"]).filter(pa.array(ok))

    return run


def _overlaps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many shingles each pair has in common in one fragment."""
    for batch in batches:
        common = [len(np.intersect1d(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), assume_unique=True)) for p, q in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)]
        yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b"), "total": batch.column("total"), "common": pa.array(common, pa.int64())})


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``a, b`` that link, as a table: overlaps counted in each fragment on its own and summed for each pair."""

    def both(of: DataFrame, kept: DataFrame, column: str) -> DataFrame:
        x = kept.select(F.col("node").alias("a"), F.col(column).alias("x"), F.col("size").alias("size_a"))
        y = kept.select(F.col("node").alias("b"), F.col(column).alias("y"), F.col("size").alias("size_b"))
        return of.join(x, "a").join(y, "b").select("a", "b", "x", "y", (F.col("size_a") + F.col("size_b")).alias("total"))

    likely = table(both(pairs, sets, "sketch").mapInArrow(_plausible(num, den), "a long, b long"), "likely")
    asked = idfilter.build(likely.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node")
    # Written, for the counting is a step in Python too, and a task should have one worker.
    held = table(idfilter.keep_held(sets, asked, "node").select("node", "size", "parts"), "asked")
    met = both(likely, held, "parts")
    met = met.select("a", "b", "total", F.posexplode(F.arrays_zip("x", "y")).alias("fragment", "part")).select("a", "b", "total", "fragment", "part.x", "part.y")
    summed = met.mapInArrow(_overlaps, "a long, b long, total long, common long").groupBy("a", "b", "total").agg(F.sum("common").alias("common"))
    found = table(summed.where(F.lit(den) * F.col("common") >= F.lit(num) * (F.col("total") - F.col("common"))).select("a", "b"), "verified")
    discard(likely, held)
    return found


def _shingle_rows(n_buckets: int, narrow: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [np.frombuffer(b"".join(x), np.uint64) for x in b.column("parts").to_pylist()]
            if sets:
                yield bucket_rows(n_buckets, np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets]), b.column("node").to_numpy(), np.zeros(len(sets), np.uint64), narrow=narrow)

    return run


def _lone_shingles(n_buckets: int):
    """How many shingles of a range each node has that no other has, by node.  Shingles of a range are told apart by 32 bits: where two agree
    both count as shared, which only rules out less."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, ids, _ in gathered(batches, narrow=True):
            order = np.argsort(hashes)
            hashes, ids = hashes[order], ids[order]
            edge = np.concatenate([[True], hashes[1:] != hashes[:-1], [True]])
            node, lone = np.unique(ids[edge[:-1] & edge[1:]], return_counts=True)
            yield by_document(n_buckets, node, lone.astype(np.uint64))

    return run


def _lone_sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lone shingles of each node over all ranges."""
    for counts, ids, _ in gathered(batches):
        node, code = np.unique(ids, return_inverse=True)
        yield pa.record_batch({"node": node, "lone": np.bincount(code, weights=counts.astype(np.float64), minlength=len(node)).astype(np.int64)})


def reach(all_sets: DataFrame, filter_: idfilter.IdFilter) -> DataFrame:
    """``node, size, sketch, reach``: of its shingles each node that the filter holds can share ``reach`` with others at most."""
    sets = idfilter.keep_held(all_sets.select("node", "size", "sketch"), filter_, "node")
    total = sets.agg(F.sum("size")).first()[0] or 0
    n = partitions(sets.sparkSession, total, SHINGLES_PER_TASK)
    sent = sets.sparkSession.sparkContext.broadcast(filter_)
    shingles = deal(all_sets.select("node", "parts"), lambda k, narrow: idfilter.held_first(_shingle_rows(k, narrow), sent, "node"), n, narrow=True)
    lone = deal(shingles, lambda k, _: _lone_shingles(k), n, documents=True).mapInArrow(_lone_sums, "node long, lone long")
    return sets.select("node", "size", "sketch").join(lone, "node", "left").select("node", "size", "sketch", (F.col("size") - F.coalesce("lone", F.lit(0))).alias("reach"))


CROSSED = "kind byte, a long, b long, group_id long, i int, j int"


def _root(parent: dict[int, int], x: int) -> int:
    while parent.setdefault(x, x) != x:
        parent[x] = x = parent[parent[x]]
    return x


def _join_labels(parent: dict[int, int], label: np.ndarray, x: int, others: np.ndarray) -> None:
    """The components ``others`` and the one of row ``x`` are one from now on."""
    for other in others.tolist():
        parent[_root(parent, other)] = _root(parent, int(label[x]))
    label[np.isin(label, others)] = label[x]


def _sketch_links(num: int, den: int):
    """Of the pairs between different components of a group, or of two blocks of one, that sketches do not rule out: kind 0, those
    that would join two components, so fewer than there are components; kind 1, the rows (with their block) that are in any."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}
        for batch in batches:
            rows = [np.zeros((6, 0), np.int64)]
            members = batch.column("members")
            for k in range(batch.num_rows):
                part = pa.RecordBatch.from_struct_array(members[k].values)
                node, size, far, comp, block = (part.column(x).to_numpy() for x in ("node", "size", "reach", "component", "block"))
                sketch = _as_wide(part.column("sketch").to_pylist())
                group, i, j = (batch.column(x)[k].as_py() for x in ("group_id", "i", "j"))
                left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
                label, met = np.array([_root(parent, x) for x in comp.tolist()], np.int64), np.zeros(len(node), bool)
                for x in left:
                    y = right[comp[right] != comp[x]]
                    if i == j:
                        y = y[y > x]
                    total = size[x] + size[y]
                    ok = (den + num) * np.minimum(far[x], far[y]) >= num * total
                    y, total = y[ok], total[ok]
                    y = y[_may_link(sketch[x], sketch[y], total, num, den)]
                    if not len(y):
                        continue
                    met[x] = met[y] = True
                    joined, one = np.unique(label[y], return_index=True)
                    one = y[one[joined != label[x]]]
                    if len(one):
                        ends = np.minimum(node[x], node[one]), np.maximum(node[x], node[one])
                        rows.append(np.stack([np.zeros(len(one), np.int64), *ends, *np.zeros((3, len(one)), np.int64)]))
                        _join_labels(parent, label, x, joined)
                some = np.flatnonzero(met)
                rows.append(np.stack([np.ones(len(some), np.int64), node[some], block[some], *(np.full(len(some), v, np.int64) for v in (group, i, j))]))
            kind, a, b, group, i, j = np.concatenate(rows, axis=1)
            yield pa.record_batch({"kind": kind.astype(np.int8), "a": a, "b": b, "group_id": group, "i": i.astype(np.int32), "j": j.astype(np.int32)})

    return run


def _set_links(num: int, den: int):
    """Links between different components of a group, or of two blocks of one, by their sets: those that join two components, so
    fewer than there are components, however many pairs link."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}
        for batch in batches:
            found = [np.zeros((2, 0), np.int64)]
            members = batch.column("members")
            for k in range(batch.num_rows):
                part = pa.RecordBatch.from_struct_array(members[k].values)
                node, size, comp, block = (part.column(x).to_numpy() for x in ("node", "size", "component", "block"))
                i, j = batch.column("i")[k].as_py(), batch.column("j")[k].as_py()
                left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
                label = np.array([_root(parent, x) for x in comp.tolist()], np.int64)
                sets = [np.frombuffer(b"".join(x), np.uint64) for x in part.column("parts").to_pylist()]
                sketch = _as_wide([_sketch(x).tobytes() for x in sets])
                names, code = np.unique(np.concatenate(sets), return_inverse=True)
                first, mark = np.cumsum(size) - size, np.zeros(len(names), bool)
                for x in left:
                    y = right[label[right] != label[x]]
                    if i == j:
                        y = y[y > x]
                    y = y[_may_link(sketch[x], sketch[y], size[x] + size[y], num, den)]
                    if not len(y):
                        continue
                    own = code[first[x] : first[x] + size[x]]
                    mark[own] = True
                    at, total = np.cumsum(size[y]) - size[y], size[x] + size[y]
                    common = np.add.reduceat(mark[code[np.repeat(first[y] - at, size[y]) + np.arange(int(size[y].sum()))]], at, dtype=np.int64)
                    mark[own] = False
                    y = y[den * common >= num * (total - common)]
                    joined, one = np.unique(label[y], return_index=True)
                    found.append(np.stack([np.minimum(node[x], node[y[one]]), np.maximum(node[x], node[y[one]])]))
                    _join_labels(parent, label, x, joined)
            a, b = np.concatenate(found, axis=1)
            yield pa.record_batch({"a": a, "b": b})

    return run


def _mixed(groups: DataFrame) -> DataFrame:
    """The groups (``group_id, node, size, component``) that hold several components, with how ``many`` nodes and ``shingles`` each
    has; of groups of the same nodes one."""
    spans = groups.groupBy("group_id").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("many"), F.sum("size").alias("shingles"), F.bit_xor(F.xxhash64("node")).alias("names"))
    spans = spans.where("low <> high").groupBy("many", "shingles", "names").agg(F.min("group_id").alias("group_id"))
    return groups.join(spans.select("group_id", "many", "shingles"), "group_id")


def _named(rows: DataFrame, components: DataFrame) -> DataFrame:
    """``rows`` with the ``component`` of their ``node``: itself, if it has no link."""
    return rows.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _open_links(open_groups: DataFrame, sets: DataFrame, links: DataFrame, num: int, den: int) -> DataFrame:
    """Links that join the components (by ``links``) of each group which their members' lone shingles, sketches and sets show to link.

    Most pairs that sketches do not rule out link, so first those are verified that join all that may be joined.  Where some don't
    link, rows that still have such a pair between components are compared by their sets.
    """
    nodes = open_groups.select("node").distinct()
    # The few others that the filter lets through share shingles too, so they only rule out less.
    known = table(reach(sets, idfilter.build(nodes, "node")).where(F.lit(den) * F.col("reach") >= F.lit(num) * F.col("size")), "reach")
    live = _mixed(open_groups.select("group_id", "node", "size", "component").join(known.select("node"), "node", "left_semi"))
    blocks = F.greatest(F.ceil(F.col("many") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = live.select("group_id", "node", "component", own.alias("block"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    dealt = dealt.join(known, "node").withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    met = dealt.groupBy("group_id", "i", "j").agg(F.collect_list(F.struct("node", "size", "reach", "component", "block", "sketch")).alias("members"))
    found = table(met.mapInArrow(_sketch_links(num, den), CROSSED), "crossed")
    likely = found.where("kind = 0").select("a", "b").distinct()
    joined = verified(likely, sets, num, den)
    if joined.count() == likely.count():
        return joined
    now = connected_components(links.select("a", "b").unionByName(joined), "a", "b")
    key = ["group_id", "i", "j"]
    rest = _named(found.where("kind = 1").select(*key, F.col("a").alias("node"), F.col("b").cast("int").alias("block")), now)
    spans = rest.groupBy(*key).agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("many"), F.bit_xor(F.xxhash64("node", "block")).alias("names"))
    spans = spans.where("low <> high").groupBy("many", "names").agg(F.min(F.struct(*key)).alias("key")).select("key.*")
    rest = table(rest.join(spans, key), "crossing")
    held = idfilter.keep_held(sets, idfilter.build(rest.select("node").distinct(), "node"), "node").select("node", "size", "parts")
    met = rest.join(held, "node").groupBy(*key).agg(F.collect_list(F.struct("node", "size", "component", "block", "parts")).alias("members"))
    more = table(met.select("i", "j", "members").mapInArrow(_set_links(num, den), "a long, b long").distinct(), "set-links")
    discard(found, now, rest, known)
    return joined.unionByName(more)


def similar_documents(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Components of the documents whose shingle sets have a Jaccard similarity of ``num / den`` or more.

    ``docs`` needs ``doc_id`` (whole number) and ``text``; other columns are not looked at.  Words are
    runs outside space and ``\\x09-\\x0D`` with A-Z lower-cased; a set holds the distinct runs of ``size``
    words, of a shorter text its whole sequence.  Result: ``doc_id, n_shingles, component_id``, one row
    for each row of ``docs``; ``component_id`` is the smallest id that links reach.

    Null, empty and blank texts have no shingles, link with nothing and stand alone.  Rows with a null
    ``doc_id`` give a null ``component_id`` and link nothing.  Repeated rows share their component.  An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    all_sets = table(slim.mapInArrow(_set_rows(size), "doc_id long, n_shingles long, node long, node2 long"), "sets")
    named = all_sets.where("doc_id is not null and n_shingles > 0")
    total, n_max = named.agg(F.sum("n_shingles"), F.max("n_shingles")).first()
    n = partitions(spark, total or 0, SHINGLES_PER_TASK)

    slim = slim.where("doc_id is not null")
    found = deal(slim, lambda k, narrow: _signatures(size, num, den, n_max or 0, k, narrow), n, narrow=True)
    found = table(found.mapInArrow(_proposals(num, den), "kind byte, packed binary, group_id long"), "proposals")
    pairs = table(found.where("kind = 0").select("packed").mapInArrow(_unpack_pairs, "a long, b long").distinct(), "pairs")
    groups = found.where("kind = 1").select("group_id", "packed").mapInArrow(_unpack_groups, "group_id long, node long, size long").distinct()
    groups = table(groups, "groups")

    discard(found)
    reps = named.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    active = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(groups.select("node")).distinct().join(reps, "node")
    held = spark.sparkContext.broadcast(idfilter.build(active, "doc_id"))
    raw = table(slim.mapInArrow(_fragments(size, held), SETS), "fragments")
    sets = _once(raw)
    links = verified(pairs, sets, num, den)
    first = connected_components(links, "a", "b")

    open_groups = table(_mixed(_named(groups, first)), "open")
    more = _open_links(open_groups, sets, links, num, den)
    final = connected_components(links.union(more), "a", "b")
    discard(pairs, groups, raw, sets, links, first, open_groups)
    ids = _named(reps, final)
    least = ids.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_node = ids.join(least, "component").select(F.col("node").alias("linked"), "component_id")
    own = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("node"))
    return all_sets.withColumn("own", own).join(by_node, F.col("own") == F.col("linked"), "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def query(spark, sf_dir: str) -> DataFrame:
    """op3: four-word shingles, similarity 0.85."""
    return similar_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=4, num=85, den=100)
