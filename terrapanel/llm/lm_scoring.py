"""Language-model scoring with a log-frequency Bloom filter.

Chunks.  The texts are read into chunks once: a table of each chunk's distinct words and of which of them its documents have, from
which all other steps work.

Counting.  Each chunk of training documents counts its words and the runs of two and three words.  Spelling is
learned from the vocabulary: the chunks' words meet by hash first, and each distinct word counts the byte n-grams in it
once (orders 1 to ``ORDER``, a word's end mark among the symbols), however the documents lie in files.  All
counts meet by ranges of hashes in packed rows.

Filter.  A count c is kept as the level q = 1 + floor(log2 c), and the n-gram goes in once for each
level up to q.  A range of hashes fills its own slice of the filter, ``BITS_PER_LEVEL`` bits for each
level of each n-gram, so the slices grow with the corpus and nothing is left out.  A slice is probed by
the task that fills it: chunks ask for their n-grams and get the levels back, so no task or driver holds
more than its own ranges.

Scoring.  A level is found by repeated probes, (n, 1), (n, 2) ..., until one misses, and stands for the
middle of its counts.  A word follows the two before it with a probability interpolated between runs of
three, runs of two and the word alone; from a word alone ``DISCOUNT`` is taken off its count and given to
the spelling, an n-gram model over the word's bytes that backs off by interpolation to all shorter
contexts and to the uniform byte.  So every text has a probability above zero, and those of all words add
up to one but for the quantised counts of runs and what the filter mistakes.

The base score uses the exact counts of all words, which come back to the chunk that asked for them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapanel.sources.shared import partitions, table

from . import textscan as ts

ORDER = 5
BITS_PER_LEVEL = 12
PROBES = 4
#: A byte context seen so often counts as much as all shorter ones; and a word context.
SMOOTHING = 3.0
WORD_SMOOTHING = 20.0
DISCOUNT = 0.8
WORDS_PER_TASK = 2_000_000
#: Words whose byte n-grams are counted at once; beyond so many ranges of hashes the vocabulary takes fewer, wider ones.
WORDS_AT_ONCE, WIDE_FROM = 50_000, 64
#: The token that ends a document, among word hashes.
END = np.uint64(0x2545F4914F6CDD1D)
_KIND = np.array([0x9D39247E33776D41 + 2 * k for k in range(ORDER + 1)], np.uint64)
#: So many different keys are numbered by a table.
DENSE = 1 << 22
#: Chunks in a row group of their table.
ROW_GROUP = 4


class Grams:
    """The byte n-grams that end at each place of the words, orders 1 to ``ORDER``, each distinct one once.

    A word's symbols are its bytes and an end mark; before its beginning stands one mark for all orders.  ``place[n]`` numbers the n-gram
    of each place, ``hash[n]`` has the n-grams' hashes, ``shorter[n]`` the n-gram without its first symbol and ``before[n]`` the one without its
    last, -1 at a word's beginning.  ``at`` is each word's first place.
    """

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        size = end - start + 1
        self.at = at = np.cumsum(size) - size
        total = int(size.sum())
        spot = np.repeat(start - at, size)
        spot += np.arange(total)
        symbol = np.append(data, np.uint8(0)).astype(np.int32)[spot]
        symbol[at + size - 1] = 256
        found, code = _dense(symbol, 258)
        raw = found.astype(np.uint64) + np.uint64(2)
        self.hash, self.place, self.shorter, self.before = [_KIND[0:0], ts.mix(raw + _KIND[1])], [symbol[:0], code], [found[:0]] * 2, [found[:0]] * 2
        for n in range(2, ORDER + 1):
            own = np.empty(total, np.int32)
            own[n - 1 :] = symbol[: max(0, total - n + 1)]
            for k in range(n - 1):
                own[at[size > k] + k] = 257
            last = code
            found, code = _dense(last.astype(np.int64) * 258 + own, len(raw) * 258)
            shorter = found // 258
            raw = raw[shorter] + (found % 258 + 2).astype(np.uint64) * np.uint64(pow(521, n - 1, 1 << 64))
            back = np.empty(total, np.int32)
            back[1:] = last[:-1]
            back[at] = -1
            before = np.empty(len(found), np.int32)
            before[code] = back
            self.hash.append(ts.mix(raw + _KIND[n]))
            self.place.append(code)
            self.shorter.append(shorter)
            self.before.append(before)

    def hashes(self) -> list[np.ndarray]:
        """Of the empty n-gram, of the others by order, and of a word's beginning as a context of each order but the first."""
        return [ts.mix(_KIND[0:1]), *self.hash[1:], np.array([_begin(n) for n in range(1, ORDER)], np.uint64)] if len(self.at) else [np.zeros(0, np.uint64)]


def _begin(n: int) -> np.uint64:
    return ts.mix(np.uint64(259) + np.uint64(n) + _KIND[n : n + 1])[0]


def _dense(key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys (whole numbers under ``size``) in order, and each one's place among them: by a table if it is small, else sorted."""
    if size <= DENSE:
        seen = np.zeros(size, bool)
        seen[key] = True
        found = np.flatnonzero(seen)
        number = np.empty(size, np.int32)
        number[found] = np.arange(len(found), dtype=np.int32)
        return found, number[key]
    bits = np.uint64(max(1, len(key).bit_length()))
    both = np.sort(key.astype(np.uint64) << bits | np.arange(len(key), dtype=np.uint64))
    order, both = (both & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), both >> bits
    new = np.append(True, both[1:] != both[:-1])
    code = np.empty(len(key), np.int32)
    code[order] = np.cumsum(new, dtype=np.int32) - 1
    return both[new].astype(np.int64), code


def _order(h: np.ndarray) -> np.ndarray:
    """The order of the hashes: sorted by value with their places in the last bits, which is faster than sorting places."""
    bits = np.uint64(max(1, len(h).bit_length()))
    order = (np.sort(h >> bits << bits | np.arange(len(h), dtype=np.uint64)) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    found = h[order]
    # Hashes that agree in all but the last bits may stand the wrong way round.
    return order if (found[1:] >= found[:-1]).all() else np.argsort(h, kind="stable")


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes in order, and each one's place among them."""
    order = _order(h)
    h = h[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    code = np.empty(len(h), np.int64)
    code[order] = np.cumsum(new) - 1
    return h[new], code


def _sum_by(h: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, code = distinct(h)
    return own, np.bincount(code, weights=weight, minlength=len(own)).astype(np.int64)


def _count_by(h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes in order, and how often each occurs where ``counts`` is true."""
    some, rest = np.sort(h[counts]), np.unique(h[~counts])
    start = np.flatnonzero(np.append(True, some[1:] != some[:-1])) if len(some) else np.zeros(0, np.int64)
    taught, n = some[start], np.diff(np.append(start, len(some)))
    # Two runs in order are merged, not sorted again.
    own = np.sort(np.concatenate([taught, rest]), kind="stable")
    own = own[np.append(True, own[1:] != own[:-1])] if len(own) else own
    out = np.zeros(len(own), np.int64)
    out[np.searchsorted(own, taught)] = n
    return own, out


def _distinct_grams(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All byte n-grams and contexts of the words in the order of their hashes, each once."""
    return np.unique(np.concatenate(Grams(data, start, end).hashes()))


def _gram_counts(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All byte n-grams and contexts of the words in the order of their hashes, and how often the words have each."""
    grams = Grams(data, start, end)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = len(grams.place[1])
    found = [np.array([total]), *(np.bincount(grams.place[n], minlength=len(grams.hash[n])) for n in range(1, ORDER + 1)), np.full(ORDER - 1, len(start))]
    return _sum_by(np.concatenate(grams.hashes()), np.concatenate(found))


def _runs(h: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of documents with so many words each, words in order: the hashes of the runs of two and of three tokens
    that end at each token, 0 where there is none, and the tokens' documents.  Each document has its end after it."""
    row = np.repeat(np.arange(len(size)), size + 1)
    token = np.full(len(row), END)
    token[np.arange(len(h)) + np.repeat(np.arange(len(size)), size)] = h
    two, three = np.zeros(len(row), np.uint64), np.zeros(len(row), np.uint64)
    place = np.arange(len(row)) - np.repeat(np.cumsum(size + 1) - size - 1, size + 1)
    k = np.flatnonzero(place >= 1)
    two[k] = ts.mix(ts.mix(token[k - 1] + np.uint64(2)) + token[k])
    k = np.flatnonzero(place >= 2)
    three[k] = ts.mix(ts.mix(two[k - 1] + np.uint64(3)) + token[k])
    return two, three, row


def _pack(x: np.ndarray) -> bytes:
    """Whole numbers in the narrowest of 1, 2, 3, 4 or 8 bytes; the first byte says which."""
    width = next(w for w in (1, 2, 3, 4, 8) if w == 8 or int(x.max(initial=0)) < 1 << (8 * w))
    if width == 3:
        return b"\x03" + x.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def _unpack(x: bytes) -> np.ndarray:
    if x[0] == 3:
        out = np.zeros(((len(x) - 1) // 3, 4), np.uint8)
        out[:, :3] = np.frombuffer(x, np.uint8, offset=1).reshape(-1, 3)
        return out.view("<u4").ravel()
    return np.frombuffer(x, f"<u{x[0]}", offset=1)


def _squeezed(x: np.ndarray) -> bytes:
    """Whole numbers under 2^32, byte by byte of each, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _stretched(x: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class Chunk:
    """Some documents: their distinct words in the order of their hashes, and the place of each word among them.

    The name is a hash of ids and words.
    """

    def __init__(self, row: dict):
        self.name, self.ids, self.held = row["chunk"], np.frombuffer(row["ids"], np.int64), np.frombuffer(row["held"], bool)
        self.size, self.code = _unpack(row["sizes"]).astype(np.int64), _stretched(row["tokens"]).astype(np.int64)
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["words"]) if len(self.code) else b"", np.uint8)
        gap = np.flatnonzero(self.data == 0x20)
        some = np.zeros(min(1, len(self.data)), np.int64)
        self.start, self.end = np.concatenate([some, gap + 1]), np.concatenate([gap, some + len(self.data)])
        self.own = ts.word_hashes(ts.Words(self.data, self.start, self.end, some, 1))

    def taught(self) -> np.ndarray:
        """Which words, of all, are in training documents."""
        return np.repeat(~self.held, self.size)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of a table of chunks, one at a time."""
    try:
        for b in batches:
            for k in range(b.num_rows):
                yield {x: b.column(x)[k].as_py() for x in b.schema.names}
    finally:
        ts.release()


def _batch(rows: list[tuple], schema: str, types: tuple) -> pa.RecordBatch:
    names = [x.split()[0] for x in schema.split(", ")]
    return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


ROWS = "kind byte, bucket int, chunk long, hashes binary, counts binary"
_TYPES = (pa.int8(), pa.int32(), pa.int64(), pa.binary(), pa.binary())


def _chunk_rows(n_buckets: int):
    """Kinds 1, 2 and 3: a chunk's words and runs of words with their counts and its byte n-grams, by bucket.

    Words are told apart by 64 bits, the others by 32 within the bucket, sent as steps from one to the next.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in map(Chunk, _rows(batches)):
            if not len(c.own):
                continue
            train = np.bincount(c.code[c.taught()], minlength=len(c.own)).astype(np.int64)
            two, three, row = _runs(c.own[c.code], c.size)
            runs, taught = np.concatenate([two, three]), np.tile(~c.held[row], 2)
            rows = []
            for kind, mine, count in ((1, c.own, train), (2, _distinct_grams(c.data, c.start, c.end), None), (3, *_count_by(runs[runs > 0], taught[runs > 0]))):
                place = ts.scaled(mine, n_buckets)
                full, edge = ts.filled(place)
                for k, a, b in zip(full.tolist(), edge[:-1], edge[1:], strict=True):
                    sent = mine[a:b].tobytes() if kind == 1 else _pack(np.diff(place[a:b] & np.uint64(0xFFFFFFFF), prepend=np.uint64(0)))
                    rows.append((kind, k, c.name, sent, b"" if count is None else _pack(count[a:b])))
            yield _batch(rows, ROWS, _TYPES)

    return run


VOCABULARY = "bucket int, sizes binary, words binary"


def _taught_words(n_buckets: int):
    """The distinct words of a chunk's training documents with their bytes, by bucket."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in map(Chunk, _rows(batches)):
            some = np.flatnonzero(np.bincount(c.code[c.taught()], minlength=len(c.own)))
            if not len(some):
                continue
            own, start, end = c.own[some], c.start[some], c.end[some]
            full, edge = ts.filled(ts.scaled(own, n_buckets))
            rows = []
            for k, a, b in zip(full.tolist(), edge[:-1], edge[1:], strict=True):
                size = end[a:b] - start[a:b]
                spot = np.repeat(start[a:b] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
                rows.append((k, _pack(size), zstandard.ZstdCompressor(level=1).compress(c.data[spot].tobytes())))
            yield _batch(rows, VOCABULARY, (pa.int32(), pa.binary(), pa.binary()))

    return run


def _vocabulary_grams(n_buckets: int):
    """Kind 5: the byte n-grams of the distinct words of a range of hashes with their counts, by bucket."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[tuple]] = {}
        for b in batches:
            for bucket, *rest in zip(*(x.to_pylist() for x in b.columns), strict=True):
                found.setdefault(bucket, []).append(rest)
        for bucket in list(found):
            parts = found.pop(bucket)
            data = np.frombuffer(b"".join(zstandard.ZstdDecompressor().decompress(x) for _, x in parts), np.uint8)
            size = np.concatenate([_unpack(x).astype(np.int64) for x, _ in parts])
            end = np.cumsum(size)
            _, first = np.unique(ts.word_hashes(ts.Words(data, end - size, end, np.zeros(len(end), np.int64), 1)), return_index=True)
            start, end = (end - size)[first], end[first]
            counted = [_gram_counts(data, start[at : at + WORDS_AT_ONCE], end[at : at + WORDS_AT_ONCE]) for at in range(0, len(start), WORDS_AT_ONCE)]
            own, count = _sum_by(*(np.concatenate(x) for x in zip(*counted, strict=True)))
            place = ts.scaled(own, n_buckets)
            full, edge = ts.filled(place)
            yield _batch([(5, k, 0, _pack(np.diff(place[a:b] & np.uint64(0xFFFFFFFF), prepend=np.uint64(0))), _pack(count[a:b])) for k, a, b in zip(full.tolist(), edge[:-1], edge[1:], strict=True)], ROWS, _TYPES)
        ts.release()

    return run


PAYLOAD = "chunk long, ids binary, held binary, words binary, sizes binary, tokens binary"


def _payload(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A chunk's distinct words in the order of their hashes, and which of them each document has."""
    for c in ts.chunks(batches):
        w = ts.words(c.column("text"), lower=True)
        h, first = ts.word_hashes(w), w.first()
        own, code = distinct(h)
        n = len(own)
        one = np.empty(n, np.int64)
        one[code] = np.arange(len(h))
        text = ts.join_words(ts.Words(w.data, w.start[one], w.end[one], np.zeros(n, np.int64), 1), np.ones(n, bool))[0].as_py().encode() if n else b""
        ids = c.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        held = c.column("held").to_numpy(zero_copy_only=False).astype(bool)
        parts = ts.mix(ids.view(np.uint64)) ^ ts.whole_hashes(h, first)
        name = int(ts.whole_hashes(parts, np.array([0, len(parts)])).view(np.int64)[0])
        row = (name, ids.tobytes(), held.tobytes(), zstandard.ZstdCompressor(level=1).compress(text), _pack(np.diff(first)), _squeezed(code))
        yield _batch([row], PAYLOAD, (pa.int64(), *([pa.binary()] * 5)))


COUNTS = "kind byte, bucket int, chunk long, counts binary, levels binary, n_tokens long, n_types long, n_middle double"
_COUNT_TYPES = (pa.int8(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.float64())
LEVELS = 48


def _bucket_counts(bits_per_level: int):
    """Fills each bucket's slice; kinds 1, 2 and 3, levels and for words the counts, go back to the chunks, kind 4
    has the bucket's sums."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[tuple]] = {}
        for b in batches:
            for kind, bucket, *rest in zip(*(x.to_pylist() for x in b.columns), strict=True):
                found.setdefault(bucket, []).append((kind, *rest))
        for bucket in list(found):
            parts = found.pop(bucket)
            rows, sums, n_tokens, n_types, n_middle = [], [], 0, 0, 0.0
            for kind in (1, 2, 3):
                mine = [(c, np.frombuffer(h, np.uint64) if kind == 1 else np.cumsum(_unpack(h), dtype=np.uint64), x) for k, c, h, x in parts if k == kind]
                # Chunks ask for byte n-grams, the vocabulary has their counts.
                told = [(np.cumsum(_unpack(h), dtype=np.uint64), _unpack(x)) for k, _, h, x in parts if k == 5 and kind == 2]
                pairs = [(h, _unpack(x) if x else np.zeros(len(h), np.int64)) for _, h, x in mine] + told
                if not pairs:
                    continue
                h, code = distinct(np.concatenate([x[0] for x in pairs]))
                n = np.bincount(code, weights=np.concatenate([x[1] for x in pairs]), minlength=len(h)).astype(np.int64)
                # Chunks of the same rows have one name, and one answer serves them all.
                sums.append((kind, {c: at for (c, *_), at in zip(mine, np.split(code, np.cumsum([len(x[0]) for x in pairs])), strict=False)}, h, n))
                if kind == 1:
                    n_tokens, n_types, n_middle = int(n.sum()), int((n > 0).sum()), float(_middle(_level(n)).sum())
            names = [ts.mix(h + np.uint64(kind)) for kind, _, h, _ in sums]
            held, top = np.concatenate([x[n > 0] for x, (*_, n) in zip(names, sums, strict=True)]), np.concatenate([_level(n[n > 0]) for *_, n in sums])
            model = LogFrequencyFilter(held, top, bits_per_level)
            for name, (kind, asked, h, n) in zip(names, sums, strict=True):
                level = model.levels(name).astype(np.uint8)
                for chunk, at in asked.items():
                    rows.append((kind, bucket, chunk, _pack(n[at]) if kind == 1 else b"", level[at].tobytes(), 0, 0, 0.0))
            rows.append((4, bucket, 0, b"", b"", n_tokens, n_types, n_middle))
            yield _batch(rows, COUNTS, _COUNT_TYPES)

    return run


def _level(count: np.ndarray) -> np.ndarray:
    """1 + floor(log2 c), 0 for none."""
    return np.frexp(count.astype(np.float64))[1].astype(np.int64)


def _middle(level: np.ndarray) -> np.ndarray:
    """The middle of the counts at a level."""
    return np.where(level > 0, 0.75 * np.exp2(level.astype(np.float64)) - 0.5, 0.0)


class LogFrequencyFilter:
    """Quantised counts by membership: each hash is in at all levels up to its own, and probes of level 1, 2 ...
    until one misses find it."""

    def __init__(self, h: np.ndarray, top: np.ndarray, bits_per_level: int = BITS_PER_LEVEL):
        self.bits = max(64, bits_per_level * int(top.sum()))
        field = np.zeros(self.bits, bool)
        for q in range(1, int(top.max(initial=0)) + 1):
            for spot in self._spots(h[top >= q], np.array([q])):
                field[spot] = True
        self.field = np.packbits(field, bitorder="little")

    def _halves(self, h: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a = ts.mix(h + level.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return a & np.uint64(0xFFFFFFFF), a >> np.uint64(32) | np.uint64(1)

    def _spot(self, a: np.ndarray, b: np.ndarray, probe: int) -> np.ndarray:
        return ((a + np.uint64(probe) * b) % np.uint64(self.bits)).astype(np.int64)

    def _spots(self, h: np.ndarray, level: np.ndarray) -> Iterator[np.ndarray]:
        """The bits of each (hash, level), one array for each probe."""
        a, b = self._halves(h, level)
        for k in range(PROBES):
            yield self._spot(a, b, k)

    def levels(self, h: np.ndarray) -> np.ndarray:
        """The level of each hash, 0 if it isn't in."""
        level, todo = np.zeros(len(h), np.int64), np.arange(len(h))
        for q in range(1, LEVELS + 1):
            a, b = self._halves(h[todo], np.array([q]))
            for k in range(PROBES):
                # What misses one bit is not asked for the next.
                spot = self._spot(a, b, k)
                hit = np.flatnonzero(self.field[spot >> 3] >> (spot & 7).astype(np.uint8) & 1)
                todo, a, b = todo[hit], a[hit], b[hit]
            level[todo] = q
            if not len(todo):
                break
        return level


def spelling(level: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each word's bytes and end mark; ``level`` has those of all byte
    n-grams of the words in the order of their hashes.  A probability is worked out once for each distinct n-gram."""
    grams = Grams(data, start, end)
    parts = grams.hashes()
    count = _middle(level)[distinct(np.concatenate(parts))[1]]
    whole, *part, begin = np.split(count, np.cumsum([len(x) for x in parts])[:-1])
    p = np.full(1, 1 / 258)
    for n in range(1, ORDER + 1):
        if n > 1:
            # A context's count is the count of the n-gram that ends one place before.
            before = grams.before[n]
            whole = np.where(before < 0, begin[n - 2], part[n - 2][before])
            p = p[grams.shorter[n]]
        # The quantised counts of continuations can add up to more than the context's.
        weight = whole / (whole + SMOOTHING)
        p = weight * np.minimum(part[n - 1] / np.maximum(whole, 1), 1.0) + (1 - weight) * p
    return np.add.reduceat(np.log(p)[grams.place[ORDER]], grams.at)


def token_scores(alone: np.ndarray, count: np.ndarray, two: np.ndarray, three: np.ndarray, row: np.ndarray) -> np.ndarray:
    """log10 of the probability of each token after those before it in its document.

    ``alone`` is the natural logarithm of its probability by itself; ``count``, ``two`` and ``three`` are the counts of the token and of the
    runs of two and three that it ends, 0 where its document has none.
    """
    p = alone
    for run, context in ((two, count), (three, two)):
        before = np.concatenate([np.zeros(1), context[:-1]])
        before[np.concatenate([[True], row[1:] != row[:-1]])] = 0
        weight = before / (before + WORD_SMOOTHING)
        some = np.flatnonzero(before > 0)
        p = p.copy()
        p[some] += np.log1p(-weight[some])
        # Where a run was never seen nothing is added.
        some = some[run[some] > 0]
        p[some] = np.logaddexp(np.log(weight[some] * np.minimum(run[some] / np.maximum(before[some], 1), 1.0)), p[some])
    return p / np.log(10)


def _score(n_words: int, n_types: int, n_docs: int, n_middle: float):
    """Base and model scores of a chunk's documents; ``back`` has the answers to what it asked by bucket."""
    n_tokens = n_words + n_docs
    end_count = float(_middle(_level(np.array([n_docs])))[0])
    whole, types = n_middle + end_count, n_types + int(n_docs > 0)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _rows(batches):
            c = Chunk(chunk)
            r = sorted(chunk["back"] or [], key=lambda p: (p["kind"], p["bucket"]))
            count = np.concatenate([_unpack(x["counts"]).astype(np.float64) for x in r if x["kind"] == 1] or [np.zeros(0)])
            known, grams, runs = (np.frombuffer(b"".join(x["levels"] for x in r if x["kind"] == k), np.uint8).astype(np.int64) for k in (1, 2, 3))
            known, runs = _middle(known), _middle(runs)
            size, code, first = c.size, c.code, np.concatenate([[0], np.cumsum(c.size)])
            spelled = spelling(grams, c.data, c.start, c.end) if len(c.own) else np.zeros(0)
            fresh = DISCOUNT * types / whole if whole else 1.0
            with np.errstate(divide="ignore"):
                alone = np.logaddexp(np.log(np.maximum(known - DISCOUNT, 0) / max(whole, 1)), np.log(fresh) + spelled)
            two, three, row = _runs(c.own[code], size)
            of_run = np.zeros((2, len(row)))
            some = np.stack([two, three]) > 0
            of_run[some] = runs[distinct(np.stack([two, three])[some])[1]]
            place = np.arange(len(code)) + np.repeat(np.arange(len(size)), size)
            by_token, seen = np.full(len(row), np.log((end_count - DISCOUNT) / whole if n_docs else 0.5)), np.full(len(row), end_count)
            by_token[place], seen[place] = alone[code], known[code]
            score = token_scores(by_token, seen, *of_run, row)
            logs = np.log10(count + 1)
            base = ts.row_sums(logs[code], first) + np.log10(n_docs + 1) - (size + 1) * np.log10(n_tokens + types + 1.0)
            yield pa.record_batch(
                {
                    "doc_id": c.ids,
                    "held_out": c.held,
                    "n_tokens": size + 1,
                    "n_known": ts.row_sums((count > 0).astype(np.int64)[code], first) + int(n_docs > 0),
                    "train_tokens": np.full(len(size), n_tokens),
                    "base_score": base,
                    "score": np.bincount(row, weights=score, minlength=len(size)),
                }
            )

    return run


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(docs: DataFrame, held_out: str = "crc32(CAST(doc_id AS STRING)) % 7 = 2", bits_per_level: int = BITS_PER_LEVEL) -> DataFrame:
    """Scores all texts by a model of those for which the SQL condition ``held_out`` is not true.

    ``docs`` needs ``doc_id`` (whole number) and ``text``; other columns are not looked at.
    Tokens are words outside space and ``\\x09-\\x0D``, A-Z lower-cased, then one end.  Result: see
    ``RESULT``; ``base_score`` is the add-one unigram score from exact counts, ``score`` the model's.

    Null, empty and blank texts are the end alone.  Rows with a null id are left out of training and
    result (they have no fold).  Repeated rows count and are scored as often as they occur.  An empty
    table gives an empty result.  ``docs`` is read twice, for its size and for its chunks; vocabulary, counts and scores come from
    the chunks.
    """
    spark = docs.sparkSession
    ts.small_batches(spark)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    slim = slim.select("doc_id", "text", F.coalesce(F.expr(held_out), F.lit(False)).alias("held"))
    total = slim.agg(F.count("*"), F.count(F.when(~F.col("held"), 1)), F.sum(F.octet_length("text"))).first()
    n_docs = total[1]
    n = partitions(spark, (total[2] or 0) // 6, WORDS_PER_TASK)
    wide = n if n <= WIDE_FROM else max(WIDE_FROM, n // 16)
    # Row groups of few chunks: whoever reads them holds one at a time.
    chunks = table(slim.mapInArrow(_payload, PAYLOAD), "chunks", row_group=ROW_GROUP)
    vocabulary = chunks.mapInArrow(_taught_words(wide), VOCABULARY).repartitionById(wide, F.col("bucket"))
    rows = chunks.mapInArrow(_chunk_rows(n), ROWS).unionByName(vocabulary.mapInArrow(_vocabulary_grams(n), ROWS)).repartitionById(n, F.col("bucket"))
    counts = table(rows.mapInArrow(_bucket_counts(bits_per_level), COUNTS), "counts", compression="zstd")
    sums = counts.where("kind = 4").agg(F.sum("n_tokens"), F.sum("n_types"), F.sum("n_middle")).first()
    back = counts.where("kind < 4").groupBy("chunk").agg(F.collect_list(F.struct("kind", "bucket", "counts", "levels")).alias("back"))
    both = chunks.join(back, "chunk", "left")
    return both.mapInArrow(_score(sums[0] or 0, sums[1] or 0, n_docs, sums[2] or 0.0), RESULT)


def query(spark, sf_dir: str) -> DataFrame:
    """op10: base and model scores of every document."""
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
