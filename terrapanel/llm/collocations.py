"""Phrases whose words occur together more often than chance, by prefix-free parsing.

Each document is a stream of word hashes with a 0 between pieces.  Where the next four entries of the stream hash to a
trigger a chunk begins; it ends four entries into the next chunk, so chunks follow from content alone, repeated passages give
equal chunks wherever they stand, and every phrase of up to five words lies whole in the one chunk in which it starts.
Equal chunks meet by hash: the dictionary holds each once, with how often the parse has it.  Phrases are counted inside the
dictionary, weighted, at their owned starts only, so the overlaps count once.

Words are hashed together with their language, so everything is per language from the first step on.  Phrases are counted in two
passes: pairs of frequent words, then three to five words all of whose pairs are frequent.  Both tests are Bloom filters of
bounded size that only spare work; every count is exact.  A phrase is identified by the hash of all but its last word, and its
last word, so words and texts come back by joins with the shorter phrases.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrapanel.sources.shared import table

from . import idfilter
from . import textscan as ts
from .exchange import FAN_OUT
from .hotkeys import counted

LONGEST, LEAST, FIRST = 5, 100, 2000
OVERLAP = LONGEST - 1
#: A chunk begins at one of so many entries of a stream.
EVERY = 24
#: Text that a task parses, and phrases that it counts, before it sends what it has put together.
FLUSH_BYTES, FLUSH_PHRASES = 12 << 20, 1 << 20
#: Text, or phrases, for each range of hashes.
RANGE_BYTES, RANGE_PHRASES = 8 << 20, 1 << 20
SALTS = 64

_WORD = np.ones(256, dtype=bool)
_WORD[[0x20, *range(0x09, 0x0E), *b".,;:!?"]] = False
_SPLIT = np.zeros(256, dtype=np.uint8)
_SPLIT[[*range(0x0A, 0x0E), *b".,;:!?"]] = 1
_ODD = np.uint64(0xD6E8FEB86659FD93)
_OTHER = np.uint64(0xA0761D6478BD642F)

WORDS, CHUNKS = 1, 0
EXCHANGE = "kind int, bucket int, lang string, keys binary, weights binary, sizes binary, data binary"
PARSED = "kind int, lang string, word string, key long, n long, weights binary, sizes binary, data binary"


def join_key(prefix: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The hash of a phrase from the hash of all but its last word (of one word: itself) and its last word."""
    return ts.mix(prefix * _ODD + last)


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places that spans cover, one span after the other."""
    at = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else np.zeros(0, np.int64)
    return np.repeat(start - at, size) + np.arange(int(size.sum()))


class Summed:
    """Entries with keys of ``width`` words, weights, and data of any length each; equal keys are put together."""

    def __init__(self, width: int, unit: type):
        self.width, self.unit, self.parts, self.size = width, unit, [], 0

    def add(self, keys: np.ndarray, weights: np.ndarray, sizes: np.ndarray, data: np.ndarray) -> None:
        self.parts.append((keys, weights, sizes, data))
        self.size += len(weights)

    def put_together(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All entries so far in the order of their keys; of equal keys the first one's data."""
        if not self.parts:
            return np.zeros((0, self.width), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, self.unit)
        keys, weights, sizes, data = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.size = [], 0
        order = np.argsort(keys[:, 0], kind="stable") if self.width == 1 else np.lexsort(keys.T[::-1])
        start = np.flatnonzero(np.concatenate([[True], (keys[order[1:]] != keys[order[:-1]]).any(axis=1)]))
        first = order[start]
        if len(sizes):
            at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)[:-1]])
            data, sizes = data[_spans(at[first], sizes[first].astype(np.int64))], sizes[first]
        return keys[first], np.add.reduceat(weights[order], start), sizes, data


def _rows(kind: int, lang: str | None, n_buckets: int, found: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], by: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Entries cut into ranges of the hashes ``by``, a row for each range that has some."""
    keys, weights, sizes, data = found
    if not len(weights):
        return
    order = np.argsort(by, kind="stable")
    full, edge = ts.filled(ts.scaled(by[order], n_buckets))
    at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]) if len(sizes) else None
    parts = []
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        mine = order[a:b]
        own = data[_spans(at[mine], sizes[mine].astype(np.int64))] if at is not None else data
        parts.append((keys[mine], weights[mine], sizes[mine] if at is not None else sizes, own))
    names = ["kind", "bucket", "lang", "keys", "weights", "sizes", "data"]
    yield pa.record_batch([pa.array([kind] * len(full), pa.int32()), pa.array(full, pa.int32()), pa.array([lang] * len(full), pa.string()), *(ts.binary([p[i] for p in parts]) for i in range(4))], names=names)


def _hash_of(kind: int, keys: np.ndarray) -> np.ndarray:
    return keys[:, 0] if kind <= WORDS else join_key(keys[:, 0], keys[:, 1])


def _gathered(batches: Iterable[pa.RecordBatch], most: int | None = None) -> Iterator[tuple[int, int, str | None, Summed]]:
    """What the task got, put together by kind, range and language; with ``most``, as soon as so many entries are there."""
    held: dict[tuple, Summed] = {}
    for b in batches:
        for kind, bucket, lang, keys, weights, sizes, data in zip(*(b.column(i).to_pylist() for i in range(7)), strict=True):
            width, unit = 1 if kind == WORDS else 2, np.uint8 if kind == WORDS else np.uint64
            s = held.setdefault((kind, bucket, lang), Summed(width, unit))
            s.add(np.frombuffer(keys, np.uint64).reshape(-1, width), np.frombuffer(weights, np.int64), np.frombuffer(sizes, np.uint32), np.frombuffer(data, unit))
            if most and s.size >= most:
                yield kind, bucket, lang, held.pop((kind, bucket, lang))
    for key in list(held):
        yield *key, held.pop(key)
    ts.release()


def _deal(source: DataFrame, rows_of: Callable[[int], Callable], n: int) -> DataFrame:
    """Sends the rows of ``rows_of(ranges)`` to ``n`` tasks by range.  Where there are many ranges, wide ones first: what
    many tasks sent for a wide range is put together there and cut again, so rows keep their size."""
    if n <= FAN_OUT:
        return source.mapInArrow(rows_of(n), EXCHANGE).repartitionById(n, F.col("bucket"))
    wide = math.isqrt(n - 1) + 1

    def again(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, _, lang, s in _gathered(batches, FLUSH_PHRASES):
            found = s.put_together()
            yield from _rows(kind, lang, n, found, _hash_of(kind, found[0]))

    first = source.mapInArrow(rows_of(wide), EXCHANGE).repartition(n, "bucket", F.pmod(F.xxhash64("keys"), F.lit(-(-n // wide))))
    return first.mapInArrow(again, EXCHANGE).repartitionById(n, F.col("bucket"))


def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class Stream:
    """A chunk of documents as one stream: word hashes, a 0 between pieces, four after each document."""

    def __init__(self, langs: pa.Array, texts: pa.Array):
        langs = pc.fill_null(langs.cast(pa.string()), "und").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.row_lang = langs.indices.to_numpy()
        w = self.words = ts.words(texts, lower=True, word_bytes=_WORD)
        seeds = np.array([_seed(x) for x in self.langs], np.uint64)
        self.hashes = ts.mix(ts.word_hashes(w) + seeds[self.row_lang[w.row]])
        self.hashes[self.hashes == 0] = 1
        self._lay_out()

    def _lay_out(self) -> None:
        w, n = self.words, len(self.hashes)
        if not n:
            self.stream, self.start, self.end = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
            return
        split = np.cumsum(_SPLIT[w.data], dtype=np.int64)[w.start]
        new_row = w.row[1:] != w.row[:-1]
        gap = np.where(new_row, OVERLAP, (split[1:] != split[:-1]).astype(np.int64))
        at = np.arange(n) + np.concatenate([[0], np.cumsum(gap)])
        self.stream = np.zeros(at[-1] + 1 + OVERLAP, np.uint64)
        self.stream[at] = self.hashes
        doc_start = at[np.concatenate([[True], new_row])]
        doc_end = at[np.concatenate([new_row, [True]])] + 1
        trigger = ts.run_hashes(self.stream, OVERLAP) % np.uint64(EVERY) == 0
        starts = np.union1d(doc_start, np.flatnonzero(trigger & (self.stream[: len(trigger)] != 0)))
        doc = np.searchsorted(doc_start, starts, side="right") - 1
        next_ = np.append(starts[1:], np.iinfo(np.int64).max)
        self.start, self.end = starts, np.minimum(next_, doc_end[doc]) + OVERLAP

    def chunks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        keys = np.stack([ts.span_hashes(self.stream, self.start, self.end), ts.span_hashes(ts.mix(self.stream ^ _OTHER), self.start, self.end)], axis=1)
        size = self.end - self.start
        return keys, np.ones(len(size), np.int64), size.astype(np.uint32), self.stream[_spans(self.start, size)]

    def vocabulary(self) -> Iterator[tuple[str, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]:
        w = self.words
        found, first, n = np.unique(self.hashes, return_index=True, return_counts=True)
        lang = self.row_lang[w.row[first]]
        for k in np.unique(lang):
            mine = lang == k
            f = first[mine]
            size = w.end[f] - w.start[f]
            yield self.langs[k], (found[mine][:, None], n[mine].astype(np.int64), size.astype(np.uint32), w.data[_spans(w.start[f], size)])


def _parse(n_buckets: int):
    """Parses documents ``lang, text`` into chunks and words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parsed, words, size = Summed(2, np.uint64), {}, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size
            size = 0
            found = parsed.put_together()
            yield from _rows(CHUNKS, None, n_buckets, found, found[0][:, 0])
            del found
            for lang in list(words):
                found = words.pop(lang).put_together()
                yield from _rows(WORDS, lang, n_buckets, found, found[0][:, 0])

        for b in ts.chunks(batches, "text", ts.SMALL_CHUNK_BYTES):
            s = Stream(b.column("lang"), b.column("text"))
            if len(s.hashes):
                parsed.add(*s.chunks())
                for lang, found in s.vocabulary():
                    words.setdefault(lang, Summed(1, np.uint8)).add(*found)
            size += len(s.words.data)
            if size >= FLUSH_BYTES:
                yield from flush()
        yield from flush()

    return run


def _dictionary(least: int):
    """The distinct chunks of a range of hashes, its frequent words, and its number of words for each language."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("kind", pa.int32()), ("lang", pa.string()), ("word", pa.string()), ("key", pa.int64()), ("n", pa.int64()), ("weights", pa.binary()), ("sizes", pa.binary()), ("data", pa.binary())])
        for kind, _, lang, s in _gathered(batches):
            keys, weights, sizes, data = s.put_together()
            if kind == CHUNKS:
                yield pa.RecordBatch.from_pylist([{"kind": CHUNKS, "n": len(weights), "weights": weights.tobytes(), "sizes": sizes.tobytes(), "data": data.tobytes()}], schema)
                continue
            at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            rows = [{"kind": WORDS, "lang": lang, "word": data[at[k] : at[k + 1]].tobytes().decode(), "key": int(keys[k, 0].view(np.int64)), "n": int(weights[k])} for k in np.flatnonzero(weights >= least).tolist()]
            yield pa.RecordBatch.from_pylist([*rows, {"kind": WORDS, "lang": lang, "n": int(weights.sum())}], schema)

    return run


def _phrases(orders: list[int], words, pairs, n_buckets: int):
    """Counts the phrases of chunks that the filters let through; ``words`` and ``pairs`` are broadcast filters or None."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {m: Summed(2, np.uint64) for m in orders}

        def flush(m: int) -> Iterator[pa.RecordBatch]:
            got = found[m].put_together()
            yield from _rows(m, None, n_buckets, got, _hash_of(m, got[0]))

        for b in batches:
            for weights, sizes, data in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                weights, sizes, stream = np.frombuffer(weights, np.int64), np.frombuffer(sizes, np.uint32).astype(np.int64), np.frombuffer(data, np.uint64)
                owned = np.ones(len(stream), bool)
                owned[_spans(np.cumsum(sizes) - OVERLAP, np.full(len(sizes), OVERLAP))] = False
                weight = np.repeat(weights, sizes)
                ok = stream != 0
                ok[ok] = words.value.holds(stream[ok].view(np.int64))
                ok = ok[:-1] & ok[1:]
                place = np.flatnonzero(ok)
                if pairs is not None:
                    place = place[pairs.value.holds(join_key(stream[place], stream[place + 1]).view(np.int64))]
                    ok[:] = False
                    ok[place] = True
                place = place[owned[place]]
                prefix = stream[place]
                for m in range(2, max(orders) + 1):
                    if m > 2:  # all pairs of the longer phrase must hold
                        still = (place + m - 2 < len(ok)) & ok[np.minimum(place + m - 2, len(ok) - 1)]
                        place, prefix = place[still], join_key(prefix[still], stream[place[still] + m - 2])
                    if m in orders and len(place):
                        found[m].add(np.stack([prefix, stream[place + m - 1]], axis=1), weight[place], np.zeros(0, np.uint32), np.zeros(0, np.uint64))
                for m in orders:
                    if found[m].size >= FLUSH_PHRASES:
                        yield from flush(m)
        for m in orders:
            yield from flush(m)
        ts.release()

    return run


def _frequent(least: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for m, _, _, s in _gathered(batches):
            keys, weights, _, _ = s.put_together()
            k = weights >= least
            key = join_key(keys[k, 0], keys[k, 1]).view(np.int64)
            yield pa.record_batch([pa.array([m] * len(key), pa.int32()), pa.array(key), pa.array(keys[k, 0].view(np.int64)), pa.array(keys[k, 1].view(np.int64)), pa.array(weights[k])], names=["words", "key", "prefix", "last", "a"])

    return run


_GRAMS = "words int, key long, prefix long, last long, a long"


def _cuts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each phrase its cuts in two (``k`` over 0, with the keys of both parts) and the shorter phrases in it (``k`` 0)."""
    for b in batches:
        out = [[], [], [], []]
        for key, path in zip(b.column("key").to_pylist(), b.column("path").to_pylist(), strict=True):
            words = np.array(path, np.int64).view(np.uint64)
            inside: dict[tuple[int, int], int] = {}
            for i in range(len(words)):
                h = words[i : i + 1]
                inside[i, i + 1] = int(h.view(np.int64)[0])
                for j in range(i + 1, len(words)):
                    h = join_key(h, words[j : j + 1])
                    inside[i, j + 1] = int(h.view(np.int64)[0])
            n = len(words)
            rows = [(k, inside[0, k], inside[k, n]) for k in range(1, n)] + [(0, v, None) for (i, j), v in inside.items() if 2 <= j - i < n]
            for k, first, rest in rows:
                for column, x in zip(out, (key, k, first, rest), strict=True):
                    column.append(x)
        yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64())], names=["key", "k", "first", "rest"])


def count_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent words ``key, lang, word, n``, frequent phrases ``words, key, prefix, last, a`` and all words by language,
    ``lang, n``; ``docs`` has ``lang, text``."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parsed = table(_deal(docs, _parse, max(1, -(-total // RANGE_BYTES))).mapInArrow(_dictionary(least), PARSED), "parsed")
    vocabulary = parsed.where(F.col("kind") == WORDS)
    words = vocabulary.where("key is not null").select("key", "lang", "word", "n")
    totals = table(vocabulary.where("key is null").groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    ranges = max(1, -(-n_words // RANGE_PHRASES))
    chunks = parsed.where(F.col("kind") == CHUNKS).select("weights", "sizes", "data")
    frequent = spark.sparkContext.broadcast(idfilter.build(words, "key"))
    pairs = table(_deal(chunks, lambda n: _phrases([2], frequent, None, n), ranges).mapInArrow(_frequent(least), _GRAMS), "pairs")
    known = spark.sparkContext.broadcast(idfilter.build(pairs, "key"))
    longer = table(_deal(chunks, lambda n: _phrases(list(range(3, LONGEST + 1)), frequent, known, n), ranges).mapInArrow(_frequent(least), _GRAMS), "longer")
    return words, pairs.unionByName(longer), totals


def _with_words(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """``key, lang, phrase, path, a`` of all phrases; ``path`` has the hashes of their words."""
    last = words.select(F.col("key").alias("last"), "word")
    shorter = words.select(F.col("key").alias("prefix"), "lang", F.col("word").alias("before"), F.array("key").alias("path_before"))
    out = None
    for m in range(2, LONGEST + 1):
        mine = table(phrases.where(F.col("words") == m).select("key", "prefix", "last", "a"), "phrases")
        mine = counted(table(counted(mine, shorter, "prefix"), "phrases"), last, "last")
        mine = table(mine.select("key", "lang", F.concat_ws(" ", "before", "word").alias("phrase"), F.concat("path_before", F.array("last")).alias("path"), "a"), "phrases")
        shorter = mine.select(F.col("key").alias("prefix"), "lang", F.col("phrase").alias("before"), F.col("path").alias("path_before"))
        out = mine if out is None else out.unionByName(mine)
    return out


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, first: int = FIRST, share: int = 100) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``first`` phrases of two to five words.

    A null language counts as ``und``, a null or empty text has no words.  Only A-Z are lower-cased.  A phrase counts
    wherever it stands within a piece, overlaps and repeated rows included; ``least`` is the fewest occurrences of a candidate.
    The score is that of the cut with the lowest, of equal ones the first.  Candidates inside a longer one that has at least
    ``share`` percent of their occurrences go.  Ties of score and count are ranked by phrase, in byte order.  An empty table
    gives no rows; other columns are not read.
    """
    words, phrases, totals = count_phrases(docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")), least)
    whole = _with_words(words, phrases)
    cuts = table(whole.select("key", "path").mapInArrow(_cuts, "key long, k int, first long, rest long"), "cuts")
    counts = words.select("key", F.col("n").alias("f")).unionByName(phrases.select("key", F.col("a").alias("f")))

    inside = cuts.where("k = 0").join(phrases.select("key", F.col("a").alias("longer")), "key").groupBy(F.col("first").alias("key")).agg(F.max("longer").alias("longer"))
    whole = whole.join(inside, "key", "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share)).drop("longer")

    parts = table(cuts.where("k > 0").join(whole.select("key", "lang", "a"), "key"), "parts")
    parts = table(counted(parts, counts.toDF("first", "l"), "first"), "parts")
    parts = counted(table(counted(parts, counts.toDF("rest", "r"), "rest"), "parts"), totals, "lang")
    # 38 digits hold all products: no count here reaches 10^15 and no total 10^17
    score = F.expr("(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(15,0)) * CAST(n AS DECIMAL(17,0))) DIV (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))")
    lowest = parts.withColumn("score", score).groupBy("key").agg(F.min(F.struct("score", "k", "l", "r", "n")).alias("cut"))
    scored = whole.join(lowest, "key").select("lang", "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    near = scored.withColumn("place", F.row_number().over(Window.partitionBy("lang", salt).orderBy(*order))).where(F.col("place") <= first).drop("place")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH pieces AS (SELECT lang, unnest([regexp_extract_all(x, '[^\x20\x09]+') FOR x IN regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')]) AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)),
grams AS MATERIALIZED (SELECT lang, m, array_to_string(w[i + 1 : i + m], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, m, unnest(range(len(w) - m + 1)) AS i FROM pieces, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m) GROUP BY ALL HAVING m = 1 OR f >= 100),
total AS (SELECT lang, sum(f) AS n FROM grams WHERE m = 1 GROUP BY 1),
cand AS MATERIALIZED (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE m > 1),
inner_ AS (SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, a, array_to_string(w[i + 1 : i + k], ' ') AS phrase FROM (SELECT lang, a, w, k, unnest(range(m - k + 1)) AS i FROM cand, (SELECT unnest(range(2, 5)) AS k) WHERE k < m)) GROUP BY ALL),
kept AS (SELECT cand.* FROM cand LEFT JOIN inner_ USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a),
cut AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS one, array_to_string(w[k + 1 :], ' ') AS two FROM (SELECT *, unnest(range(1, m)) AS k FROM kept)),
scored AS (SELECT cut.lang, cut.phrase, a, k, x.f AS l, y.f AS r, n, CAST(CAST(1000 AS HUGEINT) * a * CAST(n AS HUGEINT) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cut JOIN grams x ON x.lang = cut.lang AND x.phrase = one JOIN grams y ON y.lang = cut.lang AND y.phrase = two JOIN total ON total.lang = cut.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM best QUALIFY rank <= 2000
"""
