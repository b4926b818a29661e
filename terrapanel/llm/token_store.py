"""Token-ID output as sorted-string-table shards.

A shard holds documents in ascending order of their ids:

    blocks    entries of one block, compressed together: each entry has the bytes shared with the key
              before, the rest of the key, the number of tokens and the tokens (2 or 4 bytes each)
    index     for each block: last key, offset and length (a sparse index, searched by halves)
    filter    a Bloom filter over the keys
    footer    fixed size: offsets and lengths of index and filter, documents, tokens, width, magic

A key is the id as eight bytes whose order is the ids' order; a null id is the empty key, before all
others.  Documents are dealt out by ranges of ids, so the shards' names are in the order of the ids.
Each task writes its shards under their final names by renaming, with the same content on a retry.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrapanel.sources.shared import shared_dir

from . import textscan as ts

MAGIC = b"TPSST1\0\0"
FOOTER = struct.Struct("<QQQQQQQ8s")
BLOCK_BYTES = 64 << 10
SHARD_BYTES = 32 << 20
FILTER_BITS, FILTER_PROBES = 10, 7
MAX_KNOWN = 300_000
#: So many words are asked for as one text.
IN_A_ROW = 64
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
_MARK[list(b".,!?;:")] = True
SIGN = 1 << 63


def key_of(doc_id: int | None) -> bytes:
    return b"" if doc_id is None else (doc_id + SIGN).to_bytes(8, "big")


def id_of(key: bytes) -> int | None:
    return int.from_bytes(key, "big") - SIGN if key else None


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _probes(key: bytes, bits: int) -> list[int]:
    a, b = zlib.crc32(key), zlib.crc32(key, 0x9E3779B9) | 1
    return [(a + k * b) % bits for k in range(FILTER_PROBES)]


class ShardWriter:
    """Builds one shard in memory; a shard is bounded by ``SHARD_BYTES`` and one document."""

    def __init__(self, width: int):
        self.width, self.body, self.index, self.keys = width, bytearray(), [], []
        self.block, self.last, self.n_tokens = bytearray(), b"", 0
        self.pack = zstandard.ZstdCompressor(level=1)

    def add(self, key: bytes, ids: np.ndarray) -> None:
        shared = 0
        if self.block:
            while shared < min(len(key), len(self.last)) and key[shared] == self.last[shared]:
                shared += 1
        self.block += _varint(shared) + _varint(len(key) - shared) + key[shared:] + _varint(len(ids)) + ids.astype(f"<u{self.width}").tobytes()
        self.last = key
        self.keys.append(key)
        self.n_tokens += len(ids)
        if len(self.block) >= BLOCK_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.block:
            packed = self.pack.compress(bytes(self.block))
            self.index.append((self.last, len(self.body), len(packed)))
            self.body += packed
            self.block = bytearray()

    def finish(self) -> bytes:
        self._flush()
        index = b"".join(_varint(len(k)) + k + _varint(o) + _varint(n) for k, o, n in self.index)
        bits = max(64, FILTER_BITS * len(self.keys))
        bloom = bytearray(-(-bits // 8))
        for key in self.keys:
            for p in _probes(key, bits):
                bloom[p >> 3] |= 1 << (p & 7)
        at = len(self.body)
        footer = FOOTER.pack(at, len(index), at + len(index), bits, len(self.keys), self.n_tokens, self.width, MAGIC)
        return bytes(self.body) + index + bytes(bloom) + footer


def read_footer(tail: bytes) -> dict[str, int]:
    *numbers, magic = FOOTER.unpack(tail[-FOOTER.size :])
    if magic != MAGIC:
        raise ValueError("not a token shard")
    return dict(zip(("index_at", "index_size", "filter_at", "filter_bits", "n_docs", "n_tokens", "width"), numbers, strict=True))


def read_index(data: bytes) -> list[tuple[bytes, int, int]]:
    out, at = [], 0
    while at < len(data):
        n, at = _read_varint(data, at)
        key, at = data[at : at + n], at + n
        offset, at = _read_varint(data, at)
        size, at = _read_varint(data, at)
        out.append((key, offset, size))
    return out


def read_block(data: bytes, width: int) -> Iterator[tuple[bytes, np.ndarray]]:
    raw, at, key = zstandard.ZstdDecompressor().decompress(data), 0, b""
    while at < len(raw):
        shared, at = _read_varint(raw, at)
        n, at = _read_varint(raw, at)
        key, at = key[:shared] + raw[at : at + n], at + n
        n, at = _read_varint(raw, at)
        yield key, np.frombuffer(raw, f"<u{width}", n, at)
        at += n * width


def read_shard(data: bytes) -> Iterator[tuple[bytes, np.ndarray]]:
    """All documents of a shard in order."""
    f = read_footer(data)
    for _, offset, size in read_index(data[f["index_at"] : f["index_at"] + f["index_size"]]):
        yield from read_block(data[offset : offset + size], f["width"])


def find(path: str, doc_id: int | None) -> np.ndarray | None:
    """The tokens of one document of a shard, by its filter and a binary search; None if it isn't there."""
    where, name = fs.FileSystem.from_uri(path)
    key = key_of(doc_id)
    with where.open_input_file(name) as file:
        end = file.size()
        f = read_footer(file.read_at(FOOTER.size, end - FOOTER.size))
        bloom = file.read_at(-(-f["filter_bits"] // 8), f["filter_at"])
        if not all(bloom[p >> 3] >> (p & 7) & 1 for p in _probes(key, f["filter_bits"])):
            return None
        index = read_index(file.read_at(f["index_size"], f["index_at"]))
        low, high = 0, len(index)
        while low < high:
            mid = (low + high) // 2
            low, high = (mid + 1, high) if index[mid][0] < key else (low, mid)
        if low < len(index):
            for k, ids in read_block(file.read_at(index[low][2], index[low][1]), f["width"]):
                if k == key:
                    return ids
    return None


class UnitEncoder:
    """Ids by the tokenizers library, which is asked once for each distinct unit of a chunk, and not again
    for the units of chunks just before.

    A unit is a word with the white space before it (without the marks after it), and
    white space that ends a text.  A byte-level
    file splits text at the same places whatever stands around a unit, unless other white space than
    space and ``\\x09-\\x0D``, or a special token's text, is there; such texts are encoded whole.
    """

    def __init__(self, data: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(data)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        #: In a byte-level file a token has one character for each byte; added tokens are 0, so they fit nowhere.
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        added = self.tokenizer.get_added_tokens_decoder()
        self.bytes_of = np.zeros(max(vocab.values(), default=0) + 1, np.int64)
        for token, k in vocab.items():
            self.bytes_of[k] = 0 if k in added else len(token)

    def _ids(self, texts: list[str]) -> list[bytes]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        edge = np.cumsum([0, *map(len, ids)]) * 4
        packed = array("I", chain.from_iterable(ids)).tobytes()
        return [packed[a:b] for a, b in pairwise(edge.tolist())]

    def _units(self, units: list[bytes]) -> list[bytes]:
        """Packed ids of each unit; units met lately are not asked for again."""
        if len(self.known) + len(units) > MAX_KNOWN:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        found = list(map(known.get, units))
        lacks = [k for k, x in enumerate(found) if x is None]
        if older:
            for k in lacks:
                x = older.get(units[k])
                if x is not None:
                    found[k] = known[units[k]] = x
            lacks = [k for k in lacks if found[k] is None]
        for at in range(0, len(lacks), 4096):
            part = lacks[at : at + 4096]
            for k, x in zip(part, self._asked([units[k] for k in part]), strict=True):
                found[k] = known[units[k]] = x
        return found

    def _asked(self, units: list[bytes]) -> list[bytes]:
        """Packed ids of each unit from the library.  Words with a space before them are asked for in rows, as a text has them, which is
        cut by the tokens' bytes; a row whose tokens don't end where its units do is asked for again by unit."""
        led = [k for k, u in enumerate(units) if u[0] == 0x20 and u[-1] > 0x20]
        out: list[bytes | None] = [None] * len(units)
        rows = [led[at : at + IN_A_ROW] for at in range(0, len(led), IN_A_ROW)]
        for row, packed in zip(rows, self._ids([b"".join([units[k] for k in row]).decode() for row in rows]), strict=True):
            end = np.cumsum(self.bytes_of[np.frombuffer(packed, "<u4")])
            upto = np.cumsum([len(units[k]) for k in row])
            at = np.searchsorted(end, upto)
            if len(end) and end[-1] == upto[-1] and (end[at] == upto).all():
                for k, a, b in zip(row, [0, *(4 * at + 4).tolist()], (4 * at + 4).tolist(), strict=False):
                    out[k] = packed[a:b]
        lone = [k for k, x in enumerate(out) if x is None]
        for k, x in zip(lone, self._ids([units[k].decode() for k in lone]), strict=True):
            out[k] = x
        return out

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in order, and each text's number of ids."""
        w = ts.words(column)
        _, offsets = ts.text_bytes(column)
        edge = np.sort(np.concatenate([offsets, w.end, self._marks(w.data)]), kind="stable")
        edge = edge[np.concatenate([[True], edge[1:] != edge[:-1]])]
        units = pa.Array.from_buffers(pa.large_binary(), len(edge) - 1, [None, pa.py_buffer(edge.astype(np.int64).tobytes()), pa.py_buffer(w.data.tobytes())])
        whole = self._whole(w.data, offsets)
        row = np.searchsorted(offsets, edge[:-1], side="right") - 1
        plain = ~whole[row]
        coded = units.filter(pa.array(plain)).dictionary_encode()
        odd = np.flatnonzero(whole)
        found = self._units(coded.dictionary.to_pylist()) + [self._ids([column[int(k)].as_py()])[0] for k in odd]
        count = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = np.frombuffer(b"".join(found), "<u4")
        start = np.cumsum(count) - count
        code = np.concatenate([coded.indices.to_numpy(), np.arange(len(found) - len(odd), len(found))]).astype(np.int64)
        row = np.concatenate([row[plain], odd])
        if len(odd):
            order = np.argsort(row, kind="stable")
            code, row = code[order], row[order]
        size = count[code]
        at = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        n = np.bincount(row, weights=size, minlength=len(column)).astype(np.int64)
        return ids[np.repeat(start[code] - at[:-1], size) + np.arange(at[-1])], n

    @staticmethod
    def _marks(data: np.ndarray) -> np.ndarray:
        """Where a common mark follows a letter: the file's pattern always cuts there, so ``word,`` is two units."""
        return np.flatnonzero(_LETTER[data[:-1]] & _MARK[data[1:]]) + 1

    @staticmethod
    def _whole(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The texts with other white space or what may be a special token."""
        a = data
        b = np.append(a[1:], 0).astype(np.uint8)
        c = np.append(a[2:], [0, 0])[: len(a)].astype(np.uint8)
        hit = (a >= 0x1C) & (a <= 0x1F)
        hit |= (a == 0x3C) & (b == 0x7C)
        hit |= (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
        hit |= (a == 0xE1) & (b == 0x9A) & (c == 0x80)
        hit |= (a == 0xE2) & (((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F)))
        hit |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
        out = np.zeros(len(offsets) - 1, bool)
        out[np.searchsorted(offsets, np.flatnonzero(hit), side="right") - 1] = True
        return out


_ENCODERS: dict[int, UnitEncoder] = {}


def _loaded(data) -> UnitEncoder:
    key = hash(data.value)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = UnitEncoder(data.value)
    return _ENCODERS[key]


MANIFEST = "shard string, n_docs long, n_tokens long"


def _write(data, folder: str, end_id: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _loaded(data)
        where, base = fs.FileSystem.from_uri(folder)
        where.create_dir(base, recursive=True)
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        serial = 0

        def close(w: ShardWriter) -> pa.RecordBatch:
            nonlocal serial
            name = f"{part:08d}-{serial:06d}.sst"
            serial += 1
            with where.open_output_stream(f"{base}/_{attempt}-{name}") as out:
                out.write(w.finish())
            # An earlier attempt may have left the same shard, and not every store moves a file over another.
            if where.get_file_info(f"{base}/{name}").type != fs.FileType.NotFound:
                where.delete_file(f"{base}/{name}")
            where.move(f"{base}/_{attempt}-{name}", f"{base}/{name}")
            return pa.record_batch({"shard": [name], "n_docs": [len(w.keys)], "n_tokens": [w.n_tokens]})

        writer = ShardWriter(encoder.width)
        for c in ts.chunks(batches):
            ids, count = encoder.encode(c.column("text"))
            for doc_id, mine in zip(c.column("doc_id").to_pylist(), np.split(ids, np.cumsum(count)[:-1]), strict=True):
                writer.add(key_of(doc_id), np.append(mine, np.uint32(end_id)))
                if len(writer.body) >= SHARD_BYTES:
                    yield close(writer)
                    writer = ShardWriter(encoder.width)
        if writer.keys:
            yield close(writer)

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int) -> DataFrame:
    """Encodes ``text``, ends each document with ``end_id``, and writes the shards to ``folder``.

    Returns the manifest, read back: ``shard`` (in order of the ids), ``n_docs``, ``n_tokens``.  Null,
    empty and blank texts are written too, null ones with the end id alone; rows with a null ``doc_id``
    come first, repeated ids one after the other in the order of their texts; columns but ``doc_id`` and
    ``text`` are not looked at.  An empty table writes no shard.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        data = spark.sparkContext.broadcast(f.read())
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = slim.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    dealt.mapInArrow(_write(data, folder, end_id), MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            docs = list(read_shard(content.as_buffer().to_pybytes()))
            size = np.array([len(ids) for _, ids in docs], np.int64)
            yield pa.record_batch(
                {
                    "shard": pa.array([path.as_py().rsplit("/", 1)[1]] * len(docs)),
                    "doc_id": pa.array([id_of(k) for k, _ in docs], pa.int64()),
                    "before": np.cumsum(size) - size,
                    "n_tokens": size,
                    "ids": pa.array([ids.astype("<u4").tobytes() for _, ids in docs], pa.binary()),
                }
            )


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the shards in ``folder``: ``doc_id, start, n_tokens, ids``.

    ``start`` counts the tokens of all documents before it; ``ids`` are little-endian 32-bit numbers.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("shard", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("shard_start"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.sst").load(folder).select("path", "content")
    docs = files.mapInArrow(_read, "shard string, doc_id long, before long, n_tokens long, ids binary")
    return docs.join(starts, "shard").select("doc_id", (F.col("shard_start") + F.col("before")).alias("start"), "n_tokens", "ids")


def query(spark, sf_dir: str) -> DataFrame:
    """op4: writes the shards of all documents and describes what they hold."""
    import public_tokenizers

    folder = shared_dir(spark, "tokens")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
