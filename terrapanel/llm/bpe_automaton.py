"""BPE encoding and decoding with a tokenization automaton.

The automaton reads tokens; its state is the token read last.  It starts with an arc between any two
symbols, and each merge (u, v) -> w, in order of priority, adds a gadget: the arc from u to v goes, w
gets the arcs into u as its arcs in and the arcs out of v as its arcs out.  What is left after the last
merge accepts exactly the token sequences that the merges give, and since it is deterministic a word's
encoding is its only path.  All arcs together would be too many to list (vocabulary squared), so a
gadget keeps (u, v, priority) and an arc is worked out from the gadgets when first asked for, then
kept in the transition table.

A word is encoded by table look-ups: for each position the one token that ends there and whose arc from
the token before exists.  Decoding emits the labels of the path's arcs.
"""

from __future__ import annotations

import json
import pickle
import re
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textscan as ts
from .hashtable import HashTable
from .token_counts import split_words

MAX_ARCS = 1_000_000
#: Longer pieces are read one by one.
LONG_PIECE = 64
#: Symbols that are read, and words whose ids are put together, at once.
AT_ONCE = 1 << 17
#: Bytes of text whose words are read together.
CHUNK_BYTES = 2 << 20


class Automaton:
    """The compiled merges of a vocabulary."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.vocab = vocab
        n = max(vocab.values()) + 1
        self.born, self.left, self.right = [-1] * n, [0] * n, [0] * n
        self.merge: dict[tuple[int, int], int] = {}
        for k, (u, v) in enumerate(merges):
            a, b = vocab[u], vocab[v]
            w = vocab[u + v]
            self.merge.setdefault((a, b), k)
            if self.born[w] < 0:
                self.born[w], self.left[w], self.right[w] = k, a, b
        self.table: dict[tuple[int, int], bool] = {}
        self.reached: dict[int, bool] = {}

    def arc(self, a: int, b: int) -> bool:
        """Whether an arc leads from token ``a`` to token ``b``."""
        found = self.table.get((a, b))
        if found is None:
            if len(self.table) >= MAX_ARCS:
                self.table.clear()
            found = self.table[a, b] = self._arc(a, b, len(self.merge))
        return found

    def _arc(self, a: int, b: int, before: int) -> bool:
        """Whether the arc is there just before merge ``before``: back through the gadgets that made it."""
        born, merge = self.born, self.merge
        while True:
            k = merge.get((a, b))
            if k is not None and k < before:
                return False
            i, j = born[a], born[b]
            if i < 0 and j < 0:
                return True
            if i > j:
                before, a = i, self.right[a]
            elif j > i:
                before, b = j + 1, self.left[b]
            else:
                before, a, b = i, self.right[a], self.left[b]

    def alive(self, t: int) -> bool:
        """Whether the merges ever make this token."""
        found = self.reached.get(t)
        if found is None:
            k = self.born[t]
            found = self.reached[t] = k < 0 or (self.alive(self.left[t]) and self.alive(self.right[t]) and self._arc(self.left[t], self.right[t], k))
        return found

    def ends(self, tail: str) -> dict[str, int]:
        """Every string that a live token with ``tail`` after it ends in, with the token's id if it is one."""
        out: dict[str, int] = {}
        for t, i in self.vocab.items():
            if t.endswith(tail) and self.alive(i):
                t = t[: len(t) - len(tail)]
                for k in range(1, len(t)):
                    out.setdefault(t[k:], -1)
                out[t] = i
        return out


class Encoder:
    """Paths of words through an automaton.

    The path to a prefix does not depend on what follows, so a word takes over the states that it shares
    with the word before; in sorted order a shared prefix is read once.
    """

    def __init__(self, automaton: Automaton, suffix: str):
        self.automaton = automaton
        self.inner, self.final = automaton.ends(""), automaton.ends(suffix)
        self.word, self.state, self.begin = "", [-1], [0]

    def _step(self, word: str, i: int, ends: dict[str, int]) -> tuple[int, int]:
        """The token that ends the path to the first ``i`` symbols, and where it begins."""
        state, arc = self.state, self.automaton.arc
        for j in range(i - 1, -1, -1):
            t = ends.get(word[j:i])
            if t is None:
                break
            if t >= 0 and (j == 0 or (state[j] >= 0 and arc(state[j], t))):
                return t, j
        return -1, 0

    def encode(self, word: str) -> list[int]:
        """The tokens of a word."""
        n, before, state, begin = len(word), self.word, self.state, self.begin
        same, most = 0, min(n - 1, len(state) - 1)
        while same < most and word[same] == before[same]:
            same += 1
        del state[same + 1 :], begin[same + 1 :]
        for i in range(same + 1, n):
            t, j = self._step(word, i, self.inner)
            state.append(t)
            begin.append(j)
        self.word = word
        t, i = self._step(word, n, self.final)
        out = [t]
        while i:
            out.append(state[i])
            i = begin[i]
        return out[::-1]


class Tables:
    """The automaton's tables as arrays, to read many pieces at once.

    ``walk`` leads from a node of the trie of all tokens' symbols, and a symbol, to the next node;
    ``inner`` and ``final`` have the token at a node, within a piece and at its end; ``arcs`` holds the
    transitions worked out so far.
    """

    def __init__(self, automaton: Automaton, suffix: str):
        self.automaton, self.suffix = automaton, suffix
        symbols = sorted({c for t in automaton.vocab for c in t})
        self.symbol = {c: k for k, c in enumerate(symbols)}
        nodes: dict[str, int] = {"": 0}
        keys, values, ids = [], [], []
        for t, i in automaton.vocab.items():
            if not automaton.alive(i):
                continue
            end = bool(suffix) and t.endswith(suffix)
            t = t[: len(t) - len(suffix)] if end else t
            for k in range(1, len(t) + 1):
                if t[:k] not in nodes:
                    keys.append(nodes[t[: k - 1]] << 10 | self.symbol[t[k - 1]])
                    nodes[t[:k]] = len(nodes)
                    values.append(len(nodes) - 1)
            ids.append((nodes[t], i, end))
        self.walk = HashTable(int(4 * len(keys)).bit_length())
        self.walk.put(np.array(keys, np.int64), np.array(values, np.int32))
        self.inner, self.final = (np.full(len(nodes), -1, np.int32) for _ in range(2))
        for node, i, end in ids:
            (self.final if end else self.inner)[node] = i
        if not suffix:
            self.final = self.inner
        self.arcs = HashTable(18)

    @cached_property
    def encoder(self) -> Encoder:
        """For long pieces; most texts have none."""
        return Encoder(self.automaton, self.suffix)

    def _open(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether arcs lead from the tokens ``a`` to the tokens ``b``."""
        key = a.astype(np.int64) << 32 | b
        found = self.arcs.get(key)
        if (found < 0).any():
            new = np.unique(key[found < 0])
            if self.arcs.used > MAX_ARCS:
                self.arcs = HashTable(18)
            n = len(self.automaton.merge)
            self.arcs.put(new, np.array([self.automaton._arc(k >> 32, k & 0xFFFFFFFF, n) for k in new.tolist()], np.int32))
            return self._open(a, b) if self.arcs.used == len(new) else np.where(found < 0, self.arcs.get(key), found) == 1
        return found == 1

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All tokens of all pieces in order, and how many each piece has."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        edge = np.searchsorted(np.cumsum(size), np.arange(AT_ONCE, int(size.sum()) + AT_ONCE, AT_ONCE), side="left") + 1
        cuts = [0, *np.unique(np.minimum(edge, len(pieces))).tolist()]
        parts = [self._encode(pieces[a:b], size[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b]
        return np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])

    def _encode(self, pieces: list[str], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        short = size <= LONG_PIECE
        text = "".join(p for p, ok in zip(pieces, short, strict=True) if ok)
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        names = np.zeros(max(map(ord, self.symbol)) + 1, np.int64)
        names[[ord(c) for c in self.symbol]] = list(self.symbol.values())
        code = names[code]
        own = size[short]
        stop = np.repeat(np.cumsum(own), own)
        place = np.arange(len(code)) - np.repeat(np.cumsum(own) - own, own)
        # From each place along the trie as far as tokens go; what ends on the way may be on a path.
        at, node, far = np.arange(len(code)), np.zeros(len(code), np.int64), 0
        begins, ends, tokens = [], [], []
        while len(at):
            node = self.walk.get(node << 10 | code[at + far]).astype(np.int64)
            far += 1
            ok = node >= 0
            at, node = at[ok], node[ok]
            whole = at + far == stop[at]
            t = np.where(whole, self.final[node], self.inner[node])
            hit = t >= 0
            begins.append(at[hit])
            ends.append(at[hit] + far)
            tokens.append(t[hit])
            at, node = at[~whole], node[~whole]
        begin, end, token = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (begins, ends, tokens))
        depth = place[end - 1]
        order = np.argsort(depth.astype(np.uint8), kind="stable")
        begin, end, token = begin[order], end[order], token[order]
        cut = np.searchsorted(depth[order], np.arange(LONG_PIECE + 1))
        state, came = np.full(len(code) + 1, -1, np.int64), np.zeros(len(code) + 1, np.int64)
        # By places from the pieces' beginnings: each place has one token whose arc from the token before exists.
        for k in range(LONG_PIECE):
            b, e, t = begin[cut[k] : cut[k + 1]], end[cut[k] : cut[k + 1]], token[cut[k] : cut[k + 1]]
            if not len(b):
                continue
            first = place[b] == 0
            before = state[b]
            ok = first | (before >= 0)
            check = np.flatnonzero(ok & ~first)
            ok[check] = self._open(before[check], t[check])
            state[e[ok]], came[e[ok]] = t[ok], b[ok]
            # The end of a piece is the next one's beginning, which has no state before it.
        on = np.zeros(len(code) + 1, bool)
        at = np.cumsum(own)
        while len(at):
            on[at] = True
            at = came[at]
            at = at[place[np.minimum(at, len(code) - 1)] > 0]
        ids = state[on].astype(np.int32)
        count = np.zeros(len(pieces), np.int64)
        count[short] = np.diff(np.concatenate([[0], np.cumsum(on)[np.cumsum(own)]]))
        if not short.all():
            parts = np.split(ids, np.cumsum(count[short])[:-1]) if short.any() else []
            rest = iter(parts)
            out = [next(rest) if ok else np.array(self.encoder.encode(p), np.int32) for p, ok in zip(pieces, short, strict=True)]
            count = np.fromiter(map(len, out), np.int64, len(out))
            ids = np.concatenate(out)
        return ids, count


#: Words of printable characters up to U+017F; they are their own normal form but for case.
_PLAIN = re.compile("[!-~¡-ſ]+")
_PLAIN_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ſ]+|[0-9²³¹¼-¾]|[^\na-zªµºß-öø-ſ0-9²³¹¼-¾]+|\n")


def byte_symbols() -> dict[int, str]:
    """The printable symbol of each byte in byte-level vocabularies: itself if printable, else from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordTokenizer:
    """A tokenizer file with word-end BPE: its normaliser and splitter as they are, its merges as an automaton."""

    def __init__(self, data: str):
        spec = json.loads(data)
        self.automaton = Automaton(spec["model"]["vocab"], [tuple(m) for m in spec["model"]["merges"]])
        self.tables = Tables(self.automaton, spec["model"]["end_of_word_suffix"] or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        # The normaliser and the splitter need no tokens.
        self.splitter = json.dumps(spec | {"added_tokens": [], "model": spec["model"] | {"vocab": {}, "merges": []}})
        self.symbols = {chr(b): s for b, s in byte_symbols().items()}
        self.to_symbols = str.maketrans(self.symbols)

    @cached_property
    def parts(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.splitter)

    @cached_property
    def label(self) -> list[str]:
        label = {i: t for t, i in (self.automaton.vocab | self.special).items()}
        return [label.get(i, "") for i in range(max(label) + 1)]

    def _split(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """The pieces of all words in order, special tokens among them, and how many each word has."""
        pieces: list[str] = []
        count = np.zeros(len(words), np.int64)
        plain = [bool(_PLAIN.fullmatch(w)) and "<|" not in w for w in words]
        run: list[int] = []

        def flush() -> None:
            found = _PLAIN_SPLIT.findall("\n".join(words[k] for k in run).lower())
            ends = np.array([p == "\n" for p in found] + [True])
            edge = np.flatnonzero(ends)
            count[run] = np.diff(np.concatenate([[-1], edge])) - 1
            pieces.extend(p.encode().decode("latin-1").translate(self.to_symbols) for p in found if p != "\n")
            run.clear()

        for k, ok in enumerate(plain):
            if ok:
                run.append(k)
                continue
            if run:
                flush()
            mine: list[str] = []
            for part in self.cut.split(words[k]):
                if part in self.special:
                    mine.append(part)
                else:
                    mine += (p for p, _ in self.parts.pre_tokenizer.pre_tokenize_str(self.parts.normalizer.normalize_str(part)))
            pieces += mine
            count[k] = len(mine)
        if run:
            flush()
        return pieces, count

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in order, and how many each word has; a word has no white space."""
        pieces, n_pieces = self._split(words)
        if not pieces:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        coded = pa.array(pieces, pa.large_string()).dictionary_encode()
        code, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        special = {k: self.special[p] for k, p in enumerate(distinct) if p in self.special}
        ids, count = self.tables.encode([p if k not in special else "!" for k, p in enumerate(distinct)])
        start = np.cumsum(count) - count
        ids = ids.copy()
        for k, i in special.items():
            ids[start[k]] = i
        size = count[code]
        at = np.concatenate([[0], np.cumsum(size)])
        spot = np.repeat(start[code] - at[:-1], size) + np.arange(at[-1])
        return ids[spot], ts.row_sums(size, np.concatenate([[0], np.cumsum(n_pieces)]))

    def decode(self, ids: Iterable[int]) -> str:
        """The arc labels along the path, as the file's decoder has them: apart by spaces."""
        return " ".join(self.label[i] for i in ids)


def compiled(data: str) -> bytes:
    """A tokenizer file's :class:`WordTokenizer`, to be sent to tasks."""
    return pickle.dumps(WordTokenizer(data))


def _encode(data, carry: list[str], chunk_bytes: int = CHUNK_BYTES, at_once: int = AT_ONCE, decode: bool = True):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Unpacked for each task and gone with it: Spark keeps its Python workers for later stages.
        tokenizer = pickle.loads(data.value)
        if decode:
            labels = [x.encode() for x in tokenizer.label]
            width = np.array([len(x) for x in labels])
            label_end = np.cumsum(width)
            label_bytes = np.frombuffer(b"".join(labels), np.uint8)
        for c in ts.chunks(batches, limit=chunk_bytes):
            code, distinct, n_words = split_words(c.column("text"))
            ids, count = tokenizer.encode_words(distinct.to_pylist())
            start, first = np.cumsum(count) - count, np.concatenate([[0], np.cumsum(n_words)])
            k = 0
            while k < c.num_rows:
                end = max(k + 1, int(np.searchsorted(first, first[k] + at_once, side="right")) - 1)
                mine = code[first[k] : first[end]]
                size = count[mine]
                at = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
                own = ids[np.repeat(start[mine] - at[:-1], size) + np.arange(at[-1])]
                n_tokens = ts.row_sums(size, first[k : end + 1] - first[k])
                offsets = np.concatenate([[0], np.cumsum(n_tokens)]).astype(np.int32)
                some = c.slice(k, end - k)
                out = {x: some.column(x) for x in carry} | {"n_tokens": n_tokens, "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(own))}
                if decode:
                    row = np.repeat(np.arange(end - k), n_tokens)
                    out["decoded"] = ts.join_words(ts.Words(label_bytes, (label_end - width)[own], label_end[own], row, end - k), np.ones(len(own), bool))
                yield pa.record_batch(out)
                k = end
            del code, distinct, ids, count, start
            ts.release()

    return run


def encode_documents(docs: DataFrame, tokenizer_path: str, carry: tuple[str, ...] = ("doc_id",), chunk_bytes: int = CHUNK_BYTES, at_once: int = AT_ONCE, decode: bool = True) -> DataFrame:
    """Each row's ``carry`` columns with ``n_tokens``, ``ids`` and, with ``decode``, ``decoded``, the text of the ids.

    ``docs`` needs ``text``; columns not in ``carry`` are not looked at.  The tokenizer file is compiled on
    the driver and sent to the tasks (five megabytes).  Null, empty and blank texts give no ids and an empty
    decoded text; null ids and repeated rows are encoded like any other row.  Words are encoded on their
    own, since this kind of file never joins what white space parts; texts of any length are read whole.
    ``chunk_bytes`` of text and ``at_once`` words are worked on at a time, which bounds a task's memory.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        data = docs.sparkSession.sparkContext.broadcast(compiled(f.read()))
    kinds = dict(docs.dtypes)
    slim = docs.select(*carry, F.col("text").cast("string").alias("text")) if "text" not in carry else docs.select(*carry)
    schema = "".join(f"`{x}` {kinds[x]}, " for x in carry) + "n_tokens long, ids array<int>" + ", decoded string" * decode
    return slim.mapInArrow(_encode(data, list(carry), chunk_bytes, at_once, decode), schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op2: digests of the ids and of the decoded text of every document."""
    import public_tokenizers

    done = encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
    return done.select("doc_id", "n_tokens", F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
