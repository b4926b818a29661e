"""Token counts under a unigram model, by dynamic programming shared in a trie.

The distinct pre-tokens of a chunk are inserted in a trie.  Each node keeps the forward score of its
prefix, the best log probability of any split into pieces, and how many pieces that split has; a
prefix that many pre-tokens share is scored once, and the count at a pre-token's last node is its
token count.  Tries live within a task and are emptied at ``MAX_NODES``, so nothing is shuffled and
memory is bounded.

The vocabulary is a public piece file (never trained here).  Its pieces come in order of frequency, so
the piece of rank r has the probability 1 / (r H), with H the sum of 1 / r over all ranks; a character
without a piece is spelled in bytes, each with the rank after the last.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textscan as ts

MAX_NODES = 400_000
WORD_MARK = "▁"


def read_pieces(model: bytes) -> tuple[dict[str, float], float]:
    """Log probabilities of the pieces of a piece model, and of a byte."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = [m.id_to_piece(i) for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i))]
    norm = math.log(sum(1 / r for r in range(1, len(pieces) + 2)))
    return {p: -math.log(r) - norm for r, p in enumerate(pieces, 1)}, -math.log(len(pieces) + 1) - norm


class Trie:
    """Pre-tokens by character, with the best score and piece count of each prefix."""

    def __init__(self, pieces: dict[str, float], byte: float):
        self.pieces, self.byte = pieces, byte
        #: Every suffix of a piece, with the piece's score if it is one itself: a look back stops where no piece can end.
        self.ends: dict[str, float | None] = {p[k:]: None for p in pieces for k in range(len(p))} | pieces
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.score, self.count = [0.0], [0]

    def tokens(self, word: str) -> int:
        """The number of pieces of the best split; of equal scores the one with fewer pieces."""
        child, score, count, ends = self.child, self.score, self.count, self.ends
        node, path = 0, [0]
        for i, char in enumerate(word, 1):
            at = child.get((node, char))
            if at is None:
                at = len(score)
                size = len(char.encode())
                best, n = score[node] + size * self.byte, count[node] + size
                for k in range(i - 1, -1, -1):
                    p = ends.get(word[k:i], 0.0)
                    if p == 0.0:
                        break
                    if p is not None:
                        s, m = score[path[k]] + p, count[path[k]] + 1
                        if s > best or (s == best and m < n):
                            best, n = s, m
                child[node, char] = at
                score.append(best)
                count.append(n)
            node = at
            path.append(at)
        return count[node]


def split_words(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """For each word its place among the distinct words, these, and each row's number of words."""
    parts = pc.ascii_split_whitespace(pc.fill_null(column.cast(pa.large_string()), ""))
    flat = parts.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    row = pc.list_parent_indices(parts).filter(full).to_numpy()
    coded = flat.filter(full).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, np.bincount(row, minlength=len(column))


def _counts(model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(*read_pieces(model.value))
        for c in ts.chunks(batches, limit=2 * ts.CHUNK_BYTES):
            code, distinct, n_words = split_words(c.column("text"))
            each = np.zeros(len(distinct), np.int64)
            for k, word in enumerate(distinct.to_pylist()):
                if len(trie.score) > MAX_NODES:
                    trie.clear()
                each[k] = trie.tokens(WORD_MARK + word)
            first = np.concatenate([[0], np.cumsum(n_words)])
            yield pa.record_batch({"doc_id": c.column("doc_id"), "n_words": n_words, "n_tokens": ts.row_sums(each[code], first)})

    return run


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, n_words, n_tokens`` for each row of ``docs`` (``doc_id, text``; other columns are not looked at).

    ``model_path`` is read on the driver and sent to the tasks (half a megabyte).  Null, empty and blank
    texts have no words and no tokens; null ids and repeated rows are counted like any other row; words
    and texts may have any length.
    """
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    slim = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(_counts(model), f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, n_tokens long")


def query(spark, sf_dir: str) -> DataFrame:
    """op1: the counts of every document."""
    import public_tokenizers

    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
