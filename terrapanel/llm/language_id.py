"""Language ID by a bidirectional gated recurrent network over bytes.

The network reads a text byte by byte in both directions and gives every position the probabilities of the
languages; a document's are the mean over the positions of its letters.  Texts are dealt into stretches of
``STRETCH`` bytes that span words; each reads ``CONTEXT`` bytes of its neighbours first, in either
direction, so that the states at a stretch's own positions come from what stands before and after it.

Gates are piecewise linear and states soft-signed, x / (1 + |x|), which spares exponentials.  Training is
backpropagation through time in numpy, on the driver, over windows of at most ``SAMPLE`` whole documents
of each language that are not held out (those with the smallest hashes of their ids); prediction runs
over every document in Spark.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textscan as ts

#: Documents of each language that are learned from.
SAMPLE = 400
#: Pieces of a text that the driver learns from, and their bytes.
PIECES, PIECE = 128, 256
STRETCH, CONTEXT = 224, 16
HIDDEN = 12
STEPS = 300
BATCH, WINDOW = 160, 64
#: Stretches that are read at once.
AT_ONCE = 1024
SEED = 7
UNKNOWN = "und"


class BiGru:
    """Two gated recurrent layers, one for each direction, and a softmax over both at each position."""

    def __init__(self, n_labels: int, hidden: int = HIDDEN, seed: int = SEED):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.hidden = hidden
        init = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        self.p = {}
        for d in "fb":
            self.p |= {f"x{d}": init(256, 3 * hidden, scale=0.3), f"u{d}": init(hidden, 2 * hidden, scale=hidden**-0.5), f"c{d}": init(hidden, hidden, scale=hidden**-0.5)}
        self.p |= {"o": init(2 * hidden, n_labels, scale=0.3), "ob": np.zeros(n_labels, np.float32)}

    def _run(self, codes: np.ndarray, d: str, keep: bool = False) -> tuple[np.ndarray, list]:
        """States after each position; ``codes`` is positions by stretches."""
        n, h = self.hidden, np.zeros((codes.shape[1], self.hidden), self.p["o"].dtype)
        states, cache = np.empty((*codes.shape, n), h.dtype), []
        x, u, c = self.p[f"x{d}"], self.p[f"u{d}"], self.p[f"c{d}"]
        for k in range(len(codes)) if d == "f" else range(len(codes) - 1, -1, -1):
            row = codes[k]
            a = x[row]
            zr = h @ u
            zr += a[:, : 2 * n]
            zr *= 0.25
            zr += 0.5
            np.clip(zr, 0, 1, out=zr)
            z, r = zr[:, :n], zr[:, n:]
            g = (r * h) @ c
            g += a[:, 2 * n :]
            g /= 1 + np.abs(g)
            if keep:
                cache.append((k, h, z, r, g))
            h = h + z * (g - h)
            states[k] = h
        return states, cache

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Positions by stretches by labels."""
        n = self.hidden
        out = self._run(codes, "f")[0] @ self.p["o"][:n]
        out += self._run(codes, "b")[0] @ self.p["o"][n:]
        out += self.p["ob"]
        out -= out.max(axis=2, keepdims=True)
        np.exp(out, out=out)
        out /= out.sum(axis=2, keepdims=True)
        return out

    def gradients(self, codes: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss over all positions, and its gradients by backpropagation through time."""
        n, t = self.hidden, len(codes)
        (f, cf), (b, cb) = self._run(codes, "f", True), self._run(codes, "b", True)
        both = np.concatenate([f, b], axis=2)
        logit = both @ self.p["o"] + self.p["ob"]
        p = np.exp(logit - logit.max(axis=2, keepdims=True))
        p /= p.sum(axis=2, keepdims=True)
        many = weight.sum() * t
        loss = -(np.log(p[:, np.arange(len(label)), label] + 1e-9) * weight).sum() / many
        d = p.copy()
        d[:, np.arange(len(label)), label] -= 1
        d *= (weight / many)[None, :, None]
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["o"] = np.tensordot(both, d, ([0, 1], [0, 1]))
        g["ob"] = d.sum(axis=(0, 1))
        back = d @ self.p["o"].T
        for way, cache, part in (("f", cf, back[:, :, :n]), ("b", cb, back[:, :, n:])):
            u, c = self.p[f"u{way}"], self.p[f"c{way}"]
            dh = np.zeros_like(cache[0][1])
            inputs = np.empty((t, codes.shape[1], 3 * n), dh.dtype)
            for k, h, z, r, q in reversed(cache):
                dh = dh + part[k]
                dq = dh * z * (1 - np.abs(q)) ** 2
                drh = dq @ c.T
                dz, dr = dh * (q - h), drh * h
                dzr = 0.25 * np.concatenate([dz * ((z > 0) & (z < 1)), dr * ((r > 0) & (r < 1))], axis=1)
                g[f"c{way}"] += (r * h).T @ dq
                g[f"u{way}"] += h.T @ dzr
                inputs[k, :, : 2 * n], inputs[k, :, 2 * n :] = dzr, dq
                dh = dh * (1 - z) + drh * r + dzr @ u.T
            np.add.at(g[f"x{way}"], codes, inputs)
        return float(loss), g

    def train(self, texts: list[np.ndarray], labels: np.ndarray, steps: int = STEPS, rate: float = 0.02) -> None:
        """Adam over windows of the texts' bytes; every language has its share of each batch, a text by its length."""
        rng = np.random.Generator(np.random.PCG64(SEED))
        size = np.array([len(x) for x in texts])
        start = np.cumsum(size + WINDOW) - size
        data = np.full(int((size + WINDOW).sum()) + WINDOW, 0x20, np.uint8)
        for at, x in zip(start, texts, strict=True):
            data[at : at + len(x)] = x
        of = [np.flatnonzero(labels == k) for k in range(labels.max() + 1)]
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        for step in range(1, steps + 1):
            label = rng.integers(0, len(of), BATCH)
            pick = np.empty(BATCH, np.int64)
            for k in np.unique(label):
                mine = label == k
                pick[mine] = rng.choice(of[k], int(mine.sum()), p=size[of[k]] / size[of[k]].sum())
            at = start[pick] + np.floor(rng.random(BATCH) * np.maximum(size[pick] - WINDOW // 2, 1)).astype(np.int64)
            codes = data[at[None, :] + np.arange(WINDOW)[:, None]]
            _, g = self.gradients(codes, label, np.ones(BATCH, np.float32))
            now = rate * (1 - 0.9 * step / steps)
            for k in self.p:
                m[k] += 0.1 * (g[k] - m[k])
                v[k] += 0.01 * (g[k] ** 2 - v[k])
                self.p[k] -= (now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text, ``PIECES`` pieces of ``PIECE`` bytes at most, spread evenly over all of it from a start that its id gives."""
    for b in batches:
        found, langs = [], []
        for id_, lang, text in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
            raw = text.encode()
            n = min(PIECES, -(-len(raw) // PIECE))
            spare = max(0, len(raw) - n * PIECE)
            shift = int(ts.mix(np.array([id_], np.int64).view(np.uint64))[0]) % (spare // max(n, 1) + 1)
            found += [raw[at : at + PIECE] for at in (k * PIECE + k * spare // max(n, 1) + shift for k in range(n))]
            langs += [lang] * n
        yield pa.record_batch({"piece": pa.array(found, pa.binary()), "lang": pa.array(langs, pa.string())})


def train_model(texts: list[tuple[str | bytes, str]]) -> tuple[BiGru, list[str]]:
    """A model of (text, language) pairs; blank texts teach nothing."""
    texts = [(t, lang) for t, lang in texts if t.strip()]
    languages = sorted({lang for _, lang in texts})
    model = BiGru(len(languages))
    if len(languages) > 1:
        model.train([np.frombuffer(t.encode() if isinstance(t, str) else t, np.uint8) for t, _ in texts], np.array([languages.index(lang) for _, lang in texts], np.int64))
    return model, languages


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([unicodedata.category(chr(k))[0] == "L" for k in range(0x110000)])


def letter_bytes(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text belong to letters."""
    if not len(data) or int(data.max()) < 128:
        return ((data | 32) >= 97) & ((data | 32) <= 122)
    head = (data & 0xC0) != 0x80
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    return _letters()[points][np.cumsum(head) - 1]


def label_sums(model: BiGru, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text of a chunk the label probabilities summed over its letters, and how many bytes its letters have."""
    size = np.diff(offsets)
    letter = letter_bytes(data)
    sums = np.zeros((len(size), model.p["ob"].shape[0]))
    many = ts.row_sums(letter.astype(np.int64), offsets)
    parts = np.where(many > 0, -(-size // STRETCH), 0)
    row = np.repeat(np.arange(len(size)), parts)
    begin = offsets[row] + (np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)) * STRETCH
    end = np.minimum(begin + STRETCH, offsets[row + 1])
    # Stretches of about the same length are read together.
    order = np.argsort(begin - end, kind="stable")
    padded = np.append(data, np.uint8(0x20))
    for at in range(0, len(order), AT_ONCE):
        pick = order[at : at + AT_ONCE]
        a, b, low, high = begin[pick], end[pick], offsets[row[pick]], offsets[row[pick] + 1]
        spot = a[None, :] + np.arange(-CONTEXT, int((b - a).max()) + CONTEXT)[:, None]
        inside = (spot >= low) & (spot < high)
        p = model.probabilities(padded[np.where(inside, spot, len(data))])
        own = (spot >= a) & (spot < b)
        own[own] = letter[spot[own]]
        np.add.at(sums, row[pick], np.einsum("tnk,tn->nk", p, own.astype(p.dtype)))
    return sums, many


def _predict(model, languages: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = model.value
        for c in ts.chunks(batches):
            data, offsets = ts.text_bytes(c.column("text"))
            if len(languages) > 1:
                sums, total = label_sums(net, data, offsets)
            else:
                total = ts.row_sums(letter_bytes(data).astype(np.int64), offsets)
                sums = total[:, None].astype(float)
            p = sums / np.maximum(total, 1)[:, None]
            best = p.argmax(axis=1)
            none = (total == 0) | (not languages)
            names = [UNKNOWN if skip else languages[k] for k, skip in zip(best, none, strict=True)]
            score = np.where(none, 0.0, np.clip(p[np.arange(len(p)), best], 0, 1))
            yield pa.record_batch({"doc_id": c.column("doc_id"), "held_out": c.column("held_out"), "lang_pred": pa.array(names, pa.string()), "score": score})

    return run


def identify_languages(docs: DataFrame, held_out: str = "crc32(CAST(doc_id AS STRING)) % 5 = 0") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for each row of ``docs`` (``doc_id, text, lang``).

    Learned from rows with an id, a ``lang`` and a text for which ``held_out``, an SQL condition
    on ``doc_id``, is not true: ``SAMPLE`` ids of each language, and pieces spread over the whole of each text, so that the driver
    gets ``SAMPLE * PIECES * PIECE`` bytes of a language at most (13 MB); other columns are not looked at.  Null texts and
    texts without a letter get ``und`` and a score of 0, and so does every text when there is nothing to
    learn from; of a single language every other text gets that one with a score of 1.  A null id counts as
    not held out.  Ties go to the language first in the alphabet.  Repeated rows are labelled alike and
    count once when learning (rows that repeat an id and
    language with other texts by the smallest); an empty table gives an empty result.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    slim = slim.withColumn("held_out", F.coalesce(F.expr(held_out), F.lit(False)))
    known = slim.where("lang is not null and text is not null and not held_out and doc_id is not null")
    # Every task keeps its first rows of each language before they meet.
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = known.select("doc_id", "lang").distinct().select("doc_id", "lang", rank.alias("rank")).where(F.col("rank") <= SAMPLE).select("doc_id", "lang")
    taught = known.join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    net, languages = train_model(sorted((bytes(r[0]), r[1]) for r in taught.mapInArrow(_pieces, "piece binary, lang string").collect()))
    model = spark.sparkContext.broadcast(net)
    return slim.select("doc_id", "held_out", "text").mapInArrow(_predict(model, languages), "doc_id long, held_out boolean, lang_pred string, score double")


def query(spark, sf_dir: str) -> DataFrame:
    """op9: the language of every document."""
    return identify_languages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
