"""Part codes, phrases and exact copies against plain versions, with the odd cases in the tables."""

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terrapanel.llm import collocations, exact_dedup, hotkeys, registry, textscan, vector_codes

# Joins with hot keys


@pytest.mark.parametrize("heavy", [1, 4, 10**6])
def test_look_up_is_a_left_join(spark, monkeypatch, heavy):
    monkeypatch.setattr(hotkeys, "HEAVY", heavy)
    keys = ["a"] * 30 + ["b"] * 5 + [None] * 7 + list("cdef")
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k string")
    n = Counter(keys)
    answers = spark.createDataFrame([(k, v, str(k)) for k, v in n.items() if k != "e"], "k string, n long, said string")
    want = sorted((i, "" if k == "e" else str(k)) for i, k in enumerate(keys))
    assert sorted((r.i, r.said or "") for r in hotkeys.look_up(rows, answers, "k", len(keys), "n").collect()) == want
    assert sorted((r.i, r.said or "") for r in hotkeys.counted(rows, answers.drop("n"), "k").collect()) == want


# 11 vector codes


def plain_codes(rows, rounds=6):
    """Every part against every entry, in Python's whole numbers."""
    kept = [(i, label, [math.floor(4096 * x) for x in v]) for i, label, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    dim = len(kept[0][2]) // 8
    first = sorted((i, v) for i, _, v in kept)[:16]
    books = [[v[p * dim : (p + 1) * dim] for _, v in first] for p in range(8)]
    nearest = lambda x, b: min((sum((s - t) ** 2 for s, t in zip(x, e)), k) for k, e in enumerate(b))
    for _ in range(rounds):
        for p in range(8):
            of = [[] for _ in books[p]]
            for _, _, v in kept:
                x = v[p * dim : (p + 1) * dim]
                of[nearest(x, books[p])[1]].append(x)
            books[p] = [[sum(c) // len(xs) for c in zip(*xs)] if xs else e for xs, e in zip(of, books[p])]
    out = []
    for i, label, v in kept:
        near = [nearest(v[p * dim : (p + 1) * dim], books[p]) for p in range(8)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in near), sum(d for d, _ in near)))
    total = Counter()
    for _, label, _, e in out:
        total[label] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((i, c, e, total[label], digest) for i, label, c, e in out)


def coded(spark, rows, kind="float"):
    df = spark.createDataFrame([(i, label, v, "clash", "clash") for i, label, v in rows], f"vec_id long, label int, embedding array<{kind}>, ball string, code string")
    return df, sorted(tuple(r) for r in vector_codes.encode(df.repartition(3)).collect())


@pytest.mark.parametrize("seed", range(3))
def test_codes_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    grid = lambda: rng.choice([-2, -1, 0, 1, 2]) / 4096 * rng.choice([1, 1, 7, 900])  # noqa: E731  ties are common
    rows = [(i, rng.choice([None, 1, 2]), [grid() for _ in range(16)]) for i in range(150)]
    rows += [(200, 1, None), (201, 1, []), (202, 2, [0.1] * 15 + [None]), (203, 2, [0.1] * 15 + [float("nan")]), (204, None, [0.1] * 15 + [float("inf")]), (205, 3, [3.0e4] * 16)]
    _, got = coded(spark, rows)
    assert got == plain_codes(rows) and len({r[1] for r in got}) > 20


def test_balls_find_the_nearest(spark):
    rng = np.random.default_rng(2)
    for large in (False, True):
        entries = rng.integers(-30, 30, (16, 3)).astype(object if large else np.int64) * (10**12 if large else 1)
        entries[5] = entries[3]
        x = np.concatenate([rng.integers(-40, 40, (500, 3)).astype(entries.dtype) * (10**12 if large else 1), entries])
        best, least = vector_codes.Balls(entries).nearest(x, rng.integers(0, 16, len(x)))
        all_ = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        want = np.array([min(range(16), key=lambda k: (row[k], k)) for row in all_])
        assert best.tolist() == want.tolist() and least.tolist() == all_[np.arange(len(x)), want].tolist()


def test_codes_of_odd_tables(spark):
    assert coded(spark, [])[1] == [] and coded(spark, [(None, 1, [0.5] * 8)])[1] == []
    few = [(3, None, [0.5] * 8), (3, None, [0.5] * 8), (9, 1, [0.25] * 8), (None, 1, [0.25] * 8), (11, 1, [1.0] * 9)]
    got = sorted(((r.vec_id or -1), r.code, r.error) for r in vector_codes.encode(spark.createDataFrame(few, "vec_id long, label int, embedding array<double>")).collect())
    assert got == [(-1, "01" * 8, 0), (3, "00" * 8, 0), (3, "00" * 8, 0), (9, "01" * 8, 0)]
    huge = vector_codes.encode(spark.createDataFrame([(1, 1, [1e300] * 8), (2, 1, [-1e300] * 8), (3, 2, [0.0] * 8)], "vec_id long, label int, embedding array<double>")).collect()
    assert {(r.vec_id, r.code, r.error) for r in huge} == {(1, "00" * 8, 0), (2, "01" * 8, 0), (3, "02" * 8, 0)}
    assert vector_codes.spans(10, 8)[:3] == [(0, 2), (2, 4), (4, 5)]


# 12 phrases


def plain_phrases(rows, least, first, share=100):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 6):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i : i + m])] += 1
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    inside = Counter()
    for (lang, p), a in cand.items():
        for i in range(len(p)):
            for j in range(i + 2, len(p) + 1):
                if j - i < len(p):
                    inside[lang, p[i:j]] = max(inside[lang, p[i:j]], a)
    out = {}
    for (lang, p), a in cand.items():
        if 100 * inside[lang, p] >= share * a:
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, r, p.decode(), -a, x, y, n[lang], -s) for lang, v in out.items() for r, (s, a, p, x, y) in enumerate(sorted(v)[:first], 1))


def phrase_rows(seed=3):
    rng = random.Random(seed)
    vocab = [w for w in "der die das Ein the of und é x¹ aß q'r - 12".split()]
    passage = " ".join(rng.choice(vocab) for _ in range(40)) + ", " + " ".join(rng.choice(vocab) for _ in range(30)) + "\nlone. " + "ab " * 30
    rows = [(rng.choice(["de", "fr", None]), "".join(rng.choice(vocab) + rng.choice([" ", " ", " ", "\t", ", ", "!\n", ". ", "\r"]) for _ in range(rng.randrange(90)))) for _ in range(60)]
    rows += [("de", passage)] * 8 + [("und", passage), (None, None), ("fr", ""), ("fr", " . ,\n"), ("", "a b a b a b"), ("de", passage + " " + passage.upper())]
    return rows


@pytest.mark.parametrize("least,first,every", [(5, 2000, 24), (3, 7, 2), (8, 50, 1000)])
def test_phrases_equal_brute_force(spark, monkeypatch, least, first, every):
    monkeypatch.setattr(collocations, "EVERY", every)
    rows = phrase_rows()
    df = spark.createDataFrame([(t, lang, k, "x") for k, (lang, t) in enumerate(rows)], "text string, lang string, rank int, phrase string").repartition(4)
    got = sorted(tuple(r) for r in collocations.collocations(df, least=least, first=first).collect())
    assert got == plain_phrases(rows, least, first) and got


def test_phrases_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []
    assert collocations.collocations(spark.createDataFrame([(None, None), ("one", "en")], "text string, lang string"), least=1).collect() == []


def test_phrases_in_two_exchanges_and_other_shares(spark, monkeypatch):
    rows = phrase_rows(5)
    df = spark.createDataFrame([(t, lang) for lang, t in rows], "text string, lang string")
    monkeypatch.setattr(collocations, "FAN_OUT", 2)
    monkeypatch.setattr(collocations, "RANGE_BYTES", 1500)
    monkeypatch.setattr(collocations, "RANGE_PHRASES", 400)
    assert sorted(tuple(r) for r in collocations.collocations(df, least=6, share=80).collect()) == plain_phrases(rows, 6, 2000, 80)


def test_a_text_of_several_megabytes_is_parsed_whole(spark):
    text = "alpha beta gamma. " * 250_000
    got = collocations.collocations(spark.createDataFrame([(text, "en")], "text string, lang string"), first=5).collect()
    assert [(r.phrase, r.a, r.n) for r in got] == [("alpha beta gamma", 250_000, 750_000)]


def test_chunks_follow_from_content_alone():
    rng = random.Random(1)
    passage = " ".join(rng.choice(["ba", "ca", "da", "fa", "ga"]) + str(rng.randrange(9)) for _ in range(400))
    of = lambda text: {tuple(k) for k in collocations.Stream(pa.array(["en"]), pa.array([text])).chunks()[0].tolist()}
    one, two = of("zz yy " + passage), of(" ".join(f"w{k}" for k in range(57)) + " " + passage + " tail")
    assert len(one & two) >= len(one) - 3 > 5
    s = collocations.Stream(pa.array(["en"]), pa.array([passage]))
    assert (np.diff(s.start) > 0).all() and ((s.end[:-1] - s.start[1:]) == collocations.OVERLAP).all()
    h = np.arange(1, 9, dtype=np.uint64)
    assert textscan.span_hashes(h, np.array([1]), np.array([4]))[0] == textscan.span_hashes(h[1:], np.array([0]), np.array([3]))[0]


# 13 exact copies


@pytest.mark.parametrize("run_rows,largest", [(1 << 17, True), (4, True), (3, False)])
def test_copies_equal_brute_force(spark, monkeypatch, run_rows, largest):
    monkeypatch.setattr(exact_dedup, "RUN_ROWS", run_rows)
    rng = random.Random(4)
    texts = ["", None, " ", "a", "A", "a ", "x" * 100_000, "é", "é", "long " * 900_000]
    rows = [(i, rng.choice(texts[:9])) for i in rng.sample(range(-50, 400), 120)] + [(7, "a"), (7, "a"), (None, "a"), (None, "lone"), (None, "lone"), (1000, texts[9]), (1001, texts[9])]
    best = max if largest else min
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    want = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = best((x for x in ids if x is not None), default=None)
        want.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in rows], "doc_id long, text string, group_size int, digest string").repartition(5)
    assert sorted(map(str, (tuple(r) for r in exact_dedup.exact_duplicates(df, largest=largest).collect()))) == sorted(map(str, want))


def test_copies_of_nothing_and_of_normalised_texts(spark):
    assert exact_dedup.exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    df = spark.createDataFrame([(1, "A b"), (2, "a  B"), (3, None)], "doc_id int, text string")
    got = exact_dedup.exact_duplicates(df, normalise=lambda t: F.lower(F.regexp_replace(t, " +", " "))).collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got} == {(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True)}


def test_runs_tell_digests_apart_that_begin_alike():
    digests = np.array([[5, 1, 0, 0], [5, 2, 0, 0], [5, 1, 0, 0], [4, 9, 9, 9]], np.uint64)
    run = exact_dedup.Run(digests, np.array([3, 8, 6, 1]), np.ones(4, np.uint8), np.ones(4, np.int64))
    out = exact_dedup.merge([run, run], True)
    assert out.digests.tolist() == [[4, 9, 9, 9], [5, 1, 0, 0], [5, 2, 0, 0]] and out.ids.tolist() == [1, 6, 8] and out.counts.tolist() == [2, 4, 2]


# SQL


@pytest.mark.parametrize("name", ["op11_ball_codes", "op12_collocations", "op13_exact_dedup"])
def test_queries_give_the_rows_of_their_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df, rel = registry.queries()[name](spark, sf_dir), con.sql(registry.oracle_sql()[name])
    cols = sorted(df.columns)
    at = [rel.columns.index(c) for c in cols]
    mine = sorted(str(tuple(r[c] for c in cols)) for r in df.collect())
    assert cols == sorted(rel.columns) and mine == sorted(str(tuple(r[i] for i in at)) for r in rel.fetchall()) and mine
