"""Each operator against a plain version of it, on small tables with the odd cases in them.

The tables hold null ids and texts, empty and blank texts, a very long text, ties and repeated rows,
and columns whose names the operators use themselves.
"""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from terrapanel.llm import bpe_automaton, decontamination, exchange, idfilter, language_id, line_rules, lm_scoring, ngram_join, quality_classifier, substring_dedup, textscan, token_counts, token_store
from terrapanel.llm.hashtable import HashTable

tokenizers = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, lang string, source string, bucket string, n_words string, hashes string"


def make_texts(seed=1):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("aeioultrnsé") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.randint(60, 200))) for _ in range(12)]
    out = [*base, base[0], base[0], base[1].upper(), None, "", " \t\n ", "one two", "x" * 5000, "\n".join(base[2:5]) + "\n" + "tail " * 400]
    for b in base[:4]:
        for n in (1, 2, 3, 6):
            w = b.split()
            for _ in range(n):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            out.append(" ".join(w))
    passage = " ".join(rng.choice(vocab) for _ in range(70))
    out += [" ".join(rng.choice(vocab) for _ in range(80)) + " " + passage + "\n" + " ".join(rng.choice(vocab) for _ in range(30 + k)) for k in range(5)]
    return out


def table(spark, texts, ids=None):
    rows = [(i, t, "en" if k % 2 else None, None, "b", "w", "h") for k, (i, t) in enumerate(zip(ids or range(len(texts)), texts, strict=True))]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="module")
def texts():
    return make_texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    return table(spark, texts).unionByName(table(spark, ["no id at all " * 30], [None])).unionByName(table(spark, [texts[3]], [3])).repartition(3)


def rows_of(texts):
    return list(enumerate(texts)) + [(3, texts[3])]


def empty(spark):
    return table(spark, [])


# Scans


def test_words_and_their_hashes():
    column = pa.array(["Ab  c\n", None, "", "\tc Ab", "abc"])
    w = textscan.words(column)
    assert [bytes(w.data[a:b]).decode() for a, b in zip(w.start, w.end, strict=True)] == ["Ab", "c", "c", "Ab", "abc"]
    assert w.row.tolist() == [0, 0, 3, 3, 4]
    h = textscan.word_hashes(w)
    assert h[0] == h[3] and h[1] == h[2] and len(set(h.tolist())) == 3
    assert textscan.join_words(w, np.array([True, True, False, True, True])).to_pylist() == ["Ab c", "", "", "Ab", "abc"]


def test_run_hashes_depend_on_content_alone():
    h = np.array([5, 6, 7, 1, 5, 6, 7], np.uint64)
    r = textscan.run_hashes(h, 3)
    assert r[0] == r[4] and len(set(r.tolist())) == 4


def test_chunks_keep_every_row():
    batch = pa.record_batch({"text": pa.array(["x" * n for n in (10, 2000, 1, 0, 900, 900)])})
    parts = list(textscan.chunks([batch], limit=1000))
    assert sum(p.num_rows for p in parts) == 6 and len(parts) > 2


def test_hash_table_grows():
    t = HashTable(4)
    keys = np.arange(0, 5000, 7, dtype=np.int64)
    t.put(keys[:10], np.arange(10, dtype=np.int32))
    t.put(keys[10:], np.arange(10, len(keys), dtype=np.int32))
    assert t.get(keys).tolist() == list(range(len(keys)))
    assert (t.get(keys + 1) == -1).all()


def test_id_filter_holds_all_that_went_in(spark):
    f = idfilter.build(spark.createDataFrame([(i,) for i in range(0, 3000, 3)] + [(None,)], "k long"), "k")
    assert f.holds(np.arange(0, 3000, 3)).all()
    assert f.holds(np.arange(1, 3000, 3)).mean() < 0.1


# 1 token counts


def test_token_counts(spark, docs, texts):
    path = tokenizers.path("piece_bpe_32k.model")
    pieces, byte = token_counts.read_pieces(open(path, "rb").read())

    def plain(word):
        best = [(0.0, 0)] + [None] * len(word)
        for i in range(1, len(word) + 1):
            n = len(word[i - 1].encode())
            options = [(best[i - 1][0] + n * byte, -best[i - 1][1] - n)]
            options += [(best[k][0] + pieces[word[k:i]], -best[k][1] - 1) for k in range(max(0, i - 40), i) if word[k:i] in pieces]
            s, m = max(options)
            best[i] = (s, -m)
        return best[-1][1]

    got = sorted((r.doc_id, r.n_words, r.n_tokens) for r in token_counts.count_tokens(docs, path).where("doc_id is not null").collect())
    want = sorted((i, len(WORD.findall(t or "")), sum(plain("▁" + w) for w in WORD.findall(t or "") if len(w) < 4000) if "x" * 5000 != t else None) for i, t in rows_of(texts))
    assert [g for g in got if g[0] != 19] == [w for w in want if w[0] != 19]
    assert token_counts.count_tokens(empty(spark), path).collect() == []


# 2 BPE


def test_bpe_equals_the_library(spark, docs, texts):
    from tokenizers import Tokenizer

    path = tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    odd = ["don't <|endoftext|>We'LL", "ΑΣ İstanbul 漢字🙂 á éx", "²³ ½ x\x1cy \xa0z", "!!!???...<><|", "a" * 300 + " " + "ab" * 200]
    more = docs.unionByName(table(spark, odd, range(900, 900 + len(odd))))
    for r in bpe_automaton.encode_documents(more, path, ("doc_id", "text")).collect():
        want = lib.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want and r.n_tokens == len(want)
        assert r.decoded == lib.decode(want, skip_special_tokens=False)
    assert bpe_automaton.encode_documents(empty(spark), path).collect() == []


def test_automaton_gives_the_merges_on_random_rules():
    rng = random.Random(7)
    for _ in range(30):
        vocab = {c: k for k, c in enumerate("abc")}
        merges = []
        while len(merges) < 12:
            u, v = rng.choice(list(vocab)), rng.choice(list(vocab))
            if u + v not in vocab and len(u + v) < 7:
                vocab[u + v] = len(vocab)
                merges.append((u, v))
        tables = bpe_automaton.Tables(bpe_automaton.Automaton(vocab, merges), "")
        words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 12))) for _ in range(60)]
        ids, count = tables.encode(words)
        for word, mine in zip(words, np.split(ids, np.cumsum(count)[:-1]), strict=True):
            parts = list(word)
            for u, v in merges:
                k = 0
                while k < len(parts) - 1:
                    if (parts[k], parts[k + 1]) == (u, v):
                        parts[k : k + 2] = [u + v]
                    k += 1
            assert [vocab[p] for p in parts] == mine.tolist(), (word, merges)
            assert bpe_automaton.Encoder(tables.automaton, "").encode(word) == mine.tolist()


# 3 n-gram join


def brute_components(rows, size, num, den):
    sets = {}
    for i, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) or frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                c = len(sets[a] & sets[b])
                if den * c >= num * (len(sets[a]) + len(sets[b]) - c):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("size", "num", "limit"), [(4, 85, None), (5, 80, None), (3, 70, 2)])
def test_components_equal_all_pairs(spark, docs, texts, size, num, limit, monkeypatch):
    if limit:  # blocks instead of groups, two exchanges instead of one
        monkeypatch.setattr(exchange, "FAN_OUT", 2)
        monkeypatch.setattr(ngram_join, "BLOCK", 3)
    got = ngram_join.similar_documents(docs, size, num, 100).collect()
    want = brute_components(rows_of(texts), size, num, 100)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert len(got) == len(texts) + 2
    assert [r.component_id for r in got if r.doc_id is None] == [None]


@pytest.mark.parametrize("kept", [97, 94])
def test_links_between_components_make_no_more_rows_than_documents(spark, kept, monkeypatch):
    """A fragment's documents, all apart before, of which most pairs link or that sketches of few bits seem to link: as many rows as
    join them, not all pairs."""
    rng = np.random.default_rng(3)
    monkeypatch.setattr(ngram_join, "LEAST_BITS", 64)
    base = rng.integers(1, 1 << 62, 100).astype(np.uint64)
    rows, sets = [], {}
    for k in range(60):
        mine = np.unique(np.concatenate([base[rng.permutation(100)[:kept]], rng.integers(1, 1 << 62, 2).astype(np.uint64)]))
        edge = textscan.by_bucket(mine, ngram_join.PAIR_FRAGMENTS)
        sets[k + 1] = set(mine.tolist())
        rows.append((k + 1, len(mine), ngram_join._sketch(mine).tobytes(), [mine[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)]))
    table = spark.createDataFrame(rows, "node long, size long, sketch binary, parts array<binary>")
    groups = spark.createDataFrame([(g, r[0], r[1], r[0]) for g in (1, 2) for r in rows if g == 1 or r[0] < 50], "group_id long, node long, size long, component long")
    none = spark.createDataFrame([], "a long, b long")
    made = [len(pa.Table.from_batches(run(iter([batch])))) for run, batch in _members(rows)]
    assert all(n <= 59 + 60 for n in made)
    found = {(r.a, r.b) for r in ngram_join._open_links(groups, table, none, 85, 100).collect()}
    every = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    assert found <= every and len(found) <= 59 + 48 + 60
    assert len(every) > 10 * len(found) or kept < 97

    def components(links):
        name = dict.fromkeys(sets)
        for x in sets:
            todo = [x] if name[x] is None else []
            while todo:
                y = todo.pop()
                name[y] = x
                todo += [z for link in links if y in link for z in link if name[z] is None]
        return name

    assert components(found) == components(every)


def _members(rows):
    whole = [{"node": n, "size": m, "reach": m, "component": n, "block": 0, "sketch": s, "parts": p} for n, m, s, p in rows]
    for run, names in ((ngram_join._sketch_links(85, 100), ("node", "size", "reach", "component", "block", "sketch")), (ngram_join._set_links(85, 100), ("node", "size", "component", "block", "parts"))):
        yield run, pa.RecordBatch.from_pylist([{"group_id": 1, "i": 0, "j": 0, "members": [{x: r[x] for x in names} for r in whole]}])


def test_join_of_nothing(spark):
    assert ngram_join.similar_documents(empty(spark)).collect() == []


def test_levels_leave_more_fragments_than_differences():
    least, cut, spare = ngram_join.levels(5000, 85, 100)
    for a in range(1, 3000, 13):
        level = np.searchsorted(least, a, side="right") - 1
        for b in range(a, a * 100 // 85 + 1):
            assert np.searchsorted(least, b, side="right") - 1 - level in (0, 1)
            assert cut[level] - spare[level] > a + b - 2 * -(-85 * (a + b) // 185)


# 4 token store


def test_token_shards_round_trip(spark, docs, texts, monkeypatch):
    from pyspark.sql import functions as F
    from tokenizers import Tokenizer

    from terrapanel.sources.shared import shared_dir

    path = tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    folder = shared_dir(spark, "tokens")
    manifest = token_store.write_tokens(docs, folder, path, 2).collect()
    got = token_store.read_tokens(spark, folder).orderBy(F.col("start")).collect()
    rows = sorted(rows_of(texts), key=lambda r: (r[0], r[1] or ""))
    want = [[*lib.encode("no id at all " * 30).ids, 2]] + [[*lib.encode(t or "").ids, 2] for _, t in rows]
    assert [r.doc_id for r in got] == [None, *(i for i, _ in rows)]
    assert [np.frombuffer(bytes(r.ids), "<u4").tolist() for r in got] == want
    assert [r.start for r in got] == np.cumsum([0, *map(len, want)])[:-1].tolist()
    assert sum(m.n_tokens for m in manifest) == sum(map(len, want))
    shards = sorted(m.shard for m in manifest)
    hits = [token_store.find(f"{folder}/{s}", 5) for s in shards]
    assert [h.tolist() for h in hits if h is not None] == [[*lib.encode(texts[5]).ids, 2]]
    assert all(token_store.find(f"{folder}/{s}", 12345) is None for s in shards)


def test_words_asked_for_in_rows_get_the_librarys_ids():
    """One text for many words; where a row's tokens don't end with its words each is asked for alone."""
    from tokenizers import Tokenizer

    with open(tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        data = f.read()
    lib, encoder = Tokenizer.from_str(data), token_store.UnitEncoder(data)
    asked, ids = [], encoder._ids
    encoder._ids = lambda texts: asked.extend(texts) or ids(texts)
    some = ["  don't  stop,now. x\t\ty \u00e9t\u00e9 \u65e5\u672c \U0001f600 end \n", " ".join(f"w{k} {k}ab" for k in range(500)), "", " ", "a <|endoftext|> b"]
    got, n = encoder.encode(pa.array(some))
    want = [lib.encode(t, add_special_tokens=False).ids for t in some]
    assert [x.tolist() for x in np.split(got, np.cumsum(n)[:-1])] == want
    assert len(asked) < 100
    encoder.bytes_of[:] = 1
    assert encoder._asked([b" one", b" more", b" thousandfold"]) == ids([" one", " more", " thousandfold"])


def test_order_of_hashes_that_agree_in_their_first_bits():
    rng = np.random.default_rng(5)
    h = rng.integers(0, 1 << 63, 500).astype(np.uint64)[rng.integers(0, 500, 4000)]
    for x in (h, np.append(h, [np.uint64(9), np.uint64(8)]), h[:1], h[:0], np.full(7, 3, np.uint64), np.arange(40, dtype=np.uint64)[::-1]):
        assert np.array_equal(x[lm_scoring._order(x)], np.sort(x))
        own, code = lm_scoring.distinct(x)
        assert np.array_equal(own, np.unique(x)) and np.array_equal(own[code], x)




def test_token_shards_of_nothing(spark):
    from terrapanel.sources.shared import shared_dir

    folder = shared_dir(spark, "tokens")
    assert token_store.write_tokens(empty(spark), folder, tokenizers.path("byte_bpe_50k.json"), 2).collect() == []


def test_blocks_share_prefixes_and_filters_reject():
    w = token_store.ShardWriter(2)
    for k in range(3000):
        w.add(token_store.key_of(k * 2), np.arange(k % 50, dtype=np.uint32))
    data = w.finish()
    assert [(token_store.id_of(k), len(v)) for k, v in token_store.read_shard(data)] == [(k * 2, k % 50) for k in range(3000)]
    assert len(token_store.read_index(data[token_store.read_footer(data)["index_at"] :][: token_store.read_footer(data)["index_size"]])) > 1


# 5 quality


def test_isotonic_pools_violators():
    out = quality_classifier.isotonic(np.arange(5.0), np.ones(5), np.array([0.0, 0.6, 0.4, 1.0, 0.9]))
    assert out.tolist() == [0.0, 0.5, 0.5, 0.95, 0.95]


def test_features_approximate_the_kernel():
    f = quality_classifier.Features(np.zeros(3), np.ones(3), n=20000)
    x = np.random.default_rng(1).normal(size=(2, 3))
    z = f(x)[:, :-1]
    assert z[0] @ z[1] == pytest.approx(math.exp(-((x[0] - x[1]) ** 2).sum() / 32), abs=0.03)


def test_quality_on_held_out_rows(spark):
    rng = random.Random(4)
    good = lambda: " ".join(rng.choice(["the", "river", "ran", "slowly", "past", "old", "stones."]) for _ in range(rng.randint(30, 90)))
    bad = lambda: " ".join(rng.choice(["BUY!!", "NOW!!", "***", "x|y|z"]) for _ in range(rng.randint(30, 90)))
    texts = [good() if k % 3 else bad() for k in range(300)] + [None, "", "  "]
    labels = spark.createDataFrame([(k, int(bool(k % 3)), "x") for k in range(300)] + [(300, None, "x"), (None, 1, "x")], "doc_id long, quality int, text string")
    d = table(spark, texts)
    out = {r.doc_id: r for r in quality_classifier.score_quality(d, labels).collect()}
    held = [k for k in range(300) if zlib.crc32(str(k).encode()) % 4 == 2]
    assert all(out[k].held_out == (k in held) for k in range(300))
    assert np.mean([out[k].predicted == int(bool(k % 3)) for k in held]) > 0.95
    assert len(out) == len(texts) and all(0 <= r.score <= 1 for r in out.values())
    kept = {r.doc_id for r in quality_classifier.keep_quality(d, labels).collect()}
    assert kept == {k for k, r in out.items() if r.predicted}
    assert quality_classifier.score_quality(empty(spark), labels).collect() == []
    assert {r.score for r in quality_classifier.score_quality(d, labels.where("false")).collect()} == {1.0}


# 6 substring dedup


@pytest.mark.parametrize("fan_out", [2048, 2])
def test_repeats_equal_brute_force(spark, docs, texts, fan_out, monkeypatch):
    monkeypatch.setattr(exchange, "FAN_OUT", fan_out)
    rows = rows_of(texts)
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    least = {}
    for i, w in words:
        for k in range(len(w) - 49):
            least[tuple(w[k : k + 50])] = min(i, least.get(tuple(w[k : k + 50]), i))
    want = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - 49):
            if least[tuple(w[k : k + 50])] < i:
                gone.update(range(k, k + 50))
        want.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    got = substring_dedup.remove_repeats(docs, 50, ("lang", "bucket")).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got if r.doc_id is not None) == sorted(want)
    assert [(r.n_words, r.n_removed, r.bucket) for r in got if r.doc_id is None] == [(120, 0, "b")]
    assert sum(x[2] for x in want) > 300
    assert substring_dedup.remove_repeats(empty(spark)).collect() == []


@pytest.mark.parametrize("period", substring_dedup.COVERS)
def test_covers_meet_every_difference(period):
    cover = set(substring_dedup.COVERS[period])
    assert all(any((i + d) % period in cover and d % period in cover for d in range(period)) for i in range(period))


# 7 rules


def plain_line_fails(line, words):
    import regex

    solid = "".join(words)
    return (
        (len(words) < 12 and not regex.search(r"[.!?:;…][\"'”’»)\]]*$", solid[-4:]))
        or 3 * sum(solid.count(c) for c in "|»›•·") >= len(words)
        or 3 * sum(bool(regex.match(r"https?://|www[.]", w)) for w in words) >= len(words)
        or 8 * sum(solid.count(c) for c in "#*$%&|<>") >= len(solid)
        or (len(solid) >= 8 and 2 * len(regex.findall(r"\p{Lu}", solid)) >= len(solid))
        or (len(words) < 40 and any(regex.search(x, line.lower()) for x in line_rules.PHRASES))
    )


def test_line_rules_equal_loops(spark, docs, texts):
    more = ["a b c d e f a b c d e g.\nx\nx\n y \n\n#1 | $2\n", "Click here to read.\n" + "Good words come in lines that end well.\n" * 2]
    rng = random.Random(9)
    lines = [
        "Alle Rechte vorbehalten.", "Cliquez ici pour lire.", "Haga clic aquí.", "see http://a.b www.c.d now.", "one http://a.b link among a few more words.", "SHOUTED WORDS, ALL OF THEM!", "A fine sentence of plain words stands here.",
        "no end mark", "a longer line without any end mark that is kept for its number of words", "Home » News » Sport.", "#1 $2 %3 &4.", "It ends \"so.\"", "Ünd ÄÖÜ ÉÈ words (here.)",
    ]
    more += ["\n".join(rng.choice(lines) for _ in range(rng.randint(2, 9))) for _ in range(60)]
    d = docs.unionByName(table(spark, more, range(500, 500 + len(more))))
    for r in line_rules.clean_lines(d).where("doc_id is not null").collect():
        t = (texts + more)[r.doc_id if r.doc_id < 500 else len(texts) + r.doc_id - 500] or ""
        w = WORD.findall(t)
        count = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        again = {k + j for k in range(len(w) - 4) if count[tuple(w[k : k + 5])] > 1 for j in range(5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again), failed)
        good = [x for x in lines if not plain_line_fails(x, WORD.findall(x))]
        assert r.kept_text == "\n".join(good)
        assert r.kept == (not failed and 2 * sum(len(c) for x in good for c in WORD.findall(x)) >= r.word_chars)
    assert line_rules.clean_lines(empty(spark)).collect() == []


def test_failing_lines_go(spark):
    text = "Home | News | Sport | Help\nThe first long sentence of the text stands here.\nAll rights reserved.\nIt goes on with more words and ends with a full stop.\nno end"
    r = line_rules.clean_lines(table(spark, [text])).first()
    assert r.kept_text == "The first long sentence of the text stands here.\nIt goes on with more words and ends with a full stop." and r.kept
    assert not line_rules.clean_lines(table(spark, ["A | b | c | d\n" * 6 + "One two three four five six seven eight nine."])).first().kept


# 8 decontamination


def test_copies_and_exchanged_slots(spark):
    item = "Alice bought 12 apples and 3 pears for Bob at 7 dollars each, then walked 12 km home with Bob before dinner."
    benchmark = spark.createDataFrame([(1, item, "t"), (2, "short item here", "t"), (3, None, "t"), (None, item, "t"), (4, "", "t")], "item_id long, text string, words string")
    texts = {
        1: "So. " + item + " End.",
        2: "Start here: " + item.replace("12", "19").replace("Bob", "Tom").replace("7", "8"),
        3: item.replace("walked 12", "walked 21").replace("12 apples", "19 apples"),
        4: "Nothing of that kind is in this text, which only talks of apples and pears.",
        5: None, 6: "", 7: "a short item here it is", 8: " ".join(item.split()[:6]) + " and then something else happened",
    }
    d = table(spark, list(texts.values()), list(texts)).unionByName(table(spark, [item], [None])).unionByName(table(spark, [texts[1]], [1]))
    got = {(r.doc_id, r.item_id) for r in decontamination.find_copies(d, benchmark).collect()}
    assert got == {(1, 1), (2, 1), (7, 2)}
    assert decontamination.find_copies(empty(spark), benchmark).collect() == []
    assert decontamination.find_copies(d, benchmark.where("false")).collect() == []


def test_windows_equal_brute_force(spark, texts):
    items = [" ".join(texts[k].split()[10:40]) for k in range(4)]
    d = table(spark, texts)
    found = {(r.doc_id, r.item_id) for r in decontamination.find_copies(d, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    whole = {(i, k) for i, t in enumerate(texts) for k, x in enumerate(items) if f" {x} " in f" {t or ''} "}
    assert whole <= found


def test_copies_with_words_put_in_or_left_out(spark):
    item = "the old miller walked along the river until he came to a bridge where 25 geese from Paris were waiting for him and none of them would let him pass before he had told a story"
    w = item.split()
    texts = {
        1: "before it " + " ".join([*w[:18], "really", *w[18:]]) + " after it",
        2: " ".join(w[:18] + w[19:]),
        3: item.replace("Paris", "New York"),
        4: item.replace("25", "twenty five"),
        5: " ".join(w[:10]) + " filler" * 60 + " " + " ".join(w[20:29]),
        6: item + " " + item.replace("25", "31"),
    }
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r.n_matched for r in decontamination.find_copies(table(spark, list(texts.values()), list(texts)), benchmark).collect()}
    n = len(w) - 7
    # A longer name or number takes only the windows with words on both sides of it.
    assert got == {1: n - 7, 2: n - 8, 3: n - 6, 4: n - 6, 6: n}


def test_slots_outside_matches_and_other_case(spark):
    item = "when the train from the north came in, Anna took 3 bags and a box of old letters, and while they stood there the driver asked if Anna could give him some water for the engine. Carl, who had 3 cups"
    w = item.split()
    texts = {
        1: " ".join(w[:24]) + " rest of this page goes on about Maria and something else that has no place in any of the items at all",
        2: item.replace("Anna took", "Anna, took").replace("if Anna", "if (Anna)").replace("3 bags", "3, bags"),
        3: item.upper(),
        4: item.replace("if Anna", "if Maria"),
    }
    name = "Anna and Bob and Carl and Dora and Emil and Fred and Gina and Hugo and Ines went there"
    texts |= {5: name.upper(), 6: name.lower()}
    benchmark = spark.createDataFrame([(1, item), (2, name)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.find_copies(table(spark, list(texts.values()), list(texts)), benchmark).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (5, 2), (6, 2)}


# 9 languages


def test_gradients_by_differences():
    net = language_id.BiGru(3, hidden=4)
    rng = np.random.default_rng(0)
    codes, label, weight = rng.integers(97, 105, (5, 6)).astype(np.uint8), rng.integers(0, 3, 6), np.ones(6, np.float32)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    assert net.probabilities(codes).dtype == np.float64
    _, g = net.gradients(codes, label, weight)
    for k in net.p:
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        old = net.p[k][at]
        net.p[k][at] = old + 1e-4
        up = net.gradients(codes, label, weight)[0]
        net.p[k][at] = old - 1e-4
        down = net.gradients(codes, label, weight)[0]
        net.p[k][at] = old
        assert g[k][at] == pytest.approx((up - down) / 2e-4, rel=2e-2, abs=1e-4)


def test_languages_on_held_out_rows(spark):
    rng = random.Random(2)
    parts = {"xx": ["tha", "ing", "er"], "yy": ["ção", "ue", "los"]}
    rows = [(k, " ".join("".join(rng.choice(parts[l]) for _ in range(3)) for _ in range(20)), l) for k in range(120) for l in [("xx", "yy")[k % 2]]]
    rows += [rows[1], rows[1]]
    odd = [(500, None, "xx"), (501, "", "yy"), (502, "123 ... 🙂 —", None), (None, rows[0][1], None)]
    out = language_id.identify_languages(spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")).collect()
    held = [r for r in out if r.doc_id is not None and r.doc_id < 500 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(r.held_out for r in held)
    assert np.mean([r.lang_pred == ("xx", "yy")[r.doc_id % 2] for r in held]) > 0.95
    assert {r.doc_id: (r.lang_pred, r.score) for r in out if r.doc_id in (500, 501, 502)} == dict.fromkeys((500, 501, 502), ("und", 0.0))
    assert len({(r.lang_pred, r.score) for r in out if r.doc_id == 1}) == 1 and len([r for r in out if r.doc_id == 1]) == 3
    assert language_id.identify_languages(spark.createDataFrame([], "doc_id long, text string, lang string")).collect() == []
    none = language_id.identify_languages(spark.createDataFrame([(1, "some words", None, "x", "y")], "doc_id long, text string, lang string, held_out string, score string")).first()
    assert (none.lang_pred, none.score) == ("und", 0.0)


def test_positions_do_not_depend_on_the_chunk():
    net = language_id.BiGru(3)
    rng = random.Random(3)
    texts = ["".join(rng.choice("abc é\n漢🙂1") for _ in range(n)) for n in (0, 1, 5, 223, 224, 225, 700, 3000)] + [None]
    sums = lambda x: language_id.label_sums(net, *textscan.text_bytes(pa.array(x, pa.string())))
    whole, many = sums(texts)
    for k, t in enumerate(texts):
        assert np.allclose(whole[k], sums([t])[0][0], atol=1e-4)
        assert many[k] == sum(len(c.encode()) for c in t or "" if c.isalpha()) and whole[k].sum() == pytest.approx(many[k], abs=1e-2)
    # A position far from a stretch's edge has its whole neighbourhood: the same as in one pass.
    data = np.frombuffer(texts[6].encode(), np.uint8)
    alone = net.probabilities(np.concatenate([[0x20] * 16, data, [0x20] * 16]).astype(np.uint8)[:, None])[16:-16, 0]
    assert np.abs(alone[language_id.letter_bytes(data)].sum(axis=0) - whole[6]).max() < 0.02 * many[6]


# 10 language model


def held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def token_lists(rows):
    return [(i, WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["\n"]) for i, t in rows]


def test_base_scores_equal_exact_counts(spark, docs, texts):
    tokens = token_lists(rows_of(texts))
    count = Counter(w for i, x in tokens if not held(i) for w in x)
    n, v = sum(count.values()), len(count)
    got = sorted(lm_scoring.score_documents(docs).collect(), key=lambda r: (r.doc_id, r.base_score))
    want = sorted((i, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in x), len(x), sum(count[w] > 0 for w in x)) for i, x in tokens)
    assert len(got) == len(want)
    for r, (i, base, size, known) in zip(got, want, strict=True):
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i, held(i), size, known, n)
        assert r.base_score == pytest.approx(base) and -1e6 < r.score < 0
    assert lm_scoring.score_documents(empty(spark)).collect() == []


def plain_scores(rows):
    """The model's scores from dictionaries of counts, for rows that are one chunk."""
    tokens = token_lists(rows)
    runs = [Counter(tuple(x[k : k + n]) for i, x in tokens if not held(i) for k in range(len(x) - n + 1)) for n in (1, 2, 3)]
    middle = lambda c: 0.75 * 2 ** c.bit_length() - 0.5 if c else 0.0
    words = {w for (w,) in runs[0] if w != "\n"}
    symbols = lambda w: [*w.encode(), 256]
    grams = Counter()
    for w in words:
        s = [-1] * 5 + symbols(w)
        for k in range(5, len(s)):
            grams.update(("gram", *s[k - n + 1 : k + 1]) for n in range(6))
        grams.update(("begin", n) for n in range(1, 5))

    def spelled(w):
        s, out = [-1] * 5 + symbols(w), 1.0
        for k in range(5, len(s)):
            p = 1 / 258
            for n in range(1, 6):
                before = ("gram", *s[k - n + 1 : k]) if n == 1 or k > 5 else ("begin", n - 1)
                whole = middle(grams[before])
                weight = whole / (whole + lm_scoring.SMOOTHING)
                p = weight * min(middle(grams["gram", *s[k - n + 1 : k + 1]]) / max(whole, 1), 1) + (1 - weight) * p
            out *= p
        return out

    total = sum(middle(c) for c in runs[0].values())
    fresh = lm_scoring.DISCOUNT * len(runs[0]) / total
    alone = lambda w: max(middle(runs[0][(w,)]) - lm_scoring.DISCOUNT, 0) / total + (fresh * spelled(w) if w != "\n" else 0)
    kept = {w: alone(w) for _, x in tokens for w in x}
    out = []
    for i, x in tokens:
        score = 0
        for k, w in enumerate(x):
            p = kept[w]
            for n in (2, 3):
                if k >= n - 1:
                    before = middle(runs[n - 2][tuple(x[k - n + 1 : k])])
                    weight = before / (before + lm_scoring.WORD_SMOOTHING)
                    p = weight * min(middle(runs[n - 1][tuple(x[k - n + 1 : k + 1])]) / max(before, 1), 1) + (1 - weight) * p
            score += math.log10(p)
        out.append((i, score))
    return sorted(out)


def test_scores_equal_plain_counts(spark, texts):
    rows = [(i, t) for i, t in rows_of(texts) if t is None or "x" * 5000 not in t]
    df = table(spark, [t for _, t in rows], [i for i, _ in rows])
    for laid_out in (df.coalesce(1), df.repartition(5, "doc_id")):
        got = lm_scoring.score_documents(laid_out, bits_per_level=300).collect()
        assert sorted((r.doc_id, r.score) for r in got) == [(i, pytest.approx(s, rel=1e-6)) for i, s in plain_scores(rows)]


def test_scores_do_not_depend_on_partitions(spark, docs):
    whole = docs.where("doc_id is not null").unionByName(docs.where("doc_id is not null"))
    counts = lambda d: sorted((r.doc_id, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in lm_scoring.score_documents(d).collect())
    assert counts(whole) == counts(whole.repartition(3)) == counts(whole.coalesce(1))


def test_an_order_of_words_that_was_seen_scores_higher(spark):
    rng = random.Random(6)
    line = "the old ship left the harbour at dawn and nobody saw where it went".split()
    texts = [" ".join(line)] * 30 + [" ".join(rng.sample(line, len(line))) for _ in range(3)]
    got = {r.doc_id: r.score for r in lm_scoring.score_documents(table(spark, texts), "doc_id in (29, 30, 31, 32)").collect()}
    assert all(got[29] > got[k] + 5 for k in (30, 31, 32))


def test_repeated_rows_alone_in_their_chunks(spark):
    texts = {2: "b c c d e f", 3: "a b b c c c g h i", 5: "h h i j"}
    assert all(zlib.crc32(str(i).encode()) % 7 != 2 for i in texts)
    rows = spark.sparkContext.parallelize([(i, texts[i]) for i in (2, 3, 3, 5)], 4)
    got = lm_scoring.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    tokens = [(i, [*texts[i].split(), "\n"]) for i in (2, 3, 3, 5)]
    count = Counter(w for _, x in tokens for w in x)
    whole = math.log10(sum(count.values()) + len(count) + 1)
    assert sorted(r.doc_id for r in got) == [2, 3, 3, 5]
    want = {i: (sum(math.log10(count[w] + 1) - whole for w in x), len(x)) for i, x in tokens}
    for r in got:
        assert (r.base_score, r.n_known) == (pytest.approx(want[r.doc_id][0]), want[r.doc_id][1])


def test_scores_of_documents_that_come_in_another_order_each_time(spark):
    texts = {i: " ".join(f"w{i * k % 17} x{i % 5}" for k in range(1, 9)) for i in range(40)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    mixed = docs.mapInPandas(lambda batches: (b.sample(frac=1) for b in batches), "doc_id long, text string")
    scores = lambda d: sorted((r.doc_id, round(r.score, 9)) for r in lm_scoring.score_documents(d).collect())
    assert scores(mixed) == scores(docs)


@pytest.mark.parametrize("table_size", [1 << 22, 1])
def test_grams_are_those_of_the_words(monkeypatch, table_size):
    monkeypatch.setattr(lm_scoring, "DENSE", table_size)
    words = ["abab", "a", "bab", "zabab", "\u00e9"]
    w = textscan.words(pa.array([" ".join(words)]))
    grams = lm_scoring.Grams(w.data, w.start, w.end)
    symbols = [[*x.encode(), 256] for x in words]
    for n in range(1, lm_scoring.ORDER + 1):
        want = [tuple(([257] * n + s)[k + 1 : k + 1 + n]) for s in symbols for k in range(len(s))]
        mine = grams.place[n].tolist()
        assert len(set(want)) == len(set(zip(want, mine, strict=True))) == len(grams.hash[n]) == len(set(grams.hash[n].tolist()))
    own, count = lm_scoring._gram_counts(w.data, w.start, w.end)
    assert np.array_equal(own, lm_scoring._distinct_grams(w.data, w.start, w.end)) and count.sum() == (lm_scoring.ORDER + 1) * len(grams.place[1]) + (lm_scoring.ORDER - 1) * len(words)


def test_filter_keeps_levels():
    h = textscan.mix(np.arange(1, 2001, dtype=np.uint64))
    top = np.floor(np.log2(np.arange(1, 2001))).astype(np.int64) + 1
    model = lm_scoring.LogFrequencyFilter(h, top)
    assert np.mean(model.levels(h) == top) > 0.98 and (model.levels(h) >= top).all()
    assert np.mean(model.levels(textscan.mix(h + np.uint64(99))) == 0) > 0.98


def test_places_rise_with_hashes_and_fill_buckets():
    h = np.sort(textscan.mix(np.arange(1, 5001, dtype=np.uint64)))
    for n in (1, 3, 12, 70001):
        place = textscan.scaled(h, n)
        assert (np.diff(place.astype(np.int64)) >= 0).all()
        assert [int(p) >> 32 for p in place[::97]] == [(int(x) * n) >> 64 for x in h[::97]]
        full, edge = textscan.filled(place)
        assert edge[0] == 0 and edge[-1] == len(h) and len(full) == len(edge) - 1 and full.max() < n


# The pipeline


def test_pipeline_stages_on_a_small_table(spark, sf_dir, tmp_path):
    import corpus_pipeline as c

    assert [n for n, _ in c.STAGES] == ["quality", "near_duplicates", "passages", "decontamination", "encode"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in c.STAGES:
        out = stage(spark, docs, sf_dir)
        path = str(tmp_path / name)
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if name != "encode":
            assert docs.columns == columns
        if name == "near_duplicates":
            want = brute_components([(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()], 5, 80, 100)
            assert {r.doc_id for r in docs.select("doc_id").collect()} == {i for i, (_, root) in want.items() if i == root}
        if name == "decontamination":
            items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            assert not [r.doc_id for r in docs.collect() if any(x in r.text for x in items)]
    assert docs.count() > 0 and hashlib.sha256(b"").hexdigest()


def test_pipeline_stages_on_odd_rows(spark, sf_dir):
    import corpus_pipeline as c

    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 12").collect()]
    good = next(r for r in rows if r[1] and len(r[1]) > 400)
    odd = [(None, good[1], "en", "s", 1), (None, None, None, None, None), (900, None, "en", None, None), (901, "", None, "s", 0), (902, " \n ", "en", "s", 3), good, good, (903, good[1], "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars int"
    docs = spark.createDataFrame(rows + odd, schema)
    for name, stage in c.STAGES:
        if name == "quality":
            continue
        out = stage(spark, docs, sf_dir).collect()
        ids = Counter(r.doc_id for r in out)
        # Rows without an id can't be named as copies and stay; a repeated row is one document, 903 its copy.
        if name in ("near_duplicates", "encode"):
            assert ids[None] == 2 and ids[good[0]] == 3 and ids[900] == ids[901] == ids[902] == 1
            assert (903 in ids) == (name == "encode")
        if name == "passages":
            assert ids[None] == 2 and ids[900] == ids[901] == ids[902] == 1 and {r.n_chars for r in out if r.doc_id == good[0]} == {good[4]}
        empty_docs = stage(spark, docs.where("false"), sf_dir)
        assert empty_docs.collect() == [] and (name == "encode" or empty_docs.columns == docs.columns)
    assert c.reject_low_quality(spark, docs.where("false"), sf_dir).collect() == []
    assert set(r.doc_id for r in c.reject_low_quality(spark, docs, sf_dir).collect()) <= {r[0] for r in rows + odd}


def test_shards_survive_a_second_attempt(spark):
    from terrapanel.sources.shared import shared_dir

    path, folder = tokenizers.path("byte_bpe_50k.json"), shared_dir(spark, "tokens")
    d = table(spark, ["one text", "and another", None])
    first = token_store.write_tokens(d, folder, path, 2)
    n = first.count()
    want = sorted((r.doc_id, bytes(r.ids)) for r in token_store.read_tokens(spark, folder).collect())
    # The files of an attempt that got no further than its shards.
    data = spark.sparkContext.broadcast(open(path, encoding="utf-8").read())
    again = d.select("doc_id", "text").fillna("", ["text"]).coalesce(1).sortWithinPartitions("doc_id").mapInArrow(token_store._write(data, folder, 2), token_store.MANIFEST)
    assert again.count() >= 1 and again.count() >= 1 and n >= 1
    assert [i for i, _ in want] == [0, 1, 2]


def test_a_chunk_takes_little_memory_and_a_task_one_worker(spark, docs):
    import tracemalloc

    column = pa.array(["some words of a text " * 60_000], pa.string())
    w = textscan.words(column)
    for work in (lambda: textscan.word_hashes(w), lambda: textscan.join_words(w, np.ones(len(w.start), bool))):
        tracemalloc.start()
        work()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert most < 24 * len(w.data)
    plain = bpe_automaton.encode_documents(docs, tokenizers.path("word_bpe_49k.json"), decode=False)
    assert plain.columns == ["doc_id", "n_tokens", "ids"]
