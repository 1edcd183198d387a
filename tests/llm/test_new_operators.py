"""Operators 11 to 13 against brute force, with nulls, empty and repeated rows, ties, empty tables and clashing column names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from prefdata.llm import search, toxicity, trie


def brute_ranking(docs, items, top):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
    words = [(d, cut(t)) for d, t in docs]
    some = [(d, Counter(w), len(w)) for d, w in words if w]
    n, total, df = len(some), sum(x[2] for x in some), Counter(t for _, c, _ in some for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c, size in some:
            m = 50 + (50 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(cut(text)) if t in c)
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(found)[:top])]
    return out


def corpus(seed=5):
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    rows = [(i, " ".join(rng.choices(vocab, weights, k=rng.randint(1, 200)))) for i in range(300)]
    rows += [(400 + i, rows[7][1]) for i in range(90)] + [(500, None), (501, ""), (502, " .,;"), (7, rows[7][1]), (None, rows[7][1]), (None, "w3 w3 É"), (503, "W3-w3;É é")]
    rows.append((504, "w1 w2 w390 " * 30_000))
    items = [(i, " ".join(rng.choices(vocab, k=12))) for i in range(25)] + [(100, rows[7][1]), (101, ""), (102, None), (103, "nothing here"), (104, "É w399. W3"), (105, "w1")]
    return rows, items


@pytest.mark.parametrize("block_terms, rows_of_block", [(20_000, 2048), (60, 8)])
def test_ranking_equals_brute_force(spark, monkeypatch, block_terms, rows_of_block):
    monkeypatch.setattr(search, "ITEM_TERMS", block_terms)
    monkeypatch.setattr(search, "ROWS", rows_of_block)
    rows, items = corpus()
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, text_key string, rank int").repartition(5)
    bench = spark.createDataFrame([(i, t, 1.0) for i, t in items], "item_id long, text string, score double")
    got = [tuple(r) for r in search.ranked(docs, bench).select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(got, key=str) == sorted(brute_ranking(rows, items, search.TOP), key=str)


def test_bounds_are_never_below_the_score():
    rng = random.Random(1)
    rows = [Counter({b"t%d" % rng.randrange(60): rng.choice([1, 2, 3, 5, 7, 50, 5000]) for _ in range(rng.randint(1, 30))}) for _ in range(50)]
    df = Counter(t for c in rows for t in c)
    q = search.Queries([{b"t%d" % rng.randrange(60) for _ in range(8)} for _ in range(12)], df, 50, sum(sum(c.values()) for c in rows))
    keys = []
    for c in rows:
        reach = [(search.xxhash.xxh3_64_intdigest(t), lv) for t, n in c.items() for lv in range(np.searchsorted(search.LEVELS, n, side="right"))]
        keys.append((np.array([h for h, _ in reach], np.uint64), np.array([lv for _, lv in reach])))
    bits = np.frombuffer(search.sliced(keys, 2048), np.uint8).reshape(2048, -1)
    lengths = np.array([sum(c.values()) for c in rows])
    bound = q.bounds(lengths, bits)
    exact = np.array([[q.score(i, c, sum(c.values())) for c in rows] for i in range(12)])
    assert (bound >= exact).all() and (bound == exact).mean() > 0.3


def test_ranking_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert [tuple(r) for r in search.ranked(docs, items).select("item_id", "rank", "doc_id").collect()] == [(1, 1, 1)]
    assert search.ranked(docs.limit(0), items).count() == 0 and search.ranked(docs, items.limit(0)).count() == 0


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own[c].append((role or "", text or ""))
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        full[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    out = []
    for k, who in members.items():
        under = [x for x in members if x[: len(k)] == k]
        ends = ",".join(str(c) for c in sorted(c for c in who if len(full[c]) == len(k)))
        out.append((min(who), len(k), min(members[k[:-1]]) if k else None, len(who), len(kids[k]), sum(not kids[x] for x in under),
                    sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in under if x), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def talks(seed):
    rng = random.Random(seed)
    rows = []
    for c in range(60):
        if c % 7 == 3:
            continue
        rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["hé", "b", "", None, "long text"])) for t in range(rng.randint(1, 12))]
    rows += [(70, None, "user", "first"), (70, None, "user", "also first"), (70, 1, "user", "x"), (70, 1, "user", "x"), (None, 1, "user", "lost"), (-3, 0, "user", "neg")]
    return rows + [(200, t, "user", "turn %d" % (t % 3)) for t in range(300)] + [(c, 0, "user", "same") for c in range(300, 420)]


@pytest.mark.parametrize("last, piece", [(16_384, 8192), (10, 3)])
def test_trie_equals_brute_force(spark, monkeypatch, last, piece):
    monkeypatch.setattr(trie, "PIECE", piece)
    monkeypatch.setattr(trie.list_sums, "__defaults__", (last,))
    rows = talks(3)
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "conv_id long, turn long, role string, text string, key string, depth long").repartition(6)
    got = sorted((tuple(r) for r in trie.prefix_trie(df).collect()), key=str)
    names = trie.prefix_trie(df.limit(0)).columns
    assert names == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert got == sorted(brute_trie(rows), key=str)


def test_trie_of_little(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert trie.prefix_trie(spark.createDataFrame([], schema)).count() == 0
    one = [tuple(r) for r in trie.prefix_trie(spark.createDataFrame([(5, 0, None, None)], schema)).collect()]
    assert sorted(one, key=str) == sorted(brute_trie([(5, 0, None, None)]), key=str)


def numbers(net, texts, y):
    z = net.pooled(texts) @ net.dense + net.base
    return float((np.logaddexp(0, z) - y * z).mean())


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, toxicity.BUCKETS ** 2, n) for n in (1, 4, 9, 0, 30)]
    y = np.array([1.0, 0, 1, 0, 1])
    net = toxicity.Network(4)
    for name in ("table", "filters", "bias", "dense"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.base, net.bias = np.float64(0.3), 0.1 * rng.standard_normal(len(net.bias))  # away from the kink at 0
    (gf, gb, gd, g0), (rows, g_rows) = toxicity.gradients(net, texts, y)
    step = 1e-5

    def difference(array, at):
        old = array[at]
        array[at] = old + step
        up = numbers(net, texts, y)
        array[at] = old - step
        down = numbers(net, texts, y)
        array[at] = old
        return (up - down) / (2 * step)
    for grad, array, places in ((gf, net.filters, [(0, 0), (3, 20), (20, 30)]), (gb, net.bias, [0, 13, 35]), (gd, net.dense, [1, 17, 30])):
        for at in places:
            assert abs(difference(array, at) - grad[at]) < 1e-4
    for k in range(0, len(rows), 9):
        assert abs(difference(net.table, (rows[k], 2)) - g_rows[k][2]) < 1e-4


def test_pieces_score_like_the_whole_text(monkeypatch):
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 1 << 32, n) for n in (0, 1, 2, 3, 50, 1000)]
    net = toxicity.Network(1)
    whole = net.raw(texts)
    monkeypatch.setattr(toxicity, "SCORE_WORDS", 7)
    assert np.allclose(net.raw(texts), whole, atol=1e-5)


def toxic_corpus(n, seed=9):
    rng = random.Random(seed)
    plain = {"en": ["the", "house", "is", "green", "and", "tree"], "de": ["das", "haus", "ist", "baum", "und", "mond"]}
    bad = {"en": ["foul", "nasty"], "de": ["mies", "eklig"]}
    rows, labels = [], []
    for i in range(n):
        lang, toxic = rng.choice(["en", "de"]), rng.random() < 0.25
        words = [rng.choice(plain[lang]) + rng.choice(["", "s", "en"]) for _ in range(rng.randint(5, 60))]
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(bad[lang]))
        rows.append((i, " ".join(words), lang))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_on_rows_not_seen(spark):
    rows, labels = toxic_corpus(1500)
    truth = dict(labels)
    extra = [(9000, None, "en"), (9001, "", None), (None, "foul house", "xx"), (5, rows[5][1], "en"), (9002, "tree " * 90_000 + "nasty", "en")]
    docs = spark.createDataFrame([(*r, "k", 0.5) for r in rows + extra], "doc_id long, text string, lang string, cut string, score double").repartition(6)
    marks = spark.createDataFrame(labels + [(5, None), (None, 1), (7, truth[7]), (7, 0)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, marks)
    assert got.columns == ["doc_id", "held_out", "score", "predicted", "flagged"]
    out = [tuple(r) for r in got.collect()]
    assert len(out) == len(rows) + len(extra) and all(0 <= r[2] <= 1 and r[3] == int(r[2] >= 0.5) for r in out)
    assert all(r[1] == (r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0) for r in out)
    unseen = [r for r in out if r[1] and r[0] in truth]
    assert len(unseen) > 200 and sum(r[3] == truth[r[0]] for r in unseen) >= 0.95 * len(unseen)
    assert {r[3] for r in out if r[0] == 9002} == {1} and {r[3] for r in out if r[0] in (9000, 9001)} == {0}
    # The held-out labels, the language and the id change no score.
    other = marks.withColumn("toxic", toxicity.F.when(toxicity.held_out(toxicity.F.col("doc_id"), 5, 0), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    again = toxicity.toxicity(docs.withColumn("lang", toxicity.F.lit("zz")), other).collect()
    assert sorted((r[0] or -1, round(r[2], 6)) for r in again) == sorted((r[0] or -1, round(r[2], 6)) for r in out)


def test_toxicity_learns_from_every_labelled_row(spark):
    rows, labels = toxic_corpus(1500)
    rows = [(d, f"{t} only{d}", lang) for d, t, lang in rows]
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4), spark.createDataFrame(labels, "doc_id long, toxic int")
    net, cuts = toxicity.load(toxicity.train(docs, marks, rows=300))  # four shards
    crc = {d: zlib.crc32(str(d).encode()) for d, _, _ in rows}
    learned = [t for d, t, _ in rows if crc[d] % 5 and crc[d] % 8]
    assert len(learned) > 900
    for t in learned:
        assert np.abs(net.table[toxicity._rows(toxicity.word_codes(t)).reshape(-1)]).sum(1).min() > 0
    assert "" in cuts
    unseen = [(toxicity.word_codes(t), truth) for (d, t, _), (_, truth) in zip(rows, labels) if crc[d] % 5 == 0]
    right = (net.score([t for t, _ in unseen]) >= 0.5) == np.array([y for _, y in unseen])
    assert len(unseen) > 200 and right.mean() >= 0.95
    z, y = np.array([-2.0, 1.0, 1.0, -2.0, 1.0]), np.array([0.0, 1, 1, 1, 0])
    assert toxicity.calibrate(z, y) == pytest.approx(toxicity.calibrate(np.array([-2.0, -2, 1, 1]), np.array([0.0, 1, 0, 1]), np.array([1.0, 1, 1, 2])))


def test_toxicity_deals_its_rows_to_shards_once(spark, monkeypatch):
    rows, labels = toxic_corpus(600)
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4), spark.createDataFrame(labels, "doc_id long, toxic int")
    dealt, read = toxicity._shards, []

    def spied(learned, shards):
        read.append((dealt(learned, shards), learned))
        return read[-1][0]
    monkeypatch.setattr(toxicity, "_shards", spied)
    toxicity.train(docs, marks, rows=200)  # three shards
    (held, learned), = read
    got = held.collect()
    assert len(got) == 3 and sorted((x["h"], x["t"], x["toxic"], bytes(x["codes"])) for r in got for x in r["rows"]) == sorted(
        (x["h"], x["t"], x["toxic"], bytes(x["codes"])) for x in learned.collect())
    assert len(held.inputFiles()) == 3 and "Exchange" not in held._jdf.queryExecution().toString()


def test_toxicity_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["score"] for r in toxicity.toxicity(docs, none).collect()] == [0.5, 0.5]
    assert toxicity.toxicity(docs.limit(0), none).count() == 0


def test_threshold_takes_equal_scores_together():
    assert toxicity.threshold(np.array([0.9, 0.9, 0.4, 0.1]), np.array([1.0, 0, 1, 0])) == pytest.approx(0.25)
    assert toxicity.threshold(np.array([0.9, 0.8, 0.1]), np.array([1.0, 1, 0])) == pytest.approx(0.45)
    a, b = toxicity.calibrate(np.array([-5.0, -4, 6, 7, -3, 5]), np.array([0.0, 0, 1, 1, 0, 1]))
    assert a > 0 and abs(b) < 5
