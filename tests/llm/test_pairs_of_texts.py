"""Operators 2, 3 and 10 against brute force, with nulls, empty and repeated rows, and clashing column names."""

import random
import re

import numpy as np
import pytest
import xxhash

from prefdata.llm import decontam, hamming, lines, simhash
from prefdata.llm.components import connected_components

SCHEMA = "doc_id long, text string, key string, fp string, root string, h string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(d, t, "x", "y", "z", "w") for d, t in rows], schema).repartition(5)


def corpus(seed=7):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(5, 120)))) for i in range(120)]
    for i in range(120, 180):  # near copies: a word changed, long texts
        t = rows[i % 20][1].split() * 6
        t[rng.randrange(len(t))] = "changed%d" % i
        rows.append((i, "\n".join(" ".join(t[k: k + 25]) for k in range(0, len(t), 25))))
    rows += [(180, None), (181, ""), (182, "  \n "), (183, rows[3][1]), (183, rows[3][1]), (184, rows[3][1].upper()), (185, "One line\nOne  line!\nother")]
    rows.append((186, "long " * 70_000))
    return rows


def groups(fps, radius):
    values = np.array(fps, np.uint64)
    label = list(range(len(values)))
    for i in range(len(values)):
        near = [j for j in range(len(values)) if int(values[i] ^ values[j]).bit_count() <= radius]
        least = min(label[j] for j in near)
        old = {label[j] for j in near}
        label = [least if x in old else x for x in label]
    return label


def test_simhash_groups_match_brute_force(spark):
    rows = corpus()
    got = simhash.simhash_groups(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    fps = [simhash.fingerprint(t) for _, t in rows]
    label = groups(fps, simhash.RADIUS)
    first = {}
    for (d, _), g in zip(rows, label):
        first[g] = min(first.get(g, d), d)
    expected = sorted((d, f, first[g]) for (d, _), f, g in zip(rows, fps, label))
    assert sorted((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got) == expected
    kept = simhash.keep_one(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(first.values())


def test_fingerprint_is_the_majority_of_shingle_hashes():
    text = "A b  C d\te"
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in ("a b c d", "b c d e")]
    assert simhash.fingerprint(text) == sum(1 << i for i in range(64) if sum(x >> i & 1 for x in h) > 1)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0
    assert simhash.fingerprint("One two") == xxhash.xxh64_intdigest(b"one two", 42)


@pytest.mark.parametrize("small, tile", [(48, 4096), (2, 16)])
def test_links_lose_no_pair_also_when_buckets_are_cut(spark, monkeypatch, small, tile):
    rng = random.Random(1)
    centre = [rng.getrandbits(64) for _ in range(12)]
    values = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for c in centre for _ in range(40)} | {0, 1, (1 << 64) - 1}
    monkeypatch.setattr(hamming, "SMALL", small)
    monkeypatch.setattr(hamming, "TILE", tile)
    found, units = hamming.Stars(), []
    fps = np.array(sorted(values), np.uint64)
    for mask in hamming.segment_masks(4, 6):
        units += list(hamming.bucket_links(fps, mask, 4, found))
    for x, y in units:
        hamming.compare(x, y, 4, found)
    a, root = found.reduce()
    to = dict(zip(a.tolist(), root.tolist()))
    label = groups(sorted(values), 4)
    least = [sorted(values)[g] for g in label]
    assert [to.get(v, v) for v in sorted(values)] == least
    assert tile == 4096 or units


def test_components_of_chains_stars_and_nothing(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 150)] + [(7, 7), (3, 2), (200, -5)]
    rng.shuffle(edges)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {i: 100 for i in range(101, 150)} | {200: -5}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_lines(rows):
    occ = [(d, t, i, lines.normalised(x)) for d, t in rows for i, x in enumerate((t or "").split("\n"))]
    occ = [x for x in occ if x[3]]
    kinds = sorted({x[3] for x in occ})
    label = list(range(len(kinds)))
    for i in range(len(kinds)):
        for j in range(i):
            if label[i] != label[j] and lines.similar(kinds[i], kinds[j]):
                a, b = label[i], label[j]
                label = [a if x == b else x for x in label]
    of, first = dict(zip(kinds, label)), {}
    for d, t, i, k in sorted(occ, key=lambda x: (x[0] is not None, x[0], x[2])):
        first.setdefault(of[k], (d, i))
    gone = {(d, i) for d, _, i, k in occ if first[of[k]] != (d, i)}
    return [(d, None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone)) for d, t in rows]


@pytest.mark.parametrize("tile, bucket", [(8, 4096), (2048, 2)])
def test_line_dedup_matches_brute_force(spark, monkeypatch, tile, bucket):
    monkeypatch.setattr(lines, "TILE", tile)
    monkeypatch.setattr(lines, "BUCKET", bucket)
    rows = corpus() + [(None, "no id\nNull line"), (None, "no id\nNull line"), (300, "hello\nhella\nHELLO?\nabc\nabd")]
    got = lines.dedup_lines(frame(spark, rows))
    assert got.columns == frame(spark, rows).columns
    key = lambda x: (x[0] or -1, x[1] or "")
    expected = brute_lines(rows)
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=key) == sorted(expected, key=key)
    assert dict(expected)[185] == "One line\nother" and dict(expected)[180] is None and dict(expected)[300] == "hello\nabc\nabd"


def edits(rng, word):
    """Kinds of edits of a line: (name, share that candidates must find, function)."""
    def chars(line, share):
        a = list(line)
        for i in rng.sample(range(len(a)), max(1, int(share * len(a)))):
            r = rng.random()
            a[i] = rng.choice("abcdefghijklmnop") if r < 0.6 else "" if r < 0.8 else a[i] + rng.choice("abcdefghijklmnop")
        return " ".join("".join(a).split())

    def words(line, share):
        w = line.split()
        for i in rng.sample(range(len(w)), max(1, int(share * len(w)))):
            w[i] = word()
        return " ".join(w)

    def insert(line):
        w = line.split()
        for _ in range(max(1, len(w) // 10)):
            w.insert(rng.randrange(len(w) + 1), word())
        return " ".join(w)
    return [("typo", 0.97, lambda x: chars(x, 0)), ("word", 0.97, lambda x: words(x, 0)), ("fifth of words", 0.97, lambda x: words(x, 0.2)),
            ("insert", 0.97, insert), ("tenth of characters", 0.8, lambda x: chars(x, 0.1))]  # words of evenly random letters: no n-gram is more usual than another


def test_recall_of_every_edit_without_regard_to_candidates(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8)))
    rows, pairs = [], []
    for name, least, edit in edits(rng, word):
        for n in (4, 8, 12, 20, 30, 50):
            for _ in range(30):
                a = " ".join(word() for _ in range(n))
                b = edit(a)
                if a != b and lines.similar(a, b):
                    pairs.append((name, least, len(rows), len(rows) + 1))
                    rows += [(len(rows), a), (len(rows) + 1, b)]
    kept = {r["doc_id"]: r["text"] for r in lines.dedup_lines(frame(spark, rows)).collect()}
    assert all(kept[a] for _, _, a, _ in pairs)
    for kind, least in {(p[0], p[1]) for p in pairs}:
        own = [b for name, _, _, b in pairs if name == kind]
        found = sum(kept[b] == "" for b in own)
        assert len(own) > 100 and found >= least * len(own), (kind, found, len(own))


def spoiled(rng, line, share, letters="abcdefghij "):
    a = list(line)
    for i in rng.sample(range(len(a)), int(share * len(a))):
        r = rng.random()
        a[i] = rng.choice(letters) if r < 0.4 else "" if r < 0.7 else a[i] + rng.choice(letters)
    return lines.normalised("".join(a))


def test_bounds_of_the_distance_keep_every_link():
    rng = random.Random(5)
    held = ["".join(rng.choices("abcdefghij \u00e9\u4e2d", k=n)) for n in (1, 3, 5, 9, 30, 63, 64, 65, 70, 128, 140, 200, 300, 700) for _ in range(6)]
    pairs = [(a, spoiled(rng, a, rng.choice([0.05, 0.15, 0.22, 0.3]))) for a in map(lines.normalised, held) if a]
    pairs = [(a, b) for a, b in pairs if b] + [(a + " " + b, b) for (a, _), (b, _) in zip(pairs, pairs[1:])]
    pairs += [(a[k:] + a[:k], a) for a, _ in pairs for k in (len(a) // 10,) if a[k:].strip() and lines.normalised(a[k:] + a[:k])]
    pairs += [(a, lines.normalised("".join(rng.choices("abcdefghij ", k=len(a)))) or "a") for a, _ in pairs]
    every = [x for p in pairs for x in p]
    size = np.array([len(x) for x in every])
    codes = np.frombuffer("".join(every).encode("utf-32-le"), np.uint32)
    a, b = np.arange(0, len(every), 2), np.arange(1, len(every), 2)
    fits = np.abs(size[a] - size[b]) <= lines.allowed(np.maximum(size[a], size[b]), 0.8)
    a, b = a[fits], b[fits]
    limit = lines.allowed(np.maximum(size[a], size[b]), 0.8)
    near = np.array([lines.edit_distance(every[i], every[j], int(d)) <= d for i, j, d in zip(a, b, limit)])
    over = lines.surely_over(np.unique(codes, return_inverse=True)[1] % 256, size, a, b, limit)
    assert near.sum() > 60 and (~near).sum() > 30 and not (over & near).any() and over.sum() > 10
    bits = lines.gram_bits(codes, size, 512)
    for x, y in ((a, b), (b, a)):
        gone = np.bitwise_count(bits[:, x] & ~bits[:, y]).sum(0, dtype=np.int64)
        assert (gone <= lines.BOUND_GRAM * limit)[near].all()


def syllables(rng, n):
    parts = ["th", "an", "er", "on", "ing", "nd", "re", "ha", "ti", "ou", "st", "the ", "of ", "a ", " ", " "]
    return lines.normalised("".join(rng.choices(parts, k=n)))


@pytest.mark.parametrize("n", [1, 8, 40, 120, 800])
def test_places_of_ngrams_keep_every_link(n):
    rng = random.Random(n)
    x = [syllables(rng, n) or "a" for _ in range(70)]
    y = [spoiled(rng, a, rng.choice([0.02, 0.1, 0.2, 0.25])) or "a" for a in x] + [a[len(a) // 9:] + a[: len(a) // 9] for a in x[:9]] + [syllables(rng, n) or "a" for _ in range(20)]
    size = [np.array([len(a) for a in z]) for z in (x, y)]
    grams = [[lines.gram_classes(np.frombuffer("".join(z).encode("utf-32-le"), np.uint32), s, *kind) for z, s in zip((x, y), size)] for kind in ((3, 4096), (4, 1 << 14))]
    longest = np.maximum(size[0][:, None], size[1])
    limit = lines.allowed(longest, 0.8)
    most = int(limit.max())
    left, right = (max(most + int(s), 0) // 2 for s in (size[0].max() - size[1].min(), size[1].max() - size[0].min()))
    far, wide = lines.far_apart(*grams[0], left, right, most), lines.far_apart(*grams[1], left, right, most, 4, 1 << 14)
    near = np.array([[lines.edit_distance(a, b, int(d)) <= d for b, d in zip(y, row)] for a, row in zip(x, limit)])
    assert far.shape == near.shape and not ((far | wide) & near).any() and near.sum() > 20
    assert n < 40 or n > 120 or far.sum() > 0.5 * (~near).sum()


def test_places_of_ngrams_leave_few_pairs_to_slower_bounds(monkeypatch):
    """Common n-grams alone left two fifths of all pairs of long lines to the bounds by pieces."""
    rng, asked, surely_over = random.Random(3), [], lines.surely_over
    held = [lines.normalised(syllables(rng, 130)[:250]) for _ in range(300)]
    held += [spoiled(rng, x, 0.12) for x in held[:40]]
    kinds = sorted(set(held), key=len)
    monkeypatch.setattr(lines, "surely_over", lambda classes, size, a, b, limit: asked.append(len(a)) or surely_over(classes, size, a, b, limit))
    own = {int(np.uint64(xxhash.xxh64_intdigest(x)).view(np.int64)): x for x in kinds}

    def packed(some):
        rows = lines.pa.RecordBatch.from_arrays([lines.pa.nulls(len(some), lines.pa.int64()), lines.pa.array(some)], names=["root", "line"])
        sink = lines.pa.BufferOutputStream()
        with lines.pa.ipc.new_stream(sink, rows.schema) as out:
            out.write_batch(rows)
        return sink.getvalue().to_pybytes()
    for x, y in ((kinds, None), (kinds[::2], kinds[1::2])):
        del asked[:]
        pair = lines.pa.RecordBatch.from_arrays([lines.pa.array([packed(x)]), lines.pa.array([y and packed(y)], lines.pa.binary())], names=["data", "other"])
        edges = [(own[a], own[b]) for out in lines._compare(0.8)([pair]) for a, b in zip(*(c.to_pylist() for c in out.columns))]
        near = {(a, b) for a in x for b in (y or x) if (y or a < b) and lines.similar(a, b)}
        label = {k: k for k in kinds}
        for a, b in near:
            old = label[b]
            label.update({k: label[a] for k in kinds if label[k] == old})
        got = {k: k for k in kinds}
        for a, b in edges:
            old = got[b]
            got.update({k: got[a] for k in kinds if got[k] == old})
        assert len(near) > 10 and all((got[a] == got[b]) == (label[a] == label[b]) for a in kinds for b in kinds)
        assert sum(asked) < 0.1 * len(x) * len(y or x)


def codes_of(some):
    return np.frombuffer("".join(some).encode("utf-32-le"), np.uint32), np.array([len(x) for x in some])


@pytest.mark.parametrize("n, piece", [(1, lines.WHOLE), (8, lines.WHOLE), (40, lines.WHOLE), (120, lines.WHOLE), (120, 96), (500, lines.WHOLE), (500, 96)])
def test_rare_ngrams_keep_every_link(n, piece):
    rng = random.Random(n)
    x = [syllables(rng, n) or "a" for _ in range(70)]
    y = [spoiled(rng, a, rng.choice([0.02, 0.1, 0.2, 0.25])) or "a" for a in x] + [a[len(a) // 9:] + a[: len(a) // 9] for a in x[:9]] + [syllables(rng, n) or "a" for _ in range(30)]
    size = [codes_of(z)[1] for z in (x, y)]
    limit = lines.allowed(np.maximum(size[0][:, None], size[1]), 0.8)
    near = np.array([[lines.edit_distance(a, b, int(d)) <= d for b, d in zip(y, row)] for a, row in zip(x, limit)])
    for one, other, linked in ((0, 1, near), (1, 0, near.T)):
        most, (a, b) = int(limit.max()), (size[one], size[other])
        left, right = max(most + int(a.max() - b.min()), 0) // 2, max(most + int(b.max() - a.min()), 0) // 2
        places, upto = lines.Places(*codes_of((x, y)[other])), -(-int(a.max()) // lines.BLOCK)
        ahead = lines.Ahead(*codes_of((x, y)[one]), places.share(*lines.shifts(left, right, piece)[:2], upto), piece)
        left_over = np.zeros(linked.shape, bool)
        for lo in (0, 50):
            left_over[lines.not_far(ahead, slice(lo, lo + 50), places, left, right, most, upto)] = True
        assert left_over[:50].sum() + left_over[50:100].sum() == left_over[:100].sum() and not (linked[:100] & ~left_over[:100]).any() and near.sum() > 20


def test_rare_ngrams_leave_few_pairs_of_long_lines_to_slower_bounds(monkeypatch):
    """All n-grams in a row left over a fifth of the pairs of these lines to the bounds by pieces."""
    rng, asked, surely_over = random.Random(3), [], lines.surely_over
    held = sorted({lines.normalised(syllables(rng, 520)[: rng.randint(990, 1010)]) for _ in range(200)})
    monkeypatch.setattr(lines, "surely_over", lambda classes, size, a, b, limit: asked.append(len(a)) or surely_over(classes, size, a, b, limit))
    rows = lines.pa.RecordBatch.from_arrays([lines.pa.nulls(len(held), lines.pa.int64()), lines.pa.array(held)], names=["root", "line"])
    sink = lines.pa.BufferOutputStream()
    with lines.pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_batch(rows)
    pair = lines.pa.RecordBatch.from_arrays([lines.pa.array([sink.getvalue().to_pybytes()]), lines.pa.array([None], lines.pa.binary())], names=["data", "other"])
    assert not sum(x.num_rows for x in lines._compare(0.8)([pair])) and sum(asked) < 0.2 * len(held) ** 2 / 2


def test_tiles_meet_wherever_lengths_fit():
    counts = [(1, 3), (2, 1), (4, 30), (5, 2), (9, 100), (10, 1), (12, 7), (40, 2)]
    plan = {size: rest for size, *rest in lines.tile_plan(counts, 8, 0.8)}
    for s, _ in counts:
        first, tiles, lo, hi = plan[s]
        for t, _ in counts:
            if abs(s - t) <= lines.allowed(max(s, t), 0.8):
                assert lo <= plan[t][0] and plan[t][0] + plan[t][1] - 1 <= hi
    assert plan[9][1] == 13 and plan[40][2] == plan[40][0] and lines.tile_plan([], 8, 0.8) == []


@pytest.mark.parametrize("least", [24, 256])
def test_line_dedup_leaves_out_no_link(spark, monkeypatch, least):
    """Lines with up to a fifth of their characters changed: blocks, radius and shared n-grams lose many of them."""
    monkeypatch.setattr(lines, "REST_LEAST", least)
    rng, rows = random.Random(12), []
    for n in (12, 20, 40, 90, 180, 400):
        for _ in range(12):
            a = lines.normalised("".join(rng.choices("abcdefghij ", k=n)))
            rows += [(len(rows), a), (len(rows) + 1, spoiled(rng, a, 0.2)), (len(rows) + 2, spoiled(rng, a, 0.15))]
    rows += [(900, None), (901, rows[4][1].upper()), (901, rows[4][1].upper()), (None, rows[50][1])]
    got = sorted(((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "") for r in lines.dedup_lines(frame(spark, rows)).collect()))
    expected = sorted((-1 if d is None else d, t or "") for d, t in brute_lines(rows))
    assert got == expected and sum(not t for _, t in expected) > 100


def test_packed_entries_are_one_row_for_each_part(spark, monkeypatch):
    """Blocks of all holes that go to one part travel together, so that more parts do not multiply the rows by the holes."""
    made = []
    monkeypatch.setattr(lines, "materialize", lambda df, name: made.append(df) or df if name == "line-buckets" else df)
    rng = random.Random(1)
    docs = frame(spark, [(i, " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(12))) for i in range(300)]).coalesce(1)
    lines._candidates(docs, np.ones(lines.TRIGRAMS, bool), lines.RADIUS, lines.SIMILARITY)
    packed = spark.createDataFrame([], "x int") if not made else made[0]
    plan = packed._jdf.queryExecution().optimizedPlan().toString()
    assert "counts" in plan and "nth" not in plan


def test_distinct_lines_make_blocks_and_tiles_are_not_shuffled_for_each_pair(spark, monkeypatch):
    seen, candidates, materialize = {}, lines._candidates, lines.materialize
    monkeypatch.setattr(lines, "_candidates", lambda docs, *rest: seen.update(texts=docs.count()) or candidates(docs, *rest))
    monkeypatch.setattr(lines, "materialize", lambda df, name, **options: seen.update({name: df}) or materialize(df, name, **options))
    text = "the first of all lines here\nanother one with other words\n\nsomething else again, at some length"
    assert lines.dedup_lines(frame(spark, [(i, text) for i in range(40)])).count() == 40
    assert seen["texts"] == 3
    plan = seen["line-rest"]._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan


def test_packed_tiles_come_back_whole():
    h = np.array([lines.xxhash.xxh64_intdigest(x) for x in ("b", "a é", "c")], np.uint64).view(np.int64)
    root, place = np.array([h[0], 0, h[0]], np.int64), np.zeros(3, np.int32)
    names = ["tile", "from", "to", "h", "root", "line"]
    rows = [lines.pa.RecordBatch.from_arrays([lines.pa.array(x) for x in (place[i:j], place[i:j], place[i:j], h[i:j], root[i:j], ["b", "a é", "c"][i:j])], names=names)
            for i, j in ((0, 2), (2, 3))]
    (packed,) = lines._pack_tiles(rows)
    got = lines._unpacked(packed.column(3)[0].as_buffer())
    assert sorted(zip(got[2], got[0].tolist(), got[1].tolist())) == sorted(zip(("b", "a é", "c"), h.tolist(), root.tolist()))


def test_similar_lines():
    assert lines.edit_distance("kitten", "sitting", 9) == 3 and lines.edit_distance("kitten", "sitting", 2) == 3
    assert lines.edit_distance("", "abc", 9) == 3 and lines.edit_distance("abc", "abc", 0) == 0
    assert lines.similar("aaaaaaaaab", "aaaaaaaaaa") and not lines.similar("abc", "xyz")


def test_contamination_edge_cases(spark):
    item = "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda"
    bench = spark.createDataFrame([(2, item), (10, item), (3, "Tiny item"), (4, ""), (5, None)], "item_id long, text string")
    rows = [(1, "x " + item.upper() + " y"), (2, "alpha beta gamma delta epsilon zeta eta theta iota"), (3, "a TINY-item, tiny item"),
            (4, None), (5, ""), (6, "a TINY-item, tiny item"), (6, "a TINY-item, tiny item"), (None, "tiny item")]
    got = {(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in decontam.contamination(frame(spark, rows), bench).collect()}
    assert got == {(1, 13, 11, 2, True), (2, 9, 0, 0, False), (3, 5, 4, 1, True), (4, 0, 0, 0, False), (5, 0, 0, 0, False), (6, 5, 4, 1, True), (None, 2, 2, 1, True)}
    clean = decontam.decontaminate(frame(spark, rows), bench)
    assert sorted(r["doc_id"] for r in clean.collect()) == [2, 4, 5] and clean.columns == SCHEMA_NAMES
    cut = {r["doc_id"]: r["text"] for r in decontam.decontaminate(frame(spark, rows), bench, "spans").collect()}
    assert cut[1] == "x y" and cut[3] == "a" and cut[4] is None and cut[2] == rows[1][1] and cut[None] == ""
    nothing = decontam.contamination(frame(spark, rows), bench.limit(0))
    assert nothing.filter("contaminated").count() == 0 and nothing.count() == len(rows)
    assert decontam.contamination(frame(spark, rows).limit(0), bench).count() == 0


@pytest.mark.parametrize("most", [decontam.BROADCAST_GRAMS, 0])
def test_windows_match_brute_force_in_any_case_and_script(spark, monkeypatch, most):
    monkeypatch.setattr(decontam, "BROADCAST_GRAMS", most)
    rng, words = random.Random(4), ["The", "the", "OF", "of", "Straße", "STRASSE", "ΣΟΦΟΣ", "σοφος", "Éa", "éa", "kilo", "\u212Ailo", "中文", "a1", "B", "İx"]
    held = [[rng.choice(words) for _ in range(rng.choice([1, 2, 3, 9, 10, 14]))] for _ in range(8)]
    rows = []
    for i in range(60):
        text = [rng.choice(words) for _ in range(rng.randint(0, 30))]
        if i % 2:
            text[5:5] = [rng.choice([w, w.translate({c: c ^ 32 for c in range(65, 91)})]) for w in rng.choice(held)]
        rows.append((i, "".join(w + rng.choice([" ", "-", "\n. "]) for w in text)))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(held)], "item_id long, text string")
    lower = lambda w: "".join(c.lower() if c < "\x80" else c for c in w)
    item = {i: [lower(w) for w in x] for i, x in enumerate(held)}
    expected = []
    for d, text in rows:
        w = [lower(x) for x in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
        hit, found = set(), set()
        for i, x in item.items():
            n = min(len(x), 10)
            for a in range(len(x) - n + 1):
                at = [p for p in range(len(w) - n + 1) if w[p: p + n] == x[a: a + n]]
                hit |= {p + k for p in at for k in range(n)}
                found |= {i} if at else set()
        expected.append((d, len(w), len(hit), len(found)))
    got = decontam.contamination(frame(spark, rows), bench).select("doc_id", "n_words", "n_hit", "n_items").collect()
    assert sorted(map(tuple, got)) == expected and sum(n > 0 for *_, n in expected) > 20


def test_texts_of_windows_are_made_after_the_probe_of_their_ends(spark, monkeypatch):
    """Splitting a text twice and writing out every window were most of the scan's time."""
    seen, materialize = {}, decontam.materialize
    monkeypatch.setattr(decontam, "materialize", lambda df, name, **options: seen.update({name: df}) or materialize(df, name, **options))
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    decontam.hits(spark.createDataFrame([(1, "one two")], "doc_id long, text string"), bench)
    plan = seen["hits"]._jdf.queryExecution().optimizedPlan().toString().split("\n")
    scan = [line for line in plan if "split(" in line and "ends" not in line]
    made = [k for k, line in enumerate(plan) if "array_join" in line]
    (probe,) = [k for k, line in enumerate(plan) if "LeftSemi" in line and "ends" in line]
    assert len(scan) == 1 and made and max(made) < probe


SCHEMA_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]


def test_empty_tables(spark):
    none = frame(spark, []).limit(0)
    assert simhash.simhash_groups(none).count() == 0 and simhash.keep_one(none).count() == 0
    assert lines.dedup_lines(none).count() == 0
