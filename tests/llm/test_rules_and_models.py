"""Operators 1, 4, 5, 6, 7, 8 and 9: brute force, round trips, held-out accuracy, edge cases."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from prefdata.llm import langid, mixing, outliers, pii, quality, secret_scan, warc

SF = "/root/testdata/sf0.01"


def docs(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, cell string"
    return spark.createDataFrame([(d, t, lang, s, 0, "a", "b", "c") for d, t, lang, s in rows], schema).repartition(3)


EDGES = [(9001, None, "en", None), (9002, "", None, "s"), (9003, " \n\t", "en", "s"), (9004, "one", "en", "s"), (9004, "one", "en", "s"),
         (None, "two words", None, None), (9005, "ab " * 60_000, "en", "s")]


def base(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    n = collections.Counter(zip(w, w[1:], w[2:]))
    hit = {j for i in range(len(w) - 2) if n[tuple(w[i: i + 3])] > 1 for j in (i, i + 1, i + 2)}
    kept = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(kept) - len(set(kept)), len(hit)


def test_quality_rules_reject_outliers_and_keep_the_rest(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 8)))
    rows = [(i, " ".join(word() for _ in range(rng.randint(60, 160))), "en", "s" if i % 3 else "t") for i in range(900)]
    rows += [(1000 + i, " ".join(word() + "###" for _ in range(80)), "en", "s") for i in range(40)]
    got = outliers.quality_outliers(docs(spark, rows + EDGES)).collect()
    assert len(got) == len(rows) + len(EDGES)
    text = {d: t for d, t, *_ in rows + EDGES}
    for r in got:
        want = base(text[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["kept"] and r["base_failed"])
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert not any(kept[1000 + i] for i in range(40)) and sum(kept[i] for i in range(900)) >= 897


def test_mahalanobis_matches_numpy(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(800, 5)) * 300 + 1000).astype(int)
    rows = spark.createDataFrame([(i, "g", *map(int, v)) for i, v in enumerate(x)], "doc_id long, gid string, " + ", ".join(f"{c} long" for c in outliers.X))
    sums = rows.groupBy("gid").agg(*outliers._sums())
    got = rows.join(outliers._estimate(sums, 1.0), "gid").withColumn("d", outliers._distance()).orderBy("doc_id").toPandas()["d"].to_numpy()
    cov = np.cov(x.T, bias=True) + np.diag([(outliers.FLOOR[c] * outliers.GRID) ** 2 for c in outliers.X])
    z = x - x.mean(0)
    assert np.allclose(got, np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z))
    assert abs(outliers.chi2_quantile(0.975, 5) - 12.8325) < 1e-3


RULES = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    good = [lambda m: True, lambda m: all(int(p) <= 255 for p in m.split(".")), lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m)),
            lambda m: 10 <= len(digits(m)) <= 15]
    found = sorted((m.start(), k, m.end()) for k, p in enumerate(RULES) for m in re.finditer(p, text or "") if good[k](m.group()))
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in found)


def test_personal_data_base_matches_brute_force(spark):
    rng = random.Random(5)
    pieces = ["a.b@c.d", "a@b.c_d@e.f", "a@b.c..d@e.f", "1.2.3.4.5", "256.1.1.1", "001.2.3.255", "4111 1111-1111 1111", "4111111111111112", "12--34", "+1 (555) 555-0100", "+1 2",
              "+12 . ", "é@x.y", "𝔘 9.9.9.9", "@", "+", "\n", " ", "x", "0", "-", "."]
    rows = [(i, "".join(rng.choices(pieces, k=rng.randint(1, 12))), "en", "s") for i in range(400)]
    rows += [(900, "a" * 50_000 + "@" + "b.c" * 20_000, "en", "s"), (901, "1 " * 50_000, "en", "s"), *EDGES]
    got = pii.personal_data(docs(spark, rows)).collect()
    text = {d: t for d, t, *_ in rows}
    assert len(got) == len(rows)
    for r in got:
        want = spans(text[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), (r["doc_id"], want, r["spans"])
        assert set(filter(None, want.split(","))) <= set(r["spans"].split(","))


def test_patterns_of_seeds_discover_unseen_identifiers(spark):
    card = lambda i: next(s for c in range(10) if luhn(s := f"41111111{i:07d}{c}"))
    bad = lambda i: next(s for c in range(10) if not luhn(s := f"42222222{i:07d}{c}"))
    rows = [(i, f"pay by card {card(i)} now", "en", "s") for i in range(30)]
    rows += [(100, f"pay by card {bad(1)} now", "en", "s"), (101, f"order number {bad(2)} was sent", "en", "s")]
    got = {r["doc_id"]: r for r in pii.personal_data(docs(spark, rows)).collect()}
    assert got[100]["spans"] == "card:12:28" and got[100]["n_card"] == 0 and got[100]["n_added"] == 1
    assert got[101]["spans"] == "" and got[3]["n_card"] == 1 and got[3]["n_added"] == 0


def test_quality_classifier_on_held_out_labels(spark):
    large = SF.replace("sf0.01", "sf0.1")  # 4,000 labels
    d, labels = spark.read.parquet(f"{large}/documents.parquet"), spark.read.parquet(f"{large}/labels.parquet")
    got = quality.quality_scores(d, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert (got["predicted"] == got["quality"]).mean() > 0.95 and got["score"].between(0, 1).all()
    edges = quality.quality_scores(docs(spark, EDGES), labels.limit(0)).toPandas()
    assert (edges["score"] == 0.5).all() and len(edges) == len(EDGES)
    one_class = quality.fit(np.ones((5, len(quality.FEATURES))), np.ones(5))
    assert one_class.score(np.zeros((1, len(quality.FEATURES))))[0] > 0.5


def test_language_on_held_out_documents(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.languages(d).join(d.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (got["lang_pred"] == got["lang"]).mean() > 0.98
    model = langid.BackoffModel([("de", "und", 5), ("de", "nicht", 3), ("en", "the", 6), ("en", "thing", 2)])
    assert model.classify("the thing")[0] == "en" and model.classify("nichts")[0] == "de"
    assert model.classify(None) == model.classify("12 !?") == model.classify("½ ² ① ٣") == ("und", 0.0)
    assert langid.tokens("x²Ähre ½ ①b") == ["x", "ähre", "b"]
    edges = {r["doc_id"]: r for r in langid.languages(docs(spark, EDGES)).collect()}
    assert edges[9001]["lang_pred"] == "und" and edges[9005]["lang_pred"] == "en" and len(edges) == 6


PAGES = [(3, "http://a/é", "same"), (1, "http://b\r\nX: y", "same"), (2, None, None), (5, "u", ""), (7, "u", "ü" * 50_000), (9, "v", "same"), (9, "v", "same"), (None, "n", "same")]


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, payload string").repartition(3)
    outs = []
    for run, parts in enumerate((3, 1)):
        out = f"file://{tmp_path}/warc{run}"
        manifest = warc.write_warc(pages.repartition(parts), out, file_bytes=300, shard_bytes=400).orderBy("file").collect()
        outs.append([(m["file"], m["records"], m["bytes"], m["sha256"]) for m in manifest])
    assert outs[0] == outs[1] and len(outs[0]) > 2  # the same files for any partitioning
    with pytest.raises(FileExistsError):
        warc.write_warc(pages, out)
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.read_warc(spark, out).collect()), key=repr)
    want = []
    for page, _, html in PAGES:
        body = (html or "").encode()
        same = min(p for p, _, h in PAGES if (h or "") == (html or "") and p is not None)
        revisit = page is not None and page != same
        want.append((page, len(body), warc.base32_sha1(body), "revisit" if revisit else "response", same if revisit else None))
    assert got == sorted(want, key=repr)
    whole = {r["page_id"]: r["payload"] for r in warc.read_warc(spark, out).filter("record_type = 'response'").collect()}
    assert bytes(whole[7]) == ("ü" * 50_000).encode() and bytes(whole[2]) == b""
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_raking_meets_marginals(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randint(1, 40)), rng.choice(["en", "en", "fr", None]), rng.choice(["a", "a", "a", "b", None])) for i in range(600)]
    goal = {"source": {"a": 1, "b": 1, None: 2}, "lang": {"en": 1, "fr": 2, None: 1}}
    got = mixing.calibrated(docs(spark, rows + EDGES), goal, rounds=12).toPandas()
    assert len(got) == len(rows) + len(EDGES) and got["probability"].max() <= 1 + 1e-9
    meta = {d: (lang, s) for d, t, lang, s in rows}
    got = got[got["doc_id"].isin(list(meta))]
    tokens = collections.Counter()
    for r in got.itertuples():
        lang, source = meta[int(r.doc_id)]
        tokens["lang", lang] += r.n_tokens * r.probability
    total = sum(tokens.values())
    assert abs(tokens["lang", "fr"] / total - 0.5) < 0.1
    assert mixing.mix(docs(spark, [])).count() == 0
    assert mixing.mix(docs(spark, rows)).columns == docs(spark, rows).columns
    # Rows of one id are drawn by the probability of their own cell.
    twins = [(i, "one two three four", "fr", "a") for i in range(200)] + [(i, "one two three four", "en", "b") for i in range(200)]
    goal = {"lang": {"fr": 0.9, "en": 0.1}, "source": {"a": 0.9, "b": 0.1}}
    drawn = [r["lang"] for r in mixing.mix(docs(spark, twins), goal).collect()]
    assert drawn.count("fr") == 200 and 5 <= drawn.count("en") <= 45


def test_secret_scan_removes_false_positives(spark):
    rng = random.Random(4)
    hexes = lambda: "".join(rng.choices("0123456789abcdef", k=40))
    rows = [(i, f'some plain words here token = "{hexes()}" and more', "en", "s") for i in range(60)]
    rows += [(100 + i, f"card {rng.randrange(10 ** 15, 10 ** 16)} and /usr/lib/python3/words/some/plain", "en", "s") for i in range(60)]
    got = secret_scan.secrets(docs(spark, rows + EDGES)).toPandas()
    assert got[got["doc_id"] < 100]["is_secret"].all() and not got[got["doc_id"] >= 100]["is_secret"].any()
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redact(docs(spark, rows)).collect()}
    assert clean[0] == 'some plain words here token = "[SECRET]" and more' and clean[100] == dict((d, t) for d, t, *_ in rows)[100]
    text = rows[0][1]
    twins = [*rows, (0, "an entirely other text of the same id, long enough to reach the span of a secret in it", "en", "s"), (None, text, "en", "s"), (None, "harmless", "en", "s")]
    both = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"]) for r in secret_scan.redact(docs(spark, twins)).collect() if r["doc_id"] in (0, None))
    masked = 'some plain words here token = "[SECRET]" and more'
    assert both == sorted([(0, masked), (0, twins[-3][1]), (-1, masked), (-1, "harmless")])
    none = secret_scan.secrets(docs(spark, EDGES))
    assert none.count() == 0
