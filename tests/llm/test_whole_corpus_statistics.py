"""Statistics over all rows, estimates of small groups and candidates of every form, against plain Python."""

import re
from collections import Counter

import numpy as np

from prefdata.llm import langid, outliers, secret_scan
from tests.conftest import SF001


def documents(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


def test_named_values_of_any_form_are_candidates():
    forms = {'password = "Xk9!pQ2z"': "Xk9!pQ2z", "api_key=abcdefghijklmnopqrstuvwxyz": "abcdefghijklmnopqrstuvwxyz",
             "token: short1234567": "short1234567", "(secret=hunter22).": "hunter22", "PWD:ÄÖÜäöü": "ÄÖÜäöü", "x 0123456789abcdefXYZ y": "0123456789abcdefXYZ"}
    for text, token in forms.items():
        got = list(secret_scan.candidates(text))
        assert [g[2] for g in got] == [token] and text[got[0][0]: got[0][1]] == token
    for text in (None, "", "author: Johnson", "password:", "token = abc", "an unremarkable sentence of lower case words"):
        assert not list(secret_scan.candidates(text))
    both = list(secret_scan.candidates("token=abcdef0123456789abcdef!? then 0123456789abcdefXYZ"))
    assert [b[2] for b in both] == ["abcdef0123456789abcdef!?", "0123456789abcdefXYZ"]


def test_dictionary_counts_every_document(spark):
    docs = documents(spark)
    language = secret_scan.dictionary(docs)
    words, pairs = Counter(), Counter()
    for r in docs.collect():
        words.update(w for w in re.findall(r"[^\W\d_]{2,24}", (r["text"] or "").lower()))
    for w, c in words.items():
        for a, b in zip(w, w[1:]):
            pairs[a + b] += c
    least = secret_scan.USUAL * sum(words.values())
    assert language.words == {w for w, c in words.items() if len(w) >= 4 and c >= least}
    singles = Counter()
    for p, c in pairs.items():
        singles[p[0]] += c
    assert set(language.log) == set(pairs)
    assert all(abs(v - np.log((pairs[p] + 0.5) / (singles[p[0]] + 20))) < 1e-12 for p, v in language.log.items())
    empty = secret_scan.dictionary(docs.limit(0))
    assert not empty.words and secret_scan.secrets(docs.limit(0)).isEmpty()


def test_n_grams_are_counted_over_all_training_words(spark):
    docs = documents(spark)
    model = langid.train(docs)
    known = docs.filter(~langid.held_out(docs["doc_id"], 4, 2) & docs["lang"].isNotNull()).collect()
    counts = Counter((r["lang"], w) for r in known for w in langid.tokens(r["text"]))
    by_hand = langid.BackoffModel([(lang, w, c) for (lang, w), c in counts.items()])
    assert model.langs == by_hand.langs and model.words == by_hand.words and model.grams == by_hand.grams
    assert np.allclose(model.log, by_hand.log)
    for text in ("und das Haus", "zzzz qqqq", "½ ² 12", "", None):
        assert model.classify(text) == by_hand.classify(text)
    few = langid.train(docs, words=20, n_grams=10)
    assert set(few.langs) == set(model.langs)  # every language keeps its own


def plain(i, n=120, lines=12):
    """A text of ``lines`` different lines."""
    words = [f"{'abcdefghij'[(i * 7 + k * k) % 10]}{'lmnopqrst'[(i + k) % 9]}{'uvwxyz'[(k * 5 + i) % 6]}{'aeio'[(i * 3 + k * 11) % 4]}{k}" for k in range(n)]
    step = n // lines
    return "\n".join(" ".join(words[k: k + step]) for k in range(0, n, step))


def test_repeated_lines_alone_reject_and_small_groups_use_their_language(spark):
    rows = [(i, plain(i), "en", "big") for i in range(300)] + [(1000 + i, plain(i + 5), "en", "rare") for i in range(6)]
    words = plain(3).split()
    menu = "\n".join(" ".join(words[:2]) if k % 2 else " ".join(words[:2])[::-1] for k in range(60))
    shout = plain(9).upper().replace(" ", " ##$$ ")
    rows += [(2000, menu, "en", "big"), (2001, shout, "en", "rare"), (2002, shout, "xx", "alone"), (2003, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in outliers.quality_outliers(docs).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["kept"] for i in range(300)) and all(got[1000 + i]["kept"] for i in range(6))
    assert not got[2001]["kept"] and not got[2002]["kept"] and not got[2001]["base_failed"]
    assert got[2001]["distance"] is not None and not got[2003]["kept"]
    # a text nearly all of whose lines repeat lies beyond the cutoff by that statistic alone
    assert (1 / outliers.FLOOR["x_lines"]) ** 2 > outliers.chi2_quantile(outliers.CUT, len(outliers.X))


def test_group_estimates_cover_all_rows_of_their_language(spark):
    rows = [(i, "en" if i % 3 else "de", f"s{i % 4}" if i < 400 else f"t{i}", False, *[(i * (j + 3)) % 50 for j in range(5)]) for i in range(420)]
    stats = spark.createDataFrame(rows, "doc_id long, lang string, source string, base_failed boolean, " + ", ".join(f"{x} long" for x in outliers.X))
    judged, fit = outliers._with_groups(stats)
    gid = {r["doc_id"]: r["gid"] for r in judged.collect()}
    n = {r["gid"]: r["count"] for r in fit.groupBy("gid").count().collect()}
    sizes, langs = Counter((r[1], r[2]) for r in rows), Counter(r[1] for r in rows)
    for r in rows:
        if sizes[r[1:3]] >= outliers.MIN_GROUP:
            assert gid[r[0]] == f"={r[1]}\x1f={r[2]}" and n[gid[r[0]]] == sizes[r[1:3]]
        else:
            assert gid[r[0]] == f"={r[1]}\x1f*" and n[gid[r[0]]] == langs[r[1]]
