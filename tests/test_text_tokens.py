
import pytest
from pyspark.sql import functions as F

from prefdata.functions import text as TX
from prefdata.functions.tokens import PAD_ID, pad, padded_mask, round_up, token_count, tokens
from prefdata.operators import prompts as PR
from prefdata.operators import vocab as V
from tests.reference_rules import collapse

SAMPLES = [
    "", "a", "  lead and trail \t\n", "x\n\n\n\ny", "x\n  \n y", "x\n \ny", "x\n\u001c\ny",
    "p\u0085q r", "a\r\n\r\nb", "no blank\nlines", "\n\n", "tab\t\tsep",
]


def _one(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")


def test_collapse_and_strip_match_python(spark):
    df = _one(spark, SAMPLES).select("i", TX.collapse_blank_lines("t").alias("c"), TX.strip_text("t").alias("s"))
    for r in df.collect():
        assert r["c"] == collapse(SAMPLES[r["i"]])
        assert r["s"] == SAMPLES[r["i"]].strip()


def test_tokens_match_str_split(spark):
    df = _one(spark, SAMPLES).select("i", tokens("t").alias("k"), token_count("t").alias("n"))
    for r in df.collect():
        assert list(r["k"]) == SAMPLES[r["i"]].split()
        assert r["n"] == len(SAMPLES[r["i"]].split())


@pytest.mark.parametrize("attr,expected", [("lang-py", "py"), ("a-b c", "b"), ("", None), ("plain", "plain"),
                                           ("  lang-js extra", "js")])
def test_code_language(spark, attr, expected):
    row = spark.createDataFrame([(attr,)], "c string").select(TX.code_language("c").alias("l")).first()
    assert row["l"] == expected


def test_code_language_null_attr(spark):
    row = spark.createDataFrame([(None,)], "c string").select(TX.code_language("c").alias("l")).first()
    assert row["l"] is None


@pytest.mark.parametrize("n,kept_strict,kept_inclusive", [(511, True, True), (512, False, True), (513, False, False)])
def test_length_filters_at_boundary(spark, n, kept_strict, kept_inclusive):
    df = spark.createDataFrame([(" ".join(["w"] * n), " ".join(["w"] * 3))], "a string, b string")
    assert (PR.filter_shorter(df, "a", 512).count() == 1) == kept_strict
    assert (PR.filter_both_within(df, "a", "b", 512).count() == 1) == kept_inclusive
    assert (PR.filter_both_within(df, "b", "a", 512).count() == 1) == kept_inclusive


def test_prompts_and_prefixes(spark):
    df = spark.createDataFrame([("Q?", "A.")], "q string, a string")
    r = df.select(PR.question_prompt("q").alias("p"), PR.qa_text("q", "a").alias("t"),
                  PR.add_prefixes(PR.question_prompt("q"), ["TAG ", "INSTR "]).alias("x"),
                  PR.query_response(PR.question_prompt("q"), "a").alias("qr")).first()
    assert r["p"] == "Question: Q?\n\nAnswer: "
    assert r["t"] == "Question: Q?\n\nAnswer: A."
    assert r["x"] == "TAG INSTR Question: Q?\n\nAnswer: "
    assert r["qr"] == "Question: Q?\n\nAnswer: A."


@pytest.mark.parametrize("n", [0, 8, 9])
def test_pad_to_multiple_of_8(spark, n):
    df = spark.createDataFrame([(list(range(3, 3 + n)),)], "ids array<int>")
    w = round_up(F.size("ids"), 8)
    r = df.select(pad("ids", w, PAD_ID).alias("p"), padded_mask("ids", w).alias("m")).first()
    width = -(-n // 8) * 8
    assert len(r["p"]) == width and r["p"][n:] == [PAD_ID] * (width - n)
    assert r["m"] == [1] * n + [0] * (width - n)


def test_left_padding(spark):
    df = spark.createDataFrame([([5, 6],)], "ids array<int>")
    r = df.select(pad("ids", 4, 0, side="left").alias("p"), padded_mask("ids", 4, side="left").alias("m")).first()
    assert r["p"] == [0, 0, 5, 6] and r["m"] == [0, 0, 1, 1]


def test_vocab_encode_decode_roundtrip(spark):
    texts = ["the cat sat", "the dog  sat\nthe end", "rare", "", None, "naïve 日本語\u2003𝄞 the rarer"]
    df = _one(spark, texts)
    vocab = V.build_vocab(df, "t", max_size=3 + 5)
    rows = {r["token"]: r["id"] for r in vocab.collect()}
    assert rows["the"] == 3 and rows["sat"] == 4  # by count desc, then token
    assert len(rows) == 5
    enc = df.select("i", V.encoder(vocab, 8)("t").alias("ids"))
    dec = enc.select("i", V.decoder(vocab, 8)("ids").alias("d"), "ids").collect()
    for r in dec:
        text = texts[r["i"]]
        assert r["d"] == (None if text is None else " ".join(text.split()))
        spelled = [i for w in (text or "").split() for i in ([rows[w]] if w in rows else [8 + b for b in f" {w}".encode()])]
        assert (r["ids"] or []) == spelled
    cut = df.filter("i = 5").select(V.decoder(vocab, 8)(F.slice(V.encoder(vocab, 8)("t"), 1, 4)).alias("d")).first()
    assert cut["d"] == "na\ufffd"  # a truncation may cut a character of a spelled token
    with pytest.raises(ValueError):
        V.encoder(vocab, 4)


def test_eos_and_ratio(spark):
    df = spark.createDataFrame([(["a", "b"], "ab cd")], "t array<string>, s string")
    r = df.select(V.with_eos(F.array(F.lit(3), F.lit(4))).alias("x")).first()
    assert r["x"] == [3, 4, 1]
    ratio = V.chars_per_token(df, "s").first()
    assert ratio["ratio"] == 5 / 2
    empty = V.chars_per_token(df.filter("false"), "s").first()
    assert empty["ratio"] is None


def test_markdown_code_blocks(spark):
    cases = {
        '<pre class="lang-py s-code"><code>x = 1</code></pre>': "```py\nx = 1\n```",
        "<p>use</p><pre><code>y</code>\n</pre>": "use\n\n```\ny\n```",
        "call <code>f()</code><hr>end": "call `f()`\n\n---\n\nend",
        "<pre>plain</pre>": "```\nplain\n```",
        "<div>" * 600 + "deep" + "</div>" * 600: "deep",
        "": "",
        None: None,
    }
    df = spark.createDataFrame([(i, x) for i, x in enumerate(cases)], "i int, h string")
    got = [r["m"] for r in df.select("i", TX.repair_utf8(TX.markdown_native("h")).alias("m")).orderBy("i").collect()]
    assert got == list(cases.values())


def test_markdown_native_subset(spark):
    html = '<!-- c --><h1>Title</h1><p>One <b>two</b><br>three &amp; &quot;q&quot;</p><a href="/x">link</a>'
    r = spark.createDataFrame([(html,)], "h string").select(TX.markdown_native("h").alias("m")).first()
    assert r["m"] == '# Title\n\nOne **two**  \nthree & "q"\n\n[link](/x)'


def test_utf8_repair_inserts_replacement_char(spark):
    r = spark.range(1).select(TX.repair_utf8(F.unhex(F.lit("61FF62")).cast("string")).alias("s")).first()
    assert r["s"] == "a\ufffdb"


def test_batches_are_spread_out_in_slices_without_a_change():
    import numpy as np

    from prefdata.operators.vocab import cuts_of

    rng = np.random.default_rng(2)
    sizes = rng.integers(0, 50, 500)
    sizes[77] = 1000
    cuts = cuts_of(sizes, 100)
    assert cuts[0][0] == 0 and cuts[-1][1] == 500 and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))
    assert all(sizes[i:j].sum() <= 150 or 77 in range(i, j) for i, j in cuts) and len(cuts) > 50
    assert cuts_of(np.zeros(0, np.int64)) == [(0, 0)] and cuts_of(np.zeros(5, np.int64)) == [(0, 5)]
