"""Operator 7: language identification, known words first, character n-grams for unseen ones.

A word of the model adds its log frequency in each language.  A word that the
model does not know is looked up by its character n-grams, the longest first,
and the first length with a known n-gram counts.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.window import Window

from prefdata.llm.common import materialize
from prefdata.llm.quality import held_out

#: Documents with a language that the model is fitted on at most (those with the smallest hash of their id).
TRAIN_DOCS = 20_000
#: Words of a language, and n-grams of a language and length, in the model at most: the most frequent ones of the training documents.
MODEL_WORDS, MODEL_GRAMS = 60_000, 15_000
#: Lengths of n-grams, longest first; smoothing; tokens after which a text's evidence counts no more.
ORDERS, SMOOTHING, SURE_TOKENS = (4, 3, 2, 1), 0.5, 30

WORD = re.compile(r"[^\W\d_]+")


def tokens(text: str | None) -> list[str]:
    """Runs of letters; other numerals that the pattern lets through (½, ², ①) part them."""
    found = WORD.findall((text or "").lower())
    odd = [t for t in found if not t.isalpha()]
    if odd:
        found = [t for t in found if t.isalpha()] + [w for t in odd for w in "".join(c if c.isalpha() else " " for c in t).split()]
    return found


def grams(word: str, n: int) -> list[str]:
    padded = word if n == 1 else f"^{word}$"
    return [padded[i: i + n] for i in range(len(padded) - n + 1)]


class BackoffModel:
    """Log frequencies per language (columns) of words and n-grams (rows)."""

    def __init__(self, counts: list[tuple[str, str, int]], of_grams: list[tuple[int, str, str, int]] | None = None):
        """``counts`` are (language, word, occurrences), ``of_grams`` (length, language, n-gram, occurrences); without them those of the words given."""
        self.langs = sorted({lang for lang, _, _ in counts})
        of = {lang: i for i, lang in enumerate(self.langs)}
        if of_grams is None:
            of_grams = [(n, lang, g, c) for lang, word, c in counts for n in ORDERS for g in grams(word, n)]
        tables = {0: Counter({(lang, w): c for lang, w, c in counts}), **{n: Counter() for n in ORDERS}}
        for n, lang, g, c in of_grams:
            tables[n][(lang, g)] += c
        self.words: dict[str, int] = {}
        self.grams: dict[int, dict[str, int]] = {n: {} for n in ORDERS}
        rows, at = [], 0
        for n, table in tables.items():
            index = self.grams[n] if n else self.words
            names = sorted({g for _, g in table})
            index.update({g: at + i for i, g in enumerate(names)})
            m = np.full((len(names), len(self.langs)), SMOOTHING)
            for (lang, g), c in table.items():
                m[index[g] - at, of[lang]] += c
            rows.append(np.log(m / m.sum(axis=0, keepdims=True)))
            at += len(names)
        self.log = np.concatenate(rows) if self.langs else np.zeros((0, 0))

    def classify(self, text: str | None) -> tuple[str, float]:
        """Language and its share of the evidence; ``und`` and 0 for null and texts without a letter."""
        found = Counter(tokens(text))
        if not found or not self.langs:
            return "und", 0.0
        at, weight, known = [], [], self.words
        for word, c in found.items():
            i = known.get(word)
            if i is not None:
                at.append(i)
                weight.append(c)
                continue
            for n in ORDERS:
                index = self.grams[n]
                ids = [j for g in grams(word, n) if (j := index.get(g)) is not None]
                if ids:
                    at += ids
                    weight += [c / len(ids)] * len(ids)
                    break
        n = sum(found.values())
        total = np.array(weight) @ self.log[at] if at else np.zeros(len(self.langs))
        odds = np.exp((total - total.max()) * min(1.0, SURE_TOKENS / n))
        best = int(np.argmax(odds))
        return self.langs[best], float(odds[best] / odds.sum())


def train(docs: DataFrame, rows: int = TRAIN_DOCS, words: int = MODEL_WORDS, n_grams: int = MODEL_GRAMS) -> BackoffModel:
    """Counts per language of words, and of the n-grams of all words, over at most ``rows`` documents outside the held-out fold.

    Every language keeps its own most frequent ones, so a rare language loses none to a frequent one.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"), 4, 2))
    ids = known.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = known.select("doc_id", "lang", "text").join(F.broadcast(ids), "doc_id")  # an integer in at most `rows` rows
    words_of = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
    counts = materialize(sample.select("lang", F.explode(words_of).alias("g")).groupBy("lang", "g").agg(F.count("*").alias("n")), "langid-words")
    every = counts.select(F.lit(0).alias("size"), "lang", "g", "n")
    for size in ORDERS:
        padded = F.col("g") if size == 1 else F.concat(F.lit("^"), "g", F.lit("$"))
        places = F.when(F.length(padded) >= size, F.sequence(F.lit(1), F.length(padded) - size + 1))
        cut = counts.select("lang", "n", padded.alias("p"), F.explode(places).alias("i"))
        cut = cut.groupBy("lang", F.substring("p", F.col("i"), F.lit(size)).alias("g")).agg(F.sum("n").alias("n"))
        every = every.unionByName(cut.select(F.lit(size).alias("size"), "lang", "g", "n"))
    rank = F.row_number().over(Window.partitionBy("size", "lang").orderBy(F.desc("n"), "g"))
    top = every.withColumn("rank", rank).filter(F.col("rank") <= F.when(F.col("size") == 0, words).otherwise(n_grams))
    got = top.select("size", "lang", "g", "n").collect()  # `words` and a few times `n_grams` rows per language at most
    return BackoffModel([(r["lang"], r["g"], r["n"]) for r in got if not r["size"]], [tuple(r) for r in got if r["size"]])


def languages(docs: DataFrame, rows: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row of ``docs``.

    Null texts and texts without a letter are ``und`` with score 0, as is every
    text where there is nothing to learn from.  Repeated rows repeat their
    result; only the text is an input of a prediction; extra columns are not
    looked at.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, rows))

    @pandas_udf("lang_pred string, score double")
    def predict(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.value.classify(t) for t in text], columns=["lang_pred", "score"])

    predicted = docs.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), predict("text").alias("p"))
    return predicted.select("doc_id", "held_out", "p.lang_pred", "p.score")
