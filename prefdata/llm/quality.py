"""Operator 6: quality classifier, a generalised additive model with pairwise interactions.

Shallow trees are boosted in turn on one feature after the other, then on the
strongest pairs of features.  What they add up to is a lookup table per
feature and per pair, so a text is scored by finding its bins and adding.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

#: Labelled rows that the model is fitted on at most (those with the smallest hash of their id).
TRAIN_ROWS = 20_000
#: Bins of a feature, boosting rounds over all features, and over all pairs; pairs; learning rate; penalty of a leaf.
BINS, ROUNDS, PAIR_ROUNDS, PAIRS, RATE, PENALTY = 48, 150, 60, 6, 0.15, 4.0
#: Score from which a text is taken as good.
THRESHOLD = 0.3

FEATURES = ("log_words", "word_length", "upper", "digits", "symbols", "exclaim", "stops", "pipes", "non_ascii",
            "lines_per_word", "dup_lines", "distinct_words", "distinct_trigrams", "log_longest_line")

_CLASS = np.zeros((8, 256))
for _row, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>", b"!?", b".,;:", b"|")):
    _CLASS[_row, list(_chars)] = 1
_CLASS[6, 128:] = 1
_CLASS[7, [9, 10, 11, 12, 13, 32]] = 1


def features(text: str | None) -> list[float]:
    """Statistics of one whole text; null counts as empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = len(words), max(1, len(raw))
    upper, digits, symbols, exclaim, stops, pipes, non_ascii, space = _CLASS @ np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    grams = max(1, n - 2)
    return [np.log1p(n), (size - space) / max(1, n), upper / size, digits / size, symbols / size, exclaim / size, stops / size,
            pipes / size, non_ascii / size, len(lines) / max(1, n), 1 - len(set(lines)) / max(1, len(lines)),
            len(set(words)) / max(1, n), len(set(zip(words, words[1:], words[2:]))) / grams if n > 2 else 1.0,
            np.log1p(max(map(len, lines), default=0))]


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _gain(g, h):
    return g * g / (h + PENALTY)


def _best_split(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and position of the best split of a histogram (0: none)."""
    cg, ch = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(cg):
        return 0.0, 0
    gain = _gain(cg, ch) + _gain(g.sum() - cg, h.sum() - ch) - _gain(g.sum(), h.sum())
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values per bin of a tree of the given depth on one feature's histogram."""
    gain, at = _best_split(g, h) if depth else (0.0, 0)
    if gain <= 1e-9:
        return np.full(len(g), g.sum() / (h.sum() + PENALTY))
    return np.concatenate([_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values per cell of the best tree that splits one axis, then the other on either side; and its gain."""
    best, out = 0.0, None
    for turn in (False, True):
        a, b = (g.T, h.T) if turn else (g, h)
        for at in range(1, a.shape[0]):
            parts = [(a[:at].sum(0), b[:at].sum(0)), (a[at:].sum(0), b[at:].sum(0))]
            splits = [_best_split(*p) for p in parts]
            gain = sum(s[0] for s in splits) + sum(_gain(p[0].sum(), p[1].sum()) for p in parts) - _gain(a.sum(), b.sum())
            if gain > best:
                best, value = gain, np.empty(a.shape)
                for rows, (pg, ph), (_, cut) in zip((slice(None, at), slice(at, None)), parts, splits):
                    for cols in (slice(None, cut), slice(cut, None)):
                        value[rows, cols] = pg[cols].sum() / (ph[cols].sum() + PENALTY)
                out = value.T if turn else value
    return (np.zeros(g.shape) if out is None else out), best


class AdditiveModel:
    """Cut points and lookup tables; ``score`` adds table entries."""

    def __init__(self, cuts, tables, pair_tables, base):
        self.cuts, self.tables, self.pair_tables, self.base = cuts, tables, pair_tables, base

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)]

    def score(self, x: np.ndarray) -> np.ndarray:
        at = self.bins(x)
        z = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            z += t[at[j]]
        for (i, j), t in self.pair_tables.items():
            z += t[at[i] // PAIR_STEP, at[j] // PAIR_STEP]
        return _sigmoid(z)


#: Bins of a feature that make one bin of a pair's table.
PAIR_STEP = 6
PAIR_BINS = BINS // PAIR_STEP + 1


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting on the logistic loss; without rows every score is one half."""
    p = len(FEATURES)
    if not len(y):
        return AdditiveModel([np.empty(0)] * p, [np.zeros(1)] * p, {}, 0.0)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(p)]
    cuts = [np.unique(np.concatenate([c, _tail_cuts(x[:, j], y)])) for j, c in enumerate(cuts)]
    cuts = [c if len(c) < BINS else c[np.linspace(0, len(c) - 1, BINS - 1).astype(int)] for c in cuts]
    rate = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(cuts, [np.zeros(len(c) + 1) for c in cuts], {}, float(np.log(rate / (1 - rate))))
    at = model.bins(x)
    z = np.full(len(y), model.base)
    for _ in range(ROUNDS):
        for j in range(p):
            s = _sigmoid(z)
            m = len(cuts[j]) + 1
            step = RATE * _tree(np.bincount(at[j], y - s, m), np.bincount(at[j], s * (1 - s), m))
            model.tables[j] += step
            z += step[at[j]]
    cell = {(i, j): (at[i] // PAIR_STEP) * PAIR_BINS + at[j] // PAIR_STEP for i in range(p) for j in range(i)}

    def grid(key, s):
        shape = (PAIR_BINS, PAIR_BINS)
        return np.bincount(cell[key], y - s, PAIR_BINS ** 2).reshape(shape), np.bincount(cell[key], s * (1 - s), PAIR_BINS ** 2).reshape(shape)
    s = _sigmoid(z)
    strongest = sorted(cell, key=lambda k: (-_pair_tree(*grid(k, s))[1], k))[:PAIRS]
    model.pair_tables = {k: np.zeros((PAIR_BINS, PAIR_BINS)) for k in strongest}
    for _ in range(PAIR_ROUNDS):
        for k in strongest:
            step = RATE * _pair_tree(*grid(k, _sigmoid(z)))[0]
            model.pair_tables[k] += step
            z += step.reshape(-1)[cell[k]]
    return model


def _tail_cuts(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Quantiles of the rarer class, so that what only a few rows have gets bins too."""
    rare = x[y == (0 if y.mean() > 0.5 else 1)]
    return np.quantile(rare, np.linspace(0, 1, 17)[1:-1]) if len(rare) else np.empty(0)


def _vectors():
    @pandas_udf("array<double>")
    def vector(text: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in text], dtype=object)
    return vector


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> AdditiveModel:
    """Fit on at most ``rows`` labelled documents outside the held-out fold.

    Labels without an id or a quality are left out; of several labels of an id
    the largest counts.
    """
    learn = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), 5, 0))
    learn = learn.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    picked = docs.select("doc_id", "text").join(F.broadcast(learn), "doc_id")  # two integers in at most `rows` rows
    vectors = picked.select(F.xxhash64("doc_id").alias("h"), "doc_id", "quality", F.xxhash64("text").alias("t"), _vectors()("text").alias("x"))
    pdf = vectors.orderBy("h", "doc_id", "t").limit(rows).toPandas()  # however often an id is repeated
    x = np.array(pdf["x"].tolist(), float).reshape(-1, len(FEATURES))
    return fit(x, pdf["quality"].to_numpy(float))


def held_out(doc_id, folds: int, fold: int):
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def score_udf(model: AdditiveModel):
    @pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        x = np.array([features(t) for t in text], float).reshape(-1, len(FEATURES))
        return pd.Series(model.score(x))
    return score


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``.

    Null and empty texts are scored as empty texts; repeated rows repeat their
    score; without labels every score is one half.  Only the text is an input
    of a score; extra columns are not looked at.
    """
    scored = docs.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), score_udf(train(docs, labels, rows))("text").alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def keep_good(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` without the rows that the classifier rejects; all columns stay."""
    return docs.filter(score_udf(train(docs, labels, rows))("text") >= THRESHOLD)
