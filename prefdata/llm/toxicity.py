"""Operator 11: toxicity by a convolutional text classifier.

A text is its sequence of lower-cased words; a word's embedding is the sum of
``HASHES`` rows of a hashed table, so that two words rarely share all of them.
Filters of one to ``WIDEST`` words slide over the whole text, each filter's
largest value is kept, and a dense layer on those gives the score.  Training is
Adam in numpy on every labelled row: rows are dealt to shards by the hash of
their id and text, a task trains on one shard, and between rounds the networks
of all shards are averaged (one shard needs no rounds).  The score is then
scaled by a logistic fit on a part of the labelled rows that training did not
see, and on the same part a threshold is calibrated for every language.
The language only chooses the threshold of ``flagged``: it is no input of the
score, nor of ``predicted``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from prefdata.llm.common import materialize
from prefdata.llm.quality import held_out
from prefdata.session import scratch_path

#: Labelled rows of a shard (about); all shards together hold every labelled row.
TRAIN_ROWS = 20_000
#: Rounds between which the networks of several shards are averaged, and parts of the table that are averaged side by side.
ROUNDS, TABLE_PARTS = 4, 32
#: Steps of a raw score in the calibration of several shards' network: all rows count, in one row per step and language.
RAW_STEPS = 1 << 12
#: Labels (two integers each) that are broadcast at most; more are joined by a shuffle.
BROADCAST_LABELS = 1_000_000
#: Rows of the embedding table, values of a row, rows that make a word's embedding.
BUCKETS, DIM, HASHES = 1 << 16, 8, 2
#: Words of the widest filter, and filters of each width.
WIDEST, FILTERS = 3, 12
#: Passes over the rows, words of a training batch (about), step size, decay of the weights.
EPOCHS, BATCH_WORDS, BATCH_ROWS, STEP, DECAY = 8, 1 << 15, 64, 0.02, 1e-4
#: Times that a text of the rarer label 1 counts, at most; the calibration undoes what this does to the scores' level.
RARE = 5.0
#: Words of texts scored at a time; longer texts are scored in pieces that overlap by WIDEST - 1 words.
SCORE_WORDS = 1 << 15
#: Score from which a text is predicted toxic, and labelled rows of a class that a language needs for a threshold of its own.
THRESHOLD, OWN_ROWS = 0.5, 20

#: ASCII characters other than letters and digits part words, A-Z are lower-cased, all others belong to words.
PARTS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
#: Row of the table for places beyond a text's ends; its embedding stays zero.
PAD = BUCKETS


class _WordRows(dict):
    """Rows of a word in the table, packed in one integer."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 19:
            self.clear()
        self[word] = x = xxhash.xxh3_64_intdigest(word) & (BUCKETS ** HASHES - 1)
        return x


_KNOWN = _WordRows()


def word_codes(text: str | None) -> np.ndarray:
    """One code per word of the whole text."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").translate(PARTS).split()
    return np.fromiter(map(_KNOWN.__getitem__, words), np.int64, len(words))


def _rows(codes: np.ndarray) -> np.ndarray:
    """(words, HASHES) rows of the table; the pad's where a code is negative."""
    rows = np.stack([(codes >> (16 * i)) & (BUCKETS - 1) for i in range(HASHES)], axis=1)
    return np.where(codes[:, None] < 0, PAD, rows)


def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts with WIDEST - 1 pads after each (one more for an empty one), and where each begins."""
    pads = [np.full(WIDEST - 1 + (len(t) == 0), -1, np.int64) for t in texts]
    sizes = np.array([len(t) + len(p) for t, p in zip(texts, pads)], np.int64)
    return np.concatenate([x for t, p in zip(texts, pads) for x in (t, p)]), np.cumsum(sizes) - sizes


class Network:
    """Embedding table, filters (words in a window x DIM, filters of all widths), their biases and the dense layer."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.table = (0.1 * rng.standard_normal((BUCKETS + 1, DIM))).astype(np.float32)
        self.table[PAD] = 0
        n = WIDEST * FILTERS
        self.filters = (0.5 * rng.standard_normal((WIDEST * DIM, n))).astype(np.float32)
        for w in range(1, WIDEST):  # narrow filters look at their first words only
            self.filters[w * DIM:, (w - 1) * FILTERS: w * FILTERS] = 0
        self.mask = (self.filters != 0).astype(np.float32)
        self.bias, self.dense = np.zeros(n, np.float32), (0.3 * rng.standard_normal(n)).astype(np.float32)
        self.base, self.scale, self.shift = np.float32(-2.0), 1.0, 0.0

    def windows(self, codes: np.ndarray) -> np.ndarray:
        """(places, WIDEST * DIM) embeddings of the words from each place on."""
        e = self.table[_rows(codes)].sum(1)
        e = np.concatenate([e, np.zeros((WIDEST - 1, DIM), np.float32)])
        return np.concatenate([e[i: len(codes) + i] for i in range(WIDEST)], axis=1)

    def pooled(self, texts: list[np.ndarray]) -> np.ndarray:
        """(texts, filters) largest value of each filter, at least 0."""
        codes, begin = _joined(texts)
        value = self.windows(codes) @ self.filters + self.bias
        return np.maximum(np.maximum.reduceat(value, begin, axis=0), 0)

    def raw(self, texts: list[np.ndarray]) -> np.ndarray:
        """Scores before the logistic function, of texts of any length in pieces."""
        out, held, of, size = np.zeros((len(texts), WIDEST * FILTERS), np.float32), [], [], 0

        def flush():
            np.maximum.at(out, np.array(of), self.pooled(held))
            held.clear()
            of.clear()
        for i, t in enumerate(texts):
            for at in range(0, max(1, len(t)), SCORE_WORDS):
                held.append(t[at: at + SCORE_WORDS + WIDEST - 1])
                of.append(i)
                size += len(held[-1])
                if size >= SCORE_WORDS:
                    flush()
                    size = 0
        if held:
            flush()
        return out @ self.dense + self.base

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.raw(texts).astype(np.float64) + self.shift, -30, 30)))


class _Adam:
    def __init__(self, *values: np.ndarray):
        self.m, self.v, self.n = [np.zeros_like(x) for x in values], [np.zeros_like(x) for x in values], 0

    def step(self, values, grads, at=None):
        """One step; ``at`` (for each value, or None) limits it to some rows."""
        self.n += 1
        for x, g, m, v, rows in zip(values, grads, self.m, self.v, at or [None] * len(values)):
            rows = slice(None) if rows is None else rows
            m[rows] = 0.9 * m[rows] + 0.1 * g
            v[rows] = 0.999 * v[rows] + 0.001 * g * g
            x[rows] -= STEP * (m[rows] / (1 - 0.9 ** self.n) / (np.sqrt(v[rows] / (1 - 0.999 ** self.n)) + 1e-6) + DECAY * x[rows])


def gradients(net: Network, texts: list[np.ndarray], y: np.ndarray, rare: float = 1.0):
    """Gradients of the mean logistic loss, in which a text of label 1 counts ``rare`` times: (filters, bias, dense, base) and, of the table, (rows, gradients)."""
    codes, begin = _joined(texts)
    x = net.windows(codes)
    value = x @ net.filters + net.bias
    sizes = np.diff(np.append(begin, len(codes)))
    best = np.maximum.reduceat(value, begin, axis=0)
    # The first place of each text and filter that has the largest value.
    hit = np.where(value == np.repeat(best, sizes, axis=0), np.arange(len(codes))[:, None], len(codes))
    at = np.minimum.reduceat(hit, begin, axis=0)
    pooled = np.maximum(best, 0)
    p = 1 / (1 + np.exp(-(pooled @ net.dense + net.base)))
    d = ((p - y) * np.where(y > 0, rare, 1) / len(y)).astype(np.float32)
    back = d[:, None] * net.dense * (best > 0)
    seen = x[at]  # (texts, filters, window)
    g_filters = np.einsum("tfw,tf->wf", seen, back) * net.mask
    g_seen = back[:, :, None] * net.filters.T[None]
    place = at[:, :, None] + np.arange(WIDEST)
    g_word = g_seen.reshape(*back.shape, WIDEST, DIM).reshape(-1, DIM)
    word = np.append(codes, np.full(WIDEST, -1))[place].reshape(-1)
    g_word, word = g_word[word >= 0], word[word >= 0]
    rows, of = np.unique(_rows(word).reshape(-1), return_inverse=True)
    g_rows = np.zeros((len(rows), DIM), np.float32)
    np.add.at(g_rows, of.reshape(-1), np.repeat(g_word, HASHES, axis=0))
    return (g_filters, back.sum(0), pooled.T @ d, d.sum()), (rows, g_rows)


def _rare(n: int, ones: float) -> float:
    return float(np.clip((n - ones) / max(1, ones), 1, RARE))


def _base(n: int, ones: float) -> np.float32:
    return np.float32(np.log((ones + 1) / (n - ones + 1)))


def used_rows(texts: list[np.ndarray]) -> np.ndarray:
    """Which rows of the table the words of the texts use."""
    used = np.zeros(BUCKETS + 1, bool)
    for t in texts:
        used[_rows(t).reshape(-1)] = True
    return used


def fit(texts: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> Network:
    """Train on texts (word codes) and 0/1 labels; words that no text has get a zero embedding."""
    net = Network(seed)
    net.table[~used_rows(texts)] = 0
    if not len(y):
        return net
    net.base = _base(len(y), y.sum())
    return fit_on(net, texts, y, _rare(len(y), y.sum()), epochs, seed)


def fit_on(net: Network, texts: list[np.ndarray], y: np.ndarray, rare: float, epochs: int, seed: int) -> Network:
    """Train ``net`` further; a text of label 1 counts ``rare`` times."""
    rng = np.random.default_rng(seed)
    base = np.array([net.base], np.float32)
    adam, sparse = _Adam(net.filters, net.bias, net.dense, base), _Adam(net.table)
    for _ in range(epochs):
        order, batch, size = rng.permutation(len(texts)), [], 0
        for k, i in enumerate(order):
            batch.append(i)
            size += len(texts[i])
            if len(batch) >= BATCH_ROWS or size >= BATCH_WORDS or k == len(order) - 1:
                net.base = base[0]
                (gf, gb, gd, g0), (rows, g_rows) = gradients(net, [texts[j] for j in batch], y[batch], rare)
                adam.step([net.filters, net.bias, net.dense, base], [gf, gb, gd, np.array([g0], np.float32)])
                sparse.step([net.table], [g_rows], [rows])
                batch, size = [], 0
    net.base = base[0]
    return net


def calibrate(z: np.ndarray, y: np.ndarray, n: np.ndarray | float = 1.0) -> tuple[float, float]:
    """Scale (above 0) and shift of a logistic fit of labels on raw scores that stand for ``n`` rows each: Newton's method with halved steps, slightly held to 1 and 0."""
    def loss(a, b):
        t = a * z + b
        return (n * (np.logaddexp(0, t) - y * t)).sum() + (a - 1) ** 2 / 2 + 0.05 * b * b
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = n * (p * (1 - p) + 1e-9)
        g = np.array([(n * (p - y) * z).sum() + (a - 1), (n * (p - y)).sum() + 0.1 * b])
        h = np.array([[(w * z * z).sum() + 1, (w * z).sum()], [(w * z).sum(), w.sum() + 0.1]])
        step, now = np.linalg.solve(h, g), loss(a, b)
        while np.abs(step).max() > 1e-9 and (a - step[0] <= 0.01 or loss(a - step[0], b - step[1]) > now):
            step = step / 2
        if np.abs(step).max() <= 1e-9:
            break
        a, b = a - step[0], b - step[1]
    return float(a), float(b)


def threshold(score: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> float:
    """The score from which flagging gives the best F1, half-way to the next lower score; a score stands for ``n`` rows (one each without)."""
    n = np.ones(len(score)) if n is None else n
    order = np.argsort(-score, kind="stable")
    s, hits = score[order], np.cumsum((y * n)[order])
    f1 = 2 * hits / (np.cumsum(n[order]) + (y * n).sum())
    f1[:-1][s[:-1] == s[1:]] = -1  # equal scores go together
    k = int(np.argmax(f1))
    return float((s[k] + s[k + 1]) / 2 if k + 1 < len(s) else s[k])


def _pickled(net: Network, by_lang: dict) -> bytes:
    import io

    out = io.BytesIO()
    np.savez_compressed(out, table=net.table.astype(np.float16), filters=net.filters, bias=net.bias, dense=net.dense,
                        rest=np.array([net.base, net.scale, net.shift], np.float64),
                        langs=np.array([k.encode("utf-8", "surrogatepass").hex() for k in by_lang] or [""]), cuts=np.array(list(by_lang.values()) or [THRESHOLD]))
    return out.getvalue()


def load(model: bytes) -> tuple[Network, dict[str, float]]:
    """The network and the thresholds by language ('' for any other) of :func:`train`."""
    import io

    data, net = np.load(io.BytesIO(model)), Network.__new__(Network)
    net.table, net.filters, net.bias, net.dense = data["table"].astype(np.float32), data["filters"], data["bias"], data["dense"]
    net.base, net.scale, net.shift = np.float32(data["rest"][0]), float(data["rest"][1]), float(data["rest"][2])
    return net, {bytes.fromhex(str(k)).decode("utf-8", "surrogatepass"): float(c) for k, c in zip(data["langs"], data["cuts"])}


def _constant(n: int, ones: float) -> bytes:
    """The model of labels with nothing to tell apart: every score is the share of label 1."""
    net = Network()
    net.table[:], net.dense[:], net.scale = 0, 0, 1.0
    net.base = _base(n, ones)
    return _pickled(net, {"": THRESHOLD})


def _train_rows(pdf: pd.DataFrame) -> pd.DataFrame:
    """The model of labelled rows that one task holds."""
    pdf = pdf.sort_values(["h", "t"], kind="stable")
    texts = [_codes(x) for x in pdf["codes"]]
    y, check = pdf["toxic"].to_numpy(np.float64), pdf["check"].to_numpy(bool)
    if not len(y) or y.min() == y.max():
        return pd.DataFrame({"model": [_constant(len(y), y.sum())]})
    net = fit([t for t, c in zip(texts, check) if not c], y[~check])
    by_lang = {"": THRESHOLD}
    if check.any() and y[check].min() < y[check].max():
        z = net.raw([t for t, c in zip(texts, check) if c]).astype(np.float64)
        net.scale, net.shift = calibrate(z, y[check])
        score = 1 / (1 + np.exp(-np.clip(net.scale * z + net.shift, -30, 30)))
        by_lang[""] = threshold(score, y[check])
        lang = pdf["lang"].to_numpy(object)[check]
        for x in sorted({v for v in lang if v is not None}):
            own = lang == x
            if min(y[check][own].sum(), (1 - y[check][own]).sum()) >= OWN_ROWS:
                by_lang[x] = threshold(score[own], y[check][own])
    return pd.DataFrame({"model": [_pickled(net, by_lang)]})


def _codes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint32).astype(np.int64)


def _small(net: Network) -> np.ndarray:
    return np.concatenate([net.filters.reshape(-1), net.bias, net.dense, [net.base]]).astype(np.float32)


def _set_small(net: Network, x: np.ndarray) -> None:
    f, n = net.filters.size, len(net.bias)
    net.filters, net.bias, net.dense, net.base = x[:f].reshape(net.filters.shape).copy(), x[f: f + n].copy(), x[f + n: f + 2 * n].copy(), x[-1]


def _average(pdf: pd.DataFrame) -> pd.DataFrame:
    """One part of the networks of all shards -> its average; rows of the table over the shards that use them, all else by rows."""
    pdf, part = pdf.sort_values("shard"), int(pdf["part"].iloc[0])
    total, weight = 0.0, 0.0
    for data, used, n in zip(pdf["data"], pdf["used"], pdf["n"]):
        x = np.frombuffer(data, np.float32).astype(np.float64)
        w = float(n)
        if part < TABLE_PARTS:
            x, w = x.reshape(-1, DIM), w * np.frombuffer(used, bool)[:, None]
        total, weight = total + w * x, weight + w
    mean = total / np.where(weight > 0, weight, 1) if part < TABLE_PARTS else total / weight
    return pd.DataFrame({"part": [part], "data": [mean.astype(np.float32).tobytes()]})


def _shards(rows: DataFrame, shards: int) -> DataFrame:
    """One row per shard, (shard, rows in the order of ``h`` and ``t``), written once for all rounds: a file each, so that tasks take whole shards."""
    row = F.struct("h", "t", "toxic", "codes")
    dealt = rows.groupBy(F.pmod(F.xxhash64("h", "t"), F.lit(shards)).cast("int").alias("shard")).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    path = scratch_path(rows.sparkSession, "toxicity-shards")
    dealt.write.option("maxRecordsPerFile", 1).parquet(path)
    return rows.sparkSession.read.parquet(path)


def _train_shards(rows: DataFrame, shards: int) -> Network:
    """The network trained on all ``rows``: in every round each shard's task goes on from the average of the last.

    The rows are shuffled once; what is shuffled in a round are the shards' networks.
    """
    sc = rows.sparkSession.sparkContext
    n, ones = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0)).cast("double")).first()
    net, rare = Network(), _rare(n, ones)
    net.base = _base(n, ones)
    if not n:
        return net
    dealt = _shards(rows, shards)
    for nth in range(ROUNDS):
        epochs, seed = EPOCHS * (nth + 1) // ROUNDS - EPOCHS * nth // ROUNDS, 11 + nth
        shared = sc.broadcast((net.table, _small(net)))  # about 2 MB

        def train_shard(batches):
            for batch in batches:
                for k, shard in enumerate(batch.column(0).to_pylist()):
                    held = batch.column(1)[k].values  # the shard's rows
                    texts, own = [np.frombuffer(x.as_buffer(), np.uint32).astype(np.int64) for x in held.field("codes")], Network()
                    own.table = shared.value[0].copy()
                    _set_small(own, shared.value[1])
                    fit_on(own, texts, held.field("toxic").to_numpy(zero_copy_only=False).astype(np.float64), rare, epochs, seed)
                    used = np.split(used_rows(texts)[:PAD], TABLE_PARTS)
                    data = [x.tobytes() for x in np.split(own.table[:PAD], TABLE_PARTS)] + [_small(own).tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array(range(TABLE_PARTS + 1), pa.int32()), pa.array([shard] * (TABLE_PARTS + 1), pa.int32()),
                                                      pa.array([float(len(texts))] * (TABLE_PARTS + 1)), pa.array(data, pa.binary()),
                                                      pa.array([x.tobytes() for x in used] + [b""], pa.binary())], names=["part", "shard", "n", "data", "used"])
        trained = dealt.mapInArrow(train_shard, "part int, shard int, n double, data binary, used binary")
        parts = {r["part"]: r["data"] for r in trained.groupBy("part").applyInPandas(_average, "part int, data binary").collect()}  # one network
        net.table[:PAD] = np.concatenate([np.frombuffer(parts[k], np.float32).reshape(-1, DIM) for k in range(TABLE_PARTS)])
        _set_small(net, np.frombuffer(parts[TABLE_PARTS], np.float32))
    return net


def _calibrate_shards(net: Network, rows: DataFrame) -> bytes:
    """The model of a network calibrated on all ``rows``, counted by steps of the raw score."""
    shared = rows.sparkSession.sparkContext.broadcast(net)

    @pandas_udf("double")
    def raw(codes: pd.Series) -> pd.Series:
        z = np.clip(shared.value.raw([_codes(x) for x in codes]).astype(np.float64), -64, 64)
        return pd.Series(np.round(z * RAW_STEPS) / RAW_STEPS)
    counts = materialize(rows.select(raw("codes").alias("z"), F.col("toxic").cast("double").alias("y"), "lang")
                         .groupBy("z", "y", "lang").agg(F.count(F.lit(1)).cast("double").alias("n")), "toxicity-scores")
    fitted = counts.groupBy("z", "y").agg(F.sum("n").alias("n")).groupBy(F.lit(0).alias("all")).applyInPandas(
        lambda pdf: pd.DataFrame([calibrate(*(pdf.sort_values(["z", "y"])[c].to_numpy() for c in ("z", "y", "n")))
                                  if pdf["y"].nunique() > 1 else (None, None)], columns=["scale", "shift"]), "scale double, shift double").first()
    if not fitted or fitted["scale"] is None:
        return _pickled(net, {"": THRESHOLD})
    net.scale, net.shift = scale, shift = fitted["scale"], fitted["shift"]

    def cut(pdf):
        z, y, n = (pdf.sort_values(["z", "y"])[c].to_numpy() for c in ("z", "y", "n"))
        score = 1 / (1 + np.exp(-np.clip(scale * z + shift, -30, 30)))
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "cut": [threshold(score, y, n)]})
    every = counts.groupBy("z", "y").agg(F.sum("n").alias("n")).select(F.lit("").alias("lang"), "z", "y", "n")
    both = counts.groupBy("lang").agg(F.sum(F.col("n") * F.col("y")).alias("a"), F.sum(F.col("n") * (1 - F.col("y"))).alias("b"))
    own = counts.join(both.filter((F.least("a", "b") >= OWN_ROWS) & (F.col("lang") != "")).select("lang"), "lang").select("lang", "z", "y", "n")
    cuts = every.unionByName(own).groupBy("lang").applyInPandas(cut, "lang string, cut double").collect()  # a row per language
    by_lang = {r["lang"]: r["cut"] for r in cuts}
    return _pickled(net, {"": by_lang.pop("")} | dict(sorted(by_lang.items())))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> bytes:
    """The model, fitted on every labelled document outside the held-out fold, about ``rows`` of them in a task.

    Labels without an id or a toxicity are left out; of several labels of an id
    the largest counts.  One row in eight calibrates; whole texts are taken.
    """
    learn = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), 5, 0))
    learn = materialize(learn.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "toxicity-labels")
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    few = learn.count() <= BROADCAST_LABELS
    picked = docs.select("doc_id", "text", lang.cast("string").alias("lang")).join(F.broadcast(learn) if few else learn, "doc_id")

    @pandas_udf("binary")
    def codes(text: pd.Series) -> pd.Series:
        return pd.Series([word_codes(t).astype(np.uint32).tobytes() for t in text], dtype=object)
    every = picked.select(F.xxhash64("doc_id").alias("h"), F.xxhash64("text").alias("t"), "toxic", "lang", codes("text").alias("codes"),
                          (F.crc32(F.col("doc_id").cast("string")) % 8 == 0).alias("check"))
    every = materialize(every, "toxicity-rows")
    n, least, most, ones = every.agg(F.count(F.lit(1)), F.min("toxic"), F.max("toxic"), F.sum("toxic")).first()
    if not n or least == most:
        return _constant(n, float(ones or 0))
    if n <= rows:
        return materialize(every.groupBy(F.lit(0).alias("all")).applyInPandas(_train_rows, "model binary"), "toxicity-model").first()["model"]
    learned = every.filter(~F.col("check"))
    return _calibrate_shards(_train_shards(learned, -(-n // rows)), every.filter("check"))


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted and flagged for every row of ``docs``.

    ``predicted`` is 1 from a score of one half on, ``flagged`` from the
    threshold of the row's language on (the common one where the language is
    null or rare).  Null and empty texts are scored as texts without words;
    repeated rows repeat their score; without labels of both kinds every score
    is the share of label 1 (one half without any).  Extra columns are not
    looked at; a table without ``lang`` has the common threshold.
    """
    sc = docs.sparkSession.sparkContext
    model = train(docs, labels, rows)
    shared = sc.broadcast(model)  # about 1 MB, whatever the corpus
    loaded: list = []

    @pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        if not loaded:
            loaded.append(load(shared.value)[0])
        return pd.Series(loaded[0].score([word_codes(t) for t in text]))
    cuts = load(model)[1]
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    cut = F.lit(cuts[""])
    for k, v in cuts.items():
        if k:
            cut = F.when(lang == k, v).otherwise(cut)
    scored = docs.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), score("text").alias("score"), cut.alias("cut"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), (F.col("score") >= F.col("cut")).alias("flagged"))
