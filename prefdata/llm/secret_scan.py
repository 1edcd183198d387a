"""Operator 4: secret scan, candidates by pattern and a random forest that removes false positives.

Features of a candidate: its length, how likely its character transitions are
in the words of the whole corpus, how much of it dictionary words cover, how much it
looks like a path, and its neighbouring words.  The forest (Spark ML) is
trained on labelled findings; where none are given, labelling rules mark the
clear ones and the forest decides the rest.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefdata.llm.common import materialize

#: Labelled findings that the forest is fitted on at most (smallest hashes).
TRAIN_ROWS = 20_000
#: Share of all words (of all pairs of letters) that makes one a word of the dictionary (a known transition): so a million of each at most.
USUAL = 1e-6
#: Different words that a task holds before it passes their counts on.
WORDS_HELD = 200_000
#: Trees, depth and seed of the forest; buckets of the hashed neighbouring words; score from which a finding is a secret.
TREES, DEPTH, SEED, NEIGHBOURS, THRESHOLD = 24, 6, 42, 16, 0.5

WORD = re.compile(r"[^\W\d_]{2,24}")
CANDIDATE = re.compile(r"[A-Za-z0-9_/+=.-]{16,}")
ASSIGNED = re.compile(r"(?i)(?:token|secret|passw(?:or)?d|pwd|api.?key|access.?key|private.?key|auth|bearer)[\"']?\s*[:=]?\s*[\"']?$")
#: A value of six or more characters right after a secret's name and ``:`` or ``=``.
NAMED = re.compile(r"(?i)(?:token|secret|passw(?:or)?d|pwd|api.?key|access.?key|private.?key|auth)[\"']?\s*[:=]\s*[\"']?([^\s\"'<>,;]{6,})")
PLACEHOLDER = re.compile(r"(?i)(.)\1{7}|x{4,}|example|0123456789|abcdefgh|your")


class Language:
    """Dictionary and character transitions of the corpus's words."""

    def __init__(self, words: list[str], pairs: list[tuple[str, int]]):
        self.words = {w for w in words if len(w) >= 4}
        self.longest = max(map(len, self.words), default=0)
        pairs, singles = dict(pairs), Counter()
        for p, c in pairs.items():
            singles[p[0]] += c
        self.log = {p: math.log((c + 0.5) / (singles[p[0]] + 20)) for p, c in pairs.items()}
        self.rare = math.log(0.5 / 1000)

    def transitions(self, s: str) -> float:
        s = s.lower()
        return sum(self.log.get(s[i: i + 2], self.rare) for i in range(len(s) - 1)) / max(1, len(s) - 1)

    def coverage(self, s: str) -> float:
        s, i, covered = s.lower(), 0, 0
        while i < len(s):
            for n in range(min(self.longest, len(s) - i), 3, -1):
                if s[i: i + n] in self.words:
                    covered += n
                    i += n
                    break
            else:
                i += 1
        return covered / max(1, len(s))


def entropy(s: str) -> float:
    return -sum(c / len(s) * math.log2(c / len(s)) for c in Counter(s).values())


def vector(token: str, left: str, right: str, language: Language) -> list[float]:
    n = len(token)
    digits, upper = sum(c.isdigit() for c in token), sum(c.isupper() for c in token)
    x = [math.log(n), language.transitions(token), language.coverage(token), token.count("/") + token.count(".") / 2,
         1.0 if "://" in left[-8:] + token or token.startswith(("/", "./")) else 0.0, digits / n, upper / n, entropy(token),
         1.0 if re.fullmatch(r"[0-9a-fA-F]+", token) else 0.0, 1.0 if re.search(r"[:=]\s*[\"']?$", left) else 0.0,
         1.0 if left[-1:] in "\"'" and left else 0.0, 1.0 if right[:1] in "\"'" and right else 0.0]
    for words, near in ((re.findall(r"\w+", left)[-2:], 0), (re.findall(r"\w+", right)[:1], 1)):
        hashed = [0.0] * NEIGHBOURS
        for w in words:
            hashed[xxhash.xxh32_intdigest(f"{near}{w.lower()}") % NEIGHBOURS] = 1.0
        x += hashed
    return x


def labelled(token: str, left: str, language: Language) -> int | None:
    """1 for a mixed token that is assigned to a secret's name, 0 for numbers, paths, words and placeholders, else None."""
    if token.isdigit() or token.count("/") >= 2 or PLACEHOLDER.search(token) or language.coverage(token) >= 0.6:
        return 0
    if ASSIGNED.search(left) and any(c.isdigit() for c in token) and any(c.isalpha() for c in token) and entropy(token) >= 3:
        return 1
    return None


def candidates(text: str | None):
    """(start, stop, token, left context, right context) of every candidate of a text.

    Named values of any form, and long tokens with a digit or mixed case outside them.
    """
    text = text or ""
    spans = [(m.start(1), m.start(1) + max(6, len(m.group(1).rstrip(".)")))) for m in NAMED.finditer(text)]
    named, at = list(spans), 0
    for m in CANDIDATE.finditer(text):
        while at < len(named) and named[at][1] <= m.start():
            at += 1
        token, free = m.group(), at == len(named) or named[at][0] >= m.end()
        if free and (any(c.isdigit() for c in token) or (token.lower() != token and token.upper() != token and not token.istitle())):
            spans.append(m.span())
    for start, stop in sorted(spans):
        yield start, stop, text[start:stop], text[max(0, start - 32): start], text[stop: stop + 32]


def _count_words(batches):
    """(text) -> (w, n): words of a task's texts, added up in a table that is passed on when it is full."""
    held = Counter()

    def out():
        full = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["w", "n"])
        held.clear()
        return full
    for batch in batches:
        for text in batch.column(0).to_pylist():
            held.update(WORD.findall((text or "").lower()))
            if len(held) >= WORDS_HELD:
                yield out()
    if held:
        yield out()


def dictionary(docs: DataFrame, usual: float = USUAL) -> Language:
    """Words and transitions of letters counted over all documents; those that make up ``usual`` of all or more are known."""
    counted = docs.select("text").mapInArrow(_count_words, "w string, n long")
    words = materialize(counted.groupBy("w").agg(F.sum("n").alias("n")), "secrets-words")
    pairs = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substring("w", i, F.lit(2)))).alias("w"), "n")
    pairs = materialize(pairs.groupBy("w").agg(F.sum("n").alias("n")), "secrets-pairs")

    def known(counts):
        total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        return [(r["w"], r["n"]) for r in counts.filter(F.col("n") >= usual * total).collect()]
    return Language([w for w, _ in known(words)], known(pairs))


FOUND = "doc_id long, start int, stop int, token_sha256 string, label int, x array<double>"


def findings(docs: DataFrame, language: Language) -> DataFrame:
    """One row per candidate: place (code points), hash of the token, label by rule or null, features."""
    import hashlib

    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("token_sha256", pa.string()),
                        ("label", pa.int32()), ("x", pa.list_(pa.float64()))])

    shipped = docs.sparkSession.sparkContext.broadcast(language)

    def find(batches):
        language = shipped.value
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for start, stop, token, left, right in candidates(text):
                    rows.append({"doc_id": doc, "start": start, "stop": stop, "token_sha256": hashlib.sha256(token.encode()).hexdigest(),
                                 "label": labelled(token, left, language), "x": vector(token, left, right, language)})
                    if len(rows) >= 20_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(find, FOUND)


def secrets(docs: DataFrame, labels: DataFrame | None = None, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, start, stop, token_sha256, score and is_secret of every candidate in ``docs``.

    ``labels`` (token_sha256, label 0/1) are labelled findings; without them the
    labelling rules are used.  Where they do not show both classes, every score
    is one half and every candidate stays.  Null and empty texts have no
    candidates; repeated rows repeat theirs; extra columns are not looked at.
    """
    docs = docs.select("doc_id", "text")
    found = materialize(findings(docs, dictionary(docs)), "secrets")
    if labels is not None:
        given = labels.filter("label IS NOT NULL").groupBy("token_sha256").agg(F.max("label").cast("int").alias("label"))
        known = found.drop("label").join(given, "token_sha256")
    else:
        known = found.filter("label IS NOT NULL")
    order = F.xxhash64("doc_id", "start", "token_sha256")
    known = known.select(F.col("label").cast("double").alias("label"), array_to_vector("x").alias("features"), order.alias("h"), "x")
    train = known.orderBy("h", "label", "x").limit(rows).select("label", "features").coalesce(1)  # at most `rows` rows
    train = materialize(train, "secrets-train")
    if train.select("label").distinct().count() < 2:
        scored = found.withColumn("score", F.lit(0.5))
    else:
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.8, maxBins=32)
        model = forest.fit(train)
        scored = model.transform(found.drop("label").withColumn("features", array_to_vector("x"))).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "start", "stop", "token_sha256", "score", (F.col("score") >= THRESHOLD).alias("is_secret"))


def redact(docs: DataFrame, labels: DataFrame | None = None, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret replaced by ``mask``; all rows and columns stay.

    Rows may share an id, or have none: a span is masked where the text there is
    the secret itself (by its hash), so another text of the same id is left alone.
    """
    bad = secrets(docs, labels).filter("is_secret").groupBy(F.col("doc_id").alias("__llm_id")).agg(F.collect_set(F.struct("start", "stop", "token_sha256")).alias("__llm_all"))
    joined = docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["__llm_id"]), "left")
    own = F.filter("__llm_all", lambda s: F.sha2(F.substring(F.col("text"), s["start"] + 1, s["stop"] - s["start"]), 256) == s["token_sha256"])
    joined = joined.withColumn("__llm_spans", F.sort_array(own))
    init = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    step = lambda acc, s: F.struct(F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask)).alias("out"), s["stop"].alias("at"))
    done = F.aggregate("__llm_spans", init, step, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    return joined.withColumn("text", F.when(F.col("__llm_spans").isNull(), F.col("text")).otherwise(done)).select(*docs.columns)


__all__ = ["Language", "candidates", "dictionary", "findings", "redact", "secrets"]
