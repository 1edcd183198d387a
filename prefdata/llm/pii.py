"""Operator 5: personal data by fixed rules, extended by bootstrapped contextual extraction; DataFrame functions only.

The entities that the fixed rules find are seeds.  Every identifier-like token
of the corpus (it has a digit or an at sign) is an instance; the word before
it and its character shape are its pattern.  Pattern and instance scores are
found in turns over the distinct (pattern, instance) pairs: a pattern is as
good as the share of its instances that are believed, an instance is believed
by the patterns it occurs in.  Occurrences of unseen instances in patterns
that score high enough are added to the fixed rules' spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefdata.llm.common import materialize, params_by_key, row_key

KINDS = ("email", "ip", "card", "phone")

# The patterns of the contract, with possessive groups (linear time, no deep recursion) and
# look-behinds that only forbid starts inside a run that cannot begin a leftmost match.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

#: An identifier-like token: white-space delimited, with a digit or an at sign; digit groups that follow it belong to it.
CANDIDATE = r"(?<![^\x20\x09-\x0D])(?=[^\x20\x09-\x0D]*[0-9@])[^\x20\x09-\x0D]++(?:\x20[0-9()][0-9().-]*+(?=[\x20\x09-\x0D]|$))*+"
#: Rounds of scoring; distinct seed instances a pattern needs; scores that patterns and instances need; added to a pattern's instances.
ROUNDS, SUPPORT, PATTERN_SCORE, INSTANCE_SCORE, PRIOR = 3, 5, 0.8, 0.8, 0.5
#: Digits that an unseen identifier needs at least (short numbers are no identifiers).
MIN_DIGITS = 6

SPAN = "struct<start:int,kind:int,stop:int>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    d = F.transform(F.split(F.reverse(_digits(m)), ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(d, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    return {"email": F.lit(True), "ip": m.rlike(f"^{PART}(?:\\.{PART}){{3}}$"),
            "card": F.when(n.between(14, 19), _luhn(m)).otherwise(False), "phone": n.between(10, 15)}[kind]


def _matches(text: Column, pattern: str, hint: str) -> tuple[Column, Column]:
    """Matches of a pattern and the pieces of text between them, where the text has the hint at all."""
    has, none = text.rlike(hint), F.array().cast("array<string>")
    return (F.when(has, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none),
            F.when(has, F.split(text, pattern, -1)).otherwise(none))


def _located(found: str, between: str) -> Column:
    """Array of (m, start, stop) in code points, from the columns of matches and of pieces between them."""
    init = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<m:string,start:int,stop:int>>").alias("out"))
    step = F.zip_with(F.col(found), F.slice(F.col(between), 1, F.size(found)), lambda m, b: F.struct(m.alias("m"), F.length(b).alias("gap")))

    def add(acc, x):
        start = acc["at"] + x["gap"]
        stop = start + F.length(x["m"])
        return F.struct(stop.alias("at"), F.concat(acc["out"], F.array(F.struct(x["m"].alias("m"), start.alias("start"), stop.alias("stop")))).alias("out"))
    return F.aggregate(step, init, add, lambda acc: acc["out"])


def _spans_text(spans: Column) -> Column:
    name = lambda k: F.element_at(F.array(*[F.lit(x) for x in KINDS]), k + 1)
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
        ":", name(s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _checked(k: int, kind: str) -> Column:
    """Spans (start, kind, stop) of the matches of a kind that pass its check."""
    return F.transform(F.filter(kind, lambda s: _valid(kind, s["m"])),
                       lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["stop"].alias("stop")))


def _count(k: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, key, base spans (array of start, kind, stop) and candidate tokens of every text; null counts as empty."""
    t = docs.select("doc_id", row_key().alias("key"), F.coalesce("text", F.lit("")).alias("t"))
    rules = [("email", EMAIL, "@"), ("ip", IP, r"[0-9]\.[0-9]"), ("card", CARD, "[0-9][ -]?[0-9]"), ("phone", PHONE, r"\+[0-9]"), ("cand", CANDIDATE, "[0-9@]")]
    cols = {}
    for kind, pattern, hint in rules:
        cols[f"{kind}_m"], cols[f"{kind}_b"] = _matches(F.col("t"), pattern, hint)
    t = t.select("*", *[c.alias(k) for k, c in cols.items()])
    t = t.select("doc_id", "key", "t", *[_located(f"{kind}_m", f"{kind}_b").alias(kind) for kind, _, _ in rules])
    per_kind = [_checked(k, kind) for k, kind in enumerate(KINDS)]
    t = t.select("doc_id", "key", "t", "cand", F.sort_array(F.concat(*per_kind)).alias("base"))
    before = lambda s: F.regexp_extract(F.substring(F.col("t"), F.greatest(s["start"] - 31, F.lit(1)), F.least(s["start"], F.lit(32))), r"([^\x20\x09-\x0D]*)[\x20\x09-\x0D]*$", 1)
    context = F.transform("cand", lambda s: F.struct(
        s["m"].alias("m"), s["start"].alias("start"), s["stop"].alias("stop"), F.lower(F.when(s["start"] > 0, before(s)).otherwise("")).alias("left")))
    return t.select("doc_id", "key", "base", context.alias("cand"))


def _shape(m: Column) -> Column:
    """Characters of the token by class (9 digit, a letter), runs of letters as one."""
    return F.regexp_replace(F.regexp_replace(m, "[0-9]", "9"), r"\p{L}+", "a")


def _scores(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct (pattern, kind, instance, seed) -> pattern scores (pid, kind, score, support) and instance scores (iid, kind, belief).

    For a pattern's score, what the pattern itself says about an instance does
    not count: an unseen instance is believed by its other patterns only.
    """
    sure = 1.0 - 1e-3
    votes = edges.withColumn("doubt", F.lit(0.0)).withColumn("own", F.lit(0.0))  # log of disbelief: all patterns', this one's
    patterns = beliefs = None
    for _ in range(ROUNDS):
        without = F.when(F.col("seed") == 1, 1.0).otherwise(1 - F.exp(F.col("doubt") - F.col("own")))
        patterns = materialize(votes.groupBy("pid", "kind").agg(
            (F.sum(without) / (F.count("*") + PRIOR)).alias("score"), F.sum("seed").alias("support")), "pii-patterns")
        good = patterns.filter((F.col("support") >= SUPPORT) & (F.col("score") >= 0.5)).select("pid", F.col("kind").alias("kind_p"), "score")
        by_edge = params_by_key(edges.withColumn("pk", F.xxhash64("pid", "kind")), good.select(F.xxhash64("pid", "kind_p").alias("pk"), "score"), "pk", F.col("iid"))
        by_edge = by_edge.withColumn("own", F.coalesce(F.log1p(-F.least("score", F.lit(sure))), F.lit(0.0))).withColumn("ik", F.xxhash64("iid", "kind"))
        by_edge = materialize(by_edge.select("pid", "iid", "kind", "seed", "own", "ik"), "pii-votes")
        beliefs = by_edge.groupBy("ik").agg(F.sum("own").alias("doubt"), F.max("seed").alias("seen"))
        votes = params_by_key(by_edge, beliefs.select("ik", "doubt"), "ik", F.col("pid"), "inner")
    told = beliefs.select("ik", F.greatest(F.col("seen").cast("double"), 1 - F.exp("doubt")).alias("belief"))
    return patterns, told


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone and base_sha256 of the fixed rules' spans; ``spans`` with the added ones, and n_added.

    Null and empty texts have no spans.  Repeated rows repeat their result and
    weigh nothing extra in the scores (those count distinct pairs).  Spans of
    one kind never overlap base spans of any kind when they are added.  Extra
    columns are not looked at.
    """
    own = materialize(base_spans(docs.select("doc_id", "text")), "pii")
    seen = own.filter(F.size("cand") > 0).select("key", "base", F.explode("cand").alias("c"))
    touching = F.filter("base", lambda b: (b["start"] < F.col("c.stop")) & (b["stop"] > F.col("c.start")))
    seen = seen.select("key", F.col("c.start").alias("start"), F.col("c.stop").alias("stop"),
                       F.xxhash64("c.m").alias("iid"), F.xxhash64("c.left", _shape(F.col("c.m"))).alias("pid"),
                       F.length(_digits(F.col("c.m"))).alias("n_digits"), F.transform(touching, lambda b: b["kind"]).alias("kinds"))
    seen = materialize(seen.distinct(), "pii-seen")
    links = seen.select("pid", "iid", F.array_distinct("kinds").alias("kinds")).distinct()
    kinds = links.select("pid", "iid", "kinds", F.explode(F.sequence(F.lit(0), F.lit(len(KINDS) - 1))).alias("kind"))
    edges = kinds.groupBy("pid", "iid", "kind").agg(F.max(F.array_contains("kinds", F.col("kind")).cast("int")).alias("seed"))
    seeded = edges.filter("seed = 1").select("pid", "kind").distinct().withColumnRenamed("kind", "kind_s")
    edges = params_by_key(edges, seeded, "pid", F.col("iid"), "inner").filter("kind = kind_s").select("pid", "iid", "kind", "seed")
    edges = materialize(edges, "pii-edges")
    patterns, belief = _scores(edges)
    sure = patterns.filter((F.col("score") >= PATTERN_SCORE) & (F.col("support") >= SUPPORT)).select("pid", "kind")
    new = params_by_key(seen.filter((F.size("kinds") == 0) & (F.col("n_digits") >= MIN_DIGITS)), sure, "pid", F.col("key"), "inner")
    believed = belief.filter(F.col("belief") >= INSTANCE_SCORE).select("ik")
    new = params_by_key(new.withColumn("ik", F.xxhash64("iid", "kind")), believed, "ik", F.col("key"), "inner")
    added = new.groupBy("key").agg(F.collect_set(F.struct("start", "kind", "stop")).alias("added"))
    none = F.array().cast(f"array<{SPAN}>")
    both = own.select("doc_id", "key", "base").join(added, "key", "left")
    counts = [_count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return both.select("doc_id", *counts, F.sha2(_spans_text(F.col("base")), 256).alias("base_sha256"),
                       _spans_text(F.concat(F.col("base"), F.coalesce("added", none))).alias("spans"),
                       F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_added"))
