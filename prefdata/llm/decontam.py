"""Operator 3: benchmark decontamination by a broadcast hash set of normalised n-grams, DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefdata.llm.common import LOWER, UPPER, cased_hit_words, hit_words, lower_ascii, materialize, row_key

#: Words in a window; an item of fewer words is one window.
WINDOW = 10
#: Distinct benchmark windows up to which they are broadcast (some 100 bytes each); more are joined by a shuffle.
BROADCAST_GRAMS = 500_000

#: A word with the separators before it, as it stands in the text.
CHUNK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _windows(texts: DataFrame, sizes: list[int]) -> DataFrame:
    """(key, w) -> (key, w, pos, len) for every window of each of the sizes."""
    # The outer form: for the inner one Spark would split every text once more, to filter out those without a window.
    spots = F.when(F.size("w") >= sizes[0], F.sequence(F.lit(0), F.size("w") - sizes[0]))
    places = texts.select("key", "w", F.explode_outer(spots).alias("pos"))
    if len(sizes) == 1:
        return places.select("key", "w", "pos", F.lit(sizes[0]).alias("len")).filter("pos IS NOT NULL")
    return places.select("key", "w", "pos", F.explode(F.array(*map(F.lit, sizes))).alias("len")).filter(F.col("pos") + F.col("len") <= F.size("w"))


def _ends(w, pos, size, word):
    """Hash of a window's first, last and middle word."""
    return F.xxhash64(size, *[word(F.get(w, i)) for i in (pos, pos + size - 1, pos + F.shiftright(size, 1))])


def benchmark_grams(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (gram, len, item) of the benchmark; items without words have none."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), hit_words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    own = F.least(F.size("w"), F.lit(window))
    grams = F.transform(F.sequence(F.lit(0), F.size("w") - F.col("n")), lambda i: F.array_join(F.slice("w", i + 1, F.col("n")), " "))
    return items.select("item", "w", own.alias("n")).select("item", F.col("n").alias("len"), F.explode(grams).alias("gram")).distinct()


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(row key, pos, len, gram) of every benchmark window in ``docs``, and the (gram, item) table.

    A window's text is the join key itself, so a probe of the hash set that
    succeeds is already verified word by word.  The text is made only of windows
    whose first, last and middle word are those of a benchmark window.
    """
    grams = materialize(benchmark_grams(benchmark, window), "grams")
    sizes = {r["len"]: r["n"] for r in grams.groupBy("len").agg(F.countDistinct("gram").alias("n")).collect()}  # window rows at most
    texts = docs.select(row_key().alias("key"), cased_hit_words(F.col("text")).alias("w"))
    places = _windows(texts, sorted(sizes) or [window])
    known = grams.select("gram").distinct()
    if sum(sizes.values()) <= BROADCAST_GRAMS:
        ends = grams.select(_ends(F.split("gram", " "), F.lit(0), F.col("len"), lambda x: x).alias("ends")).distinct()
        places = places.withColumn("ends", _ends(F.col("w"), F.col("pos"), F.col("len"), lower_ascii)).join(F.broadcast(ends), "ends", "left_semi")
        known = F.broadcast(known)
    gram = lower_ascii(F.array_join(F.slice("w", F.col("pos") + 1, F.col("len")), " "))
    # Never null, and said so: Spark would test it before the first probe, of every window.
    scanned = places.select("key", "pos", "len", F.coalesce(gram, F.lit("")).alias("gram"))
    return materialize(scanned.join(known, "gram", "left_semi"), "hits"), grams.select("gram", "item")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, key, hit_words (their indices).

    Null and empty texts have no words and are never hit.  Rows that repeat an
    id and a text repeat its result; repeated items count once, and an item
    without an id hits words but is not counted.  An empty benchmark hits
    nothing.  Extra columns are not looked at.
    """
    docs = docs.select("doc_id", "text")
    found, items = hits(docs, benchmark, window)
    spots = found.groupBy("key").agg(F.collect_set(F.struct("pos", "len")).alias("spans"))
    words = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["pos"], s["pos"] + s["len"] - 1))))
    which = found.select("key", "gram").distinct().join(items, "gram").select("key", "item").distinct()
    which = which.groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    hit = spots.select("key", words.alias("hit_words")).join(which, "key", "left")
    counted = docs.select("doc_id", row_key().alias("key"), F.size(cased_hit_words(F.col("text"))).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return counted.join(hit, "key", "left").select(
        "doc_id", "n_words", F.coalesce(F.size("hit_words"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
        F.col("hit_words").isNotNull().alias("contaminated"), "key", "hit_words")


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", window: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated documents (``mode='documents'``), or without the hit words (``'spans'``).

    Removing a span removes its words and the separators before each of them.
    All columns of ``docs`` stay; other documents are unchanged.
    """
    found, _ = hits(docs.select("doc_id", "text"), benchmark, window)
    keyed = docs.withColumn("__llm_row", row_key())
    if mode == "documents":
        return keyed.join(found.select(F.col("key").alias("__llm_row")).distinct(), "__llm_row", "left_anti").select(*docs.columns)
    if mode != "spans":
        raise ValueError(f"mode must be 'documents' or 'spans', not {mode!r}")
    spots = found.groupBy(F.col("key").alias("__llm_row")).agg(F.collect_set(F.struct("pos", "len")).alias("__llm_spans"))
    cut = F.array_distinct(F.flatten(F.transform("__llm_spans", lambda s: F.sequence(s["pos"], s["pos"] + s["len"] - 1))))
    chunks = F.regexp_extract_all("text", F.lit(CHUNK), F.lit(0))
    kept = F.filter("__llm_chunks", lambda c, i: ~F.array_contains("__llm_cut", i))
    tail = F.substring(F.col("text"), F.length(F.array_join("__llm_chunks", "")) + 1, F.length("text"))
    joined = keyed.join(spots.select("__llm_row", cut.alias("__llm_cut")), "__llm_row", "left")
    joined = joined.withColumn("__llm_chunks", F.when(F.col("__llm_cut").isNotNull(), chunks))
    text = F.when(F.col("__llm_cut").isNull(), F.col("text")).otherwise(F.concat(F.array_join(kept, ""), tail))
    return joined.withColumn("text", text).select(*docs.columns)


def _sql_words(column: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({column}, ''), '{UPPER}', '{LOWER}'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


def contamination_sql(window: int = WINDOW) -> str:
    """DuckDB text of the digest columns of :func:`contamination`."""
    return f"""
WITH d AS (SELECT doc_id, {_sql_words('text')} AS w FROM documents),
b AS (SELECT item_id, {_sql_words('text')} AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(len(w), {window}) AS n, unnest(list_transform(range(0, len(w) - least(len(w), {window}) + 1),
        lambda i: array_to_string(w[i + 1:i + least(len(w), {window})], ' '))) AS gram FROM b WHERE len(w) > 0),
s AS (SELECT DISTINCT n FROM g),
x AS (SELECT doc_id, n, unnest(range(0, len(w) - n + 1)) AS pos, w FROM d, s WHERE len(w) >= n),
h AS (SELECT DISTINCT x.doc_id, x.pos, x.n, g.gram, g.item_id FROM (SELECT doc_id, pos, n, array_to_string(w[pos + 1:pos + n], ' ') AS gram FROM x) x
      JOIN g ON x.gram = g.gram AND x.n = g.n),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM h) GROUP BY 1),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN i USING (doc_id)"""


__all__ = ["benchmark_grams", "contamination", "contamination_sql", "decontaminate", "hits"]
