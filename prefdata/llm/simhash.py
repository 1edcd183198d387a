"""Operator 10: near-duplicate documents by SimHash, compared exactly within a Hamming radius."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from prefdata.llm.common import materialize
from prefdata.llm.components import connected_components
from prefdata.llm.hamming import links

#: Production parameters: words in a shingle, bits that linked fingerprints may differ in, segments of the 64 bits.
SHINGLE, RADIUS, BLOCKS = 4, 4, 6
SEED = 42
#: Shingles hashed at a time, so that a text of any length needs bounded memory.
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    n = max(1, len(words) - shingle + 1)
    last = end[shingle - 1:] if len(words) >= shingle else end[-1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, n, CHUNK):
        at = zip(start[i: min(i + CHUNK, n)].tolist(), last[i: i + CHUNK].tolist())
        h = np.array([digest(joined[s:e], SEED) for s, e in at], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprint_udf(shingle: int):
    @pandas_udf("long")
    def fp(text: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in text], np.uint64).view(np.int64))
    return fp


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``doc_id``, ``text_key`` (hash of the text), ``fp``, ``root`` (group), ``component_id`` for every row of ``docs``.

    Null and empty texts have fingerprint 0 and are linked like any other.
    Exact copies meet in one fingerprint row before anything is compared.
    Repeated rows keep a row each; ``component_id`` is the smallest ``doc_id``
    of the group (null ids are not counted).  Other columns are not looked at.
    """
    own = materialize(docs.select("doc_id", F.xxhash64("text").alias("text_key"),
                                  fingerprint_udf(shingle)("text").alias("fp")), "simhash")
    reps = materialize(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-reps")
    tree = connected_components(links(reps, radius, blocks))
    group = reps.join(tree, reps["fp"] == tree["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    group = materialize(group, "simhash-groups")
    ids = group.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = group.join(ids, "root").select("fp", "root", "component_id")
    return own.join(linked, "fp", "left").select("doc_id", "text_key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest ``(doc_id, hash of the text)``.

    Repeated rows count as copies, so one stays.  All columns of ``docs`` are kept.
    """
    groups = simhash_groups(docs, shingle, radius, blocks)
    best = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("best"))
    best = best.select(F.col("best.doc_id").alias("__llm_id"),
                       F.xxhash64("best.doc_id", "best.text_key").alias("__llm_best")).distinct()
    keyed = docs.withColumn("__llm_row", F.xxhash64(F.col("doc_id"), F.xxhash64("text")))
    kept = keyed.join(best, (keyed["__llm_row"] == best["__llm_best"]) & keyed["doc_id"].eqNullSafe(best["__llm_id"]), "left_semi")
    # Hashed on the row key already: only rows that repeat an id and a text meet here.
    return kept.dropDuplicates(["__llm_row", "doc_id"]).drop("__llm_row")


def fingerprint_hex(fp):
    """16 lowercase hexadecimal digits of a fingerprint column."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
