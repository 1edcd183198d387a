"""Plan A: scored Q&A threads -> exact split by question -> capped pairs -> cleaned text -> sharded Parquet.

Actions on the way: the small reads of the cut positions, the scratch tables of
the pair sampler and of the drawn texts, and the sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefdata.functions.text import clean_markdown, markdown_native, repair_utf8
from prefdata.operators import pairs as P
from prefdata.operators import split as S
from prefdata.operators.prompts import qa_text
from prefdata.operators.shards import SHARD_BYTES, shard_splits
from prefdata.session import materialize
from prefdata.sources import fixtures as FX
from prefdata.sources.sinks import write_and_read_sharded


def plain_clean(c):
    """T3 + T4 + T5 for text that is not HTML."""
    return clean_markdown(c)


def html_clean(c):
    """HTML to Markdown, then repaired UTF-8; null stays null."""
    return repair_utf8(markdown_native(c))


def paired_splits(answers: DataFrame, questions: DataFrame, seed=42, k: int = P.MAX_PAIRS, clean=plain_clean,
                  qid: str = "qid", aid: str = "aid", score: str = "score", text: str = "text") -> DataFrame:
    """Split questions 30/30/30/10 (O4), then build capped pairs (J3) with cleaned texts.

    Output: the question columns, ``split``, ``pair_no``, ``aid_j``, ``aid_k``,
    ``response_j``, ``response_k``.  Each answer is cleaned once, not once per pair.
    """
    qs = S.split_exact(questions, qid, seed)
    qs = qs.withColumn("question", clean(F.col("question"))) if "question" in qs.columns else qs
    ids = P.sample_pairs(answers, k, seed, qid, aid, score)
    return P.attach_texts(ids, answers, qs, qid, aid, text, clean)


def prepare_threads(threads: DataFrame, seed=42, k: int = P.MAX_PAIRS, clean=html_clean) -> DataFrame:
    """The reference's nested input (``answers: array<struct<pm_score, text>>``) through plan A with HTML cleaning."""
    flat = P.explode_threads(threads).withColumnRenamed("pm_score", "score")
    questions = threads.drop("answers")
    return paired_splits(flat, questions, seed, k, clean=clean)


def write_prepared(pairs: DataFrame, path: str, key: str = "pair_key", seed=42, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """K1-K5: contiguous size-based shards per split, written as ``split=/shard=`` folders plus a manifest.

    Pairs keep the split of their question; shards are contiguous and sorted in
    the seeded order of ``key`` inside each split.  The pairs are computed once.
    """
    return write_and_read_prepared(pairs, path, key, seed, shard_bytes)[0]


def write_and_read_prepared(pairs: DataFrame, path: str, key: str = "pair_key", seed=42,
                            shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """:func:`write_prepared`, and the rows as read back from the files."""
    keyed = materialize(pairs.withColumn(key, F.concat_ws("-", "qid", "pair_no")), "prepared")
    return write_and_read_sharded(shard_splits(keyed, key, seed=seed, shard_bytes=shard_bytes), path, order_by=S.ORDER_COL)


def prepared_threads(spark: SparkSession, threads: DataFrame, path: str, seed=42, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Plan A from nested threads to files and back: every pair with its split, shard, shard name and place in the shard's file."""
    manifest, back = write_and_read_prepared(prepare_threads(threads, seed), path, seed=seed, shard_bytes=shard_bytes)
    return back.withColumn("place", F.col("_metadata.row_index")).join(manifest.select("split", "shard", "name"), ["split", "shard"])


def paired_split_counts(spark: SparkSession, sf_dir: str, seed=42) -> DataFrame:
    """Flagship: fixture Q&A -> split by question -> capped pairs -> P4 text -> per split counts."""
    qa = FX.qa_answers(spark, sf_dir).withColumnRenamed("pm_score", "score")
    questions = FX.qa_questions(spark, sf_dir)
    pairs = paired_splits(qa, questions, seed)
    text = qa_text("question", "response_j")
    return pairs.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.countDistinct("qid").alias("n_questions"),
        F.sum(F.length(text)).alias("n_chars"),
    )
