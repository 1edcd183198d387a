"""Vocabulary, encode, decode and the chars-per-token ratio.

The reference downloads a pretrained tokenizer; none is available here, so the
vocabulary is built from the corpus: whitespace tokens counted with a partial
aggregate, the ``max_size`` most frequent kept (ties by token).  Its size is
bounded by ``max_size``, which is what makes it safe to ship to every task.
Encoding is an Arrow UDF over that dictionary: map-only, no token explode, no
shuffle; tokens beyond it are spelled in bytes, so decoding gives every token back.  Any other tokenizer plugs in via :func:`tokenize_with`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefdata.functions.tokens import EOS_ID, SPECIAL_TOKENS, append_token, token_count, tokens
from prefdata.session import materialize

MAX_VOCAB = 32000
# Tokens, ids or bytes of a batch that a Python task spreads out at a time (a batch has thousands of texts).
SLICE = 1 << 18


def cuts_of(sizes: np.ndarray, most: int | None = None) -> list[tuple[int, int]]:
    """Consecutive (from, to) rows whose sizes sum to about ``most`` (``SLICE``); a larger row is alone."""
    at = (np.cumsum(sizes, dtype=np.int64) - sizes) // (SLICE if most is None else most)
    edges = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1, [len(sizes)]]).tolist()
    return list(zip(edges, edges[1:]))


def sizes_of(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def build_vocab(df: DataFrame, text: str, max_size: int = MAX_VOCAB) -> DataFrame:
    """``(token, id, n)``; ids ``0..2`` are the special tokens, then tokens by (count desc, token).

    Counting is a partial aggregate.  To keep the top-``V`` step small, a
    histogram of the count values (one row per distinct count) gives the count
    of the V-th token; only tokens at or above it reach the ordered limit, so
    one task sees about V rows instead of V per partition.
    """
    counts = df.select(F.explode(tokens(text)).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "token-counts")  # one tokenizing pass feeds both steps below
    keep = max_size - len(SPECIAL_TOKENS)
    # the V-th token's count is among the V largest distinct counts: at most V rows reach the driver
    hist = (counts.groupBy("n").agg(F.count(F.lit(1)).alias("tokens"))
            .orderBy(F.col("n").desc()).limit(keep).collect())
    floor, seen = 0, 0
    for row in sorted(hist, key=lambda r: -r["n"]):
        seen += row["tokens"]
        floor = row["n"]
        if seen >= keep:
            break
    top = counts.filter(F.col("n") >= floor).orderBy(F.col("n").desc(), F.col("token")).limit(keep)
    ranked = top.withColumn("id", (F.row_number().over(Window.orderBy(F.col("n").desc(), F.col("token")))
                                   + len(SPECIAL_TOKENS) - 1).cast("int"))
    return ranked.select("token", "id", "n")


def _vocab_dict(vocab: DataFrame, max_size: int) -> dict[str, int]:
    rows = vocab.select("token", "id").limit(max_size + 1).collect()
    if len(rows) > max_size:
        raise ValueError(f"vocabulary has more than {max_size} entries; refusing to broadcast it")
    return {r["token"]: r["id"] for r in rows}


def encoder(vocab: DataFrame, max_size: int = MAX_VOCAB) -> Callable[[Column], Column]:
    """A Column function ``text -> array<int>``; no token is lost.

    A token outside the vocabulary becomes the byte of a space and then its
    UTF-8 bytes, byte ``b`` as id ``max_size + b``; no token holds a space, so
    :func:`decoder` finds where each begins.  Splitting is native; the Arrow
    UDF looks a whole batch up at once and builds its lists from offsets.
    """
    spark = vocab.sparkSession
    table = spark.sparkContext.broadcast(_vocab_dict(vocab, max_size))

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lookup = table.value
        keys = pa.array(list(lookup.keys()), type=pa.string())
        ids = np.array([*lookup.values(), 0], np.int32)

        def part(arr, size):
            flat = arr.flatten()
            at = pc.fill_null(pc.index_in(flat, value_set=keys), -1).to_numpy(zero_copy_only=False)
            unknown = at < 0
            raw = flat.filter(pa.array(unknown)).cast(pa.binary())
            n_bytes = pc.binary_length(raw).to_numpy(zero_copy_only=False).astype(np.int64)
            width = np.ones(len(at), np.int64)
            width[unknown] += n_bytes
            start = np.concatenate([[0], np.cumsum(width)])
            out = np.empty(start[-1], np.int32)
            out[start[:-1]] = np.where(unknown, max_size + ord(" "), ids[at])
            spelled = np.frombuffer(b"".join(raw.to_pylist()), np.uint8)
            before = np.cumsum(n_bytes) - n_bytes
            out[np.repeat(start[:-1][unknown] + 1 - before, n_bytes) + np.arange(len(spelled))] = max_size + spelled.astype(np.int32)
            offsets = start[np.concatenate([[0], np.cumsum(size)])]
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(out), mask=arr.is_null())
        for arr in lists:
            size = sizes_of(arr)
            yield pa.concat_arrays([part(arr.slice(i, j - i), size[i:j]) for i, j in cuts_of(size)])

    return lambda text: encode(tokens(text))


def decoder(vocab: DataFrame, max_size: int = MAX_VOCAB, skip_special: bool = True) -> Callable[[Column], Column]:
    """A Column function ``array<int> -> text``; special tokens skipped, tokens joined by one space.

    Ids of no token are skipped; bytes that a truncation cut apart become U+FFFD.
    """
    spark = vocab.sparkSession
    pieces = {i: f" {t}".encode() for t, i in _vocab_dict(vocab, max_size).items()}
    if not skip_special:
        pieces.update({i: f" {t}".encode() for i, t in enumerate(SPECIAL_TOKENS)})
    pieces.update({max_size + b: bytes([b]) for b in range(256)})
    table = spark.sparkContext.broadcast(pieces)

    @F.arrow_udf(T.BinaryType())
    def decode(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        keys = pa.array(list(table.value.keys()), pa.int32())
        values = pa.array(list(table.value.values()), pa.binary())

        def part(arr, size):
            flat = pc.fill_null(pc.take(values, pc.index_in(arr.flatten().cast(pa.int32()), value_set=keys)), b"")
            offsets = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
            return pc.binary_join(pa.ListArray.from_arrays(offsets, flat, mask=arr.is_null()), b"")
        for arr in lists:
            size = sizes_of(arr)
            yield pa.concat_arrays([part(arr.slice(i, j - i), size[i:j]) for i, j in cuts_of(size)])

    return lambda ids: F.ltrim(F.make_valid_utf8(decode(ids).cast("string")))


def tokenize_with(factory: Callable[[], Callable[[str], list[int]]]) -> Callable[[Column], Column]:
    """T6, pluggable: ``factory()`` builds a tokenizer once per task (e.g. from a local file)."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tok = factory()
        for s in texts:
            yield s.map(lambda t: None if t is None else list(tok(t)))

    return run


def with_eos(ids, eos_id: int = EOS_ID) -> Column:
    """``ids + [eos]``; an eos id of 0 counts as missing, as in the reference."""
    return append_token(ids, F.lit(eos_id if eos_id else EOS_ID))


def chars_per_token(df: DataFrame, text: str) -> DataFrame:
    """``sum(len(text)) / sum(tokens)`` over the rows given (null when there are no tokens)."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.length(text)).alias("n_chars"),
        F.sum(token_count(text)).alias("n_tokens"),
    ).withColumn("ratio", F.try_divide(F.col("n_chars").cast("double"), F.col("n_tokens").cast("double")))
