"""Constant-length packing.

Reference semantics: fill a buffer with documents until it holds at least
``seq_length * chars_per_token * num_of_sequences`` characters (the last
document may overshoot), tokenize, append ``eos`` to each document, concatenate,
cut every ``seq_length`` tokens and drop the short tail of the buffer; shuffle
the blocks of the buffer.

Exact buffers come from :mod:`prefdata.operators.buffers`; they need an order
of all documents.  The cheaper form: a buffer is a **shard**, ``pmod(h(seed, key), n)`` with ``n`` from
the same character budget (:func:`buffer_count`), so each shard holds about one
buffer's worth of text; the boundary differs from the sequential one, the rules
inside a buffer are the same.  Tokens are never exploded: a running sum of
document lengths per shard gives each document's offset, a document is cut into
the pieces that fall in each block (a long document spans many blocks), and a
block is one group of at most ``seq_length`` tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prefdata.functions.keys import h, hnum

SEQ_LENGTH = 1024
NUM_OF_SEQUENCES = 1024
CHARS_PER_TOKEN = 3.6


def buffer_count(total_chars: int, seq_length: int = SEQ_LENGTH, chars_per_token: float = CHARS_PER_TOKEN,
                 num_of_sequences: int = NUM_OF_SEQUENCES) -> int:
    """Number of buffers (shards) for a corpus of ``total_chars`` characters."""
    budget = seq_length * chars_per_token * num_of_sequences
    return int(total_chars // budget) + 1


def total_chars(df: DataFrame, text: str) -> int:
    return int(df.agg(F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("c")).first()["c"])


def pack(docs: DataFrame, keys: list[str], toks: str, seq_length: int, n_shards: int, seed=42) -> DataFrame:
    """``(shard, chunk, input_ids)`` blocks of exactly ``seq_length`` tokens.

    ``toks`` already ends with the separator (T11).  Documents are ordered by
    ``(h(seed, *keys), *keys)`` inside their shard.
    """
    d = docs.select(*keys, toks).withColumn("_o", h(seed, *keys))
    return _pack(d.withColumn("shard", F.pmod(hnum("_o"), F.lit(n_shards)).cast("int")), keys, toks, seq_length)


def pack_buffers(docs: DataFrame, keys: list[str], toks: str, buffer: str, seq_length: int, seed=42) -> DataFrame:
    """T12 over buffers made beforehand (T13, :func:`prefdata.operators.buffers.sequential_buffers`): ``shard`` is the buffer."""
    d = docs.select(*keys, toks, F.col(buffer).alias("shard")).withColumn("_o", h(seed, *keys))
    return _pack(d, keys, toks, seq_length)


def _pack(d: DataFrame, keys: list[str], toks: str, L: int) -> DataFrame:
    d = d.withColumn("_n", F.size(toks))
    w = Window.partitionBy("shard").orderBy("_o", *keys).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)).cast("long"))
    # An empty document touches no block.  (No filter on the size: Catalyst would push it below a
    # round-robin spread of the scan and tokenize everything in the scan task.)
    touched = F.when(F.col("_n") > 0, F.sequence(F.expr(f"_off div {L}"), F.expr(f"(_off + _n - 1) div {L}")))
    d = d.withColumn("chunk", F.explode(F.coalesce(touched, F.array().cast("array<bigint>"))))
    lo = F.greatest(F.col("chunk") * L, F.col("_off"))
    hi = F.least((F.col("chunk") + 1) * L, F.col("_off") + F.col("_n"))
    d = d.select("shard", "chunk", F.struct(lo.alias("lo"),
                                            F.slice(toks, (lo - F.col("_off") + 1).cast("int"),
                                                    (hi - lo).cast("int")).alias("piece")).alias("_p"))
    blocks = d.groupBy("shard", "chunk").agg(F.array_sort(F.collect_list("_p")).alias("_ps"))
    blocks = blocks.select("shard", "chunk", F.flatten(F.transform("_ps", lambda p: p["piece"])).alias("input_ids"))
    return blocks.filter(F.size("input_ids") == L)


def shuffle_blocks(blocks: DataFrame, seed=42) -> DataFrame:
    """O3: position of each block inside its shard after a seeded shuffle (bounded per shard)."""
    w = Window.partitionBy("shard").orderBy(h(seed, "shard", "chunk"), "chunk")
    return blocks.withColumn("pos", (F.row_number().over(w) - 1).cast("int"))


def with_labels(blocks: DataFrame) -> DataFrame:
    """``labels`` is a copy of ``input_ids``."""
    return blocks.withColumn("labels", F.col("input_ids"))


def repeat_epochs(df: DataFrame, n_epochs: int, out: str = "epoch") -> DataFrame:
    """The data ``n_epochs`` times with an ``epoch`` column (finite, unlike an infinite iterator).

    A generator on each row, not a cross join; put ``epoch`` in the order key so
    each pass is shuffled differently.  No epochs give no rows.
    """
    if n_epochs <= 0:
        return df.filter(F.lit(False)).withColumn(out, F.lit(0))
    return df.withColumn(out, F.explode(F.sequence(F.lit(0), F.lit(n_epochs - 1))))
