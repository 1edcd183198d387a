"""Batches, list collation, length draws and padding.

A dataloader walks the whole table in order and cuts batches of ``batch_size``.
Numbering every row in one global order needs one task, so rows are dealt to
``n_shards`` shards by keyed hash (``n_shards`` grows with the row count) and
batches are consecutive rows of one shard in the seeded order.  Every window
here is partitioned by shard or by batch, so its size is bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefdata.functions.keys import h, hnum
from prefdata.functions.tokens import pad, padded_mask, round_up

BATCH_SIZE = 32
ROWS_PER_SHARD = 1 << 20
# Generation lengths are drawn from [32, 512).
MIN_GEN_LENGTH, MAX_GEN_LENGTH = 32, 512


def shard_count(df: DataFrame, rows_per_shard: int = ROWS_PER_SHARD) -> int:
    return df.count() // rows_per_shard + 1


def assign_batches(df: DataFrame, keys: list[str], batch_size: int = BATCH_SIZE, n_shards: int = 1,
                   seed=42) -> DataFrame:
    """G1: add ``shard``, ``batch_id`` and ``pos`` (position in the batch)."""
    o = h(seed, *keys)
    x = df.withColumn("_o", o).withColumn("shard", F.pmod(hnum("_o"), F.lit(n_shards)).cast("int"))
    r = F.row_number().over(Window.partitionBy("shard").orderBy("_o", *keys)) - 1
    x = x.withColumn("_r", r)
    return x.withColumn("batch_id", F.expr(f"_r div {batch_size}").cast("int")).withColumn(
        "pos", F.expr(f"_r % {batch_size}").cast("int")).drop("_o", "_r")


def collate(batched: DataFrame, fields: list[str]) -> DataFrame:
    """One row per batch, each field a list in batch order (rows -> dict of lists)."""
    s = F.array_sort(F.collect_list(F.struct("pos", *fields)))
    x = batched.groupBy("shard", "batch_id").agg(s.alias("_rows"))
    return x.select("shard", "batch_id", F.size("_rows").alias("n"),
                    *[F.transform("_rows", _field(f)).alias(f) for f in fields])


def _field(name: str):
    return lambda r: r[name]


def first_batches(batched: DataFrame, n_batches: int, n_shards: int) -> DataFrame:
    """L3: stop after ``n_batches`` batches; batches are taken round-robin over shards.

    Only the first ``n_batches`` shards can hold one; that part of the filter
    reaches below the window, so other shards are not shuffled or sorted.
    """
    return batched.filter(F.col("shard") < n_batches).filter(F.col("batch_id") * n_shards + F.col("shard") < n_batches)


def length_draw(keys: list[str], seed=42, low: int = MIN_GEN_LENGTH, high: int = MAX_GEN_LENGTH) -> Column:
    """A keyed draw from ``[low, high)`` per row."""
    return (F.lit(low) + F.pmod(hnum(h(seed, F.lit("len"), *keys)), F.lit(high - low))).cast("int")


def batch_width(ids: str, multiple: int | None = None, max_length: int | None = None) -> Column:
    """The padded width of a batch: longest row (or ``max_length``) rounded up to ``multiple``."""
    if max_length is not None:
        return round_up(max_length, multiple)
    longest = F.max(F.size(ids)).over(Window.partitionBy("shard", "batch_id"))
    return round_up(longest, multiple)


def pad_batch(batched: DataFrame, ids: str, pad_value, multiple: int | None = None, max_length: int | None = None,
              side: str = "right", prefix: str = "") -> DataFrame:
    """Pad ``ids`` to the batch width; add ``{prefix}input_ids``, ``{prefix}attention_mask``, ``{prefix}width``."""
    x = batched.withColumn(f"{prefix}width", batch_width(ids, multiple, max_length).cast("int"))
    w = F.col(f"{prefix}width")
    return x.withColumn(f"{prefix}attention_mask", padded_mask(ids, w, side)).withColumn(
        f"{prefix}input_ids", pad(ids, w, pad_value, side))
