"""Stateful stream operators: the buffered shuffle (O2) and the packer (S4 -> T12).

Rows are dealt to shards by a keyed hash; a shard is one state key, so shards
run side by side and a shard's rows keep their order.  Inside a micro-batch a
shard's rows are ordered by the given columns, and files must arrive in that
order; then the result does not depend on how rows fall into micro-batches.
A task holds the rows of one shard in one micro-batch: bound it by
``maxFilesPerTrigger`` and the number of shards.

A stream has no end.  What is still held when a run stops is in the state, so
the next run on the same checkpoint goes on from there; :func:`held_rows` and
:func:`held_tokens` read it for whoever wants to close the stream.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefdata.functions.keys import HNUM_DIGITS, h, hnum

BUFFER = 5000


def _draw(seed, shard: int, n: int, size: int) -> int:
    """``hnum(h(seed, shard, n)) % size`` for one arrival."""
    return int(hashlib.md5(f"{seed}-{shard}-{n}".encode()).hexdigest()[:HNUM_DIGITS], 16) % size


def shards_of(key: str, shards: int, seed=42):
    return F.pmod(hnum(h(seed, key)), F.lit(shards)).cast("int")


def buffered_shuffle(df: DataFrame, key: str, order: list[str], shards: int, buffer: int = BUFFER, seed=42) -> DataFrame:
    """O2: ``(shard, pos, row)`` - every shard fills a buffer, then each arrival takes the place of a drawn row, which is emitted.

    ``row`` is the whole row as JSON (:func:`rows_of` reads it), ``pos`` its place
    in the shard's new order.  A row moves forward by ``buffer`` places at most.
    The last ``buffer`` rows of a shard stay in the state (:func:`held_rows`).
    """
    rows = df.select(shards_of(key, shards, seed).alias("shard"), *order, F.to_json(F.struct(*df.columns)).alias("row"))

    def swap(group, frames, state):
        shard = int(group[0])
        held, n = state.get if state.exists else ([], 0)
        held = list(held)
        pos, out = [], []
        arrived = pd.concat(list(frames)).sort_values([*order, "row"], kind="stable")
        for row in arrived["row"]:
            if len(held) < buffer:
                held.append(row)
            else:
                j = _draw(seed, shard, n, buffer)
                pos.append(n - buffer)
                out.append(held[j])
                held[j] = row
            n += 1
        state.update((held, n))
        yield pd.DataFrame({"shard": pd.Series([shard] * len(out), dtype="int32"), "pos": pd.Series(pos, dtype="int64"), "row": pd.Series(out, dtype="object")})

    return rows.groupBy("shard").applyInPandasWithState(swap, "shard int, pos long, row string", "held array<string>, n long", "append", "NoTimeout")


def rows_of(shuffled: DataFrame, schema: T.StructType) -> DataFrame:
    """``(shard, pos, <columns of schema>)`` of shuffled rows."""
    return shuffled.select("shard", "pos", F.from_json("row", schema).alias("_r")).select("shard", "pos", "_r.*")


def _state(spark: SparkSession, checkpoint: str) -> DataFrame:
    return spark.read.format("statestore").load(checkpoint).select("key.shard", "value.groupState.*")


def held_rows(spark: SparkSession, checkpoint: str, seed=42) -> DataFrame:
    """The rows that a :func:`buffered_shuffle` still holds, in a drawn order after those it emitted."""
    held = _state(spark, checkpoint)
    slots = F.transform("held", lambda row, i: F.struct(h(seed, "shard", F.lit("end"), i).alias("o"), i.alias("i"), row.alias("row")))
    held = held.select("shard", (F.col("n") - F.size("held")).alias("first"), F.posexplode(F.array_sort(slots)).alias("at", "slot"))
    return held.select("shard", (F.col("first") + F.col("at")).alias("pos"), "slot.row")


def pack_stream(df: DataFrame, key: str, order: list[str], toks: str, seq_length: int, shards: int, seed=42) -> DataFrame:
    """S4 -> T12: ``(shard, chunk, input_ids)``, full blocks only; the unfinished block of a shard is carried in the state.

    ``toks`` already ends with the separator (T11).  A null or empty list adds nothing.
    """
    kind = df.schema[toks].dataType
    rows = df.select(shards_of(key, shards, seed).alias("shard"), *order, F.coalesce(F.col(toks), F.array().cast(kind)).alias("toks"))

    def pack(group, frames, state):
        carry, chunk = state.get if state.exists else ([], 0)
        pieces = pd.concat(list(frames)).sort_values(order, kind="stable")["toks"]
        flat = np.concatenate([np.array(list(carry), object), *pieces])
        full = len(flat) // seq_length * seq_length
        blocks = list(flat[:full].reshape(-1, seq_length))
        state.update((flat[full:].tolist(), chunk + len(blocks)))
        yield pd.DataFrame({"shard": pd.Series([int(group[0])] * len(blocks), dtype="int32"),
                            "chunk": pd.Series(range(chunk, chunk + len(blocks)), dtype="int64"), "input_ids": pd.Series(blocks, dtype="object")})

    ids = kind.simpleString()
    return rows.groupBy("shard").applyInPandasWithState(pack, f"shard int, chunk long, input_ids {ids}", f"carry {ids}, chunk long", "append", "NoTimeout")


def held_tokens(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``(shard, chunk, input_ids)``: the unfinished block of every shard of a :func:`pack_stream`."""
    return _state(spark, checkpoint).select("shard", "chunk", F.col("carry").alias("input_ids"))
