"""Shard planning and contiguous shards (K1, K2).

The reference sizes shards from the table's byte size, ``int(nbytes / 1000 MiB) + 1``,
and gives shard ``i`` of ``n`` the contiguous rows ``[i*div + min(i, mod), ...)``
(``div, mod = divmod(N, n)``).  Here the byte size is the UTF-8 size of string
columns plus 8 bytes per other column, summed per split by a partial
aggregate; the contiguous cut points are positions in the seeded order and are
located with :mod:`prefdata.operators.cuts` (no global sort), then every row is
labelled map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefdata.operators.cuts import apply_thresholds, cut_thresholds
from prefdata.operators.split import ORDER_COL, SPLIT_NAMES, SPLIT_TENTHS, with_order

SHARD_BYTES = 1000 << 20


def row_bytes(df: DataFrame, exclude: tuple[str, ...] = ()) -> Column:
    """Estimated stored bytes of a row: UTF-8 length of strings, 8 per array element and per other column."""
    parts = []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.StringType):
            parts.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)).cast("long"))
        elif isinstance(f.dataType, T.ArrayType):
            parts.append(F.greatest(F.coalesce(F.size(F.col(f.name)), F.lit(0)), F.lit(0)).cast("long") * 8)
        else:
            parts.append(F.lit(8).cast("long"))
    out = parts[0] if parts else F.lit(0).cast("long")
    for p in parts[1:]:
        out = out + p
    return out


def shard_count(nbytes: int, shard_bytes: int = SHARD_BYTES) -> int:
    """K1: ``int(nbytes / shard_bytes) + 1``."""
    return int(nbytes // shard_bytes) + 1


def shard_plan(df: DataFrame, split_col: str = "split", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """K1 per split: ``split, nbytes, n_shards``."""
    nb = df.withColumn("_rb", row_bytes(df, exclude=(split_col,))).groupBy(split_col).agg(
        F.sum("_rb").alias("nbytes"))
    return nb.withColumn("n_shards", (F.expr(f"nbytes div {shard_bytes}") + 1).cast("int"))


def contiguous_bounds(n_rows: int, n_shards: int) -> list[int]:
    """Start offsets of shards 1..n-1 of a contiguous split of ``n_rows`` rows."""
    div, mod = divmod(n_rows, n_shards)
    return [i * div + min(i, mod) for i in range(1, n_shards)]


def shard_splits(df: DataFrame, key: str, split: str = "split", seed=42, shard_bytes: int = SHARD_BYTES,
                 names=SPLIT_NAMES) -> DataFrame:
    """K1 + K2 for rows that have their split: add ``shard`` and the order column, in which every shard is contiguous.

    The order is the split's number (one digit) and then the seeded hash, so one
    histogram and one read of cut rows serve all splits.  ``key`` is unique and
    every row's split is one of ``names``.
    """
    number = F.array_position(F.array(*[F.lit(x) for x in names]), F.col(split)) - 1
    ordered = with_order(df, key, seed).withColumn(ORDER_COL, F.concat(F.hex(number), F.col(ORDER_COL)))
    sizes = {r[split]: r for r in df.withColumn("_rb", row_bytes(df, exclude=(split,))).groupBy(split).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_rb").alias("nbytes")).collect()}  # one row per split
    cuts, earlier, start = [], [], 0
    for name in names:
        earlier.append(len(cuts))
        if name in sizes:
            n = sizes[name]["n"]
            cuts.extend(start + b for b in contiguous_bounds(n, shard_count(sizes[name]["nbytes"], shard_bytes)))
            start += n
    _, thresholds, hist = cut_thresholds(ordered.select(ORDER_COL, key), ORDER_COL, key, cuts)
    out = apply_thresholds(ordered, ORDER_COL, key, thresholds, hist, "_within")
    first = F.element_at(F.array(*[F.lit(v) for v in earlier]), (number + 1).cast("int"))
    return out.withColumn("shard", (F.col("_within") - first).cast("int")).drop("_within")


def split_and_shard(df: DataFrame, key: str, seed=42, shard_bytes: int = SHARD_BYTES, names=SPLIT_NAMES,
                    tenths=SPLIT_TENTHS, keep_order: bool = False) -> DataFrame:
    """O4 + K1 + K2: add ``split`` and ``shard`` (contiguous shards inside each split).

    ``keep_order`` leaves the order column for a sink that sorts inside shards.

    Jobs: one histogram of the order hash, one read of the split cut rows, one
    per-split byte sum, one read of the shard cut rows; the labelling itself
    is map-only (or a join with a table bounded by the histogram).
    """
    ordered = with_order(df, key, seed)
    keys = ordered.select(ORDER_COL, key)
    n, _, hist = cut_thresholds(keys, ORDER_COL, key, [])
    split_cuts = [n * t // 10 for t in tenths]
    _, split_thr, _ = cut_thresholds(keys, ORDER_COL, key, split_cuts, total=n, hist=hist)
    labelled = apply_thresholds(ordered, ORDER_COL, key, split_thr, hist, "_split")
    sizes = {r["_split"]: r["nbytes"] for r in labelled.withColumn("_rb", row_bytes(df)).groupBy("_split")
             .agg(F.sum("_rb").alias("nbytes")).collect()}
    starts = [0] + split_cuts
    ends = split_cuts + [n]
    cuts, first_interval = [], []
    for s in range(len(names)):
        first_interval.append(len(cuts) + s)
        k = shard_count(int(sizes.get(s, 0) or 0), shard_bytes)
        cuts.extend(starts[s] + b for b in contiguous_bounds(ends[s] - starts[s], k))
    _, shard_thr, _ = cut_thresholds(keys, ORDER_COL, key, sorted(cuts), total=n, hist=hist)
    out = apply_thresholds(labelled, ORDER_COL, key, shard_thr, hist, "_within")
    # interval index over all cuts = shard index + shards of earlier splits
    interval = F.col("_within") + F.col("_split")
    base = F.element_at(F.array(*[F.lit(v) for v in first_interval]), F.col("_split") + 1)
    out = out.withColumn("shard", (interval - base).cast("int"))
    out = out.withColumn("split", F.element_at(F.array(*[F.lit(x) for x in names]), F.col("_split") + 1))
    return out.drop("_split", "_within") if keep_order else out.drop("_split", "_within", ORDER_COL)
