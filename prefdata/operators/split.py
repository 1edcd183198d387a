"""Seeded order, exact splits, hold-outs and first-n subsets.

The reference shuffles with a seed and slices by position.  Here the shuffle is
a key, ``order = (h(seed, key), key)``, never a physical move; positions are
found with :mod:`prefdata.operators.cuts`, so no operator sorts the table.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefdata.functions.keys import h
from prefdata.operators.cuts import apply_thresholds, assign_intervals, cut_thresholds

ORDER_COL = "_order"
SPLIT_NAMES = ("finetune", "reward", "rl", "evaluation")
# Split boundaries as tenths of N, floored: [:3N//10], [3N//10:6N//10], [6N//10:9N//10], rest.
SPLIT_TENTHS = (3, 6, 9)


def with_order(df: DataFrame, key: str, seed: int = 42, out: str = ORDER_COL) -> DataFrame:
    """O1: seeded shuffle as a sort key (no data moves until something needs the order)."""
    return df.withColumn(out, h(seed, key))


def label_positions(df: DataFrame, key: str, cuts_for_n, labels, seed: int = 42, out: str = "split",
                    keep_order: bool = False) -> DataFrame:
    """Label rows by the positional interval they fall in; ``cuts_for_n(N)`` gives the cuts."""
    ordered = with_order(df, key, seed)
    keys = ordered.select(ORDER_COL, key)
    n, _, hist = cut_thresholds(keys, ORDER_COL, key, [])
    cuts = list(cuts_for_n(n))
    _, thresholds, _ = cut_thresholds(keys, ORDER_COL, key, cuts, total=n, hist=hist)
    res = apply_thresholds(ordered, ORDER_COL, key, thresholds, hist, "_idx")
    res = res.withColumn(out, F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("_idx") + 1)).drop("_idx")
    return res if keep_order else res.drop(ORDER_COL)


def split_exact(df: DataFrame, key: str, seed: int = 42, names=SPLIT_NAMES, tenths=SPLIT_TENTHS,
                out: str = "split") -> DataFrame:
    """The reference's 30/30/30/10 split by position in the seeded order.

    Split by the question key *before* pairs are built, so no question spans two splits.
    """
    return label_positions(df, key, lambda n: [n * t // 10 for t in tenths], names, seed, out)


def holdout_size(n: int, test_size: float) -> int:
    """Rows in the hold-out for a fractional test size: ``ceil(test_size * n)``."""
    return int(math.ceil(test_size * n))


def holdout(df: DataFrame, key: str, test_size: float = 0.005, seed: int = 42, out: str = "part") -> DataFrame:
    """Fractional hold-out; the first ``ceil(test_size*N)`` rows of the order are ``test``."""
    return label_positions(df, key, lambda n: [holdout_size(n, test_size)], ("test", "train"), seed, out)


def take_skip(df: DataFrame, key: str, n: int = 1000, seed: int = 42, out: str = "part") -> DataFrame:
    """L2 (batch form): the first ``n`` rows are ``valid`` (take), the rest ``train`` (skip)."""
    return label_positions(df, key, lambda _: [n], ("valid", "train"), seed, out)


def first_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """L1: the first ``n`` rows of the seeded order (all rows when ``n <= 0`` or ``n >= N``)."""
    if n <= 0:
        return df
    labelled = label_positions(df, key, lambda _: [n], (0, 1), seed, "_past")
    return labelled.filter(F.col("_past") == 0).drop("_past")


def split_counts(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Row count per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))


__all__ = ["with_order", "split_exact", "holdout", "holdout_size", "take_skip", "first_n", "split_counts",
           "label_positions", "assign_intervals", "SPLIT_NAMES"]
