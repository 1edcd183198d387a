"""Scorers and reward metrics.

A scorer is a model applied to texts.  It runs as an iterator pandas UDF so the
model is built once per task and fed Arrow batches of ``batch_size`` rows.
The built-in scorer is a text statistic (characters per whitespace token), so
results can be checked in SQL; any other ``factory() -> (list[str] -> list[float])``
plugs in the same way.  Metrics are native aggregates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from prefdata.functions.tokens import first_tokens


def text_stat_scorer() -> Callable[[list[str]], list[float]]:
    """Built-in scorer: ``len(text) / (1 + number of whitespace tokens)``."""
    return lambda texts: [None if t is None else len(t) / (1 + len(t.split())) for t in texts]


def scorer(factory: Callable[[], Callable[[list[str]], list[float]]] = text_stat_scorer,
           batch_size: int = 16, max_tokens: int | None = None) -> Callable[[Column], Column]:
    """A Column function ``text -> double`` running ``factory()`` once per task, ``batch_size`` texts per call.

    With ``max_tokens`` the model sees that many tokens of a longer text; the cut is native and comes before the transfer to Python.
    """

    @F.pandas_udf(T.DoubleType())
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for s in texts:
            vals = s.tolist()
            out: list = []
            for i in range(0, len(vals), batch_size):
                out.extend(model(vals[i:i + batch_size]))
            yield pd.Series(out, dtype="float64")

    return score if max_tokens is None else lambda text: score(first_tokens(text, max_tokens))


def score_pair(df: DataFrame, text_j: str, text_k: str, fn: Callable[[Column], Column] | None = None) -> DataFrame:
    """Score both sides independently -> ``r_j``, ``r_k``."""
    fn = fn or scorer()
    return df.withColumn("r_j", fn(F.col(text_j))).withColumn("r_k", fn(F.col(text_k)))


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema, batch_size: int = 1000) -> DataFrame:
    """A batched map whose output may have more or fewer rows than its input.

    ``fn`` gets exactly ``batch_size`` consecutive rows of a partition (fewer in
    its last call), whatever the size of the Arrow batches they come in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rebatched(batches, batch_size):
            out = fn(rows.to_pandas())
            yield from pa.Table.from_pandas(out, target, preserve_index=False).to_batches()

    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    target = to_arrow_schema(schema)
    return df.mapInArrow(run, schema)


def rebatched(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The rows of ``batches`` in tables of exactly ``size`` rows, the last one shorter; slices are not copied."""
    held, n = [], 0
    for b in batches:
        at = 0
        while n + b.num_rows - at >= size:
            held.append(b.slice(at, size - n))
            at += size - n
            yield pa.Table.from_batches(held)
            held, n = [], 0
        if at < b.num_rows:
            held.append(b.slice(at))
            n += b.num_rows - at
    if n:
        yield pa.Table.from_batches(held)


def baseline_shift(score, baseline: float = 0.0) -> Column:
    """M3: ``score - reward_baseline``."""
    s = F.col(score) if isinstance(score, str) else score
    return s - F.lit(float(baseline))


def _margin(r_j: str, r_k: str) -> Column:
    return F.col(r_j) - F.col(r_k)


def logsigmoid_loss(r_j: str = "r_j", r_k: str = "r_k") -> Column:
    """M1 (per row): ``-logsigmoid(r_j - r_k)`` in the stable form ``max(-x, 0) + log(1 + exp(-|x|))``."""
    x = _margin(r_j, r_k)
    return F.greatest(-x, F.lit(0.0)) + F.log(F.lit(1.0) + F.exp(-F.abs(x)))


def pair_metrics(df: DataFrame, group: list[str] | None = None, r_j: str = "r_j", r_k: str = "r_k",
                 digits: int = 6) -> DataFrame:
    """M1, M2 (and M5 when grouped by step): mean loss and accuracy; a tie counts as correct."""
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(logsigmoid_loss(r_j, r_k)), digits).alias("loss"),
        F.round(F.avg((F.col(r_j) >= F.col(r_k)).cast("double")), digits).alias("accuracy"),
    ]
    return df.groupBy(*group).agg(*aggs) if group else df.agg(*aggs)


def eval_steps(last_step: int, every: int) -> list[int]:
    """M5: the steps at which an evaluation runs: the first and every ``every``-th."""
    return sorted({1, *range(every, last_step + 1, every)}) if last_step > 0 else []


def reward_stats(df: DataFrame, reward: str, group: list[str], digits: int = 6) -> DataFrame:
    """M4: per-step reward statistics (mean, population std, min, max)."""
    r = F.col(reward)
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(r), digits).alias("mean"),
        F.round(F.stddev_pop(r), digits).alias("std"),
        F.round(F.min(r), digits).alias("min"),
        F.round(F.max(r), digits).alias("max"),
    )
