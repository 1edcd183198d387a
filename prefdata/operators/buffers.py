"""Sequential packing buffers (T13): fill a buffer until it holds the budget, overshoot included, then start the next.

Which document starts a buffer depends on where the one before it ended, so the
rule is a walk over all documents in order.  It is cut by the partitions of a
range sort.  Inside a partition every document's next start is a binary search
in the running sum, and following these pointers to the partition's end is done
for all documents at once.  Only documents within one budget of a partition's
start can be entered from outside; their exits form a small pointer table, and
the walk from the first document through it is found by pointer doubling
(``log2(partitions)`` joins).  No task scans more than its own partition.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prefdata.functions.keys import h
from prefdata.session import materialize

#: Documents of a range partition, about; a document takes some 60 bytes there.
PARTITION_ROWS = 1_000_000


def next_starts(before: np.ndarray, budget: int) -> np.ndarray:
    """For a buffer that starts at each row, the row that starts the next one; ``len(before)`` if it lies beyond.

    ``before`` is the number of characters before each row, in order.
    """
    return np.searchsorted(before, before + budget, side="left")


def exits(before: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """For a buffer that starts at each row: the characters from which the first start beyond these rows is sought, and the starts up to it."""
    n = len(before)
    to = next_starts(before, budget)
    jump = np.where(to < n, to, np.arange(n))
    hops = (to < n).astype(np.int64)
    while (jump[jump] != jump).any():
        hops = hops + hops[jump]
        jump = jump[jump]
    return before[jump] + budget, hops + 1


def _first_at(lasts: np.ndarray, parts: np.ndarray, sought: np.ndarray) -> np.ndarray:
    """The partition that holds the first row with ``sought`` characters or more before it; -1 if none does."""
    at = np.searchsorted(lasts, sought, side="left")
    return np.where(at < len(parts), parts[np.minimum(at, len(parts) - 1)], -1)


def sequential_buffers(docs: DataFrame, keys: list[str], text: str, budget: int, seed=42) -> DataFrame:
    """``docs`` with ``buffer`` (from 0): documents in the order ``(h(seed, *keys), *keys)`` fill buffers of ``budget`` characters or more.

    The document that reaches the budget still belongs to the buffer; the next
    one, empty or not, starts another.  The last buffer may hold less.  Null
    texts count as empty.  ``keys`` identify a row.
    """
    if budget <= 0:
        raise ValueError("budget must be positive")
    spark = docs.sparkSession
    order = ["_o", *keys]
    rows = docs.select(*keys, h(seed, *keys).alias("_o"), F.coalesce(F.length(text), F.lit(0)).cast("long").alias("_n"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.count() // PARTITION_ROWS + 1)
    ranged = materialize(rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "buffer-order")
    # One row per partition from here on, some tens of bytes each.
    sums = ranged.groupBy("_part").agg(F.sum("_n").alias("chars"), F.max(F.struct(*order, "_n"))["_n"].alias("last_n")).orderBy("_part").toPandas()
    if not len(sums):
        return docs.withColumn("buffer", F.lit(None).cast("long"))
    begin = (sums["chars"].cumsum() - sums["chars"]).to_numpy(np.int64)
    of = {int(p): int(b) for p, b in zip(sums["_part"], begin)}
    ids, lasts = sums["_part"].to_numpy(np.int64), begin + (sums["chars"] - sums["last_n"]).to_numpy(np.int64)

    def sorted_before(pdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
        pdf = pdf.sort_values(order, kind="stable")
        n = pdf["_n"].to_numpy(np.int64)
        return pdf, of[int(pdf["_part"].iloc[0])] + np.cumsum(n) - n

    def entries(pdf: pd.DataFrame) -> pd.DataFrame:
        part = int(pdf["_part"].iloc[0])
        _, before = sorted_before(pdf)
        sought, hops = exits(before, budget)
        some = np.arange(np.searchsorted(before, of[part] + budget, side="left") + 1)
        some = some[some < len(before)]
        return pd.DataFrame({"part": part, "before": before[some], "row": some, "sought": sought[some], "hops": hops[some],
                             "to_part": _first_at(lasts, ids, sought[some])})

    table = ranged.groupBy("_part").applyInPandas(entries, "part long, before long, row long, sought long, hops long, to_part long")
    table = materialize(table, "buffer-entries")

    def resolve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The row of the entered partition that each exit leads to."""
        right = right.sort_values("row")
        at = np.searchsorted(right["before"].to_numpy(), left["sought"].to_numpy(), side="left")
        return pd.DataFrame({"part": left["part"], "row": left["row"], "to_part": left["to_part"], "to_row": right["row"].to_numpy()[at] if len(left) else at, "hops": left["hops"]})

    edges = "part long, row long, to_part long, to_row long, hops long"
    jumps = table.filter("to_part >= 0").groupBy("to_part").cogroup(table.groupBy("part")).applyInPandas(resolve, edges)
    jumps = materialize(jumps, "buffer-jumps")
    first = spark.createDataFrame([(int(ids[0]), 0, 0)], "part long, row long, cum long")
    walk = materialize(first, "buffer-walk")
    for _ in range(len(ids).bit_length()):
        step = jumps.withColumnsRenamed({"part": "p", "row": "r"})
        more = walk.join(step, (walk["part"] == step["p"]) & (walk["row"] == step["r"])).select(F.col("to_part").alias("part"), F.col("to_row").alias("row"), (F.col("cum") + F.col("hops")).alias("cum"))
        walk = materialize(walk.unionByName(more).distinct(), "buffer-walk")
        ahead = jumps.select(F.col("part").alias("to_part"), F.col("row").alias("to_row"), F.col("to_part").alias("far_part"), F.col("to_row").alias("far_row"), F.col("hops").alias("more"))
        jumps = materialize(jumps.join(ahead, ["to_part", "to_row"]).select("part", "row", F.col("far_part").alias("to_part"), F.col("far_row").alias("to_row"), (F.col("hops") + F.col("more")).alias("hops")), "buffer-jumps")
    # A partition that is not entered lies inside the buffer before the next entered one.
    ends = walk.join(table.select("part", "row", "hops"), ["part", "row"]).select(F.col("part").alias("_part"), "row", "cum", (F.col("cum") + F.col("hops")).alias("after"))
    known = ranged.select("_part").distinct().join(ends, "_part", "left")
    past = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    known = known.withColumn("open", F.coalesce(F.max("after").over(past), F.lit(0)) - 1)
    known = materialize(known.select("_part", F.coalesce("row", F.lit(-1)).alias("_row"), "open"), "buffer-parts")

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        entry, buffer = int(pdf["_row"].iloc[0]), int(pdf["open"].iloc[0])
        pdf, before = sorted_before(pdf)
        out = np.full(len(pdf), buffer, np.int64)
        to = next_starts(before, budget)
        while 0 <= entry < len(pdf):
            buffer += 1
            out[entry: to[entry]] = buffer
            entry = int(to[entry])
        return pdf[keys].assign(buffer=out)

    schema = ", ".join([*(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys), "buffer long"])
    numbered = materialize(ranged.join(known, "_part").groupBy("_part").applyInPandas(number, schema), "buffers")
    return docs.join(numbered, keys)


def buffers_sql(source: str, key: str, text: str, budget: int, order_sql: str) -> str:
    """DuckDB text of :func:`sequential_buffers` as CTEs ``bo``, ``bw`` (one row at a time) and ``buffered``."""
    return f"""bo AS (SELECT {key}, length(coalesce({text}, '')) AS n, row_number() OVER (ORDER BY {order_sql}, {key}) AS r FROM {source}),
bw(r, fill, buffer) AS (SELECT r, n, 0::BIGINT FROM bo WHERE r = 1
  UNION ALL SELECT bo.r, CASE WHEN bw.fill >= {budget} THEN bo.n ELSE bw.fill + bo.n END, CASE WHEN bw.fill >= {budget} THEN bw.buffer + 1 ELSE bw.buffer END
  FROM bw JOIN bo ON bo.r = bw.r + 1),
buffered AS (SELECT {key}, buffer FROM bw JOIN bo USING (r))"""
