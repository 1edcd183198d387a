"""Rows by their place in the files (L1, L2, K2): files in name order, rows in the order they lie in.

The reference's ``select(range)``, ``take`` and ``skip`` count rows as they are
stored.  The index is a count per file (partial aggregate, no sort, no hash)
and the sum before each; a range of rows then opens only the files that hold
it, and ``_metadata.row_index`` cuts the first and the last of them.  The driver
holds one (path, count) per file and no row.
"""

from __future__ import annotations

import bisect
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class FilePositions:
    """Positional index of the Parquet files under ``path`` (a file, folder or glob)."""

    def __init__(self, spark: SparkSession, path: str):
        files = spark.read.parquet(path)
        self.spark, self.schema = spark, files.schema
        counts = files.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n")).collect()
        counts.sort(key=lambda r: r["path"])
        self.paths = [r["path"] for r in counts]
        self.starts = [0, *accumulate(r["n"] for r in counts)]

    @property
    def n_rows(self) -> int:
        return self.starts[-1]

    def files_of(self, start: int, stop: int) -> list[tuple[str, int]]:
        """(path, position of its first row) of every file that holds a row of ``[start, stop)``; files without rows are in none."""
        start, stop = max(start, 0), min(stop, self.n_rows)
        if start >= stop:
            return []
        return list(zip(self.paths, self.starts))[bisect.bisect_right(self.starts, start) - 1: bisect.bisect_left(self.starts, stop)]

    def select(self, start: int, stop: int, position: str = "position") -> DataFrame:
        """Rows ``start`` to ``stop - 1`` with their ``position``; bounds beyond the table are cut to it."""
        files = self.files_of(start, stop)
        if not files:
            return self.spark.createDataFrame([], self.schema).withColumn(position, F.lit(None).cast("long"))
        rows = self.spark.read.schema(self.schema).parquet(*[_as_glob(p) for p, _ in files])
        path, index = F.col("_metadata.file_path"), F.col("_metadata.row_index")
        # Files of a range follow each other: only its first and last are cut, the others lie in it whole.
        (first, before), (last, last_before) = files[0], files[-1]
        rows = rows.filter(((path != first) | (index >= start - before)) & ((path != last) | (index < stop - last_before)))
        starts = self.spark.createDataFrame(files, "_path string, _before long")  # one row per file opened
        return (rows.select(*self.schema.names, path.alias("_path"), index.alias("_index")).join(F.broadcast(starts), "_path")
                .withColumn(position, F.col("_before") + F.col("_index")).select(*self.schema.names, position))

    def take(self, n: int) -> DataFrame:
        """L2: the first ``n`` rows."""
        return self.select(0, n)

    def skip(self, n: int) -> DataFrame:
        """L2: all rows but the first ``n``."""
        return self.select(n, self.n_rows)

    def shard(self, shard: int, n_shards: int) -> DataFrame:
        """K2: the contiguous shard of that number; the first ``n_rows % n_shards`` shards have one row more."""
        size, more = divmod(self.n_rows, n_shards)
        start = shard * size + min(shard, more)
        return self.select(start, start + size + (shard < more))


def _as_glob(path: str) -> str:
    """A path as the metadata spells it (percent-encoded), for a reader that expands patterns."""
    from urllib.parse import unquote

    out = unquote(path)
    for sign in "\\{}[]*?":
        out = out.replace(sign, "\\" + sign)
    return out
