"""Exact positional cuts over a keyed-hash order, without a global sort.

Several reference operations slice a shuffled table by position: a 30/30/30/10
split (``[: N*3//10]`` ...), a hold-out of the first ``ceil(f*N)`` rows, the first
``n`` rows, contiguous shards.  Sorting the whole table to number its rows puts
every row through one ordering and, with ``row_number()`` and no partition, one
task.  Instead:

1. histogram of the first 4 hex digits of the hash (at most 65,536 groups,
   partially aggregated before the shuffle);
2. for each cut position find its bucket on the driver (the histogram is
   bounded); buckets larger than ``FETCH_MAX`` rows are refined by the next 4
   digits, all of a level in one job.  With more than ``REFINE_MAX`` such
   buckets (many cuts) they are ranked directly, one window per bucket of
   about N/65,536 rows;
3. rank only inside the buckets that hold a cut and read back the (hash, key)
   of the row at each cut (one row per cut);
4. label every row by comparing its (hash, key) with those thresholds:
   a map-only expression, or for many cuts a join with a per-bucket table
   whose size is bounded by the histogram (at most 65,536 rows), broadcast.

Ties in the hash are broken by the key, so keys must be unique for the
positions to be well defined (as they are for row numbers).
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET_DIGITS = 4
FETCH_MAX = 1_000_000
# Most buckets refined in one level; beyond it the cut buckets are ranked directly.
REFINE_MAX = 16
CASE_MAX = 64
# Most thresholds in the broadcast table of cuts (about 100 bytes each).
MAX_CUTS = 1_000_000
# Marker thresholds: a cut at or before position 0 (every row is past it) and a cut
# at or past the end (no row reaches it).
BEFORE_ALL = "before-all"
AFTER_ALL = "after-all"


def _histogram(keys: DataFrame, hcol: str, prefixes: list[str], digits: int) -> dict[str, list[tuple[str, int]]]:
    """Counts per hash prefix one level deeper, for all given prefixes in one job (``[""]`` = top level)."""
    width = len(prefixes[0]) + digits
    src = keys if prefixes == [""] else keys.filter(F.substring(hcol, 1, len(prefixes[0])).isin(prefixes))
    rows = src.groupBy(F.substring(hcol, 1, width).alias("_b")).agg(F.count(F.lit(1)).alias("_n")).collect()
    out: dict[str, list[tuple[str, int]]] = {p: [] for p in prefixes}
    for r in rows:
        out[r["_b"][: width - digits]].append((r["_b"], r["_n"]))
    return {p: sorted(v) for p, v in out.items()}


def _locate(hist, wanted: list[int]) -> dict[int, tuple[str, int, int]]:
    """Position -> (bucket, offset in bucket, bucket size) within one histogram."""
    starts, acc = [], 0
    for _, n in hist:
        starts.append(acc)
        acc += n
    out = {}
    for p in wanted:
        i = bisect_right(starts, p) - 1
        out[p] = (hist[i][0], p - starts[i], hist[i][1])
    return out


def _resolve(keys: DataFrame, hcol: str, hist, wanted: list[int]):
    """Map positions to (bucket, offset in bucket), refining big buckets one level per job.

    All oversized buckets of a level are refined by a single job.  When more
    than ``REFINE_MAX`` buckets would need refining (many cuts), the buckets are
    ranked directly instead: one window per bucket, each about N/65,536 rows.
    """
    located = {p: (b, off) for p, (b, off, _) in _locate(hist, wanted).items()}
    sizes = dict(hist)
    while True:
        big: dict[str, list[int]] = {}
        for p, (b, _) in located.items():
            if sizes.get(b, 0) > FETCH_MAX and len(b) + BUCKET_DIGITS <= 32:
                big.setdefault(b, []).append(p)
        if not big or len(big) > REFINE_MAX:
            return located
        subs = _histogram(keys, hcol, sorted(big), BUCKET_DIGITS)
        for b, ps in big.items():
            inner = _locate(subs[b], [located[p][1] for p in ps])
            for p in ps:
                sb, soff, _ = inner[located[p][1]]
                located[p] = (sb, soff)
        sizes = {sb: n for v in subs.values() for sb, n in v}


def _fetch(keys: DataFrame, hcol: str, kcol: str, located: dict[int, tuple[str, int]]):
    """Read the (hash, key) of the row at each located (bucket, offset)."""
    result: dict[int, tuple] = {}
    by_width: dict[int, dict[int, tuple[str, int]]] = {}
    for p, (b, off) in located.items():
        by_width.setdefault(len(b), {})[p] = (b, off)
    for width, items in by_width.items():
        wanted = pa.table({"_b": [b for b, _ in items.values()], "_r": pa.array([off for _, off in items.values()], pa.int32())})
        wanted = keys.sparkSession.createDataFrame(wanted)  # a row per cut
        w = Window.partitionBy("_b").orderBy(hcol, kcol)
        rows = (
            keys.withColumn("_b", F.substring(hcol, 1, width))
            .join(F.broadcast(wanted.select("_b").distinct()), "_b", "left_semi")
            .withColumn("_r", F.row_number().over(w) - 1)
            .join(F.broadcast(wanted), ["_b", "_r"])
            .select("_b", "_r", hcol, kcol)
            .collect()
        )
        found = {(r["_b"], r["_r"]): (r[hcol], r[kcol]) for r in rows}
        for p, (b, off) in items.items():
            result[p] = found[(b, off)]
    return result


def cut_thresholds(keys: DataFrame, hcol: str, kcol: str, cuts: list[int], total: int | None = None, hist=None):
    """(N, thresholds): the (hash, key) of the row at each cut position, or a marker."""
    if hist is None:
        hist = _histogram(keys, hcol, [""], BUCKET_DIGITS)[""]
    n = sum(c for _, c in hist) if total is None else total
    inside = sorted({c for c in cuts if 0 < c < n})
    located = _resolve(keys, hcol, hist, inside) if inside else {}
    fetched = _fetch(keys, hcol, kcol, located) if located else {}
    out = []
    for c in cuts:
        if c <= 0:
            out.append(BEFORE_ALL)
        elif c >= n:
            out.append(AFTER_ALL)
        else:
            out.append(fetched[c])
    return n, out, hist


def _at_or_past(hcol: str, kcol: str, t) -> Column:
    if t == BEFORE_ALL:
        return F.lit(True)
    if t == AFTER_ALL:
        return F.lit(False)
    th, tk = t
    return (F.col(hcol) > F.lit(th)) | ((F.col(hcol) == F.lit(th)) & (F.col(kcol) >= F.lit(tk)))


def interval_index(hcol: str, kcol: str, thresholds) -> Column:
    """Map-only: number of thresholds at or before the row's (hash, key) position."""
    if not thresholds:
        return F.lit(0)
    terms = [F.when(_at_or_past(hcol, kcol, t), 1).otherwise(0) for t in thresholds]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out.cast("int")


def bucket_rows(hist, thresholds) -> list[tuple]:
    """Per 4-digit bucket: thresholds strictly before it and those inside it (<= 65,536 rows)."""
    before = sum(1 for t in thresholds if t == BEFORE_ALL)
    real = sorted(t for t in thresholds if t not in (BEFORE_ALL, AFTER_ALL))
    rows, j = [], 0
    for b, _ in hist:  # one merge pass: both lists are sorted
        while j < len(real) and real[j][0][:BUCKET_DIGITS] < b:
            j += 1
        k = j
        while k < len(real) and real[k][0][:BUCKET_DIGITS] == b:
            k += 1
        rows.append((b, before + j, real[j:k]))
    return rows


def _bucket_table(spark, hist, thresholds, key_type) -> DataFrame:
    schema = T.StructType([
        T.StructField("_b", T.StringType()),
        T.StructField("_base", T.IntegerType()),
        T.StructField("_inner", T.ArrayType(T.StructType([
            T.StructField("th", T.StringType()), T.StructField("tk", key_type)]))),
    ])
    return spark.createDataFrame(bucket_rows(hist, thresholds), schema)


def apply_thresholds(df: DataFrame, hcol: str, kcol: str, thresholds, hist, out: str) -> DataFrame:
    """Add ``out`` = interval index; a map-only CASE for few cuts, a bounded broadcast join for many."""
    if len(thresholds) <= CASE_MAX:
        return df.withColumn(out, interval_index(hcol, kcol, thresholds))
    if len(thresholds) > MAX_CUTS:
        raise ValueError(f"{len(thresholds)} cuts: more than {MAX_CUTS} are not broadcast; use larger shards")
    key_type = df.schema[kcol].dataType
    table = _bucket_table(df.sparkSession, hist, thresholds, key_type)
    # One row per histogram bucket (at most 16**BUCKET_DIGITS), all of them hold MAX_CUTS thresholds at most.
    joined = df.withColumn("_b", F.substring(hcol, 1, BUCKET_DIGITS)).join(F.broadcast(table), "_b", "left")
    inside = F.size(F.filter("_inner", lambda t: (t["th"] < F.col(hcol)) | ((t["th"] == F.col(hcol)) & (t["tk"] <= F.col(kcol)))))
    return joined.withColumn(out, (F.col("_base") + inside).cast("int")).drop("_b", "_base", "_inner")


def assign_intervals(df: DataFrame, hcol: str, kcol: str, cuts: list[int], out: str = "_interval",
                     total: int | None = None) -> tuple[DataFrame, int]:
    """Add ``out`` = index of the positional interval ``[cuts[i-1], cuts[i])`` holding each row.

    Rows are ordered by (``hcol``, ``kcol``); ``cuts`` are 0-based positions in
    ascending order.  Returns the labelled frame and the row count N.
    """
    keys = df.select(hcol, kcol)
    n, thresholds, hist = cut_thresholds(keys, hcol, kcol, cuts, total)
    return apply_thresholds(df, hcol, kcol, thresholds, hist, out), n
