"""Pairs of 64-bit fingerprints within a Hamming radius: tiled exact comparison inside pigeonhole buckets.

The 64 bits are cut into ``blocks`` segments.  Two fingerprints that differ in
at most ``radius`` bits agree on at least ``blocks - radius`` whole segments,
so every such pair meets in a bucket keyed by some choice of that many
segments.  Inside a bucket fingerprints are sorted by population count and
compared tile against tile by exclusive-or and bit counts; a pair of tiles
whose population counts differ by more than the radius is skipped.  Nothing is
approximate and no bucket is capped: one that is larger than ``TILE`` is cut
into tiles and every pair of tiles becomes a row of its own, dealt out again.

Fingerprints travel as packed arrays, not as a row each: the bucketing
shuffle moves 8 bytes per fingerprint and segment choice.  Only star edges of
what a task found leave it, so a dense group never emits its pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefdata.llm.common import materialize, shuffle_partitions
from prefdata.llm.components import star

#: Fingerprints in one tile; a unit of work holds two at most.
TILE = 4096
#: Rows of a tile that are compared with all its columns in one array operation.
STRIP = 256
#: Buckets up to this size are compared all at once, offset by offset.
SMALL = 48
#: Fingerprints packed at a time by a map task, and edges held before they are reduced to stars.
PACK_ROWS, HELD_EDGES = 1 << 18, 1 << 20


def segment_masks(radius: int, blocks: int) -> list[int]:
    """Bit masks of every choice of ``blocks - radius`` out of ``blocks`` segments."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    segment = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(segment, blocks - radius)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser that spreads masked keys evenly."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


class Stars:
    """Edges found so far, reduced to stars whenever many are held."""

    def __init__(self):
        self.a, self.b, self.held = [], [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.a.append(a)
            self.b.append(b)
            self.held += len(a)
            if self.held > HELD_EDGES:
                self.reduce()

    def reduce(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.a:
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        a, b = star(np.concatenate(self.a), np.concatenate(self.b))
        self.a, self.b, self.held = [a], [b], 0
        return a, b


def compare(x: np.ndarray, y: np.ndarray | None, radius: int, found: Stars) -> None:
    """Add all pairs within the radius between x and y (or inside x); both sorted by population count."""
    inside = y is None
    y = x if inside else y
    px, py = np.bitwise_count(x).astype(np.int16), np.bitwise_count(y).astype(np.int16)
    for i in range(0, len(x), STRIP):
        rows, low, high = x[i: i + STRIP], px[i] - radius, px[min(i + STRIP, len(x)) - 1] + radius
        j0, j1 = np.searchsorted(py, low), np.searchsorted(py, high, side="right")
        j0 = max(j0, i) if inside else j0
        for j in range(j0, j1, TILE):
            cols = y[j: min(j + TILE, j1)]
            r, c = np.nonzero(np.bitwise_count(rows[:, None] ^ cols[None, :]) <= radius)
            if inside:
                keep = r + i < c + j
                r, c = r[keep], c[keep]
            found.add(rows[r], cols[c])


def _by_popcount(x: np.ndarray) -> np.ndarray:
    return x[np.argsort(np.bitwise_count(x), kind="stable")]


def bucket_links(fps: np.ndarray, mask: int, radius: int, found: Stars):
    """Compare inside every bucket of ``fps & mask``; yields (tile, other tile or None) of buckets over TILE."""
    key = fps & np.uint64(mask)
    order = np.lexsort((np.bitwise_count(fps), key))
    fps, key = fps[order], key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, int)
    size = np.diff(np.r_[first, len(key)])
    small = np.repeat((size > 1) & (size <= SMALL), size)
    f, k = fps[small], key[small]
    for step in range(1, SMALL):
        same = k[step:] == k[:-step] if step < len(k) else np.empty(0, bool)
        if not same.any():
            break
        a, b = f[step:][same], f[:-step][same]
        near = np.bitwise_count(a ^ b) <= radius
        found.add(a[near], b[near])
    for at, n in zip(first[size > SMALL], size[size > SMALL]):
        run = fps[at: at + n]
        if n <= TILE:
            compare(run, None, radius, found)
            continue
        tiles = [run[i: i + TILE] for i in range(0, n, TILE)]
        counts = [(int(np.bitwise_count(t[0])), int(np.bitwise_count(t[-1]))) for t in tiles]
        for i, t in enumerate(tiles):
            yield t, None
            for j in range(i + 1, len(tiles)):
                if counts[j][0] - counts[i][1] <= radius:
                    yield t, tiles[j]


def _fps(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


LINK_SCHEMA = "a long, b long, unit long, head int, data binary"


def _rows(a=(), b=(), unit=(), head=(), data=()) -> pa.RecordBatch:
    n = len(a) or len(unit)
    none = [None] * n
    return pa.RecordBatch.from_arrays(
        [pa.array(a if len(a) else none, pa.int64()), pa.array(b if len(b) else none, pa.int64()),
         pa.array(unit or none, pa.int64()), pa.array(head or none, pa.int32()), pa.array(data or none, pa.binary())],
        names=["a", "b", "unit", "head", "data"])


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def links(fps: DataFrame, radius: int, blocks: int) -> DataFrame:
    """Distinct ``fp`` (long) -> star edges ``(a, b)`` that connect what lies within the radius.

    Two fingerprints within the radius are connected through the edges, and
    edges connect only fingerprints that a chain of such pairs connects.
    """
    spark = fps.sparkSession
    masks = segment_masks(radius, blocks)
    parts = 4 * shuffle_partitions(spark)

    def pack(batches):
        def out(fp):
            part, mask_no, data = [], [], []
            for m, mask in enumerate(masks):
                to = (mix((fp & np.uint64(mask)) + np.uint64(m)) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                to, sorted_fp = to[order], fp[order]
                first = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
                part += to[first].tolist()
                mask_no += [m] * len(first)
                data += [x.tobytes() for x in np.split(sorted_fp, first[1:])]
            return pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(mask_no, pa.int32()), pa.array(data, pa.binary())],
                names=["part", "mask", "data"])
        held, n = [], 0
        for batch in batches:
            held.append(_fps(batch))
            n += len(held[-1])
            if n >= PACK_ROWS:
                yield out(np.concatenate(held))
                held, n = [], 0
        if n:
            yield out(np.concatenate(held))

    def in_buckets(batches):
        by_mask: dict[int, list] = {}
        for batch in batches:
            for m, d in zip(batch.column(1).to_pylist(), batch.column(2)):
                by_mask.setdefault(m, []).append(np.frombuffer(d.as_buffer(), np.uint64))
        found = Stars()
        for m in sorted(by_mask):
            fp = np.concatenate(by_mask.pop(m))
            for k, (x, y) in enumerate(bucket_links(fp, masks[m], radius, found)):
                both = x if y is None else np.concatenate([x, y])
                yield _rows(unit=[int((int(x[0]) * 31 + k * 1_000_003 + m) & 0x7FFFFFFFFFFF)],
                            head=[-1 if y is None else len(x)], data=[both.tobytes()])
        a, b = found.reduce()
        if len(a):
            yield _rows(_signed(a), _signed(b))

    def in_units(batches):
        found = Stars()
        for batch in batches:
            for head, d in zip(batch.column(0).to_pylist(), batch.column(1)):
                fp = np.frombuffer(d.as_buffer(), np.uint64)
                if head < 0:
                    compare(_by_popcount(fp), None, radius, found)
                else:
                    compare(_by_popcount(fp[:head]), _by_popcount(fp[head:]), radius, found)
        a, b = found.reduce()
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(_signed(a)), pa.array(_signed(b))], names=["a", "b"])

    packed = fps.select("fp").mapInArrow(pack, "part int, mask int, data binary")
    met = packed.repartition(shuffle_partitions(spark), "part").mapInArrow(in_buckets, LINK_SCHEMA)
    met = materialize(met, "hamming")
    units = met.filter("unit IS NOT NULL").select("unit", "head", "data")
    wide = units.repartition(shuffle_partitions(spark), "unit").select("head", "data").mapInArrow(in_units, "a long, b long")
    return met.filter("a IS NOT NULL").select("a", "b").unionByName(wide)
