"""Operator 12: ranked lexical search over bit-sliced Bloom signatures.

Texts are indexed in blocks of rows.  A row's signature has bits for every
(term, level) whose occurrences reach the level, and a block stores it
transposed: one bitmap over its rows for each bit of the signature.  The
bitmaps of a term's bits, combined, overestimate which rows hold the term that
often; weighted sums of those slices bound the score of every row from above,
as the rows' lengths are known exactly.  The rows with the highest bounds are
scored exactly; their last-ranked score is the threshold, and every row whose
bound reaches it is scored exactly too, so nothing is lost to the signatures.

Rows of like size share a block, so that long texts get wide signatures.  Equal
texts of a task share a row, and only one of them is scored.  Queries go in
blocks of ``ITEM_TERMS`` terms, each over all texts.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prefdata.llm.common import materialize
from prefdata.llm.hamming import mix

#: Documents of an item.
TOP = 50
#: Occurrences that have a bit of their own: an occurrence count is known up to the next level.
LEVELS = np.array([1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 256, 512, 1024, 4096, 16384, 65536, 1 << 20], np.int64)
#: Bits set for a (term, level), bits of a signature for each of them, rows of a block and bytes of a block (about).
HASHES, BITS_PER_KEY, ROWS, BLOCK_BYTES = 10, 16, 2048, 1 << 21
#: Terms of the items that are asked in one pass (their strings and weights travel with the tasks: some MB).
ITEM_TERMS = 20_000
#: Terms whose slices are combined at once; rows of the highest bounds that set an item's threshold, in times of ``top``.
CHUNK, FIRST = 256, 4
#: Texts fetched again by a broadcast of their keys (about 60 bytes each); more are joined by a shuffle.
BROADCAST_KEYS = 200_000

#: ASCII characters other than letters and digits part terms; A-Z are lower-cased; all others belong to terms.
PARTS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))

INDEX = "kind string, a long, b long, term string, docs binary, lengths binary, bits binary, width int"


def terms(text: str | None) -> list[bytes]:
    """Terms of a text with repeats."""
    return (text or "").encode("utf-8", "surrogatepass").translate(PARTS).split()


class _Hashes(dict):
    def __missing__(self, term: bytes) -> int:
        if len(self) >= 1 << 19:
            self.clear()
        self[term] = x = xxhash.xxh3_64_intdigest(term)
        return x


def positions(hashes: np.ndarray, levels: np.ndarray, width: int) -> np.ndarray:
    """(HASHES, keys) bits of (term, level) keys in a signature of ``width`` bits (a power of two)."""
    x = mix(hashes + np.uint64(0x9E3779B97F4A7C15) * (levels.astype(np.uint64) + np.uint64(1)))
    y = mix(x) | np.uint64(1)
    return np.stack([((x + np.uint64(i) * y) >> np.uint64(7)) % np.uint64(width) for i in range(HASHES)]).astype(np.int64)


def width_of(keys: int) -> int:
    return 1 << max(6, math.ceil(math.log2(max(1, keys) * BITS_PER_KEY)))


def sliced(rows: list[tuple[np.ndarray, np.ndarray]], width: int) -> bytes:
    """Signatures of the rows' (hashes, levels), transposed: ``width`` bitmaps over the rows."""
    n = -(-len(rows) // 8) * 8
    bits = np.zeros((width, n), bool)
    for i, (h, lv) in enumerate(rows):
        bits[positions(h, lv, width).reshape(-1), i] = True
    return np.packbits(bits, axis=1).tobytes()


def _index(wanted: frozenset):
    """(text_key, text) -> blocks, document frequencies of the wanted terms and totals of the task."""
    def row(kind, a=None, b=None, term=None, docs=None, lengths=None, bits=None, width=None):
        return pa.RecordBatch.from_pydict({"kind": [kind], "a": [a], "b": [b], "term": [term], "docs": [docs], "lengths": [lengths], "bits": [bits], "width": [width]}, schema=SCHEMA)

    def run(batches):
        known, df, open_, total, words = _Hashes(), Counter(), {}, 0, 0
        seen: dict[str, tuple] = {}

        def close(width):
            keys, lengths, rows = open_.pop(width)
            return row("block", a=len(rows), docs="".join(keys).encode(), lengths=np.array(lengths, np.int64).tobytes(), bits=sliced(rows, width), width=width)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key in seen:
                    n, hit = seen[key]
                else:
                    count = Counter(terms(text))
                    n, hit = sum(count.values()), [t for t in count if t in wanted]
                    if len(seen) >= 1 << 16:
                        seen.clear()
                    seen[key] = n, hit
                    if n:
                        h = np.fromiter(map(known.__getitem__, count), np.uint64, len(count))
                        reach = np.searchsorted(LEVELS, np.fromiter(count.values(), np.int64, len(count)), side="right")
                        h, lv = np.repeat(h, reach), np.arange(reach.sum()) - np.repeat(np.cumsum(reach) - reach, reach)
                        width = width_of(len(h))
                        keys, lengths, rows = open_.setdefault(width, ([], [], []))
                        keys.append(key)
                        lengths.append(n)
                        rows.append((h, lv))
                        if len(rows) >= max(8, min(ROWS, 8 * BLOCK_BYTES // width)):
                            yield close(width)
                if n:
                    total += 1
                    words += n
                    df.update(hit)
        for width in list(open_):
            yield close(width)
        if total:
            yield row("total", total, words)
        if df:
            yield pa.RecordBatch.from_pydict({"kind": ["df"] * len(df), "a": list(df.values()), "b": [None] * len(df), "term": [t.decode("utf-8", "surrogatepass") for t in df],
                                              "docs": [None] * len(df), "lengths": [None] * len(df), "bits": [None] * len(df), "width": [None] * len(df)}, schema=SCHEMA)
    return run


SCHEMA = pa.schema([("kind", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("term", pa.string()), ("docs", pa.binary()), ("lengths", pa.binary()),
                    ("bits", pa.binary()), ("width", pa.int32())])


class Queries:
    """Items, by number, with the weights of their terms and the totals of the texts."""

    def __init__(self, items: list[set[bytes]], df: dict[bytes, int], n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in set().union(*items) if t in df}
        self.items = [[t for t in sorted(x) if t in self.weight] for x in items]

    def norm(self, length):
        return 50 + (50 * length * self.n_docs) // self.n_terms

    def score(self, item: int, count: dict[bytes, int], length: int) -> int:
        m = self.norm(length)
        return sum(self.weight[t] * ((1000000000 * count[t]) // (1000 * count[t] + 20 * m)) for t in self.items[item] if t in count)

    def bounds(self, lengths: np.ndarray, bits: np.ndarray) -> np.ndarray:
        """(items, rows) upper bounds of the scores of a block's rows."""
        n, width = len(lengths), len(bits)
        m = np.array([self.norm(int(x)) for x in lengths], np.int64)
        # What an occurrence count below the next level can give at most, and what a level adds to that.
        most = np.stack([(1000000000 * tf) // (1000 * tf + 20 * m) for tf in (np.minimum(np.append(LEVELS[1:] - 1, 1 << 40), 1 << 33)).tolist()])
        adds = np.diff(most, axis=0, prepend=0)
        adds = adds.astype(np.float64)  # whole numbers below 2**53, as are their weighted sums
        total = np.zeros((len(self.items), n))

        def slices_of(hashes, level):
            return np.bitwise_and.reduce(bits[positions(hashes, np.full(len(hashes), level), width)], axis=0)
        for hashes, weights in self._chunks:
            slices = slices_of(hashes, 0)
            some = np.flatnonzero(slices.any(axis=1))
            if not len(some):
                continue
            slices, hashes, at = slices[some], hashes[some], np.arange(len(some))
            value = np.unpackbits(slices, axis=1, count=n) * adds[0]
            for level in range(1, len(LEVELS)):
                slices = slices & slices_of(hashes, level)
                left = slices.any(axis=1)
                if not left.any():
                    break
                slices, hashes, at = slices[left], hashes[left], at[left]
                value[at] += np.unpackbits(slices, axis=1, count=n) * adds[level]
            total += weights[:, some] @ value
        return total.astype(np.int64)

    @cached_property
    def _chunks(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Hashes of ``CHUNK`` terms at a time and their (items, terms) weights."""
        names, out = list(self.weight), []
        for i in range(0, len(names), CHUNK):
            own = {t: k for k, t in enumerate(names[i: i + CHUNK])}
            weights = np.zeros((len(self.items), len(own)))
            for j, x in enumerate(self.items):
                for t in x:
                    if t in own:
                        weights[j, own[t]] = self.weight[t]
            out.append((np.array([xxhash.xxh3_64_intdigest(t) for t in own], np.uint64), weights))
        return out


def _blocks(batches):
    for batch in batches:
        for a, docs, lengths, bits, width in zip(*(batch.column(i).to_pylist() for i in range(5))):
            yield [docs[32 * i: 32 * i + 32].decode() for i in range(a)], np.frombuffer(lengths, np.int64), np.frombuffer(bits, np.uint8).reshape(width, -1)


def _best(q: Queries, top: int):
    """Blocks -> (item, text_key, bound): the rows with the highest bounds of the task, ``top`` for each item."""
    def run(batches):
        heaps = [[] for _ in q.items]
        for keys, lengths, bits in _blocks(batches):
            bound = q.bounds(lengths, bits)
            for i, row in enumerate(bound):
                least = heaps[i][0][0] if len(heaps[i]) == top else 0
                some = np.flatnonzero(row > least)
                if len(some) > top:
                    some = some[np.argpartition(-row[some], top - 1)[:top]]
                for r in some:
                    (heapq.heappushpop if len(heaps[i]) == top else heapq.heappush)(heaps[i], (int(row[r]), keys[r]))
        out = [(i, k, b) for i, heap in enumerate(heaps) for b, k in heap]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["item", "text_key", "bound"])
    return run


def _reaching(q: Queries, least: list[int]):
    """Blocks -> (item, text_key) of every row whose bound reaches the item's threshold."""
    def run(batches):
        floor = np.maximum(np.array(least, np.int64), 1)[:, None]
        for keys, lengths, bits in _blocks(batches):
            item, at = np.nonzero(q.bounds(lengths, bits) >= floor)
            if len(item):
                yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int64)), pa.array([keys[r] for r in at])], names=["item", "text_key"])
    return run


def _exact(q: Queries):
    """(text_key, items, text) -> (item, text_key, score) by the formula, for scores above 0."""
    def run(batches):
        for batch in batches:
            out = []
            for key, items, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                count = Counter(terms(text))
                length = sum(count.values())
                out += [(i, key, s) for i in items if (s := q.score(i, count, length)) > 0]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["item", "text_key", "score"])
    return run


def _scores(texts: DataFrame, pairs: DataFrame, q: Queries) -> DataFrame:
    """(item, text_key) pairs -> (item, text_key, score), one text of each key being read again."""
    by_text = materialize(pairs.distinct().groupBy("text_key").agg(F.collect_list("item").alias("items")), "search-pairs")  # the items of a pass at most
    keys = by_text.select("text_key")
    hint = F.broadcast if by_text.count() <= BROADCAST_KEYS else (lambda x: x)
    one = texts.join(hint(keys), "text_key", "left_semi")
    one = one.join(by_text, "text_key").select("text_key", "items", "text")
    # Copies of a text give equal scores: they are scored where they lie and meet as numbers.
    return materialize(one.mapInArrow(_exact(q), "item long, text_key string, score long").distinct(), "search-scores")


def _item_blocks(items: DataFrame):
    """Lists of (item_id, set of terms), each of ``ITEM_TERMS`` terms or one item."""
    held, size = [], 0
    for r in items.select("item_id", "text").distinct().orderBy("item_id", "text").toLocalIterator():
        own = set(terms(r["text"]))
        if held and size + len(own) > ITEM_TERMS:
            yield held
            held, size = [], 0
        held.append((r["item_id"], own))
        size += len(own)
    if held:
        yield held


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score of the ``top`` documents of each item, among scores above 0.

    Equal scores are ordered by document id, null ids last.  Null and empty
    texts have no term; they neither count nor match.  Rows of ``docs`` that
    repeat an id or a text are documents of their own.  Items without a term
    give no row; equal rows of ``items`` count once, items that share an id are
    ranked each on its own.  No items or no documents give no rows.  Other
    columns are not looked at.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.md5("text").alias("text_key"), "text").filter("text IS NOT NULL")
    parts = []
    for block in _item_blocks(items):
        wanted = frozenset().union(*(x for _, x in block))
        index = materialize(texts.select("text_key", "text").mapInArrow(_index(wanted), INDEX), "search-index")
        total = index.filter("kind = 'total'").agg(F.sum("a"), F.sum("b")).first()
        df = {r["term"].encode("utf-8", "surrogatepass"): r["n"] for r in index.filter("kind = 'df'").groupBy("term").agg(F.sum("a").alias("n")).toLocalIterator()}
        q = Queries([x for _, x in block], df, total[0] or 0, total[1] or 0)
        blocks = index.filter("kind = 'block'").select(F.col("a").cast("int"), "docs", "lengths", "bits", "width")
        first = blocks.mapInArrow(_best(q, FIRST * top), "item long, text_key string, bound long").distinct()
        order = Window.partitionBy("item").orderBy(F.desc("bound"), "text_key")
        first = first.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= FIRST * top).select("item", "text_key")
        known = _scores(texts, first, q)
        # Texts that are copies of each other are documents each; counting each text once keeps the threshold low enough.
        least = known.withColumn("n", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))).filter(F.col("n") == top)
        floor = {r["item"]: r["score"] for r in least.select("item", "score").collect()}  # a row per item of the pass
        scored = _scores(texts, blocks.mapInArrow(_reaching(q, [floor.get(i, 0) for i in range(len(block))]), "item long, text_key string"), q)
        # Of a text, the documents with the smallest ids are enough.
        keys = scored.select("text_key").distinct()
        by_id = [F.col("doc_id").asc_nulls_last()]
        ids = texts.select("doc_id", "text_key").join(keys, "text_key", "left_semi")
        ids = ids.withColumn("n", F.row_number().over(Window.partitionBy("text_key").orderBy(*by_id))).filter(F.col("n") <= top).drop("n")
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), *by_id))
        found = scored.join(ids, "text_key").withColumn("rank", rank).filter(F.col("rank") <= top)
        names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(block)], f"item long, item_id {items.schema['item_id'].dataType.simpleString()}")
        parts.append(materialize(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "search-ranked"))
    if not parts:
        return spark.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def ranked_sql(top: int = TOP) -> str:
    """DuckDB text of :func:`ranked`: every document scored for every item."""
    words = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words.format('text')} AS w FROM documents WHERE text IS NOT NULL),
n AS (SELECT r, doc_id, len(w) AS n FROM d WHERE len(w) > 0),
t AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM n),
q AS (SELECT DISTINCT item_id, unnest({words.format('text')}) AS term FROM benchmark),
f AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM f GROUP BY term), t),
s AS (SELECT q.item_id, f.r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
      FROM q JOIN f USING (term) JOIN w USING (term) JOIN n USING (r), t GROUP BY q.item_id, f.r),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s JOIN n USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= {top}"""
