"""Operator 13: prefix trie of conversations by the Euler-tour technique.

Every distinct sequence of first turns is a node.  Nodes are found by running
sums of 128-bit turn hashes (which depend on the turn's place), so no
conversation is ever gathered in one row.  Each node has an enter and an exit
arc; the arcs' successors form one tour of the tree.  The tour is ranked
distributedly: in every round the arcs whose hash is smaller than those of both
neighbours leave the list and hand their weight to the arc before them, until
``LAST`` arcs are left, and then return in reverse order.  A node's subtree is
the difference of the sums at its two arcs.

Orders that need neighbours (turns of a conversation, children of a node) come
from range partitions: neighbours inside a partition by a window, and over its
ends by a table with one row per partition, so a conversation, a first turn or
a parent that holds a third of all rows is spread over many tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefdata.llm.common import materialize, shuffle_partitions

#: Conversations that share a source, and the modulus of the number of turns taken from it.
FAMILY, HEADS = 5, 9
#: Arcs that are ranked in one task at the end of the list contraction (a row is 40 bytes).
LAST = 16_384
#: Ids of members joined into one piece of a list of ids.
PIECE = 8192

PARTS = ["p0", "p1", "p2", "p3"]


def _ranged(df: DataFrame, *keys, name: str) -> DataFrame:
    """``df`` range-partitioned by the keys, with the partition's number in ``part``; written, so that the numbers stay."""
    out = df.repartitionByRange(shuffle_partitions(df.sparkSession), *keys)
    return materialize(out.withColumn("part", F.spark_partition_id()), name)


def _running(df: DataFrame, group: str, order: list, values: list[str]) -> DataFrame:
    """``df`` (from :func:`_ranged` by group and order) with ``values`` replaced by their running sums inside the group."""
    inside = Window.partitionBy("part", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = df.select("*", *(F.sum(v).over(inside).alias(f"sum_{v}") for v in values))
    totals = df.groupBy("part", group).agg(*(F.sum(v).alias(f"all_{v}") for v in values))
    # Only groups that reach over an end of a partition have more than one row here: two per partition at most.
    split = totals.join(totals.groupBy(group).agg(F.count("*").alias("reach")).filter("reach > 1"), group)
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = split.select("part", group, *(F.coalesce(F.sum(f"all_{v}").over(before), F.lit(0)).alias(f"carry_{v}") for v in values))
    joined = local.join(carry, ["part", group], "left")
    plain = [c for c in df.columns if c not in values and c != "part"]
    return joined.select(*plain, *((F.col(f"sum_{v}") + F.coalesce(f"carry_{v}", F.lit(0))).alias(v) for v in values))


def _following(df: DataFrame, group: str, item: str) -> DataFrame:
    """``df`` (from :func:`_ranged` by group and item) with the next and the previous item of the group in ``next`` and ``prev`` (null at its ends)."""
    w = Window.partitionBy("part").orderBy(group, item)
    both = df.select("*", F.lead(F.struct(group, item)).over(w).alias("lead"), F.lag(F.struct(group, item)).over(w).alias("lag"))
    ends = df.groupBy("part").agg(F.min(F.struct(group, item)).alias("first"), F.max(F.struct(group, item)).alias("last"))
    over = Window.orderBy("part")  # one row per partition
    ends = ends.select("part", F.lead("first").over(over).alias("after"), F.lag("last").over(over).alias("before"))
    near = both.join(ends, "part")
    nxt, prv = F.coalesce("lead", "after"), F.coalesce("lag", "before")
    pick = lambda x: F.when(x[group] == F.col(group), x[item])
    return near.select(*[c for c in df.columns if c != "part"], pick(nxt).alias("next"), pick(prv).alias("prev"))


def heads(conv_id: Column) -> Column:
    """Turns that a conversation takes from its source."""
    return F.crc32(conv_id.cast("string")) % HEADS


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, turn_key, size) of every rebuilt turn, and (conv_id, n) of every conversation, turnless ones too.

    ``turn_key`` is an md5 of role and text, ``size`` the text's UTF-8 bytes.
    """
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # The length keeps (role, text) pairs apart.  Ties of a turn are ordered by role and text.
    turns = turns.withColumn("turn_key", F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text"))).withColumn("size", F.octet_length("text"))
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    ranged = _ranged(turns.withColumn("idx", F.lit(1)), "conv_id", *order, name="trie-turns")
    own = _running(ranged, "conv_id", order, ["idx"]).select("conv_id", (F.col("idx") - 1).alias("idx"), "turn_key", "size")
    own = materialize(own, "trie-own")
    convs = own.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    source = F.col("conv_id") - F.col("conv_id") % FAMILY
    sources = convs.select(F.col("conv_id").alias("source"), F.col("n_own").alias("n_source"))
    convs = convs.withColumn("source", source).withColumn("h", heads(F.col("conv_id"))).join(sources, "source", "left")
    convs = materialize(convs.withColumn("taken", F.least("h", F.coalesce("n_source", F.lit(0)))), "trie-convs")
    first = own.filter(F.col("idx") < HEADS).withColumnRenamed("conv_id", "source")
    head = convs.filter("taken > 0").select("conv_id", "source", "taken").join(first, "source").filter("idx < taken")
    tail = own.join(convs.select("conv_id", "h", "taken"), "conv_id").filter("idx >= h").withColumn("idx", F.expr("idx - h + taken"))
    columns = ["conv_id", F.col("idx").alias("pos"), "turn_key", "size"]
    n = F.expr("taken + greatest(n_own - h, 0)")
    return head.select(*columns).unionByName(tail.select(*columns)), convs.select("conv_id", n.alias("n"))


def trie_nodes(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, depth, key, parent_key, conv_id, n_convs, weight) and members (conv_id, depth, key) that end at a node."""
    turns, convs = rebuilt_turns(conversations)
    digest = F.md5(F.concat_ws(":", F.col("pos").cast("string"), "turn_key"))
    parts = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(p) for i, p in enumerate(PARTS)]
    hashed = turns.select("conv_id", "pos", "size", *parts, *(p.alias(f"own_{c}") for p, c in zip(parts, PARTS)))
    sums = _running(_ranged(hashed, "conv_id", "pos", name="trie-places"), "conv_id", ["pos"], PARTS)
    key = lambda cols: F.concat_ws("-", *(F.hex(c) for c in cols))
    path = sums.select("conv_id", (F.col("pos") + 1).alias("depth"), "size", key([F.col(p) for p in PARTS]).alias("key"),
                       key([F.col(p) - F.col(f"own_{p}") for p in PARTS]).alias("parent_key"))
    path = materialize(path, "trie-paths")
    root = key([F.lit(0).cast("long")] * len(PARTS))
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.lit(0).alias("size")).filter("n_convs > 0")
    top = top.select(F.lit(0).cast("long").alias("depth"), root.alias("key"), F.lit(None).cast("string").alias("parent_key"), "conv_id", "n_convs", "size")
    nodes = path.groupBy("depth", "key").agg(F.min("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("size").alias("size"))
    nodes = top.unionByName(nodes).withColumn("weight", (F.col("n_convs") - 1) * F.col("size")).drop("size")
    ends = convs.filter("n = 0").select("conv_id", F.lit(0).cast("long").alias("depth"), root.alias("key"))
    last = path.join(convs.select("conv_id", F.col("n").alias("depth")), ["conv_id", "depth"]).select("conv_id", "depth", "key")
    # An id stays what it is because it is written.
    return materialize(nodes.withColumn("id", F.monotonically_increasing_id()), "trie-nodes"), ends.unionByName(last)


def tour(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Arcs (arc, prev, next, leaves, saved) of the Euler tour, and (id, parent, n_children) of every node.

    The enter arc of node i is 2 i, its exit arc 2 i + 1; the ends of the tour have a null neighbour.
    """
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("key").alias("parent_key"), F.col("id").alias("parent"))
    linked = nodes.join(up, ["depth", "parent_key"], "left").select("id", "parent", "weight")
    kids = _following(_ranged(linked.filter("parent IS NOT NULL"), "parent", "id", name="trie-children"), "parent", "id")
    kids = materialize(kids, "trie-siblings")
    of = kids.groupBy("parent").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n_children"))
    top = linked.filter("parent IS NULL").select("id", "parent", "weight", F.lit(None).cast("long").alias("next"), F.lit(None).cast("long").alias("prev"))
    every = kids.select("id", "parent", "weight", "next", "prev").unionByName(top)
    every = materialize(every.join(of.withColumnRenamed("parent", "id"), "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-tree")
    enter, leave = lambda c: 2 * F.col(c), lambda c: 2 * F.col(c) + 1
    down = every.select(enter("id").alias("arc"), F.coalesce(leave("prev"), enter("parent")).alias("prev"), F.coalesce(enter("first"), leave("id")).alias("next"),
                        (F.col("n_children") == 0).cast("long").alias("leaves"), F.col("weight").alias("saved"))
    back = every.select(leave("id").alias("arc"), F.coalesce(leave("last"), enter("id")).alias("prev"), F.coalesce(enter("next"), leave("parent")).alias("next"),
                        F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"))
    return down.unionByName(back), every.select("id", "parent", "n_children")


def _rank_last(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums from each arc to the end of a list of ``LAST`` arcs at most, by pointer jumping."""
    order = np.argsort(pdf["arc"].to_numpy())
    arc, nxt = pdf["arc"].to_numpy()[order], pdf["next"].to_numpy(float)[order]
    pdf = pdf.iloc[order]
    to = np.where(np.isnan(nxt), len(arc), np.searchsorted(arc, pdf["next"].fillna(0).astype("int64")))
    sums = np.concatenate([pdf[["leaves", "saved"]].to_numpy(np.int64), np.zeros((1, 2), np.int64)])
    to = np.append(to, len(arc))
    while (to[to] != to).any():
        sums = sums + sums[to]
        to = to[to]
    return pd.DataFrame({"arc": arc, "leaves": sums[:-1, 0], "saved": sums[:-1, 1]})


def list_sums(arcs: DataFrame, last: int = LAST) -> DataFrame:
    """(arc, prev, next, leaves, saved) of one list -> (arc, leaves, saved) summed from the arc to the end of the list.

    An arc leaves when its hash is below those of both neighbours (ties by
    number), so two neighbours never leave in one round and about a third of
    the list does; the ends stay.
    """
    now, gone, n_round = materialize(arcs, "trie-tour"), [], 0
    while now.count() > last:
        rank = lambda c: F.struct(F.xxhash64(F.lit(n_round), c), F.col(c))  # noqa: E731, B023
        out = F.coalesce((rank("arc") < rank("prev")) & (rank("arc") < rank("next")) & F.col("prev").isNotNull() & F.col("next").isNotNull(), F.lit(False))
        marked = now.withColumn("out", out)
        leaving = marked.filter("out").drop("out")
        gone.append(materialize(leaving, "trie-gone"))
        left = gone[-1]
        zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
        told = left.select(F.col("prev").alias("arc"), none.alias("new_prev"), F.col("next").alias("new_next"), "leaves", "saved")
        told = told.unionByName(left.select(F.col("next").alias("arc"), F.col("prev").alias("new_prev"), none.alias("new_next"), zero.alias("leaves"), zero.alias("saved")))
        stay = marked.filter("NOT out").select("arc", "prev", "next", none.alias("new_prev"), none.alias("new_next"), "leaves", "saved")
        told = told.select("arc", none.alias("prev"), none.alias("next"), "new_prev", "new_next", "leaves", "saved")
        merged = stay.unionByName(told).groupBy("arc").agg(*(F.max(c).alias(c) for c in ("prev", "next", "new_prev", "new_next")), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        now = materialize(merged.select("arc", F.coalesce("new_prev", "prev").alias("prev"), F.coalesce("new_next", "next").alias("next"), "leaves", "saved"), "trie-list")
        n_round += 1
    sums = now.groupBy(F.lit(0).alias("all")).applyInPandas(lambda pdf: _rank_last(pdf), "arc long, leaves long, saved long")
    sums = materialize(sums, "trie-sums")
    for left in reversed(gone):
        ahead = sums.select(F.col("arc").alias("next"), F.col("leaves").alias("l"), F.col("saved").alias("s"))
        back = left.join(ahead, "next").select("arc", (F.col("leaves") + F.col("l")).alias("leaves"), (F.col("saved") + F.col("s")).alias("saved"))
        sums = materialize(sums.unionByName(back), "trie-sums")
    return sums


def _id_pieces(batches):
    """Rows (depth, key, conv_id) in order -> (depth, key, first, ids): up to ``PIECE`` decimal ids, joined by commas."""
    held, ids = None, []

    def out():
        return pa.RecordBatch.from_pydict({"depth": [held[0]], "key": [held[1]], "first": [ids[0]], "ids": [",".join(map(str, ids))]},
                                          schema=pa.schema([("depth", pa.int64()), ("key", pa.string()), ("first", pa.int64()), ("ids", pa.string())]))
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if row[:2] != held or len(ids) == PIECE:
                if ids:
                    yield out()
                held, ids = row[:2], []
            ids.append(row[2])
    if ids:
        yield out()


def _id_hashes(batches):
    """Pieces in order -> (depth, key, ends_sha256); only the hash is held between two pieces."""
    held, state, done = None, None, []
    for batch in batches:
        for d, k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()):
            if (d, k) != held:
                if held:
                    done.append((*held, state.hexdigest()))
                held, state = (d, k), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if len(done) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=["depth", "key", "ends_sha256"])
            done = []
    if held:
        done.append((*held, state.hexdigest()))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=["depth", "key", "ends_sha256"])


def end_hashes(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, key) -> (depth, key, ends_sha256) of the ascending ids; a long list is joined in pieces by many tasks, one task hashes them in order."""
    parts = shuffle_partitions(ends.sparkSession)
    order = ["depth", "key", "conv_id"]
    pieces = ends.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    pieces = pieces.mapInArrow(_id_pieces, "depth long, key string, first long, ids string")
    pieces = pieces.repartition(parts, "depth", "key").sortWithinPartitions("depth", "key", "first")
    return pieces.mapInArrow(_id_hashes, "depth long, key string, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Rows without a ``conv_id`` belong to no conversation and are left out; a
    null turn comes first; ties of a turn are ordered by role and text, and
    rows that repeat all four count as turns of their own.  Null role or text
    are empty.  The remainder of a negative id is that of SQL (0 or below).
    Other columns are not looked at.  An empty table has no node, not even a
    root.
    """
    nodes, ends = trie_nodes(conversations)
    arcs, tree = tour(nodes)
    sums = materialize(list_sums(arcs), "trie-arc-sums")
    at = sums.select(F.floor(F.col("arc") / 2).cast("long").alias("id"), F.when(F.col("arc") % 2 == 0, 1).otherwise(-1).alias("sign"), "leaves", "saved")
    under = at.groupBy("id").agg(F.sum(F.col("sign") * F.col("leaves")).alias("n_leaves"), F.sum(F.col("sign") * F.col("saved")).alias("saved_tokens"))
    full = nodes.join(tree, "id").join(under, "id")
    parents = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    full = full.join(parents, "parent", "left").join(end_hashes(ends), ["depth", "key"], "left")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return full.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", empty).alias("ends_sha256"))


def prefix_trie_sql() -> str:
    """DuckDB text of :func:`prefix_trie`: members by concatenated turn hashes, subtrees by joining nodes with their members' paths."""
    crc = ("list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii(substr(c::VARCHAR, i::INT, 1))::BIGINT)), "
           "lambda x, b: list_reduce(list_concat([xor(x, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda y, z: xor(y >> 1, CASE WHEN y & 1 = 1 THEN 3988292384 ELSE 0 END)))")
    return f"""
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS idx,
                  md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS k, strlen(coalesce(text, '')) AS size
           FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT c, count(*) AS n_own FROM t GROUP BY c),
h AS (SELECT c, n_own, c - c % {FAMILY} AS src, xor({crc}, 4294967295) % {HEADS} AS h FROM n),
g AS (SELECT h.*, least(h.h, coalesce(s.n_own, 0)) AS taken FROM h LEFT JOIN n s ON s.c = h.src),
r AS (SELECT g.c, t.idx AS pos, k, size FROM g JOIN t ON t.c = g.src AND t.idx < g.taken
      UNION ALL SELECT g.c, t.idx - h + taken, k, size FROM g JOIN t ON t.c = g.c AND t.idx >= g.h),
p AS (SELECT c, pos + 1 AS d, size, md5(string_agg(k, ',' ORDER BY pos) OVER (PARTITION BY c ORDER BY pos)) AS key FROM r
      UNION ALL SELECT c, 0, 0, '' FROM g),
nodes AS (SELECT d, key, min(c) AS c, count(*) AS n_convs, (count(*) - 1) * min(size) AS w FROM p GROUP BY d, key),
tree AS (SELECT x.*, up.c AS parent_c, up.key AS parent_key FROM nodes x LEFT JOIN p q ON q.c = x.c AND q.d = x.d - 1 LEFT JOIN nodes up ON up.d = q.d AND up.key = q.key),
kids AS (SELECT d - 1 AS d, parent_key AS key, count(*) AS n_children FROM tree WHERE d > 0 GROUP BY ALL),
leafy AS (SELECT tree.*, coalesce(n_children, 0) AS n_children FROM tree LEFT JOIN kids USING (d, key)),
under AS (SELECT q.d, q.key, sum((n_children = 0)::INT) AS n_leaves, sum(w) AS saved FROM leafy x JOIN p q ON q.c = x.c AND q.d <= x.d GROUP BY q.d, q.key),
ends AS (SELECT d, key, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM p JOIN (SELECT c, max(d) AS d FROM p GROUP BY c) USING (c, d) GROUP BY d, key)
SELECT c AS conv_id, d AS depth, parent_c AS parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM leafy JOIN under USING (d, key) LEFT JOIN ends USING (d, key)"""
