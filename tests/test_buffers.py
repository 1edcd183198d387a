"""Sequential buffers (T13) against the rule stated one document at a time."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from prefdata.functions.keys import h
from prefdata.operators import buffers as BF
from prefdata.operators import packing as PK


def one_by_one(lengths, budget):
    out, fill, buffer = [], 0, 0
    for n in lengths:
        if fill >= budget:
            fill, buffer = 0, buffer + 1
        fill += n
        out.append(buffer)
    return out


@pytest.mark.parametrize("budget, parts", [(50, 1), (50, 7), (1, 5), (400, 16), (10_000, 6), (10**9, 4)])
def test_buffers_equal_the_sequential_rule(spark, budget, parts):
    rng = random.Random(budget + parts)
    rows = [(i, None if rng.random() < 0.05 else "x" * rng.choice([0, 1, 7, 30, rng.randint(0, 600)])) for i in range(400)]
    docs = spark.createDataFrame(rows, "id long, text string")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r["id"]: r["buffer"] for r in BF.sequential_buffers(docs, ["id"], "text", budget, 3).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    order = [r["id"] for r in docs.select("id").orderBy(h(3, "id"), "id").collect()]
    text = dict(rows)
    assert got == dict(zip(order, one_by_one([len(text[i] or "") for i in order], budget)))


def test_exits_follow_all_starts_of_a_partition():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n = rng.integers(0, 9, rng.integers(1, 40))
        before, budget = 100 + np.cumsum(n) - n, int(rng.integers(1, 20))
        sought, hops = BF.exits(before, budget)
        for i in range(len(n)):
            at, k = i, 1
            while (j := int(np.searchsorted(before, before[at] + budget))) < len(n):
                at, k = j, k + 1
            assert sought[i] == before[at] + budget and hops[i] == k


def test_empty_table_and_blocks_of_buffers(spark):
    docs = spark.createDataFrame([], "id long, text string")
    assert BF.sequential_buffers(docs, ["id"], "text", 5).count() == 0
    with pytest.raises(ValueError):
        BF.sequential_buffers(docs, ["id"], "text", 0)
    rows = spark.createDataFrame([(i, ["a"] * 5, i % 2) for i in range(7)], "id long, toks array<string>, buffer long")
    blocks = PK.pack_buffers(rows, ["id"], "toks", "buffer", 4)
    assert {(r["shard"], r["n"]) for r in blocks.groupBy("shard").agg(F.count("*").alias("n")).collect()} == {(0, 5), (1, 3)}
