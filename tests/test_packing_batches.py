import math

import pytest
from pyspark.sql import functions as F

from prefdata.operators import batches as B
from prefdata.operators import metrics as M
from prefdata.operators import packing as PK
from tests.reference_rules import h, hnum, pack


def _docs(spark, lengths):
    rows = [(i, [f"d{i}t{j}" for j in range(n)] + ["<eos>"]) for i, n in enumerate(lengths)]
    return spark.createDataFrame(rows, "doc_id long, toks array<string>"), rows


@pytest.mark.parametrize("lengths,L,n_shards", [
    ([3, 4, 5, 40, 2], 4, 1),      # one document longer than three blocks
    ([3, 3], 4, 1),                # tail of 0 after 2 blocks (8 tokens)
    ([4, 3], 5, 1),                # tail of 4 = L-1
    ([5], 5, 1),                   # tail of 1
    ([7, 1, 9, 2, 13, 4, 6], 3, 3),
])
def test_pack_matches_sequential_definition(spark, lengths, L, n_shards):
    df, rows = _docs(spark, lengths)
    got = PK.pack(df, ["doc_id"], "toks", L, n_shards, seed=42).collect()
    got = sorted((r["shard"], r["chunk"], tuple(r["input_ids"])) for r in got)
    expected = []
    for s in range(n_shards):
        docs = sorted([r for r in rows if hnum(h(42, r[0])) % n_shards == s], key=lambda r: (h(42, r[0]), r[0]))
        for c, block in enumerate(pack([r[1] for r in docs], L)):
            expected.append((s, c, tuple(block)))
    assert got == sorted(expected)
    # packed tokens = all tokens minus the dropped tail of every shard
    per_shard = {}
    for i, n in enumerate(lengths):
        s = hnum(h(42, i)) % n_shards
        per_shard[s] = per_shard.get(s, 0) + n + 1
    assert sum(len(b) for _, _, b in got) == sum(t - t % L for t in per_shard.values())


def test_repeat_epochs_and_labels(spark):
    df, _ = _docs(spark, [3, 4])
    rep = PK.repeat_epochs(df, 3)
    assert rep.count() == 6
    blocks = PK.with_labels(PK.pack(rep, ["epoch", "doc_id"], "toks", 4, 1))
    r = blocks.first()
    assert r["labels"] == r["input_ids"]
    assert blocks.count() == (3 * (4 + 5)) // 4


def test_buffer_count():
    assert PK.buffer_count(0) == 1
    assert PK.buffer_count(3774873) == 1  # budget is 1024 * 3.6 * 1024 = 3774873.6 chars
    assert PK.buffer_count(3774874) == 2


def test_batches_positions_and_collate(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    b = B.assign_batches(df, ["k"], 8, 3, seed=42)
    rows = b.collect()
    for s in range(3):
        mine = sorted([r for r in rows if r["shard"] == s], key=lambda r: (r["batch_id"], r["pos"]))
        order = sorted([r["k"] for r in mine], key=lambda k: (h(42, k), k))
        assert [r["k"] for r in mine] == order
        assert all(r["batch_id"] == i // 8 and r["pos"] == i % 8 for i, r in enumerate(mine))
    c = B.collate(b, ["k"]).collect()
    assert sum(r["n"] for r in c) == 100 and max(r["n"] for r in c) == 8
    first = B.first_batches(b, 4, 3).select("shard", "batch_id").distinct().count()
    assert first == 4


def test_length_draw_range(spark):
    df = spark.range(2000).select(B.length_draw(["id"]).alias("g"))
    r = df.agg(F.min("g").alias("lo"), F.max("g").alias("hi")).first()
    assert 32 <= r["lo"] and r["hi"] < 512


def test_pad_longest_per_batch(spark):
    df = spark.createDataFrame([(0, 0, [1, 2, 3]), (1, 0, [4]), (2, 1, [5, 6])],
                               "pos int, batch_id int, ids array<int>").withColumn("shard", F.lit(0))
    out = {r["pos"]: r for r in B.pad_batch(df, "ids", 0).collect()}
    assert out[1]["input_ids"] == [4, 0, 0] and out[1]["attention_mask"] == [1, 0, 0]
    assert out[2]["width"] == 2
    out8 = B.pad_batch(df, "ids", 0, multiple=8).collect()
    assert {r["width"] for r in out8} == {8}


def test_pair_metrics_stable_and_ties(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1000.0, 0.0), (0.0, 1000.0), (2.0, 1.0)], "r_j double, r_k double")
    r = M.pair_metrics(df).first()
    xs = [0.0, 1000.0, -1000.0, 1.0]
    loss = sum(max(-x, 0) + math.log1p(math.exp(-abs(x))) for x in xs) / 4
    assert math.isfinite(r["loss"]) and abs(r["loss"] - round(loss, 6)) < 1e-6
    assert r["accuracy"] == 0.75  # the tie counts as correct


def test_scorer_and_baseline(spark):
    df = spark.createDataFrame([("ab cd",), ("x",)], "t string")
    r = df.select(M.baseline_shift(M.scorer(batch_size=1)(F.col("t")), 0.5).alias("r")).collect()
    assert [x["r"] for x in r] == [5 / 3 - 0.5, 1 / 2 - 0.5]
    stats = M.reward_stats(df.withColumn("g", F.lit(1)).withColumn("v", F.length("t").cast("double")), "v", ["g"]).first()
    assert stats["mean"] == 3.0 and stats["min"] == 1.0 and stats["max"] == 5.0 and stats["std"] == 2.0


def test_map_batches_changes_row_count(spark):
    df = spark.range(10)
    out = M.map_batches(df, lambda b: b.loc[b.index.repeat(2)].reset_index(drop=True), "id long")
    assert out.count() == 20
