"""Stateful streams against plain Python, over different micro-batches and across restarts."""

import json

from pyspark.sql import functions as F

from prefdata.functions.tokens import tokens
from prefdata.session import scratch_path
from prefdata.sources import tables as TB
from prefdata.streaming import stateful as SF
from prefdata.streaming import streams as ST
from tests.conftest import SF001
from tests.reference_rules import h, hnum

SHARDS, BUFFER, LENGTH = 3, 10, 64


def write_in_order(docs, path, cuts, skip=0):
    for lo, hi in list(zip(cuts, cuts[1:]))[skip:]:
        docs.filter((F.col("doc_id") >= lo) & (F.col("doc_id") < hi)).coalesce(1).write.mode("append").parquet(path)


def by_shard(ids):
    shards = {}
    for i in sorted(ids):
        shards.setdefault(hnum(h(42, i)) % SHARDS, []).append(i)
    return shards


def shuffled_by_hand(ids):
    out = {}
    for shard, arrivals in by_shard(ids).items():
        held, order = [], []
        for n, i in enumerate(arrivals):
            if len(held) < BUFFER:
                held.append(i)
            else:
                j = hnum(h(42, shard, n)) % BUFFER
                order.append(held[j])
                held[j] = i
        out[shard] = order + [held[j] for j in sorted(range(len(held)), key=lambda j: h(42, shard, "end", j))]
    return out


def test_buffered_shuffle_over_restarts(spark):
    docs = TB.table(spark, SF001, "documents").select("doc_id", "text")
    ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
    top = max(ids) + 1
    want = shuffled_by_hand(ids)
    for cuts in ([0, top // 3, top // 2, top], [0, top]):
        path, root = scratch_path(spark, "t-in"), scratch_path(spark, "t-shuffled")
        shards = lambda: SF.buffered_shuffle(ST.read_stream(spark, path, docs.schema, 1), "doc_id", ["doc_id"], SHARDS, BUFFER)
        write_in_order(docs, path, cuts[:2])
        ST.run_to_table(spark, shards(), "t", root=root)
        write_in_order(docs, path, cuts, skip=1)
        out = ST.run_to_table(spark, shards(), "t", root=root)  # a new query on the same folder goes on
        assert out.count() == len(ids) - SHARDS * BUFFER
        every = out.unionByName(SF.held_rows(spark, f"{root}/checkpoint"))
        got = {}
        for r in every.orderBy("shard", "pos").collect():
            got.setdefault(r["shard"], []).append((r["pos"], json.loads(r["row"])["doc_id"]))
        assert {s: [d for _, d in x] for s, x in got.items()} == want
        assert all([p for p, _ in x] == list(range(len(x))) for x in got.values())
        for shard, arrivals in by_shard(ids).items():
            assert all(arrivals.index(d) <= p + BUFFER for p, d in got[shard])
        assert SF.rows_of(every, docs.schema).drop("shard", "pos").exceptAll(docs).isEmpty()


def test_packer_carries_blocks_over_batches(spark):
    docs = TB.table(spark, SF001, "documents").select("doc_id", F.concat(tokens("text"), F.array(F.lit("<eos>"))).alias("toks"))
    rows = {r["doc_id"]: r["toks"] for r in docs.collect()}
    want, rest = {}, {}
    for shard, ids in by_shard(rows).items():
        flat = [t for i in ids for t in rows[i]]
        full = len(flat) // LENGTH
        want |= {(shard, c): flat[c * LENGTH: (c + 1) * LENGTH] for c in range(full)}
        rest[shard] = flat[full * LENGTH:]
    top = max(rows) + 1
    for cuts in ([0, top // 4, top // 2, top], [0, top]):
        path, root = scratch_path(spark, "t-in"), scratch_path(spark, "t-packed")
        write_in_order(docs, path, cuts)
        stream = SF.pack_stream(ST.read_stream(spark, path, docs.schema, 1), "doc_id", ["doc_id"], "toks", LENGTH, SHARDS)
        out = ST.run_to_table(spark, stream, "t", root=root).collect()
        assert len(out) == len(want) and {(r["shard"], r["chunk"]): r["input_ids"] for r in out} == want
        held = SF.held_tokens(spark, f"{root}/checkpoint").collect()
        assert {r["shard"]: r["input_ids"] for r in held} == rest


def test_a_run_on_the_same_folder_takes_only_new_rows(spark):
    events = TB.table(spark, SF001, "events").select("event_id")
    path, root = scratch_path(spark, "t-in"), scratch_path(spark, "t-resumed")
    half = events.agg(F.expr("percentile_approx(event_id, 0.5)")).first()[0]
    split = lambda: ST.read_stream(spark, path, events.schema).select("event_id", ST.hash_split("event_id").alias("split"))
    for part, total in ((f"event_id <= {half}", None), (f"event_id > {half}", events.count()), ("false", events.count())):
        events.filter(part).write.mode("append").parquet(path)
        out = ST.run_to_table(spark, split(), "t", partition_by=["split"], root=root)
        assert total is None or (out.count() == total == out.select("event_id").distinct().count())


def test_windows_over_a_restart_and_the_closing_pass(spark):
    events = TB.table(spark, SF001, "events").select("ts", "event_type", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"))
    path, root = scratch_path(spark, "t-in"), scratch_path(spark, "t-windows")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    middle = F.lit(low + (high - low) / 2)
    for part in (F.col("ts") < middle, F.col("ts") >= middle):
        events.filter(part).coalesce(1).write.mode("append").parquet(path)
        out = ST.run_to_table(spark, ST.windowed_rewards(ST.read_stream(spark, path, events.schema)), "t", root=root)
    rest = ST.open_windows(spark, f"{root}/checkpoint")
    assert rest.count() and out.join(rest, ["window_start", "event_type"]).isEmpty()
    day = F.unix_seconds(F.date_trunc("day", ST.ntz_to_utc("ts")))
    want = events.groupBy(day.alias("window_start"), "event_type").agg(F.count("*").alias("n"), F.round(F.avg("value"), 5).alias("mean_value"))
    got = out.unionByName(rest).withColumn("mean_value", F.round("mean_value", 5))
    rows = lambda d: sorted(tuple(r) for r in d.collect())
    assert rows(got) == rows(want)


def test_arriving_files_are_written_in_one_pass_and_come_in_order(spark):
    from prefdata import catalog
    from prefdata.streaming import streams as ST

    docs = spark.createDataFrame([(i * 7 % 1000, "t%d" % i) for i in range(1000)] + [(None, "none")], "doc_id long, text string").repartition(6)
    path = catalog._arriving(spark, docs)
    files = [r[0] for r in spark.read.parquet(path).selectExpr("_metadata.file_path").distinct().collect()]
    assert len(files) == 4
    seen = []

    def note(batch, _):
        seen.append(sorted(r["doc_id"] for r in batch.collect()))
    q = ST.read_stream(spark, path, docs.schema, 1).writeStream.foreachBatch(note).trigger(availableNow=True).start()
    q.awaitTermination()
    assert len(seen) == 4 and sum(seen, []) == list(range(1000))
