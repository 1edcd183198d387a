import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from prefdata.operators import shards as SH
from prefdata.session import scratch_path
from prefdata.sources import sinks as SK
from prefdata.sources import tables as TB
from prefdata.streaming import streams as ST
from tests.conftest import SF001
from prefdata import catalog
from tests.reference_rules import h, hnum


def test_stream_split_equals_batch_thresholds(spark):
    path = f"{SF001}/events[.]parquet"
    s = ST.read_stream(spark, path, TB.table(spark, SF001, "events").schema)
    out = ST.run_to_table(spark, s.select("event_id", ST.hash_split("event_id").alias("split")), "t-split",
                          partition_by=["split"])
    got = {r["event_id"]: r["split"] for r in out.collect()}
    names = ["finetune"] * 3 + ["reward"] * 3 + ["rl"] * 3 + ["evaluation"]
    assert len(got) == TB.table(spark, SF001, "events").count()
    assert all(got[e] == names[hnum(h(42, e)) % 10] for e in got)


def test_stream_holdout_fraction(spark):
    df = spark.range(20000).select(ST.hash_holdout("id", 0.05).alias("p"))
    share = df.filter("p = 'valid'").count() / 20000
    assert 0.04 < share < 0.06


def test_windowed_rewards_drop_open_window(spark):
    path = f"{SF001}/events[.]parquet"
    s = ST.read_stream(spark, path, TB.table(spark, SF001, "events").schema)
    out = ST.run_to_table(spark, ST.windowed_rewards(s), "t-rewards")
    ev = TB.table(spark, SF001, "events")
    last = ev.agg(F.max("ts")).first()[0]
    starts = {r["window_start"] for r in out.collect()}
    assert starts and max(starts) + 86400 <= last.replace(tzinfo=__import__("datetime").timezone.utc).timestamp() - 3600


def test_buffered_shuffle_writes_everything(spark):
    path = f"{SF001}/events[.]parquet"
    s = ST.read_stream(spark, path, TB.table(spark, SF001, "events").schema)
    root = scratch_path(spark, "t-shuffle")
    q = ST.shuffle_each_batch(s.select("event_id"), "event_id", f"{root}/data", f"{root}/chk")
    q.awaitTermination()
    assert spark.read.parquet(f"{root}/data").count() == TB.table(spark, SF001, "events").count()


def test_contiguous_shards_and_sink(spark):
    docs = TB.table(spark, SF001, "documents")
    sharded = SH.split_and_shard(docs, "doc_id", shard_bytes=32 << 10)
    rows = sharded.select("doc_id", "split", "shard").collect()
    by_split = {}
    for r in rows:
        by_split.setdefault(r["split"], []).append(r)
    for split, rs in by_split.items():
        counts = {}
        for r in rs:
            counts[r["shard"]] = counts.get(r["shard"], 0) + 1
        sizes = [counts[i] for i in sorted(counts)]
        assert sorted(counts) == list(range(len(counts)))
        assert max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)
    path = scratch_path(spark, "t-sink")
    manifest = SK.write_sharded(sharded, path).collect()
    assert sum(m["rows"] for m in manifest) == len(rows)
    assert all(m["name"].startswith("train-") for m in manifest)
    with pytest.raises(Exception):
        SK.write_sharded(sharded, path)  # K5: refuses an existing target
    back = TB.read_split(spark, path, "rl")
    assert back.count() == len(by_split.get("rl", []))


def test_topic_paths():
    assert TB.topic_paths("/d", "philosophy") == ["/d/philosophy.stackexchange.com/train-*.parquet"]


def test_entry_and_registry(spark):
    df = entry.entry(spark)
    assert set(df.columns) == {"split", "n_pairs", "n_questions", "n_chars"}
    assert df.count() >= 1
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs) and set(catalog.QUERIES) <= set(qs)
    assert set(catalog.QUERIES) == set(catalog.SQL)


def test_checkpoint_dir_is_read_from_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert root and os.path.isdir(root)
