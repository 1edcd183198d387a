from pyspark.sql import functions as F

from prefdata.operators import pairs as P
from prefdata.operators import packing as PK
from prefdata.plans import prepare as PA
from prefdata.plans import reward as RW
from prefdata.plans import rollout as RO
from prefdata.plans import supervised as SU
from prefdata.operators import vocab as V
from prefdata.session import scratch_path
from prefdata.sources import fixtures as FX
from prefdata.sources.sinks import read_manifest
from tests import reference_rules as R
from tests.conftest import SF001, SF01


def _pairs(spark):
    qa = FX.qa_answers(spark, SF01).withColumnRenamed("pm_score", "score")
    questions = FX.qa_questions(spark, SF01)
    return PA.paired_splits(qa, questions)


def test_paired_splits_keep_questions_whole(spark):
    p = _pairs(spark)
    per_q = p.groupBy("qid").agg(F.countDistinct("split").alias("s"), F.count(F.lit(1)).alias("n")).collect()
    assert all(r["s"] == 1 and r["n"] <= 10 for r in per_q)
    assert p.filter(F.col("aid_j") == F.col("aid_k")).count() == 0


def test_prepare_threads_nested_html(spark):
    threads = spark.createDataFrame(
        [(i, f"<p>Question {i} &amp; more</p>", [(s, f"<p>answer <b>{i}-{j}</b></p>") for j, s in enumerate([3, 1, 2, 2])])
         for i in range(20)],
        "qid long, question string, answers array<struct<pm_score:int, text:string>>")
    out = PA.prepare_threads(threads).collect()
    assert len(out) == 20 * 5  # 4 answers, scores 3,1,2,2 -> 5 unequal pairs each
    r = out[0]
    assert r["question"].startswith("Question ") and "&" in r["question"] and "<p>" not in r["question"]
    assert r["response_j"].startswith("answer **")


def test_write_prepared_manifest(spark):
    path = scratch_path(spark, "t-prepared")
    manifest = PA.write_prepared(_pairs(spark), path, shard_bytes=64 << 10).collect()
    total = _pairs(spark).count()
    assert sum(m["rows"] for m in manifest) == total
    assert read_manifest(spark, path).count() == len(manifest)
    rows = spark.read.parquet(path).withColumn("place", F.col("_metadata.row_index")).collect()
    assert "_order" not in spark.read.parquet(path).columns
    for name in {m["split"] for m in manifest}:
        sizes = [m["rows"] for m in sorted(manifest, key=lambda m: m["shard"]) if m["split"] == name]
        assert max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)
        stored = sorted((r["shard"], r["place"], r["pair_key"]) for r in rows if r["split"] == name)
        keys = [k for _, _, k in stored]
        assert keys == sorted(keys, key=lambda k: (R.h(42, k), k))  # contiguous shards, sorted inside


def test_prepared_threads_list_the_files_once(spark, monkeypatch):
    threads = spark.createDataFrame([(i, f"question {i}", [(s, f"answer {i}-{s}") for s in range(4)]) for i in range(30)],
                                    "qid long, question string, answers array<struct<pm_score:int, text:string>>")
    path, listed, reader = scratch_path(spark, "t-once"), [], type(spark.read)
    parquet = reader.parquet
    monkeypatch.setattr(reader, "parquet", lambda self, *paths, **options: listed.extend(paths) or parquet(self, *paths, **options))
    rows = PA.prepared_threads(spark, threads, path, shard_bytes=1 << 10).collect()
    assert listed.count(path) == 1
    assert len(rows) == 30 * 6 and len({(r["split"], r["name"], r["place"]) for r in rows}) == len(rows)
    assert {(r["split"], r["name"]): r["rows"] for r in read_manifest(spark, path).collect()} == {
        k: sum((r["split"], r["name"]) == k for r in rows) for k in {(r["split"], r["name"]) for r in rows}}


def test_shards_of_an_empty_table(spark):
    path = scratch_path(spark, "t-empty")
    empty = spark.createDataFrame([], "qid long, pair_no long, question string, split string")
    assert PA.write_prepared(empty, path).count() == 0


def test_supervised_blocks(spark):
    pairs = _pairs(spark).withColumn("pair_key", F.concat_ws("-", "qid", "pair_no"))
    train, valid, cpt = SU.supervised_blocks(pairs, "pair_key", seq_length=64, num_of_sequences=8, n_epochs=2, test_size=0.2)
    assert cpt > 0
    rows, held = train.collect(), valid.collect()
    for part in (rows, held):
        assert part and all(len(r["input_ids"]) == 64 and r["labels"] == r["input_ids"] for r in part)
    assert len(rows) > len(held)


def test_reward_dataset_and_metrics(spark):
    pairs = _pairs(spark).withColumn("pair_key", F.concat_ws("-", "qid", "pair_no"))
    vocab = V.build_vocab(pairs.withColumn("t", F.concat_ws(" ", "question", "response_j", "response_k")), "t")
    ds = RW.reward_dataset(pairs, "pair_key", vocab, subset=50, max_length=4096, batch_size=4, pad_multiple=8)
    rows = ds.collect()
    assert 0 < len(rows) <= 50
    for r in rows:
        assert len(r["input_ids_j"]) == len(r["attention_mask_j"]) and len(r["input_ids_j"]) % 8 == 0
        assert r["return_loss"] is True
    scores = FX.scores(spark, SF001)
    m = RW.reward_metrics(scores).first()
    assert m["n"] == scores.count() and 0 <= m["accuracy"] <= 1


def test_rollout_rewards(spark):
    turns = FX.qa_turns(spark, SF01).withColumn("query", F.concat(F.lit("Question: "), "question", F.lit("\n\nAnswer: ")))
    rows, log = RO.rollout_rewards(turns, ["conv_id", "turn"], response="answer", baseline=1.0, batch_size=8,
                                   n_batches=3)
    got = rows.collect()
    assert {(r["shard"], r["batch_id"]) for r in got} and len({(r["shard"], r["batch_id"]) for r in got}) <= 3
    assert all(32 <= r["gen_len"] < 512 for r in got)
    assert sum(r["n"] for r in log.collect()) == len(got)


def test_sampler_and_packer_independent_of_partitioning(spark):
    qa = FX.order_lines(spark, SF001)
    a = sorted(P.sample_pairs(qa.repartition(1)).collect())
    b = sorted(P.sample_pairs(qa.repartition(7, "aid")).collect())
    assert a == b
    docs = spark.createDataFrame([(i, [f"t{i}-{j}" for j in range(i % 9 + 1)]) for i in range(60)],
                                 "doc_id long, toks array<string>")
    x = sorted(PK.pack(docs.repartition(1), ["doc_id"], "toks", 5, 3).collect())
    y = sorted(PK.pack(docs.repartition(5), ["doc_id"], "toks", 5, 3).collect())
    assert x == y and x
