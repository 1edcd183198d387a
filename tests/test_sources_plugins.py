import os
import shutil

from pyspark.sql import functions as F

from prefdata.operators import vocab as V
from prefdata.session import scratch_path
from prefdata.sources import tables as TB


def test_read_topics_globs_all_parts(spark):
    root = scratch_path(spark, "t-topics")
    for topic, n in (("philosophy", 3), ("buddhism", 2)):
        df = spark.range(n).select(F.col("id").alias("qid"), F.lit(f"q-{topic}").alias("question"))
        # several part files per topic (the reference could read only one)
        df.repartition(2).write.parquet(f"{root}/{topic}.stackexchange.com/parts")
        parts = f"{root}/{topic}.stackexchange.com/parts"
        for i, f in enumerate(sorted(p for p in os.listdir(parts) if p.endswith(".parquet"))):
            shutil.copy(f"{parts}/{f}", f"{root}/{topic}.stackexchange.com/train-{i:05d}-of-00002.parquet")
    out = TB.read_topics(spark, root, "philosophy", "buddhism")
    got = sorted((r["topic"], r["qid"]) for r in out.collect())
    assert got == [("buddhism", 0), ("buddhism", 1), ("philosophy", 0), ("philosophy", 1), ("philosophy", 2)]


def test_pluggable_tokenizer(spark):
    df = spark.createDataFrame([("ab c def",), ("",)], "t string")

    def factory():
        return lambda text: [len(w) for w in text.split()]

    got = [r["ids"] for r in df.select(V.tokenize_with(factory)("t").alias("ids")).collect()]
    assert got == [[2, 1, 3], []]
