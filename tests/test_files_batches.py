"""Places in files, published shard files, differing topics, exact batches, truncation and subword ids."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefdata.catalog import VOCABULARY_FILE
from prefdata.functions.tokens import first_tokens
from prefdata.operators import metrics as M
from prefdata.operators import subword as SW
from prefdata.session import scratch_path
from prefdata.sources import sinks as SK
from prefdata.sources import tables as TB
from prefdata.sources.positions import FilePositions
from tests.conftest import SF001


def test_ranges_open_only_their_files(spark):
    path = scratch_path(spark, "t-places")
    spark.range(100).repartitionByRange(7, "id").sortWithinPartitions("id").write.parquet(path)
    files = FilePositions(spark, path)
    assert files.n_rows == 100
    for start, stop in ((0, 100), (0, 1), (13, 14), (20, 60), (99, 100), (50, 50), (90, 1000), (-5, 3)):
        got = sorted(tuple(r) for r in files.select(start, stop).collect())
        assert got == [(i, i) for i in range(max(start, 0), min(stop, 100))]
    one = files.files_of(20, 21)
    assert len(one) == 1 and len(files.select(20, 21).inputFiles()) == 1
    shards = [sorted(r["id"] for r in files.shard(i, 6).collect()) for i in range(6)]
    assert [len(s) for s in shards] == [17, 17, 17, 17, 16, 16] and sum(shards, []) == list(range(100))


def test_ranges_of_empty_tables_and_odd_paths(spark):
    path = scratch_path(spark, "t-empty")
    spark.range(0).write.parquet(path)
    assert FilePositions(spark, path).take(5).count() == 0
    path = f"{scratch_path(spark, 't odd')}/a b=c"
    spark.range(9).coalesce(1).write.parquet(path)
    assert sorted(r["id"] for r in FilePositions(spark, path).skip(7).collect()) == [7, 8]


def test_publish_survives_a_stop_between_its_phases(spark, monkeypatch):
    path = scratch_path(spark, "t-publish")
    rows = spark.range(40).select("id", F.when(F.col("id") < 30, "a").otherwise("b").alias("split"), (F.col("id") % 3).cast("int").alias("shard"))
    SK.stage_shards(rows, path, order_by=None)
    assert not os.path.exists(f"{path}/data")
    # the driver is lost after some of the renames
    real, done = SK.read_plan, []
    monkeypatch.setattr(SK, "read_plan", lambda s, p: real(s, p).limit(2))
    with monkeypatch.context() as m:
        m.setattr(SK, "PUBLISHED", "_not_yet")
        SK.rename_shards(spark, path)
    monkeypatch.undo()
    done = sum(len(os.listdir(f"{path}/data/{s}")) for s in os.listdir(f"{path}/data"))
    assert done >= 2
    SK.publish_shards(rows, path)
    names = {s: sorted(f for f in os.listdir(f"{path}/data/{s}") if not f.startswith(".")) for s in ("a", "b")}
    assert names == {s: [f"train-{i:05d}-of-00003.parquet" for i in range(3)] for s in ("a", "b")}
    assert sorted(r["id"] for r in SK.read_published(spark, path).collect()) == list(range(40))
    with pytest.raises(FileExistsError):
        SK.publish_shards(rows, path)


def test_common_types():
    t = T._parse_datatype_string
    a = t("q string, answers array<struct<s:int, t:string>>")
    b = t("q string, extra float, answers array<struct<t:string, s:double, who:string>>")
    assert TB.common_type(a, b).simpleString() == "struct<q:string,answers:array<struct<s:double,t:string,who:string>>,extra:float>"
    assert TB.common_type(T.IntegerType(), T.FloatType()) == T.DoubleType()
    assert TB.common_type(T.IntegerType(), T.LongType()) == T.LongType()
    with pytest.raises(TypeError):
        TB.common_type(T.IntegerType(), T.StringType())


def test_topics_that_differ_keep_nulls(spark):
    root = scratch_path(spark, "t-differ")
    kinds = {"x": ("qid int, answers array<struct<s:int>>", [(1, [(1,), None]), (2, None), (3, [])]),
             "y": ("answers array<struct<who:string, s:long>>, qid long", [([("me", 5)], 7)])}
    for name, (schema, rows) in kinds.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/{name}.site/parts")
        part = [f for f in os.listdir(f"{root}/{name}.site/parts") if f.endswith(".parquet")][0]
        os.link(f"{root}/{name}.site/parts/{part}", f"{root}/{name}.site/train-00000-of-00001.parquet")
    out = TB.read_topics_reconciled(spark, root, "x", "y", site_suffix=".site")
    got = {r["qid"]: (r["answers"] and [x and tuple(x) for x in r["answers"]], r["topic"]) for r in out.collect()}
    assert got == {1: ([(1, None), None], "x"), 2: (None, "x"), 3: ([], "x"), 7: ([(5, "me")], "y")}


@pytest.mark.parametrize("arrow_rows", [7, 10_000])
def test_batches_are_exact(spark, arrow_rows):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", arrow_rows)
    try:
        sizes = lambda rows: rows.head(1).assign(n=len(rows))[["n"]].astype("int64")
        got = sorted(r["n"] for r in M.map_batches(spark.range(2345).coalesce(1), sizes, "n long", 1000).collect())
        assert got == [345, 1000, 1000]
        twice = lambda rows: rows.loc[rows.index.repeat(2)]
        assert M.map_batches(spark.range(50), twice, "id long", 9).count() == 100
        assert M.map_batches(spark.range(0), twice, "id long", 9).count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_first_tokens(spark):
    df = spark.createDataFrame([(" a  b c ",), ("a  b",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(first_tokens("t", 2)).collect()] == ["a b", "a  b", "", None]
    scores = [r[0] for r in df.select(M.scorer(max_tokens=2)(F.col("t"))).collect()]
    assert scores == [3 / 3, 4 / 3, 0.0, None]


def test_eval_steps():
    assert M.eval_steps(1500, 500) == [1, 500, 1000, 1500] and M.eval_steps(3, 500) == [1] and M.eval_steps(0, 500) == []


def merged_by_hand(piece: bytes, ranks: dict) -> list[int]:
    """Byte pairs of a word joined one at a time, the lowest rank first, leftmost first."""
    parts = [piece[i: i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        _, i = min(pairs)
        parts[i: i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.skipif(not os.path.exists(VOCABULARY_FILE), reason="no public vocabulary here")
def test_subword_ids(spark):
    import regex

    ranks = SW.read_ranks(spark, VOCABULARY_FILE)
    sub = SW.Subwords(spark, VOCABULARY_FILE)
    docs = TB.table(spark, SF001, "documents").select("text").limit(60)
    odd = spark.createDataFrame([("",), (None,), ("  \n\n x",), ("½ ² <|endoftext|>",), ("ß" * 300,), ("日本語 😀",)], "text string")
    rows = docs.unionByName(odd).select("text", sub.encode("text").alias("ids"), sub.encode("text", eos=True).alias("ended"),
                                        sub.decode(sub.encode("text", eos=True)).alias("back"), SW.truncated(sub, "text", 3).alias("cut")).collect()
    for r in rows:
        assert r["back"] == r["text"]
        if r["text"] is None:
            assert r["ids"] is None
            continue
        words = [w for w in regex.findall(SW.PATTERN, r["text"]) if len(w) < 60]
        if sum(map(len, words)) == len(r["text"]):
            assert r["ids"] == [i for w in words for i in merged_by_hand(w.encode(), ranks)]
        assert r["ended"] == r["ids"] + [sub.eos_id] and r["cut"] == r["ids"][:3]
    with pytest.raises(ValueError):
        SW.read_ranks(spark, VOCABULARY_FILE, max_entries=10)
