import pytest
from pyspark.sql import functions as F

from prefdata.operators import cuts
from prefdata.operators import split as S
from tests.reference_rules import holdout_n, split_by_position


def _df(spark, n):
    return spark.range(n).withColumnRenamed("id", "k")


@pytest.mark.parametrize("n", list(range(0, 26)))
def test_split_floors_match_positions(spark, n):
    got = {r["k"]: r["split"] for r in S.split_exact(_df(spark, n), "k").collect()}
    assert got == split_by_position(range(n))


def test_split_disjoint_covering_and_refined_buckets(spark, monkeypatch):
    monkeypatch.setattr(cuts, "FETCH_MAX", 3)  # force prefix refinement
    n = 2000
    got = {r["k"]: r["split"] for r in S.split_exact(_df(spark, n), "k").collect()}
    assert got == split_by_position(range(n))


def test_many_cuts_use_bucket_table(spark):
    n = 1500
    df = _df(spark, n).withColumn("_o", F.md5(F.concat_ws("-", F.lit("42"), F.col("k").cast("string"))))
    cut_list = list(range(10, n, 10))  # > CASE_MAX cuts
    out, total = cuts.assign_intervals(df, "_o", "k", cut_list)
    assert total == n
    got = {r["k"]: r["_interval"] for r in out.collect()}
    order = sorted(range(n), key=lambda k: (df_hash(k), k))
    for pos, k in enumerate(order):
        assert got[k] == sum(1 for c in cut_list if pos >= c)


def df_hash(k):
    import hashlib
    return hashlib.md5(f"42-{k}".encode()).hexdigest()


def test_holdout_first_n_take_skip(spark):
    n = 1000
    df = _df(spark, n)
    order = sorted(range(n), key=lambda k: (df_hash(k), k))
    test = {r["k"] for r in S.holdout(df, "k", 0.005).filter("part = 'test'").collect()}
    assert test == set(order[:holdout_n(n, 0.005)])
    assert {r["k"] for r in S.first_n(df, "k", 37).collect()} == set(order[:37])
    assert S.first_n(df, "k", 5000).count() == n
    valid = {r["k"] for r in S.take_skip(df, "k", 100).filter("part = 'valid'").collect()}
    assert valid == set(order[:100])


def test_same_result_for_1_and_8_partitions(spark):
    df = _df(spark, 500)
    a = sorted(S.split_exact(df.repartition(1), "k").collect())
    b = sorted(S.split_exact(df.repartition(8), "k").collect())
    assert a == b


def test_split_counts(spark):
    rows = {r["split"]: r["n"] for r in S.split_counts(S.split_exact(_df(spark, 100), "k")).collect()}
    assert rows == {"finetune": 30, "reward": 30, "rl": 30, "evaluation": 10}


def test_many_cuts_with_big_buckets_rank_directly(spark, monkeypatch):
    monkeypatch.setattr(cuts, "FETCH_MAX", 2)
    monkeypatch.setattr(cuts, "REFINE_MAX", 3)
    n = 800
    df = _df(spark, n).withColumn("_o", F.md5(F.concat_ws("-", F.lit("42"), F.col("k").cast("string"))))
    cut_list = list(range(7, n, 7))
    out, _ = cuts.assign_intervals(df, "_o", "k", cut_list)
    got = {r["k"]: r["_interval"] for r in out.collect()}
    order = sorted(range(n), key=lambda k: (df_hash(k), k))
    for pos, k in enumerate(order):
        assert got[k] == sum(1 for c in cut_list if pos >= c)


def test_bucket_rows_of_many_cuts_in_one_pass():
    import time

    hist = [(f"{b:04x}", 100) for b in range(65536)]
    at = [(f"{i * 65536 // 100_000:04x}{i:028x}", i) for i in range(100_000)]
    start = time.monotonic()
    rows = cuts.bucket_rows(hist, [cuts.BEFORE_ALL, *at, cuts.AFTER_ALL])
    assert time.monotonic() - start < 5
    assert len(rows) == 65536 and [t for _, _, inner in rows for t in inner] == at
    seen = 1
    for b, base, inner in rows:
        assert base == seen and all(th.startswith(b) for th, _ in inner)
        seen += len(inner)


def test_cuts_are_no_literals_of_a_plan(spark, monkeypatch):
    df = _df(spark, 900).withColumn("_o", F.md5(F.concat_ws("-", F.lit("42"), F.col("k").cast("string"))))

    def isin(*_):
        raise AssertionError("a literal for every cut")
    monkeypatch.setattr(type(F.col("_o")), "isin", isin)
    out, _ = cuts.assign_intervals(df, "_o", "k", list(range(9, 900, 9)))
    assert {r["_interval"]: r["count"] for r in out.groupBy("_interval").count().collect()} == {i: 9 for i in range(100)}
