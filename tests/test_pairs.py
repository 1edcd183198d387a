import pytest

from prefdata.operators import pairs as P
from tests.reference_rules import all_pairs, sampled_pairs


def _answers(spark, rows):
    return spark.createDataFrame(rows, "qid long, aid long, score int")


def _sample(spark, rows, **kw):
    out = P.sample_pairs(_answers(spark, rows), **kw).collect()
    return sorted((r["qid"], r["pair_no"], r["aid_j"], r["aid_k"]) for r in out)


def _expected(rows, k=10):
    by_q = {}
    for q, a, s in rows:
        if s is not None:
            by_q.setdefault(q, []).append((a, s))
    out = []
    for q, ans in by_q.items():
        out += [(q, i, b, w) for i, b, w in sampled_pairs(q, ans, k)]
    return sorted(out)


CASES = {
    "zero_one_two": [(1, 1, 5), (2, 2, 5), (2, 3, 1)],
    "all_tied": [(1, i, 3) for i in range(6)],
    "null_score": [(1, 1, 2), (1, 2, None), (1, 3, 1)],
    "exactly_10_pairs": [(1, i, i) for i in range(5)],          # 5 distinct scores -> 10 pairs
    "eleven_pairs": [(1, 0, 0), (1, 1, 1), (1, 2, 2), (1, 3, 3), (1, 4, 3), (1, 5, 3)],
    "large_mixed": [(q, q * 100 + i, (i * 7) % 5) for q in range(3) for i in range(40)],
}


@pytest.mark.parametrize("name", list(CASES))
def test_sampler_matches_definition(spark, name):
    rows = CASES[name]
    assert _sample(spark, rows) == _expected(rows)


@pytest.mark.parametrize("name", list(CASES))
def test_sampled_pairs_are_valid_distinct_and_capped(spark, name):
    rows = CASES[name]
    got = _sample(spark, rows)
    by_q = {}
    for q, a, s in rows:
        if s is not None:
            by_q.setdefault(q, []).append((a, s))
    for q, ans in by_q.items():
        valid = all_pairs(ans)
        mine = [(b, w) for qq, _, b, w in got if qq == q]
        assert len(mine) == min(10, len(valid))
        assert len(set(mine)) == len(mine)
        assert set(mine) <= valid


def test_fewer_than_cap_returns_all_pairs(spark):
    rows = [(1, 1, 3), (1, 2, 2), (1, 3, 1)]
    got = {(b, w) for _, _, b, w in _sample(spark, rows)}
    assert got == all_pairs([(1, 3), (2, 2), (3, 1)])


def test_salted_rank_equals_plain_rank(spark, monkeypatch):
    rows = [(1, i, i % 3) for i in range(300)] + [(2, 1000 + i, 0) for i in range(50)] + [(2, 2000, 1)]
    plain = _sample(spark, rows)
    monkeypatch.setattr(P, "RANK_TARGET", 7)
    salted = P.sample_pairs(_answers(spark, rows), k=10).collect()
    assert plain == sorted((r["qid"], r["pair_no"], r["aid_j"], r["aid_k"]) for r in salted)
    assert plain == _expected(rows)


def test_pair_space_counts(spark):
    rows = [(1, 1, 2), (1, 2, 2), (1, 3, 1), (2, 4, 0)]
    got = {r["qid"]: (r["n_answers"], r["n_pairs"], r["n_tied"]) for r in P.pair_space(_answers(spark, rows)).collect()}
    assert got == {1: (3, 2, 1), 2: (1, 0, 0)}


def test_nested_threads_explode(spark):
    threads = spark.createDataFrame(
        [(7, "<p>q</p>", [(2, "<b>a</b>"), (1, "b"), (2, "c")])],
        "qid long, question string, answers array<struct<pm_score:int, text:string>>")
    flat = P.explode_threads(threads)
    assert flat.columns == ["qid", "question", "aid", "pm_score", "text"]
    pairs = P.sample_pairs(flat.withColumnRenamed("pm_score", "score")).collect()
    assert sorted((r["aid_j"], r["aid_k"]) for r in pairs) == [(0, 1), (2, 1)]


def test_prefix_scan_equals_window_sums(spark):
    rows = [(1, i, (i * 37) % 101) for i in range(400)] + [(2, 1000 + i, i % 3) for i in range(30)] + [(3, 5000, 1)]
    a = _answers(spark, rows)
    cols = ["qid", "score", "n", "above", "pairs", "block", "np"]
    win = sorted(P.score_classes(a).select(*cols).collect())
    for parts in (1, 3, 7):
        scan = sorted(P.score_classes(a, scan_partitions=parts).select(*cols).collect())
        assert scan == win


def test_sampler_with_prefix_scan(spark, monkeypatch):
    rows = [(1, i, (i * 37) % 101) for i in range(300)] + [(2, 1000 + i, i % 4) for i in range(25)]
    monkeypatch.setattr(P, "MAX_WINDOW_CLASSES", 5)
    assert _sample(spark, rows) == _expected(rows)


def test_every_pair_is_drawn_equally_often(spark):
    """NP = 15 pairs, 10 drawn: over many questions each pair's share is 2/3 within 4 standard deviations."""
    n = 1500
    rows = [(q, a, a) for q in range(n) for a in range(6)]
    got = P.sample_pairs(_answers(spark, rows)).groupBy("aid_j", "aid_k").count().collect()
    assert len(got) == 15
    sd = (n * (2 / 3) * (1 / 3)) ** 0.5
    assert all(abs(r["count"] - n * 2 / 3) < 4 * sd for r in got)


def test_only_drawn_answers_are_cleaned(spark):
    from pyspark.sql import functions as F

    rows = [(1, i, i) for i in range(30)]
    answers = _answers(spark, rows).withColumn("text", F.concat(F.lit(" t"), F.col("aid").cast("string")))
    pairs = P.sample_pairs(answers)
    questions = spark.createDataFrame([(1, "q")], "qid long, question string")
    out = P.attach_texts(pairs, answers, questions, clean=F.trim).collect()
    assert len(out) == 10
    assert all(r["response_j"] == f"t{r['aid_j']}" and r["response_k"] == f"t{r['aid_k']}" and r["question"] == "q" for r in out)


def test_small_questions_are_drawn_in_one_shuffle_like_large_ones(spark, monkeypatch):
    import random

    rng = random.Random(3)
    rows = [(rng.randrange(60), "a%d" % i, float(rng.randrange(4))) for i in range(900)]
    rows += [(100, "b%d" % i, float(i % 7)) for i in range(300)] + [(200, "c", 1.0), (201, None, 1.0), (201, "d", 2.0), (None, "e", 1.0), (None, "f", 2.0), (202, "g", None)]
    answers = spark.createDataFrame(rows, "qid long, aid string, score double").repartition(5)
    small = P.sample_pairs(answers, 10)
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # the answers move once, their pairs do not
    got = sorted(map(tuple, small.collect()), key=repr)
    for limit in (0, 100):  # all questions by their class table; the largest by it
        monkeypatch.setattr(P, "SMALL_QUESTION", limit)
        assert sorted(map(tuple, P.sample_pairs(answers, 10).collect()), key=repr) == got
    assert {r[0] for r in got} == set(range(60)) | {100, 201}
