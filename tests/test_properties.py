"""Property tests: random small inputs against the plain-Python definitions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from prefdata.operators import cuts
from prefdata.operators import pairs as P
from prefdata.operators import split as S
from tests.reference_rules import all_pairs, h, sampled_pairs

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

answers_st = st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 4)),  # (qid, score)
    min_size=0, max_size=40,
)


@SETTINGS
@given(rows=answers_st, k=st.integers(1, 12))
def test_sampler_definition_and_validity(spark, rows, k):
    data = [(q, i, s) for i, (q, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "qid long, aid long, score int")
    got = sorted((r["qid"], r["pair_no"], r["aid_j"], r["aid_k"]) for r in P.sample_pairs(df, k=k).collect())
    by_q = {}
    for q, a, s in data:
        by_q.setdefault(q, []).append((a, s))
    expected = sorted((q, i, b, w) for q, ans in by_q.items() for i, b, w in sampled_pairs(q, ans, k))
    assert got == expected
    for q, ans in by_q.items():
        mine = [(b, w) for qq, _, b, w in got if qq == q]
        valid = all_pairs(ans)
        assert len(mine) == len(set(mine)) == min(k, len(valid)) and set(mine) <= valid


@SETTINGS
@given(n=st.integers(0, 300), cut_list=st.lists(st.integers(-5, 320), max_size=8))
def test_cuts_match_sorted_positions(spark, n, cut_list):
    cut_list = sorted(cut_list)
    df = spark.range(n).withColumnRenamed("id", "k")
    df = S.with_order(df, "k")
    old = cuts.FETCH_MAX
    cuts.FETCH_MAX = 5
    try:
        out, total = cuts.assign_intervals(df, S.ORDER_COL, "k", cut_list)
        got = {r["k"]: r["_interval"] for r in out.collect()}
    finally:
        cuts.FETCH_MAX = old
    assert total == n
    order = sorted(range(n), key=lambda x: (h(42, x), x))
    for pos, key in enumerate(order):
        assert got[key] == sum(1 for c in cut_list if pos >= c)
