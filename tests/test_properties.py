"""Property tests: operators against brute-force Python on random inputs."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyledger.functions import classify as C
from skyledger.operators.aggregates import ratio
from skyledger.operators.dedup import latest_per_key
from skyledger.operators.sampling import quota_sample

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_strategy = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 4)),      # key (nullable)
              st.integers(0, 3),                              # time (ties likely)
              st.text("abc", max_size=2)),                    # payload
    min_size=1, max_size=40)


@SETTINGS
@given(rows=rows_strategy)
def test_latest_per_key_matches_brute_force(spark, rows):
    data = [(k, t, i, p) for i, (k, t, p) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, t int, seq int, p string")
    got = {(r.k, r.seq) for r in latest_per_key(df, ["k"], [F.desc("t"), F.desc("seq")]).collect()}
    best = {}
    for k, t, seq, _ in data:
        if k not in best or (t, seq) > best[k]:
            best[k] = (t, seq)
    assert got == {(k, v[1]) for k, v in best.items()}


@SETTINGS
@given(ids=st.lists(st.integers(0, 300), min_size=1, max_size=60, unique=True),
       strata=st.lists(st.sampled_from(["A", "B", "C"]), min_size=60, max_size=60),
       qa=st.integers(0, 30), qb=st.integers(0, 30),
       width=st.sampled_from([1, 3, 16, 4096]))
def test_quota_sample_matches_brute_force(spark, ids, strata, qa, qb, width):
    data = [(i, strata[n]) for n, i in enumerate(ids)]
    df = spark.createDataFrame(data, "id int, s string")
    quotas = {"A": qa, "B": qb}
    got = sorted((r.s, r.id) for r in quota_sample(df, "s", quotas, "id", width).collect())
    want = []
    for s, q in quotas.items():
        want += [(s, i) for i in sorted(i for i, t in data if t == s)[:q]]
    assert got == sorted(want)


@SETTINGS
@given(pairs=st.lists(st.tuples(st.integers(0, 5000), st.integers(0, 5000)),
                      min_size=1, max_size=50))
def test_ratio_is_half_up_of_the_exact_quotient(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(ratio("n", "d")).collect()]
    want = [None if d == 0 else float((Decimal(n) / Decimal(d)).quantize(
        Decimal("0.0001"), rounding=ROUND_HALF_UP)) for n, d in pairs]
    assert got == want


def _regime(a, p):
    if a is not None and a < 2000:
        return "LEO"
    if p is not None and a is not None and p >= 2000 and a < 35000:
        return "MEO"
    if p is not None and a is not None and p >= 35000 and a <= 36500:
        return "GEO"
    if a is not None and a >= 36500:
        return "HEO"
    return "UNKNOWN"


@SETTINGS
@given(pairs=st.lists(st.tuples(st.one_of(st.none(), st.integers(-100, 40000)),
                                st.one_of(st.none(), st.integers(-100, 40000))),
                      min_size=1, max_size=80))
def test_orbital_regime_matches_rule(spark, pairs):
    df = spark.createDataFrame(pairs, "a int, p int")
    got = [r[0] for r in df.select(C.orbital_regime("a", "p")).collect()]
    assert got == [_regime(a, p) for a, p in pairs]
