"""Time-series operators against plain Python; no window runs over a whole table."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from skyledger.operators.timeseries import (DAY, HOUR, asof_join, carry_forward,
                                            lagged_correlation, spine)
from skyledger.plans.weather import clean_readings, hourly_merge, storm_impact

T0 = dt.datetime(2024, 1, 1)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def windows(text):
    """Partition lists of the windows of a plan."""
    return re.findall(r"\bWindow \[.*?\], \[(.*?)\], \[", text)


def test_spine_has_every_step_once(spark):
    for first, last in ((0, 0), (5, 5), (-30, 100), (3, 24 * 70)):
        bounds = spark.createDataFrame([(at(first), at(last))], "first timestamp, last timestamp")
        got = sorted(r[0] for r in spine(bounds, HOUR, 10 * DAY).collect())
        assert got == [at(h) for h in range(first, last + 1)]
    none = spark.createDataFrame([(None, None)], "first timestamp, last timestamp")
    assert spine(none, HOUR, DAY).count() == 0


@pytest.mark.parametrize("width", [HOUR, 7 * HOUR, 1000 * DAY])
def test_carry_forward(spark, width):
    rng = random.Random(width)
    rows = [(k, at(h), rng.choice([None, None, None, float(h)]))
            for k in ("a", "b", None) for h in rng.sample(range(300), 90)]
    rows.append(("a", None, 5.0))
    df = spark.createDataFrame(rows, "k string, t timestamp, v double")
    got = {(r.k, r.t): (r.v_filled, r.v_since) for r in
           carry_forward(df, ["k"], "t", "v", width).collect()}
    assert len(got) == len(rows)
    for k, t, _ in rows:
        if t is None:
            continue
        before = [(u, v) for j, u, v in rows if j == k and v is not None and u and u <= t]
        last = max(before, default=(None, None))
        assert got[k, t] == (last[1], last[0])


@pytest.mark.parametrize("width,tolerance", [(2 * HOUR, None), (31 * DAY, None), (9 * HOUR, 5 * HOUR)])
def test_asof_join(spark, width, tolerance):
    """A hot key, ties in time, keys on one side only, nulls, clashing names."""
    rng = random.Random(width)
    keys = ["hot"] * 6 + ["a", "b", None]
    left = [(rng.choice(keys + ["left only"]), at(rng.randrange(400)), i) for i in range(300)]
    left += [("hot", None, 900), (None, None, 901), left[0]]
    right = list({(k, t): (k, t, v) for k, t, v in
                  ((rng.choice(keys + ["right only"]), at(rng.randrange(400)), i) for i in range(200))}
                 .values()) + [("hot", None, 999)]
    ldf = spark.createDataFrame(left, "k string, t timestamp, v int")
    rdf = spark.createDataFrame(right, "k string, u timestamp, w int")
    out = asof_join(ldf, rdf, ["k"], "t", "u", ["w"], width, tolerance)
    assert out.columns == ["k", "t", "v", "w", "u_as_of"]

    def expected(k, t):
        if k is None or t is None:
            return None, None
        hits = [(u, w) for j, u, w in right if j == k and u is not None and u <= t
                and (tolerance is None or (t - u).total_seconds() <= tolerance)]
        u, w = max(hits, default=(None, None))
        return w, u
    def order(r):
        return tuple((x is None, x) for x in r)
    assert sorted(map(tuple, out.collect()), key=order) == \
        sorted(((k, t, v, *expected(k, t)) for k, t, v in left), key=order)
    assert all(p and "_k0" in p for p in windows(plan(out)))


def test_asof_join_empty_sides(spark):
    ldf = spark.createDataFrame([(1, T0)], "k int, t timestamp")
    rdf = spark.createDataFrame([], "k int, u timestamp, w int")
    assert [tuple(r) for r in asof_join(ldf, rdf, ["k"], "t", "u", ["w"]).collect()] == \
        [(1, T0, None, None)]
    assert asof_join(ldf.limit(0), rdf, ["k"], "t", "u", ["w"]).count() == 0


def test_lagged_correlation_finds_the_delay(spark):
    rng = random.Random(5)
    x = {h: rng.random() for h in range(200) if h % 7}
    y = {h + 3: 2 * v + rng.random() / 50 for h, v in x.items() if h % 5}
    df = [spark.createDataFrame([(at(h), v) for h, v in s.items()] + [(at(999), None)],
                                "t timestamp, v double") for s in (x, y)]
    out = lagged_correlation(df[0], df[1], "t", "v", "v", 8)
    rows = {r.lag: r for r in out.collect()}
    assert sorted(rows) == list(range(9))
    assert max(rows.values(), key=lambda r: r.correlation).lag == 3
    assert rows[3].slope == pytest.approx(2, abs=0.05)
    for lag, r in rows.items():
        pairs = [(v, y[h + lag]) for h, v in x.items() if h + lag in y]
        mx, my = (sum(p[i] for p in pairs) / len(pairs) for i in (0, 1))
        sxy = sum((a - mx) * (b - my) for a, b in pairs)
        sxx, syy = (sum((p[i] - m) ** 2 for p in pairs) for i, m in ((0, mx), (1, my)))
        assert r.pairs == len(pairs)
        assert r.correlation == pytest.approx(sxy / (sxx * syy) ** 0.5)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    flat = spark.createDataFrame([(at(h), 1.0) for h in range(5)], "t timestamp, v double")
    assert {(r.correlation, r.slope) for r in
            lagged_correlation(flat, df[1], "t", "v", "v", 2).collect()} <= {(None, None)}


READINGS = "series string, time_tag string, value string, reading_id bigint"


def test_hourly_merge_has_gaps_at_both_ends(spark):
    """Wind starts late, Kp stops early, nobody reads in hour 3."""
    rows = [("kp", "2024-01-01 00:30:00", "2", 1), ("kp", "2024-01-01 00:45:00", "4", 2),
            ("kp", "2024-01-01 00:45:00", "9", 3), ("xray", "2024-01-01 02:00:00", "bad", 4),
            ("wind", "2024-01-01 02:10:00", "400", 5), ("kp", "nope", "5", 6),
            ("drag", "2024-01-01 09:00:00", "1", 7), ("wind", "2024-01-01 05:59:59", "410", 8)]
    out = hourly_merge(clean_readings(spark.createDataFrame(rows, READINGS)), width=2 * HOUR)
    got = {r.hour.hour: r for r in out.collect()}
    assert sorted(got) == [0, 1, 2, 3, 4, 5]
    assert [got[h].kp for h in range(6)] == [3.0, None, None, None, None, None]
    assert [got[h].kp_n for h in range(6)] == [2, 0, 0, 0, 0, 0]
    assert [got[h].kp_filled for h in range(6)] == [3.0] * 6
    assert [got[h].kp_age_hours for h in range(6)] == [0, 1, 2, 3, 4, 5]
    assert [got[h].wind_filled for h in range(6)] == [None, None, 400.0, 400.0, 400.0, 410.0]
    assert [got[h].wind_age_hours for h in range(6)] == [None, None, 0, 1, 2, 0]
    assert {(r.xray, r.xray_n, r.xray_filled) for r in got.values()} == {(None, 0, None)}
    assert all("series" in p or "_k0" in p for p in windows(plan(out)))
    empty = spark.createDataFrame([], READINGS)
    assert hourly_merge(clean_readings(empty)).count() == 0
    assert storm_impact(clean_readings(empty)).count() == 0
