"""Boundary tables for the classifiers (edge semantics are part of the tables)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from skyledger.functions import classify as C


def _eval(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_orbital_regime_holes_and_edges(spark):
    cases = [
        ((1500, None), "LEO"),
        ((1999, 100), "LEO"),
        ((2000, 300), "UNKNOWN"),       # hole: neither LEO nor MEO
        ((20000, 2000), "MEO"),
        ((35000, 2000), "UNKNOWN"),     # hole
        ((35786, 35000), "GEO"),
        ((36500, 35000), "GEO"),        # <= 36500 is GEO before HEO
        ((36500, 34000), "HEO"),
        ((35786, 250), "UNKNOWN"),
        ((None, 300), "UNKNOWN"),
        ((None, None), "UNKNOWN"),
    ]
    got = _eval(spark, [c for c, _ in cases], "a int, p int", C.orbital_regime("a", "p"))
    assert got == [e for _, e in cases]


def test_object_category_flags(spark):
    d = dt.date(2020, 1, 1)
    rows = [("PAYLOAD", None), ("PAYLOAD", d), ("ROCKET BODY", None), ("DEBRIS", d),
            ("UNKNOWN", None), (None, None), (None, d)]
    df = spark.createDataFrame(rows, "t string, d date")
    out = df.select(C.object_category("t", "d"), C.is_debris("t"), C.is_active("t", "d")).collect()
    assert [r[0] for r in out] == ["active_payload", "defunct_payload", "rocket_body",
                                   "debris", "unknown", "unknown", "unknown"]
    assert [r[1] for r in out] == [False, False, False, True, False, None, None]
    # null type AND (decay is null): null; null type AND false: false
    assert [r[2] for r in out] == [True, False, False, False, False, None, False]


def test_ladders(spark):
    counts = [(9,), (10,), (99,), (100,), (999,), (1000,)]
    assert _eval(spark, counts, "n long", C.severity("n")) == [
        "insignificant", "minor", "minor", "major", "major", "catastrophic"]
    totals = [(49,), (50,), (199,), (200,), (499,), (500,)]
    assert _eval(spark, totals, "n long", C.congestion_level("n")) == [
        "low", "moderate", "moderate", "high", "high", "critical"]
    per = [(199,), (200,), (299,), (300,), (None,)]
    assert _eval(spark, per, "p int", C.decay_risk("p")) == [
        "imminent", "high", "high", "moderate", "moderate"]


def test_launch_id_and_band(spark):
    rows = [("1999-025ABC",), ("2007-003D",), ("BAD",), (None,), ("1999-25A",)]
    assert _eval(spark, rows, "s string", C.launch_id("s")) == [
        "1999-025", "2007-003", "", None, ""]
    vals = [(0,), (49,), (50,), (-1,), (-50,), (-51,)]
    assert _eval(spark, vals, "a int", C.band("a", 50)) == [0, 0, 50, -50, -50, -100]


def test_constellation_first_match(spark):
    rows = [("Starlink-1",), ("ONEWEB kuiper",), ("iridium 33",), ("GLOBALSTAR M001",),
            ("COSMOS 1",), (None,)]
    assert _eval(spark, rows, "n string", C.constellation("n")) == [
        "Starlink", "OneWeb", "Iridium", "Globalstar", None, None]


def test_lenient_casts(spark):
    rows = [("12",), ("",), ("x",), (None,)]
    assert _eval(spark, rows, "s string", C.lenient("s", "int")) == [12, None, None, None]
    assert _eval(spark, [("2024-05-06T19:53:04.999776",)], "s string",
                 C.lenient("s", "timestamp_ntz")) == [dt.datetime(2024, 5, 6, 19, 53, 4, 999776)]


def test_display_formatters(spark):
    rows = [(0.1235, 1234567, "payload"), (0.0, 0, None), (0.61, 5, "")]
    df = spark.createDataFrame(rows, "r double, n long, t string")
    out = df.select(C.percent("r"), C.thousands("n"), C.debris_tier("r"), C.type_key("t"),
                    C.type_color("t"), C.regime_label(F.lit("MEO"))).collect()
    assert [tuple(r) for r in out] == [
        ("12.4%", "1,234,567", "green", "PAYLOAD", "#22c55e", "Medium Earth Orbit"),
        ("0.0%", "0", "green", "UNKNOWN", "#94a3b8", "Medium Earth Orbit"),
        ("61.0%", "5", "red", "UNKNOWN", "#94a3b8", "Medium Earth Orbit"),
    ]


def test_small_helpers(spark):
    from skyledger.plans.panels import reference_bands
    df = spark.createDataFrame([("debris", "2026-01-02T03:04:05+00:00", 1.5, 2.5)],
                               "t string, ts string, a double, b double")
    r = df.select(C.type_rgba("t"), C.iso_date_part("ts"), C.km_to_m("a"),
                  C.round_half_up("a"), C.round_half_up("b"), C.low_perigee(F.lit(299))).first()
    assert list(r[0]) == [239, 68, 68, 180]
    assert r[1] == "2026-01-02" and r[2] == 1500.0
    assert (r[3], r[4], r[5]) == (2.0, 3.0, True)
    assert [tuple(x) for x in reference_bands(spark).collect()] == [
        ("LEO", 2000), ("MEO", 20200), ("GEO", 35786)]
