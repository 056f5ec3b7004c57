"""TLE parsing on a public element set; propagation against closed forms."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from skyledger.functions.tle import parse_tle
from skyledger.plans.positions import EARTH_RADIUS_KM, MU_KM3_S2, position_grid

ISS_L1 = "1 25544U 98067A   08264.51782528 -.00002182  00000-0 -11606-4 0  2927"
ISS_L2 = "2 25544  51.6416 247.4627 0006703 130.5360 325.0288 15.72125391563537"
SCHEMA = ("norad_cat_id int, object_name string, object_type string, country string, "
          "epoch timestamp_ntz, mean_motion double, eccentricity double, inclination double, "
          "ra_of_asc_node double, arg_of_pericenter double, mean_anomaly double")


def test_parse_public_tle(spark):
    df = spark.createDataFrame([(ISS_L1, ISS_L2), ("1 00123U", "2 00123"), (None, None)],
                               "tle_line1 string, tle_line2 string")
    rows = parse_tle(df).collect()
    r = rows[0]
    assert r.tle_satnum == 25544 and r.tle_classification == "U"
    assert r.tle_intl_designator == "98067A"
    assert r.tle_epoch == dt.datetime(2008, 9, 20, 12, 25, 40, 104192)
    assert r.tle_bstar == pytest.approx(-0.11606e-4) and r.tle_nddot == 0.0
    assert r.tle_eccentricity == pytest.approx(0.0006703)
    assert r.tle_mean_motion == pytest.approx(15.72125391) and r.tle_rev_number == 56353
    assert r.tle_line1_ok and r.tle_line2_ok
    short = rows[1]
    assert short.tle_satnum == 123 and short.tle_epoch is None and short.tle_line1_ok is None
    assert rows[2].tle_satnum is None
    junk = "1 25544U 98067A   99999999999999 -.00002182  00000-0 -11606-4 0  2927"
    bad = parse_tle(spark.createDataFrame([(junk, ISS_L2)], "tle_line1 string, tle_line2 string"))
    assert bad.first().tle_epoch is None


def _one(spark, n, e, inc, raan, argp, m):
    return spark.createDataFrame(
        [(1, "X", "PAYLOAD", "C", dt.datetime(2020, 1, 1), n, e, inc, raan, argp, m)], SCHEMA)


def test_circular_equatorial_orbit_closed_form(spark):
    n = 15.0
    g = position_grid(_one(spark, n, 0.0, 0.0, 10.0, 20.0, 30.0), "2020-01-01T00:00:00",
                      3, 600, j2=0.0).orderBy("step").collect()
    n0 = n * 2 * math.pi / 86400
    a = (MU_KM3_S2 / n0 ** 2) ** (1 / 3)
    earth_deg_per_s = 360.98564736629 / 86400
    for r in g:
        assert r.lat == pytest.approx(0.0, abs=1e-9)
        assert r.alt_km == pytest.approx(a - EARTH_RADIUS_KM, abs=1e-6)
        assert r.alt_m == pytest.approx(r.alt_km * 1000)
    step = (g[1].lng - g[0].lng) % 360
    assert step == pytest.approx(math.degrees(n0 * 600) - earth_deg_per_s * 600, abs=1e-6)


def test_eccentric_orbit_perigee_and_apogee(spark):
    n, e = 2.0, 0.7
    n0 = n * 2 * math.pi / 86400
    a = (MU_KM3_S2 / n0 ** 2) ** (1 / 3)
    period = 86400 / n
    g = position_grid(_one(spark, n, e, 0.0, 0.0, 0.0, 0.0), "2020-01-01T00:00:00", 2,
                      int(period / 2), j2=0.0).orderBy("step").collect()
    assert g[0].alt_km == pytest.approx(a * (1 - e) - EARTH_RADIUS_KM, rel=1e-9)
    assert g[1].alt_km == pytest.approx(a * (1 + e) - EARTH_RADIUS_KM, rel=1e-6)


def test_bad_elements_are_dropped(spark):
    df = _one(spark, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0).union(_one(spark, 15.0, 1.5, 0.0, 0.0, 0.0, 0.0))
    assert position_grid(df, "2020-01-01T00:00:00", 2, 30).count() == 0


def test_altitude_over_the_pole(spark):
    n = 15.0
    a = (MU_KM3_S2 / (n * 2 * math.pi / 86400) ** 2) ** (1 / 3)
    r = position_grid(_one(spark, n, 0.0, 90.0, 0.0, 90.0, 0.0), "2020-01-01T00:00:00", 1,
                      j2=0.0).first()
    assert abs(r.lat) == pytest.approx(90, abs=1e-5)
    assert r.alt_km == pytest.approx(a - 6356.752314245, abs=1e-5)  # the polar radius


def test_high_eccentricity_converges_and_the_inside_of_the_earth_is_dropped(spark):
    from skyledger.plans.positions import kepler_geodetic, rejected_positions
    import numpy as np
    m = np.linspace(0, 360, 20001)
    e = np.full_like(m, 0.99)
    lat, _, alt = kepler_geodetic(np.full_like(m, 0.05), e, 0 * m, 0 * m, 0 * m, m, 0 * m, 0 * m, 0)
    a = (MU_KM3_S2 / (0.05 * 2 * math.pi / 86400) ** 2) ** (1 / 3)
    r = alt + EARTH_RADIUS_KM
    ecc = np.arccos(np.clip((1 - r / a) / 0.99, -1, 1))
    back = np.degrees(ecc - 0.99 * np.sin(ecc))
    good = np.isfinite(alt)
    assert good[a * (1 - 0.99 * np.cos(np.radians(m))) > 3 * EARTH_RADIUS_KM].all()
    assert np.allclose(back[good], np.minimum(m, 360 - m)[good], atol=1e-3)
    low = _one(spark, 17.5, 0.0, 0.0, 0.0, 0.0, 0.0)  # 80 km below the surface
    assert position_grid(low, "2020-01-01T00:00:00", 3).count() == 0
    assert tuple(rejected_positions(low, "2020-01-01T00:00:00", 3).first()) == (3, 3)
    with pytest.raises(ValueError):
        position_grid(low, "2020-01-01T00:00:00", 0)


def test_positions_from_element_lines(spark):
    from skyledger.functions.tle import elements_from_tle
    lines = spark.createDataFrame([(1, ISS_L1, ISS_L2), (2, ISS_L1, ISS_L2[:-1] + "0")],
                                  "norad_cat_id int, tle_line1 string, tle_line2 string")
    got = position_grid(elements_from_tle(lines), "2008-09-20T12:30:00", 2,
                        keep=["norad_cat_id"]).collect()
    assert {r.norad_cat_id for r in got} == {1} and len(got) == 2  # a wrong checksum is dropped
    assert all(330 < r.alt_km < 380 and abs(r.lat) < 52 for r in got)


def test_letter_led_catalogue_numbers(spark):
    from skyledger.functions.tle import catalogue_number
    df = spark.createDataFrame([("A0000",), ("Z9999",), ("J1234",), ("I0000",), ("25544",)],
                               "n string")
    assert [r[0] for r in df.select(catalogue_number(F.col("n"))).collect()] == \
        [100000, 339999, 181234, None, 25544]


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Run from a folder where worker processes cannot import the package."""
    import subprocess
    import sys
    from compare import ROOT
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
import __spark_entry__ as E
from skyledger.session import get_session
spark = get_session("local-cluster[1,2,1024]", extra={{"spark.checkpoint.dir": {str(tmp_path)!r},
    "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}})
print("ROWS", E.queries()["position_grid"](spark, "/root/testdata/sf0.001").count())
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                         timeout=600)
    assert "ROWS" in out.stdout, out.stderr[-2000:]


def test_polar_orbit_reaches_high_latitude(spark):
    g = position_grid(_one(spark, 14.0, 0.0, 90.0, 0.0, 0.0, 0.0), "2020-01-01T00:00:00",
                      60, 60, j2=0.0)
    assert g.agg(F.max("lat")).first()[0] > 80
