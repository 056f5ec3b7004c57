"""Oracle SQL for TLE parsing and the position grid (DuckDB dialect).

Iterations that the Spark code runs with ``aggregate`` are unrolled here into
one CTE per step; the arithmetic is written out from the same formulas.
"""

from __future__ import annotations

import math

from .oracle import _with
from .plans import positions as P
from .sources.adapters import TLE_LINES_DUCKDB

TWO_PI = repr(2 * math.pi)


def _field(line: str, start: int, width: int) -> str:
    return f"trim(substring({line}, {start}, {width}))"


def _implied(line: str, start: int) -> str:
    s = f"trim(substring({line}, {start}, 8))"
    pat = r"'^([+-]?)(\d{1,5})([+-]\d)$'"
    mant = f"regexp_extract({s}, {pat}, 2)"
    sign = f"(CASE WHEN regexp_extract({s}, {pat}, 1) = '-' THEN -1.0 ELSE 1.0 END)"
    exp = f"TRY_CAST(regexp_extract({s}, {pat}, 3) AS DOUBLE)"
    return (f"CASE WHEN {mant} <> '' THEN {sign} * TRY_CAST('0.' || {mant} AS DOUBLE)"
            f" * pow(10.0, {exp}) END")


def _checksum(line: str) -> str:
    return (f"(list_sum(list_transform(string_split(substring({line}, 1, 68), ''), "
            f"lambda c: CASE WHEN regexp_matches(c, '^[0-9]$') THEN CAST(c AS INTEGER) "
            f"WHEN c = '-' THEN 1 ELSE 0 END)) % 10)")


def _number(line: str) -> str:
    f = _field(line, 3, 5)
    letters = "'ABCDEFGHJKLMNPQRSTUVWXYZ'"
    return (f"CASE WHEN regexp_matches({f}, '^[A-HJ-NP-Z][0-9]{{4}}$') "
            f"THEN CAST((strpos({letters}, substring({f}, 1, 1)) + 9) * 10000 "
            f"+ TRY_CAST(substring({f}, 2, 4) AS INTEGER) AS INTEGER) "
            f"ELSE TRY_CAST({f} AS INTEGER) END")


def tle_fields_sql() -> str:
    return _with() + _tle_select(
        "norad_cat_id, tle_line1, tle_line2", "objects WHERE tle_line1 IS NOT NULL")


def tle_full_fields_sql() -> str:
    return f"WITH lines AS MATERIALIZED ({TLE_LINES_DUCKDB}) " + _tle_select("object_id", "lines")


def globe_positions_sql(t0: str, steps: int, step_seconds: int, digits: int) -> str:
    """Positions from the parsed lines, by the same chain of steps."""
    parsed = _tle_select("object_id", "lines")
    source = f"""lines AS MATERIALIZED ({TLE_LINES_DUCKDB}), objects AS MATERIALIZED (
      SELECT object_id, tle_epoch AS epoch, tle_mean_motion AS mean_motion,
             tle_eccentricity AS eccentricity, tle_inclination AS inclination,
             tle_ra_of_asc_node AS ra_of_asc_node, tle_arg_of_pericenter AS arg_of_pericenter,
             tle_mean_anomaly AS mean_anomaly
      FROM ({parsed}) p WHERE tle_line1_ok AND tle_line2_ok)"""
    ctes, final = _position_ctes("object_id", t0, steps, step_seconds, digits)
    return "WITH " + ",\n".join([source, *ctes]) + final


def _tle_select(keep: str, source: str) -> str:
    l1, l2 = "tle_line1", "tle_line2"
    yy = f"TRY_CAST({_field(l1, 19, 2)} AS INTEGER)"
    day = f"TRY_CAST({_field(l1, 21, 12)} AS DOUBLE)"
    year = f"(CASE WHEN {yy} >= 57 THEN {yy} + 1900 ELSE {yy} + 2000 END)"
    epoch = (f"CASE WHEN {yy} IS NOT NULL AND {day} >= 1 AND {day} < 367 THEN "
             f"make_timestamp({year}, 1, 1, 0, 0, 0) + "
             f"to_microseconds(CAST(round(({day} - 1) * 86400000000.0) AS BIGINT)) END")
    ecc = _field(l2, 27, 7)
    return f"""
    SELECT {keep},
           substring({l1}, 1, 1) AS tle_line1_no,
           {_number(l1)} AS tle_satnum,
           {_field(l1, 8, 1)} AS tle_classification,
           {_field(l1, 10, 8)} AS tle_intl_designator,
           {epoch} AS tle_epoch,
           TRY_CAST({_field(l1, 34, 10)} AS DOUBLE) AS tle_ndot,
           {_implied(l1, 45)} AS tle_nddot,
           {_implied(l1, 54)} AS tle_bstar,
           TRY_CAST({_field(l1, 65, 4)} AS INTEGER) AS tle_element_set_no,
           TRY_CAST({_field(l2, 9, 8)} AS DOUBLE) AS tle_inclination,
           TRY_CAST({_field(l2, 18, 8)} AS DOUBLE) AS tle_ra_of_asc_node,
           CASE WHEN regexp_matches({ecc}, '^\\d+$') THEN TRY_CAST('0.' || {ecc} AS DOUBLE) END
             AS tle_eccentricity,
           TRY_CAST({_field(l2, 35, 8)} AS DOUBLE) AS tle_arg_of_pericenter,
           TRY_CAST({_field(l2, 44, 8)} AS DOUBLE) AS tle_mean_anomaly,
           TRY_CAST({_field(l2, 53, 11)} AS DOUBLE) AS tle_mean_motion,
           TRY_CAST({_field(l2, 64, 5)} AS INTEGER) AS tle_rev_number,
           {_checksum(l1)} = TRY_CAST({_field(l1, 69, 1)} AS INTEGER) AS tle_line1_ok,
           {_checksum(l2)} = TRY_CAST({_field(l2, 69, 1)} AS INTEGER) AS tle_line2_ok
    FROM {source}"""


def _pmod(x: str, m: str) -> str:
    return f"((({x}) % {m}) + {m}) % {m}"


def position_grid_sql(t0: str, steps: int, step_seconds: int) -> str:
    ctes, final = _position_ctes("norad_cat_id, object_name, object_type, country", t0, steps,
                                 step_seconds)
    return _with(*ctes) + final


def _position_ctes(keep: str, t0: str, steps: int, step_seconds: int,
                   digits: int = P.OUTPUT_DIGITS) -> tuple[list[str], str]:
    mu, re_, j2 = repr(P.MU_KM3_S2), repr(P.EARTH_RADIUS_KM), repr(P.J2)
    e2 = repr(P.WGS84_E2)
    ctes = [f"""g0 AS (
      SELECT {keep}, epoch, mean_motion,
             eccentricity AS e, radians(inclination) AS inc, ra_of_asc_node, arg_of_pericenter,
             mean_anomaly, s.step,
             CAST('{t0}' AS TIMESTAMP) + to_seconds(s.step * {step_seconds}) AS t
      FROM objects, range(0, {steps}) s(step)
      WHERE epoch IS NOT NULL AND mean_motion > 0 AND eccentricity >= 0 AND eccentricity < 1)""",
            f"""g1 AS (
      SELECT *, mean_motion * {repr(2 * math.pi / P.SECONDS_PER_DAY)} AS n0,
             epoch_us(t) / 1e6 - epoch_us(epoch) / 1e6 AS dt,
             sin(inc) * sin(inc) AS sin_i2 FROM g0)""",
            f"""g2 AS (
      SELECT *, pow({mu} / (n0 * n0), {repr(1.0 / 3.0)}) AS a FROM g1)""",
            f"""g3 AS (
      SELECT *, {repr(1.5)} * {j2} * pow({re_} / (a * (1.0 - e * e)), 2.0) * n0 AS k FROM g2)""",
            f"""g4 AS (
      SELECT *, {_pmod(f'radians(mean_anomaly) + (n0 + k * sqrt(1.0 - e * e) * (1.0 - 1.5 * sin_i2)) * dt', TWO_PI)} AS M,
             radians(ra_of_asc_node) - k * cos(inc) * dt AS raan,
             radians(arg_of_pericenter) + k * (2.0 - 2.5 * sin_i2) * dt AS argp,
             CASE WHEN e >= {P.HIGH_ECCENTRICITY} THEN pi()
                  ELSE {_pmod(f'radians(mean_anomaly) + (n0 + k * sqrt(1.0 - e * e) * (1.0 - 1.5 * sin_i2)) * dt', TWO_PI)} END AS E0
      FROM g3)"""]
    prev = "g4"
    for i in range(1, P.KEPLER_ITERATIONS + 1):
        ctes.append(f"""k{i} AS (SELECT * REPLACE (E0 - (E0 - e * sin(E0) - M) / (1.0 - e * cos(E0)) AS E0)
                        FROM {prev})""")
        prev = f"k{i}"
    ctes.append(f"""c0 AS (
      SELECT *, 2.0 * atan2(sqrt(1.0 + e) * sin(E0 / 2), sqrt(1.0 - e) * cos(E0 / 2)) AS nu,
             a * (1.0 - e * cos(E0)) AS r FROM {prev})""")
    ctes.append("""c1 AS (SELECT *, argp + nu AS u FROM c0)""")
    ctes.append("""c2 AS (
      SELECT *, r * (cos(raan) * cos(u) - sin(raan) * sin(u) * cos(inc)) AS x,
             r * (sin(raan) * cos(u) + cos(raan) * sin(u) * cos(inc)) AS y,
             r * sin(u) * sin(inc) AS z FROM c1)""")
    ctes.append("""c3 AS (SELECT *, sqrt(x * x + y * y) AS rxy, atan2(z, sqrt(x * x + y * y)) AS lat0
                   FROM c2)""")
    prev = "c3"
    for i in range(1, P.GEODETIC_ITERATIONS + 1):
        ctes.append(f"""l{i} AS (SELECT * REPLACE (atan2(z + {re_} * {e2} * sin(lat0)
                          / sqrt(1.0 - {e2} * sin(lat0) * sin(lat0)), rxy) AS lat0) FROM {prev})""")
        prev = f"l{i}"
    d = "(epoch_us(t) / 1e6 / 86400.0 + 2440587.5 - 2451545.0)"
    tt = f"({d} / 36525.0)"
    gmst = _pmod(f"radians(280.46061837 + 360.98564736629 * {d} + 0.000387933 * {tt} * {tt}"
                 f" - {tt} * {tt} * {tt} / 38710000.0)", TWO_PI)
    lon = _pmod(f"atan2(y, x) - {gmst} + pi()", TWO_PI) + " - pi()"
    # the altitude by another formula than the kernel's: along the equator's plane at
    # low latitudes, along the axis at high ones
    normal = f"{re_} / sqrt(1.0 - {e2} * sin(lat0) * sin(lat0))"
    ctes.append(f"""fin AS (
      SELECT {keep}, step, t,
             degrees(lat0) AS lat, degrees({lon}) AS lng,
             CASE WHEN abs(lat0) < pi() / 4 THEN rxy / cos(lat0) - {normal}
                  ELSE z / sin(lat0) - (1.0 - {e2}) * {normal} END AS alt_km
      FROM {prev} WHERE abs(E0 - e * sin(E0) - M) <= {P.KEPLER_TOLERANCE})""")
    return ctes, f"""
    SELECT {keep}, step, t,
           round(lat, {digits}) + 0.0 AS lat, round(lng, {digits}) + 0.0 AS lng,
           round(alt_km, {digits}) AS alt_km, round(alt_km, {digits}) * 1000 AS alt_m FROM fin
    WHERE lat IS NOT NULL AND NOT isnan(lat) AND abs(lat) < 'inf'::DOUBLE
      AND lng IS NOT NULL AND NOT isnan(lng) AND abs(lng) < 'inf'::DOUBLE
      AND alt_km > 0 AND alt_km IS NOT NULL AND NOT isnan(alt_km) AND abs(alt_km) < 'inf'::DOUBLE"""
