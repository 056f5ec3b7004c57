"""Position grid (E2): latitude, longitude and altitude per object and instant.

**Model: two-body Keplerian motion plus the secular J2 drift of the node,
argument of perigee and mean anomaly.  This is NOT SGP4/SDP4**: no drag, no
periodic terms, no deep-space resonances; errors grow to kilometres within
hours for low orbits.  It is meant for coarse display positions, and results
must not be presented as SGP4-accurate.

Spark shape: each object row generates its own instants with
``explode(sequence(...))`` (a per-row generator, not a join), so the work is
split exactly like the object table.  The orbit math is a vectorised numpy
kernel behind one pandas UDF (Arrow batches); Kepler's equation and the
geodetic latitude are solved with a fixed number of iterations.  Rows without a
possible position are dropped (P13): bad elements, an unsolved Kepler equation, a
point at or below the surface.  ``rejected_positions`` counts them.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import km_to_m

# Fixed physical constants (WGS-84 / EGM values, public).
MU_KM3_S2 = 398600.4418
EARTH_RADIUS_KM = 6378.137
J2 = 1.08262668e-3
WGS84_F = 1 / 298.257223563
WGS84_E2 = WGS84_F * (2 - WGS84_F)
SECONDS_PER_DAY = 86400.0
J2000_JD = 2451545.0
UNIX_EPOCH_JD = 2440587.5
KEPLER_ITERATIONS = 24
KEPLER_TOLERANCE = 1e-9   # largest residual of Kepler's equation, radians
HIGH_ECCENTRICITY = 0.8   # from here on Newton starts at pi, where it cannot overshoot
GEODETIC_ITERATIONS = 6
TWO_PI = 2 * math.pi

ELEMENT_COLUMNS = ["epoch", "mean_motion", "eccentricity", "inclination",
                   "ra_of_asc_node", "arg_of_pericenter", "mean_anomaly"]


def _seconds(ts: Column) -> Column:
    """Seconds since 1970-01-01 UTC of a timestamp or timestamp_ntz column."""
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)


def gmst_rad_np(unix_seconds):
    """Greenwich mean sidereal angle (IAU 1982 polynomial), radians in [0, 2pi)."""
    import numpy as np
    d = unix_seconds / SECONDS_PER_DAY + UNIX_EPOCH_JD - J2000_JD
    t = d / 36525.0
    deg = 280.46061837 + 360.98564736629 * d + 0.000387933 * t * t - t * t * t / 38710000.0
    return np.mod(np.radians(deg), TWO_PI)


def kepler_geodetic(n_rev_day, e, inc_deg, raan_deg, argp_deg, m_deg, dt, t_unix, j2=J2):
    """Vectorised kernel (numpy arrays in, ``(lat_deg, lng_deg, alt_km)`` out)."""
    import numpy as np
    n0 = n_rev_day * (TWO_PI / SECONDS_PER_DAY)
    inc = np.radians(inc_deg)
    with np.errstate(all="ignore"):
        a = np.power(MU_KM3_S2 / (n0 * n0), 1.0 / 3.0)
        p = a * (1.0 - e * e)
        k = 1.5 * j2 * np.power(EARTH_RADIUS_KM / p, 2.0) * n0
        sin_i2 = np.sin(inc) ** 2
        m = np.mod(np.radians(m_deg) + (n0 + k * np.sqrt(1.0 - e * e) * (1.0 - 1.5 * sin_i2)) * dt,
                   TWO_PI)
        raan = np.radians(raan_deg) - k * np.cos(inc) * dt
        argp = np.radians(argp_deg) + k * (2.0 - 2.5 * sin_i2) * dt
        ecc_anom = np.where(e >= HIGH_ECCENTRICITY, np.pi, m)
        for _ in range(KEPLER_ITERATIONS):
            ecc_anom = ecc_anom - (ecc_anom - e * np.sin(ecc_anom) - m) / (1.0 - e * np.cos(ecc_anom))
        residual = np.abs(ecc_anom - e * np.sin(ecc_anom) - m)
        nu = 2.0 * np.arctan2(np.sqrt(1.0 + e) * np.sin(ecc_anom / 2),
                              np.sqrt(1.0 - e) * np.cos(ecc_anom / 2))
        r = a * (1.0 - e * np.cos(ecc_anom))
        u = argp + nu
        x = r * (np.cos(raan) * np.cos(u) - np.sin(raan) * np.sin(u) * np.cos(inc))
        y = r * (np.sin(raan) * np.cos(u) + np.cos(raan) * np.sin(u) * np.cos(inc))
        z = r * np.sin(u) * np.sin(inc)
        rxy = np.sqrt(x * x + y * y)
        lat = np.arctan2(z, rxy)
        for _ in range(GEODETIC_ITERATIONS):
            s = np.sin(lat)
            lat = np.arctan2(z + EARTH_RADIUS_KM * WGS84_E2 * s / np.sqrt(1.0 - WGS84_E2 * s * s), rxy)
        s = np.sin(lat)
        # stable at the poles, where both rxy and cos(lat) vanish
        alt = rxy * np.cos(lat) + z * s - EARTH_RADIUS_KM * np.sqrt(1.0 - WGS84_E2 * s * s)
        alt = np.where((residual <= KEPLER_TOLERANCE) & (alt > 0), alt, np.nan)
        lon = np.arctan2(y, x) - gmst_rad_np(t_unix)
        lon = np.mod(lon + np.pi, TWO_PI) - np.pi
    return np.degrees(lat), np.degrees(lon), alt


_GEO_TYPE = "struct<lat:double,lng:double,alt_km:double>"


def _geo_udf(j2: float):
    @F.pandas_udf(_GEO_TYPE)
    def geo(n: pd.Series, e: pd.Series, inc: pd.Series, raan: pd.Series, argp: pd.Series,
            m: pd.Series, dt: pd.Series, t_unix: pd.Series) -> pd.DataFrame:
        lat, lng, alt = kepler_geodetic(n.to_numpy(float), e.to_numpy(float), inc.to_numpy(float),
                                        raan.to_numpy(float), argp.to_numpy(float),
                                        m.to_numpy(float), dt.to_numpy(float),
                                        t_unix.to_numpy(float), j2)
        return pd.DataFrame({"lat": lat, "lng": lng, "alt_km": alt})

    return geo


def propagate(df: DataFrame, t: str = "t", j2: float = J2) -> DataFrame:
    """Add ``lat``, ``lng`` (degrees) and ``alt_km`` at instant column ``t``.

    The numeric kernel runs as one Arrow-batched pandas UDF: the chained
    trigonometry, written as column expressions, is inlined by the optimiser
    into an expression tree that grows with every Newton step.
    """
    t_unix = _seconds(F.col(t))
    dt = t_unix - _seconds(F.col("epoch"))
    geo = _geo_udf(j2)(F.col("mean_motion").cast("double"), F.col("eccentricity").cast("double"),
                       F.col("inclination").cast("double"), F.col("ra_of_asc_node").cast("double"),
                       F.col("arg_of_pericenter").cast("double"),
                       F.col("mean_anomaly").cast("double"), dt, t_unix)
    return df.withColumn("_geo", geo).select("*", "_geo.*").drop("_geo")


def _finite(c: str) -> Column:
    x = F.col(c)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


OUTPUT_DIGITS = 6  # 1e-6 degree is about 0.1 m; the model error is kilometres


def position_grid(objects: DataFrame, t0: str, steps: int, step_seconds: int = 30,
                  keep: list[str] | None = None, j2: float = J2,
                  digits: int | None = OUTPUT_DIGITS) -> DataFrame:
    """Positions of every object with elements at ``t0 + k * step_seconds``, k < steps.

    ``lat``/``lng`` (degrees) and ``alt_km`` are rounded to ``digits`` decimals
    (None keeps full precision); ``alt_m`` is ``alt_km * 1000``.
    """
    out = _propagated(objects, t0, steps, step_seconds, keep, j2)
    keep = keep or KEEP
    out = out.where(_finite("lat") & _finite("lng") & _finite("alt_km"))
    if digits is not None:
        out = out.select(*keep, "step", "t",
                         *[F.round(c, digits).alias(c) for c in ("lat", "lng", "alt_km")])
    return out.select(*keep, "step", "t", "lat", "lng", "alt_km", km_to_m("alt_km").alias("alt_m"))


def rejected_positions(objects: DataFrame, t0: str, steps: int, step_seconds: int = 30,
                       j2: float = J2) -> DataFrame:
    """One row: ``positions`` asked of objects with valid elements, and how many of
    them :func:`position_grid` drops."""
    out = _propagated(objects, t0, steps, step_seconds, None, j2)
    good = _finite("lat") & _finite("lng") & _finite("alt_km")
    return out.agg(F.count(F.lit(1)).alias("positions"), F.count_if(~good).alias("rejected"))


KEEP = ["norad_cat_id", "object_name", "object_type", "country"]


def _propagated(objects: DataFrame, t0: str, steps: int, step_seconds: int,
                keep: list[str] | None, j2: float) -> DataFrame:
    if steps < 1:
        raise ValueError("steps must be 1 or more")
    keep = keep or KEEP
    valid = objects.where(F.col("epoch").isNotNull() & (F.col("mean_motion") > 0)
                          & (F.col("eccentricity") >= 0) & (F.col("eccentricity") < 1))
    start = F.lit(t0).cast("timestamp_ntz")
    grid = (valid.select(*keep, *ELEMENT_COLUMNS,
                         F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("step"))
                 .withColumn("t", F.timestamp_add("SECOND", F.col("step") * step_seconds, start)))
    return propagate(grid, "t", j2)
