"""Gold layer: the six published aggregate tables and the census roll-ups.

Every table is one pass over ``space_objects``: a hash aggregate with partial
(map-side) aggregation, so skewed keys (one country holding a third of the
catalogue) are combined per task before the shuffle and only one row per key
and task crosses the network.  Filters are plain column predicates that
Catalyst pushes into the parquet scan when the input is a stored table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify as C
from ..operators.aggregates import count_if, exact_mean, mean, ratio
from ..operators.sampling import quota_sample

# Fixed values of the published tables.
CONGESTION_BAND_KM = 50
DECAY_MAX_PERIGEE_KM = 400
GLOBE_QUOTAS = {"LEO": 3750, "MEO": 650, "GEO": 600}

GLOBE_COLUMNS = ["norad_cat_id", "object_name", "object_type", "country",
                 "orbital_regime", "tle_line1", "tle_line2"]
DECAY_COLUMNS = ["norad_cat_id", "object_name", "object_type", "country",
                 "apogee_km", "perigee_km", "inclination", "bstar", "epoch",
                 "launch_date", "orbital_regime"]


def _snapshot(snapshot_date) -> Column:
    if snapshot_date is None:
        return F.current_date()
    if isinstance(snapshot_date, Column):
        return snapshot_date
    if isinstance(snapshot_date, _dt.date):
        snapshot_date = snapshot_date.isoformat()
    return F.lit(snapshot_date).cast("date")


# A1 -------------------------------------------------------------------------
def orbital_census(objects: DataFrame, snapshot_date=None) -> DataFrame:
    """Counts and mean altitudes per (type, regime, country)."""
    return (objects.groupBy("object_type", "orbital_regime", "country")
            .agg(F.count(F.lit(1)).alias("object_count"),
                 count_if("is_active").alias("active_count"),
                 count_if("is_debris").alias("debris_count"),
                 F.avg("apogee_km").alias("avg_apogee_km"),
                 F.avg("perigee_km").alias("avg_perigee_km"))
            .withColumn("snapshot_date", _snapshot(snapshot_date)))


# A2 - A4 ----------------------------------------------------------------------
def census_by_type(objects: DataFrame) -> DataFrame:
    return objects.groupBy("object_type").agg(
        F.count(F.lit(1)).alias("count"), count_if("is_active").alias("active_count"))


def census_by_regime(objects: DataFrame) -> DataFrame:
    return objects.groupBy("orbital_regime").agg(F.count(F.lit(1)).alias("count"))


def census_by_country(objects: DataFrame) -> DataFrame:
    return (objects.groupBy("country").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc("country")))


def census_grouping_sets(objects: DataFrame) -> DataFrame:
    """A1-A4 in one aggregate: GROUPING SETS over one scan and one shuffle.

    ``g_type``/``g_regime``/``g_country`` are 1 where that column is rolled up.
    """
    sets = [["object_type", "orbital_regime", "country"], ["object_type"],
            ["orbital_regime"], ["country"]]
    cols = ["object_type", "orbital_regime", "country"]
    return (objects.groupingSets([[F.col(c) for c in s] for s in sets], *cols)
            .agg(F.count(F.lit(1)).alias("object_count"),
                 count_if("is_active").alias("active_count"),
                 count_if("is_debris").alias("debris_count"),
                 F.grouping("object_type").cast("int").alias("g_type"),
                 F.grouping("orbital_regime").cast("int").alias("g_regime"),
                 F.grouping("country").cast("int").alias("g_country")))


# A5 + F7 + F8 + L1 ------------------------------------------------------------
def congestion_metrics(objects: DataFrame, width: int = CONGESTION_BAND_KM,
                       avg_digits: int | None = None) -> DataFrame:
    """Objects per apogee band of ``width`` km (null apogee dropped).

    Mean eccentricity/inclination use :func:`exact_mean`, so re-running the
    job gives the same bits whatever the partitioning.
    """
    return (objects.where(F.col("apogee_km").isNotNull())
            .withColumn("altitude_band_km", C.band("apogee_km", width))
            .groupBy("altitude_band_km")
            .agg(F.count(F.lit(1)).alias("total_objects"),
                 count_if("is_debris").alias("debris_count"),
                 count_if("is_active").alias("active_count"),
                 (exact_mean("eccentricity") if avg_digits is None
                  else mean("eccentricity", avg_digits)).alias("avg_eccentricity"),
                 (exact_mean("inclination") if avg_digits is None
                  else mean("inclination", avg_digits)).alias("avg_inclination"))
            .withColumns({"debris_ratio": ratio("debris_count", "total_objects"),
                          "congestion_level": C.congestion_level("total_objects")})
            .orderBy("altitude_band_km"))


# A6 + L2 --------------------------------------------------------------------
def country_leaderboard(objects: DataFrame) -> DataFrame:
    t = F.col("object_type")
    return (objects.groupBy("country")
            .agg(F.count(F.lit(1)).alias("total_objects"),
                 count_if(t == "PAYLOAD").alias("payload_count"),
                 count_if("is_active").alias("active_count"),
                 count_if("is_debris").alias("debris_count"),
                 count_if(t == "ROCKET BODY").alias("rocket_body_count"))
            .withColumns({"debris_ratio": ratio("debris_count", "total_objects"),
                          "active_ratio": ratio("active_count", "total_objects")})
            .orderBy(F.desc("total_objects"), F.asc_nulls_last("country")))


# A7 + F9 + P11 ----------------------------------------------------------------
def constellation_growth(objects: DataFrame) -> DataFrame:
    return (objects.withColumn("constellation", C.constellation("object_name"))
            .where(F.col("constellation").isNotNull())
            .groupBy("constellation")
            .agg(F.count(F.lit(1)).alias("total_objects"),
                 count_if("is_active").alias("active_count"),
                 count_if("is_debris").alias("debris_count"),
                 F.avg("apogee_km").alias("avg_altitude_km"),
                 F.min("launch_date").alias("first_launch"),
                 F.max("launch_date").alias("latest_launch")))


# P5 + P6 + F10 + L3 -----------------------------------------------------------
def decay_tracker(objects: DataFrame,
                  max_perigee_km: int = DECAY_MAX_PERIGEE_KM) -> DataFrame:
    """Low-perigee objects not yet decayed and with a drag term."""
    return (objects.where((F.col("perigee_km") < max_perigee_km)
                          & F.col("decay_date").isNull()
                          & F.col("bstar").isNotNull())
            .select(*DECAY_COLUMNS)
            .withColumn("decay_risk", C.decay_risk("perigee_km"))
            .orderBy("perigee_km", "norad_cat_id"))


# P8 + W4 + U1 + P9 ------------------------------------------------------------
def globe_data(objects: DataFrame, quotas: dict[str, int] | None = None) -> DataFrame:
    """Objects with a TLE pair: the lowest ids per regime up to the quotas."""
    with_tle = objects.where(F.col("tle_line1").isNotNull() & F.col("tle_line2").isNotNull())
    sampled = quota_sample(with_tle.select(*GLOBE_COLUMNS), "orbital_regime",
                           quotas or GLOBE_QUOTAS, "norad_cat_id")
    return sampled.select(*GLOBE_COLUMNS)


GOLD_TABLES = {
    "orbital_census": orbital_census,
    "congestion_metrics": congestion_metrics,
    "country_leaderboard": country_leaderboard,
    "constellation_growth": constellation_growth,
    "decay_tracker": decay_tracker,
    "globe_data": globe_data,
}
