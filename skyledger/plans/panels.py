"""Panel roll-ups: what the dashboard pages compute from the gold tables.

In the original system these run in the browser over downloaded JSON.  Here
they are DataFrame functions over the gold tables, so they scale with the
tables and never pull a table through one process.  Inputs are small,
already aggregated tables; the only global windows (``over ()``) run over
them, never over object-level data.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import classify as C
from ..operators.paging import PAGE_SIZE, page, page_count, top_n

# Fixed values of the pages.
DASHBOARD_BAND_KM = 200
TOP_COUNTRIES = 15
TOP_CONSTELLATIONS = 3


# A11 ------------------------------------------------------------------------
def rollup_by_type(census: DataFrame) -> DataFrame:
    """Objects per type, re-summed from the census."""
    return census.groupBy("object_type").agg(
        F.sum("object_count").cast("bigint").alias("object_count"))


# A12 + F13 --------------------------------------------------------------------
def regime_breakdown(census: DataFrame) -> DataFrame:
    """Per regime: payload, debris, and everything else counted as rocket body."""
    t, n = F.col("object_type"), F.col("object_count")
    return (census.groupBy("orbital_regime")
            .agg(F.sum(F.when(t == "PAYLOAD", n).otherwise(0)).cast("bigint").alias("payload"),
                 F.sum(F.when(t == "DEBRIS", n).otherwise(0)).cast("bigint").alias("debris"),
                 F.sum(F.when((t == "PAYLOAD") | (t == "DEBRIS"), 0).otherwise(n))
                  .cast("bigint").alias("rocket_body"))
            .withColumn("regime_label", C.regime_label("orbital_regime")))


# A13 ------------------------------------------------------------------------
def total_objects(census: DataFrame) -> DataFrame:
    return census.agg(F.coalesce(F.sum("object_count"), F.lit(0))
                      .cast("bigint").alias("total_objects"))


# A14 + F15 --------------------------------------------------------------------
def headline_counts(census: DataFrame) -> DataFrame:
    """KPI row; UNKNOWN objects only count in the total."""
    t, n = F.col("object_type"), F.col("object_count")

    def s(pred):
        return F.coalesce(F.sum(F.when(pred, n).otherwise(0)), F.lit(0)).cast("bigint")

    out = census.agg(F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("total_objects"),
                     s(t == "PAYLOAD").alias("payloads"),
                     s(t == "DEBRIS").alias("debris"),
                     s(t == "ROCKET BODY").alias("rocket_bodies"))
    return out.withColumn("total_objects_text", C.thousands("total_objects"))


# A15 ------------------------------------------------------------------------
def reband(congestion: DataFrame, width: int = DASHBOARD_BAND_KM) -> DataFrame:
    """Merge fine altitude bands into ``width`` km bands, ascending."""
    return (congestion.withColumn("altitude_band_km", C.band("altitude_band_km", width))
            .groupBy("altitude_band_km")
            .agg(F.sum("active_count").cast("bigint").alias("active_count"),
                 F.sum("debris_count").cast("bigint").alias("debris_count"))
            .orderBy("altitude_band_km"))


# A16 + F14 --------------------------------------------------------------------
def type_share(by_type: DataFrame, value: str = "object_count") -> DataFrame:
    """Share of the total per type, and the whole-percent pie label."""
    total = F.sum(value).over(Window.partitionBy())  # over a per-type table
    share = F.when(total != 0, F.col(value) / total)
    return (by_type.withColumn("share", share)
            .withColumn("percent", F.round(F.col("share") * 100, 0).cast("int"))
            .withColumn("color", C.type_color("object_type")))


# A17 ------------------------------------------------------------------------
def points_by_type(points: DataFrame) -> DataFrame:
    """Number of points per upper-cased type (null or empty type: UNKNOWN)."""
    return points.groupBy(C.type_key("object_type").alias("type_key")).agg(
        F.count(F.lit(1)).alias("points"))


# P12 ------------------------------------------------------------------------
def visible_objects(points: DataFrame, hidden: Iterable[str]) -> DataFrame:
    hidden = [h.upper() for h in hidden]
    if not hidden:
        return points
    return points.where(~C.type_key("object_type").isin(hidden))


# L4 -------------------------------------------------------------------------
def _leader_order():
    return [F.desc("total_objects"), F.asc_nulls_last("country")]


def top_countries(leaderboard: DataFrame, n: int = TOP_COUNTRIES) -> DataFrame:
    return top_n(leaderboard, n, _leader_order())


# L5 + W5 + F15 - F17 ----------------------------------------------------------
def country_page(leaderboard: DataFrame, number: int, size: int = PAGE_SIZE) -> DataFrame:
    """One page of the country table with display rank and formatted cells."""
    p = page(leaderboard, _leader_order(), number, size)
    return p.select(
        "rank", "country", "total_objects", "payload_count", "debris_count",
        "rocket_body_count", "debris_ratio",
        C.thousands("total_objects").alias("total_text"),
        C.percent("debris_ratio").alias("debris_pct"),
        C.debris_tier("debris_ratio").alias("debris_tier"))


def country_pages(leaderboard: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    return page_count(leaderboard, size)


# L6 + F19 ---------------------------------------------------------------------
def top_constellations(growth: DataFrame, n: int = TOP_CONSTELLATIONS) -> DataFrame:
    """Cards for the first ``n`` constellations (largest first, then by name)."""
    top = top_n(growth, n, [F.desc("total_objects"), F.asc_nulls_last("constellation")])
    return top.select("constellation", "total_objects", "active_count",
                      C.thousands("total_objects").alias("total_text"),
                      C.round_half_up("avg_altitude_km", 0).cast("bigint")
                       .alias("avg_altitude_km_rounded"))


# L5 + F18 -------------------------------------------------------------------------
def decay_page(decay: DataFrame, number: int, size: int = PAGE_SIZE) -> DataFrame:
    p = page(decay, [F.asc_nulls_last("perigee_km"), F.asc_nulls_last("norad_cat_id")],
             number, size)
    return p.select("rank", "norad_cat_id", "object_name", "object_type", "country",
                    "perigee_km", "apogee_km", "decay_risk",
                    C.low_perigee("perigee_km").alias("low_perigee"))


# F21 -------------------------------------------------------------------------
def reference_bands(spark: SparkSession) -> DataFrame:
    """The three drawn reference altitudes (a constant, three rows)."""
    return spark.createDataFrame(C.REFERENCE_BANDS_KM, "regime string, altitude_km int")
