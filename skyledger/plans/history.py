"""Analyses over the element history and catalogue snapshots.

These were planned but never built in the original system; semantics here are
ours and stated per function.  All of them are skew-safe: per-object work is
expressed as partially aggregated aggregates (``regr_slope``, ``min_by``,
``max_by``), snapshot comparisons join tables that are unique on their keys,
and the only global windows run over small aggregated tables (years).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify as C
from ..operators.aggregates import count_if
from ..operators.dedup import latest_per_key, upsert
from . import silver
from .positions import EARTH_RADIUS_KM, MU_KM3_S2, SECONDS_PER_DAY

# Fixed values of the heatmap.
HEATMAP_ALT_BAND_KM = 500
HEATMAP_INC_BAND_DEG = 10


def mean_motion_altitude_km(mean_motion: Column) -> Column:
    """Mean altitude from mean motion (rev/day): ``(mu / n^2)^(1/3) - R``."""
    n = mean_motion * F.lit(2 * 3.141592653589793 / SECONDS_PER_DAY)
    return F.pow(F.lit(MU_KM3_S2) / (n * n), F.lit(1.0 / 3.0)) - F.lit(EARTH_RADIUS_KM)


# X4 -------------------------------------------------------------------------
def altitude_trend(gp_raw: DataFrame) -> DataFrame:
    """Per object over its whole element history: epochs seen, first/last epoch,
    first/last mean altitude and the least-squares slope (km/day).

    One hash aggregate with map-side partial aggregation: an object holding a
    third of all history rows is reduced inside each task before the shuffle.
    Rows without a positive mean motion or a parsable epoch are ignored.
    """
    typed = silver.clean_gp(gp_raw).where(F.col("epoch").isNotNull()
                                          & (F.col("mean_motion") > 0))
    days = F.unix_micros(F.col("epoch").cast("timestamp")) / F.lit(86_400e6)
    h = typed.select("norad_cat_id", "epoch", days.alias("_day"),
                     mean_motion_altitude_km(F.col("mean_motion")).alias("_alt"))
    order = F.struct("epoch", "_alt")
    return h.groupBy("norad_cat_id").agg(
        F.count(F.lit(1)).alias("epochs"),
        F.min("epoch").alias("first_epoch"),
        F.max("epoch").alias("last_epoch"),
        F.min_by("_alt", order).alias("first_alt_km"),
        F.max_by("_alt", order).alias("last_alt_km"),
        F.regr_slope("_alt", "_day").alias("alt_slope_km_per_day"))


# X5 -------------------------------------------------------------------------
def catalogue_upsert(satcat_raw: DataFrame, cutoff: str) -> DataFrame:
    """Newest SATCAT row per id, built as (state before ``cutoff``) upserted with
    (rows from ``cutoff`` on); equals de-duplicating everything at once."""
    typed = silver.clean_satcat(satcat_raw)
    ts = F.col("_ingestion_ts")
    order = silver._newest_first(typed)
    cut = F.lit(cutoff).cast(typed.schema["_ingestion_ts"].dataType)
    before = latest_per_key(typed.where(ts < cut), ["norad_cat_id"], order)
    after = typed.where(ts >= cut)
    return upsert(before, after, ["norad_cat_id"], order).select(*silver.SATCAT_COLUMNS)


def feeds_as_of(satcat_raw: DataFrame, gp_raw: DataFrame, cutoff: str):
    """Raw feeds restricted to rows ingested before ``cutoff`` (a past snapshot).

    The predicate is on a scan column, so it reaches the parquet reader."""
    def cut(df):
        return df.where(F.col("_ingestion_ts") < F.lit(cutoff).cast(df.schema["_ingestion_ts"].dataType))
    return cut(satcat_raw), cut(gp_raw)


# X6 -------------------------------------------------------------------------
TRACKED = ["object_name", "object_type", "country", "decay_date", "apogee_km", "perigee_km",
           "orbital_regime", "object_category"]


def change_feed(before: DataFrame, after: DataFrame, key: str = "norad_cat_id",
                tracked: list[str] = TRACKED) -> DataFrame:
    """Row-level changes between two snapshots (unique on ``key``):
    ``insert`` / ``delete`` / ``update``; unchanged rows are not emitted.

    A full outer join of two key-unique tables: no key can be hot.
    """
    b = before.select(key, F.lit(True).alias("_hb"),
                      *[F.col(c).alias(f"old_{c}") for c in tracked])
    a = after.select(key, F.lit(True).alias("_ha"),
                     *[F.col(c).alias(f"new_{c}") for c in tracked])
    j = b.join(a, key, "full_outer")
    differs = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
    change = (F.when(F.col("_hb").isNull(), "insert")
              .when(F.col("_ha").isNull(), "delete")
              .when(differs, "update"))
    return (j.withColumn("change", change).where(F.col("change").isNotNull())
             .select(key, "change", *[f"old_{c}" for c in tracked],
                     *[f"new_{c}" for c in tracked]))


def before_and_after(satcat_raw: DataFrame, cutoff: str) -> DataFrame:
    """Newest catalogue row of each id from the rows before ``cutoff`` and from all
    rows, as structs ``before`` (null if the id is new) and ``after``.

    One scan and one grouped aggregate with map-side partial ``max_by``; elements
    play no part in what is compared, so their history is not read.
    """
    typed = silver.clean_satcat(satcat_raw)
    order = F.struct(*[silver._lineage_value(c).alias(c) for c in silver.LINEAGE_ORDER
                       if c in typed.columns])
    row = F.struct(*[c for c in silver.SATCAT_COLUMNS if c != "norad_cat_id"])
    past = F.col("_ingestion_ts") < F.lit(cutoff).cast(typed.schema["_ingestion_ts"].dataType)
    return typed.groupBy("norad_cat_id").agg(
        F.max_by(row, F.when(past, order)).alias("before"), F.max_by(row, order).alias("after"))


def _classified(row: str, columns: list[str]) -> Column:
    """``columns`` of a catalogue row, with the classes derived from it."""
    def of(c: str) -> Column:
        if c == "orbital_regime":
            return C.orbital_regime(F.col(row)["apogee_km"], F.col(row)["perigee_km"])
        if c == "object_category":
            return C.object_category(F.col(row)["object_type"], F.col(row)["decay_date"])
        return F.col(row)[c]
    return F.when(F.col(row).isNotNull(), F.struct(*[of(c).alias(c) for c in columns]))


def changes_since(satcat_raw: DataFrame, cutoff: str,
                  tracked: list[str] = TRACKED) -> DataFrame:
    """:func:`change_feed` between the catalogue as of ``cutoff`` and now, in one pass."""
    both = before_and_after(satcat_raw, cutoff).select(
        "norad_cat_id", _classified("before", tracked).alias("o"),
        _classified("after", tracked).alias("n"))
    change = F.when(F.col("o").isNull(), "insert").when(~F.col("o").eqNullSafe(F.col("n")),
                                                        "update")
    return both.withColumn("change", change).where(F.col("change").isNotNull()).select(
        "norad_cat_id", "change", *[F.col("o")[c].alias(f"old_{c}") for c in tracked],
        *[F.col("n")[c].alias(f"new_{c}") for c in tracked])


def census_since(satcat_raw: DataFrame, cutoff: str) -> DataFrame:
    """:func:`census_change` between the catalogue as of ``cutoff`` and now, in one pass."""
    keys = ["object_type", "orbital_regime", "country"]
    both = before_and_after(satcat_raw, cutoff).select(F.explode(F.array(
        F.struct(F.lit(True).alias("past"), _classified("before", keys).alias("k")),
        F.struct(F.lit(False).alias("past"), _classified("after", keys).alias("k")))).alias("x"))
    counts = both.where("x.k IS NOT NULL").groupBy(*[F.col("x.k")[c].alias(c) for c in keys]).agg(
        F.count_if("x.past").alias("past_count"), F.count_if(~F.col("x.past")).alias("present_count"))
    return counts.withColumn("delta", F.col("present_count") - F.col("past_count"))


# X7 -------------------------------------------------------------------------
def census_change(past_census: DataFrame, present_census: DataFrame) -> DataFrame:
    """Object counts per (type, regime, country) then and now, with the delta."""
    keys = ["object_type", "orbital_regime", "country"]
    p = past_census.select(*keys, F.col("object_count").alias("past_count"))
    n = present_census.select(*keys, F.col("object_count").alias("present_count"))
    j = p.join(n, [p[k].eqNullSafe(n[k]) for k in keys], "full_outer").select(
        *[F.coalesce(p[k], n[k]).alias(k) for k in keys],
        F.coalesce("past_count", F.lit(0)).cast("bigint").alias("past_count"),
        F.coalesce("present_count", F.lit(0)).cast("bigint").alias("present_count"))
    return j.withColumn("delta", F.col("present_count") - F.col("past_count"))


CENSUS_KEYS = ["object_type", "orbital_regime", "country"]


def census_at(versions: DataFrame, dates: list[str]) -> DataFrame:
    """Objects per (type, regime, country) at each of ``dates``, from validity intervals
    (``valid_from`` included, ``valid_to`` not; null: still valid), in one pass.

    An interval adds one at the first date that it covers and takes one away at the
    first date past it.  These steps are summed by group and date with map-side combine,
    so only sums of a group and date meet; a window of at most one row a date then
    runs along each group.  Groups without objects at a date have no row.
    """
    days = sorted(set(dates))
    at = F.array(*[F.lit(d).cast("timestamp_ntz") for d in days])
    def first_date(t: str) -> Column:   # index of the first date not before ``t``
        return F.size(F.filter(at, lambda d: d < F.col(t).cast("timestamp_ntz")))
    steps = versions.select(*CENSUS_KEYS, F.explode(F.array(
        F.struct(first_date("valid_from").alias("i"), F.lit(1).alias("step")),
        F.struct(F.when(F.col("valid_to").isNull(), F.lit(len(days))).otherwise(first_date("valid_to"))
                 .alias("i"), F.lit(-1).alias("step")))).alias("e")) \
        .where(F.col("e.i") < len(days)) \
        .groupBy(*CENSUS_KEYS, F.col("e.i").alias("_i")).agg(F.sum("e.step").alias("_step"))
    along = Window.partitionBy(*CENSUS_KEYS).orderBy("_i")
    total = F.sum("_step").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    until = F.coalesce(F.lead("_i").over(along), F.lit(len(days)))
    levels = steps.select(*CENSUS_KEYS, "_i", total.alias("object_count"), until.alias("_until")) \
        .where("object_count > 0")
    return levels.withColumn("_i", F.explode(F.sequence("_i", F.col("_until") - 1))).select(
        *CENSUS_KEYS, F.get(F.array(*[F.lit(d).cast("date") for d in days]), F.col("_i")).alias("census_date"),
        "object_count")


# X9 -------------------------------------------------------------------------
def growth_by_launch_year(objects: DataFrame) -> DataFrame:
    """Objects launched per year and the running total (years with a launch date)."""
    per_year = (objects.where(F.col("launch_date").isNotNull())
                .groupBy(F.year("launch_date").alias("launch_year"))
                .agg(F.count(F.lit(1)).alias("launched"),
                     count_if("is_debris").alias("debris_launched")))
    running = Window.orderBy("launch_year").rowsBetween(Window.unboundedPreceding,
                                                       Window.currentRow)
    # the window runs over one row per year: a small, bounded table
    return per_year.withColumn("cumulative", F.sum("launched").over(running))


# X10 ------------------------------------------------------------------------
def altitude_inclination_heatmap(objects: DataFrame, alt_band: int = HEATMAP_ALT_BAND_KM,
                                 inc_band: int = HEATMAP_INC_BAND_DEG) -> DataFrame:
    """Object counts on an (apogee band x inclination band) grid."""
    return (objects.where(F.col("apogee_km").isNotNull() & F.col("inclination").isNotNull())
            .groupBy(C.band("apogee_km", alt_band).alias("altitude_band_km"),
                     C.band("inclination", inc_band).alias("inclination_band_deg"))
            .agg(F.count(F.lit(1)).alias("objects"),
                 count_if("is_debris").alias("debris"),
                 count_if("is_active").alias("active")))


# X6 (validity intervals) ----------------------------------------------------
VERSION_TRACKED = ["object_name", "object_type", "country", "decay_date", "apogee_km",
                   "perigee_km"]


def object_versions(satcat_raw: DataFrame, collection: Column,
                    tracked: list[str] = VERSION_TRACKED) -> DataFrame:
    """SCD2 history of catalogue attributes: one row per run of unchanged
    ``tracked`` values, with ``valid_from``/``valid_to`` collection times.

    1. newest row per (object, collection) - the map-side-limited dedup, so a
       hot object is reduced per task before any shuffle;
    2. ``lag`` over each object's collections marks where a value changed;
    3. ``lead`` over the change points gives ``valid_to`` (null = current).

    The windows of steps 2-3 hold at most one row per collection for an
    object: their size is bounded by the number of collections, not by the
    volume of rows.
    """
    typed = silver.clean_satcat(satcat_raw).withColumn("_collection", collection)
    per_run = latest_per_key(typed, ["norad_cat_id", "_collection"],
                             silver._newest_first(typed)).select(
        "norad_cat_id", "_collection", *tracked)
    by_time = Window.partitionBy("norad_cat_id").orderBy("_collection")
    changed = F.lit(False)
    for c in tracked:
        changed = changed | ~F.col(c).eqNullSafe(F.lag(c).over(by_time))
    first = F.lag("_collection").over(by_time).isNull()
    versions = (per_run.withColumn("_change", first | changed)
                       .where(F.col("_change")).drop("_change"))
    return (versions
            .withColumn("valid_to", F.lead("_collection").over(by_time))
            .withColumn("is_current", F.col("valid_to").isNull())
            .withColumnRenamed("_collection", "valid_from")
            .select("norad_cat_id", *tracked, "valid_from", "valid_to", "is_current"))
