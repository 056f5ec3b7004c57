"""The element history as a stored table, and elements as of a time (X4).

Rows lie in partitions by year and month of their epoch.  A load reads and rewrites
only the months that its rows fall into, so a day's load costs its month, however long
the history is, and loading the same rows again changes nothing.  Beside the rows lie
the moments of each object and month (count, means, sums of squares about the means,
first and last row); they merge exactly into the trend over the whole history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import latest_per_key
from ..operators.timeseries import asof_join
from ..session import path_exists, scratch_path
from . import silver
from .history import mean_motion_altitude_km

ROWS, MOMENTS = "rows", "moments"
_KEY = ["norad_cat_id", "epoch", "_seq"]


def _typed(gp_raw: DataFrame) -> DataFrame:
    """Rows with a positive mean motion and an epoch, and what the trend needs."""
    return silver.clean_gp(gp_raw).where(F.col("epoch").isNotNull() & (F.col("mean_motion") > 0)) \
        .select("norad_cat_id", "epoch", "mean_motion", "eccentricity", "inclination", "bstar",
                "_ingestion_ts", "_seq", F.year("epoch").alias("year"),
                F.month("epoch").alias("month"))


def _in_months(months: list[tuple[int, int]]) -> Column:
    found = F.lit(False)
    for year, month in months:
        found = found | ((F.col("year") == year) & (F.col("month") == month))
    return found


def _overwrite_months(df: DataFrame, path: str) -> None:
    """Replace exactly the partitions that ``df`` has rows of."""
    (df.repartition("year", "month", F.pmod(F.xxhash64("norad_cat_id"), F.lit(16)))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("year", "month").parquet(path))


def monthly_moments(rows: DataFrame) -> DataFrame:
    """Moments of the altitude (km) over time (days) by object and month."""
    day = F.unix_micros(F.col("epoch").cast("timestamp")) / F.lit(86_400e6)
    h = rows.select("norad_cat_id", "year", "month", "epoch", day.alias("_x"),
                    mean_motion_altitude_km(F.col("mean_motion")).alias("_y"))
    order = F.struct("epoch", "_y")
    return h.groupBy("norad_cat_id", "year", "month").agg(
        F.count(F.lit(1)).alias("n"), F.avg("_x").alias("mx"), F.avg("_y").alias("my"),
        F.regr_sxx("_y", "_x").alias("sxx"), F.regr_sxy("_y", "_x").alias("sxy"),
        F.min(order).alias("first"), F.max(order).alias("last"))


def load_history(spark: SparkSession, base: str, gp_raw: DataFrame) -> list[tuple[int, int]]:
    """Add raw element rows to the history under ``base``; the months written.

    Rows are told apart by object, epoch and ``_seq``; a row that is there already is
    kept once.  A load that is stopped half-way is made good by loading again.
    """
    new = _typed(gp_raw)
    months = sorted((r.year, r.month) for r in
                    new.select("year", "month").distinct().collect())  # one row a month
    if not months:
        return []
    rows = new
    if path_exists(spark, f"{base}/{ROWS}"):
        held = spark.read.schema(new.schema).parquet(f"{base}/{ROWS}").where(_in_months(months))
        rows = held.unionByName(new)
    # stored aside first: a table is not overwritten while it is read
    merged = scratch_path(spark, "history-months")
    rows.dropDuplicates(_KEY).write.parquet(merged)
    rows = spark.read.schema(new.schema).parquet(merged)
    _overwrite_months(rows, f"{base}/{ROWS}")
    _overwrite_months(monthly_moments(rows), f"{base}/{MOMENTS}")
    return months


def _merge(a: Column, b: Column) -> Column:
    """Moments of two disjoint sets of rows together."""
    n = a["n"] + b["n"]
    dx, dy = b["mx"] - a["mx"], b["my"] - a["my"]
    share = b["n"] / n
    between = a["n"] * share
    return F.struct(n.alias("n"), (a["mx"] + dx * share).alias("mx"),
                    (a["my"] + dy * share).alias("my"),
                    (a["sxx"] + b["sxx"] + dx * dx * between).alias("sxx"),
                    (a["sxy"] + b["sxy"] + dx * dy * between).alias("sxy"))


def history_trend(spark: SparkSession, base: str) -> DataFrame:
    """:func:`skyledger.plans.history.altitude_trend` from the stored moments: an
    object's months, not its rows, are brought together."""
    m = spark.read.parquet(f"{base}/{MOMENTS}")
    part = F.struct(F.col("n").cast("double").alias("n"), "mx", "my",
                    F.coalesce("sxx", F.lit(0.0)).alias("sxx"),
                    F.coalesce("sxy", F.lit(0.0)).alias("sxy"))
    months = m.groupBy("norad_cat_id").agg(
        F.sum("n").alias("epochs"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.array_sort(F.collect_list(F.struct("year", "month", part.alias("p")))).alias("months"))
    parts = F.transform("months", lambda x: x["p"])
    whole = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.get(parts, F.lit(0)), _merge)
    return months.withColumn("all", whole).select(
        "norad_cat_id", "epochs", F.col("first.epoch").alias("first_epoch"),
        F.col("last.epoch").alias("last_epoch"), F.col("first._y").alias("first_alt_km"),
        F.col("last._y").alias("last_alt_km"),
        F.when(F.col("all.sxx") > 0, F.col("all.sxy") / F.col("all.sxx")).alias("alt_slope_km_per_day"))


def elements_as_of_collections(satcat_raw: DataFrame, gp_raw: DataFrame,
                               collection: Column) -> DataFrame:
    """The catalogue state of each object in each collection, with the elements that
    were in force at the collection's end (a month after its start): the newest epoch
    not after it, nulls where there is none yet.

    Both histories are swept together by object and time (``asof_join``); the newest
    row of an object and collection, and of an object and epoch, counts.
    """
    typed = silver.clean_satcat(satcat_raw).withColumn("collection", collection)
    states = latest_per_key(typed, ["norad_cat_id", "collection"], silver._newest_first(typed)) \
        .select("norad_cat_id", "collection", "object_name", "apogee_km", "perigee_km",
                (F.col("collection") + F.expr("INTERVAL 1 MONTH")).cast("timestamp_ntz").alias("_end"))
    gp = silver.clean_gp(gp_raw)
    sets = latest_per_key(gp, ["norad_cat_id", "epoch"], silver._newest_first(gp))
    return asof_join(states, sets, ["norad_cat_id"], "_end", "epoch",
                     ["epoch", "mean_motion", "inclination", "bstar"]).drop("_end", "epoch_as_of")
