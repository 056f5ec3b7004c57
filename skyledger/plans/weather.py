"""Space weather: cleaned signals, their hourly merge, and storm impact (X1-X3).

Three signals (solar wind, Kp index, X-ray flux) and a drag signal arrive as readings
``(series, time_tag, value, reading_id)``, all text but the id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classify import lenient
from ..operators.aggregates import exact_mean
from ..operators.dedup import latest_per_key
from ..operators.timeseries import DAY, HOUR, carry_forward, lagged_correlation, spine

SERIES = ("wind", "kp", "xray")
DRAG = "drag"
VALUE_SCALE = 6   # decimals of a reading that count


# X1 -------------------------------------------------------------------------
def typed_readings(raw: DataFrame) -> DataFrame:
    """Readings with a time and a finite value, typed; all others go."""
    value = lenient("value", "double")
    return raw.select("series", lenient("time_tag", "timestamp").alias("time_tag"),
                      value.alias("value"), "reading_id") \
        .where(F.col("time_tag").isNotNull() & F.col("value").isNotNull()
               & ~F.isnan("value") & (F.abs("value") < float("inf")))


def clean_readings(raw: DataFrame) -> DataFrame:
    """One reading a series and time: the first by ``reading_id`` where several came."""
    return latest_per_key(typed_readings(raw), ["series", "time_tag"], [F.col("reading_id")])


# X2 -------------------------------------------------------------------------
def hourly(readings: DataFrame) -> DataFrame:
    """Mean and number of the readings of each series and hour."""
    return readings.groupBy("series", F.date_trunc("hour", "time_tag").alias("hour")).agg(
        exact_mean("value", VALUE_SCALE).alias("value"), F.count(F.lit(1)).alias("readings"))


def hourly_merge(readings: DataFrame, series: Sequence[str] = SERIES,
                 width: int = 31 * DAY) -> DataFrame:
    """All series on one line of hours, from the first reading of any to the last.

    For each series: ``<s>`` (the hour's mean, null without readings), ``<s>_n``, and
    ``<s>_filled`` / ``<s>_age_hours``, the last mean up to this hour and its age (null
    before the first).  An hour in which no series has a reading is there as well.
    """
    wanted = readings.where(F.col("series").isin(*series))
    means = hourly(wanted)
    bounds = means.agg(F.min("hour").alias("first"), F.max("hour").alias("last"))
    slots = spine(bounds, HOUR, width).select(
        F.col("_t").alias("hour"), F.explode(F.array(*[F.lit(s) for s in series])).alias("series"))
    filled = carry_forward(slots.join(means, ["series", "hour"], "left"), ["series"], "hour",
                           "value", width)
    age = (F.unix_seconds("hour") - F.unix_seconds("value_since")) / HOUR
    columns = []
    for s in series:
        mine = F.col("series") == s
        columns += [F.max(F.when(mine, F.col("value"))).alias(s),
                    F.coalesce(F.max(F.when(mine, F.col("readings"))), F.lit(0)).alias(f"{s}_n"),
                    F.max(F.when(mine, F.col("value_filled"))).alias(f"{s}_filled"),
                    F.max(F.when(mine, age.cast("bigint"))).alias(f"{s}_age_hours")]
    return filled.groupBy("hour").agg(*columns)


# X3 -------------------------------------------------------------------------
def storm_impact(readings: DataFrame, max_lag: int = 72, cause: str = "kp",
                 effect: str = DRAG) -> DataFrame:
    """Correlation of the hourly ``cause`` with ``effect`` up to ``max_lag`` hours later."""
    means = hourly(readings.where(F.col("series").isin(cause, effect)))
    return lagged_correlation(means.where(F.col("series") == cause),
                              means.where(F.col("series") == effect),
                              "hour", "value", "value", max_lag)
