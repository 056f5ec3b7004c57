"""Operators on time-ordered rows: carrying values forward, as-of joins, lagged
correlation.

None of them sorts a whole key (or the whole table) in one task.  Time is cut into
ranges of ``width``; inside a range a window sees the rows of one key and range only,
and what passes from range to range is one row a range, found by an aggregate with
map-side combine.  A key that holds a third of all rows is thereby spread over its
ranges; the only window along a key runs over its range ends, whose number follows the
length of time covered, not the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR = 3600
DAY = 86_400


def seconds(time: str | Column) -> Column:
    """Seconds since 1970 of a timestamp column, with fractions cut off downwards."""
    t = F.col(time) if isinstance(time, str) else time
    return F.unix_seconds(t.cast("timestamp"))


def _range(time: str, width: int) -> Column:
    return F.floor(seconds(time) / F.lit(width))


def _last_before(ends: DataFrame, keys: Sequence[str], value: str, at: str) -> DataFrame:
    """Range ends with ``_carry``: the last ``value`` of the ranges before."""
    earlier = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    return ends.withColumn("_carry", F.last(value, ignorenulls=True).over(earlier)) \
        .select(*keys, at, "_carry")


def spine(bounds: DataFrame, step: int, width: int) -> DataFrame:
    """Every ``_t`` (timestamp, each ``step`` seconds) from ``first`` to ``last`` of the
    one-row ``bounds``; none where they are null.  Ranges are made first and filled in
    parallel, so no array is longer than a range."""
    first, last = seconds("first"), seconds("last")
    ranges = bounds.where("first IS NOT NULL AND last IS NOT NULL").select(
        first.alias("_f"), last.alias("_l"), F.explode(F.sequence(
            F.floor(first / width), F.floor(last / width))).alias("_range"))
    low = F.greatest("_f", F.ceil(F.col("_range") * width / step) * step)
    high = F.least("_l", (F.col("_range") + 1) * width - 1)
    return ranges.repartition("_range").withColumn("_low", low.cast("bigint")) \
        .withColumn("_high", high.cast("bigint")).where("_low <= _high") \
        .select(F.explode(F.sequence("_low", "_high", F.lit(step).cast("bigint"))).alias("_s")) \
        .select(F.timestamp_seconds("_s").alias("_t"))


def carry_forward(df: DataFrame, keys: Sequence[str], time: str, value: str,
                  width: int = 31 * DAY) -> DataFrame:
    """``df`` with ``<value>_filled``, the value or else the last one before it in time,
    and ``<value>_since``, that value's time; both null before the first value.

    ``keys`` and ``time`` name a row; rows of a key with one time count as in no order.
    Null keys are a key like any other; rows without a time get nothing carried.
    """
    own = F.when(F.col(value).isNotNull(), F.struct(F.col(time).alias("t"), F.col(value).alias("v")))
    rows = df.withColumn("_range", _range(time, width)).withColumn("_own", own)
    # null keys are matched too: they are compared as (is null, value)
    named = {k: f"_k{i}" for i, k in enumerate(keys)}
    ends = rows.groupBy(*[F.col(k).alias(n) for k, n in named.items()], "_range") \
        .agg(F.max_by("_own", F.when(F.col("_own").isNotNull(), F.col(time))).alias("_end"))
    carry = _last_before(ends, list(named.values()), "_end", "_range") \
        .withColumnRenamed("_range", "_r")
    same = F.col("_range") == F.col("_r")
    for k, n in named.items():
        same = same & F.col(k).eqNullSafe(F.col(n))
    inside = Window.partitionBy(*keys, "_range").orderBy(time) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = F.coalesce(F.last("_own", ignorenulls=True).over(inside), F.col("_carry"))
    return rows.join(carry, same, "left").withColumn("_found", found).select(
        *[F.col(c) for c in df.columns], F.col("_found.v").alias(f"{value}_filled"),
        F.col("_found.t").alias(f"{value}_since"))


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str,
              right_time: str, columns: Sequence[str], width: int = 366 * DAY,
              tolerance: int | None = None) -> DataFrame:
    """``left`` with the ``columns`` of the last row of ``right`` with the same ``on``
    whose ``right_time`` is not after ``left_time`` (and at most ``tolerance`` seconds
    before it); nulls where there is none.  Every left row comes out once.

    Both sides go through one shuffle as a tagged union and are swept in time order,
    right rows before left ones at the same time; no side is paired with the other.
    (``on``, ``right_time``) must be unique in ``right``.  Null keys and null times
    match nothing.
    """
    # left columns travel in a struct, so no name of either side can clash
    lrows = left.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(on)],
                        F.col(left_time).alias("_t"), F.lit(1).alias("_side"),
                        F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_left"))
    picked = F.struct(F.col(right_time).alias("_at"), *[F.col(c) for c in columns])
    rrows = right.where(F.col(right_time).isNotNull()).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(on)], F.col(right_time).alias("_t"),
        F.lit(0).alias("_side"), picked.alias("_right"))
    keys = [f"_k{i}" for i in range(len(on))]
    usable = F.lit(True)
    for k in keys:
        usable = usable & F.col(k).isNotNull()
        rrows = rrows.where(F.col(k).isNotNull())
    usable = usable & F.col("_t").isNotNull()
    both = lrows.where(usable).unionByName(rrows, allowMissingColumns=True) \
        .withColumn("_range", _range("_t", width))
    # ranges of both sides: one without a right row still needs what was there before
    slots = both.groupBy(*keys, "_range").agg(
        F.max_by("_right", F.when(F.col("_side") == 0, F.col("_t"))).alias("_end"))
    carry = _last_before(slots, keys, "_end", "_range")
    sweep = Window.partitionBy(*keys, "_range").orderBy("_t", "_side") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = both.withColumn("_hit", F.last("_right", ignorenulls=True).over(sweep)) \
        .where("_side = 1").join(carry, [*keys, "_range"], "left") \
        .withColumn("_hit", F.coalesce("_hit", "_carry"))
    if tolerance is not None:
        near = seconds("_t") - seconds(F.col("_hit._at")) <= tolerance
        swept = swept.withColumn("_hit", F.when(near, F.col("_hit")))
    out = swept.select("_left", "_hit").unionByName(
        lrows.where(~usable).select("_left"), allowMissingColumns=True)
    return out.select(*[F.col("_left")[c].alias(c) for c in left.columns],
                      *[F.col("_hit")[c].alias(c) for c in columns],
                      F.col("_hit._at").alias(f"{right_time}_as_of"))


def lagged_correlation(x: DataFrame, y: DataFrame, time: str, x_value: str, y_value: str,
                       max_lag: int, step: int = HOUR) -> DataFrame:
    """Correlation of ``x`` at each time with ``y`` ``lag`` steps later, for lags 0 to
    ``max_lag``: lag, pairs, correlation, slope (of y on x).

    Every x is dealt to the times that its lags reach and meets the one y there: one
    equi-join for all lags, then one aggregate of mergeable moments, combined on the
    map side.  ``time`` must be unique on either side and on a grid of ``step``
    seconds; null values take no part.  Both are null for lags without variance.
    """
    dealt = x.where(F.col(x_value).isNotNull()).select(
        seconds(time).alias("_s"), F.col(x_value).cast("double").alias("_x")).select(
        "_x", "_s", F.explode(F.sequence(F.lit(0), F.lit(max_lag))).alias("lag")).select(
        "_x", "lag", (F.col("_s") + F.col("lag") * step).alias("_s"))
    met = dealt.join(y.where(F.col(y_value).isNotNull()).select(
        seconds(time).alias("_s"), F.col(y_value).cast("double").alias("_y")), "_s")
    varies = (F.min("_x") < F.max("_x")) & (F.min("_y") < F.max("_y"))
    return met.groupBy("lag").agg(
        F.count(F.lit(1)).alias("pairs"),
        F.when(varies, F.try_divide(F.covar_pop("_x", "_y"), F.stddev_pop("_x") * F.stddev_pop("_y")))
         .alias("correlation"),
        F.when(varies, F.regr_slope("_y", "_x")).alias("slope"))
