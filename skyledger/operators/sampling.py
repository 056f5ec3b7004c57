"""Stratified quota sample (W4): the first ``quota`` rows of each stratum.

Semantics: for every stratum value ``v`` listed in ``quotas`` keep the
``quotas[v]`` rows with the smallest ``order`` value (ascending, nulls last);
strata not listed are dropped.  ``order`` must be an integral column that is
unique among the candidates (an object id after de-duplication).

Why not ``row_number() over (partition by stratum)``: a stratum such as LEO
holds most of the table, so that window would sort a huge group in one task.
Instead the cut-off is located on a histogram:

1. count rows per (stratum, id bucket) - a partially aggregated, tiny result;
2. a running sum over the buckets of each stratum finds, per stratum, the
   buckets that lie wholly below the quota and the one bucket that straddles
   it (the histogram's size depends on the id range, not on the row count);
3. the kept buckets - at most ``sum(quotas)`` rows, so a proven bound - are
   broadcast and joined back; ranks are only taken *inside* a bucket, whose
   size is at most ``bucket_width`` because ids are unique.

The input is read twice (histogram, then rows); give it a stored table or a
cheap plan (the batch pipeline passes the written ``space_objects``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_NULL_BUCKET = 2**63 - 1


def quota_sample(df: DataFrame, by: str, quotas: dict[str, int], order: str,
                 bucket_width: int = 4096) -> DataFrame:
    quota_of = F.create_map(*[x for k, v in quotas.items()
                              for x in (F.lit(k), F.lit(int(v)).cast("long"))])
    # Null ids sort last: they get the largest bucket number.
    cand = (df.withColumn("_quota", quota_of[F.col(by)])
              .where(F.col("_quota").isNotNull())
              .withColumn("_bucket", F.coalesce(
                  F.floor(F.col(order) / F.lit(bucket_width)), F.lit(_NULL_BUCKET))))
    hist = cand.groupBy(by, "_bucket", "_quota").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy(by).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    # more rows than ids in a bucket: ``order`` is not unique, and a rank inside
    # the bucket would not be bounded
    checked = F.when(F.col("_n") > bucket_width, F.raise_error(F.lit(
        f"quota_sample: {order} is not unique")).cast("long")).otherwise(F.col("_n"))
    kept = (hist.withColumn("_n", checked)
                .withColumn("_before", F.sum("_n").over(running) - F.col("_n"))
                .where(F.col("_before") < F.col("_quota"))
                .select(by, "_bucket", "_before"))
    # Each kept bucket holds >= 1 row and starts below the quota, so ``kept``
    # has at most sum(quotas) rows: a proven bound, safe to broadcast.
    inside = Window.partitionBy(by, "_bucket").orderBy(F.asc_nulls_last(order))
    return (cand.join(F.broadcast(kept), [by, "_bucket"])
                .withColumn("_rank", F.col("_before") + F.row_number().over(inside))
                .where(F.col("_rank") <= F.col("_quota"))
                .select(*df.columns))


def quota_sample_by_limits(df: DataFrame, by: str, quotas: dict[str, int],
                           order: str) -> DataFrame:
    """Reference formulation: one ordered ``limit`` per stratum, then a union.

    Kept as the equivalence check for :func:`quota_sample`; it scans the input
    once per stratum and funnels each stratum's top rows through one task.
    """
    parts = [df.where(F.col(by) == k).orderBy(F.asc_nulls_last(order)).limit(int(v))
             for k, v in quotas.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
