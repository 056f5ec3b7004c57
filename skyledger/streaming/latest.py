"""Newest row per key kept current by a stream (W1, W2 without a full rebuild).

A stateful aggregate (``max_by`` per key) holds the newest row of every key in the state
store; each micro-batch emits the keys that it changed.  They are written as plain
Parquet, one folder a micro-batch (``batch=<id>``): a batch that is retried after a
failure overwrites its own folder, so every change is there exactly once.  Reading the
table takes the last change of each key.  The folder grows by the changed keys only;
a batch job may write :func:`read_latest` to a new place whenever that suits.

Each micro-batch loads, commits and writes every partition of the state, however few keys
it changes, so a new checkpoint gets ``STATE_TASKS`` partitions a core at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import latest_per_key
from ..session import settings

STATE_TASKS = 1   # partitions of the state a core, at most


def newest_rows(stream: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The row with the greatest ``order`` of each key; also on a batch table."""
    row = F.struct(*[F.col(c) for c in stream.columns if c not in keys])
    newest = stream.groupBy(*keys).agg(F.max_by(row, order).alias("_newest"))
    return newest.select(*keys, *[F.col("_newest")[c].alias(c)
                                  for c in stream.columns if c not in keys])


def _state_settings(spark: SparkSession) -> dict[str, str]:
    """Taken by the first run of a checkpoint; later runs keep its partitions."""
    name = "spark.sql.shuffle.partitions"
    tasks = STATE_TASKS * spark.sparkContext.defaultParallelism
    return {name: str(min(int(spark.conf.get(name)), tasks))}


def keep_latest(stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str],
                order: Column):
    """Drain ``stream`` (availableNow) and append the changed keys to ``target``.
    Returns the finished ``StreamingQuery``; call again to go on from its checkpoint."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={batch_id}")

    spark = stream.sparkSession
    with settings(spark, _state_settings(spark)):   # the query copies them when it starts
        q = (newest_rows(stream, keys, order).writeStream.outputMode("update")
             .foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def read_latest(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """The current row of each key."""
    return latest_per_key(spark.read.parquet(target), keys, [F.desc("batch")]).drop("batch")
