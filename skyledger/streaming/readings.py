"""Cleaned signal readings as a stream (X1).

Readings are typed, and repeated ones (same series and time) dropped while they may
still come: state is kept for ``delay`` beyond the newest time seen.  A reading older
than that is late; it is dropped, and counted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..plans.weather import typed_readings

READING = "series string, time_tag string, value string, reading_id bigint"


@dataclass
class CleanResult:
    batches: int
    late: int      # readings dropped because they came after the watermark


def readings_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None,
                    max_file_age: str = "36500d") -> DataFrame:
    """Landed readings (JSON lines) as a stream of raw rows."""
    reader = spark.readStream.schema(READING).option("maxFileAge", max_file_age) \
        .option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(landing)


def clean_stream(raw: DataFrame, delay: str) -> DataFrame:
    """The typed stream without repetitions, within ``delay`` of event time."""
    return typed_readings(raw).withWatermark("time_tag", delay) \
        .dropDuplicatesWithinWatermark(["series", "time_tag"])


def clean_to_parquet(raw: DataFrame, target: str, checkpoint: str, delay: str) -> CleanResult:
    """Drain the stream into the Parquet table ``target`` (append, exactly once)."""
    late, batches = [], []

    q = (clean_stream(raw, delay).writeStream.format("parquet").option("path", target)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    for p in q.recentProgress:
        batches.append(p.batchId)
        late += [s.numRowsDroppedByWatermark for s in p.stateOperators]
    return CleanResult(len(set(batches)), sum(late))
