"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# White space and words of the contracts (fixed values).
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"

# Rows of one Arrow batch and text bytes worked on at a time in a task.
BATCH_ROWS = 1024
SLICE_BYTES = 4 * 1024 ** 2


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back.

    Cuts lineage with files every executor can read, computes ``df`` once, and
    gives Catalyst the real size of the table for its join choices.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with small input batches, so that a task holds few texts."""
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != str(BATCH_ROWS):
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def slices(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches where the bytes of ``column`` pass ``limit``; a longer value
    stands alone.  Every row comes out once, in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


ROW = "_row_address"


def addressed(df: DataFrame) -> DataFrame:
    """``df`` with the file and position of each row as a stable address.

    The address does not depend on how a scan is split, so it names the same row
    in every job and after a lost executor.  A table that is not a plain file scan
    is stored first.
    """
    try:
        meta = df.metadataColumn("_metadata")
        return df.withColumn(ROW, F.concat_ws(":", meta["file_path"],
                                              meta["row_index"].cast("string")))
    except AnalysisException:
        return addressed(store(df, "addressed"))


def without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """``rows`` (addressed) but for the ``dropped`` addresses, with their columns."""
    return rows.join(store(dropped.select(ROW), "dropped"), ROW, "left_anti").drop(ROW)
