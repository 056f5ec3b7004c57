"""Display rank over a whole table, and pages of it (W5, L5).

``row_number()`` without a partition would sort the table in one task.  Here the table
is range-partitioned and sorted once and stored with each row's range and its place in
it; the rows of each range are counted, and the running sums of these counts (one
number a range) are all that a rank or a page needs beside the row itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .paging import PAGE_SIZE

_PLACE_BITS = 33   # of monotonically_increasing_id: the place within a partition


@dataclass
class RankedTable:
    stored: DataFrame     # the columns, ``_part`` and ``_place``
    columns: list[str]
    offsets: list[int]    # rows before each range; one more at the end for the total

    @property
    def rows(self) -> int:
        return self.offsets[-1]

    def ranked(self, rank_col: str = "rank") -> DataFrame:
        """All rows with their rank from 1."""
        before = F.array(*[F.lit(n).cast("bigint") for n in self.offsets])
        return self.stored.select(*self.columns, (
            F.get(before, F.col("_part")) + F.col("_place") + 1).alias(rank_col))

    def page(self, number: int, size: int = PAGE_SIZE, rank_col: str = "rank") -> DataFrame:
        """Page ``number`` (from 0): a filter on the ranges that hold it, whatever its
        depth; ``size`` rows, or what is left of them."""
        low, high = number * size, min((number + 1) * size, self.rows)
        wanted = F.lit(False)
        for part, (start, end) in enumerate(zip(self.offsets, self.offsets[1:])):
            if start < high and low < end:
                wanted = wanted | ((F.col("_part") == part) & F.col("_place").between(
                    max(low - start, 0), min(high, end) - start - 1))
        rows = RankedTable(self.stored.where(wanted), self.columns, self.offsets)
        return rows.ranked(rank_col)


def rank_table(df: DataFrame, order: Sequence[Column], partitions: int | None = None) -> RankedTable:
    """``df`` ranked under ``order``, which should end with a unique column (ties are
    broken arbitrarily otherwise).  An empty table has no ranks and no pages."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    path = scratch_path(spark, "ranked")
    (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
       .withColumns({"_part": F.spark_partition_id(), "_place": place}).write.parquet(path))
    stored = spark.read.parquet(path)
    counts = {r["_part"]: r["n"] for r in
              stored.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a range
    sizes = [counts.get(i, 0) for i in range(max(counts, default=-1) + 1)]
    return RankedTable(stored, df.columns, [0, *accumulate(sizes)])
