"""Top-k, paging and display rank (L4, L5, L6, W5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAGE_SIZE = 20


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """First ``n`` rows under ``order`` (TakeOrderedAndProject: each task keeps
    its own top ``n``, only ``n`` rows per task travel)."""
    return df.orderBy(*order).limit(n)


def page(df: DataFrame, order: Sequence[Column], number: int,
         size: int = PAGE_SIZE, rank_col: str | None = "rank") -> DataFrame:
    """Page ``number`` (0-based) of ``size`` rows under ``order``.

    ``offset + limit`` keeps the per-task top ``(number + 1) * size`` rows, so
    a page near the front needs no global sort of the whole input; readers that go
    deep follow :func:`page_after` from page to page.  ``rank_col`` is the
    1-based display rank ``number * size + i + 1``; it is numbered on the page
    itself (at most ``size`` rows).  End ``order`` with a unique column.
    """
    out = df.orderBy(*order).offset(number * size).limit(size)
    if rank_col:
        w = Window.orderBy(*order)  # over <= size rows
        out = out.withColumn(rank_col, F.row_number().over(w) + F.lit(number * size))
    return out


def page_after(df: DataFrame, keys: Sequence[str], last: Sequence | None,
               size: int = PAGE_SIZE) -> DataFrame:
    """The ``size`` rows that follow the key values ``last`` in ascending order of
    ``keys`` (None: the first page).

    Each task keeps ``size`` rows however deep the page lies, and the comparison is
    a filter on the scan.  The last of ``keys`` must be unique, and no key null.
    """
    if last is not None:
        beyond = F.lit(False)
        for i, key in enumerate(keys):
            step = F.col(key) > F.lit(last[i])
            for j in range(i):
                step = step & (F.col(keys[j]) == F.lit(last[j]))
            beyond = beyond | step
        df = df.where((F.col(keys[0]) >= F.lit(last[0])) & beyond)
    return df.orderBy(*keys).limit(size)


def page_count(df: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    """One row: ``rows`` and ``pages = ceil(rows / size)``."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.ceil(F.col("rows") / F.lit(size)).cast("bigint").alias("pages"))
