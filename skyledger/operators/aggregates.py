"""Small aggregate helpers shared by the gold tables (A9, A10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_if(pred: Column | str) -> Column:
    """Number of rows where ``pred`` is true; null counts as 0, result bigint."""
    return F.count_if(F.coalesce(_c(pred), F.lit(False)))


def ratio(num: Column | str, den: Column | str, digits: int = 4) -> Column:
    """``round(num / den, digits)`` with HALF_UP rounding; null when ``den`` is 0.

    True division (an integer quotient is never truncated).  With ANSI on a
    bare ``/ 0`` would raise, so a zero denominator gives null instead.
    """
    n, d = _c(num), _c(den)
    return F.when(d != 0, F.round(n / d, digits))


def mean(c: Column | str, digits: int | None = None) -> Column:
    """``avg``, optionally rounded.

    For an integral column ``avg`` is already exact: the sum is accumulated
    in a double without loss below 2**53 and divided once.

    Double addition is not associative, so the last bits of an average depend
    on how rows were split across tasks.  Rounding to ``digits`` decimals
    makes the published value reproducible run to run.
    """
    a = F.avg(_c(c))
    return a if digits is None else F.round(a, digits)


def exact_mean(c: Column | str, scale: int = 12) -> Column:
    """Mean of a measured double, reproducible to the last bit.

    Each value is taken at ``scale`` decimals (its shortest decimal text,
    rounded), summed exactly as ``decimal(38, scale)`` and divided once by the
    count.  Unlike ``avg`` on doubles, the result does not depend on how rows
    were split across tasks or in what order partial sums were merged.  Nulls are
    not counted; a NaN, or a magnitude of ``10**(38 - scale)`` or more, raises.
    """
    x = _c(c)
    dec = x.try_cast(f"decimal(38,{scale})")
    dec = F.when(x.isNotNull() & dec.isNull(), F.raise_error(F.lit(
        f"exact_mean: value outside of decimal(38,{scale})")).cast(f"decimal(38,{scale})")) \
        .otherwise(dec)
    total = F.sum(dec).cast("double")
    n = F.count(dec)
    return F.when(n > 0, total / n)
