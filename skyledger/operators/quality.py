"""Data-quality expectations (Q1): violating rows are kept and counted.

A rule is a boolean SQL predicate.  A row violates it when the predicate is
false *or null*.  Counting happens while the data flows through the job that
uses it (``DataFrame.observe``), so no second pass over the data is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# The expectations of the unified object table.
OBJECT_EXPECTATIONS = {
    "valid_norad_id": "norad_cat_id IS NOT NULL",
    "valid_object_name": "object_name IS NOT NULL",
}


def _violations(rules: dict[str, str]) -> list[Column]:
    return [F.count_if(~F.coalesce(F.expr(p), F.lit(False))).alias(name)
            for name, p in rules.items()]


def expect(df: DataFrame, rules: dict[str, str],
           name: str = "expectations") -> tuple[DataFrame, Observation]:
    """Attach violation counters; read ``obs.get`` after the first action."""
    obs = Observation(name)
    counters = _violations(rules) + [F.count(F.lit(1)).alias("rows")]
    return df.observe(obs, *counters), obs


def violation_counts(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """The same counters as a one-row DataFrame (a report, or a check)."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *_violations(rules))
