"""Spark-vs-DuckDB result comparison used by the tests and ``tools/check_oracle.py``.

Both results are fetched as Arrow, cells are normalised (dates and times to
ISO text, floats to a fixed number of significant digits), rows are sorted
and compared as multisets, with columns in name order.
"""

from __future__ import annotations

import datetime as dt
import math
import os
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int | None):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if digits is None:
            return repr(v)
        return f"{v:.{digits}g}"
    if isinstance(v, Decimal):
        return _norm(float(v), digits)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    return str(v)


def _rows(table, digits):
    cols = sorted(table.column_names)
    data = {c: table.column(c).to_pylist() for c in cols}
    n = table.num_rows
    rows = [tuple(_norm(data[c][i], digits) for c in cols) for i in range(n)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_df, con, sql: str, digits: int | None = 12) -> dict:
    """Return a report dict with ``ok`` and the first differences."""
    left = spark_df.toArrow()
    right = con.sql(sql).to_arrow_table()
    report = {"spark_rows": left.num_rows, "oracle_rows": right.num_rows}
    lc, lr = _rows(left, digits)
    rc, rr = _rows(right, digits)
    report["columns_match"] = lc == rc
    if lc != rc:
        report["spark_only_cols"] = sorted(set(lc) - set(rc))
        report["oracle_only_cols"] = sorted(set(rc) - set(lc))
        report["ok"] = False
        return report
    report["values_match"] = lr == rr
    if lr != rr:
        from collections import Counter
        a, b = Counter(lr), Counter(rr)
        report["spark_only"] = list((a - b).elements())[:3]
        report["oracle_only"] = list((b - a).elements())[:3]
        report["columns"] = lc
    report["ok"] = report["values_match"] and left.num_rows == right.num_rows
    return report
