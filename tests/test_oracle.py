"""Every registered query against its SQL oracle at sf0.01 (the driver's gate)."""

from __future__ import annotations

import warnings

import pytest

import __spark_entry__ as E
from compare import SF_CHECK, SF_SMALL, compare

SQL = E.oracle_sql()
QUERIES = E.queries()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == E.entry(spark).columns


def test_queries_stay_when_the_optional_operators_cannot_be_imported(monkeypatch):
    """A package that only they need is missing: the rest is still registered."""
    import sys
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("skyledger.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(sys.modules["skyledger"], "llm", None, raising=False)
    monkeypatch.setitem(sys.modules, "regex", None)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        left = set(E.queries())
    assert set(E.QUERIES) <= left and set(E.oracle_sql()) <= left


def test_every_sql_key_is_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_CHECK)
    rep = compare(df, duck, SQL[name], digits=9)
    assert rep["ok"], rep


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 0
