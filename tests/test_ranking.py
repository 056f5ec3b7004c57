"""Rank and pages of a whole table; history loads; bucketed joins; typed ingest."""

from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from compare import SF_CHECK
from skyledger.operators.ranking import rank_table
from skyledger.plans import elements, history
from skyledger.plans.owners import clean_owners, enrich_owners, owner_summary, store_bucketed
from skyledger.sources.adapters import load_feeds
from skyledger.sources.typed import (field, infer_record_schema, landed_records, typed_records,
                                     widen)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# W5 -------------------------------------------------------------------------
def test_rank_and_pages_of_a_whole_table(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, None]), i) for i in rng.sample(range(5000), 1003)]
    df = spark.createDataFrame(rows, "v int, id int").repartition(7)
    ranked = rank_table(df, [F.col("v").asc_nulls_last(), F.col("id")], partitions=6)
    want = [(v, i, n) for n, (v, i) in enumerate(
        sorted(rows, key=lambda r: (r[0] is None, r[0], r[1])), 1)]
    assert sorted(map(tuple, ranked.ranked().collect()), key=lambda r: r[2]) == want
    assert ranked.rows == 1003 and len(ranked.offsets) > 2
    for number in (0, 1, 24, 50, 51, 1000):
        got = sorted(map(tuple, ranked.page(number).collect()), key=lambda r: r[2])
        assert got == want[number * 20:number * 20 + 20], number
    assert "Window" not in _plan(ranked.ranked()) and "Exchange" not in _plan(ranked.page(50))
    assert "PushedFilters" in _plan(ranked.page(50))


def test_rank_of_an_empty_table(spark):
    ranked = rank_table(spark.createDataFrame([], "id int"), [F.col("id")])
    assert ranked.rows == 0 and ranked.ranked().count() == 0 and ranked.page(0).count() == 0


# X4 -------------------------------------------------------------------------
def _same_trend(got, want):
    g, w = ({r.norad_cat_id: r for r in d.collect()} for d in (got, want))
    assert g.keys() == w.keys()
    for k, r in g.items():
        for c in ("epochs", "first_epoch", "last_epoch", "first_alt_km", "last_alt_km"):
            assert r[c] == w[k][c], (k, c)
        a, b = r.alt_slope_km_per_day, w[k].alt_slope_km_per_day
        assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-9, abs=1e-9))


def test_history_load_reload_and_late_month(spark, scratch):
    _, gp = load_feeds(spark, SF_CHECK)
    base = f"{scratch}/history"
    day = F.to_date("_ingestion_ts")
    late = (day >= "1996-03-01") & (day < "1996-04-01")
    first = gp.where(~late & (day < "2000-01-01"))
    months = elements.load_history(spark, base, first)
    assert len(months) == len(set(months)) > 50
    _same_trend(elements.history_trend(spark, base), history.altitude_trend(first))
    elements.load_history(spark, base, first.where(day < "1995-02-01"))     # again
    _same_trend(elements.history_trend(spark, base), history.altitude_trend(first))
    untouched = {f: os.stat(f).st_mtime_ns for f in _files(f"{base}/rows") if "year=1996/month=3" not in f}
    assert elements.load_history(spark, base, gp.where(late)) == [(1996, 3)]  # a late month
    assert {f: os.stat(f).st_mtime_ns for f in untouched} == untouched        # reads and writes its month only
    elements.load_history(spark, base, gp.where(day >= "2000-01-01"))
    _same_trend(elements.history_trend(spark, base), history.altitude_trend(gp))
    assert elements.load_history(spark, base, gp.limit(0)) == []


def _files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


# X7 -------------------------------------------------------------------------
def test_census_at_dates(spark):
    rows = [("P", "LEO", "A", "2020-01-01", "2020-06-01"), ("P", "LEO", "A", "2020-03-01", None),
            ("D", "GEO", None, "2020-01-01", "2020-01-20"), ("D", "LEO", "B", "2020-12-31", None)]
    versions = spark.createDataFrame(rows, "object_type string, orbital_regime string, country string, "
                                           "valid_from string, valid_to string")
    dates = ["2019-12-31", "2020-01-01", "2020-01-20", "2020-03-02", "2020-06-01", "2021-01-01",
             "2020-03-02"]
    got = {(r.object_type, r.country, str(r.census_date)): r.object_count
           for r in history.census_at(versions, dates).collect()}
    want = {}
    for t, _, c, a, b in rows:
        for d in set(dates):
            if a <= d and (b is None or d < b):
                want[t, c, d] = want.get((t, c, d), 0) + 1
    assert got == want


# X8 -------------------------------------------------------------------------
def test_owner_join_needs_no_shuffle(spark, scratch):
    objects = spark.range(0, 500).select(F.col("id").cast("int").alias("norad_cat_id"),
                                         (F.col("id") % 2 == 0).alias("is_active"))
    raw = spark.createDataFrame(
        [(str(i % 300), f"op{i}", "KR" if i % 2 else None, "civil", str(i), i) for i in range(600)]
        + [("x", "bad id", None, None, None, 601)],
        "NORAD_CAT_ID string, operator string, operator_country string, purpose string, "
        "launch_mass_kg string, _seq bigint")
    o = store_bucketed(objects, "test_objects", f"{scratch}/objects", buckets=8)
    w = store_bucketed(clean_owners(raw), "test_owners", f"{scratch}/owners", buckets=8)
    joined = enrich_owners(o, w)
    assert "Exchange" not in _plan(joined) and "SortMergeJoin" in _plan(joined)
    got = {r.norad_cat_id: (r.operator, r.launch_mass_kg) for r in joined.collect()}
    assert got == {i: (f"op{i + 300}", float(i + 300)) if i < 300 else (None, None) for i in range(500)}
    summary = {(r.operator_country, r.purpose): (r.objects, r.active)
               for r in owner_summary(joined).collect()}
    assert summary == {("KR", "civil"): (150, 0), (None, "civil"): (150, 150), (None, None): (200, 100)}


# IO5 ------------------------------------------------------------------------
def _land(path, name, records):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.json", "w") as f:
        json.dump({"source": "s", "dataset": "d", "collected_at": "2024-01-01T00:00:00Z",
                   "record_count": len(records), "data": records}, f, indent=1)


def test_types_are_inferred_over_all_records_and_only_widen(spark, scratch):
    _land(f"{scratch}/l", "a", [{"i": 1, "f": 2, "m": 1, "n": {"a": 1}, "l": [1], "odd'name.x": "q",
                                 "z": None}] * 50)
    first = infer_record_schema(spark, f"{scratch}/l")
    assert {f.name: f.dataType.simpleString() for f in first.fields} == {
        "i": "bigint", "f": "bigint", "m": "bigint", "n": "struct<a:bigint>", "l": "array<bigint>",
        "odd'name.x": "string", "z": "string"}
    _land(f"{scratch}/l", "b", [{"i": 7, "f": 2.5, "m": "x", "n": {"a": 1, "b": True}, "l": [1.5],
                                 "new": "v"}])
    both = infer_record_schema(spark, f"{scratch}/l")
    kinds = {f.name: f.dataType.simpleString() for f in both.fields}
    assert kinds == {"i": "bigint", "f": "double", "m": "variant", "n": "struct<a:bigint,b:boolean>",
                     "l": "array<double>", "odd'name.x": "string", "z": "string", "new": "string"}
    rows = typed_records(landed_records(spark, f"{scratch}/l"), both, keep=["_record_index"])
    last = rows.where("new = 'v'").select("i", "f", F.to_json("m").alias("m"), "n.b", "l").first()
    assert tuple(last) == (7, 2.5, '"x"', True, [1.5])
    assert rows.where("new IS NULL").select("f", F.col("`odd'name.x`")).distinct().collect() == [(2.0, "q")]
    odd = spark.sql("""SELECT parse_json('{"a\\\\"b": 5}') AS record""")
    assert odd.select(field("record", 'a"b', T.LongType())).first()[0] == 5


def test_types_of_nothing(spark, scratch):
    assert infer_record_schema(spark, f"{scratch}/none") == T.StructType([])
    _land(f"{scratch}/l", "a", [])
    assert infer_record_schema(spark, f"{scratch}/l") == T.StructType([])


def test_widen():
    L, D, S, V = T.LongType(), T.DoubleType(), T.StringType(), T.VariantType()
    assert widen(L, L) == L and widen(T.IntegerType(), L) == L and widen(L, D) == D
    assert widen(L, S) == V and widen(S, T.ArrayType(S)) == V
    assert widen(T.ArrayType(L), T.ArrayType(D)) == T.ArrayType(D)
    a = T.StructType([T.StructField("x", L), T.StructField("y", S)])
    b = T.StructType([T.StructField("z", S), T.StructField("x", D)])
    assert [(f.name, f.dataType) for f in widen(a, b).fields] == [("x", D), ("y", S), ("z", S)]


def test_a_field_that_does_not_fit_is_null(spark):
    df = spark.sql("""SELECT parse_json('{"a": "x", "b": 3}') AS record""")
    row = df.select(field("record", "a", T.LongType()), field("record", "b", T.LongType()),
                    field("record", "c", T.StringType())).first()
    assert tuple(row) == (None, 3, None)
