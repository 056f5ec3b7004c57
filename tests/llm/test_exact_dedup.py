from __future__ import annotations

import hashlib
import re

from compare import compare, duck_connect

from skyledger.llm import exact_dedup as ed


def brute(rows):
    norm = [(k, re.sub("[\x20\x09-\x0D]+", " ", t or "")) for k, t in rows]
    groups = {}
    for k, t in norm:
        groups.setdefault(t, []).append(k)
    order = lambda k: (k is not None, k or 0)
    return [(k, min(groups[t], key=order), len(groups[t]),
             hashlib.sha256(t.encode()).hexdigest()) for k, t in norm]


LONG = "word " * 30000
ROWS = [(1, "a  b\n"), (2, "a b "), (2, "a b "), (3, "a b"), (4, None), (5, ""), (6, " \t"),
        (7, LONG), (8, LONG[:-2] + "x "), (9, LONG + "\n"), (10, LONG), (11, "é" * 40),
        (12, "é" * 40), (13, "é" * 39 + "e"), (None, "é" * 40), (None, "z"), (14, "x" * 32),
        (15, "x" * 32), (16, "x" * 33), (17, "nb sp"), (18, "nb sp"), (18, "other")]


def key(r):
    return tuple((x is not None, x) if x is not None else (False, 0) for x in r)


def test_edge_rows_match_brute_force(spark):
    df = spark.createDataFrame([(k, t, "s", 1, 2) for k, t in ROWS],
                               "doc_id long, text string, size string, row long, first long")
    got = ed.exact_duplicates(df).collect()
    want = brute(ROWS)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=key) \
        == sorted(want, key=key)
    # one kept row a group, the one with the smallest key
    assert sum(r.kept for r in got) == len({w[3] for w in want})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_empty_table(spark):
    assert ed.exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    report = compare(ed.op4_exact_dedup(spark, sf), duck_connect(sf), ed.ORACLE)
    assert report["ok"], report
