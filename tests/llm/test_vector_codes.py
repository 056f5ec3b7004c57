from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from compare import SF_CHECK, compare, duck_connect
from skyledger.llm import vector_codes as V

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, parts, entries, rounds, scale):
    """Plain Lloyd by full scans over Python integers."""
    kept = [(i, l, [math.floor(scale * x) for x in v]) for i, v, l in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not kept:
        return [], []
    width = len(kept[0][2]) // parts
    cut = [[r[2][p * width:(p + 1) * width] for p in range(parts)] for r in kept]
    books = [[cut[e][p] for e in range(min(entries, len(kept)))] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for turn in range(rounds + 1):
        found = [[nearest(row[p], books[p]) for p in range(parts)] for row in cut]
        if turn < rounds:
            for p in range(parts):
                for e in range(len(books[p])):
                    own = [row[p] for row, f in zip(cut, found) if f[p][1] == e]
                    if own:
                        books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    out = [(i, l, tuple(e for _, e in f), sum(d for d, _ in f))
           for (i, l, _), f in zip(kept, found)]
    return out, books


def coded(spark, rows, **kw):
    out, books = V.compress(spark.createDataFrame(rows, SCHEMA), **kw)
    return [(r.vec_id, r.label, tuple(r.codes), sum(r.dists)) for r in out.collect()], books


def key(row):
    return tuple((x is None, x) for x in row[:2]) + row[2:]


@pytest.mark.parametrize("scale", [4, 1024])
def test_equals_full_scans_with_many_ties(spark, scale):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.integers(-6, 7, 8) / 2], int(i) % 3 or None)
            for i in rng.permutation(160)]
    rows += [rows[0], rows[1], (None, [1.0] * 8, 1), (None, [0.5] * 8, None)]
    kw = dict(parts=4, entries=16, rounds=4, scale=scale)
    found, books = coded(spark, rows, **kw)
    expected, expected_books = brute(rows, **kw)
    assert sorted(found, key=key) == sorted(expected, key=key)
    assert books.tolist() == expected_books


def test_unusable_vectors_go_and_few_rows_give_small_codebooks(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 2.0, 3.0, 4.0], 1), (1, None, 1), (2, [1.0, None, 3.0, 4.0], 1), (3, [], 1),
            (4, [1.0, nan, 3.0, 4.0], None), (6, [inf, 2.0, 3.0, 4.0], 1), (7, [-inf] * 4, 1),
            (8, [-0.5, 2.0, 3.0, 4.0], None)]
    found, books = coded(spark, rows)
    assert sorted(f[0] for f in found) == [5, 8]
    assert books.shape == (4, 2, 1)
    assert [f[3] for f in found] == [0, 0]


def test_empty_table_and_clashing_columns(spark):
    assert coded(spark, []) == ([], pytest.approx(np.zeros((4, 0, 0))))
    df = spark.createDataFrame([(1, [1.0] * 4, 2, 9, "x")],
                               SCHEMA + ", codes int, part string")
    out, _ = V.compress(df)
    assert out.columns == ["vec_id", "label", "vec", "codes", "dists"]
    assert out.count() == 1


def test_lengths_and_sizes_that_cannot_be_coded_raise(spark):
    for rows in ([(1, [1.0] * 4, 0), (2, [1.0] * 8, 0)], [(1, [1.0] * 6, 0)],
                 [(1, [1e30] * 4, 0)]):
        with pytest.raises(Exception, match="length|differ|out of range"):
            coded(spark, rows)


def test_wide_components_stay_exact():
    rng = np.random.default_rng(5)
    x = rng.integers(-2 ** 26, 2 ** 26, (40, 16))
    c = rng.integers(-2 ** 26, 2 ** 26, (9, 16))
    exact = [[sum((int(a) - int(b)) ** 2 for a, b in zip(u, v)) for v in c] for u in x]
    assert V.squared_distances(x, c).tolist() == exact


def test_active_entries_give_what_a_full_scan_gives():
    rng = np.random.default_rng(8)
    x, book = rng.integers(-4, 5, (500, 2)), rng.integers(-4, 5, (12, 2))
    codes, dists = V.assign_part(x, book, np.ones(12, bool), None, None)
    for _ in range(20):
        moved = rng.random(12) < 0.4
        book = np.where(moved[:, None], rng.integers(-4, 5, (12, 2)), book)
        codes, dists = V.assign_part(x, book, moved, codes, dists)
        full = V.assign_part(x, book, moved, None, None)
        assert (codes == full[0]).all() and (dists == full[1]).all()


def test_query_matches_sql(spark):
    report = compare(V.op12_vector_codes(spark, SF_CHECK), duck_connect(SF_CHECK), V.ORACLE)
    assert report["ok"], report
    assert len(V.codebook_digest(np.zeros((4, 1, 2), np.int64))) == len(hashlib.sha256().hexdigest())
