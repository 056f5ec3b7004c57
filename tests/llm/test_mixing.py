from __future__ import annotations

import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from skyledger.llm import mixing as mx
from skyledger.llm.common import ROW, addressed


def brute_targets(sizes: dict, weights=(5, 2, 1), most=3):
    """Share by weight; hold those above their cap, share their excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, target = sum(sizes.values()), set(names), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] > most * sizes[s]]
        if not over:
            target.update({s: unit * weight[s] for s in free})
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            free.discard(s)
    return target


def check(rows, source_of, key="doc_id"):
    sizes, taken, top = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        s = source_of[r[key]]
        sizes[s] += r.size_
        taken[s] += r.taken
        top[s] = max(top[s], r.size_)
        assert r.taken in [c * r.size_ for c in range(4)]
    want = brute_targets(sizes)
    for r in rows:
        s = source_of[r[key]]
        assert r.source_size == sizes[s]
        assert r.target == pytest.approx(want[s], rel=1e-9, abs=1e-9)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= top[s] / 2 + 1e-6


def test_query_meets_targets_and_reruns_agree(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = mx.op8_mix_sources(spark, sf).withColumnRenamed("size", "size_").collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.size_ == len(re.findall("[^\x20\x09-\x0D]+", docs[r.doc_id].text or ""))
    check(rows, {k: d.source for k, d in docs.items()})
    again = mx.op8_mix_sources(spark, sf).withColumnRenamed("size", "size_").collect()
    assert sorted(rows) == sorted(again)


def brute_taken(rows, least=mx.ODDS_BOUNDS[0], most=mx.ODDS_BOUNDS[1]):
    """Copies of (row id, source, size, importance in steps, draw), one source after another,
    and the probabilities."""
    sizes, copies, chance = defaultdict(int), {}, {}
    for _, s, n, _, _ in rows:
        sizes[s] += n
    for s, target in brute_targets(sizes).items():
        own = [r for r in rows if r[1] == s]
        expected = target / sizes[s] if sizes[s] else 0.0
        whole = math.floor(expected)
        missing = max(target - whole * sizes[s], 0.0)
        mean = sum(q * n for _, _, n, q, _ in own) / sizes[s] if sizes[s] else 1.0
        ranked = []
        for i, _, n, q, draw in own:
            p = chance[i] = min(max((expected - whole) * q / (mean or 1.0), least), most)
            u = (draw % 2 ** 52 + 0.5) / 2 ** 52
            odds = (u / (1 - u)) / (p / (1 - p))
            ranked.append((odds / (1 + odds), i, n))
        reached = 0
        for _, i, n in sorted(ranked):
            # the document at the cut is taken while half of it or more is missing
            copies[i] = whole + (missing - reached >= n / 2 if missing < reached + n else missing > 0)
            reached += n
    return copies, chance


@pytest.mark.parametrize("importance", [None, "quality"])
def test_selection_equals_plain_python(spark, tmp_path, importance):
    """The documents taken, one by one, with probabilities that differ within a source."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet") \
        .withColumn("quality", F.when(F.col("doc_id") % 7 > 0, F.col("doc_id") % 7 + 0.25))
    docs.repartition(3).write.parquet(str(tmp_path / "docs"))
    rows = addressed(spark.read.parquet(str(tmp_path / "docs")))
    facts = rows.select(ROW, "source", mx.word_count().alias("n"), "quality",
                        mx.draws(rows, "doc_id", "text", mx.SEED).alias("draw")).collect()

    def steps(r):
        q = math.sqrt(r.n) if importance is None else r.quality or 0
        return max(math.floor(q * mx.IMPORTANCE_STEPS), 1)
    want, chance = brute_taken([(r[ROW], r.source, r.n, steps(r), r.draw) for r in facts])
    got = {r[ROW]: r.copies for r in mx.mix(rows, carry=(ROW,), importance=importance).collect()}
    assert got == want
    by_source = defaultdict(set)
    for r in facts:
        by_source[r.source].add(round(chance[r[ROW]], 6))
    assert min(map(len, by_source.values())) >= 4     # unequal within each source
    # of documents of more importance, more are sampled
    taken = [(chance[k], c) for k, c in got.items() if 0.001 < chance[k] < 0.999]
    half = sorted(taken)[len(taken) // 2][0]
    share = [sum(c % 1 + (c > 0) for p, c in taken if (p > half) == big) for big in (False, True)]
    assert share[1] > share[0]


def test_equal_rows_are_dealt_over_all_ranks(spark):
    df = spark.createDataFrame([(1, "a b c", "s")] * 3000 + [(2, "x " * 9000, "t")],
                               "doc_id long, text string, source string")
    got = mx.mix(df).collect()
    check([type(r)(**{**r.asDict(), "size_": r["size"]}) for r in got], {1: "s", 2: "t"})
    stored = addressed(df)
    assert stored.select(mx.draws(stored, "doc_id", "text", 1)).distinct().count() == 3001


def test_edges(spark):
    rows = [(1, "a b c", "x"), (2, None, "x"), (3, "", None), (4, "a", None), (5, "q " * 5000, "y"),
            (6, "m n", "zero"), (7, None, "none"), (8, "é ü", "X"), (9, "w " * 50, "x")]
    rows += [(100 + i, "t u v", "hot") for i in range(500)]
    df = spark.createDataFrame([(*r, 1, 1.0) for r in rows],
                               "doc_id long, text string, source string, size int, target double")
    got = mx.mix(df).withColumnRenamed("size", "size_").collect()
    assert len(got) == len(rows)
    check(got, {r[0]: r[2] for r in rows})


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b", "s")] * 40 + [(2, "c d e", "t")] * 40,
                               "doc_id long, text string, source string")
    got = mx.mix(df).collect()
    assert len(got) == 80 and all(0 <= r.copies <= 3 for r in got)
    assert mx.mix(df.limit(0)).count() == 0


def test_main_path_has_no_python(spark):
    plan = mx.op8_mix_sources(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
