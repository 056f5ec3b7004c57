from __future__ import annotations

import random
import re

import numpy as np
from compare import compare, duck_connect

from skyledger.llm import near_dedup as nd
from skyledger.llm.components import components


def shingle_set(text, width=4):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall("[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    n = min(width, len(words))
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def brute(rows, width=4, percent=80):
    """Component of each key by comparing all pairs that share a shingle."""
    sets = [(k, shingle_set(t, width)) for k, t in rows]
    root = {k: k for k, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    inverted = {}
    for i, (_, s) in enumerate(sets):
        for x in s:
            inverted.setdefault(x, []).append(i)
    for i, (k, s) in enumerate(sets):
        common = {}
        for x in s:
            for j in inverted[x]:
                if j > i:
                    common[j] = common.get(j, 0) + 1
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j][1]) - n):
                a, b = find(k), find(sets[j][0])
                root[max(a, b)] = min(a, b)
    return {(k, len(s), find(k)) for k, s in sets}


def result(df):
    return {(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()}


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet")
            .select("doc_id", "text").collect()]
    got = nd.op7_near_dedup(spark, sf)
    assert result(got) == brute(rows)
    report = compare(got, duck_connect(sf), nd.ORACLE)
    assert report["ok"], report


def made(seed, n):
    """Groups of near copies around the threshold, short texts and odd rows."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    rows, k = [], 0
    for _ in range(n):
        base = rnd.choices(words, k=rnd.choice([5, 30, 200, 600]))
        for _ in range(rnd.choice([1, 2, 5])):
            edited = list(base)
            for _ in range(int(len(base) * rnd.choice([0, 0.01, 0.02, 0.025, 0.03, 0.05]))):
                edited[rnd.randrange(len(edited))] = rnd.choice(words)
            rows.append((k, rnd.choice([" ", "\n", "  "]).join(edited)))
            k += 1
    return rows


def test_made_copies_match_brute_force(spark):
    rows = made(3, 250)
    at = len(rows)
    rows += [(at, None), (at + 1, ""), (at + 2, " \n"), (at + 3, "One two"), (at + 4, "one  TWO"),
             (at + 5, "É x y z"), (at + 6, "é x y z"), (at + 7, "lone"), (at + 8, "a b c d"),
             (at + 9, "A b c D"), (at + 10, "long " * 20000), (at + 11, "long " * 30000)]
    df = spark.createDataFrame([(k, t, "n", b"s", 5) for k, t in rows],
                               "doc_id long, text string, node string, signature binary, key int")
    got = nd.near_duplicates(df)
    assert result(got) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


def test_large_bucket_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 16)
    rnd = random.Random(5)
    base = [f"v{i}" for i in range(300)]
    rows = []
    for k in range(150):
        edited = list(base)
        for _ in range(rnd.choice([2, 5, 9])):
            edited[rnd.randrange(300)] = f"x{rnd.randrange(10 ** 6)}"
        rows.append((k, " ".join(edited)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(nd.near_duplicates(df)) == brute(rows)


def test_null_and_repeated_keys_and_empty_table(spark):
    rows = [(None, "p q r s t"), (None, None), (5, "p q r s t"), (5, "k l m n o"),
            (3, "k l m n o"), (9, "K l m n o"), (9, "K l m n o"), (None, "u v w x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in nd.near_duplicates(df).collect()),
                 key=lambda r: tuple((x is not None, x or 0) for x in r))
    assert got == [(None, None), (None, None), (None, 3), (3, 3), (5, 3), (5, 3), (9, 3), (9, 3)]
    assert nd.near_duplicates(df.limit(0)).count() == 0


def test_near_copies_without_keys_are_compared(spark):
    """Rows with null keys near each other and near a numbered row; repeated rows."""
    base = [f"v{i}" for i in range(200)]
    near = " ".join(base[:100] + ["other"] + base[101:])
    alone = [" ".join(f"{c}{i}" for i in range(50)) for c in "pq"]
    rows = [(None, " ".join(base)), (None, near), (7, near + " end"), (None, alone[0]),
            (None, alone[0] + " x"), (None, alone[0]), (None, alone[1]), (None, None), (8, "")]
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.component_id or 0, r.n_shingles) for r in got) == sorted(
        [(7, 197), (7, 197), (7, 198), (0, 47), (0, 48), (0, 47), (0, 47), (0, 0), (8, 0)])
    groups = {}
    for r in got:
        groups.setdefault(r.component, []).append((r.n_shingles, r.kept))
    assert sorted(map(sorted, groups.values())) == [
        [(0, True), (0, True)], [(47, True)], [(47, True), (47, True), (48, True)],
        [(197, False), (197, False), (198, True)]]


def test_groups_are_bounded_by_their_shingles(spark, monkeypatch):
    """Few documents, but long ones: cut into blocks by shingles, nothing lost."""
    monkeypatch.setattr(nd, "BLOCK_SHINGLES", 2000)
    rows = made(11, 20)
    base = [f"v{i}" for i in range(600)]
    rnd = random.Random(9)
    for k in range(60):
        edited = list(base)
        for _ in range(rnd.choice([3, 8, 14])):
            edited[rnd.randrange(600)] = f"x{rnd.randrange(10 ** 6)}"
        rows.append((1000 + k, " ".join(edited)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(nd.near_duplicates(df)) == brute(rows)


def test_index_guarantee():
    """Every pair within the index distance shares a key, and one first key."""
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2 ** 16, (500, nd.INDEX)).astype("<u2")
    b = a.copy()
    for row in b:
        row[rng.choice(nd.INDEX, nd.MAX_INDEX_DISTANCE, replace=False)] ^= 1
    both = np.concatenate([a, b])
    first = nd.first_shared(both, np.arange(500), np.arange(500) + 500)
    assert (first < nd.INDEX).all()
    keys = nd.keys_of(both)
    equal = keys[:500] == keys[500:]
    assert (equal.argmax(axis=1) == first).all() and equal.any(axis=1).all()


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(100, 100 + i) for i in range(1, 50)]
    got = {tuple(r) for r in components(spark.createDataFrame(
        path + star + [(7, 7), (None, 3)], "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(1, 61)} | {(100 + i, 100) for i in range(1, 50)}


def test_only_texts_of_close_pairs_are_dealt_to_groups(spark, monkeypatch):
    stored = {}

    def store(df, name):
        stored[name] = kept(df, name)
        return stored[name]

    kept = nd.store
    monkeypatch.setattr(nd, "store", store)
    rng = random.Random(5)
    lone = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(60)) for _ in range(40)]
    near = lone[0] + " more"
    rows = [(i, t) for i, t in enumerate([*lone, near, lone[0], None, ""])]
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    linked = {r.doc_id for r in got.where("component_id = 0").collect()}
    assert linked == {0, 40, 41}
    assert sorted(r.text for r in stored["member-texts"].collect()) == sorted([lone[0], near])
