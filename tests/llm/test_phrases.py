from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from compare import SF_CHECK, compare, duck_connect
from skyledger.llm import phrases as P

SCHEMA = "doc_id bigint, text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def count(rows):
    """Every phrase of one to four words, counted one by one."""
    f = defaultdict(Counter)
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 5):
                for i in range(len(ws) - k + 1):
                    f[lang or "und"][tuple(ws[i:i + k])] += 1
    return f


def brute(rows, least):
    out = set()
    for lang, f in count(rows).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cand = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        inside = defaultdict(int)
        for p, c in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], c)
        for p, a in cand.items():
            if 100 * inside[p] >= 80 * a:
                continue
            score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                 for k in range(1, len(p)))
            out.add((lang, " ".join(p), len(p), a, l, r, n, score))
    return out


def corpus(seed, n=150):
    rng = random.Random(seed)
    vocab = ["a", "b", "c", "d", "E", "é", "Ä", "x y", "\x1f", "und"]
    passage = " ".join(f"p{i}" for i in range(40))
    rows = []
    for i in range(n):
        text = "".join(rng.choice(vocab) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "!?", " :"])
                       for _ in range(rng.randrange(0, 60)))
        if i % 9 == 0:
            text += " " + passage
        if i % 11 == 0:
            text += ", a b c d a b c d " + passage[:60] + " "
        rows.append((i, text, rng.choice(["en", "de", None, "und"])))
    return rows + rows[:10] + [(None, None, "en"), (900, "", None), (901, "  \t ..", "fr")]


def found(spark, rows, least, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return [tuple(r) for r in P.collocations(df, min_count=least, **kw)
            .select("lang", "phrase", "words", "a", "l", "r", "n", "score").collect()]


@pytest.mark.parametrize("seed,least,bits", [(1, 3, 24), (2, 5, 4), (3, 2, 10)])
def test_equals_counting_every_phrase(spark, seed, least, bits):
    """Also with so few counters that pairs share them."""
    rows = corpus(seed)
    got = found(spark, rows, least, bits=bits)
    assert len(got) == len(set(got)) and set(got) == brute(rows, least)


def test_counts_of_all_lengths_follow_from_edges(spark):
    rows = corpus(4)
    counts, totals = P.phrase_counts(spark.createDataFrame(rows, SCHEMA), min_count=4, bits=12)
    expected = {(lang, " ".join(p), len(p), c) for lang, f in count(rows).items()
                for p, c in f.items() if c >= 4}
    assert {tuple(r) for r in counts.collect()} == expected
    words = {lang: sum(c for p, c in f.items() if len(p) == 1) for lang, f in count(rows).items()}
    assert {r.lang: r.n for r in totals.collect()} == {k: n for k, n in words.items() if n}


def test_unary_paths_are_compacted(spark):
    """A passage of 40 words is one path until another text leaves it in the middle."""
    passage = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join(passage), "en") for i in range(5)]
    counts, _ = P.phrase_counts(spark.createDataFrame(rows, SCHEMA), min_count=2, bits=12)
    assert [tuple(r) for r in P.compact_paths(counts).collect()] == \
        [("en", " ".join(passage), 40, 5)]
    rows += [(i, " ".join(passage[5:20] + ["other", "end"]), "en") for i in range(9, 11)]
    counts, _ = P.phrase_counts(spark.createDataFrame(rows, SCHEMA), min_count=2, bits=12)
    paths = [tuple(r) for r in P.compact_paths(counts).collect()]
    # nodes p5.. (texts start) and p17 p18 p19 (texts part) branch
    assert sorted((p.split()[0], n, f) for _, p, n, f in paths) == \
        [("p0", 8, 5), ("p17", 5, 2), ("p17", 23, 5), ("p5", 15, 7)]
    edges = Counter()
    for _, p, n, f in paths:
        ws = p.split()
        edges.update({" ".join(ws[i:i + 4]): f for i in range(n - 3)})
    assert edges == Counter({r.phrase: r.f for r in counts.where("words = 4").collect()})


def test_repeated_words_and_loops(spark):
    rows = [(i, "der " * (5 + i) + ". ab ab ab ab ab " * 3, "de") for i in range(6)]
    assert set(found(spark, rows, 3, bits=12)) == brute(rows, 3)


def test_empty_tables_nulls_and_clashing_columns(spark):
    assert found(spark, [], 2, bits=8) == []
    assert found(spark, [(None, None, None), (1, "", "en"), (2, "...", "en")], 1, bits=8) == []
    df = spark.createDataFrame([(1, "a b a b", "en", 7, "x", 1)],
                               SCHEMA + ", f int, phrase string, n int")
    rows = P.collocations(df, min_count=2, bits=8).collect()
    assert [(r.phrase, r.a, r.l, r.r, r.n) for r in rows] == [("a b", 2, 2, 2, 4)]


def test_long_texts_are_cut_at_piece_ends_only(spark, monkeypatch):
    import pyarrow as pa
    text = "a b c. d e f g h i j. k l" * 3
    batch = pa.record_batch({"lang": ["en"], "text": [text]})
    parts = [b for _, b in P._blobs(batch, limit=6)]
    assert b"".join(parts) == text.encode() and all(p.endswith((b".", b"l")) for p in parts)
    assert len(parts) > 5


def test_words_of_a_slice_are_not_kept():
    """A task's memory would grow with the text it reads until garbage is collected."""
    import gc
    gc.collect()
    gc.disable()
    try:
        for _ in range(20):
            P._word_ids(b"a b c. a b")
        assert gc.collect() == 0
    finally:
        gc.enable()


def test_bucket_counts_are_passed_on_by_blocks(monkeypatch):
    """With few numbers held, blocks and buckets come in several rows; a row's counts
    are those of a block's buckets."""
    import numpy as np
    import pyarrow as pa
    monkeypatch.setattr(P, "HELD", 50)
    rows = corpus(5)
    batch = pa.record_batch({"lang": [r[2] or "und" for r in rows], "text": [r[1] or "" for r in rows]})
    for bits in (4, 20):
        want = Counter()
        for lang, blob in P._blobs(batch):
            reach, buckets = P._reach(lang, *P._word_ids(blob), [], 2, bits)
            want.update(buckets[-1][reach[-1][:len(buckets[-1])]].tolist())
        out = list(P._bucket_counter([], bits)(iter([batch])))
        got = Counter()
        for r in (r for b in out for r in b.to_pylist()):
            n = np.frombuffer(r["n"], "<u4")
            assert n.sum() <= P.HELD
            for low, c in zip(np.frombuffer(r["buckets"], "<u2").tolist(), n.tolist()):
                got[r["block"] << P.BLOCK_BITS | low] += c
        assert got == want and len(out) > 10
        ordered = pa.Table.from_batches(out).sort_by("block").to_batches(max_chunksize=3)
        often = set()
        for r in (r for b in P._block_bits(3, bits)(iter(ordered)) for r in b.to_pylist()):
            at = np.flatnonzero(np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little"))
            often |= {r["block"] << P.BLOCK_BITS | i for i in at.tolist()}
        assert often == {b for b, c in want.items() if c >= 3}


def test_query_matches_sql(spark):
    report = compare(P.op13_phrases(spark, SF_CHECK), duck_connect(SF_CHECK), P.ORACLE)
    assert report["ok"] and report["spark_rows"] > 50, report
