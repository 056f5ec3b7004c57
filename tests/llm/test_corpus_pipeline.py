from __future__ import annotations

import re
from collections import Counter

import public_tokenizers
import pytest
from test_exact_dedup import brute as brute_exact
from test_mixing import brute_targets
from test_near_dedup import brute as brute_near
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    """Each stage's input and output as rows, written and read again."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs.collect())]
    for i, (name, stage) in enumerate(cp.STAGES):
        result = stage(spark, docs, SF)
        if i < len(cp.STAGES) - 1:
            assert result.columns == docs.columns
        path = str(tmp_path_factory.mktemp("stage") / name)
        result.write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, docs.collect()))
    return out


def test_language_stage_keeps_prose(outputs):
    before, after = outputs[0][1], outputs[1][1]
    kept = {r.doc_id for r in after}
    assert all(r.doc_id in kept for r in before if len(r.text) > 20)
    # the identified language stands in ``lang``; nothing else changes
    own = {tuple(v for k, v in r.asDict().items() if k != "lang") for r in before}
    assert {tuple(v for k, v in r.asDict().items() if k != "lang") for r in after} <= own
    said = {r.doc_id: r.lang for r in before}
    assert sum(r.lang == said[r.doc_id] for r in after) > 0.98 * len(after)


def test_language_stage_puts_wrong_labels_right(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    wrong = F.col("doc_id") % 20 == 3
    other = F.when(F.col("lang") == "en", "fr").otherwise("en")
    docs.withColumn("lang", F.when(wrong, other).otherwise(F.concat(F.upper("lang"), F.lit(" ")))) \
        .write.parquet(str(tmp_path / "d"))
    truth = {r.doc_id: r.lang for r in docs.collect()}
    after = cp.language_id(spark, spark.read.parquet(str(tmp_path / "d")), SF).collect()
    swapped = [r for r in after if r.doc_id % 20 == 3 and len(r.text) > 200]
    assert len(swapped) > 20
    assert sum(r.lang == truth[r.doc_id] for r in swapped) > 0.95 * len(swapped)
    # a right label stays as it was written
    assert all(r.lang == truth[r.doc_id].upper() + " " for r in after
               if r.doc_id % 20 != 3 and len(r.text) > 200)


def test_exact_stage(outputs):
    before, after = outputs[1][1], outputs[2][1]
    want = {k for k, keep, *_ in brute_exact([(r.doc_id, r.text) for r in before]) if k == keep}
    assert sorted(r.doc_id for r in after) == sorted(want)


def test_near_stage(outputs):
    before, after = outputs[2][1], outputs[3][1]
    rows = [(r.doc_id, r.text) for r in before]
    want = {k for k, _, c in brute_near(rows, cp.SHINGLE_WORDS) if k == c}
    assert sorted(r.doc_id for r in after) == sorted(want)


def test_mix_stage(outputs):
    before, after = outputs[3][1], outputs[4][1]
    n = {r.doc_id: len(re.findall("[^\x20\x09-\x0D]+", r.text or "")) for r in before}
    sizes, taken = Counter(), Counter()
    for r in before:
        sizes[r.source] += n[r.doc_id]
    for r in after:
        taken[r.source] += n[r.doc_id]
    for s, target in brute_targets(sizes).items():
        assert abs(taken[s] - target) <= max(n[r.doc_id] for r in before if r.source == s)
    assert max(Counter(r.doc_id for r in after).values()) <= 3


def test_bpe_stage(outputs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    before, after = outputs[4][1], outputs[5][1]
    ids = {r.doc_id: library.encode(r.text, add_special_tokens=False).ids for r in before}
    assert Counter(r.doc_id for r in after) == Counter(r.doc_id for r in before)
    assert all(list(r.tokens) == ids[r.doc_id] and r.n_tokens == len(r.tokens) for r in after)


def test_bpe_stage_decodes_every_row(spark):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = [(1, "It's 2 dogs", "en", "s"), (1, "It's 2 dogs", "en", "s"), (2, None, None, None),
            (None, "", "en", "s"), (3, "école <|endoftext|> 你好", "fr", "t"), (4, "word " * 40000, "en", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = Counter((r.doc_id, r.lang, r.source, r.decoded) for r in cp.bpe(spark, docs, SF).collect())
    shown = [library.decode(library.encode(t or "", add_special_tokens=False).ids,
                            skip_special_tokens=False) for _, t, *_ in rows]
    assert got == Counter((i, lang, source, s) for (i, _, lang, source), s in zip(rows, shown))


def test_odd_documents_pass_every_stage(spark):
    rows = [(1, "the dog runs", "en", "s", 1), (1, "the dog runs", "en", "s", 1),
            (2, None, None, None, None), (2, "", "en", None, 0), (None, "the cat sits", "en", "s", 2),
            (None, "the cat sits", "en", "s", 2), (3, "word " * 40000, "en", "t", 3),
            (4, "THE DOG runs", None, "t", 4), (4, "le chien court", "fr", "t", 4)]
    docs = spark.createDataFrame(
        [(*r, "x", 7, 1.5) for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long, "
        "kept string, copies int, posterior double")
    for empty in (False, True):
        now = docs.limit(0) if empty else docs
        for name, stage in cp.STAGES[:-1]:
            now = stage(spark, now, SF)
            assert now.columns == docs.columns
        assert cp.bpe(spark, now, SF).count() == now.count()
    left = cp.exact_dedup(spark, cp.language_id(spark, docs, SF), SF).collect()
    assert Counter(r.text for r in left).most_common(1)[0][1] == 1
