from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from skyledger.llm import language_id as li

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_from_text_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    part = F.pmod(F.xxhash64("text"), F.lit(2))
    model = li.fit(docs.where(part == 0))
    got = li.identify(docs.where(part == 1).withColumn("truth", F.col("lang")), model,
                      ["doc_id", "truth"]).collect()
    right = sum(r.truth == r.lang for r in got)
    assert len(got) > 300 and right >= 0.99 * len(got)


def test_query_covers_the_table_and_keeps_prose(spark):
    got = li.op10_language_id(spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.kept for r in got if len(docs[r.doc_id].text) > 20)


def test_pages(spark):
    got = li.page_languages(spark, SF).collect()
    html = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(got) == len(html)
    agree = sum(f'lang="{r.lang}"' in html[r.page_id] for r in got)
    assert agree >= 0.98 * len(got)


@pytest.fixture(scope="module")
def made(spark):
    en, fr = "the quick brown fox jumps over the lazy dog ", "le renard brun saute par dessus le chien "
    return li.fit(spark.createDataFrame([("en", en * 30), ("fr", fr * 30), (None, "x"), ("", "y")],
                                        "lang string, text string"))


def test_fusion_matches_plain_computation(spark, made):
    """Host prior, declaration and text by the same formulas in plain Python."""
    rows = [(i, "the dog", "en", "h1.example.com") for i in range(5)] + \
        [(10, "le chien", "fr", "h1.example.com"), (11, "o", "fr", "h2.example.com"),
         (12, "o", None, "h2.example.com"), (13, "o", "en", None)]
    df = spark.createDataFrame(rows, "k long, text string, said string, host string")
    got = {r.k: r for r in li.identify(
        df, made, ["k"], declared=F.col("said"), host=F.col("host"),
        domain=F.substring_index("host", ".", -2),
        suffix=F.substring_index("host", ".", -1)).collect()}
    names, model, n = made["names"], made["model"], len(made["names"])
    logs, post = {}, {}
    for k, text, *_ in rows:
        logs[k] = [float(x) / li.TEMPER for x in model[li.trigrams(text)].astype(float).sum(axis=0)]
        each = [math.exp(x - max(logs[k])) for x in logs[k]]
        post[k] = [x / sum(each) for x in each]

    def total(keep):
        return [sum(post[r[0]][i] for r in rows if keep(r)) for i in range(n)]

    def smooth(sums, parent):
        return [(s + li.PULL * p) / (sum(sums) + li.PULL) for s, p in zip(sums, parent)]

    whole = total(lambda r: True)
    top = [(x + 1) / (sum(whole) + n) for x in whole]
    for k, _, said, host in rows:
        part = lambda h, m: None if h is None else ".".join(h.split(".")[-m:])
        p = top
        for m in (1, 2, 9):
            sums = total(lambda r: part(r[3], m) == part(host, m))  # noqa: B023
            if m == 9:
                sums = [max(s - o, 0) for s, o in zip(sums, post[k])]
            p = smooth(sums, p)
        spoken = total(lambda r: r[2] == said)  # noqa: B023
        every = total(lambda r: r[2] is not None)
        values = len({r[2] for r in rows if r[2]})
        d = [1.0] * n if said is None else [
            (max(spoken[i] - post[k][i], 0) + 1) / (max(every[i] - post[k][i], 0) + values + 1)
            for i in range(n)]
        final = [logs[k][i] + math.log(p[i]) + math.log(d[i]) for i in range(n)]
        best = final.index(max(final))
        assert got[k].lang == (None if best == n - 1 else names[best])
        assert got[k].posterior == pytest.approx(
            1 / sum(math.exp(x - max(final)) for x in final), rel=1e-6)


def test_odd_rows(spark, made):
    rows = [(1, None), (2, ""), (3, "123 ... !!!"), (4, "the dog " * 50000), (5, "the dog"),
            (5, "the dog"), (None, "le chien"), (7, "你好世界" * 40)]
    df = spark.createDataFrame([(*r, "h", "p", 1) for r in rows],
                               "k long, text string, host string, posterior string, letters int")
    got = [(r.k, r.lang, r.accepted) for r in li.identify(df, made, ["k"]).collect()]
    assert sorted(got, key=lambda r: (r[0] is not None, r[0] or 0)) == [
        (None, "fr", True), (1, None, False), (2, None, False), (3, None, False),
        (4, "en", True), (5, "en", True), (5, "en", True), (7, None, False)]
    assert li.identify(df.limit(0), made, ["k"]).count() == 0
    none = li.fit(spark.createDataFrame([], "lang string, text string"))
    assert not any(r.accepted for r in li.identify(df, none, ["k"]).collect())


def tongues(n):
    """Labelled texts of ``n`` made-up languages, with words of their own."""
    made = random.Random(7)
    return [(f"l{i:03d}x", " ".join("".join(made.choices("abcdefghijklmnopqrstuvwxyz", k=7))
                                     for _ in range(60))) for i in range(n)]


def test_any_number_of_languages(spark, tmp_path):
    rows = [(i, lang, text, f"s{i % 3}") for i, (lang, text) in enumerate(tongues(150))]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string, source string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in li.op10_language_id(spark, str(tmp_path)).collect()}
    assert [(got[i].lang, got[i].kept) for i, *_ in rows] == [(r[1], True) for r in rows]


def test_blocks_of_languages_give_the_same_result(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = {r.doc_id: r for r in li.identify_documents(docs, ["doc_id"]).collect()}
    monkeypatch.setattr(li, "BLOCK", 2)
    monkeypatch.setattr(li, "HELD_BLOCKS", 1)
    more = {r.doc_id: r for r in li.identify_documents(docs, ["doc_id"]).collect()}
    assert one.keys() == more.keys()
    for k, r in one.items():
        assert r.lang == more[k].lang and r.accepted == more[k].accepted
        assert r.posterior == pytest.approx(more[k].posterior, rel=1e-9)


def test_spellings_of_a_label_are_one_language(spark):
    en, fr = "the quick brown fox jumps over the lazy dog ", "le renard brun saute par dessus "
    df = spark.createDataFrame(
        [("EN", en), (" en ", en * 2), ("en-US", en * 3), ("en_gb", en), ("fr", fr), ("FR\t", fr),
         ("es-419", "hola"), ("x-1", "a"), ("lang-17", "b"), ("zh-hant", "c"), (" ", "d")],
        "lang string, text string")
    model = li.fit(df)
    assert model["names"] == ["en", "es", "fr", "lang-17", "x-1", "zh-hant", li.UNKNOWN]


def test_copies_of_a_text_count_once_in_the_model(spark):
    rows = [("en", f"{text} text") for _, text in tongues(20)] + [("fr", "le renard brun")]
    copied = rows + [("en", "one text with many copies")] * 3000 + [("EN", rows[0][1])] * 500
    once = rows + [("en", "one text with many copies")]
    kind = "lang string, text string"
    got, want = (li.fit(spark.createDataFrame(r, kind)) for r in (copied, once))
    assert got["names"] == want["names"] and (got["model"] == want["model"]).all()


def test_quotes_open_a_value_after_an_equals_sign_only():
    import pyarrow as pa
    page = "<p title=it's>FIRST</p><p>SECOND it's</p><p class = \"a>b\" id='c'>THIRD</p>"
    (out,) = li.visible_text(iter([pa.record_batch({"text": [page]})]))
    assert out.column("text")[0].as_py().split() == ["FIRST", "SECOND", "it's", "THIRD"]


def test_odd_pages(spark, made):
    page = "<html lang=en><body><p>the quick brown fox jumps over the lazy dog</p>"
    rows = [(1, "http://a.example.com/x", page), (1, "http://a.example.com/x", page),
            (None, None, page), (2, "no host", page), (3, "http://b/", None), (4, "http://b/", ""),
            (5, "http://b/", "<p>1 2 3</p>"), (6, "http://b/", "<p>" + "the dog " * 50_000)]
    df = spark.createDataFrame([(*r, "xx", 1.5) for r in rows],
                               "page_id long, url string, html string, lang string, posterior double")
    got = li.identify_pages(df, made)
    assert got.columns == ["page_id", "lang", "posterior", "text_lang", "letters", "accepted"]
    found = sorted((r.page_id or 0, r.lang, r.accepted) for r in got.collect() if r.lang)
    assert found == [(0, "en", True), (1, "en", True), (1, "en", True), (2, "en", True), (6, "en", True)]
    assert sorted(r.page_id for r in got.collect() if not r.accepted) == [3, 4, 5]
    assert li.identify_pages(df.limit(0), made).count() == 0
