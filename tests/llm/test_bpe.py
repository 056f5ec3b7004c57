from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyledger.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    shown = library.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(shown.encode()).hexdigest())


ODD = ["", " \t\n", "aaaaaaaaaaaaaaaaaaaa aaa aaaa", "Hello<|endoftext|>World<|startoftext|>",
       "<|endoftext|", "it's I'll 'system 12345 x² Ⅷ", "ΣΑΣ İstanbul",
       "école ẞ ﬁn", "\U0001f600\U0001f468‍\U0001f469 你好กำ",
       "  \u0085x\x00y ​", "!!!??? ... --- ###&&&", "\0<|endoftext|>", "x" * 30000]


def test_odd_texts_match_the_library(spark, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(99, None), (99, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("tokens", bpe.F.lit(1))
    got = bpe.digests(bpe.encode(df, PATH, ["doc_id"]), "doc_id").collect()
    assert sorted(tuple(r) for r in got) == sorted((i, *expected(library, t)) for i, t in rows)


def test_query_matches_the_library(spark, library):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: tuple(r)[1:] for r in bpe.op1_bpe(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    assert all(got[r.doc_id] == expected(library, r.text) for r in docs)


def test_decode_round_trip_and_empty_table(spark):
    df = spark.createDataFrame([(1, "Round trip"), (2, None)], "k long, text string")
    both = bpe.encode(df, PATH, ["k"])
    again = bpe.decode(both, PATH, ["k"])
    assert sorted(map(tuple, both.select("k", "decoded").collect())) == \
        sorted(map(tuple, again.collect()))
    assert bpe.encode(df.limit(0), PATH, ["k"]).count() == 0
