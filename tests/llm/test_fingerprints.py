from __future__ import annotations

import hashlib
import random

import pytest

from skyledger.llm import fingerprints as fp

SF = "/root/testdata/sf0.01"


def brute_fingerprint(text):
    """Byte by byte, with a chunk hash of each block size in turn."""
    import zlib
    data, mask = text.encode(), (1 << 32) - 1
    hashes = []
    for i in range(len(data)):
        h = sum((b + 1) * pow(0x01000193, j, 1 << 32) for j, b in enumerate(
            reversed(data[max(0, i - 6):i + 1]))) & mask
        h ^= h >> 16
        h = h * 0x85EBCA6B & mask
        hashes.append(h ^ h >> 13)

    def signature(block):
        out, begin, ends = "", 0, 0
        for i, h in enumerate(hashes):
            if h % block == block - 1:
                out += fp.ALPHABET[zlib.crc32(data[begin:i + 1]) & 63]
                begin, ends = i + 1, ends + 1
        if begin < len(data):
            out += fp.ALPHABET[zlib.crc32(data[begin:]) & 63]
        return out, ends

    block = 3
    while block * 64 < len(data):
        block *= 2
    while block > 3 and signature(block)[1] < 32:
        block //= 2
    return f"{block}:{signature(block)[0]}:{signature(2 * block)[0]}"


def brute_common(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


def brute(rows, of=fp.fingerprint):
    rows = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for i, (k, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        q = len(t) // 4
        edited = t[:len(t) - q] + after[:q]
        out.append((k, len(t), hashlib.sha256(edited.encode()).hexdigest(), of(t), of(edited),
                    fp.likeness(of(t), of(edited)), fp.likeness(of(t), of(after))))
    return out


def key(r):
    return (r[0] is not None, r[0] or 0, *r[1:])


def test_kernel_matches_brute_force():
    rnd = random.Random(2)
    for n in (0, 1, 5, 6, 7, 8, 60, 200, 3000, 9000):
        text = "".join(rnd.choices("abcdefgh \né", k=n))
        assert fp.fingerprint(text) == brute_fingerprint(text)
    for _ in range(200):
        a, b = ("".join(rnd.choices("ABCD", k=rnd.randrange(70))) for _ in range(2))
        assert fp._common_length(a, b) == brute_common(a, b)


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet")
            .select("doc_id", "text").collect()]
    got = [tuple(r) for r in fp.op3_fingerprints(spark, SF).collect()]
    assert sorted(got) == sorted(brute(docs))
    long = [r for r in got if r[1] >= 400]
    assert sum(r[5] for r in long) / len(long) > 0.6
    assert sum(r[5] > r[6] for r in long) >= 0.95 * len(long)


def test_odd_rows(spark):
    rows = [(5, "repeat"), (5, "repeat"), (5, "other"), (None, "null key"), (None, None), (1, ""),
            (2, None), (9, "x" * 300000), (8, "ab" * 100), (7, "é\U0001f600" * 50), (6, "abc")]
    df = spark.createDataFrame([(*r, 1, "p") for r in rows],
                               "doc_id long, text string, part int, place string")
    got = [tuple(r) for r in fp.fingerprints(df).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    assert fp.fingerprints(df.limit(0)).count() == 0
    lone = fp.fingerprints(df.where("doc_id = 6")).first()
    assert lone.near_edited == lone.near_next == 1.0


@pytest.mark.parametrize("seed", range(3))
def test_likeness_bounds(seed):
    rnd = random.Random(seed)
    text = " ".join(f"w{rnd.randrange(5000)}" for _ in range(800))
    near = text[:2000] + "inserted words" + text[2000:]
    other = " ".join(f"w{rnd.randrange(5000)}" for _ in range(800))
    a, b, c = map(fp.fingerprint, (text, near, other))
    assert fp.likeness(a, a) == 1 and 0.7 < fp.likeness(a, b) <= 1
    assert fp.likeness(a, c) < 0.3 and fp.likeness(a, b) == fp.likeness(b, a)
    assert fp.fingerprint("") == "3::" and fp.likeness("3::", a) == 0
