from __future__ import annotations

import hashlib
import math
import random
import re

from skyledger.llm import secrets as sc

SF = "/root/testdata/sf0.01"


def brute_base(text):
    """The contract's patterns, kind by kind."""
    text = text or ""
    either = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password")
    words = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
                     for w in ("password", "passwd", "secret", "token"))
    assert either in words
    words += "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
    found = [(m.start(), 0, m.end()) for m in re.finditer(
        rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
              if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def shown(spans):
    return ",".join(f"{sc.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def check(docs, got):
    assert len(docs) == len(got)
    for r in got:
        base = brute_base(docs[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in base)
                                                     for i in range(3)]
        assert r.base_sha256 == hashlib.sha256(shown(base).encode()).hexdigest()
        assert set(shown(base).split(",")) <= set(r.spans.split(","))


def test_query_matches_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check(docs, sc.op2_secrets(spark, SF).collect())


GITHUB = "ghp_" + "aB3dE5" * 6
ODD = [(1, "a", None), (2, "a", ""), (3, "a", 'PassWord = "abc12" token:"abcdef" ſecret=zzzzzzz'),
       (4, "b", "é\U0001f600 API_KEY: k.k/k+k=k- apikey='123456' \n secret \t= abcdefgh"),
       (5, "a", "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + " xAKIA" + "C" * 30),
       (6, "c", "deadbeef" * 3 + " " + "DEADBEEF" * 3 + " " + "f" * 23),
       (7, "a", f"token: secret=abcdefgh {GITHUB} tail"), (8, None, "x" * 200000 + " token=abcdef")]


def test_odd_texts(spark, tmp_path):
    df = spark.createDataFrame([(*r, r[0] % 3, 1) for r in ODD],
                               "doc_id long, source string, text string, lang int, kind int")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = sc.op2_secrets(spark, str(tmp_path)).collect()
    check({k: t for k, _, t in ODD}, got)
    assert "github:23:" in next(r.spans for r in got if r.doc_id == 7)


def test_copied_examples_are_told_from_owned_credentials(spark):
    other = "ghp_" + "Zy9" * 12
    rows = [(i, f"s{i}", f"see {GITHUB} password=hunter2x") for i in range(5)] + \
        [(10, "s1", f"mine {other}"), (11, "s1", f"mine {other} token=owned123"),
         (11, "s1", f"mine {other} token=owned123")]
    df = spark.createDataFrame(rows, "k long, o string, text string").withColumn("r", sc.F.col("k"))
    got = sorted((r.k, [(s.kind, s.owners, s.repositories, s.live) for s in r.spans])
                 for r in sc.find_secrets(df, ["k"], "o", "r").collect())
    assert got == [*[(i, [(0, 5, 5, False)]) for i in range(5)],
                   (10, [(3, 1, 2, True)]), *[(11, [(3, 1, 2, True), (0, 1, 1, True)])] * 2]
    assert sc.find_secrets(df.limit(0), ["k"], "o", "r").count() == 0


def test_further_spans_stay_with_their_class(spark, tmp_path):
    """A leaked text copied into 3 sources is live; an example in many texts of one
    source is none, and its spans stay; copies of one text count once."""
    example, copied = "ghp_" + "Qw7" * 12, "ghp_" + "Lp4" * 12
    rows = [(i, f"s{i}", f"leak {GITHUB}") for i in range(3)] + \
        [(100 + i, "hot", f"text {i} {example} password=example1") for i in range(40)] + \
        [(200 + i, "hot", f"same {copied}") for i in range(40)] + \
        [(300 + i, f"s{i}", f"wide {'ghp_' + 'Mn8' * 12}") for i in range(6)]
    spark.createDataFrame(rows, "doc_id long, source string, text string") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in sc.op2_secrets(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows) and all("github:" in r.spans for r in got.values())
    for first, classes, n_live, n_examples in (
            (0, "live:3:3", 1, 0), (100, "example:1:40,example:1:40", 0, 2),
            (200, "live:1:40", 1, 0), (300, "example:6:6", 0, 1)):
        rest = [r for k, r in got.items() if first <= k < first + 100]
        assert {(r.classes, r.n_live, r.n_examples) for r in rest} == {(classes, n_live, n_examples)}


def brute_spans(text):
    """All spans with their values: base ones, then further kinds where nothing is yet,
    kind by kind, character by character."""
    text = text or ""
    found = [(s, k, e, brute_value(text, s, k, e)) for s, k, e in brute_base(text)]
    free = [True] * len(text)
    for s, _, e, _ in found:
        free[s:e] = [False] * (e - s)
    patterns = [r"\bgh[pousr]_[A-Za-z0-9]{36,}", r"\bxox[abprs]-[A-Za-z0-9-]{10,}",
                r"\bAIza[A-Za-z0-9_-]{35}", r"\b[rs]k_live_[A-Za-z0-9]{16,}",
                r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
                r"-----BEGIN ([A-Z0-9 ]*)PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END \1PRIVATE KEY-----",
                r"[A-Za-z0-9+/_-]{24,}={0,2}"]
    for kind, pattern in enumerate(patterns, 3):
        for m in re.finditer(pattern, text):
            v = m[0]
            if kind == 9:
                shares = [v.count(c) / len(v) for c in set(v)]
                mixed = re.search("[0-9]", v) and re.search("[a-z]", v) and re.search("[A-Z]", v)
                if not mixed or -sum(p * math.log2(p) for p in shares) < 4 - 1e-12:
                    continue
            if all(free[m.start():m.end()]):
                free[m.start():m.end()] = [False] * len(v)
                found.append((m.start(), kind, m.end(), v))
    return sorted(found)


def brute_value(text, start, kind, end):
    if kind:
        return text[start:end]
    return re.match(r"""(?is)[a-z_]+["']?\x20*[:=]\x20*["']?(.*)""", text[start:end])[1]


def brute_ownership(rows):
    """Owners, repositories and distinct texts of every value, as sets."""
    owners, places, texts = {}, {}, {}
    for k, owner, text in rows:
        for *_, value in brute_spans(text):
            owners.setdefault(value, set()).add(owner)
            places.setdefault(value, set()).add((owner, k))
            texts.setdefault(value, set()).add(text)
    return {v: (len(owners[v]), len(places[v]), len(texts[v])) for v in owners}


def check_whole(rows, got):
    known = brute_ownership(rows)
    by_id = {k: text for k, _, text in rows}
    for r in got:
        spans = brute_spans(by_id[r.doc_id])
        assert r.spans == shown([s[:3] for s in spans])
        classes, live = [], 0
        for *_, value in spans:
            n_owners, n_places, n_texts = known[value]
            example = min(n_places, n_texts) * 2 ** (n_owners - 1) >= 16
            classes.append(f"{'example' if example else 'live'}:{n_owners}:{n_places}")
            live += not example
        assert r.classes == ",".join(classes)
        assert (r.n_live, r.n_examples) == (live, len(spans) - live)


def test_all_spans_counts_and_classes_of_the_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet")
            .select("doc_id", "source", "text").collect()]
    got = sc.op2_secrets(spark, SF).collect()
    check_whole(rows, got)
    assert sum(r.n_live for r in got) and len(got) == len(rows)


def test_all_spans_counts_and_classes_of_made_documents(spark, tmp_path):
    """Every kind, at random places, in few or many texts of few or many owners."""
    rng = random.Random(6)
    letters = "ABCDEFGHJKabcdefghjk0123456789"

    def word(n):
        return "".join(rng.choice(letters) for _ in range(n))
    makers = [lambda: "ghp_" + word(36), lambda: f"xoxb-{word(12)}-{word(5)}", lambda: "AIza" + word(35),
              lambda: "sk_live_" + word(20), lambda: f"eyJ{word(9)}.{word(12)}.{word(10)}",
              lambda: f"-----BEGIN RSA PRIVATE KEY-----\n{word(60)}\n-----END RSA PRIVATE KEY-----",
              lambda: word(30), lambda: word(26) + "==", lambda: f"password={word(9)}",
              lambda: "AKIA" + "Q7" * 8, lambda: "%032x" % rng.getrandbits(128),
              lambda: f"token: sk_live_{word(18)}", lambda: "a" * 30, lambda: "xghp_" + word(36)]
    pool = [m() for m in makers for _ in range(6)]
    rows = []
    for k in range(400):
        parts = [rng.choice(["é", "some", "text", "=", "\U0001f600"]) for _ in range(rng.randrange(12))]
        for _ in range(rng.randrange(4)):
            parts.insert(rng.randrange(len(parts) + 1), pool[int(rng.random() ** 3 * len(pool))])
        rows.append((k, rng.choice(["hot", "hot", "b", "c", "d", None]), rng.choice([" ", ", "]).join(parts)))
    rows += [(500 + i, "hot", rows[3][2]) for i in range(30)] + [(600, None, None), (601, "e", "")]
    spark.createDataFrame(rows, "doc_id long, source string, text string") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    got = sc.op2_secrets(spark, str(tmp_path)).collect()
    check_whole(rows, got)
    assert {"live", "example"} <= {c.split(":")[0] for r in got for c in r.classes.split(",") if c}
    assert {s.split(":")[0] for r in got for s in r.spans.split(",") if s} == set(sc.KINDS)
