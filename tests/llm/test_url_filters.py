from __future__ import annotations

import random
import re

from compare import compare, duck_connect

from skyledger.llm import url_filters as uf

SF = "/root/testdata/sf0.01"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute(url, rules, default="allow"):
    host, path = parts(url)
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, default
    top = max(f[:2] for f in fits)
    return host, path, *min((f[2], f[3]) for f in fits if f[:2] == top)


def check(spark, urls, rules):
    df = spark.createDataFrame([(i, u, "r", True) for i, u in enumerate(urls)],
                               "page_id long, url string, rule string, is_rule boolean")
    made = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {r.page_id: tuple(r)[1:] for r in uf.judge(df, made, ["page_id"]).collect()}
    rules = [r for r in rules if None not in r]
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_query_matches_sql(spark):
    report = compare(uf.op5_url_filters(spark, SF), duck_connect(SF), uf.ORACLE)
    assert report["ok"], report


ODD = [None, "", "no scheme", "http://", "http:///path", "HTTP://WWW.Example.ORG/es/x?y#z",
       "https://example.org", "https://example.org?/es/", "https://example.org/en/1", "a://org/",
       "https://xexample.org/es/", "https://example.org./es/", "https://.org/x", "b://c://org/",
       "https://user@example.org:80/es/", "https://É.example.org/es/é\n?q", "x://a.b..org/",
       "https://" + "s." * 5000 + "example.org/es/" + "p" * 50000]


def test_odd_urls_and_made_rules(spark):
    check(spark, ODD, uf.RULES)
    rnd = random.Random(4)
    hosts = ["a", "b.a", "c.b.a", "d.c.b.a", "ab", "b-a.a", "e.a", "a.a", ""]
    paths = ["", "/", "/x", "/x/", "/x/y", "/xy", "/é"]
    rules = [(rnd.choice(hosts), rnd.choice(paths), rnd.choice(["allow", "block"]))
             for _ in range(30)] + [(None, "/", "block"), ("a", None, "block"), ("a", "/", None)]
    urls = [f"http://{rnd.choice(hosts)}{rnd.choice(paths)}{rnd.choice(['', '/z', '?q', '#f'])}"
            for _ in range(400)] + ["http://c.b.a/x"] * 600
    check(spark, urls, rules)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame(uf.RULES, "host string, path string, verdict string")
    assert uf.judge(none, rules, ["page_id"]).count() == 0
    one = spark.createDataFrame([(1, "http://x.org/")], "page_id long, url string")
    assert tuple(uf.judge(one, rules.limit(0), ["page_id"]).first()) == \
        (1, "x.org", "/", None, "allow")
