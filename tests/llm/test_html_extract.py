from __future__ import annotations

import html
import random
import re

import pytest

from skyledger.llm import html_extract as hx

SF = "/root/testdata/sf0.01"


def plain(page):
    """The given pages' only layout: blocks of the article element."""
    m = re.search(r"<article>(.*?)(</article>|$)", page, re.S)
    pieces = re.split(r"</?(?:p|h1)>", m[1])
    pieces = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x))).split())
              for x in pieces]
    return "\n\n".join(x for x in pieces if x)


def test_query_matches_the_known_layout(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = hx.op6_html_text(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.url == pages[r.page_id].url and r.n_chars == len(r.text)
        assert r.text == plain(pages[r.page_id].html)


PAGE = """<!doctype html><html><head><title>T &amp; t</title><style>p{}</style></head><body>
<header class="site"><h1>Site</h1></header><ul class="main-menu"><li><a href="/">Home</a></ul>
<div class="cookie-notice">We use cookies <p>and more</div><form><p>Name <input></form>
<div id="wrap"><div class="post post-17" data-x="a > b"><h1>Head&shy;line &lt;1&gt;</h1>
<p>First   <b>bold</b><br>line&nbsp;two <a href="x">link</a>.<p>Second <!-- <p>gone</p> -->
<script>var a = "</div><p>no</p>";</script>paragraph<span class="ad">buy</span>s.
<ul><li>one<li>two</ul><div class="advert">Buy now</div><table><tr><td>cell<td>other</table>
</div><section id="comments"><p>Nice post, thank you so much for it, a very long comment indeed</p>
</section></div><aside><p>aside</p></aside><div class="sidebar"><p>side</p></div>
<footer>foot</footer></body></html>"""
WANT = "\n\n".join(["Head\xadline <1>", "First bold line two link.", "Second paragraph s.", "one",
                    "two", "cell", "other"])


def test_a_page_with_everything_around_the_article():
    assert hx.extract(PAGE, None) == WANT
    cut = PAGE[:PAGE.index("<ul><li>one")]
    assert hx.extract(cut + "<p>end <b", None) == "\n\n".join(WANT.split("\n\n")[:3] + ["end"])


def test_consensus_outvotes_an_odd_page(spark):
    """A short article beside a long list of teasers: the host's path decides."""
    def page(article, teasers):
        return (f"<body><div class='story'><p>{article}</p></div>"
                f"<div class='teasers'><p>{teasers}</p></div></body>")
    rows = [(i, "http://h/%d" % i, page("long text " * 40, "short")) for i in range(6)]
    rows.append((9, "http://h/9", page("brief", "teaser words " * 30)))
    rows.append((10, "http://other/", page("brief", "teaser words " * 30)))
    df = spark.createDataFrame(rows, "k long, url string, html string")
    got = {r.k: r.text for r in hx.extract_main_text(df, ["k"]).collect()}
    assert got[9] == "brief" and got[10].startswith("teaser") and got[0].startswith("long")


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "http://a/", ""), (3, "nohost", "no markup at all"),
            (4, "http://a/", "<p>" + "word " * 200000), (5, "http://a/", "<script>x"),
            (6, "http://a/", "<nav>menu</nav>"), (7, "http://a/", "a < b &amp; c <"),
            (8, "http://a/", "</div></p>x<div><article><p>y"), (8, "http://a/", "<!-- open <p>x"),
            (None, None, "<p>null key</p>"), (9, "http://b/", "<div>" * 50000 + "deep" + "</x>" * 50000)]
    df = spark.createDataFrame([(*r, "text", "host", 1) for r in rows],
                               "k long, url string, html string, text string, host string, path int")
    got = sorted((r.k or 0, r.text[:20], r.n_chars) for r in
                 hx.extract_main_text(df, ["k"]).collect())
    assert got == [(0, "null key", 8), (1, "", 0), (2, "", 0), (3, "no markup at all", 16),
                   (4, "word word word word ", 999999), (5, "", 0), (6, "", 0),
                   (7, "a < b & c <", 11), (8, "", 0), (8, "x\n\ny", 4), (9, "deep", 4)]
    assert hx.extract_main_text(df.limit(0), ["k"]).count() == 0


LONG, LEAD = "long text " * 300, "lead text " * 36


def test_title_lead_and_closing_around_a_long_inner_container(spark):
    """An inner container that outscores its article brings the article along."""
    want = "\n\n".join(["Title", LEAD.strip(), LONG.strip(), "Closing"])
    inner = f"<h1>Title</h1><p>{LEAD}</p><{{0}}>{LONG}</{{1}}><p>Closing</p>"
    aside = "<div class=more>" + "<a href=x>teaser of another page</a> " * 9 + "</div>"
    for part in (("div class=body", "div"), ("blockquote", "blockquote")):
        text = inner.format(*part)
        for page in (f"<body><article>{text}</article>{aside}", f"<body>{text}</body>",
                     f"<main><h1>Title</h1><article>{text[14:]}</article>{aside}</main>"
                     .replace(aside, ""),
                     f"<body><div id=page><div class=post>{text}</div>{aside}</div>",
                     f"<body><div class=head><h1>Title</h1></div>{text[14:]}"):
            assert hx.extract(page, None) == want, page[:80]
    rows = [(i, f"http://h/{i}", f"<body><article>{inner.format('div class=body', 'div')}"
             f"</article>{aside}") for i in range(4)]
    df = spark.createDataFrame(rows, "k long, url string, html string")
    assert [r.text for r in hx.extract_main_text(df, ["k"]).collect()] == [want] * 4


def test_odd_quotes_inside_tags():
    """A quote that no "=" stands before is a character like any other."""
    def text(page):
        return hx.extract(page, None).split("\n\n")
    three = ["FIRST", "SECOND it's", "THIRD"]
    for attributes in ("title=it's", "it's", 'x"', "a='1'b'", 'a="1"b"', "title=a'b class=c",
                       '"', "'/", "title = it's", '="', 'a=b="'):
        assert text(f"<p {attributes}>FIRST</p><p>SECOND it's</p><p>THIRD</p>") == three, attributes
    assert text("<p title='a > b' data-x = \"c > 'd\">FIRST</p><p>SECOND it's<p>THIRD") == three
    assert text("<p>FIRST<p>SECOND it's<p hidden title=it's>gone<p>THIRD") == three
    assert text("<p>FIRST</p><a href=x/>SECOND it's</a><p>THIRD</p>" + "<b x='" * 300) == three


def test_marked_wrappers_and_forms_around_the_article():
    want = "Title\n\n" + LEAD.strip()
    inner = f"<h1>Title</h1><p>{LEAD}</p>"
    for wrapper in ("div class='no-sidebar'", "div class=has-sidebar", "div id=search-result",
                    "div class='content-with-comments'", "div class='widget'", "form",
                    "form action=/ class=search", "fieldset", "div role=search class='main-menu'",
                    "article class='post category-social tag-search'", "main class=widget",
                    "app-root class=widget", "div class=header", "div class='x sidebar'"):
        for body in (inner, f"<div class=a>{inner}</div>", f"<article>{inner}</article>"):
            page = f"<body><nav>menu</nav><{wrapper}>{body}</{wrapper.split()[0]}><p>&copy; we</p>"
            assert hx.extract(page, None).replace("\n\n\xa9 we", "") == want, (wrapper, body[:20])
    spread = "<body>" + "".join(f"<div class=widget><p>part {i}</p></div>" for i in range(5))
    assert hx.extract(spread, None) == "\n\n".join(f"part {i}" for i in range(5))


def test_marked_parts_beside_the_article_stay_hidden():
    inner = f"<h1>Title</h1><p>foo <span class=promo>buy</span> {LEAD}</p>"
    want = "Title\n\nfoo " + LEAD.strip()
    for part in (f"<section id=comments><article class=x>{LEAD * 3}</article></section>",
                 "<div class='cookie-notice'>We use cookies</div>", "<ul class=main-menu><li>Home</ul>",
                 "<form><p>Name <input></p>Send</form>", "<div class='site-footer'>about</div>",
                 f"<div class=related><article>{LEAD}</article></div>",
                 f"<div class=sidebar hidden>{LEAD * 9}</div>"):
        assert hx.extract(f"<body><article>{inner}</article>{part}", None) == want
        assert hx.extract(f"<body><main><article>{inner}</article>{part}</main>", None) == want


BOILER = ["reader-comments", "comment-list", "user-comments", "related-posts", "left-sidebar",
          "page-footer", "post-navigation", "cookie-message", "copyright", "sidebar"]


def test_boilerplate_blocks_inside_three_wrappers():
    """Marked blocks in the article, beside it in its wrapper, and at the end of the body."""
    sentences = "".join(f"<p>This is sentence {i} of the article itself.</p>" for i in range(30))
    want = "\n\n".join(["Title"] + [f"This is sentence {i} of the article itself." for i in range(30)])
    for name in BOILER:
        block = f"<div class='{name}'><p>Great read</p><p>I do not agree with this at all</p></div>"
        for page in (f"<body><div id=content><h1>Title</h1>{sentences}{block}</div>",
                     f"<body><article><h1>Title</h1>{sentences}{block}</article>",
                     f"<body><div class=post><h1>Title</h1>{sentences}</div>{block}",
                     f"<body><article><h1>Title</h1>{sentences[:400]}{block}{sentences[400:]}</article>"
                     .replace(sentences[:400], sentences[:sentences.index('<p>', 400)])
                     .replace(sentences[400:], sentences[sentences.index('<p>', 400):])):
            assert hx.extract(page, None) == want, (name, page[:30])


def spark_texts(spark, rows):
    df = spark.createDataFrame(rows, "k long, url string, html string")
    return {r.k: r.text for r in hx.extract_main_text(df, ["k"]).collect()}


def test_text_that_repeats_over_a_host_is_boilerplate_there(spark):
    """Blocks without any mark, told by the host's pages; copies of a page don't count."""
    def page(i, note):
        return (f"<body><article><h1>Story {i}</h1><div class=lead>Lead of {i}</div>" + "".join(
            f"<p>Sentence {j} of story {i}.</p>" for j in range(9))
            + f"<div class=box><p>{note}</p></div></article>")
    note = "This site is run by volunteers. Write to us."
    rows = [(i, f"http://a/{i}", page(i, note)) for i in range(5)]
    rows += [(10 + i, "http://b/x", page(0, note)) for i in range(5)]          # one page, copied
    rows += [(20 + i, f"http://c/{i}", page(i, f"Note {i}")) for i in range(5)]  # never the same
    rows += [(30 + i, f"http://d/{i}", page(i, note if i < 2 else f"Note {i}")) for i in range(9)]
    got = spark_texts(spark, rows)
    for k, text in got.items():
        assert text.startswith(f"Story {k % 10 if not 10 <= k < 20 else 0}\n\nLead of")
        has = text.split("\n\n")[-1]
        assert ("Sentence 8" in has) == (k < 5), (k, has)
    assert got[12].endswith(note) and got[22].endswith("Note 2") and got[30].endswith(note)


def brute_score(containers, blocks, node):
    """Score of a container by its definition: blocks halved for each container between."""
    total = 0.0
    for at, text, of_links in blocks:
        weight, up = float(len(text) - 2 * of_links), at
        while up is not None and up is not node and abs(weight) >= 0.5:
            weight, up = weight / 2, up.parent
        if up is node and abs(weight) >= 0.5:
            total += weight
    return total * hx.SEMANTIC.get(node.tag, 1.0)


def test_scores_votes_and_second_extraction_equal_plain_python(spark):
    rnd = random.Random(4)
    shapes = ["<div class=story-{n}>{a}<div class=inner>{b}</div></div><div class=teasers>{c}</div>",
              "<section><article>{a}{b}</article><div>{c}</div></section>",
              "<div class=col><div class=x{n}>{c}</div></div><div class=main2>{a}<blockquote>{b}</blockquote></div>"]

    def words(n):
        return "".join(f"<p>{' '.join(rnd.choice(['tan', 'orel', 'vi']) for _ in range(rnd.randint(1, n)))}"
                       f"{rnd.choice(['', ' <a href=x>more of it</a>'])}</p>" for _ in range(3))
    rows = []
    for k in range(90):
        shape = rnd.choice(shapes[:2] if k % 3 else shapes)
        rows.append((k, f"http://h{k % 7}/{k}",
                     "<body>" + shape.format(n=k, a=words(40), b=words(25), c=words(20))))
    got = spark_texts(spark, rows)
    votes, total, evidence = {}, {}, {}
    for k, url, page in rows:
        containers, blocks = hx.parse(page)
        scores = [brute_score(containers, blocks, n) for n in containers]
        best = containers[max(range(len(scores)), key=lambda i: (scores[i], -i))]
        assert hx.best_container(containers, blocks) is best
        assert best.score == pytest.approx(max(scores))
        main = hx.main_container(*hx.parse(page))
        host = url[7:9]
        votes[host, main.path] = votes.get((host, main.path), 0) + 1
        total[host, main.path] = total.get((host, main.path), 0) + round(main.score)
        main = next(n for n in containers if n.path == main.path)

        def under(n, top):
            while n is not None:
                if n is top:
                    return True
                n = n.parent
            return False
        for n in containers:
            if n is not main and under(n, main):
                own = tuple(t for b, t, _ in blocks if under(b, n))
                rest = tuple(t for b, t, _ in blocks if under(b, main) and not under(b, n))
                if own and rest:
                    evidence.setdefault((host, n.path), set()).add((own, rest))
    for k, url, page in rows:
        host = url[7:9]
        path = min(((-votes[h, p], -total[h, p], p) for h, p in votes if h == host))[2]
        gone = []
        for (h, p), seen in evidence.items():
            most = max(sum(o == own for o, _ in seen) for own, _ in seen)
            if h == host and most >= 2 and 2 * most >= len(seen):
                gone.append(hx.path_key(p))
        assert got[k] == hx.extract(page, path, gone), k
    assert len({p for _, p in votes}) >= 3
