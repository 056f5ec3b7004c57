"""Main text of web pages by consensus host paths.

Each page's containers (elements that hold blocks of text) are scored by the text
that lies in them outside of boilerplate, less what is link text, halved for each
container in between.  The best container is widened to the article around it
(``widen``), and the page votes for its generalised path (tags and classes, numbers
masked).  Votes are summed by host and path in Spark, and every page is extracted
again below the nodes on its host's winning path, widened in the same way; a page
without such a node uses its own best container.

The same pass gathers evidence of boilerplate inside the main text: for each container
within it, its path with the sum of its blocks' hashes and that of the main text around
it.  A path that holds one and the same text in most of a host's pages, with different
texts around it, is boilerplate there and is left out of the second extraction.  Copies
of a page have the same text around it and count as one page, so an article that is
published several times stays.

Votes and evidence are aggregated map-side before their shuffle, and the one winner and
the repeated paths of each host are joined back to the pages, so the number of a host's
pages does not matter.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, slices, store, table, text_or_empty
from .url_filters import url_host

# Attributes as HTML reads them: a quote opens a value only right after "=".
_VALUE = r"\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+)"
TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|"
                   rf"<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:{_VALUE})?+)*+)>",
                   re.S)
ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)"
                       r"(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?+")
PART = re.compile(r"[-_]+")

# Elements by their part in a page (HTML names).
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
CONTAINERS = {"body", "main", "article", "section", "div", "td", "center", "blockquote"}
BLOCKS = CONTAINERS | {
    "address", "aside", "caption", "dd", "details", "dialog", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup",
    "hr", "html", "legend", "li", "menu", "nav", "ol", "p", "pre", "summary", "table", "tbody",
    "tfoot", "th", "thead", "tr", "ul"}
BOILERPLATE = {"head", "nav", "footer", "aside", "button", "select", "option", "menu",
               "dialog", "template", "object", "svg", "canvas", "audio", "video", "math",
               "datalist", "label"} | RAW
FORMS = {"form", "fieldset"}
CLOSED_BY_SAME = {"p", "li", "dt", "dd", "td", "th", "tr", "option"}

# Tokens of a class, id or role that mark boilerplate.
MARKS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner",
    "breadcrumb", "breadcrumbs", "comment", "comments", "complementary", "consent", "contentinfo",
    "cookie", "cookies", "copyright", "disclaimer", "disqus", "footer", "gdpr", "login", "masthead", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pager",
    "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "reply",
    "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored",
    "subscribe", "toolbar", "widget"}
HEADER_MARKS = {"header", "topbar"}
# What may stand beside a mark in a token ("main-menu"), whatever the element.
BESIDE = {"main", "site", "global", "primary", "secondary", "top", "bottom", "container",
          "wrapper", "wrap", "inner", "box", "bar", "block", "area", "section", "link", "links",
          "button", "buttons", "form", "slot", "unit"}
# Beside any other word a mark at either end of a token ("reader-comments",
# "related-posts") counts on these elements only, and not after or before these words
# ("no-sidebar", "category-social", "search-result").
MARKED_PARTS = {"div", "section", "ul", "ol", "dl", "table", "td", "center"}
NOT_AFTER = {"no", "not", "non", "has", "have", "with", "without", "hide", "category", "tag", "type",
             "format", "status", "term", "topic"}
NOT_BEFORE = {"result", "results", "free", "less", "off", "open", "closed", "disabled", "enabled"}
SAME_MIN_PAGES = 2    # different pages that must share a path's text
SEMANTIC = {"article": 1.5, "main": 1.25}


class Node:
    """A container, or a marked element.  ``key`` stands for its path (64 bits, the same
    in every process), so that deep nesting costs no string for every level."""

    __slots__ = ("tag", "label", "parent", "key", "score", "chosen", "titles",
                 "marked")

    def __init__(self, tag: str, label: str, parent: "Node | None", marked: bool = False):
        self.tag, self.label, self.parent = tag, label, parent
        self.key = _key(parent.key if parent else 0, label)
        self.score, self.chosen = 0.0, False
        self.titles = int(tag in SEMANTIC)   # h1 right in it, itself as article or main
        self.marked = marked

    @property
    def path(self) -> str:
        labels, node = [], self
        while node is not None:
            labels.append(node.label)
            node = node.parent
        return ">".join(reversed(labels))


def _key(above: int, label: str) -> int:
    return xxhash.xxh3_64_intdigest(label, above & 0xFFFFFFFFFFFFFFFF) - (1 << 63)


def path_key(path: str) -> int:
    key = 0
    for label in path.split(">"):
        key = _key(key, label)
    return key


def _label(tag: str, attributes: dict[str, str]) -> str:
    classes = attributes.get("class", "").lower().replace(">", "_").split()
    return ".".join([tag, *(re.sub(r"\d+", "#", c) for c in classes)])


def _is_mark(token: str, marks: set[str]) -> bool:
    parts = {p for p in (p.strip("0123456789") for p in PART.split(token)) if p}
    return not marks.isdisjoint(parts) and parts <= marks | BESIDE


def _is_weak_mark(token: str) -> bool:
    """A mark at either end of the token beside other words."""
    parts = [p for p in (p.strip("0123456789") for p in PART.split(token)) if p]
    return len(parts) > 1 and (
        parts[0] in MARKS and NOT_BEFORE.isdisjoint(parts[1:])
        or parts[-1] in MARKS and NOT_AFTER.isdisjoint(parts[:-1]))


def _hidden(tag: str, attributes: dict[str, str], inside_article: bool) -> bool:
    """Never shown, or boilerplate by its tag."""
    return tag in BOILERPLATE or tag == "header" and not inside_article or bool(attributes) and (
        "hidden" in attributes or attributes.get("aria-hidden") == "true"
        or re.search(r"display\s*:\s*none", attributes.get("style", "")) is not None)


def _marked(tag: str, attributes: dict[str, str], inside_article: bool) -> bool:
    """Boilerplate by its marks, or a form: hidden unless it holds the article."""
    if tag in FORMS:
        return True
    if not attributes or tag in ("body", "html") or tag in SEMANTIC:
        return False
    tokens = " ".join(attributes.get(k, "") for k in ("class", "id", "role")).lower().split()
    return any(_is_mark(t, MARKS) or not inside_article and _is_mark(t, HEADER_MARKS)
               or tag in MARKED_PARTS and _is_weak_mark(t) for t in tokens)


def shown(containers: list[Node], blocks):
    """The containers and blocks left when marked elements and forms are hidden.

    Marked elements of one path are judged together.  They are not hidden if they
    hold most of the page's text outside of links, unless that text has no h1 and
    an article or main with text stands elsewhere; nor if they hold an h1, article
    or main and the page has none elsewhere.  If nothing would be left, none is
    hidden.
    """
    if not any(n.marked for n in containers):
        return containers, blocks
    # text outside of links, h1, articles and mains in and below each container
    whole = {id(n): [0, n.titles - (n.tag in SEMANTIC), n.tag in SEMANTIC] for n in containers}
    plain = dict.fromkeys(whole, 0)         # the text under no marked element
    under = {}                              # lies in a marked element
    for n in containers:
        under[id(n)] = n.marked or n.parent is not None and under[id(n.parent)]
    for n, text, of_links in blocks:
        whole[id(n)][0] += len(text) - of_links
        if not under[id(n)]:
            plain[id(n)] += len(text)
    for n in reversed(containers):          # children come before their parents
        if n.parent is not None:
            up = id(n.parent)
            plain[up] += plain[id(n)]
            for i in range(3):
                whole[up][i] += whole[id(n)][i]

    def landmark(n: Node) -> bool:
        return n.tag in SEMANTIC and not under[id(n)] and plain[id(n)] > 0

    above = {}                              # articles and mains around, with plain text
    for n in containers:
        above[id(n)] = (above[id(n.parent)] if n.parent is not None else 0) + landmark(n)
    landmarks = sum(map(landmark, containers))
    headings = sum(n.titles - (n.tag in SEMANTIC) for n in containers if not under[id(n)])
    sums: dict[int, list[int]] = {}
    for n in containers:
        if n.marked:
            held = sums.setdefault(n.key, [0, 0, 0])
            for i in range(3):
                held[i] += whole[id(n)][i]
    total = whole[id(containers[0])][0]
    gone = {}
    for n in containers:
        hides = False
        if n.marked:
            text, titles, articles = sums[n.key]
            elsewhere = landmarks - above[id(n)]
            hides = not (2 * text > total and (titles or not elsewhere)
                         or (titles or articles) and not elsewhere and not headings)
        gone[id(n)] = hides or n.parent is not None and gone[id(n.parent)]
    kept = [b for b in blocks if not gone[id(b[0])]]
    if not kept:
        return containers, blocks
    return [n for n in containers if not gone[id(n)]], kept


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str, int]]]:
    """Containers of a page, and its blocks outside of boilerplate: the container
    they lie in, their text, and the characters of it inside links."""
    root = Node("html", "html", None)
    opened: dict[str, int] = {}
    containers, blocks = [root], []
    # open element: tag, container, hidden, marked
    stack: list[tuple[str, Node, bool, bool]] = []
    # around each marked element that is open: container, text, link text, and the
    # place where the text began
    frames: list[tuple[Node, list[str], list[str], int]] = []
    places: list[int] = []
    start = 0
    now, hidden, links, articles = root, False, 0, 0
    parts: list[str] = []
    linked: list[str] = []

    def put(node: Node, parts: list[str], linked: list[str], place: int) -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                of_links = len(" ".join(html.unescape("".join(linked)).split()))
                blocks.append((node, text, min(of_links, len(text))))
                places.append(place)
            parts.clear()
            linked.clear()

    def flush() -> None:
        for frame in frames:
            put(*frame)
        put(now, parts, linked, start)

    def text(piece: str) -> None:
        nonlocal start
        if piece and not hidden:
            if not parts:
                start = at
            parts.append(piece)
            if links:
                linked.append(piece)

    def leave(depth: int) -> None:
        """Close all open elements from ``depth`` on."""
        nonlocal now, hidden, links, articles, parts, linked, start
        for tag, _, _, framed in reversed(stack[depth:]):
            opened[tag] -= 1
            links -= tag == "a"
            articles -= tag in ("article", "main")
            if framed:
                put(now, parts, linked, start)
                now, parts, linked, start = frames.pop()
        del stack[depth:]
        _, now, hidden, _ = stack[-1] if stack else ("", root, False, False)

    def last_open(tag: str, stop=()) -> int:
        if opened.get(tag):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    return i
                if stack[i][0] in stop:
                    break
        return -1

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            rest = page[at:]
            cut = re.search(r"<[a-zA-Z/!?]", rest)   # a tag cut off at the end of the page
            text(rest[:cut.start()] if cut else rest)
            break
        text(page[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            text(" ")
            continue
        if tag in BLOCKS:
            flush()
        if m[1]:
            i = last_open(tag, () if tag in BLOCKS else CONTAINERS)
            if i >= 0:
                leave(i)
            continue
        if tag in BLOCKS:
            i = last_open("p", CONTAINERS)
            if i >= 0:
                leave(i)
        if tag in CLOSED_BY_SAME:
            i = last_open(tag, CONTAINERS - {tag} | {"ul", "ol", "dl", "table"} - {tag})
            if i >= 0:
                leave(i)
        if tag in VOID:
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if m[3].rstrip().endswith("/") and tag in ("path", "use", "rect"):
            continue
        attributes = {k.lower(): a or b or c or ""
                      for k, a, b, c in ATTRIBUTE.findall(m[3])} if m[3] else {}
        gone = hidden or _hidden(tag, attributes, articles > 0)
        marked = not gone and _marked(tag, attributes, articles > 0)
        if not gone and not marked and tag not in BLOCKS and tag != "a":
            # an inline element needs no place of its own, unless it hides text
            continue
        if (gone or marked) and not hidden and tag not in BLOCKS:
            text(" ")
        if marked:
            frames.append((now, parts, linked, start))
            parts, linked = [], []
        node = now
        if marked or tag in CONTAINERS and not gone:
            node = Node(tag, _label(tag, attributes), now, marked)
            containers.append(node)
        stack.append((tag, node, gone, marked))
        opened[tag] = opened.get(tag, 0) + 1
        links += tag == "a"
        articles += tag in ("article", "main")
        now, hidden = node, gone
        now.titles += tag == "h1" and not gone
    flush()
    if places != sorted(places):    # text around a marked element began before it
        blocks = [blocks[i] for i in sorted(range(len(blocks)), key=places.__getitem__)]
    return shown(containers, blocks)


def best_container(containers: list[Node], blocks) -> Node | None:
    """The container with the highest score, the first of equals."""
    for node, text, of_links in blocks:
        weight = float(len(text) - 2 * of_links)
        while node is not None and abs(weight) >= 0.5:
            node.score += weight
            weight /= 2
            node = node.parent
    best = None
    for node in containers:
        node.score *= SEMANTIC.get(node.tag, 1.0)
        if blocks and (best is None or node.score > best.score):
            best = node
    return best


def widen(containers: list[Node], blocks, picked: list[Node]) -> list[Node]:
    """The picked containers, and those around them that belong to the same text.

    The nearest article or main around a picked container is always taken.  Of the
    containers above, up to the outermost article or main or, on a page without
    them, up to the root, each is taken whose text beyond the one taken before is
    not mostly link text.  The root and the body hold the whole page, so they are taken only where
    such text stands right in them, or an h1, article or main is left outside.
    """
    own = {id(n): [0, 0, n.titles] for n in containers}        # text, link text, titles
    for node, text, of_links in blocks:
        own[id(node)][0] += len(text)
        own[id(node)][1] += of_links
    whole = {k: list(v) for k, v in own.items()}
    held = {k: [0, 0, 0] for k in own}      # of taken containers
    inside = {}                             # an article or main, or in one
    for node in containers:
        inside[id(node)] = node.tag in SEMANTIC or node.parent is not None \
            and inside[id(node.parent)]
    picks = {id(n) for n in picked}
    # a picked container below: in no article yet (loose), at all (near)
    loose, near, out = set(), set(), []
    for node in reversed(containers):       # children come before their parents
        k = id(node)
        semantic = node.tag in SEMANTIC
        if k in picks or semantic and k in loose:
            out.append(node)
            held[k] = list(whole[k])
            near.add(k)
            loose.discard(k)
            if not semantic:
                loose.add(k)
        elif k in near and (k in loose or inside[k]):
            more, links, titles = (a - b for a, b in zip(whole[k], held[k]))
            taken = more > 0 and 2 * links <= more
            if taken and node.tag in ("html", "body"):
                taken = titles > 0 or own[k][0] > 0 and 2 * own[k][1] <= own[k][0]
            if taken:
                out.append(node)
                held[k] = list(whole[k])
        if node.parent is not None:
            up = id(node.parent)
            for total in (whole, held):
                for i in range(3):
                    total[up][i] += total[k][i]
            if k in near:
                near.add(up)
            if k in loose:
                loose.add(up)
    return out


def main_container(containers: list[Node], blocks) -> Node | None:
    """The best container of a page, widened."""
    best = best_container(containers, blocks)
    if best is None:
        return None
    around = {id(n) for n in widen(containers, blocks, [best])}
    node, top = best, best
    while node is not None:
        if id(node) in around:
            top = node
        node = node.parent
    top.score = best.score
    return top


def repeated_text(containers: list[Node], blocks, main: Node) -> list[tuple[int, int, int]]:
    """Evidence of a page: for each container inside the main one, its key, the sum of its
    blocks' hashes, and that of the main text around it (as signed 64-bit numbers)."""
    inside, sums = {id(main)}, {id(n): 0 for n in containers}
    for node, text, _ in blocks:
        sums[id(node)] += xxhash.xxh3_64_intdigest(text)
    for node in reversed(containers):
        if node is not main and node.parent is not None:
            sums[id(node.parent)] += sums[id(node)]
    out, whole = [], sums[id(main)]
    for node in containers:
        if node.parent is not None and id(node.parent) in inside:
            inside.add(id(node))
            own, rest = (x & 0xFFFFFFFFFFFFFFFF for x in (sums[id(node)], whole - sums[id(node)]))
            if own and rest:
                out.append((node.key, own - (1 << 63), rest - (1 << 63)))
    return out


def extract(page: str, path: str | None, repeated: list[int] | None = None) -> str:
    """Blocks below the nodes on ``path``, else below the page's best container, but for
    those below containers with a ``repeated`` key."""
    containers, blocks = parse(page)
    if not blocks:
        return ""
    key = path_key(path) if path else None
    gone = set(repeated or ())

    def below(picked: list[Node]) -> list[str]:
        chosen = {id(n) for n in widen(containers, blocks, picked)} if picked else ()
        for node in containers:  # parents come before their children
            node.chosen = (id(node) in chosen or node.parent is not None and node.parent.chosen) \
                and (node.key not in gone or id(node) in chosen)
        return [text for node, text, _ in blocks if node.chosen]

    held = below([n for n in containers if n.key == key]) if path else []
    if not held:
        held = below([best_container(containers, blocks)])
    return "\n\n".join(held)


def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) -> (host, path, score) of each page that has text, and the evidence
    (host, key, own, rest) of the containers inside its main text."""
    for batch in slices(batches, "html"):
        out = []
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            containers, blocks = parse(page)
            best = main_container(containers, blocks)
            if best is not None:
                out.append((host, best.path, best.score, None, None, None))
                out += [(host, None, None, *found)
                        for found in repeated_text(containers, blocks, best)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], t) for i, t in enumerate(
                (pa.string(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()))],
            names=["host", "path", "score", "key", "own", "rest"])


def extractor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        texts = [extract(*row) for row in zip(*[batch.column(c).to_pylist()
                                                for c in ("html", "path", "repeated")])]
        rest = batch.drop_columns(["html", "path", "repeated"])
        yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(texts, pa.string())],
                                         names=[*rest.schema.names, "text"])


def host_evidence(pages: DataFrame) -> DataFrame:
    """Votes (path, score) and evidence (key, own, rest) of all pages, stored."""
    return store(map_arrow(pages.select("host", "html"), vote,
                           "host string, path string, score double, key long, own long, rest long"),
                 "host-evidence")


def winning_paths(evidence: DataFrame) -> DataFrame:
    """The path with most votes of each host (host, path, votes); of equal votes,
    the higher score, then the first by name."""
    by_path = evidence.where("path IS NOT NULL").groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("votes"), F.sum(F.round("score").cast("long")).alias("score"))
    order = F.struct(-F.col("votes"), -F.col("score"), "path")
    return by_path.groupBy("host").agg(F.min_by("path", order).alias("path"),
                                       F.max("votes").alias("votes"))


def repeated_paths(evidence: DataFrame) -> DataFrame:
    """Keys of the paths that are boilerplate on their host (host, repeated): one text of
    the path occurs in ``SAME_MIN_PAGES`` or more different pages, which are half or
    more of the different pages with the path.  A host's list is as long as it has
    such paths, not pages."""
    same = evidence.where("key IS NOT NULL").select("host", "key", "own", "rest").distinct() \
        .groupBy("host", "key", "own").agg(F.count(F.lit(1)).alias("n"))
    return same.groupBy("host", "key").agg(F.max("n").alias("most"), F.sum("n").alias("pages")) \
        .where((F.col("most") >= SAME_MIN_PAGES) & (2 * F.col("most") >= F.col("pages"))) \
        .groupBy("host").agg(F.collect_set("key").alias("repeated"))


def extract_main_text(df: DataFrame, keys: list[str], url: str = "url",
                      page: str = "html") -> DataFrame:
    """Main text of every page by its host's winning path.

    Returns ``keys``, ``text`` (blocks in page order, joined by an empty line; empty
    if none) and ``n_chars``; other columns are left out, so none can clash
    (``keys`` must not name ``text``).  Null and
    empty pages have an empty text.  Pages whose URL is null or has no host vote
    together.  Nothing is dropped or cut off inside the main text.  Repeated rows
    vote and come out repeatedly; an empty table gives no rows.
    """
    pages = df.select(*[F.col(k).alias(f"key{i}") for i, k in enumerate(keys)],
                      url_host(url).alias("host"), text_or_empty(page).alias("html"))
    evidence = host_evidence(pages)
    winners = store(winning_paths(evidence).select("host", "path")
                    .join(repeated_paths(evidence), "host", "left"), "host-paths")
    joined = pages.join(winners, "host", "left").drop("host")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.schema.fields
                      if f.name not in ("html", "path", "repeated"))
    out = map_arrow(joined, extractor, f"{kinds}, text string")
    return out.select(*[F.col(f"key{i}").alias(k) for i, k in enumerate(keys)], "text",
                      F.length("text").cast("long").alias("n_chars"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"),
                             ["page_id", "url"])
