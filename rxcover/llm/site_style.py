"""Main-text extraction with a site style tree.

The DOMs of a host's pages are merged into one tree of element nodes (an
element's path of tags and classes) and style nodes (the sequence of its
children, repeats merged). Over all pages of the host,

* the presentation importance of an element is the entropy of its styles,
* the content importance of a text feature seen on n of m pages is
  ``1 - log n / log m``, averaged over the features below an element,
* both are weighted by ``gamma ** styles``: an element that looks alike on
  every page is judged by its content.

Branches seen on two pages or more and far less important than their host's
body (smoothed towards it by one page) are removed from every page, as are branches that the markup itself names as no article text (menus,
page headers and footers, side bars, notices, adverts, forms, comments,
hidden parts). On a page with an ``article`` or ``main`` element, the text is
looked for inside. Statistics are map-side aggregated counts; no page and no
host is gathered in one place. A host of one page, or whose pages are all
alike, has no contrast and nothing is removed by importance.

Defined results: a null html is empty; broken, cut and unclosed markup is
read as far as it goes (an unfinished tag at the end is dropped); a page
whose every branch would be removed keeps the text outside named noise, or all
its text if there is none; a class or id that names noise is evidence only
(``judge_names``); a null
or unreadable url has the empty host; repeated rows give repeated rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxcover.llm.common import stored

GAMMA = 0.9
#: A branch is noise below this share of its host body's importance.
CONTRAST = 0.5
#: A host's pages are dealt over so many tasks.
SALTS = 64
#: An element's importance counts with so many pages of its host's body added:
#: the fewer pages show it, the clearer its own must be.
SMOOTH = 1

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dir div dl fieldset figcaption figure footer form "
                     "h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split())
#: An opening tag ends an open one of the same kind, up to the container.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "option": ({"option"}, {"select"})}
NOISE_TAGS = frozenset("head nav footer aside form script style noscript template button select textarea input svg canvas "
                       "iframe object video audio map dialog menu title noembed noframes".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar "
                        "toolbar form".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar menu nav "
    "navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice alert popup modal "
    "overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments "
    "disqus replies respond widget toolbar pagination pager skip".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEVER_BY_NAME = HEADINGS | frozenset("html body article main".split())
#: Elements that hold running text; removed for low importance only where a
#: class or id sets them apart from the article's others.
KEPT_TAGS = frozenset("html body article main".split())
TEXT_TAGS = NEVER_BY_NAME | frozenset("p pre blockquote b i em strong".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z]+")


#: How a class or id names an element: not, as one word among others, at the
#: start of every name, or by noise words alone.
UNNAMED, PARTLY, LEADING, WHOLLY = range(4)


class Node:
    """``own`` and ``noise`` say whether the element itself, or also one above
    it, is marked as no article text; ``word`` how its class and id name it."""
    __slots__ = ("tag", "key", "up", "own", "noise", "word", "main", "kids", "_path")

    def __init__(self, tag: str, key: str, up: Node | None, own: bool, word: int, main: bool):
        self.tag, self.key, self.up, self.own, self.word, self.main, self.kids, self._path = tag, key, up, own, word, main, [], None
        self.noise = own or up is not None and up.noise

    @property
    def path(self) -> str:
        if self._path is None:
            self._path = self.key if self.up is None else f"{self.up.path}/{self.key}"
        return self._path


def _named(tag: str, attrs: str, up: Node) -> tuple[str, bool, int]:
    """The element's key in the style tree, whether its tag, role or being
    hidden marks it as something else than article text, and how far the words
    of its class and id name it so."""
    noise = tag in NOISE_TAGS or tag == "header" and not up.main
    if not attrs or attrs.isspace() or attrs == "/":
        return tag, noise, UNNAMED
    found = {}
    for m in _ATTR.finditer(attrs):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    names = f"{found.get('class', '')} {found.get('id', '')}".lower()
    words = _WORD.findall(names)
    word = UNNAMED
    if tag not in NEVER_BY_NAME or tag == "article":
        bad = NOISE_WORDS | {"header"} if not up.main and tag != "article" else NOISE_WORDS
        if not bad.isdisjoint(words):
            lists = [w for w in map(_WORD.findall, names.split()) if w]
            word = WHOLLY if bad.issuperset(words) else LEADING if all(w[0] in bad for w in lists) else PARTLY
    style = found.get("style", "").replace(" ", "").lower()
    noise = (noise or found.get("role", "").lower() in NOISE_ROLES or "hidden" in found and tag not in ("html", "body")
             or found.get("aria-hidden", "").lower() == "true" or "display:none" in style)
    return (f"{tag}.{'.'.join(sorted(set(words)))}" if words else tag), noise, word


def parse(html: str) -> list[tuple[Node, str | None]]:
    """Runs of text in page order as (element, text); (element, None) is a
    block boundary. Every element is reachable from the nodes."""
    root = Node("", "", None, False, UNNAMED, False)
    root.key = "#"
    node, out, at, n = root, [], 0, len(html)
    search = _TOKEN.search
    while at < n:
        m = search(html, at)
        if m is None:
            tail = html[at:]
            cut = re.search(r"<[/!?a-zA-Z]", tail)
            out.append((node, tail[:cut.start()] if cut else tail))
            break
        if m.start() > at:
            out.append((node, html[at:m.start()]))
        at = m.end()
        name = m[2]
        if name is None:
            continue
        tag = name.lower()
        if m[1]:
            end = node
            while end is not root and end.tag != tag:
                end = end.up
            if end is not root and (tag not in INLINE or not _block_between(node, end)):
                node = end.up
                if tag not in INLINE:
                    out.append((node, None))
            continue
        if tag not in INLINE:
            node = _implied(node, root, tag)
            out.append((node, None))
        key, noise, word = _named(tag, m[3], node)
        new = Node(tag, key, node, noise, word, node.main or (tag in ("article", "main") and not noise))
        node.kids.append(new)
        if tag in VOID or m[3].endswith("/") and tag in ("svg", "path", "use"):
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
            at = close.end() if close else n
            continue
        node = new
    return out


def _block_between(node: Node, end: Node) -> bool:
    while node is not end:
        if node.tag not in INLINE:
            return True
        node = node.up
    return False


def _implied(node: Node, root: Node, tag: str) -> Node:
    """The element that a block's opening tag goes to, after the end tags
    that it implies."""
    if tag in CLOSES_P:
        x = node
        while x is not root and (x.tag in INLINE or x.tag == "p"):
            if x.tag == "p":
                node = x.up
                break
            x = x.up
    if tag in SIBLINGS:
        ends, stop = SIBLINGS[tag]
        x, to = node, None
        while x is not root and x.tag not in stop:
            if x.tag in ends:
                to = x.up
            x = x.up
        node = to or node
    return node


def judge_names(runs: list[tuple[Node, str | None]]) -> None:
    """Settles ``noise`` and ``main`` where classes or ids name elements. A
    name is evidence only. Of branches that no named one encloses, one is kept
    if it holds most of the page's text, or if it holds the article, main or
    h1 and nothing outside named branches does; but not where noise words are
    its whole name and other text than headings stands outside, or where they
    begin its name and the article stands outside or it holds less than most. What a kept branch encloses is
    judged anew."""
    if not runs:
        return
    root = runs[0][0]
    while root.up is not None:
        root = root.up
    nodes = [root]
    for x in nodes:  # parents before children
        nodes.extend(x.kids)
    if not any(x.word for x in nodes):
        return
    size = dict.fromkeys(nodes, 0)
    for x, t in runs:
        if t is not None and not x.noise:
            size[x] += len("".join(t.split()))
    beside: dict[Node, int] = {}  # an element's own text, 0 at and below headings
    head: dict[Node, bool] = {}
    for x in nodes:
        head[x] = x.tag in HEADINGS or x.up is not None and head[x.up]
        beside[x] = 0 if head[x] else size[x]
    # what an unnamed article or main (2) or h1 (1) at or below an element gives
    holds = {x: 0 if x.noise or x.word else 2 if x.tag in ("article", "main") else int(x.tag == "h1") for x in nodes}
    for x in reversed(nodes[1:]):
        size[x.up] += size[x]
        holds[x.up] = max(holds[x.up], holds[x])
    kept: set[Node] = set()
    while True:
        inside: dict[Node, bool] = {}
        outer, free, plain = [], 0, 0
        for x in nodes:
            named = x.word and x not in kept
            below = x.up is not None and inside[x.up]
            inside[x] = bool(named or below)
            if named and not below and not x.noise:
                outer.append(x)
            if not inside[x] and not x.noise:
                free = max(free, 2 if x.tag in ("article", "main") else int(x.tag == "h1"))
                plain += beside[x]
        more = []
        for x in outer:
            most = 2 * size[x] > size[root]
            others = plain and (x.word == WHOLLY or x.word == LEADING and free == 2 and not x.main)
            if most and not others or holds[x] > free and (most or x.word == PARTLY or not plain):
                more.append(x)
        if not more:
            break
        kept.update(more)
    for x in nodes[1:]:
        own = x.own or x.word > 0 and x not in kept
        x.noise = own or x.up.noise
        x.main = x.up.main or x.tag in ("article", "main") and not own


def _text(value: str) -> str:
    return unescape(value) if "&" in value else value


def extract(html: str | None, low: frozenset[str] = frozenset()) -> str:
    """The main text of one page; ``low`` holds paths of low importance."""
    if not html:
        return ""
    runs = parse(html)
    judge_names(runs)
    verdict: dict[int, bool] = {}

    def removed(node: Node) -> bool:
        chain = []
        while node is not None and id(node) not in verdict:
            chain.append(node)
            node = node.up
        bad = verdict[id(node)] if node is not None else False
        for x in reversed(chain):
            bad = bad or (x.tag not in (TEXT_TAGS if x.key == x.tag else KEPT_TAGS) and x.path in low)
            verdict[id(x)] = bad
        return bad

    named = [(x, t) for x, t in runs if t is None or not x.noise]
    inside = [(x, t) for x, t in named if t is None or x.main]
    best = inside if any(t and not t.isspace() for _, t in inside) else named
    text = _joined((x, t) for x, t in best if t is None or not low or not removed(x))
    return text or _joined(best) or _joined(runs)


def _joined(runs) -> str:
    return " ".join("".join(" " if t is None else _text(t) for _, t in runs).split())


def observe(html: str) -> set[tuple[str, str, str]]:
    """What one page adds to its host's style tree: (path, kind, item) with
    kind ``page`` (the element occurs), ``style`` and ``text``."""
    out: set[tuple[str, str, str]] = set()
    runs = parse(html)
    seen: set[int] = set()
    texts: dict[int, tuple[Node, list[str]]] = {}
    for x, t in runs:
        if t is not None and not t.isspace():
            while x.up is not None and x.tag in INLINE:
                x = x.up
            texts.setdefault(id(x), (x, []))[1].append(t)
        while x is not None and id(x) not in seen:
            seen.add(id(x))
            if x.tag not in INLINE:
                out.add((x.path, "page", ""))
                keys = []
                for k in x.kids:
                    if k.key not in keys[-1:]:
                        keys.append(k.key)
                out.add((x.path, "style", ">".join(keys)))
            x = x.up
    for x, parts in texts.values():
        for part in parts:
            out.add((x.path, "text", " ".join(part.split())))
    return out


# --------------------------------------------------------------------------
# Spark jobs

def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


PAGE, STYLE, TEXT = 0, 1, 2
_KIND = {"page": PAGE, "style": STYLE, "text": TEXT}


def _hash(*parts: str) -> int:
    joined = "\0".join(parts).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(joined, digest_size=8).digest(), "little", signed=True)


def importance(pages: DataFrame) -> DataFrame:
    """``host, path, pages, importance, share`` of every element node;
    ``share`` is its content importance relative to the host's root. Nodes and items
    are counted by hash; a node's names come once with its page counts."""
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows, keys = [], {}
            for host, html in zip(pdf["host"], pdf["html"]):
                for path, kind, item in observe(html) if html else ():
                    node = (host, path)
                    key = keys.get(node)
                    if key is None:
                        key = keys[node] = _hash(host, path)
                    own = kind == "page"
                    rows.append((key, _KIND[kind], 0 if own else _hash(item), host if own else "", path if own else ""))
            yield pd.DataFrame(rows, columns=["node", "kind", "item", "host", "path"])

    seen = pages.select(host_of(F.col("url")).alias("host"), "html").mapInPandas(
        emit, "node long, kind tinyint, item long, host string, path string")
    counts = seen.groupBy("node", "kind", "item", "host", "path").agg(F.count(F.lit(1)).alias("n"))
    # per element: pages, sum of n log n over styles, and of log n over texts
    n = F.col("n").cast("double")
    kind = lambda k, v: F.sum(F.when(F.col("kind") == k, v))
    named = lambda c: F.first(F.when(F.col("kind") == PAGE, F.col(c)), True).alias(c)
    nodes = counts.groupBy("node").agg(
        named("host"), named("path"), kind(PAGE, n).alias("pages"), kind(STYLE, n).alias("uses"),
        kind(STYLE, F.lit(1)).alias("styles"), kind(STYLE, n * F.log(n)).alias("use_logs"),
        kind(TEXT, F.log(n)).alias("text_logs"), kind(TEXT, F.lit(1)).alias("texts"))
    nodes = stored(nodes.drop("node"), "style-nodes")
    parts = F.split("path", "/")
    # a text feature also counts for every element above it
    above = nodes.where("texts > 0").select("host", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))).alias("path"),
        "text_logs", "texts").groupBy("host", "path").agg(F.sum("text_logs").alias("all_logs"), F.sum("texts").alias("all_texts"))
    size = F.col("pages")
    style = F.log("uses") - F.col("use_logs") / F.col("uses")
    look = F.when(size > 1, F.least(F.lit(1.0), style / F.log("pages"))).otherwise(1.0)
    body = F.when(size > 1, F.greatest(F.lit(0.0), 1 - F.col("all_logs") / F.col("all_texts") / F.log("pages"))).otherwise(1.0)
    weight = F.pow(F.lit(GAMMA), F.least(F.col("styles").cast("double"), F.lit(400.0)))
    scored = nodes.join(above, ["host", "path"]).select(
        "host", "path", "pages", ((1 - weight) * look + weight * body).alias("importance"), body.alias("content"))
    root = scored.where("path = '#'").select("host", F.col("content").alias("whole"), F.col("pages").alias("host_pages"))
    smooth = lambda c: (F.col(c) * size + F.col("whole") * SMOOTH) / (size + SMOOTH)
    return scored.join(root, "host").select("host", "path", "pages", smooth("importance").alias("importance"), "content", "host_pages",
                                            (smooth("content") / F.greatest(F.col("whole"), F.lit(1e-9))).alias("share"))


def low_paths(pages: DataFrame, contrast: float = CONTRAST) -> DataFrame:
    """``host, low``: the paths to remove on each host that has any."""
    bad = importance(pages).where((F.col("pages") > 1) & (F.col("share") < contrast)
                                  & (F.col("importance") < contrast))
    return bad.groupBy("host").agg(F.array_sort(F.collect_set("path")).alias("low"))


def extract_pages(pages: DataFrame, **kw) -> DataFrame:
    """``page_id, url, text, n_chars`` per page."""
    @F.pandas_udf("string")
    def run(html: pd.Series, low: pd.Series) -> pd.Series:
        return pd.Series([extract(h, frozenset(p) if p is not None else frozenset()) for h, p in zip(html, low)],
                         dtype=object)

    rows = pages.select("page_id", "url", "html")
    # a host may hold a third of all pages: its few paths go to every salt
    low = stored(low_paths(rows, **kw), "low-paths").select(
        F.col("host").alias("__host"), "low", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))
    judged = rows.withColumns({"__host": host_of(F.col("url")), "__salt": F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")}).join(
        low, ["__host", "__salt"], "left")
    return judged.select("page_id", "url", run("html", "low").alias("text")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
