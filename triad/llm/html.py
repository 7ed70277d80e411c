"""Main text of web pages by composite text density.

A page becomes a DOM.  Elements that never hold article text (navigation, headers
outside the article, footers, asides, forms, scripts) are cut out.  Names are
weaker evidence: a class or id counts only if all words of one of its names speak of
menus, adverts, notices, comments and the like (``ad-slot``, ``related-posts``; not
``market-share`` or ``related-work``), and against a form, or a name other than
of comments, density has the last word: such a part stays if it holds the
article (an article or main element, or the first heading) or most of the page's text
with few links in it.

For every remaining node with C characters and T tags, LC and LT of them inside
links, the composite density is
C/T * log(C/LC * T/LT) to the base ln(C/(C-LC) * LC + LCb/Cb * C + e), where b is
the body.  A node's density sum is that of its children.  The threshold is the
least density on the path from the body to the node of largest sum; from the body
down, every node that reaches it contributes the largest-sum subtree below it.
A selected node inside an article or main element stands for that element, and
headings before it under the same parent belong to it.

Blocks are split at block elements; ``br`` is white space.  Character references
are decoded, white space (as Unicode has it) inside a block becomes one blank.

Reading and scoring take time in proportion to the page, however deep or broken it
is: what a start tag may close is kept with each open element, and a tag is only
looked for where a ``>`` follows.

Defined results: null or empty html, and pages with no text left, give the empty
text and 0.  Plain text is a page of one block.  Rows are independent of others.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from triad.llm.common import columns, slices

# Fixed values of HTML: void elements, raw text elements, block elements, and
# which open element each start tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select "
    "summary table tbody td tfoot th thead tr ul".split())
ENDS_P = BLOCK - frozenset("body caption dd dt html legend option tbody td tfoot th thead tr".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"),
          "tfoot": ("tbody", "thead", "tr", "td", "th"), "body": ("head",)}
SCOPE = frozenset("table ul ol dl select html body article main section aside nav footer header form button".split())
#: Elements that some start tag ends, in the order in which an open element remembers the nearest of each.
CLOSABLE = ("p", *dict.fromkeys(t for group in CLOSES.values() for t in group))
SLOT = {t: i for i, t in enumerate(CLOSABLE)}
NOTHING = (0,) * len(CLOSABLE)
# Elements and roles that hold no article text, and the words of
# classes and ids that name such parts.
CUT_TAGS = frozenset(
    "nav footer aside form script style noscript template iframe object embed svg canvas audio video button select "
    "textarea input dialog menu head title xmp noembed noframes".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
CUT_WORDS = frozenset(
    "ad ads adv adbox advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promoted "
    "promotion banner cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription "
    "paywall sidebar menu menus nav navbar navigation navi breadcrumb breadcrumbs comment comments commentlist disqus "
    "replies respond footer footnav masthead topbar toolbar pagination pager login signin signup search searchform "
    "share sharing social related recommended recommendations widget widgets outbrain taboola skip header".split())
SOFT_WORDS = frozenset("header banner notice".split())
KEEP_WORDS = frozenset("article entry post content story main body title".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies respond".split())
#: Words that say where or what kind of box a part is, but nothing of its matter.
NEUTRAL_WORDS = frozenset(
    "slot box bar list area wrap wrapper container inner outer section block panel group item items link links button buttons icon "
    "icons left right top bottom center main site page global primary secondary first last unit zone holder row col column module "
    "component region form field title label text message content body js is has c m u l id post posts article articles story stories "
    "news entry entries user reader blog thread count feed media network networks mobile desktop small large fixed sticky open closed "
    "active hidden policy policies letter up in out sign more read also you may like us".split())
MOST_LINKS, MOST_TEXT = 0.25, 0.5    # a named part with fewer links and more of the text stays

TAG = re.compile(
    r"<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[A-Za-z][^\s/>]*)(?P<attrs2>[^>]*)>|<[!?][^>]*>")
ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
WORDS = re.compile(r"[a-z]+")
HOLDS = re.compile(r"\b(?:with|has|have|no|without)[-_ ]+[a-z]+")  # "page-with-sidebar" is not a sidebar
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
ALIVE, NAMED, DEAD = 0, 1, 2


class Page:
    """Nodes in page order with their parents, and text runs with node and block."""

    def __init__(self, html: str):
        self.tag, self.parent, self.state = ["html"], [-1], [ALIVE]
        self.inside = [False]                        # an article or main element is around it
        self.runs: list[tuple[int, int, str]] = []   # node, block, text
        self.open, self.near, self.count = [0], [NOTHING], {"html": 1}
        self.parse(html)

    def parse(self, html: str) -> None:
        block, at, last = 0, 0, html.rfind(">")
        while at < len(html):
            start, m = html.find("<", at), None
            while start >= 0:
                closing = "-->" if html.startswith("<!--", start) else "]]>" if html.startswith("<![CDATA[", start) else None
                m = TAG.match(html, start) if closing is None and start < last else None
                if closing or m or start > last:
                    break
                start = html.find("<", start + 1)
            none = start < 0 or (start > last and not closing)
            text = html[at:] if none else html[at:start]
            if text:
                self.runs.append((self.open[-1], block, text))
            if none:
                break
            if closing:
                end = html.find(closing, start + 4)
                at = len(html) if end < 0 else end + 3
                continue
            at = m.end()
            tag = m["tag"] or m["tag2"]
            if not tag:
                continue
            tag = tag.lower()
            if tag in BLOCK:
                block += 1
            if m["end"] or m["end2"]:
                if self.count.get(tag):
                    i = len(self.open) - 1
                    while i and self.tag[self.open[i]] != tag:
                        i -= 1
                    if i:
                        self.cut_open(i)
                continue
            if tag == "br":
                self.runs.append((self.open[-1], block, " "))
            if tag == "html" or tag == "body" and self.count.get("body"):
                continue
            if tag in ENDS_P:
                self.end_nearest(("p",))
            if tag in CLOSES:
                self.end_nearest(CLOSES[tag])
            node, above = len(self.tag), self.open[-1]
            attrs = m["attrs"] or m["attrs2"] or ""
            self.tag.append(tag)
            self.parent.append(above)
            self.inside.append(self.inside[above] or self.tag[above] in ("article", "main"))
            self.state.append(self.judged(tag, attrs, self.inside[node]))
            if tag in RAW:
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at, last + 1)
                at = end.end() if end else len(html)
            elif tag not in VOID and not attrs.endswith("/"):
                near = NOTHING if tag in SCOPE else self.near[-1]
                if tag in SLOT:
                    near = (*near[:SLOT[tag]], len(self.open), *near[SLOT[tag] + 1:])
                self.open.append(node)
                self.near.append(near)
                self.count[tag] = self.count.get(tag, 0) + 1

    def cut_open(self, i: int) -> None:
        for node in self.open[i:]:
            self.count[self.tag[node]] -= 1
        del self.open[i:], self.near[i:]

    def end_nearest(self, tags: tuple) -> None:
        """End the nearest open element of ``tags`` that no element of SCOPE stands before, with
        those of ``tags`` right around it."""
        i = max(self.near[-1][SLOT[t]] for t in tags)
        if i:
            while i > 1 and self.tag[self.open[i - 1]] in tags:
                i -= 1
            self.cut_open(i)

    def judged(self, tag: str, attrs: str, in_article: bool) -> int:
        if tag in CUT_TAGS:
            return DEAD
        if tag == "header":
            return ALIVE if in_article else DEAD
        if not attrs or tag in ("html", "body"):
            return ALIVE
        found = {k.lower(): a or b or c for k, a, b, c in ATTR.findall(attrs)}
        if "hidden" in found or found.get("aria-hidden") == "true" or found.get("role") in CUT_ROLES:
            return DEAD
        if "style" in found and re.search(r"display\s*:\s*none", found["style"]):
            return DEAD
        names = CAMEL.sub("-", f"{found.get('class', '')} {found.get('id', '')}").lower()
        hit, words = set(), set()
        for name in HOLDS.sub(" ", names).split():
            parts = set(WORDS.findall(name))
            words |= parts
            if parts <= CUT_WORDS | NEUTRAL_WORDS:
                hit |= parts & CUT_WORDS
        if not hit or tag in ("main", "h1"):
            return ALIVE
        if hit <= SOFT_WORDS and (in_article or words & KEEP_WORDS):
            return ALIVE
        return DEAD if hit & COMMENT_WORDS else NAMED

    def spare(self) -> list[bool]:
        """Which nodes are left.  Forms and named parts (page-with-sidebar, promo) stay if an article
        or main element, or else the first heading, is inside, or most of the text with few links."""
        n = len(self.tag)
        weak = [s == NAMED or s == DEAD and t == "form" for s, t in zip(self.state, self.tag, strict=True)]
        hard = [s == DEAD and not w for s, w in zip(self.state, weak, strict=True)]
        holds = [t in ("article", "main") and s == ALIVE for t, s in zip(self.tag, self.state, strict=True)]
        if not any(holds) and "h1" in self.tag:
            holds[self.tag.index("h1")] = True
        link = [False] * n
        for i in range(1, n):
            hard[i] |= hard[self.parent[i]]
            link[i] = self.tag[i] == "a" or link[self.parent[i]]
        chars, linked = [0] * n, [0] * n
        for node, _, text in self.runs:
            if not hard[node]:
                size = len("".join(text.split()))
                chars[node] += size
                linked[node] += size if link[node] else 0
        for i in range(n - 1, 0, -1):
            chars[self.parent[i]] += chars[i]
            linked[self.parent[i]] += linked[i]
        dead = [s != ALIVE for s in self.state]
        for i in range(n - 1, 0, -1):
            holds[self.parent[i]] |= holds[i]
            article = holds[i] and (self.tag[i] not in CUT_TAGS and self.tag[i] != "header" or self.tag[i] == "form")
            bulk = weak[i] and not self.inside[i] and chars[i] > MOST_TEXT * chars[0] and linked[i] < MOST_LINKS * chars[i]
            if article or bulk:
                dead[i] = False
        for i in range(1, n):
            dead[i] |= dead[self.parent[i]]
        return dead

    def text(self) -> str:
        self.dead = self.spare()
        runs = [(node, block, unescape(t)) for node, block, t in self.runs if not self.dead[node]]
        keep = self.selected(runs)
        blocks: dict[int, list[str]] = {}
        for node, block, t in runs:
            if keep[node]:
                blocks.setdefault(block, []).append(t)
        lines = (" ".join("".join(parts).split()) for parts in blocks.values())
        return "\n\n".join(x for x in lines if x)

    def selected(self, runs: list[tuple[int, int, str]]) -> list[bool]:
        """Which nodes belong to the main text."""
        n = len(self.tag)
        link = [False] * n
        for i in range(1, n):
            link[i] = self.tag[i] == "a" or link[self.parent[i]]
        c, lc, t, lt = [0] * n, [0] * n, [0] * n, [0] * n
        for node, _, text in runs:
            size = len(" ".join(text.split()))
            c[node] += size
            lc[node] += size if link[node] else 0
        alive = [i for i in range(n) if not self.dead[i]]
        for i in reversed(alive[1:]):
            p = self.parent[i]
            c[p] += c[i]
            lc[p] += lc[i]
            t[p] += t[i] + 1
            lt[p] += lt[i] + (self.tag[i] == "a")
        body = next((i for i in alive if self.tag[i] == "body"), 0)
        ratio = lc[body] / max(1, c[body])
        density = [0.0] * n
        for i in alive:
            if c[i]:
                base = math.log(c[i] / max(1, c[i] - lc[i]) * max(1, lc[i]) + ratio * c[i] + math.e)
                x = c[i] / max(1, lc[i]) * max(1, t[i]) / max(1, lt[i])
                density[i] = c[i] / max(1, t[i]) * max(0.0, math.log(x)) / math.log(base)
        total, best = [0.0] * n, list(range(n))
        for i in alive[1:]:
            total[self.parent[i]] += density[i]
        for i in reversed(alive[1:]):
            p = self.parent[i]
            if (total[best[i]], -best[i]) > (total[best[p]], -best[p]):
                best[p] = best[i]
        outer = [-1] * n             # the outermost article or main element around a node, or itself
        for i in range(n):
            above = outer[self.parent[i]] if i else -1
            outer[i] = above if above >= 0 else i if self.tag[i] in ("article", "main") else -1

        def root(node: int) -> int:
            return outer[node] if outer[node] >= 0 else node

        path, node = [], best[0]
        while node >= 0:
            path.append(node)
            node = self.parent[node]
        threshold = min(density[i] for i in (path[:path.index(body) + 1] if body in path else path))
        on_path = set(path)
        keep, reach = [False] * n, [False] * n
        for i in alive:
            reach[i] = i in on_path or (density[i] >= threshold and reach[self.parent[i]])
            if reach[i]:
                keep[root(best[i])] = True
        top = root(best[0])
        for i in alive:  # headings before the selected part
            if i < top and self.parent[i] == self.parent[top] and self.tag[i] in ("h1", "h2", "h3"):
                keep[i] = True
        for i in alive[1:]:
            keep[i] = keep[i] or keep[self.parent[i]]
        return keep


def main_text(html: str | None) -> str:
    return Page(html).text() if html else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "html"):
            texts = [main_text(h) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return columns(pages, page_id="long", url="string", html="string").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")


def op9_text_density(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
