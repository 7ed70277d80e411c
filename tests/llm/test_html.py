import re
import time
from html import unescape

from triad.llm import html as H

SMALL = "/root/testdata/sf0.01/pages.parquet"


def between(page):
    """The blocks between the article tags of the generated pages."""
    a = page[page.index("<article>") + 9:]
    a = a[:a.find("</article>")] if "</article>" in a else a
    blocks = (" ".join(unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", a))
    return "\n\n".join(b for b in blocks if b)


def test_pages(spark):
    rows = H.extract(spark.read.parquet(SMALL)).collect()
    html = {r.page_id: r.html for r in spark.read.parquet(SMALL).collect()}
    assert len(rows) == len(html)
    for r in rows:
        assert r.text == between(html[r.page_id]) and r.n_chars == len(r.text)


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div id="cookie-notice">We use cookies, a lot of them. Accept?</div>
<div class="page-with-sidebar"><%s class="content"><h2>The title</h2>
<p>First paragraph of the text, with a <a href=x>link</a> &amp; more words than any menu has, so that it is dense.
<p>Second&nbsp;one is <b>bold<i>er</b></i>; it has   white
space, a line<br>break and an entity &lt;b&gt; too. It goes on for a while.
<ul><li>An item of the list that is long enough to count<li>Another item of it</ul>
<div class="ad-slot">Buy our things now, they are the best things of all.</div>
<script>var x = "<p>no</p>";</script><form><p>Your name</p></form>
<blockquote>Said somebody about something, in a sentence.</blockquote></%s>
<aside>Related pages</aside><div class="sidebar"><a href=a>One</a><a href=b>Two</a></div></div>
<section id="comments"><article class="comment"><p>First! I have read it all and have an opinion as long as the text itself.</p></article></section>
<footer>&copy; all of us</footer></body></html>"""
WANT = ["The title", "First paragraph of the text, with a link & more words than any menu has, so that it is dense.",
        "Second one is bolder; it has white space, a line break and an entity <b> too. It goes on for a while.",
        "An item of the list that is long enough to count", "Another item of it", "Said somebody about something, in a sentence."]


def test_article_main_and_div():
    for tag in ("article", "main", "div"):
        assert H.main_text(PAGE % (tag, tag)).split("\n\n") == WANT


def test_density_finds_the_text_without_names():
    menu = "".join(f"<li><a href=/{i}>Section {i}</a></li>" for i in range(12))
    text = "".join(f"<p>Paragraph {i} says a good deal about its matter, in plain words and at some length.</p>" for i in range(6))
    page = f"<body><div><ul>{menu}</ul></div><div><h1>Head</h1>{text}</div><div><a href=a>About us</a> <a href=b>Contact</a></div></body>"
    out = H.main_text(page)
    assert out.startswith("Head\n\nParagraph 0") and "Section" not in out and "Contact" not in out and out.count("Paragraph") == 6


TEXT = "".join(f"<p>Paragraph {i} says a good deal about its matter, in plain words and at some length.</p>" for i in range(6))


def test_names_are_weak_evidence():
    """A form around the body, and names that only contain a word of menus."""
    form = f'<body><form id="aspnetForm" action="./"><div><h1>Head</h1>{TEXT}</div><input name="x"><button>Send</button></form></body>'
    assert H.main_text(form).startswith("Head\n\nParagraph 0") and H.main_text(form).endswith("length.")
    bare = f"<body><form>{TEXT}<button>Send</button></form></body>"
    assert H.main_text(bare).count("Paragraph") == 6 and "Send" not in H.main_text(bare)
    for name in ("related-work", "market-share", "skip-lists", "header-files", "searchable"):
        page = f'<body><ul class="menu"><li><a href=a>Home</a></ul><div class="{name}">{TEXT}</div><div><p>Another part, shorter.</p></div></body>'
        assert H.main_text(page).count("Paragraph") == 6, name
        assert "Home" not in H.main_text(page)
    for name in ("ad-slot", "related-posts", "share-buttons", "cookieNotice", "newsletter_signup", "sidebar left", "reader-comments"):
        page = f'<body><div><h1>Head</h1>{TEXT}<div class="{name}"><p>Not a part of it.</p></div></div></body>'
        assert "Not a part" not in H.main_text(page) and H.main_text(page).count("Paragraph") == 6, name
    assert "Your mail" not in H.main_text(f"<body><div>{TEXT}</div><form><p>Your mail address please</p></form></body>")


def test_deep_and_broken_pages_take_linear_time():
    deep = 20_000
    pages = {"div": "<div>" * deep + "<p>end", "li": "<ul><li>" * deep + "end", "span": "<p><span>" * deep + "end", "button": "<p><button>" + "<div>" * deep + "end",
             "ends": "<div>" * deep + "</b></i></p>" * deep + "end", "half": "<a " * 350_000, "quotes": "<a title=\"" * 100_000, "ticks": "<b '>" * 100_000 + "end",
             "comments": "<!-" * 300_000, "bang": "<!x" * 300_000, "script": "<script>" + "</script " * 100_000, "article": "<article><div>" * deep + "end"}
    for name, page in pages.items():
        t = time.process_time()
        out = H.main_text(page)
        assert time.process_time() - t < 3, name
        assert out.endswith("end") or name not in ("div", "li", "span", "ends", "ticks", "article"), name


def test_edges(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "plain text"), (4, "u", "<p>open <b>bold <p>next"), (5, "u", "<div><!-- never closed"),
            (6, "u", "<p title=\"a>b\">x</p>" * 3), (7, "u", "<" * 50 + "a"), (None, None, "<p>" + "word " * 50_000), (8, "u", "<nav>only menu</nav>"),
            (3, None, "plain text")]
    pages = spark.createDataFrame([(*r, "?") for r in rows], "page_id long, url string, html string, n_chars string")
    out = [(r.page_id, r.text, r.n_chars) for r in H.extract(pages).collect()]
    by = dict((i, t) for i, t, _ in out)
    assert by[1] == by[2] == by[5] == by[8] == "" and by[3] == "plain text" and by[4] == "open bold\n\nnext"
    assert by[6] == "x\n\nx\n\nx" and by[None] == " ".join(["word"] * 50_000)
    assert len(out) == len(rows) and all(n == len(t) for _, t, n in out)
    assert H.extract(pages.where("false")).collect() == []
