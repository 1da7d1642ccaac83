"""Block rules on pages of all kinds, and a plain reading of the given pages."""

from __future__ import annotations

import html
import re
import time

from zonepulse.llm.extract import blocks_of, classify, extract, main_text

LONG = "This is the long text of the article and it is about the things that are in the world, of which there are many to be seen by you."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class='has-sidebar'>{body}</body></html>"


def test_article_without_its_surroundings():
    body = (
        "<header>Top</header><nav><a href=x>Home</a></nav><div class='cookie-notice'>We use cookies</div><main><h1>Title &amp; more</h1>"
        f"<p>Short.</p><p>{LONG}</p><div id='ad-3'>Buy now</div><p>a &lt; b <br>c&nbsp;d</p><script>if (a<b) '</p>'</script>"
        f"<section class='comments'><p>{LONG}</p></section><form><label>x</label></form></main><aside>{LONG}</aside><footer>f</footer>"
    )
    assert main_text(page(body)) == f"Title & more\nShort.\n{LONG}\na < b c d"


def test_pages_without_article():
    good = f"{LONG} {LONG}"
    assert main_text(page(f"<div>{good}</div><p>Brief words here.</p><div>{good}</div>")) == f"{good}\nBrief words here.\n{good}"
    assert main_text(page("<ul><li><a href=1>one</a></li><li><a href=2>two</a></li></ul><p>xqz brr</p>")) == ""
    near = "These words of the page are near the good ones, but it is not as long as they are."
    blocks = blocks_of(page(f"<p>{good}</p><p>{near}</p><p><a href=x>{near}</a></p>"))
    classify(blocks)
    assert [b.label for b in blocks] == ["good", "near", "bad"]


def test_broken_markup():
    assert main_text(None) == main_text("") == main_text("<p") == ""
    assert main_text(f"<article><p>{LONG}<p>x &am") == f"{LONG}\nx &am"
    assert main_text(f"<article><p title='a > b'>{LONG}</p><p>cut <a hre") == f"{LONG}\ncut"
    assert main_text("<article>only short</article>") == "only short"
    assert main_text("<article>a<br><br>b<br>c 1 < 2</article>") == "a\nb c 1 < 2"
    start = time.time()
    for bad in ('<a "' * 50000, '<a b="' * 50000, "<!--" * 50000, "<script>" * 50000, "<" * 300000, "<div>" * 50000):
        main_text(bad)
    assert time.time() - start < 60


def test_operator(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    odd = spark.createDataFrame([(None, "u", None), (-1, None, ""), (-1, None, "")], pages.schema)
    rows = extract(pages.union(odd)).collect()
    assert len(rows) == pages.count() + 3 and all(r.n_chars == len(r.text) for r in rows)
    got = {r.page_id: r.text for r in rows}
    for r in pages.collect():
        article = re.sub(r"<[^>]*$", "", r.html.split("<article>")[1].split("</article>")[0])
        parts = [" ".join(html.unescape(re.sub(r"<br>|</?b>", " ", x)).split()) for x in re.split(r"</?p>|</?h1>", article)]
        assert got[r.page_id] == "\n".join(x for x in parts if x)
    assert extract(pages.limit(0)).count() == 0


def test_names_of_wrappers_and_of_parts():
    whole = "layout has-sidebar", "page no-comments", "page-with-sidebar", "is-not-login"
    for name in whole:
        assert main_text(f'<div class="{name}"><article><p>{LONG}</p></article></div>') == LONG
        assert main_text(f'<div id="{name.split()[-1]}"><article><p>{LONG}</p></article></div>') == LONG
    for name in ("sidebar", "left-sidebar", "sidebar_box", "site-footer x", "post-comments", "ad-top", "x newsletter"):
        assert main_text(f'<article><p>{LONG}</p></article><div class="{name}"><p>{LONG}</p></div>') == LONG
