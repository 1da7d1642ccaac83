"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags (and at two ``<br>`` in a row).  Blocks inside
markup that says what it is (menus, page headers and footers, sidebars, notices, adverts,
forms, reader comments, scripts) are left out at once.  Pass one decides the other blocks by
their length, stop-word density and link density: good, bad, or ambiguous.  In pass two an
ambiguous block takes the label of the nearest decided neighbour; between two at the same
distance, good counts if the block itself is near good.  Where a page has ``article`` or
``main`` elements with text, only blocks in them can be good, neighbours are looked for in
the same element only, lists of links there don't pass on their label, and an element without
decided blocks is good as a whole.

Character references are decoded, white space inside a block becomes one space, and good
blocks are joined in page order by a line feed.  Null or empty html gives an empty text;
cut-off tags at the end are dropped; repeated rows and null ids each give a row.  The scanner
looks at every character a bounded number of times, however broken the markup is.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORT = 70  # characters below which a block alone is not decided
LONG = 200
STOP_LOW, STOP_HIGH = 0.2, 0.3
LINKS = 0.5

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """
    a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they
    this to was we were which will with you
    als am an auch auf aus bei das dem den der des die ein eine einem einen einer er es für hat ich im in ist mit nach
    nicht sich sie sind so und von war wie wird zu zum zur über
    au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qu que
    qui sa se ses son sont sur un une vous
    al con de del el ella en es esta este ha la las lo los más me mi no o para pero por que se sin sobre son su sus un una
    y ya
    """.split()
)

BLOCK_TAGS = frozenset(
    """address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre search section
    select summary table tbody td tfoot th thead title tr ul""".split()
)
# elements that may hold blocks, and so stand on the stack of open elements
CONTAINERS = frozenset(
    """address article aside blockquote body button dd details dialog div dl dt fieldset figure footer form head header html
    iframe li main menu nav noscript object ol search section select svg table tbody td template tfoot th thead tr ul video
    audio canvas math label""".split()
)
DROPPED_TAGS = frozenset(
    """aside audio button canvas dialog footer form head header iframe label math menu nav noscript object search select svg
    template video""".split()
)
RAW_TAGS = frozenset("script style textarea title xmp noembed noframes".split())
RAW_END = {tag: re.compile(f"</{tag}(?=[\\s/>]|$)", re.I) for tag in RAW_TAGS}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED_NAMES = frozenset(
    """ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments consent
    cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices
    notification pagination popup promo promoted promotion related reply replies respond share sharing sidebar signup social
    sponsor sponsored subscribe subscription toolbar widget widgets""".split()
)
STATES = frozenset("has no with without is not".split())
COMMENT_NAMES = frozenset("comment comments disqus reply replies respond".split())
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())

_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/\"']|$)", re.I)
_OPEN_QUOTE = re.compile(r"=\s*([\"'])")
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_PART = re.compile(r"[a-z]+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    link_chars: int
    element: int  # number of the article or main element around it, 0 for none
    item: bool  # in a list
    label: str = ""


def _names_part(word: str, names: frozenset[str]) -> bool:
    """Whether a class or id names such a part of a page: by itself, or in its first or last part
    (``sidebar-left``, ``site-footer``).  Words that tell of an element's state or layout
    (``has-sidebar``, ``no-comments``, ``page-with-sidebar``) name the whole, not the part."""
    parts = _PART.findall(word)
    return bool(parts) and not STATES.intersection(parts) and (parts[0] in names or parts[-1] in names)


def _dropped(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether the element's tag, role, class or id says that it isn't part of the article."""
    if tag in DROPPED_TAGS:
        return True
    if not attributes:
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "").lower()
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value in DROPPED_ROLES:
            return True
        if name in ("class", "id") and tag not in ("html", "body", "main"):
            names = COMMENT_NAMES if tag == "article" else DROPPED_NAMES
            if any(_names_part(word, names) for word in value.split()):
                return True
    return False


def _tag_end(page: str, start: int, gone: set[str]) -> int:
    """Index of the ``>`` that ends the tag at ``start``, -1 if it is cut off.  ``gone``: quotes
    that don't occur further on, so a missing one is searched only once."""
    end, at = page.find(">", start), start
    while end >= 0:
        quote = None
        while m := _OPEN_QUOTE.search(page, at, end):
            close = page.find(m[1], m.end(), end)
            if close < 0:
                quote = m
                break
            at = close + 1
        if quote is None or quote[1] in gone:
            return end
        close = page.find(quote[1], end)
        if close < 0:
            gone.add(quote[1])
            return end
        at = close + 1
        end = page.find(">", at)
    return end


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page that no markup excludes, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, bool, int]] = []  # (tag, dropped, article element)
    parts: list[str] = []
    link_parts: list[str] = []
    gone: set[str] = set()
    links = elements = breaks = 0

    def flush() -> None:
        nonlocal breaks
        breaks = 0
        text = " ".join("".join(parts).split())
        if text:
            linked = len(" ".join("".join(link_parts).split()))
            out.append(Block(text, linked, stack[-1][2] if stack else 0, any(t == "li" for t, _, _ in stack)))
        parts.clear()
        link_parts.clear()

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        text = page[at:] if lt < 0 else page[at:lt]
        if text and not (stack and stack[-1][1]):
            text = entities.unescape(text) if "&" in text else text
            if not text.isspace():
                breaks = 0
            parts.append(text)
            if links:
                link_parts.append(text)
        if lt < 0:
            break
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            if end < 0:
                break
            at = end + 3
            continue
        closing = page.startswith("</", lt)
        name = _NAME.match(page, lt + 1 + closing)
        if not name:
            if lt + 1 >= n or page[lt + 1] in "!?/":
                end = page.find(">", lt)
                if end < 0:
                    break
                at = end + 1
            else:  # a plain sign
                if not (stack and stack[-1][1]):
                    parts.append("<")
                at = lt + 1
            continue
        end = _tag_end(page, name.end(), gone)
        if end < 0:
            break
        tag, attributes = name.group().lower(), page[name.end() : end]
        at = end + 1
        if tag in RAW_TAGS and not closing:
            m = RAW_END[tag].search(page, at)
            if not m:
                break
            at = m.start()
            continue
        if tag == "br":
            breaks += 1
            parts.append(" ")
            if breaks == 2:
                flush()
            continue
        if tag == "a":
            links = 0 if closing else 1
            continue
        if tag in BLOCK_TAGS or tag in DROPPED_TAGS:
            flush()
            links = 0
        if tag not in CONTAINERS or tag in VOID:
            continue
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
        elif not attributes.endswith("/"):
            dropped, element = stack[-1][1:] if stack else (False, 0)
            dropped = dropped or _dropped(tag, attributes, bool(element))
            if tag in ("article", "main") and not element and not dropped:
                elements += 1
                element = elements
            if tag == "li" and stack and stack[-1][0] == "li":
                stack.pop()
            stack.append((tag, dropped, element))
    flush()
    return out


def classify(blocks: list[Block]) -> None:
    """Pass one: good, bad, near (near good) or short."""
    restricted = any(b.element for b in blocks)
    for b in blocks:
        length, links = len(b.text), b.link_chars / len(b.text)
        words = _WORD.findall(b.text.lower())
        stops = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
        if restricted and not b.element:
            b.label = "bad"
        elif b.element:
            if links > LINKS:
                b.label = "bad" if b.item else "short"
            elif length < SHORT:
                b.label = "short"
            else:
                b.label = "good" if stops >= STOP_LOW else "near"
        elif links > LINKS or b.text.startswith("©"):
            b.label = "bad"
        elif length < SHORT:
            b.label = "bad" if b.link_chars else "short"
        elif stops >= STOP_HIGH:
            b.label = "good" if length > LONG else "near"
        elif stops >= STOP_LOW:
            b.label = "near"
        else:
            b.label = "bad"


def inherit(blocks: list[Block]) -> None:
    """Pass two: ambiguous blocks take the label of the nearest decided neighbour."""
    n = len(blocks)
    before: list[int | None] = [None] * n
    after: list[int | None] = [None] * n
    for order, into in ((range(n), before), (range(n - 1, -1, -1), after)):
        last: dict[int, int] = {}
        for i in order:
            b = blocks[i]
            into[i] = last.get(b.element)
            if b.label == "good" or (b.label == "bad" and not b.element):
                last[b.element] = i
    labels = []
    for i, b in enumerate(blocks):
        p, q = before[i], after[i]
        if b.label in ("good", "bad"):
            labels.append(b.label)
        elif p is None and q is None:
            labels.append("good" if b.element or b.label == "near" else "bad")
        elif p is None or q is None:
            labels.append(blocks[q if p is None else p].label)
        elif i - p != q - i:
            labels.append(blocks[p if i - p < q - i else q].label)
        else:
            either = {blocks[p].label, blocks[q].label}
            labels.append("good" if either == {"good"} or ("good" in either and b.label == "near") else "bad")
    for b, label in zip(blocks, labels):
        b.label = label


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    classify(blocks)
    inherit(blocks)
    return "\n".join(b.text for b in blocks if b.label == "good")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return source.mapInArrow(run, "page_id long, url string, text string, n_chars long")
