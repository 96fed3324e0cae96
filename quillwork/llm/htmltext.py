"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. Structure leaves out what stands in menus, page headers, footers, asides,
forms, adverts, notices, reader comments and the like. Of every page's other blocks the first pass decides each by its
own figures: link density, length and stop-word density make it good, bad or ambiguous; in the second pass ambiguous
blocks take the label of the nearest decided neighbours, and where these differ the block is out unless it was nearly
good. An article or main element is a prior only: it lifts the first label of its blocks by a step (see `first_label`).
Inside it, an element is left out by name only where a whole name says so (class="related", id="newsletter-signup"); one
such word in a longer name (id="related-work") takes the prior away from the element's blocks and no more.

Defined cases: null or empty html gives an empty text. Rows go one by one: repeated rows, null page_ids and ties are like
any other, other columns are left out, a very long page is read whole, an empty table gives an empty result. Broken markup (unclosed tags, cut-off pages, stray ends) is read
as far as it goes. An unclosed script, style or comment hides the rest of the page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

# Common function words of a few languages.
STOP_WORDS = frozenset(
    """a an and are as at be by for from has he in is it its not of on or she that the their they this to was were which will with you
    aber als auch auf aus bei das dass dem den der des die ein eine einen er es für im ist mit nicht sich sie sind so und von war wie wird zu
    au aux avec ce cette dans de des du elle en est et il la le les leur mais ne ou par pas pour que qui se son sur un une
    al como con del el era esta este fue la las lo los más no nos para pero por se su sus también una uno y""".split()
)
# Elements by their part in a page.
HIDDEN = "script|style|noscript|template|svg|math|iframe|object|canvas|textarea|select|title"
OUT = frozenset("nav footer aside form button dialog menu".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
# Words in a class, id or role that name what is not the article.
NOT_ARTICLE = frozenset(
    """ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies
    disqus footer gdpr login menu modal nav navbar navigation navigationmenu newsletter notice notices pager pagination popup promo promoted
    promotion recommended related replies respond search share sharing sidebar signup social sponsor sponsored subscribe subscription
    toolbar widget complementary""".split()
)
PAGE_HEADER = frozenset("header masthead banner".split())
QUALIFIED = frozenset("has with without no".split())

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<({HIDDEN})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*?(?:/>|>.*?(?:</\1\s*>|\Z))"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-z][a-z0-9:-]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|([^<]+|<)",
    re.S | re.I,
)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    linked: int  # characters in links
    inside: int  # the number of the outermost article or main element that holds it, from 1; 0 for none
    heading: bool
    doubtful: bool = False  # inside, but a part of a name speaks against it


def named(attributes: str) -> set[str]:
    return {w.lower() for m in NAMES.finditer(attributes) for w in PARTS.findall(m[1] or m[2] or m[3] or "")}


def doubted(tag: str, attributes: str) -> bool:
    """Of an element inside an article: a part of a name is of those of other things."""
    words = named(attributes)
    return tag not in ("article", "main") and bool(words & NOT_ARTICLE) and not words & QUALIFIED


def left_out(tag: str, attributes: str, inside: bool) -> bool:
    if tag in OUT or tag == "header" and not inside:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    words = named(attributes)
    if words & QUALIFIED:
        return False
    if tag in ("article", "main"):
        return bool(words & {"comment", "comments", "related", "ad", "ads", "promo"})
    if inside:
        whole = [{w.lower() for w in PARTS.findall(x)} for m in NAMES.finditer(attributes) for x in (m[1] or m[2] or m[3] or "").split()]
        return any(x and x <= NOT_ARTICLE for x in whole)
    return bool(words & NOT_ARTICLE) or bool(words & PAGE_HEADER)


def blocks(html: str) -> list[Block]:
    """Blocks in page order, without those that structure leaves out."""
    found: list[Block] = []
    stack: list[tuple[str, bool, int, bool, bool]] = []  # tag, out, inside, link, doubtful
    text: list[str] = []
    linked, heading, n_inside = 0, False, 0

    def end() -> None:
        nonlocal linked, heading
        if text:
            whole = " ".join(unescape("".join(text)).split())
            if whole:
                found.append(Block(whole, linked, inside, heading, doubtful))
            text.clear()
        linked, heading = 0, False

    out, inside, link, doubtful = False, 0, False, False
    for m in TOKEN.finditer(html):
        if m[8] is not None:
            if not out:
                text.append(m[8])
                if link:
                    linked += len(m[8].strip())
            continue
        tag = m[3] or m[6]
        if not tag:
            continue
        tag, closing, attributes = tag.lower(), m[2] or m[5], m[4] or m[7] or ""
        if tag == "br":
            text.append(" ")
            continue
        if tag not in INLINE:
            end()
        if closing:
            if any(x[0] == tag for x in stack):
                while stack.pop()[0] != tag:
                    pass
        elif tag not in VOID and not attributes.endswith("/"):
            if tag == "p" or tag in ("li", "tr", "td", "th", "dt", "dd", "option"):
                # these end the same element left open before, as long as no other block stands between
                while stack and (stack[-1][0] in INLINE or stack[-1][0] == tag):
                    last = stack.pop()[0]
                    if last == tag:
                        break
            inner = inside
            if not inside and tag in ("article", "main"):
                inner = n_inside = n_inside + 1
            doubt = doubtful or inside > 0 and attributes != "" and doubted(tag, attributes)
            stack.append((tag, out or left_out(tag, attributes, inside > 0), inner, link or tag == "a", doubt))
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            heading = not closing
        _, out, inside, link, doubtful = stack[-1] if stack else ("", False, 0, False, False)
    end()
    return found


GOOD, BAD, NEAR, SHORT = "good", "bad", "near", "short"


def first_pass(b: Block, max_links: float = 0.2, short: int = 70, long: int = 200, low: float = 0.2, high: float = 0.3) -> str:
    n = len(b.text)
    if b.linked > max_links * n:
        return BAD
    if n < short:
        return BAD if b.linked else SHORT
    words = WORD.findall(b.text.lower())
    density = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if density >= high:
        return GOOD if n > long else NEAR
    if density >= low:
        return NEAR
    return BAD


def first_label(b: Block, lone: bool, long: int = 200, links: float = 0.9) -> str:
    """The first pass, with an article or main element as a prior: low density and short length leave its blocks nearly
    good, links leave them to their neighbours unless they are links all over, and nearly good blocks are good where they
    are long or where this is the page's only such element (teasers come in numbers)."""
    label, n = first_pass(b), len(b.text)
    if b.doubtful:
        return BAD if label == SHORT and not b.heading else label
    if not b.inside or label == GOOD:
        return label
    if label == NEAR:
        return GOOD if lone or n > long else NEAR
    if b.linked > links * n:
        return BAD
    return SHORT if b.linked > 0.2 * n else NEAR


def second_pass(labels: list[str]) -> list[bool]:
    """Nearest decided labels before and after decide what the first pass left open."""
    n, before, after = len(labels), [BAD] * len(labels), [BAD] * len(labels)
    for i in range(1, n):
        before[i] = labels[i - 1] if labels[i - 1] in (GOOD, BAD) else before[i - 1]
    for i in range(n - 2, -1, -1):
        after[i] = labels[i + 1] if labels[i + 1] in (GOOD, BAD) else after[i + 1]
    return [x == GOOD or x == SHORT and b == a == GOOD or x == NEAR and GOOD in (b, a) for x, b, a in zip(labels, before, after, strict=True)]


def main_text(html: str | None) -> str:
    if not html:
        return ""
    found = blocks(html)
    insides = {b.inside for b in found if b.inside}
    labels = [first_label(b, len(insides) == 1) for b in found]
    keep = second_pass(labels)
    # a heading goes with the block that it stands over
    for i in range(len(found) - 2, -1, -1):
        if found[i].heading and labels[i] in (SHORT, NEAR) and keep[i + 1]:
            keep[i] = True
    if not any(keep):  # a page without a good block: all that nothing speaks against, of an article if there is one
        keep = [x in (NEAR, SHORT) and (b.inside > 0 or not insides) for b, x in zip(found, labels, strict=True)]
    return " ".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of pages (page_id, url, html)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", "html").mapInArrow(work, f"page_id {kinds['page_id']}, url string, text string, n_chars long")
