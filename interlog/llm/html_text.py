"""HTML extraction: a page's main text by two passes of block rules.

The page is cut into blocks at block-level tags. Whole containers that never hold an article (scripts, menus,
footers, sidebars, notices, adverts, forms, reader comments, ...) are known by tag, role or class and left out.
First pass: link density, length and stop-word density decide a block, or leave it open. Second pass: open
blocks take the label of their nearest decided neighbours, headings that of what follows. Where the page marks
its article, blocks outside are not text and a block inside is only left out for its links. Where the only marked article
lies in a form or in a container with a layout name such as "with-sidebar", that container is not left out around it;
one that holds reader comments, teasers or adverts always is, and so is an article that is itself a reader comment.

Defined results: null, empty or text-free HTML gives ''; very long pages are read whole; repeated rows are
extracted alike; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(script|style|noscript|template|iframe|svg|math|object|canvas|audio|video|textarea|select|title|noframes)\b[^<>]*"
    r"(?:/>|>.*?(?:</\1\s*>|\Z))"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])))*+(?=>)|[^<>]*+)>"
    r"|<[!?/a-zA-Z][^<>]*>", re.S | re.I)
# A quote that follows no "=" or has no end does not hide a ">": such a tag ends at the first one.
NEAR = 32                        # open inline elements that an implied end tag looks through
ATTRIBUTE = re.compile(r"\"[^\"]*+\"|'[^']*+'|([^\s\"'=/]++)\s*+(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")
SPACE = re.compile(r"\s+")
LETTERS = re.compile(r"[^\W\d_]+")
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section
    summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LEFT_OUT = frozenset("nav footer aside form button menu dialog head search".split())
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
#: parts of class and id names, compared as whole words
LEFT_OUT_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments
    consent cookie cookies copyright disqus footer gdpr login menu modal nav navbar navigation newsletter notice notices
    overlay pager pagination paywall popup promo promoted promotion related replies reply respond share sharing sidebar
    signup skip social sponsor sponsored subscribe tags teaser toolbar topbar widget""".split())
#: names that leave a container out even where the page's only marked article lies in it
NEVER_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising comment comments disqus promo promoted promotion
    related replies reply respond sponsor sponsored teaser""".split())
ARTICLES = frozenset("article main".split())
ARTICLE_TAG = re.compile(r"<(?:article|main)\b", re.I)
COMMENT_NAME = re.compile(r"(?:user[-_]?|reader[-_]?)?(?:comment|reply)(?:[-_]?(?:item|body|[0-9]+))?")
# Frequent function words of the languages that pages come in.
STOP_WORDS = frozenset("""a an and are as at be but by for from had has have he her his in is it its not of on or she that
    the their they this to was were which will with you
    au aux avec ce dans de des du elle en est et il la le les leur ne ou par pas pour qui que se son sur un une
    aber als auch auf aus bei das dem den der des die ein eine einer er es für ich im ist mit nicht sich sie sind über und
    von war wie wird zu zum
    al como con del el entre era esta está fue las lo los más mi muy no o para pero por ser si sin su sus también y ya""".split())
LINKS_MOST = 0.5
SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH = 0.15, 0.30
SPOKEN = 0.04                    # share of stop words from which a page's language is one of theirs


class Block:
    __slots__ = ("text", "linked", "tag", "inside", "good")

    def __init__(self, text: str, linked: int, tag: str, inside: bool):
        self.text, self.linked, self.tag, self.inside = text, linked, tag, inside
        self.good: bool | None = None


def _named_out(tag: str, attributes: str) -> int:
    """0: not left out by its attributes; 1: left out unless it holds the page's only article; 2: left out."""
    found = 0
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return 2
        if name == "style" and re.search(r"display\s*:\s*none", value.lower()):
            return 2
        if name == "role" and value.lower() in LEFT_OUT_ROLES:
            found = max(found, 1 if value.lower() == "form" else 2)
        if name in ("class", "id") and tag == "article":
            if any(COMMENT_NAME.fullmatch(w) for w in value.lower().split()):
                return 2
        elif name in ("class", "id") and tag not in ("html", "body", "main"):
            words = set(re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower()))
            found = max(found, 2 if words & NEVER_NAMES else 1 if words & LEFT_OUT_NAMES else 0)
    return found


def blocks(page: str, around: bool = False) -> list[Block]:
    """The page's text blocks in order, without the containers that are left out; with ``around`` an article is read
    in a form or a container with a layout name as well."""
    found: list[Block] = []
    parts: list[str] = []
    links: list[str] = []
    # open elements, whether each is left out (2: always), and the count of those around an article that is read
    stack: list[tuple[str, int, int]] = []
    names: Counter[str] = Counter()         # of the open elements
    out = never = inside = anchors = breaks = 0
    tag, at = "", 0

    def close() -> None:
        nonlocal parts, links, breaks
        text = SPACE.sub(" ", entities.unescape("".join(parts))).strip()
        if text:
            found.append(Block(text, len(SPACE.sub(" ", entities.unescape("".join(links))).strip()), tag, inside > 0))
        parts, links, breaks = [], [], 0

    def pop() -> None:
        nonlocal out, never, inside, anchors
        name, was_out, outer = stack.pop()
        names[name] -= 1
        out += outer - (was_out > 0)
        never -= was_out > 1
        inside -= name in ARTICLES
        anchors -= name == "a"

    for m in MARKUP.finditer(page):
        if m.start() > at and not out:
            text = page[at:m.start()]
            parts.append(text)
            if anchors:
                links.append(text)
            if breaks and text.strip():
                breaks = 0
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            if not out and m[1] and m[1].lower() in ("iframe", "textarea", "select", "video", "audio"):
                parts.append(" ")
            continue
        if name == "br":
            if not out:
                parts.append("\n")
                breaks += 1
                if breaks > 1:
                    close()
            continue
        if name in BLOCKS and not out:
            close()
        if m[2]:                                            # an end tag closes up to its start tag, if that is open
            if names[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
            tag = next((t for t, *_ in reversed(stack) if t in BLOCKS), "")
            continue
        if name in VOID or m[4].endswith("/"):
            continue
        if name in BLOCKS:                                  # a new block ends an open paragraph or item
            ends = {"li": ("li", "p"), "dd": ("dd", "dt", "p"), "dt": ("dd", "dt", "p"), "tr": ("tr", "td", "th", "p"),
                    "td": ("td", "th", "p"), "th": ("td", "th", "p")}.get(name, ("p",))
            while True:
                k = next((k for k in range(len(stack) - 1, max(-1, len(stack) - NEAR), -1) if stack[k][0] in BLOCKS), None)
                if k is None or stack[k][0] not in ends:
                    break
                while len(stack) > k:
                    pop()
        hidden = 1 if name == "form" else 2 if name in LEFT_OUT or (name == "header" and not inside) else 0
        if hidden < 2 and m[4].strip():
            hidden = max(hidden, _named_out(name, m[4]))
        outer = out if around and name in ARTICLES and not never and not hidden else 0
        stack.append((name, hidden, outer))
        names[name] += 1
        out += (hidden > 0) - outer
        never += hidden > 1
        inside += name in ARTICLES
        anchors += name == "a"
        tag = name if name in BLOCKS else tag
    if at < len(page) and not out:
        text = page[at:]
        open_tag = text.find("<", text.rfind(">") + 1)
        parts.append(text[:open_tag] if re.match("<[a-zA-Z/!]", text[open_tag:open_tag + 2]) else text)
    close()
    return found


def classify(found: list[Block]) -> None:
    """First pass: each block alone. Second pass: open blocks by their nearest decided neighbours."""
    marked = any(b.inside for b in found)
    share = [(sum(w in STOP_WORDS for w in words), len(words)) for words in (LETTERS.findall(b.text.lower()) for b in found)]
    # a page in another language holds none of the stop words, so they say nothing about its blocks
    spoken = sum(n for n, _ in share) >= SPOKEN * sum(n for _, n in share)
    for b, (n_stops, n_words) in zip(found, share, strict=True):
        links, stops = b.linked / len(b.text), n_stops / max(1, n_words)
        if marked:
            b.good = False if not b.inside or links > LINKS_MOST else True if len(b.text) >= SHORT or not b.linked else None
        elif links > LINKS_MOST or "\N{COPYRIGHT SIGN}" in b.text and len(b.text) < LONG:
            b.good = False
        elif len(b.text) < SHORT:
            b.good = False if b.linked else None
        elif not spoken:
            b.good = True if len(b.text) >= LONG else None
        elif stops >= STOP_HIGH or len(b.text) >= LONG and stops >= STOP_LOW:
            b.good = True
        elif stops < STOP_LOW and len(b.text) < LONG:
            b.good = False
    decided = [b.good for b in found]
    after: list[bool | None] = [None] * len(found)
    seen = None
    for k in range(len(found) - 1, -1, -1):
        after[k] = seen
        seen = decided[k] if decided[k] is not None else seen
    seen = None
    for k, b in enumerate(found):
        if decided[k] is not None:
            seen = decided[k]
        elif b.tag in HEADINGS:
            b.good = bool(after[k])
        elif seen is None or after[k] is None:
            b.good = bool(seen or after[k]) if seen is not None or after[k] is not None else True
        else:
            b.good = seen if seen == after[k] else len(b.text) >= SHORT


def main_text(page: str | None) -> str:
    page = page or ""
    found = blocks(page)
    if not any(b.inside for b in found) and ARTICLE_TAG.search(page):
        again = blocks(page, around=True)
        found = again if any(b.inside for b in again) else found
    classify(found)
    return "\n\n".join(b.text for b in found if b.good)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    kind = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def texts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            text = [main_text(h) for h in frame.pop("html")]
            yield frame.assign(text=text, n_chars=[len(t) for t in text])

    slim = pages.select(F.col(id_col).alias("key"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return (slim.mapInPandas(texts, f"key {kind[id_col]}, url {kind[url_col]}, text string, n_chars long")
            .withColumnsRenamed({"key": id_col, "url": url_col}))
