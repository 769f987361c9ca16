"""Main text of web pages by block rules in two passes.

A page falls into blocks at its block-level tags. The first pass adds up evidence for each block: its
length, its stop-word density, its link density and what the tags around it say (menus, footers,
forms, adverts, comments and the like speak against it, an article for it, a place outside the page's
articles against it). Enough evidence either way decides the block. In the second pass each block that is
still open, mostly short ones, takes the label of the nearest decided block, of its own region first;
of two as near the one before. The stop words are those of four languages: on a page where no long block
reaches the density they are left out of account, and length and links decide.

Character references are decoded, white space inside a block becomes one space, blocks are joined
by a line break. Rows: NULL or empty pages give empty text. Repeated rows and equal ids keep one
row each. Broken markup never fails: an unclosed tag ends with its parent, a `<` that no tag follows is
text, as is one whose tag isn't closed before the next. Both passes take time in proportion to the page.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

LONG_WORDS, SHORT_WORDS = 20, 8
STOP_DENSITY, FEW_STOPS = 0.12, 0.04   # running text has as many stop words as the first, lists and slogans fewer than the second
LINK_DENSITY = 0.5
GOOD, BAD = 2.0, -1.0   # evidence that decides a block
#: Evidence: words of a long and of a middling block, stop words of running text or too few of them, links, marked tags
#: around it, inside an article, outside the page's articles.
LONG, MIDDLING, RUNNING, SPARSE, LINKED, MARKED, ARTICLE, ELSEWHERE = 1.0, 0.5, 1.0, -1.0, -4.0, -6.0, 1.0, -3.0

# Frequent function words of the languages that pages are written in.
STOP_WORDS = frozenset("""
a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to was
we were which with you
aber als am an auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer eines er es für hat ich
ihr im in ist mit nach nicht oder sich sie sind über um und von war wenn wie wir zu zum zur
al como con de del el ella en entre era es esta este fue ha la las lo los más no o para pero por que se si sin son su sus un
una y ya
au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qu que qui
sa se ses son sont sur un une vous
""".split())
# Tags and words in class, id and role that mark what is not the article.
DROPPED = frozenset("script style noscript template title svg math iframe object canvas select textarea button audio video".split())
OUTSIDE = frozenset("nav footer aside form menu dialog fieldset".split())
BLOCKS = frozenset("""
address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4
h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul
""".split())
NESTED = BLOCKS - {"p", "hr", "h1", "h2", "h3", "h4", "h5", "h6", "body", "html", "head"} | {"td", "th"}
HINTS = frozenset("""
ad ads adsense advert advertisement adverts alert alertdialog banner breadcrumb breadcrumbs comment comments complementary consent
contentinfo cookie cookies copyright dialog disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice
notices overlay pager pagination popup promo promotion promoted recommended related replies reply respond search share sharing
sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget
""".split())
ARTICLE_HINTS = frozenset("comment comments reply replies related promo ad advert sponsored teaser".split())
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/><]*)")
_STOP = re.compile(r"[<>\"']")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_WORD = re.compile(r"[^\W\d_]+")


def _close(page: str, at: int, last: dict[str, bool]) -> int:
    """End of the tag whose attributes begin at `at`; -1 if another tag begins first. `last` notes quotes that don't recur."""
    while m := _STOP.search(page, at):
        if m[0] == ">":
            return m.end()
        if m[0] == "<":
            return -1
        end = -1 if m[0] in last else page.find(m[0], m.end())
        if end < 0:
            last[m[0]] = True   # never closed: an ordinary sign
        at = max(end + 1, m.end())
    return -1


def _tag(page: str, at: int, last: dict[str, bool]) -> tuple[int, int, bool, str, str] | None:
    """The next tag from `at`: begin, end, is it an end tag, name, attributes; a comment or declaration has no name."""
    while (begin := page.find("<", at)) >= 0:
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            return begin, len(page) if end < 0 else end + 3, False, "", ""
        if page[begin + 1:begin + 2] in ("!", "?"):
            end = page.find(">", begin)
            return begin, len(page) if end < 0 else end + 1, False, "", ""
        m = _NAME.match(page, begin)
        if m and (end := _close(page, m.end(), last)) >= 0:
            return begin, end, bool(m[1]), m[2].lower(), page[m.end():end - 1]
        at = begin + 1
    return None


@dataclass
class Block:
    region: int                 # 0 outside any article, else the article's number
    out: bool                   # inside something that is not the article
    parts: list[str] = field(default_factory=list)
    linked: int = 0             # letters inside links
    text: str = ""


def _marked(tag: str, attributes: str) -> bool:
    """Does the tag or its attributes say that its content isn't the article?"""
    if tag in OUTSIDE:
        return True
    if not attributes.strip(" /"):
        return False
    names = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
    if "hidden" in names or names.get("aria-hidden", "").lower() == "true" or re.search(
            r"display\s*:\s*none|visibility\s*:\s*hidden", names.get("style", ""), re.I):
        return True
    if tag in ("html", "body", "main"):
        return False
    said = " ".join(html.unescape(names.get(k, "")) for k in ("class", "id", "role"))
    hints = {w.lower() for w in _NAME_PART.findall(said)}
    return bool(hints & (ARTICLE_HINTS if tag == "article" else HINTS))


def blocks(page: str) -> list[Block]:
    """The page's blocks with text, in order."""
    found: list[Block] = []
    stack: list[tuple[str, bool, int]] = []   # open tags: name, out so far, region
    opened: Counter[str] = Counter()          # how many of each name
    last: dict[str, bool] = {}
    articles, breaks, link, at = 0, 0, False, 0
    endless: set[str] = set()                 # dropped tags without an end tag from here on
    now = Block(0, False)

    def place() -> tuple[bool, int]:
        return (stack[-1][1], stack[-1][2]) if stack else (False, 0)

    def cut() -> None:
        nonlocal now
        if now.parts:
            found.append(now)
        out, region = place()
        now = Block(region, out)

    def put(text: str) -> None:
        nonlocal breaks
        if text.strip():
            breaks = 0
        if link:
            now.linked += len("".join(text.split()))
        now.parts.append(text)

    def enter(name: str, out: bool, region: int) -> None:
        stack.append((name, out, region))
        opened[name] += 1

    def leave() -> str:
        name = stack.pop()[0]
        opened[name] -= 1
        return name

    while at < len(page):
        m = _tag(page, at, last)
        if m is None:
            put(html.unescape(page[at:]))
            break
        begin, end_at, closing, tag, attributes = m
        if begin > at:
            put(html.unescape(page[at:begin]))
        at = end_at
        if not tag:
            continue
        if tag in DROPPED and not closing:
            if not attributes.rstrip().endswith("/"):
                end = None if tag in endless else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                if end is None:
                    endless.add(tag)
                # Without an end tag a script or style takes the rest; another tag is passed over alone.
                at = end.end() if end else len(page) if tag in ("script", "style") else at
            continue
        if tag == "br":
            breaks += 1
            now.parts.append(" ")
            if breaks > 1:
                cut()
            continue
        if tag == "a":
            link = not closing
            continue
        if tag not in BLOCKS and tag not in NESTED:
            if not closing and _marked(tag, attributes) and tag in ("span", "small", "ins", "section"):
                enter(tag, True, place()[1])
                cut()
            elif closing and opened[tag]:
                while leave() != tag:
                    continue
                cut()
            continue
        link = False
        if tag in ("td", "th"):
            now.parts.append(" ")
        if closing:
            if opened[tag]:
                while leave() != tag:
                    continue
        elif tag in NESTED and not attributes.rstrip().endswith("/"):
            if tag in ("article", "main"):
                while stack and stack[-1][0] in (*OUTSIDE, "header", "ul", "ol", "li") and stack[-1][1]:
                    leave()   # a menu that was never closed
            out, region = place()
            if tag in ("article", "main") and not region:
                articles += 1
                region = articles
            enter(tag, out or _marked(tag, attributes) or tag == "header" and not region, region)
        elif _marked(tag, attributes):
            cut()
            now.out = True
            continue
        if tag not in ("td", "th"):
            cut()
    cut()
    for block in found:
        block.text = " ".join("".join(block.parts).split())
    return [b for b in found if b.text]


def evidence(found: list[Block]) -> list[float]:
    """First pass: how much speaks for each block being part of the main text."""
    words = [[w.lower() for w in _WORD.findall(b.text)] for b in found]
    density = [sum(w in STOP_WORDS for w in own) / max(1, len(own)) for own in words]
    covered = any(len(own) >= LONG_WORDS and d >= STOP_DENSITY and not b.out for own, d, b in zip(words, density, found, strict=True))
    article = any(b.region and not b.out for b in found)
    out = []
    for b, own, d in zip(found, words, density, strict=True):
        long = len(own) >= LONG_WORDS
        total = LONG if long else MIDDLING if len(own) >= SHORT_WORDS else 0.0
        if covered:
            total += RUNNING if d >= STOP_DENSITY and len(own) >= SHORT_WORDS else SPARSE if d < FEW_STOPS and long else 0.0
        elif long:
            total += RUNNING
        total += LINKED * (b.linked > LINK_DENSITY * max(1, len(b.text.replace(" ", "")))) + MARKED * b.out
        out.append(total + (ARTICLE if b.region else ELSEWHERE if article else 0.0))
    return out


def labels(found: list[Block]) -> list[bool]:
    """Is each block part of the main text?"""
    first = [True if e >= GOOD else False if e <= BAD else None for e in evidence(found)]
    before, after = _nearest(found, first, range(len(found))), _nearest(found, first, range(len(found) - 1, -1, -1))
    decided = any(label is not None and not b.out for label, b in zip(first, found, strict=True))
    out = []
    for k, label in enumerate(first):
        for same in (0, 1) if label is None else ():
            near = [j for j in (before[k][same], after[k][same]) if j is not None]
            if near:
                label = first[min(near, key=lambda j: (abs(j - k), j))]
                break
            if found[k].region:
                label = True   # nothing in its article is decided
                break
        out.append(not decided if label is None else label)
    return out


def _nearest(found: list[Block], first: list[bool | None], order: range) -> list[tuple[int | None, int | None]]:
    """The last decided block met before each one in this order that isn't marked as outside: of its region, and of any."""
    of: dict[int, int] = {}
    anywhere = None
    out: list[tuple[int | None, int | None]] = [(None, None)] * len(found)
    for k in order:
        out[k] = of.get(found[k].region), anywhere
        if first[k] is not None and not found[k].out:
            of[found[k].region] = anywhere = k
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = blocks(page)
    return "\n".join(b.text for b, good in zip(found, labels(found), strict=True) if good)


def extracted(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """`row` (the page's columns without the markup), text and n_chars."""
    given = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns if c != html_col]).alias("row"),
                         F.col(f"`{html_col}`").alias("html"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                  names=["row", "text", "n_chars"])

    return given.mapInArrow(extract, given.select("row", F.lit("").alias("text"), F.lit(0).cast("bigint").alias("n_chars")).schema)
