"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped so that every block element is a line: scripts, styles, comments and the like
vanish, block tags and ``br`` end a line, other tags leave no trace, character references are
decoded, and white space inside a line becomes one space. Markup then weighs the lines: those of page
furniture (menus, headers, footers, sidebars, notices, adverts, forms and reader comments, told by
element, role, or a class or id that says nothing else, or by being almost all links) count nothing; others count their length.

Where a page does not name its article, the weights of ``WINDOW`` lines in a row are summed. A stretch of lines runs from where
the sums leave zero to where they dive back to it. It surges if one of its sums is more than ``SURGE``
of the page's largest, and the lines of stretches that surge are the text. A stretch that does not surge
is kept only between kept ones, or where it has a line in the same container as one (the innermost block
that is not itself a kind of paragraph); so short paragraphs stay and stray lines go.

Where a page does name it (``article``, ``main`` or an articleBody), the lines outside count nothing and no stretch
within is given up: a closing remark after an aside is as much of the article as its longest paragraph,
and line lengths cannot tell it from furniture.

Rules: null and empty pages give an empty text; unclosed and stray tags are put up with; text of any
length is worked through once, from start to end; repeated rows are extracted each; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from seqloom.llm.common import table, text_batches

WINDOW = 3
#: A stretch surges above this part of the page's largest sum.
SURGE = 0.05
LINKED = 0.6

# Element names and the words of classes and ids that mark page furniture.
HIDDEN = "script style noscript template svg math iframe object canvas head select textarea title"
FURNITURE = "nav header footer aside form menu dialog button fieldset"
ARTICLE = "article main"
BLOCKS = (
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul video"
)
PARAGRAPHS = "p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre address br hr"
VOID = "area base br col embed hr img input link meta param source track wbr"
ROLES = "navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog"
FURNITURE_WORDS = (
    "ad ads advert advertisement adverts adbox banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus disclaimer footer header "
    "login masthead menu modal nav navbar navigation newsletter notice notices notification outbrain pagination pager popup promo promoted recommended related "
    "replies reply respond rss search share sharing sidebar signup skip social sponsor sponsored subscribe taboola toolbar widget"
)

_HIDDEN, _FURNITURE, _ARTICLE, _BLOCKS, _VOID, _ROLES = (frozenset(x.split()) for x in (HIDDEN, FURNITURE, ARTICLE, BLOCKS, VOID, ROLES))
# Words that say where something is or how it is laid out, and so nothing against the others of its name.
LAYOUT_WORDS = "area bar block body bottom box buttons column container content footer form global group header icons inner item items left links list main module outer page panel primary right secondary section site small text top widget wrap wrapper"

_WORDS = frozenset(FURNITURE_WORDS.split())
_LAYOUT = frozenset(LAYOUT_WORDS.split())
_CONTAINERS = _BLOCKS - frozenset(PARAGRAPHS.split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]+|=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|[=\"'])*)>?", re.S)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|itemprop|hidden|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_SPACE = re.compile(r"\s+")
_RAW_ENDS = {name: re.compile(rf"</{name}[\s/>]", re.I) for name in ("script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "math", "object", "canvas", "select")}


def _furniture_name(name: str, within: bool) -> bool:
    """Whether a class or id names furniture: one of its words does, and the others only say where or how."""
    words = [x for x in re.split(r"[^a-z]+", name) if x]
    marking = _WORDS - {"header"} if within else _WORDS
    return any(x in marking for x in words) and all(x in marking or x in _LAYOUT for x in words)


def _marks(attributes: str, within: bool) -> tuple[bool, bool]:
    """Whether attributes mark furniture, and whether they mark the article (``within`` it, headers are its own)."""
    furniture = article = False
    for name, value in _ATTRIBUTE.findall(attributes):
        value = value.strip("\"'").lower()
        name = name.lower()
        if name in ("class", "id"):
            furniture |= any(_furniture_name(x, within) for x in value.split())
        elif name == "role":
            furniture |= value in _ROLES
            article |= value in ("main", "article")
        elif name == "itemprop":
            article |= value == "articlebody"
        elif name == "hidden" or value == "true":
            furniture = True
    return furniture, article


def lines_of(page: str) -> list[tuple[str, int, bool, bool, int]]:
    """(text, characters in links, furniture, article, container) of every line of the page, empty ones left out."""
    out: list[tuple[str, int, bool, bool, int]] = []
    stack: list[tuple[str, bool, bool, int]] = []  # name, furniture, article, container around it
    container = opened = 0
    parts: list[str] = []
    linked = links = 0
    furniture = article = 0
    at, end = 0, len(page)

    def close() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            out.append((text, linked, furniture > 0, article > 0, container))
        parts.clear()
        linked = 0

    def text(a: int, b: int) -> None:
        nonlocal linked
        if b > a:
            parts.append(page[a:b])
            if links:
                linked += b - a

    while at < end:
        found = _TOKEN.search(page, at)
        if not found:
            text(at, end)
            break
        text(at, found.start())
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if name in _BLOCKS or name in _HIDDEN:
            close()
        if found[1]:  # an end tag closes what was opened since; a stray one closes nothing
            if name == "a":
                links = 0
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if any(f or a for _, f, a, _ in stack[k:]):
                        close()
                    container = stack[k][3]
                    for _, f, a, _ in stack[k:]:
                        furniture -= f
                        article -= a
                    del stack[k:]
                    break
            continue
        if name in _RAW_ENDS:
            closed = found[3].endswith("/")
            if closed and name in ("svg", "math"):
                continue
            stop = _RAW_ENDS[name].search(page, at)
            if closed and not stop:  # written as closed, and nothing else closes it
                continue
            at = page.find(">", stop.start()) + 1 or end if stop else end
            continue
        if name == "a":
            links = 1
        if name in _VOID or name not in _BLOCKS and name not in _HIDDEN and "class" not in found[3] and "id" not in found[3] and "role" not in found[3] and "hidden" not in found[3]:
            continue
        f, a = _marks(found[3], article > 0) if found[3] else (False, False)
        if name in ("html", "body"):  # page-wide classes say nothing about a part
            f = a = False
        f |= name in _FURNITURE and not (name == "header" and article)
        a |= name in _ARTICLE
        if name == "p":  # a paragraph ends the one before it
            while stack and stack[-1][0] == "p":
                furniture -= stack[-1][1]
                article -= stack[-1][2]
                stack.pop()
        if f or a:
            close()
        stack.append((name, f, a, container))
        if name in _CONTAINERS:
            container = opened = opened + 1
        furniture += f
        article += a
    close()
    return out


def stretches(size: Sequence[int]) -> list[tuple[int, int, int]]:
    """(first line, line after the last, largest sum) between each rise of the sums of ``WINDOW`` lines from zero and the dive back to it."""
    edge = np.zeros(WINDOW, np.int64)  # empty lines around the page, so that its ends are dives
    sums = np.convolve(np.concatenate([edge, np.asarray(size, np.int64), edge]), np.ones(WINDOW, np.int64), "valid")
    up = np.nonzero((sums[1:] > 0) & (sums[:-1] == 0))[0] + 1
    down = np.nonzero((sums[1:] == 0) & (sums[:-1] > 0))[0] + 1
    # the line that a rising block took in is its last one; the one that a diving block lost is that before it
    return [(a - 1, b - WINDOW, int(sums[a:b].max())) for a, b in zip(up.tolist(), down.tolist(), strict=True)]


def kept_stretches(size: Sequence[int], containers: Sequence[int]) -> list[tuple[int, int]]:
    """(first line, line after the last) of the stretches that are text."""
    found = stretches(size)
    top = max((most for _, _, most in found), default=0)
    own = [{containers[k] for k in range(a, b) if size[k]} for a, b, _ in found]
    shared = set().union(*(c for c, (_, _, most) in zip(own, found, strict=True) if most > SURGE * top))
    near = [k for k, c in enumerate(own) if c & shared]
    return [(a, b) for a, b, _ in found[near[0] : near[-1] + 1]] if near else []


def main_text(page: str | None) -> str:
    """The article's lines where the page names it, else those between surges and dives of the line-block distribution."""
    lines = lines_of(page or "")
    named = any(a and not f for _, _, f, a, _ in lines)
    size = [0 if furniture or (not article if named else linked > LINKED * len(text)) else len(text) for text, linked, furniture, article, _ in lines]
    kept = [(0, len(lines))] if named else kept_stretches(size, [line[4] for line in lines])
    return " ".join(lines[k][0] for a, b in kept for k in range(a, b) if size[k])


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [main_text(page) for page in batch["html"]]
        yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages`` (page_id, url, html)."""
    text_batches(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInPandas(_extract, "page_id long, url string, text string, n_chars long")


def op3_line_blocks(spark, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
