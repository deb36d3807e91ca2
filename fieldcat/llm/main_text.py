"""Main text of web pages by line-block distribution.

Markup is stripped into lines: one line for each block's text, white space inside it turned
into one space, character references decoded. What no reader of the article reads never makes
a line: scripts, styles, comments in markup, hidden elements, forms, menus, page headers and
footers, sidebars, notices, adverts, share bars and reader comments, told by their elements,
roles and class or id words. Such an element outside the article, and every border of a page's
parts, leaves empty lines in its place; text in links weighs nothing.

Then the weights of lines are summed over sliding windows of ``WINDOW`` lines. A region is a
stretch of lines whose windows never sum to zero; the surge point is the first line whose
window reaches a part of the page's peak, the dive point the last one, and all text between
them is kept, with the lines in one run or one part of the page with it: an article's short
paragraphs stay.
Where a page marks its article (``article``, else ``main`` or an equal role), only lines inside
weigh, and what is left out inside leaves no empty lines.

Defined results: a null or empty page, and one without text, gives an empty text. A page whose
text lies all in links keeps none unless its article is marked. Rows given twice give equal
rows; null ids and urls are kept; pages are read whole, however long; an empty table gives an
empty result. Columns other than those named are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcat.llm.support import text_pieces

#: Lines of a window.
WINDOW = 3
#: A window surges from this part of the page's peak on.
PEAK_PART = 6

# Elements and words of web pages.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style noscript template iframe textarea title svg object select noframes xmp".split())
_BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
             "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_PART = set("article aside body dialog div fieldset footer form header main menu nav section table".split())
_SKIP = set("nav aside footer form dialog menu button label fieldset canvas audio video head".split())
_SKIP_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_SKIP_WORDS = set("ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
                  "notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar sidebars aside menu menus nav navbar "
                  "navigation breadcrumb breadcrumbs footer pagination pager comment comments commentlist reply replies respond disqus "
                  "share sharing social related recommended recommendations widget widgets copyright hidden skip".split())
_PAGE_HEADERS = set("header masthead topbar toolbar".split())
_MARKS = set("has with no without".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(text)}


def _unwanted(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether an element holds text beside the article."""
    if tag in _SKIP or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I):
        return True
    role = attributes.get("role", "").lower()
    if role in _SKIP_ROLES and not (role == "banner" and in_article):
        return True
    if tag == "main":
        return False
    words = _SKIP_WORDS if in_article else _SKIP_WORDS | _PAGE_HEADERS
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        parts = [p.lower() for p in re.split(r"[-_]+|(?<=[a-z])(?=[A-Z])", name) if p]
        if parts and parts[0] not in _MARKS and (parts[0] in words or parts[-1] in words):
            return True
    return False


def page_lines(page: str) -> list[tuple[str, int, int, int]]:
    """(text, weight, article, part) of a page's lines: ``weight`` counts the characters outside
    links, ``article`` is 2 in ``article``, 1 in ``main``, else 0, ``part`` numbers the page's
    parts (the innermost one that holds the line)."""
    lines: list[tuple[str, int, int, int]] = []
    stack: list[tuple[str, bool, int, int]] = []  # (element, unwanted, article, part)
    parts: list[str] = []
    linked = out = links = 0
    depth = part = count = 0

    def flush() -> None:
        nonlocal linked
        # a reference may stand next to white space: decode first, then close up
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            lines.append((text, len(text) if linked * 2 < len(text) else 0, depth, part))
        parts.clear()
        linked = 0

    def border(empty: int) -> None:
        lines.extend([("", 0, depth, part)] * empty)

    def close(to: int) -> None:
        nonlocal out, links, depth, part
        while len(stack) > to:
            tag, unwanted, article, _ = stack.pop()
            if tag in _BLOCK and not out:
                flush()
            out -= unwanted
            links -= tag == "a"
            depth = max((s[2] for s in stack), default=0)
            part = stack[-1][3] if stack else 0
            if unwanted and not out and not depth:
                border(WINDOW)
            elif tag in _PART and not out and not depth:
                border(WINDOW - 1)

    at, skip = 0, None
    for token in _TOKEN.finditer(page):
        if token.start() < at:
            continue
        if not out and token.start() > at:
            parts.append(page[at:token.start()])
            linked += (token.start() - at) if links else 0
        at = token.end()
        tag = (token.group(2) or "").lower()
        if not tag:
            continue
        if token.group(1):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
            else:
                if tag in _BLOCK and not out:
                    flush()
            continue
        if tag in _RAW:
            skip = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|$)", re.I)
            end = skip.search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in _BLOCK:
            # a block ends an open paragraph; an item or cell ends the one before
            ended = {"p"} | ({tag} if tag in ("li", "dt", "dd", "td", "th", "tr", "option") else set())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ended:
                    close(i)
                    break
                if stack[i][0] in _PART or stack[i][0] in ("ul", "ol", "td", "th", "li", "dl", "blockquote"):
                    break
            if not out:
                flush()
        elif tag in ("br", "img", "wbr", "input") and not out:
            parts.append(" " if tag == "br" else "")
        if tag in _VOID:
            continue
        attributes = _attributes(token.group(3)) if token.group(3).strip(" /") else {}
        unwanted = _unwanted(tag, attributes, depth > 0)
        if not out and not depth and (unwanted or tag in _PART):
            if unwanted:
                flush()
            border(WINDOW if unwanted else WINDOW - 1)
        article = 0 if out or unwanted else 2 if tag == "article" or attributes.get("role") == "article" or attributes.get("itemprop") == "articleBody" \
            else 1 if tag == "main" or attributes.get("role") == "main" else 0
        if tag in _PART:
            count += 1
            part = count
        stack.append((tag, unwanted, article, part))
        out += unwanted
        links += tag == "a"
        if article > depth:
            border(WINDOW)
            depth = article
    if not out and at < len(page):
        parts.append(page[at:])
    flush()
    return lines


def main_lines(weight: np.ndarray, page: np.ndarray, filled: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Whether each line lies between its page's surge and dive points. ``weight``, ``page``
    (rising numbers), ``filled`` (line holds text) and ``part`` of the lines of many pages."""
    if not len(weight):
        return np.zeros(0, bool)
    n = len(weight)
    pages = int(page[-1]) + 1
    start = np.searchsorted(page, np.arange(pages))
    end = np.searchsorted(page, np.arange(pages), side="right")
    total = np.concatenate([[0], np.cumsum(weight)])
    line = np.arange(n)
    ahead = total[np.minimum(line + WINDOW, end[page])] - total[line]
    behind = total[line + 1] - total[np.maximum(line + 1 - WINDOW, start[page])]
    reach = np.maximum(ahead, behind)
    peak = np.zeros(pages, np.int64)
    np.maximum.at(peak, page, reach)
    # regions: windows that begin in them never sum to zero
    empty = (reach == 0) | np.concatenate([[True], page[1:] != page[:-1]])
    region = np.cumsum(empty)
    surging = (reach * PEAK_PART >= peak[page]) & (peak[page] > 0) & filled & (weight > 0)
    low, high = np.full(region[-1] + 1, n), np.full(region[-1] + 1, -1)
    np.minimum.at(low, region[surging], line[surging])
    np.maximum.at(high, region[surging], line[surging])
    # runs (lines without an empty one between) and parts that hold a surging line stay whole
    run = np.cumsum(~filled | np.concatenate([[True], page[1:] != page[:-1]]))
    keep = (line >= low[region]) & (line <= high[region])
    for group in (run, part):
        touched = np.zeros(group.max() + 1, bool)
        touched[group[surging]] = True
        keep |= touched[group]
    return filled & keep


def extract_texts(pages: list[str | None]) -> list[str]:
    """The main text of each page."""
    text, weight, filled, page, part, parts = [], [], [], [], [], 0
    for i, source in enumerate(pages):
        lines = page_lines(source) if source else []
        best = max((article for line, _, article, _ in lines if line), default=0)
        for line, size, article, number in lines:
            part.append(parts + number)
            inside = bool(line) and article == best
            text.append(line)
            # where the article is marked, all its lines weigh
            weight.append(0 if not inside else len(line) if best else size)
            filled.append(inside)
            page.append(i)
        parts += max((number for *_, number in lines), default=0) + 1
    kept = main_lines(np.array(weight, np.int64), np.array(page, np.int64), np.array(filled, bool), np.array(part, np.int64))
    out: list[list[str]] = [[] for _ in pages]
    for i in np.flatnonzero(kept).tolist():
        out[page[i]].append(text[i])
    return ["\n".join(x) for x in out]


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_pieces(batch, "html"):
                texts = extract_texts(piece.column("html").to_pylist())
                yield pa.RecordBatch.from_arrays([piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.mapInArrow(run, f"page_id {kind['page_id']}, url {kind['url']}, text string").withColumn("n_chars", F.char_length("text").cast("long"))
