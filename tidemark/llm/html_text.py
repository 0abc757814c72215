"""Main text of web pages by the distribution of text over line blocks."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3  # lines in a block
GAP = 4  # empty lines that stand for a part of the page that is left out; more than a block
SHARE = 0.5  # a further run of blocks is kept if its peak has this share of the highest one ...
PLAIN = 80  # ... and this many characters

# Elements of HTML, and the names that pages commonly give to parts around the text.
RAW = "script style noscript template textarea svg iframe object canvas title".split()
AROUND = "nav header footer aside form menu dialog button select head".split()
BLOCKS = (
    "address article blockquote body br caption center dd details dir div dl dt fieldset figcaption figure h1 h2 h3 "
    "h4 h5 h6 hr html li main ol p pre section summary table tbody td tfoot th thead tr ul"
).split()
HOLDERS = "article center dd details div fieldset main section td th".split()  # text in or between paragraphs of one is one flow
VOID = "area base br col embed hr img input link meta source track wbr".split()
NAMES = (
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer footer header legal login masthead menu modal nav navbar navigation newsletter notice notices pager "
    "pagination popup promo promoted recommended related reply replies respond share sharing sidebar signup social "
    "sponsor sponsored subscribe tags toolbar widget"
).split()
ROLES = "navigation banner contentinfo complementary search dialog alert form menu".split()

# Words that, next to one of these names, say where a part stands or what holds it.
PLACES = (
    "area article bar block bottom box col column container entry global group inner item left links list main mobile "
    "outer page panel post posts primary right secondary section site small sticky top wrap wrapper"
).split()

_OPEN = re.compile(r"<(?:(!--)|[!?]|(/?)([a-zA-Z][a-zA-Z0-9:-]*))")
_STOP = re.compile(r"[\"'>]")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_PART = re.compile(r"[a-z0-9]+")
_SPACE = re.compile(r"\s+")
_NAMES, _KNOWN = set(NAMES), {*NAMES, *PLACES}


class _Page:
    """Markup from left to right, in time that grows with the page: no place is looked at again and again."""

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.quoted = True  # whether ">" in quoted values is part of them; not on a page where they never end
        self.closed = {'"': True, "'": True}  # whether a further sign of this kind may come

    def tag_end(self, at: int) -> int:
        """Place of the ">" that ends the tag, -1 if none does."""
        page, start = self.page, at
        if at > self.last:
            return -1
        while self.quoted and (stop := _STOP.search(page, at)):
            sign, at = stop[0], stop.end()
            if sign == ">":
                return stop.start()
            before = stop.start() - 1
            while page[before].isspace():
                before -= 1
            if page[before] == "=" and self.closed[sign]:
                close = page.find(sign, at)
                self.closed[sign] = close >= 0
                at = close + 1 if close >= 0 else at
        self.quoted = False
        return page.find(">", start)

    def tags(self) -> Iterator[tuple[int, int, str, bool, str, bool]]:
        """Begin, end, name, whether it closes, attributes, whether it is empty; "" for what is no element or no text."""
        page, at = self.page, 0
        while tag := _OPEN.search(page, at):
            begin, name = tag.start(), (tag[3] or "").lower()
            if tag[1]:
                end = page.find("-->", tag.end())
                at = len(page) if end < 0 else end + 3
                yield begin, at, "", False, "", False
                continue
            end = self.tag_end(tag.end()) if name else page.find(">", tag.end()) if tag.end() <= self.last else -1
            if end < 0 and not name:
                at = tag.end()
                continue
            if end < 0:  # cut off
                yield begin, len(page), "", False, "", False
                return
            attributes = page[tag.end() : end]
            alone = attributes.endswith("/") or name in VOID
            at = end + 1
            if name in _RAW_END and not tag[2] and not (name == "svg" and alone):
                close = _RAW_END[name].search(page, at)
                end = page.find(">", close.end()) if close else -1
                at = len(page) if end < 0 else end + 1
                name = ""
            yield begin, at, name, bool(tag[2]), attributes, alone


def _is_around(name: str, attributes: str, inside_article: bool, by_name: bool) -> bool:
    """Whether an element holds something around the main text. A header of the article itself does not."""
    if name in AROUND and not (name == "header" and inside_article):
        return True
    if not by_name or not attributes or name in ("html", "body", "article", "main"):
        return False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value in ROLES:
            return True
        if key in ("class", "id") and any(_says_around(word, inside_article) for word in value.split()):
            return True
    return False


def _says_around(word: str, inside_article: bool) -> bool:
    """A class or id made of such names alone: ``cookie-notice``, ``site-header``, but not ``no-ads`` or ``related-work``."""
    parts = [x for x in _PART.findall(word) if not x.isdigit()]
    found = _NAMES.intersection(parts) - ({"header"} if inside_article else set())
    return bool(found) and _KNOWN.issuperset(parts)


def lines_of(page: str, by_name: bool = True) -> tuple[list[str], list[int]]:
    """The page without markup, a line per block, and the number of the element that holds each line.

    A part that is left out is a gap of empty lines, held by nothing (-1), as is a line of the body itself (0)
    where the page has an article. ``by_name`` leaves out parts by their class, id and role too, not by their
    element alone.
    """
    lines: list[str] = []
    holders: list[int] = []
    within: list[tuple[str, int]] = [("body", 0)]  # open holders
    opened = 0
    articles = False
    text: list[str] = []
    around, depth = "", 0  # the element that is left out, and how many of its name are open
    article = 0
    at = 0
    count: Counter[str] = Counter()  # open holders by name

    def end_line() -> None:
        line = _SPACE.sub(" ", html.unescape("".join(text))).strip()
        text.clear()
        if line:
            lines.append(line)
            holders.append(within[-1][1])

    def gap() -> None:
        lines.extend([""] * GAP)
        holders.extend([-1] * GAP)

    def enter(name: str) -> None:
        nonlocal opened
        opened += 1
        within.append((name, opened))
        count[name] += 1

    def leave(name: str) -> None:
        if count[name]:
            left = ""
            while left != name:
                left = within.pop()[0]
                count[left] -= 1

    for begin, end, name, closing, attributes, alone in _Page(page).tags():
        if not around:
            text.append(page[at:begin])
        at = end
        if not name:
            continue
        if around:
            if name == around:
                depth += -1 if closing else not alone
                around = around if depth else ""
            elif name in ("article", "main") and not closing and around not in ("article", "main"):
                around = ""  # a part that was never closed ends where the text starts
                article += 1
                articles = True
                enter(name)
            elif closing and name in ("body", "html"):
                around = ""
            continue
        if name in ("article", "main"):
            article = max(0, article + (-1 if closing else 1))
        if not closing and not alone and _is_around(name, attributes, article > 0, by_name):
            end_line()
            if not article:
                gap()
            around, depth = name, 1
        elif name in BLOCKS or name in AROUND:
            end_line()
            if name in ("article", "main"):
                articles = True
                gap()
            if name in HOLDERS:
                if closing:
                    leave(name)
                elif not alone:
                    enter(name)
    if not around:
        text.append(page[at:])
        end_line()
    return lines, [-1 if articles and not x else x for x in holders]


def main_text(page: str | None) -> str:
    """The lines between surge and dive points, joined by one blank.

    A block's length is the text in ``WINDOW`` lines from a line on. A run of lines starts where that length
    surges from nothing and ends where it dives to nothing again. The run with the highest block is kept, and
    so are others whose highest block comes near it: articles may be cut by something that is left out. An
    element that holds a line of a kept run holds the text: all runs from its first line to its last are kept.
    """
    lines, holders = lines_of(page) if page else ([], [])
    if page and not any(lines):  # a name around the whole page says nothing about its parts
        lines, holders = lines_of(page, by_name=False)
    length = [len(x) for x in lines] + [0] * WINDOW
    block = [sum(length[i : i + WINDOW]) for i in range(len(lines))]
    runs, start = [], None
    for i, size in enumerate([*block, 0]):
        if size and start is None:
            start = i
        elif not size and start is not None:
            runs.append((max(block[start:i]), start, i))
            start = None
    highest = max((peak for peak, _, _ in runs), default=0)
    kept = _whole([peak == highest or peak >= PLAIN and peak >= SHARE * highest for peak, _, _ in runs], [set(holders[a:b]) - {-1} for _, a, b in runs])
    return " ".join(x for (_, a, b), stays in zip(runs, kept, strict=True) if stays for x in lines[a:b] if x)


def _whole(kept: list[bool], held_by: list[set[int]]) -> list[bool]:
    """The runs kept, with those between the first and the last run of every element that holds some of a kept one."""
    spans: dict[int, tuple[int, int]] = {}
    for i, found in enumerate(held_by):
        for one in found:
            spans[one] = spans.get(one, (i, i))[0], i
    out, todo = list(kept), [i for i, stays in enumerate(kept) if stays]
    while todo:
        for one in held_by[todo.pop()]:
            first, last = spans.pop(one, (0, -1))
            for i in range(first, last + 1):
                if not out[i]:
                    out[i] = True
                    todo.append(i)
    return out


def extract_text(pages: DataFrame, markup: str = "html", key: str = "page_id") -> DataFrame:
    """page_id, url, text, n_chars of every page.

    NULL or empty markup, and markup without text, give the empty text; markup that was cut off is read as far
    as it goes; repeated rows are answered each; other columns are not looked at; no pages, no rows. One scan,
    no shuffle; a task holds one batch of pages.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [main_text(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "page_id": batch.column("page_id"),
                    "url": batch.column("url"),
                    "text": pa.array(found, pa.string()),
                    "n_chars": pa.array(map(len, found), pa.int64()),
                }
            )

    rows = pages.select(F.col(key).cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col(markup).alias("html"))
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
