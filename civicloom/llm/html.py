"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element; menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and reader comments leave empty lines. Lengths of text are summed
over windows of a few lines. The main text starts where the sums surge, ends where they dive for
the last time, and all lines between are kept. From there it grows over the text beside it, however
short, until links or a gap. Sums surge at a fixed length or, where lines are shorter, at their
median, weighted by the logarithms of the lengths: one huge paragraph does not raise it. The sums
decide on every page; an article or main element is a check afterwards of what they picked.

Classes and ids name furniture less reliably than elements do: a block that they name stays if most
of the page's text, and all of it under an article or main element, stands in it.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html import unescape
from math import log1p

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lines of a window, the line itself in the middle.
WINDOW = 3
# Characters at which the sum of a window counts as surged, unless most lines are shorter.
SURGE = 86

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    r"(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|[^>]*(?:>|\Z))",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z0-9]+")

_RAW = frozenset({"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript"})
_VOID = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
                   "source", "track", "wbr"})
_INLINE = frozenset({
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font",
    "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span",
    "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"})
_DROPPED = frozenset({
    "aside", "audio", "button", "canvas", "datalist", "dialog", "footer", "form", "head", "header", "iframe",
    "input", "map", "menu", "nav", "noembed", "noframes", "noscript", "object", "script", "select", "style",
    "svg", "template", "textarea", "title", "video"})
_DROPPED_ROLES = frozenset({"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form",
                            "menu", "menubar", "navigation", "search", "toolbar"})
# Words of a class or id that name page furniture.
_FURNITURE = frozenset({
    "ad", "ads", "adsense", "advert", "advertisement", "adverts", "aside", "banner", "breadcrumb",
    "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disclaimer", "disqus", "footer",
    "form", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "notices", "notification", "pagination", "paywall", "popup", "promo",
    "promotion", "related", "replies", "reply", "search", "share", "sharing", "sidebar", "signup", "social",
    "sponsor", "sponsored", "subscribe", "subscription", "teaser", "toolbar", "widget"})
_REPLIES = frozenset({"comment", "comments", "disqus", "replies", "reply"})
# Words that turn a name into a property: "no-sidebar", "has-header".
_PROPERTY = frozenset({"has", "no", "with", "without"})
# Elements that a slash closes.
_FOREIGN = frozenset({"svg", "math"})
_MARKS = {"main": 1, "article": 2}
# Elements that hold the whole page: their classes say something about it, not what they are.
_FRAMES = frozenset({"html", "body", "article", "main"})


@dataclass
class Line:
    text: str
    length: int
    mark: int  # 2 within an article, 1 within main, else 0
    block: int = 0  # innermost block that a class or id calls furniture, 0 for none

    @property
    def is_links(self) -> bool:
        """Whether most of the line's text stands in links."""
        return 2 * self.length < len(self.text)


def _furniture(name: str, rest: str, by_class: bool) -> tuple[bool, bool]:
    """Whether an element goes whatever it holds, and whether its class or id calls it furniture."""
    if name in _DROPPED:
        return True, False
    if not rest or "=" not in rest and "hidden" not in rest:
        return False, False
    words: set[str] = set()
    for match in _ATTRIBUTE.finditer(rest):
        attribute = match[1].lower()
        value = (match[2] or match[3] or match[4] or "").lower()
        if attribute == "hidden" or attribute == "aria-hidden" and value == "true":
            return True, False
        if attribute == "style" and "display:none" in value.replace(" ", ""):
            return True, False
        if attribute == "role" and value in _DROPPED_ROLES:
            return True, False
        if attribute in ("class", "id"):
            for given in value.split():
                found = _WORD.findall(given)
                if _PROPERTY.isdisjoint(found):
                    words.update(found)
    if not by_class:
        return False, False
    if not words.isdisjoint(_REPLIES):
        return True, False
    return False, name not in _FRAMES and not words.isdisjoint(_FURNITURE)


def _without_furniture(lines: list[Line], parents: list[int]) -> list[Line]:
    """``lines`` without the blocks that classes call furniture, each of which leaves an empty line.
    ``parents`` has the block around each block. A block's last line is empty."""
    total, marked = [0] * len(parents), [0] * len(parents)
    for line in lines:
        total[line.block] += line.length
        marked[line.block] += line.length if line.mark else 0
    for block in range(len(parents) - 1, 0, -1):  # a block comes after the one around it
        total[parents[block]] += total[block]
        marked[parents[block]] += marked[block]
    gone = [0] * len(parents)  # the outermost furniture around a block's lines
    for block in range(1, len(parents)):
        stays = 2 * total[block] > total[0] and marked[block] == marked[0]
        gone[block] = gone[parents[block]] or (0 if stays else block)
    last = {line.block: k for k, line in enumerate(lines)}
    return [line for k, line in enumerate(lines)
            if (gone[line.block] == line.block and last[line.block] == k if gone[line.block]
                else not line.block or last[line.block] != k)]


def page_lines(html: str, by_class: bool = True) -> list[Line]:
    """The page as lines of stripped text. A dropped element leaves one empty line; the ends of
    other blocks leave none."""
    lines: list[Line] = []
    parts: list[str] = []
    state = {"links": 0, "linked": 0}
    stack: list[tuple[str, bool, int, bool]] = []  # name, dropped, mark, whether a block of its own
    opened: Counter[str] = Counter()  # names in the stack
    dropped, open_marks = 0, [0, 0, 0]
    block, parents = 0, [0]

    def mark() -> int:
        return 2 if open_marks[2] else 1 if open_marks[1] else 0

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            lines.append(Line(text, max(0, len(text) - state["linked"]), mark(), block))
        parts.clear()
        state["linked"] = 0

    def add(raw: str) -> None:
        if raw and not dropped:
            text = unescape(raw)
            parts.append(text)
            if state["links"]:
                state["linked"] += len(text.strip())

    def close(place: int) -> None:
        nonlocal dropped, block
        while len(stack) > place:
            name, was_dropped, was_mark, was_block = stack.pop()
            opened[name] -= 1
            if name not in _INLINE:
                flush()
            dropped -= was_dropped
            if was_dropped and not dropped or was_block:
                lines.append(Line("", 0, mark(), block))
            if was_block:
                block = parents[block]
            open_marks[was_mark] -= 1
            state["links"] -= name == "a"

    def close_last(name: str) -> None:
        """Close the innermost element of a name, which is open, and all within it."""
        place = len(stack) - 1
        while stack[place][0] != name:
            place -= 1
        close(place)

    at, end = 0, len(html)
    while at < end:
        match = _TOKEN.search(html, at)
        if match is None:
            add(html[at:])
            break
        add(html[at:match.start()])
        at = match.end()
        if match["name"] is None:
            continue
        name, rest = match["name"].lower(), match["rest"].rstrip(">")
        if match["end"]:
            if opened[name]:
                close_last(name)
            elif name not in _INLINE:
                flush()
            continue
        if name == "body":
            close(0)
        if name == "a" and opened[name]:  # links do not nest
            close_last(name)
        if name not in _INLINE:
            flush()
        if name in _RAW:
            closing = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
            at = closing.end() if closing else end
            continue
        if name in _VOID or name in _FOREIGN and rest.endswith("/"):
            continue
        is_dropped, is_block = _furniture(name, rest, by_class)
        if is_block and (dropped or name in _INLINE):  # an inline element is part of a line
            is_dropped, is_block = True, False
        own_mark = 0 if is_dropped or dropped else _MARKS.get(name, 0)
        stack.append((name, is_dropped, own_mark, is_block))
        opened[name] += 1
        if is_block:
            parents.append(block)
            block = len(parents) - 1
        dropped += is_dropped
        open_marks[own_mark] += 1
        state["links"] += name == "a"
    close(0)
    flush()
    return _without_furniture(lines, parents)


def _median(values: list[tuple[float, float]]) -> float:
    """Of ``(value, weight)``, the value that half of the weight does not exceed."""
    values.sort()
    rest = sum(weight for _, weight in values) / 2
    for value, weight in values:
        rest -= weight
        if rest <= 0:
            break
    return value


def between_surge_and_dive(lines: list[Line]) -> tuple[int, int]:
    """First and last line between surge and dive, as a half-open range; empty if there is none."""
    rows = [k for k, line in enumerate(lines) if line.text]
    if not rows:
        return 0, 0
    # Windows run over lines that have text, and over the gaps that dropped elements leave.
    padded = [0] * (WINDOW // 2) + [line.length for line in lines] + [0] * (WINDOW // 2)
    sums = [sum(padded[k:k + WINDOW]) for k in range(len(lines))]
    told = [k for k in rows if not lines[k].is_links]
    if not told:
        return rows[0], rows[-1] + 1  # nothing but links
    level = min(SURGE, _median([(sums[k], log1p(lines[k].length)) for k in told]))
    high = [k for k in told if sums[k] >= level]
    return high[0], high[-1] + 1


def _checked(lines: list[Line], kept: list[int]) -> tuple[list[int], int]:
    """Of the lines between surge and dive those that the marks agree with, and their least mark.

    A mark counts if most of the text between stands under it: text beside it goes. Otherwise
    articles are teasers or quotations; they go where the text would start or end with them.
    """
    weight = [0, 0, 0]
    for k in kept:
        weight[lines[k].mark] += lines[k].length
    if 2 * weight[2] > sum(weight):
        return [k for k in kept if lines[k].mark == 2], 2
    least = int(weight[1] > weight[0])
    kept = [k for k in kept if lines[k].mark >= least]
    plain = [k for k in kept if lines[k].mark < 2 and not lines[k].is_links]
    if 2 * weight[2] < sum(weight) and plain:
        kept = [k for k in kept if plain[0] <= k <= plain[-1]]
    return kept, least


def _grown(lines: list[Line], at: int, step: int, least: int) -> int:
    """How far the text goes on from a line of it: over text that is not links; within an article
    also past gaps and single lines of links, if such text follows."""
    far, links, k = at, 0, at + step
    while 0 <= k < len(lines) and lines[k].mark >= least and (least == 2 or lines[k].mark < 2):
        if lines[k].text and not lines[k].is_links:
            far, links = k, 0
        elif least < 2:
            break
        elif lines[k].is_links:
            links += 1
            if links == 2:
                break
        k += step
    return far


def main_lines(lines: list[Line]) -> list[str]:
    """The lines of the main text."""
    first, last = between_surge_and_dive(lines)
    kept, least = _checked(lines, [k for k in range(first, last) if lines[k].text])
    if not kept:
        return []
    if not all(lines[k].is_links for k in kept):
        before, after = _grown(lines, kept[0], -1, least), _grown(lines, kept[-1], 1, least)
        kept = [*range(before, kept[0]), *kept, *range(kept[-1] + 1, after + 1)]
    return [lines[k].text for k in kept if lines[k].text]


def main_text(html: str | None) -> str:
    """The main text of one page; empty for null and for pages without text."""
    if not html:
        return ""
    # Class names mislead on a few pages: if they leave nothing, go by elements alone.
    for by_class in (True, False):
        text = " ".join(main_lines(page_lines(html, by_class)))
        if text:
            return text
    return ""


def extract_main_text(pages: DataFrame, *, html_col: str = "html") -> DataFrame:
    """``pages`` without ``html_col`` and with ``text``, the main text of the whole page.

    Character references are decoded, white space within a line becomes one space, lines are
    joined by one space. A null or empty page, or one without text, has the empty text. Broken
    markup is read as far as it goes: an element that is not closed ends with its parent, a tag
    cut off by the page's end is dropped. A page is one row and is read whole; no shuffle.
    """
    kept = [c for c in pages.columns if c not in (html_col, "text")]
    plain = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{html_col}`").alias("_html"))

    def run(batches):
        for batch in batches:
            texts = [main_text(html) for html in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string())], names=[*kept, "text"])

    schema = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in kept)
    return plain.mapInArrow(run, f"{schema}text string")
