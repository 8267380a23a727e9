"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clickspark.llm.names import unused

#: Elements whose text is no part of an article.
DROPPED = frozenset(
    "head title script style noscript template iframe object embed svg math canvas audio video map"
    " nav footer aside form button select textarea input datalist dialog menu header".split()
)
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr basefont frame keygen".split()
)
#: Elements whose place in a path also has the words of their class, id and role.
HOLDERS = frozenset("div section td ul ol dl".split())
#: Elements that do not part a text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q"
    " rb rp rt rtc ruby s samp small span strike strong sub sup time tt u var meter progress img link"
    " meta source track param area base col basefont button select svg math canvas audio video object"
    " iframe".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Words of class, id and role that name what surrounds an article.
AROUND = frozenset(
    "ad ads adv advert adverts advertisement advertising adslot adsense adsbygoogle banner sponsor"
    " sponsored promo promotion promoted nav navbar topnav sidenav subnav mainnav navigation menu menubar"
    " breadcrumb breadcrumbs pagination pager sidebar complementary footer contentinfo header masthead"
    " topbar toolbar cookie cookies consent gdpr notice notification alert popup modal overlay dialog"
    " newsletter subscribe subscription signup login search share sharing social related recommended"
    " recommendations trending tags toc skip paywall disclaimer copyright hidden".split()
)
#: Words that name what readers wrote.
READERS = frozenset(
    "comment comments commentlist respond reply replies disqus discussion reviews guestbook".split()
)
#: Beside one of these the words above tell of a layout or a state.
STATES = frozenset("has no with without layout open closed status".split())

_PLAIN = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTES = re.compile(r"(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]*)|[^>=])*+")
_NAMES = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_MARKS = re.compile(r"[.,;:!?…、。,!?;:،؛؟।]")
#: Blocks on each side that a ratio is smoothed over, and how far it reaches.
RADIUS, WIDTH = 2, 1.0
#: Paths below this many standard deviations are no content.
THRESHOLD = 0.8
#: The same for paths below this share of the greatest ratio, whatever is beside them.
LEAST = 0.1


class _Paths:
    """Paths of tags from the root, numbered; a path is its parent's number and a tag."""

    def __init__(self):
        self.numbers: dict[tuple[int, str], int] = {}
        self.parents, self.tags = [-1], [""]

    def below(self, parent: int, tag: str) -> int:
        number = self.numbers.setdefault((parent, tag), len(self.tags))
        if number == len(self.tags):
            self.parents.append(parent)
            self.tags.append(tag)
        return number


def blocks(page: str) -> tuple[list[tuple[int, bool, bool, str, int]], _Paths]:
    """Texts of a page in order: path, whether it is in an article, whether it is a
    heading, text, and the characters of it that are links. And what paths there are.

    Elements may be left open or closed without being open; references are decoded,
    white space (also of references) becomes one space. A text that surrounds an
    article by its tag, role, class or id is left out.
    """
    paths, found = _Paths(), []
    # Of each open element: tag, path, whether its text counts, whether it is in an article.
    stack: list[tuple[str, int, str, bool]] = [("", 0, "", False)]
    still: dict[str, int] = {}
    pieces: list[str] = []
    links: list[str] = []
    in_link = False

    def take(raw: str) -> None:
        if raw and not stack[-1][2]:
            text = html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if in_link:
                links.append(text)

    def part() -> None:
        """What was read so far is a block."""
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                tag, path, _, inside = stack[-1]
                linked = len(" ".join("".join(links).split()))
                found.append((path, inside, tag in HEADINGS, text, linked))
            pieces.clear()
            links.clear()

    def pop() -> None:
        tag = stack.pop()[0]
        still[tag] -= 1

    last_end, at, end = page.rfind(">"), 0, len(page)
    while at < end:
        begin = page.find("<", at)
        if begin < 0:
            take(page[at:])
            break
        if begin > at:
            take(page[at:begin])
        after = page[begin + 1 : begin + 2]
        closing = after == "/"
        name = _PLAIN.match(page, begin + 1 + closing)
        if name is None:
            if page.startswith("<!--", begin):
                close = page.find("-->", begin + 4)
                at = end if close < 0 else close + 3
            elif after in ("!", "?") or closing:
                close = page.find(">", begin)
                at = end if close < 0 else close + 1
            else:  # a plain sign
                take("<")
                at = begin + 1
            continue
        if begin > last_end:  # a tag that never ends
            break
        tag = name.group().lower()
        rest = _ATTRIBUTES.match(page, name.end())
        at = rest.end() + 1 if rest.end() < end else page.find(">", name.end()) + 1
        if tag == "br":
            take(" ")
            continue
        if closing:
            if tag == "a":
                in_link = False
            if still.get(tag):
                if tag not in INLINE:
                    part()
                while stack[-1][0] != tag:
                    pop()
                pop()
            elif tag not in INLINE:
                part()
            continue
        if tag == "a":
            in_link = True
        words, hidden = _told(page[name.end() : rest.end()])
        out = _around(tag, words, hidden, stack)
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            if tag not in DROPPED and not out:
                take(page[at : close.start() if close else end])
            at = end if close is None else (page.find(">", close.start()) + 1 or end)
            continue
        if tag in ("td", "th"):
            take(" ")
            continue
        if tag in VOID or (tag in INLINE and (not out or out == stack[-1][2])):
            if tag == "hr":
                part()
            continue
        if tag in INLINE:  # what is left out does not part a text either
            stack.append((tag, stack[-1][1], out, stack[-1][3]))
            still[tag] = still.get(tag, 0) + 1
            continue
        part()
        in_link = False
        if stack[-1][0] in _ENDS.get(tag, _BY_BLOCK):
            pop()
            if stack[-1][0] in _ENDS.get(tag, ()):
                pop()
        _, above, _, inside = stack[-1]
        inside = inside or (tag in ("article", "main") and not out)
        label = " ".join((tag, *sorted(words))) if tag in HOLDERS else tag
        stack.append((tag, paths.below(above, label), out, inside))
        still[tag] = still.get(tag, 0) + 1
    part()
    return found, paths


#: Elements that a tag ends, if they are the innermost open one. A block ends a paragraph.
_BY_BLOCK = ("p",)
_ENDS = {
    "li": ("p", "li"),
    "dt": ("p", "dt", "dd"),
    "dd": ("p", "dt", "dd"),
    "tr": ("p", "tr"),
    "tbody": ("p", "tr", "tbody", "thead"),
    "option": ("option",),
    **{h: ("p", *sorted(HEADINGS)) for h in HEADINGS},
}


def _told(attributes: str) -> tuple[set[str], bool]:
    """Words of class, id and role, and whether the element is hidden."""
    words: set[str] = set()
    hidden = False
    for m in _NAMES.finditer(attributes) if attributes.strip() else ():
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id", "role"):
            for name in value.split():
                said = {w.lower() for w in _WORD.findall(name)}
                words |= set() if said & STATES else said
        elif key == "style":
            hidden |= re.search(r"display\s*:\s*none", value, re.I) is not None
        else:
            hidden |= key == "hidden" or value.lower() == "true"
    return words, hidden


def _around(tag: str, words: set[str], hidden: bool, stack: list) -> str:
    """Why the text of an element is left out; empty if it is not.

    Words like *sidebar* also name the layout of what holds the article, so they
    say nothing of a page's main parts, which count again below such an element
    (but not below what readers wrote).
    """
    _, _, out, inside = stack[-1]
    if words & READERS and tag not in ("html", "body", "main"):
        return "readers"
    if tag in ("article", "main"):
        return "" if out == "name" else out
    if out:
        # A heading in an article's own header is the article's.
        return "" if out == "header" and tag in HEADINGS else out
    if tag in ("html", "body"):
        return ""
    if inside and (tag == "header" or "header" in words):
        return "" if tag in HEADINGS else "header"
    if tag in DROPPED or hidden:
        return "tag"
    return "name" if words & AROUND else ""


def content(found: list[tuple[int, bool, bool, str, int]], paths: _Paths) -> list[str]:
    """Which blocks of a page are content.

    The ratios of a path: characters outside links and punctuation marks, each over
    the number of its blocks. Fused, they are smoothed over neighbouring blocks
    (Gaussian), and a path stays whose mean over its blocks reaches ``THRESHOLD``
    standard deviations, and whose own ratio is ``LEAST`` of the greatest; if the page
    has an article, only paths within it do. A heading counts as a block of the path that it stands at the head of.

    Lists, captions and the like have low ratios beside long paragraphs. Unless
    half of it is links, such a path stays too if it is in an article or in an
    element (smaller than the page) that directly holds content, and so does a
    block of it between content. If no path stays, the one with the greatest ratio
    does.
    """
    if any(inside for _, inside, *_ in found):
        found = [b for b in found if b[1]]
    if not found:
        return []
    path = np.array([b[0] for b in found])
    heading = np.array([b[2] for b in found])
    following = path.copy()
    for i in range(len(found) - 2, -1, -1):
        if heading[i]:
            following[i] = following[i + 1]
    _, kind = np.unique(following, return_inverse=True)
    chars = np.array([len(text) - linked for *_, text, linked in found], float)
    marks = np.array([len(_MARKS.findall(text)) for *_, text, _ in found], float)
    body = np.where(heading, 0.0, 1.0)
    counts = np.maximum(np.bincount(kind, body), 1)
    plain = np.bincount(kind, chars * body) / counts
    plain = np.where(np.bincount(kind, body) > 0, plain, np.bincount(kind, chars))
    ratio = plain * (1 + np.bincount(kind, marks) / counts)
    smooth = _smoothed(ratio[kind])
    score = np.bincount(kind, smooth) / np.bincount(kind)
    stays = (score > 0) & (score >= THRESHOLD * smooth.std()) & (ratio >= LEAST * ratio.max())
    if not stays.any():
        stays[score.argmax()] = True
    strong = np.flatnonzero(stays[kind])
    holders = {paths.parents[p] for p, h in zip(path[strong].tolist(), heading[strong]) if not h}
    holders = {p for p in holders if paths.tags[p] not in ("", "html", "body")}
    linked = np.bincount(kind, [b[4] for b in found]) * 2 >= np.bincount(kind, [len(b[3]) for b in found])
    held: dict[int, bool] = {}

    def within(p: int) -> bool:
        """Whether an element that directly holds content holds this path."""
        p, up = paths.parents[p], []
        while p >= 0 and p not in held and p not in holders:
            up.append(p)
            p = paths.parents[p]
        found_in = held.get(p, p in holders)
        held.update(dict.fromkeys(up, found_in))
        return found_in

    return [
        text
        for i, ((p, inside, _, text, _), k) in enumerate(zip(found, kind.tolist()))
        if stays[k] or not linked[k] and (inside or strong[0] < i < strong[-1] or within(p))
    ]


def _smoothed(values: np.ndarray) -> np.ndarray:
    total, weight = np.zeros(len(values)), np.zeros(len(values))
    for step in range(-RADIUS, RADIUS + 1):
        w = np.exp(-(step**2) / (2 * WIDTH**2))
        to, of = slice(max(0, -step), len(values) - max(0, step)), slice(max(0, step), len(values) + min(0, step))
        if abs(step) < len(values):
            total[to] += w * values[of]
            weight[to] += w
    return total / weight


def main_text(page: str | None) -> str:
    """The main text of a page, its blocks in order with an empty line between."""
    return "\n\n".join(content(*blocks(page or "")))


def extract(pages: DataFrame, page: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the main text of the whole of ``page`` as ``text``.

    The text is empty, never null: for null and empty pages, and for pages without
    text outside of what surrounds it. Text without markup is a block. Pages are
    independent of each other and stay in their rows: repeated rows have the same
    text, other columns stay, and one named ``text`` (in any case) is replaced.
    """
    others = [c for c in pages.columns if c.lower() != text.lower() and c != page]
    (whole,) = unused(others, "page")
    rows = pages.select(*(f"`{c}`" for c in others), pages[f"`{page}`"].cast("string").alias(whole))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1]), f"`{text}` string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [main_text(p) for p in batch.column(len(others)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(told, pa.string())], [*others, text]
            )

    return rows.mapInArrow(run, schema)
