"""Main text of web pages by tag-path ratios.

Every text block of a page has a path of block elements from the root (tag and
class, digits left out).  For each path the text length outside links and the
punctuation are taken per block over the whole page and fused into one ratio.
Ratios are smoothed over the tree of paths: an element's ratio is the mean of the
blocks below it, weighted by their length, and passes down to paths in it, a little
less with each step, so that the short headings, items and cells of an article
share its score; it passes down from the element that holds the content and from
those inside it, never from elements around it, and not to blocks made of links.
A heading has the score of what follows it.  Blocks of paths over a threshold are
the main text.  ``path_scores`` gives these scores, and nothing else adds a block.

Marks of the page only remove: regions marked as menus, headers, footers, side
columns, notices, adverts, forms or comments, and, where article and main elements
hold at least half of the content, all that is outside them.  An element is marked for certain
by its kind, its role, or a class or id of nothing but such words (``comment-list``).  A class
with other words in it (``menu-design``), or a word that may also name a part of an article
(WEAK, outside article and main only), leaves it to the ratios: the element goes
if its paths' are far under the mean.  Lists of links in article and main stay.

Defined results: null html counts as empty; a page without content gives an
empty text; character references are decoded, white space within a block is one
space, blocks are joined in page order by two line ends; repeated rows give equal
results; other columns are ignored.  Pages of any length, nested to any depth or
badly formed take time in proportion to their length.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_rows, small_batches

#: Share of the mean score (weighted by length) that makes a content path; what is left of a score one step down the
#: tree; share of the content that the element passing its score down holds; link share that makes a block of links; share of the
#: mean ratio under which an element goes whose mark isn't certain (one sentence has more, a menu's words have less).
THRESHOLD, STEP, HOLDS, LINKS, UNSURE = 0.4, 0.9, 0.8, 0.5, 0.1
#: Ends of tags that are looked for within an unfinished quotation.
LOOK = 16

HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
# What HTML says of its elements, and words by which pages mark regions.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
RAW = frozenset("script style textarea title noscript template iframe object svg math canvas audio video select xmp".split())
NEVER = RAW | frozenset("head nav aside footer form button dialog menu fieldset datalist".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
STRONG = frozenset(
    "ad ads advert adverts advertisement advertising adsense adbox adslot sponsored "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar footer masthead topbar "
    "cookie cookies consent gdpr notice notices newsletter comment comments commentlist respond replies disqus".split()
)
WEAK = frozenset(
    "sponsor promo promotion toc toolbar sitemap aside widget widgets rail related recommended recommendations trending popular "
    "banner popup modal overlay alert subscribe subscription signup login share sharing social reply "
    "form search skip hidden copyright legal disclaimer".split()
)
#: Words that say where or in what a marked region is, but not what it is.
PLACING = frozenset("list lists section area box wrapper wrap container inner outer item items top bottom left right primary secondary main site page global header widget unit slot banner holder".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTR = re.compile(r"""(?<![^\s"'/])([^\s"'=<>/]++)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：]")
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}


@dataclass
class Element:
    tag: str
    parent: int
    path: int  # number of its path
    hidden: bool
    soft: int  # outermost element around it, or itself, whose mark the ratios decide on; else -1
    article: bool


@dataclass
class Block:
    element: int
    text: list[str] = field(default_factory=list)
    linked: int = 0


@dataclass
class Page:
    """Block elements, texts by the innermost block element, the tree of paths (each one's parent, all parents first), and which are of html or body."""

    elements: list[Element]
    blocks: list[Block]
    up: list[int]
    outer: set[int]


NOT, MAYBE, CERTAIN = 0, 1, 2


def _marked(tag: str, of: dict[str, str], attrs: str, in_article: bool) -> int:
    """Whether the page marks an element as no part of its main text: NOT, MAYBE or CERTAIN."""
    if tag in NEVER or tag == "header" and not in_article:
        return CERTAIN
    if not attrs:
        return NOT
    if of.get("role", "").lower() in ROLES or of.get("aria-hidden", "").lower() == "true" or re.search(r"(?:^|\s)hidden(?:\s|$)", attrs.lower()):
        return CERTAIN
    if re.search(r"display\s*:\s*none", of.get("style", ""), re.I):
        return CERTAIN
    if tag in ("html", "body", "main"):
        return NOT
    names = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", f"{of.get('class', '')} {of.get('id', '')}").lower().split()
    words = [set(re.findall(r"[a-z]+", name)) for name in names]
    if any(w & STRONG and w <= STRONG | PLACING for w in words):
        return CERTAIN
    weak = not in_article and tag != "article"
    return MAYBE if any(w & STRONG or weak and w & WEAK for w in words) else NOT


class _Scanner:
    """Tags of a page, in time proportional to its length."""

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")

    def tag_end(self, at: int) -> int:
        """Where the tag that begins at a place ends: at the first > outside quotations, if there is one near."""
        page, first, quote = self.page, self.page.find(">", at), ""
        end = first
        for _ in range(LOOK):
            for c in re.findall("[\"']", page[at:end]):
                quote = "" if c == quote else quote or c
            if not quote:
                return end
            at = end
            end = page.find(">", end + 1) if end < self.last else -1
            if end < 0:
                break
        return first

    def tags(self) -> Iterator[tuple[int, int, str, bool, str]]:
        """(begin, end, name, whether an end tag, attributes); comments and raw elements have no name or their own."""
        page, at = self.page, 0
        while 0 <= (at := page.find("<", at)) < self.last:
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                end = len(page) if end < 0 else end + 3
                yield at, end, "", False, ""
            elif page[at + 1] in "!?":
                end = page.find(">", at) + 1
                yield at, end, "", False, ""
            else:
                closing = page[at + 1] == "/"
                name = _NAME.match(page, at + 1 + closing)
                if not name:
                    at += 1
                    continue
                # the name ends where the first > is, at the latest
                end = self.tag_end(name.end()) + 1
                tag, attrs = name[0].lower(), page[name.end() : end - 1]
                if tag in RAW and not closing and not (attrs.endswith("/") and tag in ("svg", "math")):
                    last = _RAW_END[tag].search(page, end)
                    end = last.end() if last else len(page)
                yield at, end, tag, closing, attrs
            at = end


def parse(page: str) -> Page:
    """Elements, blocks and paths of a page."""
    elements = [Element("", -1, 0, False, -1, False)]
    up, paths, outer = [-1], {}, {0}
    stack, blocks, now, linked = [0], [], None, False
    places: dict[str, list[int]] = {}  # where each tag is open on the stack

    def text(raw: str) -> None:
        nonlocal now
        if not raw:
            return
        if now is None or now.element != stack[-1]:
            now = Block(stack[-1])
            blocks.append(now)
        raw = entities.unescape(raw)
        now.text.append(raw)
        now.linked += len(raw) * linked

    def close(depth: int) -> None:
        while len(stack) > depth:
            places[elements[stack.pop()].tag].pop()

    at = 0
    for begin, end, tag, closing, attrs in _Scanner(page).tags():
        text(page[at:begin])
        at = end
        if not tag or tag in RAW or tag in INLINE and tag != "a" or tag in VOID and tag not in ("hr", "br"):
            continue
        if tag == "br":
            text("\n")
        elif tag == "a":
            linked = not closing
        else:
            now, linked = None, False
            if closing:
                if places.get(tag):
                    close(places[tag][-1])
                continue
            if tag == "hr":
                continue
            if tag in CLOSES:
                scope = max((p[-1] for t in SCOPE[tag] if (p := places.get(t))), default=0)
                open_ = [p[i] for t in CLOSES[tag] if (p := places.get(t)) and (i := bisect_right(p, scope)) < len(p)]
                if open_:
                    close(min(open_))
            elif elements[stack[-1]].tag == "p":
                close(len(stack) - 1)
            around = elements[stack[-1]]
            of = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attrs)} if "=" in attrs else {}
            label = (around.path, tag, re.sub(r"\d+", "", of.get("class", "")))
            path = paths.setdefault(label, len(up))
            if path == len(up):
                up.append(around.path)
                if tag in ("html", "body"):
                    outer.add(path)
            mark = _marked(tag, of, attrs, around.article)
            soft = around.soft if around.soft >= 0 or mark != MAYBE else len(elements)
            elements.append(Element(tag, stack[-1], path, around.hidden or mark == CERTAIN, soft, around.article or tag in ("article", "main")))
            places.setdefault(tag, []).append(len(stack))
            stack.append(len(elements) - 1)
    text(page[at:])
    return Page(elements, blocks, up, outer)


def _below(up: list[int], values: np.ndarray) -> np.ndarray:
    """Sums of values over the paths below each path and its own."""
    total = values.astype(float)
    for i in range(len(up) - 1, 0, -1):
        total[up[i]] += total[i]
    return total


def path_ratios(path: np.ndarray, n_paths: int, chars: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """For each path its text length and punctuation per block, fused."""
    n = np.maximum(1, np.bincount(path, minlength=n_paths))
    return np.bincount(path, chars, n_paths) / n * (1 + np.bincount(path, marks, n_paths) / n)


def path_scores(path: np.ndarray, up: list[int], chars: np.ndarray, marks: np.ndarray, linked: np.ndarray, outer: set[int], roots: set[int], heading: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """For each block the smoothed and fused tag-path ratios of its path.

    ``up`` gives each path's parent, ``linked`` the characters in links, ``outer`` the paths of
    the page, html and body, ``roots`` the paths of elements that pass their score
    down in any case (article and main), ``heading`` whether a block is a heading that what follows is beside or below,
    ``alone`` whether its element holds nothing else.
    """
    free = np.maximum(0.0, chars - linked)
    ratio = path_ratios(path, len(up), free, marks)
    size = np.bincount(path, free, len(up))
    total = _below(up, size)
    mean = _below(up, size * ratio) / np.maximum(1e-9, total)
    content = size * (ratio >= THRESHOLD * mean[0])
    mass = _below(up, content)
    givers, flat = set(roots), False
    if not givers:
        inner: dict[int, list[int]] = {}
        for i in range(1, len(up)):
            inner.setdefault(up[i], []).append(i)
        at = 0
        while (best := max(inner.get(at, ()), key=lambda i: mass[i], default=0)) and best in inner and mass[best] >= HOLDS * mass[0] > 0 and total[best] > size[best]:
            at = best
        # html and body hold everything, which is no evidence
        flat = at in outer
        if not flat:
            givers = {at}
    links = linked > LINKS * chars
    given = np.zeros(len(up))
    inside = np.zeros(len(up), bool)
    for i in range(1, len(up)):
        inside[i] = inside[up[i]] or i in givers
        if inside[i]:
            given[i] = max(mean[i], STEP * given[up[i]])
    # what holds the content passes its score to what it holds; another element of its path that holds only text has its own
    bare = np.zeros(len(path), bool) if roots else alone & np.isin(path, list(givers))
    if roots:
        links &= ~inside[path]
    score = np.where(links | bare, ratio[path], np.maximum(ratio, given)[path])
    if flat and len(score) > 2:  # what lies between contents belongs to them
        before, after = np.maximum.accumulate(score), np.maximum.accumulate(score[::-1])[::-1]
        score = np.where(links, score, np.maximum(score, STEP * np.minimum(before, after)))
    for k in np.flatnonzero(heading)[::-1]:
        if k + 1 < len(score):
            score[k] = max(score[k], STEP * score[k + 1])
    return score


def _leading_headings(elements: list[Element], of: list[int]) -> np.ndarray:
    """Which blocks are headings beside or around which the next block lies."""
    found = np.zeros(len(of), bool)
    for k, (i, j) in enumerate(zip(of, of[1:])):
        if elements[i].tag in HEADINGS:
            around, j = elements[i].parent, elements[j].parent
            while j > around:  # elements are numbered in page order
                j = elements[j].parent
            found[k] = j == around
    return found


def _alone(elements: list[Element], of: list[int]) -> np.ndarray:
    """Which blocks are all that their element holds."""
    held = np.bincount(of, minlength=len(elements))
    for i in range(len(elements) - 1, 0, -1):
        held[elements[i].parent] += held[i]
    return held[of] == 1


def main_text(page: str | None) -> str:
    """The main text of a page."""
    parsed = parse(page or "")
    elements = parsed.elements
    kept = [(b, text) for b in parsed.blocks if not elements[b.element].hidden and (text := " ".join("".join(b.text).split()))]
    if not kept:
        return ""

    def measured(of: list[tuple[Block, str]], roots: set[int]) -> tuple[np.ndarray, np.ndarray]:
        inner = [b.element for b, _ in of]
        path = np.array([elements[i].path for i in inner])
        chars = np.array([len(t) for _, t in of], float)
        marks = np.array([len(_PUNCTUATION.findall(t)) for _, t in of], float)
        linked = np.array([min(len(t), b.linked) for b, t in of], float)
        scores = path_scores(path, parsed.up, chars, marks, linked, parsed.outer, roots, _leading_headings(elements, inner), _alone(elements, inner))
        return scores >= THRESHOLD * (scores @ chars / chars.sum()), chars

    soft = np.array([elements[b.element].soft for b, _ in kept])
    if (soft >= 0).any():
        path = np.array([elements[b.element].path for b, _ in kept])
        chars = np.array([max(0, len(t) - b.linked) for b, t in kept], float)
        ratio = path_ratios(path, len(parsed.up), chars, np.array([len(_PUNCTUATION.findall(t)) for _, t in kept], float))[path]
        of_mark = np.bincount(soft + 1, chars * ratio) / np.maximum(1e-9, np.bincount(soft + 1, chars))
        stays = (soft < 0) | (of_mark >= UNSURE * (chars * ratio).sum() / max(1e-9, chars.sum()))[soft + 1]
        kept = [k for k, s in zip(kept, stays) if s] or kept
    marked = np.array([elements[b.element].article for b, _ in kept])
    content, chars = measured(kept, set())
    if marked.any() and chars[content & marked].sum() >= 0.5 * chars[content].sum():
        kept = [k for k, m in zip(kept, marked) if m]
        content, _ = measured(kept, {e.path for e in elements if e.article and not elements[e.parent].article})
    return "\n\n".join(t for (_, t), good in zip(kept, content) if good)


EXTRACTED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for page_id, url, page in zip(*(c.to_pylist() for c in batch.columns)):
                    text = main_text(page)
                    yield page_id, url, text, len(text)

        yield from arrow_rows(EXTRACTED, rows())

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
