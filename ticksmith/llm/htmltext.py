"""HTML extraction: flat text blocks, classified by a decision tree.

A page is cut into flat blocks at block-level tags (``br`` is white space inside a block).  A
block is described by its words, its link density (the share of words inside links), both for
the block before and after it, whether it is a heading, where it stands (inside an article or
main element, outside although the page has one, or on a page without any) and whether an
enclosing element says by its tag, class, id or role that it is furniture (navigation, footer,
advert, comments, ...).  A decision tree, grown by Gini impurity from the labelled table below,
tells main text from the rest.  The kept blocks are joined by a blank line.

Character references are decoded, comments, declarations and the content of scripts, styles and
the like dropped.  End tags that match nothing are ignored; an unclosed element ends with its
parent, and navigation or a page header ends where an article or main element begins.

Defined results: null or empty html, or a page without main text, gives an empty text; pages of
any length are read whole; an unclosed tag, comment or script runs to the end of the page;
repeated rows are treated alike; other columns stay, and the result is one column.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tags that begin and end blocks; those that hold others; those whose content is no text.
BREAKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
HOLDERS = frozenset(
    "address article aside blockquote body center details dialog div dl fieldset figure footer form head header hgroup html main menu nav ol "
    "section table tbody td tfoot th thead tr ul".split())
RAW = frozenset("script style noscript template textarea iframe svg select object canvas math title xmp noembed noframes".split())
FURNITURE = frozenset("nav footer header aside form menu dialog head button label fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of class, id and role that name furniture; the second ones whatever share of a page they hold.
_LAYOUT = (
    r"banner|breadcrumbs?|complementary|contentinfo|dropdown|footer|footnav|form|header|masthead|menus?|nav|navbar|navigation|pager|pagination|search|"
    r"sidebar|sitemap|toolbar|topbar|widgets?")
_NEVER = (
    r"ads?|advert\w*|adsense|captcha|comments?|commentlist|cookies?|consent|disclaimer|disqus|gdpr|login|modal|newsletter|notices?|notification|popup|"
    r"promo\w*|recommend\w*|related|replies|reply|respond|share|sharing|signup|social|sponsor\w*|subscri\w*|teasers?")
#: Words that say what a page has, and where a part of it stands; they do not name the part.
_STATES = r"has|no|not|with|without|is|show|hide|enable|enabled|disable|disabled|wp|js"
_PLACES = r"left|right|top|bottom|main|primary|secondary|area|section|wrapper|wrap|container|box|block|list|inner|outer|item|items|links?|bar|text|\d+"
_NAME = re.compile(rf"(?!(?:{_STATES})-)(?:[a-z0-9]+-)*?(?:(?P<layout>{_LAYOUT})|(?P<never>{_NEVER}))(?:-(?:{_PLACES}))*")
_ATTR = re.compile(r"""(?:^|[\s"'])(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TAG = re.compile(
    r"""<!--(?:.*?--!?>|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*'|["'])*+)(?:>|\Z)""", re.S)


@dataclass(slots=True)
class Block:
    text: str
    words: int
    linked: int
    heading: bool
    inside: bool
    furniture: bool
    wrapper: int = -1  # the innermost layout wrapper around it

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0

    @property
    def unlinked(self) -> int:
        return self.words - self.linked


#: What a tag's names say: nothing, the name of a part of the layout, or of what is never main text.
NONE, LAYOUT, NEVER = 0, 1, 2


def _tokens(attrs: str) -> Iterator[str]:
    for m in _ATTR.finditer(attrs):
        for token in "".join(m.groups("")).split():
            yield re.sub(r"[_:.-]+", "-", re.sub(r"([a-z])([A-Z])", r"\1-\2", token)).strip("-").lower()


def _named(attrs: str) -> int:
    """The most that a whole class token, id or role says: ``has-sidebar`` names no sidebar."""
    found = NONE
    for token in _tokens(attrs) if attrs.strip() else ():
        m = _NAME.fullmatch(token)
        if m:
            found = max(found, NEVER if m["never"] else LAYOUT)
    return found


def blocks(page: str) -> list[Block]:
    """The non-empty blocks of a page, in order.

    A wrapper named like a part of the layout (or a form) that holds nearly all unlinked words of the page is
    none: its mark does not count.
    """
    out: list[Block] = []
    stack: list[tuple[str, str]] = []  # open holders, and their marks: firm (furniture whatever it holds) or layout
    count: Counter[str] = Counter()  # of the open holders, and of their marks
    around: list[int] = []  # of each layout wrapper: the one around it
    wrapper = -1  # the innermost open one
    parts: list[tuple[str, bool]] = []
    links, own, heading, button = 0, False, False, False

    def close() -> None:
        if parts:
            # a word counts as linked if it begins inside a link
            whole = html.unescape("".join(p for p, _ in parts)) if len(parts) > 1 else html.unescape(parts[0][0])
            words = whole.split()
            if words:
                linked = sum(len(html.unescape(p).split()) for p, link in parts if link)
                inside = count["article"] + count["main"] > 0
                out.append(Block(" ".join(words), len(words), min(linked, len(words)), heading, inside, own or count["firm"] > 0, wrapper))
            parts.clear()

    def pop() -> None:
        nonlocal wrapper
        tag, mark = stack.pop()
        count[tag] -= 1
        count[mark] -= 1
        if mark == "layout":
            wrapper = around[wrapper]

    at, end = 0, len(page)
    while at < end:
        tag = _TAG.search(page, at)
        stop = tag.start() if tag else end
        if stop > at and not button:
            parts.append((page[at:stop], links > 0))
        if not tag:
            break
        at = tag.end()
        if tag[2] is None:
            continue
        closing, name, attrs = bool(tag[1]), tag[2].lower(), tag[3]
        if name in RAW and not closing:
            if name in BREAKS:
                close()
            if not attrs.endswith("/") or name != "svg":
                done = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = done.end() if done else end
        elif name == "a":
            links = 0 if closing else 1
        elif name == "button":
            button = not closing
        elif name == "br":
            parts.append((" ", False))
        elif name in BREAKS:
            close()
            own = heading = button = False  # a button that was left open ends with its block
            if name not in HOLDERS:
                if not closing:
                    heading = name in HEADINGS
                    own = not heading and _named(attrs) > NONE  # the id of a heading names its section
            elif closing:
                if count[name]:
                    while stack[-1][0] != name:
                        pop()
                    pop()
                    links = 0
            elif not attrs.endswith("/"):
                if name in ("article", "main"):
                    while count["nav"] + count["header"] + count["head"]:
                        pop()
                by_name = _named(attrs) if name not in ("html", "body", "main") else NONE
                by_tag = name in FURNITURE and not (name == "header" and count["article"] + count["main"])
                mark = ""
                if by_name == NEVER or by_tag and name != "form":
                    mark = "firm"
                elif by_name or by_tag:
                    mark = "layout"
                    around.append(wrapper)
                    wrapper = len(around) - 1
                stack.append((name, mark))
                count[name] += 1
                count[mark] += 1
        elif name in ("label", "legend") and not closing:
            own = True
    close()
    held = [0] * (len(around) + 1)  # the last stands for none
    for b in out:
        held[b.wrapper] += b.unlinked
    total = sum(held)
    for w in range(len(around) - 1, -1, -1):
        held[around[w]] += held[w] if around[w] >= 0 else 0
    for b in out:
        # a wrapper around holds as much at least: if the innermost one is none, they all are
        b.furniture = b.furniture or b.wrapper >= 0 and held[b.wrapper] * NEARLY_ALL[1] <= total * NEARLY_ALL[0]
    return out


#: A layout wrapper that holds more than this share of a page's unlinked words is none.
NEARLY_ALL = (3, 4)

FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "heading", "place", "furniture")
#: The labelled table: the features of a block and whether it is main text.
#: place: 1 inside an article or main element, -1 outside on a page whose text is in one, 0 on a page without.
LABELLED = [
    # inside an article: paragraphs, short ones, headings, list entries
    ((60, 0.0, 80, 0.0, 70, 0.0, 0, 1, 0), 1), ((1, 0.0, 60, 0.0, 50, 0.0, 0, 1, 0), 1), ((1, 0.0, 1, 0.0, 1, 0.0, 0, 1, 0), 1),
    ((6, 0.0, 8, 0.0, 120, 0.0, 1, 1, 0), 1), ((4, 0.0, 0, 0.0, 1, 0.0, 1, 1, 0), 1), ((9, 0.4, 30, 0.0, 40, 0.0, 0, 1, 0), 1),
    ((35, 0.3, 50, 0.1, 50, 0.0, 0, 1, 0), 1), ((2, 0.0, 3, 1.0, 0, 0.0, 0, 1, 0), 1), ((300, 0.0, 1, 1.0, 2, 0.0, 0, 1, 0), 1),
    ((3, 0.5, 12, 0.0, 15, 0.0, 0, 1, 0), 1), ((15, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0), 1), ((7, 0.0, 2, 0.0, 0, 0.0, 0, 1, 0), 1),
    # inside an article: lists of links to others
    ((5, 1.0, 6, 1.0, 5, 1.0, 0, 1, 0), 0), ((4, 1.0, 40, 0.0, 5, 1.0, 0, 1, 0), 0), ((2, 1.0, 2, 1.0, 0, 0.0, 0, 1, 0), 0),
    # inside an article: adverts, shares, comments, by name
    ((8, 0.0, 60, 0.0, 70, 0.0, 0, 1, 1), 0), ((40, 0.0, 30, 0.0, 20, 0.0, 0, 1, 1), 0), ((2, 1.0, 50, 0.0, 0, 0.0, 0, 1, 1), 0),
    ((12, 0.0, 3, 0.0, 3, 0.0, 1, 1, 1), 0), ((1, 0.0, 8, 0.0, 9, 0.0, 0, 1, 1), 0), ((150, 0.0, 90, 0.0, 90, 0.0, 0, 1, 1), 0),
    # outside of the article of a page that has one
    ((8, 0.0, 1, 1.0, 6, 0.0, 0, -1, 1), 0), ((3, 0.0, 80, 0.0, 0, 0.0, 0, -1, 1), 0), ((1, 1.0, 1, 1.0, 1, 1.0, 0, -1, 1), 0),
    ((25, 0.0, 60, 0.0, 0, 0.0, 0, -1, 0), 0), ((80, 0.0, 2, 0.0, 30, 0.0, 0, -1, 0), 0), ((6, 0.0, 2, 0.0, 60, 0.0, 1, -1, 0), 0),
    ((2, 0.0, 3, 0.0, 4, 0.0, 0, -1, 0), 0), ((150, 0.0, 1, 1.0, 80, 0.0, 0, -1, 1), 0), ((4, 1.0, 9, 0.0, 3, 1.0, 0, -1, 0), 0),
    # a page without an article: paragraphs, also short ones between them, headings before text
    ((60, 0.0, 50, 0.0, 70, 0.0, 0, 0, 0), 1), ((25, 0.1, 1, 1.0, 40, 0.0, 0, 0, 0), 1), ((14, 0.0, 40, 0.0, 30, 0.0, 0, 0, 0), 1),
    ((6, 0.0, 1, 1.0, 60, 0.0, 1, 0, 0), 1), ((3, 0.0, 40, 0.0, 45, 0.0, 0, 0, 0), 1), ((1, 0.0, 30, 0.0, 35, 0.0, 0, 0, 0), 1),
    ((120, 0.2, 2, 0.0, 2, 0.0, 0, 0, 0), 1), ((18, 0.0, 25, 0.0, 3, 0.0, 0, 0, 0), 1), ((5, 0.0, 35, 0.0, 20, 0.0, 1, 0, 0), 1),
    # a page without an article: menus, notes of rights, lone labels
    ((1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0), 0), ((4, 1.0, 3, 1.0, 50, 0.0, 0, 0, 0), 0), ((12, 0.9, 10, 0.9, 14, 1.0, 0, 0, 0), 0),
    ((4, 0.0, 50, 0.0, 0, 0.0, 0, 0, 0), 0), ((3, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0), 0), ((2, 0.0, 0, 0.0, 1, 1.0, 0, 0, 0), 0),
    ((5, 0.0, 3, 0.0, 4, 0.0, 0, 0, 0), 0), ((3, 0.0, 4, 1.0, 3, 0.0, 1, 0, 0), 0), ((30, 0.8, 20, 0.0, 5, 1.0, 0, 0, 0), 0),
    # a page without an article: furniture by name
    ((40, 0.0, 50, 0.0, 60, 0.0, 0, 0, 1), 0), ((8, 0.0, 1, 1.0, 60, 0.0, 0, 0, 1), 0), ((3, 0.0, 70, 0.0, 0, 0.0, 0, 0, 1), 0),
    ((90, 0.0, 30, 0.0, 10, 0.0, 0, 0, 1), 0), ((6, 0.0, 0, 0.0, 40, 0.0, 1, 0, 1), 0), ((1, 1.0, 1, 1.0, 40, 0.0, 0, 0, 1), 0),
]


def _impurity(labels: list[int]) -> float:
    share = sum(labels) / len(labels)
    return 2 * share * (1 - share) * len(labels)


def grow(rows: list[tuple[tuple, int]], least: int = 2):
    """A tree of (feature, threshold, at most, above); a leaf is a label.  Splits lie between neighbouring values."""
    labels = [label for _, label in rows]
    if len(set(labels)) == 1:
        return labels[0]
    best = None
    for f in range(len(rows[0][0])):
        values = sorted({x[f] for x, _ in rows})
        for a, b in zip(values, values[1:]):
            cut = (a + b) / 2
            low, high = [y for x, y in rows if x[f] <= cut], [y for x, y in rows if x[f] > cut]
            if min(len(low), len(high)) >= least:
                cost = _impurity(low) + _impurity(high)
                if best is None or cost < best[0]:
                    best = (cost, f, cut)
    if best is None:
        return int(sum(labels) * 2 >= len(labels))
    _, f, cut = best
    return f, cut, grow([r for r in rows if r[0][f] <= cut], least), grow([r for r in rows if r[0][f] > cut], least)


def decide(tree, features: tuple) -> int:
    while not isinstance(tree, int):
        f, cut, low, high = tree
        tree = low if features[f] <= cut else high
    return tree


def features(found: list[Block]) -> Iterator[tuple]:
    within = sum(b.unlinked for b in found if b.inside and not b.furniture)
    beside = sum(b.unlinked for b in found if not b.inside and not b.furniture)
    any_main = within > 0 and 2 * within >= beside  # a teaser in an article beside long text is not the page's article
    none = Block("", 0, 0, False, False, False)
    for before, b, after in zip([none, *found], found, [*found[1:], none]):
        place = (1 if b.inside else -1) if any_main else 0
        yield (b.words, b.density, before.words, before.density, after.words, after.density, int(b.heading), place, int(b.furniture))


def main_text(page: str | None, tree) -> str:
    found = blocks(page or "")
    return "\n\n".join(b.text for b, f in zip(found, features(found)) if decide(tree, f))


def extract(page: Column, labelled: list[tuple[tuple, int]] | None = None) -> Column:
    """The main text of a page's html."""
    tree = grow(LABELLED if labelled is None else labelled)

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in parts:
            yield pa.array([main_text(p.as_py(), tree) for p in pages], pa.string())

    run.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "string")(page)
