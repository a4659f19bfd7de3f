"""Main text of web pages by two passes over text blocks.

Pass one decides a block by what encloses it (navigation, forms, comments and the like, read
from tags, roles and class names), by link density, length and stop-word density. Headings
and short blocks stay ambiguous. In pass two they inherit from the nearest decided blocks
before and after them. Inside an article element, prose is never dropped for its words alone.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import steps

SHORT, LONG = 70, 200
LOW_STOPS, HIGH_STOPS = 0.12, 0.2
MAX_LINKS = 0.5

# Common function words of the languages served.
STOP_WORDS = frozenset(
    """
    a an and are as at be but by for from had has have he her his i if in is it its not of on or our she
    that the their there they this to was we were which will with would you your
    als am auf aus bei das dass dem den der des die durch ein eine einem einen einer er es für hat ich im
    ist mit nach nicht noch sich sie sind so über um und von vor war wie wir wird zu zum zur
    au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou où
    par pas plus pour qu que qui sa se ses son sur un une vous
    al como con cuando de del el ella en entre era es esta este fue ha hay la las le lo los más me muy no
    nos o para pero por que se ser si sin sobre son su sus también un una y ya
    """.split()
)

# HTML elements by their part in a page.
BLOCKS = frozenset(
    """
    address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search
    section summary table tbody td tfoot th thead title tr ul
    """.split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset(
    """
    applet aside audio button canvas datalist dialog fieldset footer form head iframe legend map math menu meter
    nav noembed noframes noscript object optgroup option output progress rp rt script search select style svg
    template textarea title video
    """.split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROOTS = frozenset(("article", "main"))
DROPPED_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog directory form menu menubar navigation search "
    "status tablist toolbar".split()
)
# Words of class names and ids that mark what is not the article.
DROPPED_NAMES = frozenset(
    """
    ad ads adbox adslot advert adverts advertisement advertising advertorial alert alerts banner banners
    breadcrumb breadcrumbs captcha colophon comment comments commentlist commentary consent cookie cookies
    copyright discussion disclaimer disqus donate footer footnav gdpr header hidden legal login masthead menu
    menus modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall
    popup popups privacy promo promos promoted promotion reactions recommended register related reply replies
    respond responses rail search share sharing sharebar sidebar sidebars signin signup skip social sponsor
    sponsored sponsors subscribe subscription tagcloud tags teaser toolbar topbar toc trending warning widget
    widgets
    """.split()
)
# Words that say the names beside them are about layout ("content with sidebar", "article header").
KEPT_NAMES = frozenset("article body content entry has main no page post story text with without wrapper".split())
LAYOUT_NAMES = frozenset("ad ads banner footer header legal menu nav rail sidebar social tags toc widget".split())

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)",
    re.DOTALL,
)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_WORD = re.compile(r"[^\W\d_]+")
_FOREIGN = re.compile(r"[^\W\d_\x00-\u024f\u1e00-\u1eff]")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}


class Block(NamedTuple):
    text: str
    linked: int
    heading: bool
    inside: bool
    dropped: bool
    parent: int


class _Open(NamedTuple):
    name: str
    dropped: bool
    inside: bool
    #: Keys of the innermost block element from here outwards, and of the next one around it; 0 if there is none.
    inner: int
    outer: int
    #: Where in the stack the innermost element lies that ends, or keeps from ending, what is open; -1 if none does.
    wall: int


_PAGE = _Open("", False, False, 0, 0, -1)


def _marks(name: str, attrs: str, inside: bool) -> bool:
    """True if an element's own tag or attributes say that it is not part of the article."""
    if name in DROPPED:
        return True
    if name == "header" and not inside:
        return True
    if not attrs or name in ("html", "body"):
        return False
    for key, *values in _ATTR.findall(attrs):
        key, value = key.lower(), "".join(values)
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        if key == "role" and value.lower() in DROPPED_ROLES:
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return True
        if key in ("class", "id"):
            for one in value.split():
                names = {n.lower() for n in _NAMES.findall(one)}
                found = names & DROPPED_NAMES
                if names & KEPT_NAMES:
                    found -= LAYOUT_NAMES
                if found:
                    return True
    return False


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order, white space collapsed, references decoded."""
    out: list[Block] = []
    stack: list[_Open] = []
    # How many elements of each name are open, so that a stray end tag costs nothing.
    names: Counter[str] = Counter()
    held: list[str] = []
    linked = 0
    in_link = heading = False
    opened = 0

    def flush() -> None:
        nonlocal linked, in_link
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                top = stack[-1] if stack else _PAGE
                out.append(Block(text, linked, heading, top.inside, top.dropped, top.outer))
            held.clear()
        linked, in_link = 0, False

    def close(depth: int) -> None:
        """Close all from a place in the stack on; every element is closed once."""
        while len(stack) > depth:
            names[stack.pop().name] -= 1

    at, n = 0, len(page)
    while at < n:
        tag = _TAG.search(page, at)
        upto = tag.start() if tag else n
        if upto > at:
            piece = page[at:upto]
            held.append(piece)
            if in_link:
                linked += len(" ".join(piece.split()))
        if not tag:
            break
        at = tag.end()
        name = (tag["name"] or tag["name2"] or "").lower()
        if not name:
            if tag[0].startswith("<![CDATA["):
                held.append(html.escape(tag[0][9:].removesuffix("]]>")))
            continue
        if tag["end"] or tag["end2"]:
            if name in BLOCKS:
                flush()
                heading = heading and name not in HEADINGS
            elif name == "a":
                in_link = False
            if names[name]:
                depth = next(k for k in range(len(stack) - 1, -1, -1) if stack[k].name == name)
                if name not in BLOCKS and stack[-1].dropped != (stack[depth - 1].dropped if depth else False):
                    flush()
                close(depth)
            continue
        attrs = tag["attrs"] or tag["attrs2"] or ""
        top = stack[-1] if stack else _PAGE
        if name in BLOCKS:
            flush()
            if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") or name in HEADINGS:
                # These end an open paragraph; items also end the item before them.
                same = {"p"} if name == "p" or name in HEADINGS else {"p", name} | ({"td", "th"} if name in ("td", "th", "tr") else set())
                k = top.wall
                while k >= 0 and stack[k].name not in same and stack[k].name not in BLOCKS:
                    k = stack[k - 1].wall if k else -1
                if k >= 0 and stack[k].name in same:
                    close(k)
                top = stack[-1] if stack else _PAGE
            heading = name in HEADINGS
        elif name == "a":
            in_link = True
        elif name == "br":
            held.append(" ")
        inside = top.inside or ((name in ROOTS or 'role="main"' in attrs or "articleBody" in attrs) and not top.dropped)
        own = _marks(name, attrs, inside)
        if name in VOID or attrs.rstrip().endswith("/") and name in ("path", "use", "rect", "circle"):
            continue
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            if not end:
                break
            at = page.find(">", end.end())
            at = n if at < 0 else at + 1
            continue
        if own and name not in BLOCKS and not top.dropped:
            flush()
        opened += 1
        inner, outer = (opened, top.inner) if name in BLOCKS else (top.inner, top.outer)
        wall = len(stack) if name in BLOCKS or name == "option" else top.wall
        stack.append(_Open(name, top.dropped or own, inside, inner, outer, wall))
        names[name] += 1
    flush()
    return out


def _foreign(text: str) -> bool:
    """Whether most letters are of scripts whose languages have no stop words here."""
    letters = sum(map(len, _WORD.findall(text)))
    return 2 * len(_FOREIGN.findall(text)) > letters


def _first_pass(block: Block, rooted: bool) -> str:
    """good, bad, near (prose of few function words) or short."""
    if block.dropped or (rooted and not block.inside):
        return "bad"
    length = len(block.text)
    if block.linked > MAX_LINKS * length:
        return "bad"
    if not block.inside and block.text.startswith(("©", "(c) ", "Copyright ")):
        return "bad"
    if block.heading:
        return "short"
    if length < SHORT:
        return "bad" if block.linked and not block.inside else "short"
    if _foreign(block.text):
        # No stop words are known; length and links have to do.
        return "good" if length > LONG else "near"
    words = _WORD.findall(block.text.lower())
    density = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if density >= HIGH_STOPS:
        return "good" if length > LONG else "near"
    return "near" if density >= LOW_STOPS or block.inside else "bad"


def _nearest(found: list[Block], kinds: list[str], order: range) -> list[tuple[str, str, int]]:
    """Per block in order: the class decided last, the one decided last under the same parent, and how far back."""
    out, last, under = [], "none", {}
    for k in order:
        kind, at = under.get(found[k].parent, ("none", 0))
        out.append((last, kind, abs(k - at)))
        # What an element's name excludes says nothing about its neighbours.
        if kinds[k] != "short" and not found[k].dropped:
            last = "bad" if kinds[k] == "bad" else "good"
            under[found[k].parent] = (last, k)
    return out


def _second_pass(found: list[Block], kinds: list[str]) -> list[bool]:
    """Whether each block is kept; ambiguous ones take the class of their nearest decided neighbours."""
    before = _nearest(found, kinds, range(len(kinds)))
    after = _nearest(found, kinds, range(len(kinds) - 1, -1, -1))[::-1]
    keep = []
    for block, kind, (b, own_b, far_b), (a, own_a, far_a) in zip(found, kinds, before, after, strict=True):
        siblings = [(far, own) for far, own in ((far_b, own_b), (far_a, own_a)) if own != "none"]
        if kind != "short":
            keep.append(kind != "bad")
        elif block.inside:
            keep.append(True)  # an article's ends count as decided neighbours
        elif siblings:
            keep.append(min(siblings, key=lambda x: (x[0], x[1] != "good"))[1] == "good")
        elif block.heading:
            keep.append(a == "good")
        else:
            keep.append(b == a == "good")
    return keep


def main_text(page: str | None) -> str:
    """The article of a page; empty for null, empty and text-free pages."""
    found = blocks(page or "")
    rooted = any(b.inside and not b.dropped for b in found)
    kinds = [_first_pass(b, rooted) for b in found]
    return " ".join(b.text for b, kept in zip(found, _second_pass(found, kinds), strict=True) if kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (id, url, text, n_chars), one per row of pages, repeated ids included.

    text is empty where the html is null or has no article; n_chars counts its code points.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "html"):
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, url string, text string, n_chars long")
