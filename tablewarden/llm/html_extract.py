"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. Blocks inside menus, asides, forms, notices, adverts and comments are
taken out by their markup: by tags, roles, and words of such parts as a class or id. Where such a word is only a part of
a name (``page-header``, ``no-sidebar``), the block stays if the part holds most of the page's text. Pass one decides the others on every page by link density, length and the share of stop
words. Marks of an article (article, main, role=main, articleBody) are one more feature: the part of the page with most
unlinked text, marked or not, is its main part; a block inside a marked main part needs less evidence, one in a part
with less than half of that text, which does not hold the main part, loses a step (good becomes undecided, undecided
bad). Pass two gives each undecided block the label of its nearest decided neighbour, inside a marked main part of the
nearest one that did not lose a step; between a good and a bad one at the same distance, bad wins, and a heading goes
with what follows it. A marked main part without any good block keeps its undecided ones.

Defined results: NULL, empty and tag-free pages are handled as pages (text without tags is one undecided block, kept
when no neighbour decides). Entities are decoded once, white space becomes one space. Repeated rows give repeated
results, an empty table an empty result; columns other than ``keep`` and ``html`` are not read.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_texts

# Common function words of four languages.
STOP_WORDS = frozenset(
    "a an and are as at be by for from in is it of on or that the this to was with "
    "aber auf aus bei das dem den der des die ein eine für ist mit nicht sich und von zu "
    "au avec ce dans de des du elle en est et la le les par pas pour que qui sur un une "
    "al como con del el en es la las lo los no para por que se su una y".split()
)
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre "
    "section select summary table tbody td tfoot th thead title tr ul".split()
)
RAW_TAGS = frozenset("script style noscript template textarea svg iframe canvas audio video title".split())
DROPPED_TAGS = frozenset("head nav footer aside form button select dialog menu fieldset".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo sidebar widget comment comments disqus reply "
    "replies footer header masthead nav navbar navigation menu breadcrumb breadcrumbs cookie cookies consent gdpr "
    "notice alert popup modal overlay newsletter subscribe signup login search share sharing social related "
    "recommended pagination pager toolbar skip hidden".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(?P<close>/?)(?P<tag>[A-Za-z][A-Za-z0-9:-]*)""", re.S
)
_TAG_SIGN = re.compile("[>\"']")
_ATTR = re.compile(r"""([A-Za-z_:][-A-Za-z0-9_:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_CUT_TAG = re.compile(r"<(?:/?[A-Za-z!?][^<>]*)?\Z")
_SPLIT = re.compile(r"[^0-9A-Za-z]+")

GOOD, BAD, UNDECIDED = 1, -1, 0
MANY_LINKS, SHORT, LONG, FEW_STOPS, MANY_STOPS = 0.5, 70, 200, 0.12, 0.24
INSIDE, NEUTRAL, OUTSIDE = 1, 0, -1
COMPARABLE = 0.5  # share of the main part's text from which on another part is not taken for surroundings


class TagEnds:
    """Where tags end: at the next ``>`` outside of quotes.

    A tag that is never closed is text, and the next one may begin inside its quotes. Quotes from which no end was reached
    are remembered, so all tags of a page together take time linear in its length.
    """

    def __init__(self, page: str):
        self.page, self.dead = page, set()
        self.searched, self.sign = 0, -1  # no sign from the one place to the other

    def _next_sign(self, at: int) -> int:
        if not self.searched <= at <= self.sign:
            found = _TAG_SIGN.search(self.page, at)
            self.searched, self.sign = at, found.start() if found else len(self.page)
        return self.sign

    def end(self, at: int) -> int:
        """The place of the ``>`` that ends the tag whose attributes begin at a place, or -1."""
        quotes = []
        while (sign := self._next_sign(at)) < len(self.page):
            if self.page[sign] == ">":
                return sign
            if sign in self.dead:
                break
            quotes.append(sign)
            close = self.page.find(self.page[sign], sign + 1)
            if close < 0:
                break
            at = close + 1
        self.dead.update(quotes)
        return -1


class Block:
    """A run of text between block tags. ``dropped`` lies in what is no text of the page, ``doubted`` are the numbers of
    the parts around it whose class or id speaks against them; a negative number speaks less clearly."""

    __slots__ = ("parts", "linked", "dropped", "doubted", "marked", "heading")

    def __init__(self, dropped: bool, doubted: tuple[int, ...], marked: tuple[int, ...], heading: bool):
        self.parts: list[str] = []
        self.linked, self.dropped, self.doubted, self.marked, self.heading = 0, dropped, doubted, marked, heading

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


WANTED, DOUBTED, REFUSED, DROPPED = range(4)


def _unwanted(tag: str, attrs: str, in_article: bool) -> int:
    """Whether a part is dropped, refused by a word that is its class or id, or doubted for a word among others in it
    (``no-sidebar`` says that there is none)."""
    if tag in DROPPED_TAGS or (tag == "header" and not in_article):
        return DROPPED
    if not attrs.strip():
        return WANTED
    found = WANTED
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id") and tag not in ("body", "html", "main"):
            if DROPPED_WORDS & set(value.split()):
                found = max(found, REFUSED)
            elif DROPPED_WORDS & set(_SPLIT.split(value)):
                found = max(found, DOUBTED)
        elif name == "role" and value in DROPPED_ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return DROPPED
        elif name == "style" and "display:none" in value.replace(" ", ""):
            return DROPPED
    return found


def _main_part(tag: str, attrs: str) -> bool:
    return tag in ("article", "main") or "articlebody" in attrs.lower() or bool(
        re.search(r"""role\s*=\s*["']?main""", attrs, re.I))


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order, with what their surroundings say."""
    blocks: list[Block] = []
    # Open block-level tags: dropped, doubted parts around, marked parts around.
    stack: list[tuple[str, bool, tuple[int, ...], tuple[int, ...]]] = []
    parts = doubts = 0
    ends = TagEnds(page)
    current: Block | None = None
    linked = False
    at = 0

    def state() -> tuple[bool, tuple[int, ...], tuple[int, ...]]:
        return stack[-1][1:] if stack else (False, (), ())

    def add(raw: str) -> None:
        nonlocal current
        if not raw:
            return
        if current is None:
            current = Block(*state(), bool(stack) and stack[-1][0] in HEADINGS)
            blocks.append(current)
        piece = entities.unescape(raw)
        current.parts.append(piece)
        if linked:
            current.linked += len(piece.strip())

    end = len(page)
    while at < end:
        found = _TOKEN.search(page, at)
        if found is None:
            add(_CUT_TAG.sub("", page[at:]))
            break
        tag = (found["tag"] or "").lower()
        stop = ends.end(found.end()) if tag else found.end()
        if stop < 0:  # never closed: text, but for a tag cut at the end of the page
            begin = page.find("<", found.end())
            begin = end if begin < 0 else begin
            add(_CUT_TAG.sub("", page[at:]) if begin == end else page[at:begin])
            at = begin
            continue
        add(page[at:found.start()])
        if not tag:
            at = stop
            continue
        closing, attrs, at = bool(found["close"]), page[found.end():stop], stop + 1
        if tag in RAW_TAGS and not closing and not attrs.rstrip().endswith("/"):
            close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = close.end() if close else end
            current = current if tag not in BLOCK_TAGS else None
            continue
        if tag == "a":
            linked = not closing
            continue
        if tag == "br":
            add("\n") if current is not None else None
            continue
        if tag not in BLOCK_TAGS:
            continue
        current, linked = None, False
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    break
        elif tag not in VOID_TAGS:
            if tag in ("p", "li", "td", "th", "tr", "dt", "dd", "option") or tag in HEADINGS:
                while stack and stack[-1][0] == "p":  # an open paragraph ends where the next block begins
                    stack.pop()
                if tag in ("li", "td", "th", "tr", "dt", "dd", "option") and stack and stack[-1][0] == tag:
                    stack.pop()
            dropped, doubted, marked = state()
            unwanted = _unwanted(tag, attrs, bool(marked))
            if unwanted in (DOUBTED, REFUSED):
                doubts += 1
                doubted += (doubts if unwanted == REFUSED else -doubts,)
            if not dropped and _main_part(tag, attrs):
                parts += 1
                marked += (parts,)
            stack.append((tag, dropped or unwanted == DROPPED, doubted, marked))
    return blocks


def _plain_size(block: Block, text: str) -> int:
    """Code points of a block's text outside of links; none for headings and lists of links."""
    return 0 if block.heading or block.linked > MANY_LINKS * len(text) else len(text) - block.linked


def undoubted(found: list[tuple[Block, str]]) -> list[tuple[Block, str]]:
    """The blocks outside of refused parts, and outside of doubted ones unless these hold most of the rest and no marked
    article with text stands beside them.

    Where that leaves no text but links and headings, the refused parts are all that the page has, and stay.
    """
    sizes = [_plain_size(block, text) for block, text in found]
    clear = [not any(d > 0 for d in block.doubted) for block, _ in found]
    if not any(size for size, c in zip(sizes, clear) if c):
        clear = [True] * len(found)
    whole = sum(size for size, c in zip(sizes, clear) if c)
    held: dict[int, int] = {}
    for (block, _), size, c in zip(found, sizes, clear):
        for part in block.doubted if c else ():
            held[part] = held.get(part, 0) + size
    articles = [set(block.doubted) for (block, _), size, c in zip(found, sizes, clear) if c and size and block.marked]
    gone = {
        part for part, size in held.items()
        if part < 0 and (2 * size < whole or any(part not in around for around in articles))
    }
    return [pair for pair, c in zip(found, clear) if c and not gone.intersection(pair[0].doubted)]


def priors(blocks: list[Block], texts: list[str]) -> list[int]:
    """What the marks say of each block, by the part of the page (marked or not) with most unlinked text."""
    running: dict[tuple[int, ...], int] = {}
    for block, text in zip(blocks, texts):
        running[block.marked] = running.get(block.marked, 0) + _plain_size(block, text)
    top = max(running, key=lambda part: (running[part], len(part)), default=())

    def prior(part: tuple[int, ...]) -> int:
        if part == top:
            return INSIDE if top else NEUTRAL
        around = part and part == top[:len(part)]  # the main part lies in this one
        return NEUTRAL if around or running[part] >= COMPARABLE * running[top] else OUTSIDE

    found = {part: prior(part) for part in running}
    return [found[block.marked] for block in blocks]


def first_pass(block: Block, text: str, prior: int) -> int:
    links = block.linked / max(1, len(text))
    if links > MANY_LINKS or text.startswith("©") or text.startswith("(c) ") and prior != INSIDE:
        return BAD
    words = text.split()
    stops = sum(w.strip(".,;:!?\"'()*#$%&").lower() in STOP_WORDS for w in words) / max(1, len(words))
    if block.heading:
        label = UNDECIDED if links <= 0.2 else BAD
    elif links > 0.2:  # some links: long text with stop words may still be one of the article
        label = UNDECIDED if len(text) >= SHORT and stops >= FEW_STOPS else BAD
    elif len(text) < SHORT:
        label = UNDECIDED
    else:
        label = GOOD if stops >= (FEW_STOPS if prior == INSIDE else MANY_STOPS) or len(text) >= LONG else UNDECIDED
    if prior == INSIDE:
        return max(label, UNDECIDED)
    return max(label - 1, BAD) if prior == OUTSIDE else label


def second_pass(labels: list[int], said: list[int], headings: list[bool]) -> list[bool]:
    """Undecided blocks take the label of the nearest decided one; without any they stay."""
    size = len(labels)
    some_good = any(label == GOOD and prior == INSIDE for label, prior in zip(labels, said))

    def nearest(order: range) -> list[tuple[int, int]]:
        found, last, last_inside = [(size + 1, 0)] * size, None, None
        for i in order:
            if labels[i]:
                last = i
                if said[i] != OUTSIDE:
                    last_inside = i
            at = last_inside if said[i] == INSIDE else last
            if at is not None:
                found[i] = (abs(i - at), labels[at])
        return found

    before, after = nearest(range(size)), nearest(range(size - 1, -1, -1))
    kept = []
    for i in range(size):
        (near, one), (far, two) = before[i], after[i]
        label = min(one, two) if near == far else one if near < far else two
        if headings[i] and two:
            label = two
        if said[i] == INSIDE and not some_good:
            label = GOOD
        kept.append((labels[i] or label) >= 0)
    return kept


def main_text(page: str | None) -> str:
    """The article of a page: kept blocks in page order, joined by one space."""
    if not page:
        return ""
    found = undoubted([(b, t) for b in blocks_of(page) if not b.dropped and (t := b.text)])
    said = priors([b for b, _ in found], [t for _, t in found])
    kept = second_pass([first_pass(b, t, p) for (b, t), p in zip(found, said)], said, [b.heading for b, _ in found])
    return " ".join(t for (_, t), keep in zip(found, kept) if keep)


def extract_main_text(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep``, ``text`` (the main text, empty if none) and ``n_chars`` (its code points) for every row."""

    def make():
        def score(texts):
            found = [main_text(t) for t in texts]
            return {"text": found, "n_chars": [len(t) for t in found]}

        return score

    return map_texts(pages, keep, html, make, {"text": pa.string(), "n_chars": pa.int64()})
