"""HTML extraction by wrappers: union-free regular expressions inferred from all pages of a host.

A page's tokens are read as a tree of blocks, in which neighbouring paragraphs, items or rows are one
repeated group; that is a wrapper of one page. Wrappers of pages of one host are aligned, element by
element from the root: what is equal stays. At a mismatch neighbouring elements or groups of
elements that are alike become one repeated group, on both sides; what one side still lacks becomes
optional, and text is a slot. Every slot adds up what stood there: pages,
characters, characters of links, and its commonest values. Alignment is a merge, so each task folds the
pages it reads into one wrapper a host, and these are aligned in two more rounds; no host is in one
task with its pages, and all pages of a host take part.

A host's wrapper says which slots are article:
- Its region is what stands in article or main elements; where there are none, the deepest container that holds
  more than half of the text of slots that are no links, no template (one value on nearly all pages), and not
  named as boilerplate. A container with paragraphs of its own is not entered further, and one without a
  heading gives way to the next one that has one.
- In the region all slots are kept, but for elements that are boilerplate by themselves (DROPPED, PLAIN) and,
  where the region was found by its text, lists of links and template text that at least three different pages share; headings stay.

Every page is then parsed by the wrapper of its host: its blocks are aligned with the wrapper's, and the texts of
those bound to kept slots are the result. Where that is less than half of a page's text, template text
aside, and the page has no article or main element, the page's own wrapper decides as well.

Character references are decoded, white space inside a block becomes one blank, and blocks are joined
by newlines. Numbers in ids, as in post-123, are no part of a symbol. An element with more than LIMIT
different groups of children becomes one repeated group of optional ones, and with more than LIMIT symbols
their classes are left out, so wrappers stay small however pages differ. Elements deeper than DEPTH
belong to the one at that depth. Nothing is cut.

Null pages and pages without content give an empty text. Pages without a url share the host "".
Repeated rows repeat their result; an empty table has no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import html as entities
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabula.llm.memory import freeing, releasing, small_batches
from fabula.llm.scratch import written

#: Longest repeated group in children; most groups of children, and most symbols of them; depth; wrappers of pages that a task holds before it aligns them; groups into which a host's partial wrappers are dealt; bytes of all wrappers up to which they are broadcast.
LONGEST, LIMIT, DEPTH, HELD, SALTS, BROADCAST_BYTES = 6, 64, 120, 200, 64, 8 << 20
#: Share of a container's text that makes its child the region; share of pages from which a value is template text (counts are kept for VALUES values, which makes them at most a fifth too small); share of own paragraphs at which a container is not entered.
REGION_SHARE, TEMPLATE_SHARE, VALUES, OWN_SHARE = 0.5, 0.8, 4, 0.2

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
MARK = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PER_PAGE = re.compile(r"\d{2,}")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that an open tag of the same kind ends.
SELF_ENDING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table div article section main body td th blockquote".split())
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: Boilerplate by element; an article's own header is not.
DROPPED = RAW | frozenset("head nav header footer aside form button select svg canvas object audio video dialog menu".split())
#: Class names that are boilerplate wherever they stand.
PLAIN = frozenset("ad ads advert adverts advertisement sponsored comments comment-list commentlist comments-area sidebar navbar nav menu footer breadcrumb breadcrumbs cookies cookie-notice cookie-banner newsletter pagination".split())
#: Names that make a container outside the region boilerplate.
CLASSES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|sidebar|side|menu|nav\w*|breadcrumbs?|cookies?|consent|notices?|alert|popup|modal|overlay|newsletter|subscribe|signup|social|share|sharing|related|recommend\w*"
    r"|comments?|replies|disqus|footer|header|masthead|toolbar|pagination|pager|search|login|skip|hidden|complementary|navigation|contentinfo|form)(?:$|[\s_-])",
    re.I,
)
#: Elements that hold the text itself; a region is the container around them.
TEXTUAL = frozenset("p li h1 h2 h3 h4 h5 h6 pre td th dt dd caption figcaption".split())
HEADINGS, PARAGRAPHS = frozenset("h1 h2 h3 h4 h5 h6".split()), frozenset("p pre li dd td blockquote".split())
#: Elements that are taken for a part of the container around them.
GROUPS = frozenset("ul ol dl table tbody thead tfoot tr blockquote figure".split())


class Block:
    """An element of a page that is no inline one. own, links: characters outside and inside of links; value: a checksum of its texts."""

    __slots__ = ("symbol", "kids", "own", "links", "value", "depth", "keep")

    def __init__(self, symbol: str, depth: int) -> None:
        self.symbol, self.kids, self.own, self.links, self.value, self.depth, self.keep = symbol, [], 0, 0, 0, depth, False


def read(page: str) -> tuple[Block, list[tuple[Block | None, str]]]:
    """The root of a page's blocks, and its texts in order: (block, text), (None, " ") for a line break, (None, "") where a block begins or ends."""
    root = Block("", 0)
    out: list[tuple[Block | None, str]] = []
    stack: list[tuple[str, Block, bool]] = [("", root, False)]  # name, block, inside a link
    at, size, search = 0, len(page), TOKEN.search
    while True:
        m = search(page, at)
        text = page[at : m.start() if m else size]
        if not m:
            text = re.sub(r"<[/!?a-zA-Z][^>]*\Z", "", text)  # a tag that the page's end cuts off
        if text:
            _, block, link = stack[-1]
            bare = text.strip()
            if bare:
                if link:
                    block.links += len(bare)
                else:
                    block.own += len(bare)
                block.value = zlib.crc32(bare.encode("utf-8", "replace"), block.value)
            out.append((block, text))
        if not m:
            return root, out
        at = m.end()
        name = m[2] and m[2].lower()
        if not name:
            continue
        inline = name in INLINE
        if name == "br":
            out.append((None, " "))
        elif not inline:
            out.append((None, ""))
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        if name in VOID or m[3].endswith("/") and name not in ("p", "div", "a", "span"):
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        ends = SELF_ENDING.get(name, set()) | ({"p"} if name in ENDS_P else set())
        if ends:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in ends:
                    del stack[k:]
                    break
                if stack[k][0] in SCOPES:
                    break
        _, block, link = stack[-1]
        marks = []
        if m[3]:
            for g in MARK.findall(m[3]):
                x = g[1] or g[2] or g[3]
                marks += (PER_PAGE.sub("", x) if g[0].lower() == "id" else x).lower().split()
        if inline and not PLAIN.intersection(marks):
            stack.append((name, block, link or name == "a"))
            continue
        if block.depth < DEPTH:
            inner = Block(f"{name}.{' '.join(sorted(set(marks)))}" if marks else name, block.depth + 1)
            block.kids.append(inner)
            block = inner
        stack.append((name, block, link))


class Wrapper:
    """A node of a wrapper. symbol: of the element, "()" for a group; any: its children come in any order and number; optional, repeated: of itself.
    pages, own, links, values (checksum -> pages, at most VALUES), seen (checksums of up to three different pages): what stood in its slot. blocks: those of a page that it was made from."""

    __slots__ = ("symbol", "kids", "any", "bare", "optional", "repeated", "pages", "own", "links", "values", "seen", "blocks", "key")

    def __init__(self, symbol: str) -> None:
        self.symbol, self.kids, self.any, self.bare, self.optional, self.repeated = symbol, [], False, False, False, False
        self.pages, self.own, self.links, self.values, self.seen, self.blocks = 0, 0, 0, {}, (), []
        self.key = symbol

    @property
    def name(self) -> str:
        return self.symbol.partition(".")[0]

    def mark(self) -> None:
        """Sets the key by which children of one parent are told apart: the symbol, and for containers what stands in them."""
        self.key = self.symbol
        if self.name not in TEXTUAL:
            inside = sorted({k.symbol for k in self.kids})
            self.key += "{" + ",".join(inside) + ("#" if self.own > self.links else "@" if self.links else "") + "}"

    def dump(self) -> list:
        return [
            self.symbol, self.any | self.bare << 1 | self.optional << 2 | self.repeated << 3, self.pages, self.own, self.links, [list(x) for x in self.values.items()], list(self.seen), [k.dump() for k in self.kids],
        ]


def load(x: list) -> Wrapper:
    w = Wrapper(x[0])
    w.any, w.bare, w.optional, w.repeated = (bool(x[1] >> k & 1) for k in range(4))
    w.pages, w.own, w.links, w.values, w.seen, w.kids = x[2], x[3], x[4], dict(map(tuple, x[5])), tuple(x[6]), [load(k) for k in x[7]]
    w.mark()
    return w


def of_page(block: Block, page: int = 0) -> Wrapper:
    """The wrapper of one page. page: its checksum."""
    w = Wrapper(block.symbol)
    w.blocks, w.own, w.links, w.pages = [block], block.own, block.links, 1
    if block.own or block.links:
        w.values, w.seen = {block.value: 1}, (page,)
    kids = [of_page(k, page) for k in block.kids]
    w.kids = folded(kids, 1, True) if len(kids) <= LIMIT else folded(kids)
    _bounded(w)
    w.mark()
    return w


def _same_page(a: Wrapper, b: Wrapper) -> Wrapper:
    """Two neighbours of one page as one."""
    out = align(a, b, True)
    out.repeated = True
    return out


def folded(kids: list[Wrapper], longest: int = LONGEST, textual: bool = False) -> list[Wrapper]:
    """Neighbouring equal children, then groups of them, as one repeated child. Shortest groups first. textual: only paragraphs and the like."""
    for size in range(1, longest + 1):
        if len(kids) < 2 * size:
            break
        keys, out, k = [x.key for x in kids], [], 0
        while k < len(kids):
            body, z = keys[k : k + size], k + size
            if keys[z : z + size] != body or textual and kids[k].name not in TEXTUAL:
                out.append(kids[k])
                k += 1
                continue
            group = _group(kids[k:z])
            while keys[z : z + size] == body:
                group = _same_page(group, _group(kids[z : z + size]))
                z += size
            out.append(group)
            k = z
        kids = out
    return kids


def grouped(kids: list[Wrapper], known: list[list[str]]) -> list[Wrapper]:
    """The same with single occurrences of groups that are known to repeat as groups. known: the keys of such groups."""
    for body in known:
        out, k = [], 0
        while k < len(kids):
            if [x.key for x in kids[k : k + len(body)]] == body:
                out.append(_group(kids[k : k + len(body)]))
                k += len(body)
            else:
                out.append(kids[k])
                k += 1
        kids = out
    return kids


def _group(kids: list[Wrapper]) -> Wrapper:
    if len(kids) == 1:
        return kids[0]
    w = Wrapper("()")
    w.kids, w.pages = kids, 1
    w.mark()
    return w


def _bounded(w: Wrapper) -> None:
    """Keeps a wrapper small: beyond LIMIT children one group in any order, then one without classes."""
    w.any = w.any or len(w.kids) > LIMIT
    if w.any:
        w.kids = _by_symbol(w.kids, w.bare)
        if len(w.kids) > LIMIT and not w.bare:
            w.bare, w.kids = True, _by_symbol(w.kids, True)


def _by_symbol(kids: list[Wrapper], bare: bool) -> list[Wrapper]:
    by: dict[str, Wrapper] = {}
    for k in [x for k in kids for x in (k.kids if k.symbol == "()" else (k,))]:
        if bare:
            k.symbol = k.name
        k.optional = k.repeated = True
        by[k.symbol] = align(by[k.symbol], k, True) if k.symbol in by else k
    return [by[s] for s in sorted(by)]


def levelled(a: list[Wrapper], b: list[Wrapper]) -> tuple[list[Wrapper], list[Wrapper]]:
    """Children of two nodes, with repeated groups on both sides where they don't match as they are."""
    if [x.key for x in a] == [y.key for y in b]:
        return a, b
    if len(a) != len(b):
        a, b = folded(a), folded(b)
    known = [[k.key for k in x.kids] for x in (*a, *b) if x.symbol == "()"]
    return (grouped(a, known), grouped(b, known)) if known else (a, b)


def matched(a: list[Wrapper], b: list[Wrapper]) -> Iterator[tuple[Wrapper | None, Wrapper | None]]:
    """Children of two nodes side by side, None where one side lacks the other's. First those of equal keys, then what is left between them by symbol."""

    def runs(x: list[str], y: list[str]):
        if x == y:
            return [("equal", 0, len(x), 0, len(y))]
        return SequenceMatcher(None, x, y, autojunk=False).get_opcodes()

    for kind, i, j, k, m in runs([x.key for x in a], [y.key for y in b]):
        if kind == "equal":
            yield from zip(a[i:j], b[k:m], strict=True)
            continue
        for inner, p, q, r, s in runs([x.symbol for x in a[i:j]], [y.symbol for y in b[k:m]]):
            if inner == "equal":
                yield from zip(a[i + p : i + q], b[k + r : k + s], strict=True)
            else:
                yield from ((x, None) for x in a[i + p : i + q])
                yield from ((None, y) for y in b[k + r : k + s])


def align(a: Wrapper, b: Wrapper, one_page: bool = False) -> Wrapper:
    """The expression that matches what either matches; their slots are added up."""
    a.own, a.links, a.blocks = a.own + b.own, a.links + b.links, a.blocks + b.blocks
    if one_page:  # a slot of several blocks has one value a page; of several slots of many pages it isn't known
        values = [*a.values, *b.values]
        a.values = {} if max(a.pages, b.pages) > 1 or not values else {zlib.crc32(repr(values).encode()) if len(values) > 1 else values[0]: 1}
        a.pages = max(a.pages, b.pages)
    else:
        a.pages += b.pages
        for v, n in b.values.items():
            a.values[v] = a.values.get(v, 0) + n
        if len(a.values) > VALUES:  # counts become too small by the same number for all
            least = sorted(a.values.values(), reverse=True)[VALUES]
            a.values = {v: n - least for v, n in a.values.items() if n > least}
    a.seen = tuple(sorted({*a.seen, *b.seen})[:3])
    a.optional, a.repeated = a.optional or b.optional, a.repeated or b.repeated
    if a.any or b.any or a.bare or b.bare:
        a.any, a.bare = True, a.bare or b.bare
        mine, theirs = ({k.symbol: k for k in _by_symbol(x.kids, a.bare)} for x in (a, b))
        a.kids = [align(mine[x], theirs[x], one_page) if x in mine and x in theirs else mine.get(x) or theirs[x] for x in sorted({*mine, *theirs})]
    else:
        kids = []
        for x, y in matched(*levelled(a.kids, b.kids)):
            if x is not None and y is not None:
                kids.append(align(x, y, one_page))
            else:
                one = x if x is not None else y
                one.optional = True
                kids.append(one)
        a.kids = folded(kids, 1) if any(x.key == y.key and (x.repeated or y.repeated) for x, y in zip(kids, kids[1:])) else kids
    _bounded(a)
    a.mark()
    return a


def infer(pages: list[str]) -> Wrapper | None:
    """The wrapper of some pages."""
    out = None
    for page in pages:
        w = of_page(read(page)[0], zlib.crc32(page.encode("utf-8", "replace")))
        out = w if out is None else align(out, w)
    return out


def show(w: Wrapper) -> str:
    """The wrapper as a regular expression over tags and slots."""
    inside = ("#" if w.own or w.links else "") + "".join(map(show, w.kids))
    inside = f"({inside})*" if w.any else inside
    if w.symbol not in ("", "()"):
        inside = f"<{w.symbol}>{inside}</{w.name}>"
    sign = "*" if w.optional and w.repeated else "?" if w.optional else "+" if w.repeated else ""
    return f"({inside}){sign}" if sign else inside


def _marks(w: Wrapper) -> str:
    return w.symbol.partition(".")[2]


def _boilerplate(w: Wrapper, in_article: bool) -> bool:
    """By its own element or name."""
    return w.name in DROPPED and not (in_article and w.name == "header") or bool(PLAIN.intersection(_marks(w).split()))


def _template(w: Wrapper, pages: int) -> bool:
    """Whether the slot has one value on nearly all of at least so many different pages."""
    return len(w.seen) >= pages and max(w.values.values(), default=0) >= TEMPLATE_SHARE * w.pages


def _explicit(w: Wrapper) -> bool:
    return w.name in ("article", "main") or w.name in ("div", "section") and bool(re.search(r"\b(main|article)\b", _marks(w)))


def decide(root: Wrapper) -> set[int]:
    """The nodes (by id) whose slots are kept."""
    explicit: list[tuple[Wrapper, bool]] = []
    mass: dict[int, int] = {}

    def weigh(w: Wrapper, out: bool, in_article: bool) -> int:
        """Text of a node that may be article, by name."""
        inside = in_article or w.name == "article"
        out = out or _boilerplate(w, in_article) or w.name not in ("html", "body") and not inside and not _explicit(w) and bool(CLASSES.search(_marks(w)))
        n = 0 if out else w.own + w.links
        total = n + sum([weigh(k, out, inside) for k in w.kids])
        if total and _explicit(w):
            explicit.append((w, in_article))
        return total

    weigh(root, False, False)
    kept: set[int] = set()

    def keep(w: Wrapper, in_article: bool, found: bool) -> None:
        """found: by its text, so that links and template text in it are told apart."""
        if _boilerplate(w, in_article):
            return
        if not found and not in_article and not _explicit(w) and CLASSES.search(_marks(w)) and w.name != "article":
            return
        if not found or w.name in HEADINGS or not (w.links > w.own or _template(w, 3)):
            kept.add(id(w))
        for k in w.kids:
            keep(k, in_article or w.name == "article", found)

    if explicit:
        for w, in_article in explicit:
            keep(w, in_article, False)
        return kept

    def text(w: Wrapper, out: bool, plain: bool) -> int:
        out = out or _boilerplate(w, False) or plain and w.name not in ("html", "body") and bool(CLASSES.search(_marks(w)))
        own = 0 if out or plain and (w.links > w.own or _template(w, 2)) else w.own
        mass[id(w)] = total = own + sum([text(k, out, plain) for k in w.kids])
        return total

    text(root, False, True) or text(root, False, False)
    up = [root]

    def inner(w: Wrapper) -> list[Wrapper]:
        """Children, with groups and elements that are part of their container opened."""
        return [y for k in w.kids for y in (inner(k) if k.symbol == "()" or k.name in GROUPS and "." not in k.symbol else (k,))]

    while True:
        here = up[-1]
        kids = inner(here)
        best = max((k for k in kids if k.name not in TEXTUAL), key=lambda k: mass[id(k)], default=None)
        if best is None or mass[id(best)] <= REGION_SHARE * mass[id(here)]:
            break
        if sum(mass[id(k)] for k in kids if k.name in PARAGRAPHS) > OWN_SHARE * mass[id(here)]:
            break
        up.append(best)

    def headed(w: Wrapper) -> bool:
        return any(k.name in HEADINGS and mass[id(k)] or headed(k) for k in w.kids)

    at = len(up) - 1
    if not headed(up[at]):
        for k in range(at - 1, -1, -1):
            if up[k].name in ("", "html", "body"):
                break
            if headed(up[k]):
                at = k
                break
    keep(up[at], False, True)
    if not any(id(w) in kept and (w.own or w.links) for w in _nodes(up[at])):
        for w in _nodes(up[at]):
            if not _boilerplate(w, False):
                kept.add(id(w))
    return kept


def _nodes(w: Wrapper) -> Iterator[Wrapper]:
    yield w
    for k in w.kids:
        yield from _nodes(k)


def unrolled(mine: list[Wrapper], page: list[Wrapper]) -> tuple[list[Wrapper], list[Wrapper]]:
    """A wrapper's children with repeated ones as often as a page may need them, and a page's without groups."""
    page = [z for y in page for z in (y.kids if y.symbol == "()" else (y,))]
    if [x.key for x in mine] == [y.key for y in page]:
        return mine, page
    n = Counter(y.symbol for y in page)
    out = []
    for x in mine:
        body = x.kids if x.symbol == "()" else [x]
        out += body * (max(1, *(n[k.symbol] for k in body)) if x.repeated and body else 1)
    return out, page


class Rules:
    """A host's wrapper with its kept slots and those of template text, and what it says of page structures met before."""

    def __init__(self, wrapper: Wrapper, kept: set[int]) -> None:
        self.wrapper, self.known = wrapper, {}
        self.slots: dict[int, bool | None] = {id(w): True if id(w) in kept else None if _template(w, 3) else False for w in _nodes(wrapper)}

    def bind(self, page: Wrapper) -> None:
        """Sets ``keep`` of the page's blocks by the slots that they are bound to; None for template text."""
        sign = signature(page)
        flags = self.known.get(sign)
        if flags is None:
            found: dict[int, bool | None] = {}
            self._walk(self.wrapper, page, found)
            flags = [found.get(id(w), False) for w in _nodes(page)]
            if len(self.known) < 1000:
                self.known[sign] = flags
        for w, keep in zip(_nodes(page), flags, strict=True):
            for b in w.blocks:
                b.keep = keep

    def _walk(self, mine: Wrapper, page: Wrapper, found: dict[int, bool | None]) -> None:
        found[id(page)] = self.slots[id(mine)]
        if mine.any or mine.bare or page.any:
            by = {x.symbol: x for x in [y for k in mine.kids for y in (k.kids if k.symbol == "()" else (k,))]}
            pairs = [(by.get(k.symbol) or by.get(k.name), k) for w in page.kids for k in (w.kids if w.symbol == "()" else (w,))]
        else:
            pairs = matched(*unrolled(mine.kids, page.kids))
        for x, y in pairs:
            if x is not None and y is not None:
                self._walk(x, y, found)
            elif y is not None:  # a wrapper that doesn't know the page: as its parent
                self._unknown(y, bool(found[id(page)]), found)

    def _unknown(self, page: Wrapper, keep: bool, found: dict[int, bool | None]) -> None:
        keep = keep and not _boilerplate(page, True)
        found[id(page)] = keep
        for k in page.kids:
            self._unknown(k, keep, found)


def signature(w: Wrapper) -> str:
    """The structure, without what stands in it."""
    inside = "".join(map(signature, w.kids))
    return f"{w.symbol}{'#' if w.own > w.links else '@' if w.links else ''}{'*' if w.any else ''}({inside})"


def extract(page: str, rules: Rules | None) -> str:
    """The main text of a page."""
    root, texts = read(page)
    own = of_page(root)
    if rules is None:
        rules = Rules(own, decide(own))
    rules.bind(own)
    sizes = [(b, b.own) for w in _nodes(own) for b in w.blocks if b.keep is not None]
    if 2 * sum(n for b, n in sizes if b.keep) < sum(n for _, n in sizes):
        mine = decide(own)
        some = any(b.keep and b.own for b, _ in sizes)
        if not some or not any(_explicit(w) and any(b.keep for x in _nodes(w) for b in x.blocks) for w in _nodes(own)):
            for w in _nodes(own):
                if id(w) in mine:
                    for b in w.blocks:
                        b.keep = b.keep is not None
    blocks: list[str] = []
    words: list[str] = []

    def end() -> None:
        if words:
            text = " ".join(entities.unescape("".join(words)).split())
            if text:
                blocks.append(text)
            words.clear()

    last = None
    for block, text in texts:
        if block is None:
            if text:
                words.append(text)
            else:
                end()
        elif block.keep:
            if block is not last:
                end()
            last = block
            words.append(text)
    end()
    return "\n".join(blocks)


def _host():
    return F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))


PARTIAL = "host string, wrapper string"


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper for each host of a task, of its pages; more where it meets many hosts."""
    held: dict[str, dict[str, Wrapper]] = {}

    def together(by: dict[str, Wrapper]) -> Wrapper:
        return functools.reduce(align, [by[s] for s in sorted(by)])

    def out() -> pa.RecordBatch:
        b = pa.record_batch({"host": pa.array(held, pa.string()), "wrapper": pa.array([json.dumps(together(by).dump(), separators=(",", ":")) for by in held.values()], pa.string())})
        held.clear()
        return b

    for b in batches:
        for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
            w = of_page(read(page)[0], zlib.crc32(page.encode("utf-8", "replace")))
            for x in _nodes(w):
                x.blocks = []
            by = held.setdefault(host, {})
            sign = signature(w)
            by[sign] = align(by[sign], w) if sign in by else w
            if len(by) > HELD:
                held[host] = {"": together(by)}
        if len(held) > HELD:
            yield out()
    if held:
        yield out()


def _merged(table: pa.Table) -> pa.Table:
    found = functools.reduce(align, [load(json.loads(x)) for x in sorted(table.column("wrapper").to_pylist())])
    return pa.table({"host": table.column("host")[:1], "wrapper": pa.array([json.dumps(found.dump(), separators=(",", ":"))], pa.string())})


def wrappers(pages: DataFrame) -> DataFrame:
    """pages: page_id, url, html. Returns host, wrapper (JSON; ``load`` reads it) of all hosts that have pages."""
    seen = small_batches(pages).where("html is not null").select(_host().alias("host"), "html").mapInArrow(releasing(_partial), PARTIAL)
    some = seen.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS))).groupBy("host", "salt").applyInArrow(freeing(_merged), PARTIAL)
    return some.groupBy("host").applyInArrow(freeing(_merged), PARTIAL)


@functools.lru_cache(500)
def _rules(wrapper: str | None) -> Rules | None:
    if not wrapper:
        return None
    w = load(json.loads(wrapper))
    return Rules(w, decide(w))


def main_text(pages: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """pages: page_id, url, html. known: wrappers of the hosts, if not those of the pages themselves. Returns page_id, url, text, n_chars."""
    found = written((wrappers(pages) if known is None else known).select("host", "wrapper"), "wrappers")
    size = found.agg(F.sum(F.octet_length("wrapper") + F.octet_length("host") + 64)).first()[0] or 0
    rows = pages.select("page_id", "url", "html", _host().alias("host")).join(F.broadcast(found) if size <= BROADCAST_BYTES else found, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                b = whole.slice(k, 500)
                texts = [extract(h, _rules(c)) if h else "" for h, c in zip(b.column("html").to_pylist(), b.column("wrapper").to_pylist(), strict=True)]
                yield pa.record_batch({"page_id": b.column("page_id"), "url": b.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())})

    return small_batches(rows).select("page_id", "url", "html", "wrapper").mapInArrow(releasing(run), f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")


def op3_wrappers(spark, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
