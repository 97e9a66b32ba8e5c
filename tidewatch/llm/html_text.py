"""Blocks of text of an HTML page, with the containers they stand in.

A lenient reader: unknown or unclosed tags never fail, and the work is linear in the page, however
deep its elements are. What is no content by its tag (menus, scripts, controls) is left out on the
way. What a name in class, id or role makes doubtful, and forms, are judged when the page is read,
by what they hold (see ``_judge``).
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import defaultdict
from dataclasses import dataclass, field
from itertools import pairwise

#: Element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
DROPPED = RAW | frozenset(
    "head nav header footer aside button select option dialog menu svg math object audio video canvas".split()
)
CONTAINERS = frozenset("html body main article section div td th center details figure blockquote".split())
BLOCKS = CONTAINERS | frozenset(
    "p pre h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tbody thead tfoot tr caption figcaption address hr "
    "summary fieldset nav header footer aside form head br".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An open element of this name ends where one of the given names begins.
CLOSED_BY = {
    "p": BLOCKS - {"br"},
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "thead", "tfoot"}),
    "td": frozenset({"td", "th", "tr", "tbody", "thead", "tfoot"}),
    "th": frozenset({"td", "th", "tr", "tbody", "thead", "tfoot"}),
    "option": frozenset({"option"}),
}
CLOSES = {name: [own for own, ends in CLOSED_BY.items() if name in ends] for name in BLOCKS | CLOSED_BY.keys()}
#: What an element that ends others does not reach beyond.
BARRIERS = CONTAINERS | frozenset("ul ol dl table".split())
#: Words in class, id or role of what is no content, whatever its size.
NO_CONTENT = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar footer comment comments disqus respond cookie cookies consent popup modal "
    "share sharing newsletter subscribe subscription signup login pagination pager contentinfo complementary "
    "hidden".split()
)
#: Likewise, of what is no content unless most of a page's text stands in it.
DOUBTFUL = frozenset(
    "banner aside header masthead notice notices alert overlay dialog social related recommended search form widget "
    "toolbar".split()
)
COMMENTS = frozenset("comment comments disqus respond".split())
#: A word behind one of these tells of the page, not of the element.
NEGATING = frozenset("has with no without".split())
#: Of the page's text outside links, what a doubtful element must hold to be content, and how much at least.
MOST = 0.5
MIN_PROSE = 200
PARTS = frozenset("details figure blockquote".split())
#: Of the text of the path above, what a path must hold to be the better one; 0.6 for other elements.
SHARE = {"article": 0.4, "main": 0.4, "section": 0.9}
OWN_PROSE = 0.05
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*+)\s*+(?:=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*+")
#: The end of a tag, or what begins a value: a quote (group 1) or the unquoted value itself.
_TAG_STOP = re.compile(r""">|=\s*+(?:(["'])|[^\s>]*+)""")
_EMPTY_COMMENT = re.compile(r"<!---?>")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


def _path_hash(path: str = ""):
    return hashlib.blake2b(path.encode("utf-8", "surrogatepass"), digest_size=16)


def key_of(path: str) -> str:
    """The key of a path, of one size however long the path is; a page never holds the path itself."""
    return _path_hash(path).hexdigest()


@dataclass
class Page:
    """``containers[i]`` is (key of its path, parent), ``names[i]`` its element.

    ``blocks`` has (text, link characters, container).
    """

    containers: list[tuple[str, int]] = field(default_factory=lambda: [(key_of(""), -1)])
    names: list[str] = field(default_factory=lambda: [""])
    blocks: list[tuple[str, int, int]] = field(default_factory=list)


@dataclass
class _Doubt:
    """An element to be judged by what it holds; ``within`` is the doubt around it."""

    within: int
    certain: bool  # by its name it is no content
    comments: bool = False
    has_heading: bool = False  # a main element, or a heading of the first rank
    has_article: bool = False
    prose: int = 0


@dataclass(slots=True)
class _Open:
    """An open element, with what holds for all text in it."""

    name: str
    container: int = 0
    dropped: bool = False
    doubt: int = -1
    in_article: bool = False
    in_header: bool = False  # of an article, outside its headings and paragraphs
    in_link: bool = False


def _prose(text: str, links: int) -> int:
    return max(0, len(text) - 2 * links)


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(raw)}


def _is_dropped(name: str, given: dict[str, str], in_article: bool) -> bool:
    if name == "header" and in_article:
        return False  # the article's own; its headings and paragraphs are read
    if name in DROPPED or "hidden" in given or given.get("aria-hidden") == "true":
        return True
    return bool(_HIDDEN.search(given.get("style", "")))


def _doubt(name: str, given: dict[str, str], within: int) -> _Doubt | None:
    """The doubt that an element's name, class, id and role cast on it, if any."""
    if name in ("html", "body", "main"):
        return None
    found = set()
    for token in " ".join(given.get(k, "") for k in ("class", "id", "role")).split():
        words = [w.lower() for w in _WORD.findall(token)]
        if name == "article" and len(words) > 1:
            continue  # such as an article that is open to comments
        found.update(w for before, w in pairwise(["", *words]) if before not in NEGATING)
    if found & NO_CONTENT:
        return _Doubt(within, True, bool(found & COMMENTS))
    if found & DOUBTFUL or name == "form":
        return _Doubt(within, False)
    return None


def _step(name: str, given: dict[str, str]) -> str:
    """A path's step: tag and classes, with figures made alike."""
    classes = sorted({re.sub(r"\d+", "0", c) for c in given.get("class", "").lower().split()})
    return ".".join([name, *classes])


class _Reader:
    def __init__(self) -> None:
        self.page = Page()
        self.hashes = [_path_hash()]  # of each container's path, to go on from
        self.doubts: list[_Doubt] = []
        self.block_doubts: list[int] = []
        self.stack = [_Open("")]
        self.places: dict[str, list[int]] = defaultdict(list)  # of each name, where it is open
        self.barriers, self.containers, self.blocks = [-1], [-1], [-1]  # where such elements are open
        self.parts: list[str] = []
        self.link_chars = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                top = self.stack[-1]
                self.page.blocks.append((text, min(self.link_chars, len(text)), top.container))
                self.block_doubts.append(top.doubt)
        self.parts, self.link_chars = [], 0

    def text(self, raw: str) -> None:
        top = self.stack[-1]
        if not raw or top.dropped or top.in_header:
            return
        decoded = html.unescape(raw) if "&" in raw else raw
        self.parts.append(decoded)
        if top.in_link:
            self.link_chars += len(decoded)

    def open(self, name: str, raw: str) -> None:
        if name in BLOCKS:
            if name == "br":
                self.parts.append(" ")
                return
            self.flush()
        if name in CLOSES:
            self.close_for(name)
        if name in VOID:
            return
        top = self.stack[-1]
        given = _attributes(raw) if raw else {}
        own = _Open(name, top.container, top.dropped, top.doubt, top.in_article, top.in_header, top.in_link)
        own.dropped = top.dropped or _is_dropped(name, given, top.in_article)
        own.in_article = top.in_article or name in ("article", "main")
        own.in_header = name == "header" or (top.in_header and name != "p" and name not in HEADINGS)
        own.in_link = top.in_link or name == "a"
        if not own.dropped:
            if doubt := _doubt(name, given, top.doubt):
                self.doubts.append(doubt)
                own.doubt = len(self.doubts) - 1
            if own.doubt >= 0:
                self.doubts[own.doubt].has_heading |= name in ("h1", "main")
                self.doubts[own.doubt].has_article |= name == "article"
            if name in CONTAINERS:
                own.container = self.contain(name, given, top.container)
        self.push(own)

    def contain(self, name: str, given: dict[str, str], parent: int) -> int:
        path = self.hashes[parent].copy()
        path.update(f"/{_step(name, given)}".encode("utf-8", "surrogatepass"))
        self.hashes.append(path)
        self.page.containers.append((path.hexdigest(), parent))
        self.page.names.append(name)
        return len(self.page.containers) - 1

    def kinds(self, name: str) -> list[list[int]]:
        sets = ((BARRIERS, self.barriers), (CONTAINERS, self.containers), (BLOCKS, self.blocks))
        return [self.places[name], *[places for names, places in sets if name in names]]

    def push(self, own: _Open) -> None:
        for places in self.kinds(own.name):
            places.append(len(self.stack))
        self.stack.append(own)

    def cut(self, at: int) -> None:
        while len(self.stack) > at:
            for places in self.kinds(self.stack.pop().name):
                places.pop()

    def close_for(self, name: str) -> None:
        """End what cannot hold an element of this name, up to its container."""
        open_at = (self.places[own][-1] for own in CLOSES[name] if self.places[own])
        at = max(open_at, default=-1)
        if at >= 0 and at >= self.barriers[-1]:
            self.cut(at)

    def close(self, name: str) -> None:
        if not (name in self.places and self.places[name]):
            return
        at = self.places[name][-1]
        if self.containers[-1] > at and name not in CONTAINERS and name not in BLOCKS:
            return  # an inline end tag ends nothing outside its container
        if self.blocks[-1] >= at:
            self.flush()
        self.cut(at)

    def finish(self) -> Page:
        self.flush()
        if self.doubts:
            kept = _judge(self.doubts, self.page.blocks, self.block_doubts)
            blocks = zip(self.page.blocks, self.block_doubts, strict=True)
            self.page.blocks = [block for block, doubt in blocks if doubt < 0 or kept[doubt]]
        return self.page


def _judge(doubts: list[_Doubt], blocks: list[tuple[str, int, int]], block_doubts: list[int]) -> list[bool]:
    """Of each doubt, whether its element is content after all.

    It is if it holds the main element or a first heading, or if most of the page's text outside links
    stands in it. For an element whose name is certain the text must also stand in an article, and
    comments do not become content by their amount. What stands in a dropped element goes with it.
    """
    total = 0
    for (text, links, _), doubt in zip(blocks, block_doubts, strict=True):
        total += _prose(text, links)
        if doubt >= 0:
            doubts[doubt].prose += _prose(text, links)
    for own in reversed(doubts):  # what stands within another follows it
        if own.within >= 0:
            around = doubts[own.within]
            around.prose += own.prose
            around.has_heading |= own.has_heading
            around.has_article |= own.has_article
    kept: list[bool] = []
    for own in doubts:
        large = own.prose >= max(MOST * total, MIN_PROSE)
        content = not own.comments and (own.has_heading or (large and (own.has_article or not own.certain)))
        kept.append(content and (own.within < 0 or kept[own.within]))
    return kept


def _tag_end(page: str, at: int, no_quote: set[str]) -> int:
    """The ``>`` of the tag that begins at ``at``, passing over quoted values; -1 if none.

    A quote opens a value only behind ``=``, and the value goes on to the closing quote however
    far that is. Any other quote, and one that nothing closes, is a stray character.
    """
    while found := _TAG_STOP.search(page, at):
        if found.group() == ">":
            return found.start()
        at, quote = found.end(), found.group(1)
        if quote and quote not in no_quote:
            close = page.find(quote, at)
            if close < 0:
                no_quote.add(quote)
            else:
                at = close + 1
    return -1


def read(page: str) -> Page:
    reader, at, size = _Reader(), 0, len(page)
    no_quote: set[str] = set()
    lowered = ""
    while at < size:
        start = page.find("<", at)
        if start < 0:
            reader.text(page[at:])
            break
        reader.text(page[at:start])
        if empty := _EMPTY_COMMENT.match(page, start):
            at = empty.end()
            continue
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), start):
            end = page.find(">", start)
            at = size if end < 0 else end + 1
            continue
        name = _NAME.match(page, start + 1)
        if not name:
            reader.text("<")
            at = start + 1
            continue
        end = _tag_end(page, name.end(), no_quote)
        if end < 0:
            break  # a tag cut off at the page's end
        tag = name.group().lower()
        at = end + 1
        if tag[0] == "/":
            reader.close(tag[1:])
            continue
        raw = page[name.end() : end].rstrip("/")
        reader.open(tag, raw)
        if tag in RAW:
            lowered = lowered or page.lower()
            aligned = lowered if len(lowered) == size else page
            close = aligned.find(f"</{tag}", at)
            at = size if close < 0 else close
    return reader.finish()


def scores(page: Page) -> dict[str, float]:
    """Of each path that may be the page's main one: 1 for the best, and half for each step above it.

    The best path is looked for from the root down. A step goes to the path that holds the
    ``SHARE`` of the text outside links that its element needs. It is not taken from an article, nor
    from a path with ``OWN_PROSE`` of its text beside its containers (but for an article in it).
    Quotations, figures and details are parts of a text and never paths of their own.
    """
    prose: dict[str, int] = {}
    own_prose: dict[str, int] = defaultdict(int)
    element: dict[str, str] = {}
    inner: dict[str, list[str]] = defaultdict(list)
    of_path = []  # of each container, the path that its text counts for
    for (key, parent), name in zip(page.containers, page.names, strict=True):
        above = of_path[parent] if parent >= 0 else ""
        if parent >= 0 and (name in PARTS or element[above] in ("article", *PARTS)):
            of_path.append(above)
            continue
        if key not in element:
            element[key], prose[key] = name, 0
            if parent >= 0:
                inner[above].append(key)
        of_path.append(key)
    for text, links, container in page.blocks:
        own_prose[of_path[container]] += _prose(text, links)
    order = list(element)
    above_of = {key: above for above, keys in inner.items() for key in keys}
    for key in reversed(order):  # inner paths stand behind outer ones
        prose[key] += own_prose[key]
        if key in above_of:
            prose[above_of[key]] += prose[key]
    chain = [order[0]]
    while step := _step_down(chain[-1], inner, prose, own_prose, element):
        chain.append(step)
    return {key: 0.5**i for i, key in enumerate(reversed(chain))} if page.blocks else {}


def _step_down(at, inner, prose, own_prose, element) -> str | None:
    if element[at] == "article" or not prose[at] or not inner[at]:
        return None
    best = max(inner[at], key=lambda key: prose[key])  # the first of equals
    if prose[best] < SHARE.get(element[best], 0.6) * prose[at]:
        return None
    if own_prose[at] >= OWN_PROSE * prose[at] and element[best] not in ("article", "main"):
        return None
    return best


def depths(page: Page) -> list[int]:
    """Of each container: the steps of its path."""
    found = [0] * len(page.containers)
    for i, (_, parent) in enumerate(page.containers):
        found[i] = found[parent] + 1 if parent >= 0 else 0
    return found


def text_under(page: Page, path: str | None) -> str:
    """Blocks in containers of this path, in page order; None is the best container's."""
    return text_at(page, None if path is None else key_of(path))


def text_at(page: Page, key: str | None) -> str:
    """Likewise, by the path's key."""
    if key is None:
        found = scores(page)
        key = max(found, key=found.__getitem__) if found else None
    wanted = {i for i, (own, _) in enumerate(page.containers) if own == key}
    inside = [False] * len(page.containers)
    for i, (_, parent) in enumerate(page.containers):
        inside[i] = i in wanted or (parent >= 0 and inside[parent])
    return " ".join(text for text, _, container in page.blocks if inside[container])
