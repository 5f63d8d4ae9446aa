"""Main text of web pages by wrapper inference.

Pages of one host come from few templates.  Their token streams (tags and
texts) are aligned one after another with a growing wrapper, a union-free
regular expression over tokens:

* texts that differ become a slot;
* a run of tokens that repeats the group just matched makes that group a
  repeated one;
* any other surplus on either side becomes optional.

On a page that marks elements as article, the text in all of these is the
article, and so is the text at places of the wrapper that lie in such elements
on most pages.  For the other pages of the block the wrapper says which texts
vary: the region (a path of open tags, without marks that change from page to
page) that holds most of them is the article, and texts that most of the
block's distinct pages share stay out, as do repeated groups of links that pages share (menus); pages of
another layout have a region of their own.  Boilerplate
inside the region (by tag, class, id or role) stays out; a class, id or role
makes no boilerplate of an element that holds the article.

Pages are sorted by host and dealt in runs of at most ``BLOCK`` pages, one
wrapper each, so a host of any size is spread over many tasks and no task
holds more than one run of pages.  A lone page makes its own wrapper.

Null html counts as empty and has an empty text.  A null
or malformed url is a host of its own name; equal rows, equal and null ids
are pages like others; extra columns are ignored.
"""
from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .url_filter import url_parts

BLOCK = 64
#: Tokens looked ahead for the end of a surplus, and back for a repeated group.
REACH = 400

# What HTML says about its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe object svg math select".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol p pre section "
                   "summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("article body center div main section table tbody td".split())
SINGLE = frozenset("html body article main".split())
TABLE = frozenset("table thead tbody tfoot tr td th".split())
ITEMS = frozenset("li dt dd td th".split())
CLOSED_BY = {  # an open element of the key ends where one of these begins
    "p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"}, "option": {"option"}}
# Elements, roles and class words of what is not the article.
OUT_TAGS = frozenset("nav footer aside form button dialog menu head".split())
OUT_WORDS = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie "
                      "cookies disqus footer masthead menu modal nav navbar navigation newsletter notice pagination "
                      "popup promo promoted related replies search share sharing sidebar social sponsor sponsored "
                      "subscribe toolbar widget".split())
IN_TAGS, IN_WORDS = frozenset({"article", "main"}), frozenset("article main".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S)
_MARK = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_DIGITS = re.compile(r"\d+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in RAW}


@dataclass(slots=True)
class Token:
    key: str          # tag with its marks, "/tag", or "" for a text
    text: str
    path: tuple       # keys of the open elements around it
    linked: int = 0   # characters of the text inside links


@dataclass(slots=True, eq=False)
class Node:
    key: str
    text: str | None  # a text all pages share; None: a slot
    path: tuple
    prev: Node | None = None
    next: Node | None = None
    loops: dict[str, Node] | None = None  # repeated groups that end here: first key, first node
    gone: bool = False
    pos: int = -1     # place in the wrapper when last counted

    @property
    def back(self) -> int:
        """Where a repeated group that ends here begins, or -1."""
        return max((n.pos for n in (self.loops or {}).values() if not n.gone), default=-1)


def tokens(page: str) -> list[Token]:
    """Tags and texts of a page with the elements they stand in.  Contents of
    scripts, styles and the like are dropped; white space alone is no text.
    Inline tags without a class, id or role part no text, and elements that
    end by implication get their end tag, so that loose markup aligns."""
    out: list[Token] = []
    stack: list[str] = []
    names: list[str] = []
    at, end, in_link = 0, len(page), False

    def close(depth: int) -> None:
        while len(names) > depth:
            stack.pop()
            out.append(Token("/" + names.pop(), "", tuple(stack)))

    while at < end:
        m = _TOKEN.match(page, at)
        if m is None:
            break
        at = m.end()
        if (text := m["text"]) is not None:
            if out and not out[-1].key:
                out[-1].text += text
            elif not text.isspace():
                out.append(Token("", text, tuple(stack)))
            else:
                continue
            out[-1].linked += len(text) if in_link else 0
            continue
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if name == "a":
            in_link = not m["close"]
        if m["close"]:
            if name in names:
                close(len(names) - 1 - names[::-1].index(name))
            continue
        while at_fault := [k for k in range(max(0, len(names) - 6), len(names)) if name in CLOSED_BY.get(names[k], ())]:
            close(at_fault[0])  # with the inline elements left open inside
        marks = " ".join(sorted(next(filter(None, g[1:]), "").lower() for g in _MARK.findall(m["attrs"])))
        if not marks and name not in BLOCKS and name not in RAW:
            if name == "br" and out and not out[-1].key:
                out[-1].text += " "
            continue
        key = f"{name} {marks}" if marks else name
        out.append(Token(key, "", tuple(stack)))
        if name in RAW:
            stop = _RAW_END[name].search(page, at)
            at = stop.end() if stop else end
        elif name not in VOID and not m["attrs"].rstrip().endswith("/"):
            stack.append(key)
            names.append(name)
    return out


class Wrapper:
    """The expression is a ring of linked nodes, so that it grows and folds
    without a look at its other nodes, whatever its length."""

    def __init__(self, first: list[Token]):
        self.end = end = Node("/", "", ())
        end.prev = end.next = end
        self.follow(first)

    @property
    def nodes(self) -> list[Node]:
        out, n = [], self.end.next
        while n is not self.end:
            n.pos = len(out)
            out.append(n)
            n = n.next
        return out

    def _fits(self, group: list[str], stream: list[str], at: int) -> int:
        """Where ``stream`` stands after one more run of ``group`` from ``at``,
        or -1; texts may be missing on either side."""
        for key in group:
            while key and at < len(stream) and not stream[at]:
                at += 1
            if not key:
                at += at < len(stream) and not stream[at]
            elif at < len(stream) and stream[at] == key:
                at += 1
            else:
                return -1
        return at

    def _group(self, last: Node, opening: str) -> list[Node]:
        """The closed group of nodes that ends with ``last`` and begins with
        ``opening`` beside it, or none."""
        if last.key and last.key[0] != "/" and last.key.split(" ")[0] not in VOID | RAW:
            return []
        out, depth, n = [], len(last.path), last
        while len(out) < REACH and n is not self.end and len(n.path) >= depth:
            out.append(n)
            if n.key == opening and len(n.path) == depth:
                return out[::-1]
            n = n.prev
        return []

    def align(self, page: list[Token], learn: bool = True) -> list[int]:
        """Place in the wrapper of every token's node, -1 where it has none;
        with ``learn`` the wrapper grows to accept the page."""
        met = self.follow(page, learn)
        _ = self.nodes  # counts them
        return [n.pos if n else -1 for n in met]

    def follow(self, page: list[Token], learn: bool = True) -> list[Node | None]:
        """The node of every token."""
        end, stream = self.end, [t.key for t in page]
        met: list[Node | None] = [None] * len(page)
        i, j = end.next, 0
        gap, stop = None, 0  # up to ``stop`` the page has a surplus before node ``gap``
        while j < len(page):
            t = page[j]
            node = None if i is end or i is gap and j < stop else i
            if node and node.key == t.key:
                if learn and not t.key and node.text != t.text:
                    node.text = None
                met[j] = node
                i, j = node.next, j + 1
                continue
            last = i.prev
            if last.loops and (first := last.loops.get(t.key)) and not first.gone:
                met[j] = first  # once more through a repeated group
                i, j = first.next, j + 1
                continue
            if node and not node.key:  # a text that this page lacks
                i = i.next
                continue
            if not t.key:  # a text that the wrapper lacks
                if learn:
                    met[j] = self._insert(i, t)
                j += 1
                continue
            # the page repeats the group just matched
            if t.key[0] != "/" and (group := self._group(last, t.key)) \
                    and self._fits([n.key for n in group], stream, j) > 0:
                if learn:
                    last.loops = {**(last.loops or {}), t.key: group[0]}
                met[j] = group[0]
                i, j = group[0].next, j + 1
                continue
            # the wrapper repeats the group just matched: fold it
            if learn and node and node.key[0] != "/" and (group := self._group(last, node.key)):
                e = self._fits([n.key for n in group], [n.key for n in self._ahead(i)], 0)
                if e > 0:
                    for n in group:
                        n.text = "" if n.key else None
                    last.loops = {**(last.loops or {}), node.key: group[0]}
                    i = self._remove(i, e)
                    continue
            skip_page, later = -1, None
            if node:
                try:
                    skip_page = stream.index(node.key, j + 1, j + REACH)
                except ValueError:
                    pass
                later = next(((n, k) for k, n in enumerate(self._ahead(i)) if n.key == t.key), None)
            if later and (skip_page < 0 or later[1] <= skip_page - j):
                met[j] = later[0]  # optional in the wrapper
                i, j = later[0].next, j + 1
                continue
            if skip_page >= 0:  # optional, known from this page on
                gap, stop = i, skip_page
            if learn:
                met[j] = self._insert(i, t)
            j += 1
        return met

    def _ahead(self, i: Node) -> list[Node]:
        out = []
        while i is not self.end and len(out) < REACH:
            out.append(i)
            i = i.next
        return out

    def _insert(self, i: Node, t: Token) -> Node:
        n = Node(t.key, t.text if not t.key else "", t.path, i.prev, i)
        i.prev.next = i.prev = n
        return n

    def _remove(self, i: Node, n: int) -> Node:
        """The node behind the ``n`` nodes that go, from ``i`` on."""
        before = i.prev
        for _ in range(n):
            i.gone, i.pos = True, -1
            i = i.next
        before.next, i.prev = i, before
        return i


def repeated_groups(wrapper: Wrapper) -> dict[Node, int]:
    """The nodes in repeated groups, each with the number of its outermost one."""
    nodes = wrapper.nodes  # counts them
    spans = sorted((first.pos, n.pos) for n in nodes for first in (n.loops or {}).values() if not first.gone)
    out: dict[Node, int] = {}
    at, reach, number = 0, -1, -1
    for begin, last in spans:
        if begin > reach:
            number, at = number + 1, begin
        for k in range(max(at, reach + 1), last + 1):
            out[nodes[k]] = number
        reach = max(reach, last)
    return out


class Shared:
    """Texts that most of the (distinct) pages have at the same node.

    Items of a repeated list or table are not judged singly, for articles
    share values of cells too.  Such a group is a menu, and all of its texts are out,
    if nine tenths of its text are links and most pages that have it share at
    least half of their items with another page."""

    def __init__(self, streams: list[list[Token]], met: list[list[Node | None]], groups: dict[Node, int]):
        self.pages = len(streams)
        self.groups = groups
        self.seen = Counter(x for s, m in zip(streams, met, strict=True)
                            for x in {(n, t.text) for t, n in zip(s, m, strict=True) if n and not t.key})
        size, linked = Counter(), Counter()
        items: list[dict[int, set]] = []
        for s, m in zip(streams, met, strict=True):
            items.append({})
            for t, n in zip(s, m, strict=True):
                if not t.key and n in groups and is_item(t.path):
                    g = groups[n]
                    size[g] += len(t.text)
                    linked[g] += t.linked
                    items[-1].setdefault(g, set()).add((n, t.text))
        votes = Counter()
        for page in items:
            for g, found in page.items():
                votes[g] += 1 if 2 * sum(self.seen[x] > 1 for x in found) >= len(found) else -1
        self.menus = {g for g, n in size.items() if 10 * linked[g] >= 9 * n and votes[g] > 0}

    def __call__(self, node: Node | None, text: str, path: tuple) -> bool:
        if node in self.groups and is_item(path):
            return self.groups[node] in self.menus
        seen = self.seen[node, text]
        return seen > 1 and 2 * seen > self.pages


def loosened(streams: list[list[Token]]) -> list[list[Token]]:
    """The tokens by which pages align: elements that a page has one of lose
    their marks, digits count as one sign, and marks of one page only go where
    most pages have such marks on the tag."""
    def marks(key: str) -> list[tuple[str, str]]:
        name, *words = _DIGITS.sub("#", key).split(" ")
        return [(name, w) for w in words]

    heads = [{t.key for t in s if t.key and t.key[0] != "/"} for s in streams]
    on = Counter(m for keys in heads for m in {m for k in keys for m in marks(k)})
    own = Counter(name for keys in heads for name in {m[0] for k in keys for m in marks(k) if on[m] == 1})
    loose = {name for name, n in own.items() if n > 1 and 2 * n >= len(streams)}
    keys: dict[str, str] = {}
    paths: dict[tuple, tuple] = {}

    def key(k: str) -> str:
        if k not in keys:
            name = k.split(" ")[0]
            kept = [] if name in SINGLE else [m[1] for m in marks(k) if on[m] > 1 or name not in loose]
            keys[k] = " ".join([name, *kept])
        return keys[k]

    def path(p: tuple) -> tuple:
        if p not in paths:
            paths[p] = tuple(map(key, p))
        return paths[p]

    return [[Token(key(t.key), t.text, path(t.path), t.linked) for t in s] for s in streams]


def marked(page: list[Token], clean: dict[tuple, bool]) -> list[bool]:
    """Whether each text lies in an element marked as article: in the
    outermost one around any that says article, and where the page has none
    of these, around a part of a class, id or role that does."""
    found = [p for p, good in clean.items() if good and any(map(is_article, p))]
    whole = [p for p in found if any(map(says_article, p))]
    roots = {p[:next(d for d, k in enumerate(p, 1) if is_article(k))] for p in whole or found}
    inside = {p: good and any(p[:len(r)] == r for r in roots) for p, good in clean.items()}
    return [not t.key and inside[t.path] for t in page]


@lru_cache(100_000)
def is_item(path: tuple) -> bool:
    """Whether a text is an item of a list or a cell of a table."""
    return not ITEMS.isdisjoint(k.split(" ")[0] for k in path)


def region(texts: list[tuple[tuple, int]]) -> tuple:
    """Path of the deepest container that holds most of the texts (path,
    size).  A table or a part of one is the region only where no text stands beside it in
    the element around the table: a heading and a closing paragraph stay with it."""
    by_path: Counter[tuple] = Counter()
    for path, size in texts:
        by_path[path] += size
    mass: Counter[tuple] = Counter()
    for path, size in by_path.items():
        for depth in range(len(path) + 1):
            mass[path[:depth]] += size

    def whole(p: tuple) -> bool:
        around = next((d for d in range(len(p), 0, -1) if p[d - 1].split(" ")[0] not in TABLE), 0)
        return mass[p] == mass[p[:around]]

    deep = [p for p, m in mass.items()
            if 10 * m >= 7 * mass[()] and p and p[-1].split(" ")[0] in CONTAINERS and whole(p)]
    return max(deep, key=len, default=())


def is_article(key: str) -> bool:
    name, *marks = key.replace("-", " ").replace("_", " ").split(" ")
    return name in IN_TAGS or not IN_WORDS.isdisjoint(marks)


def out_tag(path: tuple) -> bool:
    """Whether any element around is boilerplate by its tag.  A header inside
    an article is the article's own."""
    inside = False
    for key in path:
        name = key.split(" ")[0]
        if name in OUT_TAGS or name == "header" and not inside:
            return True
        inside = inside or is_article(key)
    return False


def says_article(key: str) -> bool:
    """Whether the tag or a whole class, id or role marks an article."""
    return not (IN_TAGS | IN_WORDS).isdisjoint(key.split(" "))


@lru_cache(100_000)
def out_word(key: str, whole: bool) -> bool:
    """Whether a class, id or role, or unless ``whole`` a part of one, is a
    boilerplate word."""
    name, *marks = (key if whole else key.replace("-", " ").replace("_", " ")).split(" ")
    return name not in ("html", "body") and not OUT_WORDS.isdisjoint(marks)


def out_words(path: tuple, whole: bool = False) -> list[tuple]:
    """Elements around, as paths, that are boilerplate by a word; of the
    outermost one that says article, only a whole class counts."""
    out, inside = [], False
    for depth, key in enumerate(path, 1):
        if out_word(key, whole or not inside and says_article(key)):
            out.append(path[:depth])
        inside = inside or is_article(key)
    return out


def fair(page: list[Token]) -> dict[tuple, bool]:
    """Whether each path of the page's texts is free of boilerplate.  A word
    does not make boilerplate of an element that holds the page's article:
    most of the text in elements that say article or, without these, most of
    the text and the main heading (nine tenths of a text with no such heading)."""
    sizes = Counter()
    for t in page:
        if not t.key:
            sizes[t.path] += len(t.text)
    worded = {p: out_words(p) for p in sizes if not out_tag(p)}
    if not any(worded.values()):
        return {p: p in worded for p in sizes}
    # without what is boilerplate by a whole word, unless all is
    counted = [p for p in worded if not [q for q in out_words(p, True) if not says_article(q[-1])]] or list(worded)
    total = sum(sizes[p] for p in counted)
    holds, holds_article, holds_title = Counter(), Counter(), set()
    for p in counted:
        first = next((d for d, k in enumerate(p, 1) if says_article(k) or is_article(k) and not out_word(k, False)), 0)
        for q in worded[p]:
            holds[q] += sizes[p]
            if len(q) <= first:
                holds_article[q] += sizes[p]
            if "h1" in {k.split(" ")[0] for k in p[len(q):]}:
                holds_title.add(q)
    titled = any("h1" in {k.split(" ")[0] for k in p} for p in counted)
    spared = {q for q, n in holds.items() if 2 * holds_article[q] >= total
              or (2 * n >= total and q in holds_title if titled else 10 * n >= 9 * total)}
    return {p: p in worded and spared.issuperset(worded[p]) for p in sizes}


def main_text(page: list[Token], kept: list[bool]) -> str:
    """Blocks of the texts that are kept, one per line."""
    lines, block = [], []
    for t, keep in zip(page, kept, strict=True):
        if keep:
            block.append(t.text)
        elif t.key and t.key.lstrip("/").split(" ")[0] in BLOCKS:
            lines.append("".join(block))
            block = []
    lines.append("".join(block))
    clean = (" ".join(references.unescape(x).split()) for x in lines)
    return "\n".join(x for x in clean if x)


def by_place(streams: list[list[Token]], good: list[list[bool]], met: list[list[Node | None]],
             kept: list[list[bool]]) -> None:
    """Adds the texts whose nodes lie in the marked elements of most pages,
    where a page lacks the marks; a page with no marks at all only gets them
    if they are most of its text, for else it has another layout."""
    votes: Counter[Node] = Counter()
    for s, m, x in zip(streams, met, kept, strict=True):
        if any(x):
            for t, n, keep in zip(s, m, x, strict=True):
                if n and not t.key:
                    votes[n] += 1 if keep else -1
    for k, (s, fine, m, x) in enumerate(zip(streams, good, met, kept, strict=True)):
        new = [keep or g and n is not None and votes[n] > 0 for keep, g, n in zip(x, fine, m, strict=True)]
        size = lambda flags, s=s: sum(len(t.text) for t, f in zip(s, flags, strict=True) if f)
        if any(x) or 10 * size(new) >= 7 * size(fine):
            kept[k] = new


def unmarked(streams: list[list[Token]], fine: list[list[bool]], loose: list[list[Token]],
             met: list[list[Node | None]], groups: dict[Node, int]) -> list[list[bool]]:
    """Whether each text is its page's own and lies in the region of the
    variable text.  A region serves the pages that have most of their variable
    text there; the others, of another layout, are looked at anew, without what they
    share with each other or with most pages of the block."""
    kept: list[list[bool]] = [[] for _ in streams]
    rest = list(range(len(streams)))
    with_all = Shared(streams, met, groups)
    while rest:
        shared = Shared([streams[k] for k in rest], [met[k] for k in rest], groups)
        good = {k: fine[k] for k in rest}
        own = {k: [g and not shared(n, t.text, t.path) and not with_all(n, t.text, t.path)
                   for g, t, n in zip(good[k], streams[k], met[k], strict=True)] for k in rest}
        if not any(map(any, own.values())):  # no text varies: all counts
            own = good
        sizes = {k: [(t.path, len(t.text)) for t, o in zip(loose[k], own[k], strict=True) if o] for k in rest}
        where = region([x for k in rest for x in sizes[k]])
        lies = {k: sum(n for p, n in sizes[k] if p[:len(where)] == where) for k in rest}
        served = [k for k in rest if 2 * lies[k] >= sum(n for _, n in sizes[k])]
        for k in served:
            kept[k] = [o and t.path[:len(where)] == where for t, o in zip(loose[k], own[k], strict=True)]
        rest = [k for k in rest if k not in served]
    return kept


def extract_block(pages: list[str]) -> list[str]:
    """Main texts of pages of one host, by their common wrapper.  Copies, also
    such that differ only in what is no token, are one page to it."""
    read = [tokens(p) for p in pages]
    same = [tuple((t.key, t.text) for t in s) for s in read]
    streams = list(dict(zip(same, read, strict=True)).values())
    clean = [fair(s) for s in streams]
    good = [[not t.key and c[t.path] for t in s] for s, c in zip(streams, clean, strict=True)]
    kept, loose = [marked(s, c) for s, c in zip(streams, clean, strict=True)], loosened(streams)
    wrapper = Wrapper(loose[0])
    for s in loose[1:]:
        wrapper.follow(s)
    met = [wrapper.follow(s, learn=False) for s in loose]
    by_place(streams, good, met, kept)
    if bare := [k for k, x in enumerate(kept) if not any(x)]:
        found = unmarked(*([x[k] for k in bare] for x in (streams, good, loose, met)), repeated_groups(wrapper))
        for k, x in zip(bare, found, strict=True):
            kept[k] = x
    texts = dict(zip(dict.fromkeys(same), (main_text(s, x) for s, x in zip(streams, kept, strict=True)), strict=True))
    return [texts[x] for x in same]


def extract(pages: DataFrame, block: int = BLOCK) -> DataFrame:
    """page_id, url, text of every row of ``pages`` (page_id, url, html)."""
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    host = url_parts(F.col("url"))["host"]
    # the second key cuts a large host into many ranges
    keys = [host.alias("host"), F.xxhash64("url", "page_id").alias("order")]
    dealt = slim.select("*", *keys).repartitionByRange("host", "order").sortWithinPartitions("host", "order")

    def finish(rows: list[tuple]) -> pa.RecordBatch:
        texts = extract_block([r[2] for r in rows])
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
             pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            columns = [batch.column(k) for k in range(4)]
            for r in range(batch.num_rows):
                row = tuple(c[r].as_py() for c in columns)
                if rows and (row[3] != rows[0][3] or len(rows) == block):
                    yield finish(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield finish(rows)

    return dealt.select("page_id", "url", "html", "host").mapInArrow(run, "page_id long, url string, text string")


def op2(pages: DataFrame) -> DataFrame:
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
