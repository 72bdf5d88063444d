"""Main text of web pages by wrappers inferred from the pages of each host.

A page becomes a stream of block tags and texts, read into a tree in which runs
of equal siblings (or of equal groups of siblings) fold into repeated groups.
Wrappers, union-free regular expressions over tags and text slots, come from
aligning such trees one after another: what both sides have is aligned in order,
what only one side has becomes optional, a text that differs becomes a slot.
Alignment is associative enough to merge wrappers too, so each task infers one
wrapper for each host from its own pages and the wrappers of a host, each no
larger than the host's template, are merged in two steps (by a salt, then by
host).  A host with a third of all pages gives every task one more small row.

The wrapper tells, for each place in the template, on how many pages it occurs,
how much text it holds, and whether that text is always the same; what is the
same on all of two or more distinct pages is template.  The main part is the
deepest container, but none inside an article, that still holds all of the
host's changing text outside menus, page headers and footers, sidebars,
notices, adverts, forms, reader comments and lists of links.  A page's main text
is the text of all blocks in that part; a page without it goes by its own blocks
in the same way.

Some elements are aside only by their place: a ``header``, and elements named as
one or as a search, login or widget, belong to the text inside an ``article`` or
``main``; outside, they are aside if the page has such an element, and otherwise
unless they hold a headline.  An element that only its name makes an aside
(``with-sidebar``) is none if it holds ``main`` or the ``h1``.

Defined results: null and empty pages have the empty text; pages without a host
form one group; rows that repeat an id stay separate; text outside any tag is a
block; what an unclosed element would hide (``head``, ``select``, a comment)
stays; containers more than ``DEEP`` levels down count as their outer one; an
empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
import html as html_
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, staged, table

SALTS, HELD_NODES = 16, 200_000
#: Texts of so many characters or more are held in wrappers as hashes.
LONG = 400
#: What is the same on one page alone says nothing: a text is template from so many distinct pages on.
LEAST_PAGES = 2
#: Levels of containers that a path tells apart.
DEEP = 128
#: Rules up to this many bytes go to all tasks at once; more are joined, with the pages of a host dealt out by a salt.
RULE_BYTES = 32 << 20
#: A container with this share of its text inside links is a list of links.
LINKS = 0.7

#: Tag classes.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul xmp".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption caption summary".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page, if they are closed.
DROPPED = frozenset("noscript template svg math iframe object audio video canvas select button datalist".split())
#: Elements that are not main text wherever they stand.
ASIDE_TAGS = frozenset("nav footer aside form menu dialog search option".split())
#: Words of class, id and role of what is not main text wherever it stands, and of what is not outside the main part.
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising alert breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies disqus footer gdpr menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion related replies reply share sharing sidebar skip social sponsor sponsored subscribe subscription".split()
)
OUTER_WORDS = frozenset("banner header login masthead search signup toolbar widget widgets".split())
#: First words of names that only tell of such elements elsewhere.
TELLING = frozenset("no has with without hide show".split())

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?--!?>)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(?P<raw>script|style|textarea|title)\b(?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')|=)*+>(?:.*?</(?P=raw)\b[^>]*>)?"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')|=)*+)>"
    r"|</?[a-zA-Z][^<>]*\Z",
    re.S | re.I,
)
_ATTR = re.compile(r"""([^\s>/=][^\s>/=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_WORDS = re.compile(r"[a-z]+")
_CONTENT, _OUTER, _ASIDE = 0, 1, 2


class Element:
    """An open or closed container: what its tag and names say, and what it turned out to hold."""

    __slots__ = ("tag", "sig", "kind", "named", "outer", "inner", "holds_main", "holds_heading", "holds_article", "depth")

    def __init__(self, tag: str, attrs: str, parent: "Element | None"):
        self.tag, self.sig, self.kind, self.named = tag, tag, _ASIDE if tag in ASIDE_TAGS else _OUTER if tag == "header" else _CONTENT, False
        self.outer = parent
        main = tag in ("article", "main")
        self.holds_main = self.holds_heading = self.holds_article = False
        self.depth = parent.depth + 1 if parent else 1
        if attrs and ("=" in attrs or "hidden" in attrs):
            found: dict[str, str] = {}
            for name, a, b, c in _ATTR.findall(attrs):
                found.setdefault(name.lower(), a or b or c)
            names = sorted({_DIGITS.sub("0", n) for n in found.get("class", "").split()})
            self.sig = tag + "".join("." + n for n in names) + ("#" + _DIGITS.sub("0", found["id"]) if found.get("id") else "")
            role = found.get("role", "").lower()
            main = main or role in ("main", "article") or found.get("itemprop") == "articleBody"
            if "hidden" in found or found.get("aria-hidden") == "true" or _HIDDEN.search(found.get("style", "")):
                self.kind = _ASIDE
            elif self.kind != _ASIDE and not main and tag not in ("html", "body"):
                words: set[str] = set()
                for n in (*found.get("class", "").split(), found.get("id", ""), role):
                    split = _WORDS.findall(_CAMEL.sub(r"\1 \2", n).lower())
                    if split and split[0] not in TELLING:
                        words.update(split)
                if words & ASIDE_WORDS:
                    self.kind, self.named = _ASIDE, True
                elif words & OUTER_WORDS:
                    self.kind = _OUTER
        self.inner = main or bool(parent and parent.inner)
        if main or tag in HEADINGS:
            e = parent
            while e:
                e.holds_main |= tag in ("main", "h1") or main and tag != "article"
                e.holds_article |= main
                e.holds_heading |= tag in HEADINGS
                e = e.outer

    def aside(self, page_has_main: bool) -> int:
        """Whether its text, and that of all it holds, is aside: _CONTENT, _OUTER (by its place) or _ASIDE."""
        if self.kind == _ASIDE:
            return _CONTENT if self.named and self.holds_main or self.tag == "form" and (self.holds_main or self.holds_article) else _ASIDE
        if self.kind == _OUTER and not self.inner and not self.holds_article:
            bare = self.tag == "header" and (self.outer is None or self.outer.tag in ("body", "html"))
            return _OUTER if page_has_main or bare or not self.holds_heading else _CONTENT
        return _CONTENT


_DIGITS, _CAMEL = re.compile(r"\d+"), re.compile(r"([a-z])([A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody")}
_STOPS = frozenset("ul ol menu dl table select".split())


def _closed(tokens: list[re.Match]) -> dict[int, int]:
    """Of dropped elements and links that are closed: the number of the opening tag -> that of the closing one."""
    out: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for i, m in enumerate(tokens):
        tag = m.group("tag")
        if tag is None or (tag := tag.lower()) not in DROPPED and tag != "a":
            continue
        if m.group("close"):
            if opened.get(tag):
                out[opened[tag].pop()] = i
        elif not m.group("attrs").endswith("/"):
            if tag == "a":
                opened[tag] = []
            opened.setdefault(tag, []).append(i)
    return out


def blocks(page: str) -> list[tuple[tuple[str, ...], int, str, int]]:
    """(path of signatures, whether it is aside, text, characters inside links) of each block of text, in page order."""
    found: list[tuple[Element | None, str, int]] = []
    stack: list[Element] = []
    held: list[str] = []
    linked = 0
    page_has_main = False

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join(html_.unescape("".join(held)).split())
            if text:
                found.append((stack[-1] if stack else None, text, linked))
            held.clear()
        linked = 0

    tokens = list(_TOKEN.finditer(page))
    closed = _closed(tokens)
    at, i, link_to = 0, 0, -1
    while i < len(tokens):
        m = tokens[i]
        if m.start() > at:
            held.append(page[at : m.start()])
            if i <= link_to:
                linked += m.start() - at
        at = m.end()
        i += 1
        tag = m.group("tag")
        if tag is None:
            continue
        tag = tag.lower()
        if tag in DROPPED:
            if i - 1 in closed:
                at, i = tokens[closed[i - 1]].end(), closed[i - 1] + 1
            continue
        if tag == "a" and not m.group("close"):
            link_to = closed.get(i - 1, -1)
        if tag == "br":
            held.append(" ")
        if tag not in BLOCKS:
            continue
        flush()
        if m.group("close"):
            if tag in ("html", "body"):
                continue
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        top = stack[-1].tag if stack else ""
        if top == "p" or top in HEADINGS and tag in ("p", top) or top == "option" and tag != "option":
            stack.pop()
        if tag in _ENDS:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag in _STOPS or tag in ("td", "th") and stack[k].tag == "tr":
                    break
                if stack[k].tag in _ENDS[tag]:
                    del stack[k:]
                    break
        if tag in VOID or tag in ("html", "body") and any(e.tag == tag for e in stack):
            continue
        stack.append(Element(tag, m.group("attrs"), stack[-1] if stack else None))
        page_has_main |= stack[-1].inner
    if at < len(page):
        held.append(page[at:])
    flush()
    made: dict[int, tuple[tuple[str, ...], int]] = {}

    def place(e: Element | None) -> tuple[tuple[str, ...], int]:
        chain = []
        while e is not None and id(e) not in made:
            chain.append(e)
            e = e.outer
        path, aside = made[id(e)] if e is not None else ((), _CONTENT)
        for e in reversed(chain):
            path, aside = (*path, e.sig) if len(path) < DEEP else path, max(aside, e.aside(page_has_main))
            made[id(e)] = path, aside
        return path, aside

    return [(*place(e), text, chars) for e, text, chars in found]


class Node:
    """A place of a wrapper: a tag with its inner places in order, or a group of such places."""

    __slots__ = ("sig", "plus", "pages", "aside", "chars", "linked", "text", "inner", "kinds")

    def __init__(self, sig: str, aside: bool = False, pages: int = 1):
        self.sig, self.aside, self.pages = sig, aside, pages
        self.plus, self.chars, self.linked, self.text = False, 0, 0, None
        self.inner: list[Node] = []
        self.kinds: list[str] = []  # of a root: up to LEAST_PAGES hashes of distinct pages

    def dump(self) -> list:
        return [self.sig, int(self.plus), self.pages, int(self.aside), self.chars, self.linked, self.text, [n.dump() for n in self.inner], self.kinds]

    @classmethod
    def load(cls, x: list) -> "Node":
        n = cls(x[0], bool(x[3]), x[2])
        n.plus, n.chars, n.linked, n.text, n.inner = bool(x[1]), x[4], x[5], x[6], [cls.load(y) for y in x[7]]
        n.kinds = x[8]
        return n

    def size(self) -> int:
        return 1 + sum(n.size() for n in self.inner)

    def expression(self, total: int | None = None) -> str:
        """The wrapper as a regular expression: (...)+ repeated, (...)? optional, #TEXT a slot."""
        total = total or self.pages
        own = [] if self.text is None else ["#TEXT" if self.text == "" else repr(self.text)]
        body = " ".join(own + [n.expression(self.pages) for n in self.inner])
        out = body if self.sig == "()" else f"<{self.sig}>" + (f" {body}" if body else "") + " </>"
        if self.plus or self.sig == "()":
            out = f"( {out} )+" if self.plus else f"( {out} )"
        return out if self.pages >= total else f"( {out} )?"


def _join_text(a: str | None, b: str | None) -> str | None:
    """None: no text; "": a slot; else the text that was always there."""
    if a is None or b is None:
        return b if a is None else a
    return a if a == b else ""


def merge(a: Node, b: Node, same_page: bool = False) -> Node:
    """``a`` aligned with ``b``; both have one signature."""
    a.pages = max(a.pages, b.pages) if same_page else a.pages + b.pages
    a.plus |= b.plus or same_page
    a.aside |= b.aside
    a.chars, a.linked, a.text = a.chars + b.chars, a.linked + b.linked, _join_text(a.text, b.text)
    a.inner = align(a.inner, b.inner, same_page)
    if b.kinds:
        a.kinds = sorted({*a.kinds, *b.kinds})[:LEAST_PAGES]
    return a


def align(a: list[Node], b: list[Node], same_page: bool = False) -> list[Node]:
    """Two rows of places in one order: equal signatures meet, the rest keeps its place between them."""
    out: list[Node] = []
    i = 0
    for node in b:
        at = next((j for j in range(i, len(a)) if a[j].sig == node.sig and a[j].sig != "()" or a[j].sig == "()" == node.sig and _signs(a[j].inner) == _signs(node.inner)), None)
        if at is None:
            before = next((j for j, n in enumerate(out) if n.sig == node.sig != "()"), None)
            if before is not None:  # the same place came earlier: repeated rather than listed again
                out[before] = merge(out[before], node, same_page=True)
            else:
                out.append(node)
            continue
        out += a[i:at]
        out.append(merge(a[at], node, same_page))
        i = at + 1
    return out + a[i:]


def _signs(nodes: list[Node]) -> list[str]:
    return [n.sig for n in nodes]


def fold(nodes: list[Node]) -> list[Node]:
    """Siblings with runs of equal places, and of equal groups of any length, folded into repeated ones."""
    out: list[Node] = []
    at: dict[str | tuple, list[int]] = {}  # where each kind of place stands in ``out``
    groups: list[int] = []

    def kind(n: Node) -> str | tuple:
        return n.sig if n.sig != "()" else ("()", *_signs(n.inner))

    def add(n: Node) -> None:
        at.setdefault(kind(n), []).append(len(out))
        if n.sig == "()":
            groups.append(len(out))
        out.append(n)

    def take(k: int) -> list[Node]:
        last = out[-k:]
        for n in reversed(last):
            at[kind(n)].pop()
        del out[-k:]
        while groups and groups[-1] >= len(out):
            groups.pop()
        return last

    def same(a: list[Node], b: list[Node]) -> list[Node]:
        return [merge(x, y, same_page=True) for x, y in zip(a, b)]

    for node in nodes:
        add(node)
        while True:
            end = len(out)
            if groups and _signs(out[groups[-1]].inner) == _signs(out[groups[-1] + 1 :]):  # one more of the group before
                last = take(end - 1 - groups[-1])
                out[-1].inner = same(out[-1].inner, last)
                continue
            before = at[kind(out[-1])]
            k = end - 1 - before[-2] if len(before) > 1 else 0
            if not k or 2 * k > end or any(kind(x) != kind(y) for x, y in zip(reversed(out[-2 * k : -k]), reversed(out[-k:]))):
                break
            last = take(k)
            merged = same(take(k), last)
            if k == 1:
                add(merged[0])
                break
            for n in merged:
                n.plus = False
            group = Node("()")
            group.inner, group.plus = merged, True
            add(group)
    return out


def _kept(text: str) -> str:
    """A text as a wrapper holds it: long ones as a hash, so that every length can be told to be the same."""
    return text if len(text) < LONG else "#" + _hash(text)


def _hash(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def page_wrapper(found: list[tuple[tuple[str, ...], int, str, int]]) -> Node:
    """The wrapper of one page."""
    root = Node("")
    path: list[Node] = [root]
    last: tuple[str, ...] = ()
    for sigs, aside, text, linked in found:
        keep = 0
        while keep < min(len(last), len(sigs)) and last[keep] == sigs[keep]:
            keep += 1
        if keep == len(sigs) and keep and sigs[-1].split(".")[0].split("#")[0] in LEAVES:
            keep -= 1  # the next block of the same kind, not the same block
        del path[keep + 1 :]
        for s in sigs[keep:]:
            node = Node(s)
            path[-1].inner.append(node)
            path.append(node)
        here = path[-1]
        here.aside |= bool(aside)
        here.chars += len(text)
        here.linked += min(linked, len(text))
        here.text = _join_text(here.text, _kept(text))
        last = sigs

    def folded(n: Node) -> Node:
        n.inner = fold([folded(x) for x in n.inner])
        return n

    out = folded(root)
    out.kinds = [_hash("\n".join(x[2] for x in found))]
    return out


def places(root: Node) -> dict[tuple[str, ...], dict]:
    """path -> pages, chars, linked, aside, text of all its nodes taken together."""
    out: dict[tuple[str, ...], dict] = {}

    def walk(n: Node, path: tuple[str, ...]) -> None:
        if n.sig != "()":
            path = (*path, n.sig) if n.sig else path
            x = out.get(path)
            if x is None:
                out[path] = {"pages": n.pages, "chars": n.chars, "linked": n.linked, "aside": n.aside, "text": n.text, "plus": n.plus}
            else:
                x["pages"], x["chars"], x["linked"], x["aside"] = max(x["pages"], n.pages), x["chars"] + n.chars, x["linked"] + n.linked, x["aside"] or n.aside
                x["text"], x["plus"] = _join_text(x["text"], n.text), True
        for inner in n.inner:
            walk(inner, path)

    walk(root, ())
    return out


def rules(root: Node) -> dict:
    """The main part's path, the paths whose text belongs to the template, and the containers that are lists of links."""
    return rules_of(places(root), root.pages, len(root.kinds))


def rules_of(at: dict[tuple[str, ...], dict], total: int, distinct: int) -> dict:
    """``rules`` from the places of a host's pages, how many pages there are, and how many distinct ones (up to LEAST_PAGES)."""

    def of_template(p: tuple[str, ...], x: dict) -> bool:
        heading = _tag(p[-1] if p else "") == "h1" and not any("header" in s for s in p)
        return bool(x["text"]) and distinct >= LEAST_PAGES and x["pages"] >= total and not x["plus"] and not heading

    fixed = {p for p, x in at.items() if of_template(p, x)}
    chars: dict[tuple[str, ...], int] = {}
    linked: dict[tuple[str, ...], int] = {}
    for p, x in at.items():
        if x["aside"] or p in fixed or not x["chars"]:
            continue
        for i in range(len(p) + 1):
            chars[p[:i]] = chars.get(p[:i], 0) + x["chars"]
            linked[p[:i]] = linked.get(p[:i], 0) + x["linked"]
    inside: dict[tuple[str, ...], list] = {}
    for p in chars:
        if p and (_tag(p[-1]) in LEAVES or linked[p] < LINKS * chars[p]):
            inside.setdefault(p[:-1], []).append(p)
    main: tuple[str, ...] = ()
    while not (main and _tag(main[-1]) == "article"):
        x = at.get(main)
        inner = inside.get(main, [])
        if len(inner) != 1 or _tag(inner[0][-1]) in LEAVES or x and x["chars"] and not x["aside"] and main not in fixed:
            break
        main = inner[0]
    flowing = {q for p, x in at.items() if x["chars"] and not x["aside"] and p not in fixed for q in (p, p[:-1] if p and _tag(p[-1]) in LEAVES else p)}
    lists = {p for p in chars if p and len(p) > len(main) and p[: len(main)] == main and linked[p] >= LINKS * chars[p] and _tag(p[-1]) not in LEAVES and not any(_tag(s) == "article" for s in p) and p[:-1] not in flowing}
    fixed = {p for p in fixed if p[: len(main)] != main or not (any(_tag(s) == "article" for s in p) or p in flowing or p[:-1] in flowing)}
    return {"main": list(main), "fixed": [list(p) for p in sorted(fixed)], "lists": [list(p) for p in sorted(lists)]}


def _tag(sig: str) -> str:
    return re.split(r"[.#]", sig, maxsplit=1)[0]


def main_text(found: list[tuple[tuple[str, ...], int, str, int]], rule: dict | None) -> str:
    """The page's main blocks, one a line."""

    def pick(main: tuple[str, ...], fixed: set, lists: set, most: int = _CONTENT) -> list[str]:
        n = len(main)
        return [t for p, aside, t, _ in found if aside <= most and p[:n] == main and p not in fixed and not (lists and any(p[:k] in lists for k in range(n + 1, len(p) + 1)))]

    got = pick(tuple(rule["main"]), {tuple(p) for p in rule["fixed"]}, {tuple(p) for p in rule["lists"]}) if rule else []
    if not got and found:
        own = rules(page_wrapper(found))
        got = pick(tuple(own["main"]), set(), {tuple(p) for p in own["lists"]}) or pick((), set(), set(), _OUTER)
    return "\n".join(got)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url.cast("string"), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def infer(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """host, pages and wrapper (JSON) of every host."""
    schema = "host string, salt int, pages bigint, wrapper string"

    def emit(held: dict[str, Node], salt: int) -> pd.DataFrame:
        return pd.DataFrame([(h, salt, n.pages, json.dumps(n.dump())) for h, n in held.items()], columns=["host", "salt", "pages", "wrapper"])

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        salt = TaskContext.get().partitionId() % SALTS
        held: dict[str, Node] = {}
        seen = 0
        for f in frames:
            for host, page in zip(f["host"], f["html"]):
                if not (found := blocks(page)):
                    continue
                own = page_wrapper(found)
                seen += 1
                held[host] = merge(held[host], own) if host in held else own
                if seen % 512 == 0 and sum(n.size() for n in held.values()) > HELD_NODES:
                    yield emit(held, salt)
                    held = {}
        if held:
            yield emit(held, salt)

    def joined(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["pages", "wrapper"], ascending=[False, True])
        root = None
        for w in f["wrapper"]:
            node = Node.load(json.loads(w))
            root = node if root is None else merge(root, node)
        return pd.DataFrame([(f["host"].iloc[0], int(f["salt"].iloc[0]), root.pages, json.dumps(root.dump()))], columns=["host", "salt", "pages", "wrapper"])

    small_batches(pages.sparkSession)
    rows = pages.select(host_of(F.col(f"`{url}`")).alias("host"), F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("html"))
    parts = rows.mapInPandas(learn, schema)
    parts = parts.groupBy("host", "salt").applyInPandas(joined, schema)
    return parts.groupBy("host").applyInPandas(joined, schema).select("host", "pages", "wrapper")


def extract(pages: DataFrame, wrappers: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page.

    The rules of all hosts go to every task while they are few (``RULE_BYTES``).  Beyond that pages and rules meet
    by host and salt, so that a host with a third of all pages is spread over SALTS tasks at least.
    """

    def ruled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"host": f["host"], "rule": [json.dumps(rules(Node.load(json.loads(w)))) for w in f["wrapper"]]})

    rule_table = staged(wrappers.mapInPandas(ruled, "host string, rule string"), "wrappers")
    few = (rule_table.agg(F.sum(F.octet_length("host") + F.octet_length("rule"))).first()[0] or 0) <= RULE_BYTES
    shared = pages.sparkSession.sparkContext.broadcast({r["host"]: r["rule"] for r in rule_table.collect()} if few else None)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, dict] = {}
        for f in frames:
            texts = []
            for page, rule in zip(f["html"], f["host"].map(shared.value) if few else f["rule"]):
                if not isinstance(rule, str):
                    rule = None
                elif rule not in known:
                    known = known if len(known) < 10_000 else {}
                    known[rule] = json.loads(rule)
                texts.append(main_text(blocks(page), known.get(rule)))
            yield pd.DataFrame({"page_id": f["page_id"], "url": f["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    rows = pages.select(F.col(f"`{key}`").cast("bigint").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), host_of(F.col(f"`{url}`")).alias("host"), F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("html"))
    if not few:
        salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "html"), F.lit(SALTS)).cast("int"))
        rows = rows.join(rule_table.withColumn("salt", F.explode(salts)), ["host", "salt"], "left").select("page_id", "url", "host", "html", "rule")
    return rows.mapInPandas(run, "page_id bigint, url string, text string, n_chars bigint")


def op4_page_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: wrappers from all pages, the main text of all pages."""
    pages = table(spark, sf_dir, "pages")
    return extract(pages, infer(pages))
