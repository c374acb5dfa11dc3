"""Main text of web pages, by removal of what a site repeats.

1. Every page is parsed to a tree, and every block element that holds text is hashed with
   all below it: tag, text and children, not attributes.
2. Spark counts, per host, the pages in which a subtree occurs.  Pages with the same longest
   block count as one, so that copies of an article do not turn it into a template.  A
   subtree recurs when ``min_pages`` pages hold it and ``min_share`` of the host's pages.
3. Recurring subtrees are deleted.  Hosts with few pages cannot show what recurs, so elements
   whose kind, role, class or id says that they are menus, headers, footers, sidebars,
   notices, adverts, forms or reader comments go as well.
4. Where the rest has article elements (else a main element), their text is the main text,
   otherwise the text of the whole body.  Inside them a subtree is deleted for recurring only
   if more than half of its text is links: prose that articles share is theirs.

Recurring subtrees are broadcast while there are at most ``broadcast_rows`` of them (8 bytes
each, counted first); beyond that each page is joined with its own.

A block is the text between the begins and ends of block elements; a table row is a block,
its cells are set apart by a space, and so are line breaks.  White space is what Python's
``str.split`` takes for it.  References are decoded as in HTML, those cut off at the end stay.
A tag cut off at the end of the page goes.  NULL and empty html have an empty text; pages
without a host (NULL or odd url) are one host without templates.  Repeated rows count once
as pages and give a row each.  Further columns are not read unless named in ``keep``.
"""

from __future__ import annotations

import functools
import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.components import stored


@dataclass(frozen=True)
class Params:
    min_pages: int = 4
    min_share: float = 0.005
    #: recurring subtrees that are sent to all executors at most
    broadcast_rows: int = 500_000


# Element names of HTML by what they mean here.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li listing main menu nav ol optgroup "
    "option p plaintext pre search section summary table tbody tfoot thead tr ul xmp".split()
)
_VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
_RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
_CELLS = frozenset("td th".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# an open p ends before these, and an end tag does not reach past those
_ENDS_P = _BLOCKS - frozenset("body caption head html legend optgroup option tbody tfoot thead tr".split())
_BARRIERS = frozenset("caption html object table td template th".split())
_AROUND_CELLS = frozenset("html table template".split())
_IN_TABLES = frozenset("caption table tbody td tfoot th thead tr".split())
_REPLACES = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "option": frozenset(["option"]), "optgroup": frozenset(["option", "optgroup"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
    "tbody": frozenset(["tbody", "thead", "tfoot", "tr", "td", "th"]),
    "tfoot": frozenset(["tbody", "thead", "tfoot", "tr", "td", "th"]),
    "thead": frozenset(["tbody", "thead", "tfoot", "tr", "td", "th"]),
}
_STOPS = {
    "li": frozenset(["ul", "ol", "menu", "dir"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]),
    "option": frozenset(["select"]), "optgroup": frozenset(["select"]),
}

_MAIN = ("article", "main")

# Never main text, by element, by role, and by a word of class or id.
_SIDE = frozenset(
    "applet aside audio button canvas dialog embed fieldset footer form frameset head iframe map menu nav noembed "
    "noframes noscript object script search select style svg template textarea title video".split()
)
_SIDE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
_SIDE_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts breadcrumb breadcrumbs comment commentlist comments consent cookie "
    "cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices popup promo promoted "
    "respond share sharing sidebar sidebars signup social sponsor sponsored subscribe".split()
)
_HEADERS = frozenset("header site-header page-header top-header global-header main-header".split())
_COMMENTS = frozenset("comment comment-body reply".split())
_ABOUT = re.compile(r"(?:has|with|no|without|is|not|hide|show)[-_]")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)"
    r"(?P<rest>(?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)?+)*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|<[a-zA-Z][^>]*+(?:>|\Z)",
    re.DOTALL,
)
_MARKING = re.compile("class|id|role", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"(?<![^\s/\"'])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE)


class Element:
    __slots__ = ("children", "digest", "holds_main", "inside", "links", "named", "size", "tag")

    def __init__(self, tag: str, named: bool, inside: bool):
        self.tag, self.named, self.inside = tag, named, inside
        self.children: list[Element | str] = []
        self.digest, self.size, self.links, self.holds_main = b"", 0, 0, tag in _MAIN

    @property
    def counted(self) -> bool:
        """Whether recurring can delete it."""
        if self.tag not in _BLOCKS or not self.size or self.holds_main or self.tag == "html":
            return False
        return not self.inside or 2 * self.links > self.size

    def close(self) -> None:
        """Hash and sizes, when all children are there."""
        digest = hashlib.blake2b(self.tag.encode(), digest_size=8)
        for child in self.children:
            if isinstance(child, str):
                words = " ".join(child.split())
                if words:
                    digest.update(b"\0" + words.encode("utf-8", "surrogatepass"))
                    self.size += len(words)
            elif child.size:
                digest.update(b"\1" + child.digest)
                self.size += child.size
                self.links += child.links
                self.holds_main |= child.holds_main
        if self.tag == "a":
            self.links = self.size
        self.digest = digest.digest()


@functools.lru_cache(maxsize=4096)
def _named(tag: str, rest: str) -> bool:
    """Whether an element says of itself that it is no main text."""
    if tag in _SIDE:
        return True
    values = {"class": "", "id": "", "role": ""}
    for name, *found in _ATTRIBUTE.findall(rest):
        values[name.lower()] = values[name.lower()] or html.unescape("".join(found))
    if tag in ("html", "body", "main") or tag in _HEADINGS:
        return False
    if values["role"].strip().lower() in _SIDE_ROLES:
        return True
    marks = [*values["class"].split(), *values["id"].split()]
    if tag == "article":
        return any(m.lower() in _COMMENTS for m in marks)
    if any(m.lower() in _HEADERS for m in marks):
        return True
    words = (w.lower() for m in marks if not _ABOUT.match(m) for w in _WORDS.findall(m))
    return any(w in _SIDE_WORDS for w in words)


def parse(page: str) -> Element:
    """The tree of a page; end tags that are left out are added where HTML implies them."""
    root = Element("html", False, False)
    stack = [root]
    opened: Counter[str] = Counter()

    def close(down_to: int) -> None:
        while len(stack) > down_to:
            element = stack.pop()
            opened[element.tag] -= 1
            element.close()

    def find(tags, stops: frozenset[str]) -> int | None:
        if not any(opened[t] for t in tags):
            return None
        for at in range(len(stack) - 1, 0, -1):
            if stack[at].tag in tags:
                return at
            if stack[at].tag in stops:
                return None
        return None

    at, size = 0, len(page)
    while at < size:
        token = _TOKEN.search(page, at)
        text = page[at : token.start() if token else size]
        if text:
            stack[-1].children.append(html.unescape(text) if "&" in text else text)
        if token is None:
            break
        at = token.end()
        name = token["name"]
        if name is None:
            continue
        name = name.lower()
        if token["end"]:
            found = find((name,), _AROUND_CELLS if name in _IN_TABLES else _BARRIERS)
            whole = name in _BLOCKS or name in _SIDE or name in _CELLS
            if found is not None and (whole or not any(e.tag in _BLOCKS for e in stack[found + 1 :])):
                close(found)
            continue
        if name in ("html", "body"):
            continue
        if name in _ENDS_P:
            open_p = find(("p",), _BARRIERS)
            if open_p is not None:
                close(open_p)
        if name in _REPLACES:
            stops = _STOPS.get(name, frozenset(["table"])) | (_BARRIERS if name in _STOPS else frozenset())
            while (found := find(_REPLACES[name], stops)) is not None:
                close(found)
        above = stack[-1]
        rest = token["rest"]
        named = _named(name, rest if _MARKING.search(rest) else "")
        element = Element(name, named, above.inside or above.tag in _MAIN)
        above.children.append(element)
        if name in _VOID:
            element.close()
        if name in _RAW:
            over = re.compile(rf"</{name}(?=[\s/>])|\Z", re.IGNORECASE).search(page, at)
            if name == "xmp":
                element.children.append(page[at : over.start()])
            at = over.start()
        if name not in _VOID:
            stack.append(element)
            opened[name] += 1
    close(1)
    root.close()
    return root


def _elements(root: Element) -> Iterator[Element]:
    stack = [root]
    while stack:
        element = stack.pop()
        yield element
        stack += [c for c in reversed(element.children) if isinstance(c, Element)]


def blocks(roots: list[Element], deleted) -> list[str]:
    """Blocks of text below some elements, without subtrees for which ``deleted`` holds."""
    out: list[str] = []
    held: list[str] = []

    def over() -> None:
        words = " ".join("".join(held).split())
        held.clear()
        if words:
            out.append(words)

    for root in roots:
        # True marks the end of a block element
        stack: list[Element | str | bool] = [root]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                held.append(item)
                continue
            if item is True:
                over()
                continue
            is_block = item.tag in _BLOCKS
            if is_block:
                over()
            elif item.tag == "br" or item.tag in _CELLS:
                held.append(" ")
            if item is not root and deleted(item):
                continue
            if is_block:
                stack.append(True)
            stack += reversed(item.children)
        over()
    return out


def _key(host: str, digest: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(host.encode() + b"\0" + digest, digest_size=8).digest(), "big", signed=True)


def subtrees(page: str, host: str) -> tuple[list[int], int]:
    """Keys of the subtrees that may be a template of the host, and of the longest main block."""
    root = parse(page)
    keys = {_key(host, e.digest) for e in _elements(root) if e.counted}
    found = blocks([e for e in _elements(root) if e.tag in _MAIN and not e.inside] or [root], lambda e: e.tag in _RAW)
    longest = max(found, key=lambda b: (len(b), b), default="")
    return sorted(keys), _key(host, longest.encode("utf-8", "surrogatepass"))


def extract(page: str, host: str, recurring) -> tuple[str, int, int]:
    """Main text; topmost subtrees deleted because they recur, and by their kind alone."""
    root = parse(page)
    n_repeated = n_named = 0

    def deleted(element: Element) -> bool:
        nonlocal n_repeated, n_named
        if element.counted and _key(host, element.digest) in recurring:
            n_repeated += 1
            return True
        if element.named or element.tag == "header" and not element.inside:
            n_named += 1
            return True
        return False

    articles, mains, stack = [], [], [root]
    while stack:
        element = stack.pop()
        if element is not root and deleted(element):
            continue
        if element.tag == "article":
            articles.append(element)
            continue
        if element.tag == "main" and not element.inside:
            mains.append(element)
        stack += [c for c in reversed(element.children) if isinstance(c, Element)]
    if not articles:
        n_repeated = n_named = 0
    return "\n\n".join(blocks(articles or mains or [root], deleted)), n_repeated, n_named


def host_of(url: Column) -> Column:
    """Host of a url in lower case, without user and port; empty if there is none."""
    found = F.regexp_extract(url.cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(F.lower(found), F.lit(""))


def candidates(pages: DataFrame) -> DataFrame:
    """``content, host, page, keys``: keys of block subtrees, and one of the longest main block.

    ``pages`` are ``html, host, content``; pages without a host are left out.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("html").to_pylist(), batch.column("host").to_pylist(), strict=True)
            found = [subtrees(page or "", host) for page, host in pairs]
            longest, keys = pa.array([f[1] for f in found], pa.int64()), pa.array([f[0] for f in found], pa.list_(pa.int64()))
            columns = [batch.column("content"), batch.column("host"), longest, keys]
            yield pa.RecordBatch.from_arrays(columns, ["content", "host", "page", "keys"])

    rows = pages.where("host <> ''").mapInArrow(task, "content binary, host string, page long, keys array<long>")
    return rows.select("content", F.xxhash64("host").alias("host"), "page", "keys")


def recurring(found: DataFrame, params: Params = Params()) -> DataFrame:
    """``key`` of each subtree that many pages of its host hold."""
    pages = found.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    held = found.select("host", "page", F.explode("keys").alias("key")).distinct()
    counts = held.groupBy("host", "key").agg(F.count("*").alias("n")).where(F.col("n") >= params.min_pages)
    enough = F.col("n") >= F.lit(params.min_share) * F.col("pages")
    return counts.join(pages, "host").where(enough).select("key")


_OUT = "text string, n_chars long, n_repeated long, n_named long"


def _texts(pages: DataFrame, kept: dict[str, str], known) -> DataFrame:
    """The kept columns and what is extracted; ``known`` gives the recurring keys of a batch's rows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("html").to_pylist(), batch.column("host").to_pylist(), known(batch), strict=True)
            texts, repeated, named = zip(*(extract(page or "", host, keys) for page, host, keys in rows), strict=True)
            numbers = [pa.array(v, pa.int64()) for v in (list(map(len, texts)), repeated, named)]
            columns = [*(batch.column(c) for c in kept), pa.array(texts, pa.string()), *numbers]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "text", "n_chars", "n_repeated", "n_named"])

    return pages.mapInArrow(task, ", ".join([*(f"`{c}` {t}" for c, t in kept.items()), _OUT]))


def main_texts(pages: DataFrame, params: Params = Params(), *, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Columns ``keep`` of each page with ``text, n_chars, n_repeated, n_named``.

    The numbers are the code points of the text, and the topmost subtrees deleted because they
    recur and because of their kind alone.
    """
    kept = {f"kept_{i}": pages.schema[c].dataType.simpleString() for i, c in enumerate(keep)}
    page, host = F.coalesce(F.col("html").cast("string"), F.lit("")), host_of(F.col("url"))
    content = F.unhex(F.md5(F.concat(host, F.lit(" "), page).cast("binary")))
    source = pages.select(
        *(F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)),
        page.alias("html"), host.alias("host"), content.alias("content"),
    )
    found = stored(candidates(source.select("content", "host", "html")), "subtrees")
    templates = stored(recurring(found, params), "templates")
    if templates.limit(params.broadcast_rows + 1).count() <= params.broadcast_rows:
        keys = np.array([r.key for r in templates.collect()], np.int64).tobytes()
        sent = pages.sparkSession.sparkContext.broadcast(keys)
        texts = _texts(source.drop("content"), kept, lambda batch: [_keys(sent)] * batch.num_rows)
    else:
        own = found.select("content", F.explode("keys").alias("key")).distinct().join(templates, "key")
        lists = own.groupBy("content").agg(F.collect_set("key").alias("keys"))
        joined = source.join(lists, "content", "left")
        texts = _texts(joined, kept, lambda batch: [k or () for k in batch.column("keys").to_pylist()])
    return texts.toDF(*keep, "text", "n_chars", "n_repeated", "n_named")


@functools.lru_cache(maxsize=1)
def _keys(sent) -> frozenset[int]:
    return frozenset(np.frombuffer(sent.value, np.int64).tolist())
