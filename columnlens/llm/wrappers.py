"""Main text of web pages by wrappers inferred per host.

A wrapper is a union-free regular expression over the pages of a host, kept as a tree of
elements: each child is needed, optional (``?``), repeated (``+``) or both (``*``); each
element's text is a constant or a slot (``#``). It is inferred by alignment: pages are
taken one after another and aligned with the wrapper so far. Children that only one side
has become optional, runs of like children become one repeated child, runs of like
sequences one repeated group, and texts that differ become a slot.

Aligning is a fold, so tasks first fold their own pages per host, then parts of a host are
folded in salted groups, then these. No task ever sees all pages of a host. Each wrapper
then says of each of its text places whether it is main text, in which kind of container
(article, main, or an element named like them): all of the container's texts but the
constant ones. Which kind it is, every page decides by what it has itself, as a host can
have several templates; a page with none gives what is left of the body. A text counts as constant once
``CONFIRMED`` pages with different texts have it; on fewer it stays, as nothing tells a title
from a template. Pages get their host's rules and are read once more.

Blocks end where a block element begins or ends and at line breaks; white space in a block
becomes one space; blocks are joined by one space in page order.

Defined results. Null or empty html: empty text. Null or odd address: the host is empty,
and such pages share a wrapper. Unclosed elements end with their parents, raw elements at
the end of the page. Repeated rows: one result each. Elements deeper than ``DEPTH`` count
as being at that depth.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .storage import saved, text_batches

DEPTH = 60
SALTS = 32
CONSTANT = 60
#: A constant is taken for part of the template once so many different pages have it.
CONFIRMED = 3
#: Kinds of containers of main text, as bits
ARTICLE, MAIN, NAMED, BODY = 1, 2, 4, 8
#: Rules of up to this many bytes are sent to every executor; beyond, pages are shuffled.
SENT_BYTES = 32 << 20

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|title|textarea|noscript|template|iframe)\b((?:[^>"']|"[^"]*"|'[^']*')*)>.*?(?:</\1\s*>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?][^>]*>|([^<]+|<)""",
    re.S | re.I)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var".split())
#: an element of the first kind ends open ones of the second
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
BARRIER = frozenset("ul ol dl table article section div body".split())
APART = frozenset(
    "nav header footer aside form button select dialog menu head svg object audio video canvas".split())
APART_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies "
    "consent notice notices alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "widget related recommended share sharing social comment comments disqus replies newsletter subscribe signup "
    "login search footer header masthead copyright pagination pager toolbar contentinfo complementary "
    "dialog form".split())
MAIN_NAMES = frozenset("main content article post entry story".split())


def _key(tag: str, attributes: str) -> str:
    """Tag with the words of its class, id and role; digits do not tell elements apart."""
    words = set()
    for m in _NAMES.finditer(attributes):
        words.update(re.findall(r"[a-z]+", (m[2] or m[3] or m[4] or "").lower()))
    return ".".join([tag, *sorted(words)])


def events(html: str) -> Iterator[tuple[str, str]]:
    """``("open", key)``, ``("close", "")``, ``("text", text)`` and ``("break", "")`` in page
    order, with left-out end tags put in."""
    stack: list[str] = []
    for m in _TOKEN.finditer(html):
        if m[6] is not None:
            yield "text", m[6]
            continue
        if m[4] is None:  # comment, declaration or raw element
            continue
        tag = m[4].lower()
        if tag in VOID:
            if tag in ("br", "hr"):
                yield "break", ""
            continue
        if m[3]:
            if tag in stack:
                while stack:
                    yield "close", stack[-1]
                    if stack.pop() == tag:
                        break
            continue
        key = _key(tag, m[5])
        if tag not in INLINE:
            ending = ENDS.get(tag, set()) | ({"p"} if tag not in ENDS else set())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i] in ending:
                    for _ in range(len(stack) - i):
                        yield "close", stack.pop()
                    break
                if stack[i] in BARRIER:
                    break
        if m[5].endswith("/") and tag in INLINE:
            continue
        stack.append(tag)
        yield "open", key
    while stack:
        yield "close", stack.pop()


def _plain(key: str) -> bool:
    """Inline elements without names are part of the text around them."""
    return key in INLINE


# A wrapper node is [key, quantifier, text, children, pages]; text: None, a constant, or "#".
# pages: of the pages that have the constant, the CONFIRMED smallest digests; so parts of a
# host can be put together in any order, and copies of a page count once.


def page_wrapper(html: str) -> list:
    """The wrapper of one page."""
    root: list = ["", "", None, [], []]
    stack, inline, off = [root], [], [False]
    held, told = [], hashlib.blake2b(digest_size=6)
    for kind, value in events(html):
        if kind == "open":
            plain = _plain(value) or len(stack) > DEPTH
            inline.append(plain)
            if not plain:
                node = [value, "", None, [], []]
                stack[-1][3].append(node)
                stack.append(node)
                off.append(off[-1] or apart((value,)))
        elif kind == "close":
            if not inline.pop():
                stack.pop()
                off.pop()
        elif kind == "text" and (text := " ".join(value.split())):
            if not off[-1]:  # other menus or ads do not make a copy another page
                told.update(text.encode("utf-8", "replace") + b"\n")
            stack[-1][2] = text if stack[-1][2] is None and len(text) <= CONSTANT else "#"
            held.append(stack[-1])
    page = int.from_bytes(told.digest(), "big")
    for node in held:
        node[4] = [page] if node[2] != "#" else []
    return _folded(root)


def _folded(node: list) -> list:
    node[3] = repeats([_folded(c) for c in node[3]])
    return node


def _quantified(a: str, b: str) -> str:
    some = {"": 0, "?": 1, "+": 2, "*": 3}
    return ["", "?", "+", "*"][some[a] | some[b]]


def align(a: list, b: list) -> list:
    """The wrapper of what either wrapper (of like keys) describes."""
    text = a[2] if a[2] == b[2] else (b[2] if a[2] is None else a[2] if b[2] is None else "#")
    pages = [] if text in (None, "#") else sorted({*a[4], *b[4]})[:CONFIRMED]
    return [a[0], _quantified(a[1], b[1]), text, repeats(_aligned(a[3], b[3])), pages]


def _aligned(a: list, b: list) -> list:
    """Children of both in order: like ones aligned, others optional."""
    if not a or not b:
        return [[c[0], _quantified(c[1], "?"), *c[2:]] for c in a or b]
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i][0] == b[j][0]:
            out.append(align(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append([a[i][0], _quantified(a[i][1], "?"), *a[i][2:]])
            i += 1
        else:
            out.append([b[j][0], _quantified(b[j][1], "?"), *b[j][2:]])
            j += 1
    return out


def repeats(children: list) -> list:
    """Runs of like children, then of like sequences of up to four, as one repeated child.
    A repeated sequence is a child with an empty key."""
    out: list = []
    for c in children:
        if out and out[-1][0] == c[0] and c[0]:
            merged = align(out[-1], c)
            need = "" in (out[-1][1], c[1]) or "+" in (out[-1][1], c[1])
            merged[1] = "+" if need else "*"
            out[-1] = merged
        else:
            out.append(c)
    for width in (2, 3, 4):
        i = 0
        while i + 2 * width <= len(out):
            keys = [c[0] for c in out[i : i + width]]
            n = 1
            while "" not in keys and [c[0] for c in out[i + n * width : i + (n + 1) * width]] == keys:
                n += 1
            if n > 1:
                group = ["", "+", None, out[i : i + width], []]
                for k in range(1, n):
                    group = ["", "+", None, _aligned(group[3], out[i + k * width : i + (k + 1) * width]), []]
                out[i : i + n * width] = [group]
            i += 1
    return out


def expression(node: list) -> str:
    """The wrapper as text: ``ul( li( # )+ )``."""
    inner = " ".join(([] if node[2] is None else [node[2]]) + [expression(c) for c in node[3]])
    return f"{node[0]}( {inner} ){node[1]}" if inner else f"{node[0]}(){node[1]}"


def rules(wrapper: list) -> dict[str, int]:
    """For each path with text, the containers (``ARTICLE``, ``MAIN``, ``NAMED``, ``BODY``) of
    whose main text it is; in pages that have none of the first three, it is that of the body.

    What the wrapper knows as constant is left out of a container, unless all of it is.
    """
    texts: dict[tuple[tuple[str, ...], str], set[int]] = {}  # of the same path in several templates
    todo: list[tuple[list, tuple[str, ...]]] = [(wrapper, ())]
    while todo:
        node, path = todo.pop()
        path = (*path, node[0]) if node[0] else path
        if node[2] is not None:
            texts.setdefault((path, node[2]), set()).update(node[4])
        todo += [(c, path) for c in node[3]]
    places = [(p, len(pages) >= CONFIRMED) for (p, _), pages in texts.items()]
    marks = {"/".join(p): 0 for p, _ in places}
    free = [(p, constant) for p, constant in places if not apart(p)]
    outside = free
    for bit, inside in ((ARTICLE, _in_article), (MAIN, _in_main), (NAMED, _in_named), (BODY, None)):
        own = [(p, c) for p, c in free if inside(p)] if inside else outside
        outside = [(p, c) for p, c in outside if not inside(p)] if inside else []
        for p in {p for p, constant in own if not constant} or {p for p, _ in own}:
            marks["/".join(p)] |= bit
    return marks


def container(found: dict[str, int], marks: dict[str, int]) -> int:
    """Which container holds a page's main text. ``found``: characters at its paths.

    The first kind that the page has; a later one if it has more text beside than the
    earlier one holds, as where an article element is but a teaser.
    """
    chosen, held = BODY, None
    for bit in (ARTICLE, MAIN, NAMED):
        own = {p for p in found if marks.get(p, 0) & bit}
        if own and (held is None or sum(found[p] for p in own - held) > sum(found[p] for p in held)):
            chosen, held = bit, own
    return chosen


def apart(path: tuple[str, ...]) -> bool:
    """Whether an element of the path is by its name no main text."""
    for key in path:
        tag, *names = key.split(".")
        if tag in APART or tag not in ("html", "body") and not APART_NAMES.isdisjoint(names):
            return True
    return False


def _in_article(path: tuple[str, ...]) -> bool:
    return any(k.split(".")[0] == "article" for k in path)


def _in_main(path: tuple[str, ...]) -> bool:
    return any(k.split(".")[0] == "main" or "main" in k.split(".")[1:] for k in path)


def _in_named(path: tuple[str, ...]) -> bool:
    return any(not MAIN_NAMES.isdisjoint(k.split(".")[1:]) for k in path if k.split(".")[0] not in ("html", "body"))


def main_text(html: str, marks: dict[str, int]) -> str:
    """The page's blocks at the places that the rules keep in the page's container."""
    path, inline = [""], []
    found: dict[str, int] = {}
    steps: list[tuple[str, str, str]] = []  # kind, text or key, path
    for kind, value in events(html):
        if kind == "text":
            if not value.isspace():
                found[path[-1]] = found.get(path[-1], 0) + len(value)
        elif kind == "open":
            plain = _plain(value) or len(path) > DEPTH
            inline.append(plain)
            if not plain:
                path.append(f"{path[-1]}/{value}" if path[-1] else value)
        elif kind == "close" and not inline.pop():
            path.pop()
        steps.append((kind, value, path[-1]))
    chosen = container(found, marks)
    blocks, block = [], []

    def flush() -> None:
        if block:
            text = " ".join("".join(block).split())
            if text:
                blocks.append(text)
            block.clear()

    for kind, value, at in steps:
        if kind == "text":
            if marks.get(at, 0) & chosen:
                block.append(unescape(value))
        elif kind == "break" or value.split(".")[0] not in INLINE:
            flush()
    flush()
    return " ".join(blocks)


def host_of(url):
    """Host of an address in lower case; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1), F.lit("")))


def _fold(wrappers: Iterator[list]) -> list | None:
    held = None
    for w in wrappers:
        held = w if held is None else align(held, w)
    return held


def _learn(lots: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper per host of the task's pages; given out early if hosts become many."""
    held: dict[str, list] = {}

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array([json.dumps(w) for w in held.values()], pa.string())],
            names=["host", "wrapper"])

    for batch in lots:
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            wrapper = page_wrapper(html or "")
            held[host] = align(held[host], wrapper) if host in held else wrapper
        if len(held) > 5000:
            yield out()
            held.clear()
    if held:
        yield out()


def wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``host, wrapper`` (as JSON): one per host, from all its pages."""
    rows = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html"))
    parts = text_batches(rows).mapInArrow(_learn, "host string, wrapper string").distinct()

    def fold(group: pd.DataFrame) -> pd.DataFrame:
        whole = _fold(json.loads(w) for w in sorted(group["wrapper"]))
        return pd.DataFrame({"host": [group["host"].iloc[0]], "wrapper": [json.dumps(whole)]})

    salted = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    some = salted.groupBy("host", "salt").applyInPandas(fold, "host string, wrapper string")
    return some.groupBy("host").applyInPandas(fold, "host string, wrapper string")


def extracted(pages: DataFrame, url: str = "url", html: str = "html", sent_bytes: int = SENT_BYTES) -> DataFrame:
    """All columns and ``text``: the page's main text. A column of that name is replaced.

    The rules of all hosts are measured: up to ``sent_bytes`` they are sent to the pages,
    beyond that pages and rules meet by host in a join that Spark splits where a host is hot.
    """
    pages = pages.drop("text")
    learned = saved(wrappers(pages, url, html), "wrappers")
    size = learned.agg(F.sum(F.length("wrapper") + F.length("host"))).first()[0] or 0
    learned = learned.select(F.col("host").alias("_host"), F.col("wrapper").alias("_wrapper"))
    joined = pages.withColumn("_of", host_of(F.col(url))).join(
        F.broadcast(learned) if size <= sent_bytes else learned, F.col("_of") == F.col("_host"), "left")
    joined = joined.drop("_of", "_host")
    out = StructType([*pages.schema.fields, *StructType.fromDDL("text string").fields])
    names = pages.columns

    def run(lots):
        known: dict[str, dict[str, int]] = {}
        for batch in lots:
            own = batch.column("_wrapper").dictionary_encode()
            held = own.dictionary.to_pylist()
            texts = []
            for i, page in zip(own.indices.to_pylist(), batch.column(html).to_pylist()):
                name = held[i]
                if name not in known:
                    if len(known) > 5000:
                        known.clear()
                    known[name] = rules(json.loads(name))
                texts.append(main_text(page or "", known[name]))
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*names, "text"])

    return text_batches(joined).mapInArrow(run, out)
