"""HTML extraction by equivalence-class template deduction.

Tokens of a page are its elements, by path with classes, and its text blocks,
by path and text.  Over all pages of a host each token has an occurrence
vector (how often it occurs on each page); tokens with equal vectors form an
equivalence class.  Vectors are never built: each page adds a hash of (page,
count) by exclusive or, so equal vectors have equal sums and Spark combines
them before the shuffle, also for a host with a third of all pages.  A class
is valid if it has ``MIN_SIZE`` tokens, as an element with its text, and lies on at least ``MIN_PAGES`` pages and half
of the host's: a passage that articles share, in an element like all others, is no template.
Classes are ordered and nested: where the tokens of a class do not follow each other in the same order on every page and
at every occurrence, it is cut into runs that do, each of which has to be of ``MIN_SIZE`` again; where one class begins in
a gap between two tokens of another and ends outside of it, the larger of them stays.
Pages of one host with the same blocks count once, so copies of an article
are not taken for template.  Blocks of a valid class are fixed text; what is
left are the slots.

A page's text is what its slots hold, in page order: those of its ``article``
or ``main`` elements where it has them, else all of them, without fixed text
outside articles and without elements that are menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles or reader comments by their
tag, role, class or id.  A class or id counts only as a whole: every part of it must be a known name (``cookie-bar``,
``site-footer-2``), so ``has-comments`` and ``no-sidebar`` say nothing.  Class and id never hide a page's only article, nor
all of its text.  No slot is left out for being small or apart.

An element's path is a hash of its parent's path and itself, so a page of any depth takes memory in proportion to its length.

Defined cases: null html gives empty text; a null or odd url has the host "";
tags cut off at the end are dropped; unknown character references stay;
hosts of fewer than ``MIN_PAGES`` different pages have no fixed text; repeated rows
have a row of text each; empty tables give no rows; other input columns are not used.
"""
from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.session import materialize

MIN_PAGES, PAGE_SHARE, MIN_SIZE = 3, 0.5, 2

# Fixed by the HTML standard: elements that stand as blocks, have no end tag, or hold raw text.
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p
pre search section summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
# An open element that ends where one of these begins, unless a container stands between.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
        "th": {"td", "th", "tr"}, "option": {"option"}}
ENDED_BY = {k: [t for t, by in ENDS.items() if k in by] for k in {x for by in ENDS.values() for x in by}}
CONTAINER = frozenset("ul ol dl table tbody thead tfoot select menu body article section div main".split())
# What is not the article.
SKIP = frozenset("""head nav footer aside form button select input textarea script style noscript template iframe svg
canvas object menu dialog title label fieldset search""".split())
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
SKIP_NAMES = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments
consent cookie cookies discussion footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices
popup promo promotion related replies reply respond share sharing sidebar sidenav signup social sponsor sponsored
subscribe toolbar topbar widget disqus""".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)
    |<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+)>
    |<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>
    |<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z""", re.S | re.X)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_PART = re.compile("[a-z]+")
# Parts that say where or what kind of box a named element is, and nothing of its content.
BOX_NAMES = frozenset("""site page main global top bottom left right primary secondary header box bar list area section container
wrapper wrap block links link buttons button form inner outer item items slot unit col column panel row group thread
id js post posts entry blog article articles story stories mobile desktop sticky fixed float floating""".split())
COMMENT_NAMES = frozenset("comment comments discussion replies reply respond disqus".split())


@lru_cache(4096)
def named(names: str) -> tuple[bool, bool, bool]:
    """Does a class or id name what is not the article, are these reader comments, is one ``header``?"""
    skip = comment = head = False
    for token in names.split():
        parts = set(_PART.findall(token))
        if parts and parts <= SKIP_NAMES | BOX_NAMES:
            if parts & SKIP_NAMES:
                skip = True
                comment = comment or bool(parts & COMMENT_NAMES)
            head = head or "header" in parts
    return skip, comment, head


def _path(parent: int, tag: str, label: str) -> int:
    return xxhash.xxh64_intdigest(f"{parent}/{tag}.{label}")


class Element:
    """An open element; ``skip`` by tag or role, ``weak`` by class or id, ``main`` in an article.  ``root`` is the
    outermost article and ``block`` the nearest block or skipped element, it or one above it."""
    __slots__ = ("tag", "path", "skip", "weak", "comment", "main", "root", "block")

    def __init__(self, tag: str, attrs: str, parent: "Element | None"):
        names, role, hidden, label = "", "", False, ""
        if attrs.strip(" /\n\t"):
            got = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attrs)}
            names = f"{got.get('class', '')} {got.get('id', '')}".lower()
            role = got.get("role", "").lower()
            hidden = "hidden" in got or got.get("aria-hidden") == "true"
            label = ".".join(sorted(got.get("class", "").lower().split()))
        self.tag = tag
        self.path = _path(parent.path if parent else 0, tag, label)
        weak, comment, head = named(names) if names.strip() else (False, False, False)
        above = parent is not None and parent.root is not None
        skip = tag in SKIP or role in SKIP_ROLES or hidden or (tag == "header" and not above)
        weak = weak or (head and not above)
        if tag in ("html", "body"):
            skip = weak = comment = False
        self.skip = (parent.skip if parent else False) or skip
        self.weak = (parent.weak if parent else False) or weak
        self.comment = (parent.comment if parent else False) or comment
        article = tag in ("article", "main") or role in ("main", "article")
        self.root = parent.root if above else self if article and not self.skip else None
        self.main = self.root is not None and not self.skip
        self.block = self if tag in BLOCK or skip or weak else parent.block if parent else None


class Block:
    __slots__ = ("text", "path", "skip", "main", "weak", "comment", "root")

    def __init__(self, text: str, e: Element | None):
        self.text = text
        self.path, self.skip, self.main, self.weak, self.comment, self.root = (
            (e.path, e.skip, e.main, e.weak, e.comment, e.root) if e else (0, False, False, False, False, None))


def _settle(blocks: list[Block], roots: list[Element]) -> list[Block]:
    """Decide on elements hidden by class or id alone: they stay hidden, but for a page's only article (reader
    comments apart) and for a page that would have no text."""
    outer = [r for r in roots if not r.comment]
    only = outer[0] if len(outer) == 1 and outer[0].weak else None
    for x in blocks:
        x.weak = x.weak and not (only is not None and x.root is only)
    # comments come back only where there is nothing else
    for hidden in (lambda x: x.weak, lambda x: x.comment, lambda x: False):
        if any(not x.skip and not hidden(x) for x in blocks):
            break
    for x in blocks:
        x.skip = x.skip or hidden(x)
        x.main = x.main and not x.skip
    return blocks


def parse(page: str, order: list | None = None) -> tuple[list[Block], dict[int, int]]:
    """Text blocks in page order, and how often each element path occurs.  Linear in the page, at any depth.
    ``order`` takes the paths of elements, where they open, and the blocks, where they end."""
    stack: list[Element] = []
    open_: Counter = Counter()           # open elements by tag
    roots: list[Element] = []            # outermost articles
    blocks: list[Block] = []
    seen: dict[int, int] = {}
    parts: list[str] = []
    owner: Element | None = None
    raw_until, at = None, 0

    def flush():
        nonlocal parts
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text:
                blocks.append(Block(text, owner))
                if order is not None:
                    order.append(blocks[-1])
            parts = []

    def add(text):
        nonlocal owner
        if not text:
            return
        here = stack[-1].block if stack else None
        if here is not owner and (parts and (here is None or owner is None or here.path != owner.path
                                             or (here.skip, here.weak) != (owner.skip, owner.weak))):
            flush()
        owner = here
        parts.append(text)

    def close(k):
        for e in stack[k:]:
            open_[e.tag] -= 1
        del stack[k:]

    while True:
        if raw_until:
            m = re.compile(f"</{re.escape(raw_until)}(?=[\\s/>]|\\Z)", re.I).search(page, at)
            at = m.start() if m else len(page)
            raw_until = None
        m = _TAG.search(page, at)
        add(page[at:m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            if m[0].startswith("<![CDATA["):
                add(html_lib.escape(m[0][9:].removesuffix("]]>")))
            continue
        name = name.lower()
        if m["end"] or m["end2"]:
            if name in BLOCK:
                flush()
            if open_[name]:
                k = next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == name)
                if any(e.tag in BLOCK for e in stack[k:]):
                    flush()
                close(k)
            continue
        if name == "br":
            add(" ")
            continue
        if name in BLOCK:
            flush()
            # a block ends an open paragraph; items end their like
            ends = ("p", *ENDED_BY.get(name, ()))
            for i in range(len(stack) - 1, -1, -1) if any(open_[t] for t in ends) else ():
                t = stack[i].tag
                if t == "p" or name in ENDS.get(t, ()):
                    close(i)
                    break
                if t in CONTAINER:
                    break
        e = Element(name, m["attrs"] or m["attrs2"] or "", stack[-1] if stack else None)
        seen[e.path] = seen.get(e.path, 0) + 1
        if order is not None:
            order.append(e.path)
        if name in VOID:
            continue
        if (e.skip, e.weak) != ((stack[-1].skip, stack[-1].weak) if stack else (False, False)):
            flush()
        if e.root is e:
            roots.append(e)
        stack.append(e)
        open_[name] += 1
        if name in RAW:
            raw_until = name
    flush()
    return _settle(blocks, roots), seen


def _token(kind: str, path: int, text: str = "") -> int:
    return xxhash.xxh64_intdigest(f"{kind}\0{path}\0{text}") - (1 << 63)


def host(url) -> Column:
    return F.regexp_extract(F.lower(F.coalesce(F.col(url), F.lit(""))), r"^[a-z][a-z0-9+.\-]*://([^/?#]*)", 1)


_SEQUENCE = "host string, page bigint, tokens array<bigint>, is_text array<boolean>"
_TOKENS = "host string, token bigint, page bigint, is_text boolean, vector bigint, n bigint"
_PAGE = 0                          # the token that every page has once


def page_sequences(pages: DataFrame) -> DataFrame:
    """The tokens of every page in page order.  ``page`` is a hash of the page's blocks outside of menus and the like, the
    same for copies."""
    t = pages.select(host("url").alias("host"), F.coalesce("html", F.lit("")).alias("h"))

    def run(batches):
        for b in batches:
            cols: list[list] = [[] for _ in range(4)]
            for h, html in zip(b.column(0).to_pylist(), b.column(1)):
                order: list = []
                blocks, _ = parse(html.as_py(), order)
                # blocks of an article are never fixed text, but they tell its copies from other pages
                content = xxhash.xxh64()
                for x in blocks:
                    if not x.skip:
                        content.update(f"{x.path}\0{x.text}\0")
                tokens, is_text = [], []
                for x in order:
                    if isinstance(x, int):
                        tokens.append(_token("e", x))
                        is_text.append(False)
                    elif not x.skip and not x.main:
                        tokens.append(_token("t", x.path, x.text))
                        is_text.append(True)
                for c, v in zip(cols, (h, content.intdigest() - (1 << 63), tokens, is_text)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
                                              pa.array(cols[2], pa.list_(pa.int64())), pa.array(cols[3], pa.list_(pa.bool_()))],
                                             ["host", "page", "tokens", "is_text"])
    return t.mapInArrow(run, _SEQUENCE)


def page_tokens(sequences: DataFrame) -> DataFrame:
    """One row for each page and token: its share in the occurrence vector."""
    def run(batches):
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for h, page, tokens, is_text in zip(*(c.to_pylist() for c in b.columns)):
                kinds = dict(zip(tokens, is_text))
                found = Counter(tokens)
                found[_PAGE] = 1
                for token, n in found.items():
                    vector = xxhash.xxh64_intdigest(f"{page}:{n}") - (1 << 63)
                    for c, v in zip(cols, (h, token, page, kinds.get(token, False), vector, n)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
                                              pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.bool_()),
                                              *[pa.array(c, pa.int64()) for c in cols[4:]]],
                                             ["host", "token", "page", "is_text", "vector", "n"])
    return sequences.mapInArrow(run, _TOKENS)


def _befores(batches):
    """(host, token, before): what comes before a token among the tokens of its class, each different case once a batch."""
    for b in batches:
        seen = set()
        for h, tokens, members in zip(*(c.to_pylist() for c in b.columns)):
            cls, last = {m["token"]: m["cls"] for m in members}, {}
            for t in tokens:
                if t in cls:
                    seen.add((h, t, last.get(cls[t])))
                    last[cls[t]] = t
        rows = list(zip(*seen)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int64())],
                                         ["host", "token", "before"])


def _chain(links: pa.Table) -> pa.Table:
    """Ordered classes of a host: runs of tokens each of which always comes after the same one.  Of two or more tokens."""
    rows = links.to_pylist()
    after = {r["before"]: r["token"] for r in rows if r["before"] is not None}
    out = []
    for r in rows:
        if r["before"] is None:
            chain, t = [], r["token"]
            while t is not None:
                chain.append(t)
                t = after.get(t)
            if len(chain) >= MIN_SIZE:
                out += [(r["host"], t, chain[0], i, len(chain)) for i, t in enumerate(chain)]
    cols = list(zip(*out)) or [()] * 5
    return pa.table([pa.array(c, pa.string() if i == 0 else pa.int64()) for i, c in enumerate(cols)], names=["host", "token", "cls", "place", "size"])


def crossings(tokens: list[int], members: dict[int, tuple[int, int, int]]) -> set[tuple[int, int]]:
    """Pairs of classes of which one begins in a gap of the other and ends outside of it.  ``members``: token -> (class, place, size)."""
    open_: list[list[int]] = []                      # class, place of its last token
    out = set()
    for t in tokens:
        if t not in members:
            continue
        cls, place, size = members[t]
        if place == 0:
            open_.append([cls, 0])
        else:
            k = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == cls), None)
            if k is None:                            # closed by a crossing before
                continue
            out |= {(min(cls, c), max(cls, c)) for c, _ in open_[k + 1:]}
            del open_[k + 1:]
            open_[k][1] = place
        if open_ and open_[-1] == [cls, size - 1]:
            open_.pop()
    return out


def _crossed(batches):
    for b in batches:
        seen = set()
        for h, tokens, members in zip(*(c.to_pylist() for c in b.columns)):
            seen |= {(h, *x) for x in crossings(tokens, {m["token"]: (m["cls"], m["place"], m["size"]) for m in members})}
        rows = list(zip(*seen)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int64())],
                                         ["host", "a", "b"])


def nested(sizes: dict[int, int], crossed: list[tuple[int, int]]) -> set[int]:
    """The classes that stay: from the largest on (ties by id), each that crosses none that stays."""
    other: dict[int, set[int]] = {}
    for a, b in crossed:
        other.setdefault(a, set()).add(b)
        other.setdefault(b, set()).add(a)
    stay: set[int] = set()
    for c in sorted(sizes, key=lambda c: (-sizes[c], c)):
        if not stay & other.get(c, set()):
            stay.add(c)
    return stay


def _fixed(row: pa.Table) -> pa.Table:
    """Text tokens of the classes of a host that stay."""
    r = row.to_pylist()[0]
    stay = nested({m["cls"]: m["size"] for m in r["members"]}, [(x["a"], x["b"]) for x in r["crossed"] or ()])
    texts = sorted({m["token"] for m in r["members"] if m["cls"] in stay and m["is_text"]})
    return pa.table([pa.array([r["host"]], pa.string()), pa.array([texts or None], pa.list_(pa.int64()))], names=["host", "fixed"])


def templates(pages: DataFrame) -> DataFrame:
    """(host, fixed array<bigint>): fixed text tokens of each host, over its different pages."""
    sequences = materialize(page_sequences(pages), "page-sequences")
    once = page_tokens(sequences).groupBy("host", "token", "page").agg(
        F.max("is_text").alias("is_text"), F.max(F.struct("n", "vector")).alias("v")).select("host", "token", "is_text", "v.*")
    tokens = materialize(once.groupBy("host", "token").agg(
        F.bit_xor("vector").alias("vector"), F.count(F.lit(1)).alias("support"), F.sum("n").alias("n"),
        F.max("is_text").alias("is_text")), "page-tokens")
    hosts = tokens.where(F.col("token") == _PAGE).select("host", F.col("support").alias("pages"))
    # an equivalence class: equal vector, hence equal support and count
    classes = tokens.where(F.col("token") != _PAGE).groupBy("host", "vector", "support", "n").agg(F.count(F.lit(1)).alias("size"))
    valid = classes.join(hosts, "host").where(
        (F.col("size") >= MIN_SIZE) & (F.col("support") >= MIN_PAGES) & (F.col("support") >= PAGE_SHARE * F.col("pages")))
    valid = materialize(valid.select("host", "vector", "support", "n"), "classes")
    cls = ["host", "vector", "support", "n"]
    # tokens of valid classes: at most 1 / PAGE_SHARE times the tokens of a page for each host
    members = materialize(tokens.where(F.col("token") != _PAGE).join(valid, cls, "left_semi").select(
        "host", "token", "is_text", F.xxhash64(*cls).alias("cls")), "class-tokens")
    # order: a class is cut where its tokens do not always follow each other
    seen = sequences.select("host", "tokens")
    known = members.groupBy("host").agg(F.collect_list(F.struct("token", "cls")).alias("members"))
    befores = seen.join(known, "host").mapInArrow(_befores, "host string, token bigint, before bigint")
    same = (F.min("before") == F.max("before")) & (F.count("before") == F.count(F.lit(1)))
    links = befores.groupBy("host", "token").agg(F.when(same, F.min("before")).alias("before"))
    ordered = materialize(links.groupBy("host").applyInArrow(_chain, "host string, token bigint, cls bigint, place bigint, size bigint").join(
        members.select("host", "token", "is_text"), ["host", "token"]), "ordered-classes")
    # nesting: of two classes that cross on a page the larger one stays
    known = materialize(ordered.groupBy("host").agg(F.collect_list(F.struct("token", "cls", "place", "size", "is_text")).alias("members")), "members")
    crossed = seen.join(known, "host").mapInArrow(_crossed, "host string, a bigint, b bigint").distinct()
    crossed = crossed.groupBy("host").agg(F.collect_list(F.struct("a", "b")).alias("crossed"))
    fixed = known.join(crossed, "host", "left").groupBy("host").applyInArrow(_fixed, "host string, fixed array<bigint>")
    return materialize(hosts.select("host").join(fixed, "host", "left"), "templates")


def page_text(page: str, fixed: set[int]) -> str:
    """The text of one page, given its host's fixed text."""
    blocks = [x for x in parse(page)[0] if not x.skip]
    if any(x.main for x in blocks):
        blocks = [x for x in blocks if x.main]
    elif fixed:
        blocks = [x for x in blocks if _token("t", x.path, x.text) not in fixed]
    return "\n".join(x.text for x in blocks)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    known = templates(pages)
    t = pages.select("page_id", "url", host("url").alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    t = t.join(known, "host", "left").select("page_id", "url", "html", "fixed")
    schema = T.StructType([*t.schema.fields[:2], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for b in batches:
            texts = [page_text(h.as_py(), set(f.as_py() or ())) for h, f in zip(b.column(2), b.column(3))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                              pa.array(np.array([len(x) for x in texts], np.int64))], schema.names)
    return t.mapInArrow(run, schema)
