"""Main text of web pages by union-free wrappers of their hosts.

A page is a stream of tags and text slots. Adjoining copies of a pattern of up to three elements
become a repeated group, so pages of one template share one skeleton. The skeletons of a host are
aligned one after another: what both have is kept, what one lacks becomes optional, texts become
slots. The result, a regular expression without unions, is the host's wrapper. Its slots carry how
much text they hold in and outside links, which tells the article from what surrounds it; every
page is then read by its place in the wrapper.

A task counts skeletons, not pages, so inference sees all pages of a host however many there are, and
moves no page. All skeletons of a host are aligned, in rounds that merge a bounded number of them, then
of partial wrappers, in one task. Only the wrappers are sent to the pages.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import checkpointed
from fieldspark.llm.urls import host_of

# Element names of HTML by what they mean for the reading of a page.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style".split())
_INLINE = frozenset(
    "abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub "
    "sup time tt u var wbr img".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section "
    "table ul".split()
)
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = frozenset("ul ol dl table tbody thead tfoot tr td th select body html article div section main".split())
_HIDDEN = frozenset(
    "head script style noscript template nav header footer aside form menu button select textarea input iframe object svg canvas dialog "
    "title option label fieldset".split()
)
_HIDDEN_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent notice notices alert sidebar "
    "menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments reply replies respond disqus share sharing "
    "social related recommended newsletter subscribe signup popup modal widget login search pagination pager toolbar".split()
)
_ARTICLE_NAMES = frozenset("article articlebody story entry post".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>""")
_TOKEN = re.compile(r"<!--|<[/a-zA-Z!?]")
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SHOWN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?false)", re.I)
_DEEPEST = 150
_TEXT, _LINKED = "#", "a"
#: Characters of wrappers that a task keeps parsed.
_PARSED = 1 << 20
_LONGEST_PATTERN = 3


@dataclass
class Node:
    """An element, or a text slot (key ``#``): children in order, and which texts of the page it stands for."""

    key: str
    children: list[Node] = field(default_factory=list)
    texts: list[int] = field(default_factory=list)
    optional: bool = False
    repeated: bool = False
    chars: int = 0
    slots: list[int] = field(default_factory=list)

    @property
    def name(self) -> str:
        return self.key.partition(".")[0]


def _key(name: str, attributes: str) -> str:
    """An element's name with its class, id and role names, digits left out."""
    if "=" not in attributes and "hidden" not in attributes:
        return name
    names = {w for m in _NAMES.finditer(attributes) for w in re.split(r"[^a-z]+", (m[1] or m[2] or m[3] or "").lower()) if w}
    if _SHOWN.search(attributes.split("=")[0]) or re.search(r"display\s*:\s*none", attributes, re.I):
        names.add("hidden")
    return ".".join([name, *sorted(names)])


def parsed(page: str) -> tuple[Node, list[str]]:
    """The element tree of a page and its texts, raw, in page order; each text is a slot.

    Elements left open are closed where HTML implies it. Inline elements are transparent: texts
    they part are one. Beyond a depth of 150, elements are transparent but still part texts.
    """
    root = Node("root")
    stack, names = [root], [""]
    texts: list[str] = []
    run: list[str] = []  # pieces of the text under way

    def flush() -> None:
        if run:
            text = "".join(run)
            run.clear()
            if text.strip():
                stack[-1].children.append(Node(_TEXT, texts=[len(texts)]))
                texts.append(text)

    def close(down_to: int) -> None:
        flush()
        del stack[down_to:], names[down_to:]

    at, n = 0, len(page)
    while at < n:
        found = _TOKEN.search(page, at)
        if found is None:
            run.append(page[at:])
            break
        if found.start() > at:
            run.append(page[at : found.start()])
        at = found.start()
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = n if end < 0 else end + 3
            continue
        if page[at + 1] in "!?":
            end = page.find(">", at)
            at = n if end < 0 else end + 1
            continue
        tag = _TAG.match(page, at)
        if tag is None:
            run.append("<")
            at += 1
            continue
        at = tag.end()
        closing, name, attributes = tag[1], tag[2].lower(), tag[3]
        if name in _RAW:
            flush()
            if not closing:
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = n if end is None else end.end()
            continue
        if name in _INLINE:
            continue
        if closing:
            if name == "br":
                flush()
            elif name in names:
                close(len(names) - 1 - names[::-1].index(name))
            else:
                flush()
            continue
        flush()
        if name in _VOID:
            continue
        if name in _CLOSES_P and "p" in names:
            close(len(names) - 1 - names[::-1].index("p"))
        for i in range(len(names) - 1, 0, -1):
            if names[i] in _CLOSES.get(name, ()):
                close(i)
            elif names[i] in _SCOPES:
                break
        if len(stack) < _DEEPEST:
            node = Node(_key(name, attributes))
            stack[-1].children.append(node)
            stack.append(node)
            names.append(name)
    flush()
    return root, texts


def _merged(a: Node, b: Node) -> Node:
    """One node for two with the same key."""
    return Node(
        a.key, _aligned(a.children, b.children), a.texts + b.texts, a.optional or b.optional, a.repeated or b.repeated,
        a.chars + b.chars, a.slots + b.slots,
    )


def _aligned(a: list[Node], b: list[Node]) -> list[Node]:
    """Both sequences as one: a longest common subsequence of keys is merged, the rest is optional."""
    if [x.key for x in a] == [x.key for x in b]:
        return [_merged(x, y) for x, y in zip(a, b)]
    n, m = len(a), len(b)
    # Only keys that both have count; at_a and at_b are places among those.
    shared = {x.key for x in a} & {x.key for x in b}
    in_a, in_b = ([x.key for x in side if x.key in shared] for side in (a, b))
    at_a, at_b = (list(accumulate((x.key in shared for x in side), initial=0)) for side in (a, b))
    best = [[0] * (len(in_b) + 1) for _ in range(len(in_a) + 1)]
    for i in range(len(in_a) - 1, -1, -1):
        for j in range(len(in_b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if in_a[i] == in_b[j] else max(best[i + 1][j], best[i][j + 1])
    found, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i].key == b[j].key:
            found.append(_merged(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[at_a[i + 1]][at_b[j]] >= best[at_a[i]][at_b[j + 1]]):
            a[i].optional = True
            found.append(a[i])
            i += 1
        else:
            b[j].optional = True
            found.append(b[j])
            j += 1
    return found


def _alike(a: Node, b: Node) -> bool:
    """Whether two adjoining elements of one key may be repeats: elements that may hold anything must
    hold the same kinds of children."""
    if a.key != b.key:
        return False
    if a.name not in ("div", "section", "span"):
        return True
    return {c.key for c in a.children} == {c.key for c in b.children}


def folded(node: Node) -> Node:
    """The node with adjoining copies of patterns of up to three elements made one repeated group."""
    children: list[Node] = []
    for child in (folded(c) for c in node.children):
        children.append(child)
        again = True
        while again:
            again = False
            for k in range(1, _LONGEST_PATTERN + 1):
                if len(children) >= 2 * k and all(_alike(x, y) for x, y in zip(children[-2 * k : -k], children[-k:])):
                    group = [_merged(x, y) for x, y in zip(children[-2 * k : -k], children[-k:])]
                    for x in group:
                        x.repeated = True
                    del children[-2 * k :]
                    children += group
                    again = k > 1
                    break
    node.children = children
    return node


def _walk(node: Node, path: tuple[Node, ...] = ()) -> Iterator[tuple[Node, tuple[Node, ...]]]:
    """Text slots in order, with the elements around them."""
    if node.key == _TEXT:
        yield node, path
    for child in node.children:
        yield from _walk(child, (*path, node))


def written(node: Node) -> str:
    """A skeleton or wrapper as a regular expression over tags and text slots."""
    mark = "*" if node.optional and node.repeated else "?" if node.optional else "+" if node.repeated else ""
    if node.key == _TEXT:
        return f"#{mark}"
    inner = " ".join(written(c) for c in node.children)
    return f"<{node.key}>{mark}({inner})" if inner else f"<{node.key}>{mark}"


_PART = re.compile(r"<([^>]*)>([?+*]?)(\()?|#([?+*]?)|\)")


def read(text: str) -> Node:
    """The inverse of ``written``."""
    stack: list[Node] = [Node("")]
    for part in _PART.finditer(text):
        if part[0] == ")":
            stack.pop()
            continue
        mark = part[2] if part[1] is not None else part[4]
        node = Node(part[1] if part[1] is not None else _TEXT, optional=mark in ("?", "*"), repeated=mark in ("+", "*"))
        stack[-1].children.append(node)
        if part[3]:
            stack.append(node)
    return stack[0].children[0]


def _hidden(node: Node) -> bool:
    name, *names = node.key.split(".")
    return name in _HIDDEN or "hidden" in names or not _HIDDEN_NAMES.isdisjoint(names)


def _outside_article(node: Node) -> bool:
    """Hidden, unless the name belongs to the page's own frame."""
    return _hidden(node) and node.name not in ("html", "body", "article", "main")


def _shown(wrapper: Node) -> list[tuple[int, Node, tuple[Node, ...]]]:
    """The text slots outside menus, notices, forms and the like: place, slot, elements around it."""
    return [(i, node, path) for i, (node, path) in enumerate(_walk(wrapper)) if not any(map(_outside_article, path))]


def _named_slots(wrapper: Node) -> set[int]:
    """The places of the slots in article elements, else in elements named like one, else in the main
    element; empty if none of these holds text."""
    slots = _shown(wrapper)

    def named(p: Node) -> bool:
        return not _ARTICLE_NAMES.isdisjoint(p.key.split(".")[1:]) and p.name not in ("html", "body")

    for by in (lambda p: p.name == "article", named, lambda p: p.name == "main" or "main" in p.key.split(".")[1:]):
        found = [s for s in slots if any(by(p) for p in s[2])]
        if sum(s[1].chars for s in found):
            return {s[0] for s in found}
    return set()


def _heaviest_slots(wrapper: Node) -> set[int]:
    """The places of the slots in the smallest element that holds seven tenths of the text outside links."""
    slots, weight = _shown(wrapper), Counter()
    for _, slot, path in slots:
        if not any(p.name == _LINKED for p in path):
            for p in path:
                weight[id(p)] += slot.chars
    at = wrapper
    while True:
        least = 0.7 * weight[id(at)]
        inner = [c for c in at.children if c.key != _TEXT and not _outside_article(c) and weight[id(c)] >= least > 0]
        if not inner:
            return {s[0] for s in slots if any(p is at for p in s[2])}
        at = inner[0]


def main_slots(wrapper: Node) -> set[int]:
    """The places, in order, of the text slots that hold the article.

    Slots in menus, notices, forms and the like are left out. The article is what article elements
    hold, else elements named like one, else the main element; without any of these it is the
    smallest element that holds seven tenths of the text outside links.
    """
    return _named_slots(wrapper) or _heaviest_slots(wrapper)


def _skeleton(page: str) -> tuple[Node, list[str], str]:
    root, texts = parsed(page)
    root = folded(root)
    return root, texts, written(root)


def _clean(text: str) -> str:
    return " ".join(entities.unescape(text).split())


def _lengths(root: Node, texts: list[str]) -> list[int]:
    """The characters in each slot of a page."""
    return [sum(len(texts[t]) for t in slot.texts) for slot, _ in _walk(root)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, digest, slot, skeleton, pages, chars) of the pages of a batch. A skeleton and its pages stand
    at slot -1 only; its digest stands for it elsewhere."""
    for batch in batches:
        counts: dict[tuple[str, str], list[int]] = {}
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            root, texts, skeleton = _skeleton(page or "")
            chars = _lengths(root, texts)
            held = counts.setdefault((host, skeleton), [0] * (len(chars) + 1))
            held[0] += 1
            for i, c in enumerate(chars, 1):
                held[i] += c
        rows = []
        for (host, skeleton), (n, *chars) in counts.items():
            digest = hashlib.blake2b(skeleton.encode(), digest_size=16).digest()
            rows.append((host, digest, -1, skeleton, n, 0))
            rows += [(host, digest, slot, None, 0, c) for slot, c in enumerate(chars)]
        if rows:
            columns = zip(*rows)
            kinds = (pa.string(), pa.binary(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            names = ["host", "digest", "slot", "skeleton", "pages", "chars"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _weighed(text: str, chars: list[int]) -> Node:
    """A skeleton or wrapper with the characters in each of its slots."""
    node = read(text)
    for (leaf, _), c in zip(_walk(node), chars):
        leaf.chars = c
    return node


def inferred(skeletons: list[tuple[str, list[int]]]) -> Node:
    """The wrapper of skeletons with the characters in each of their slots, aligned one by one."""
    wrapper = None
    for text, chars in skeletons:
        node = _weighed(text, chars)
        wrapper = node if wrapper is None else _merged(wrapper, node)
    return wrapper


def _placed(known: Node, skeleton: str, chars: list[int]) -> tuple[set[int], bool]:
    """Which slots of a page's skeleton hold the article, by its place in the wrapper, and whether names
    alone decided, not lengths. The page's texts, of ``chars`` characters, weigh beside those of the
    wrapper. Where the page meets no slot of the wrapper's article, its own structure decides."""
    page = _weighed(skeleton, chars)
    for i, (leaf, _) in enumerate(_walk(page)):
        leaf.slots = [i]
    both = _merged(known, page)
    named = _named_slots(both)
    main = named or _heaviest_slots(both)
    found = {s for i, (leaf, _) in enumerate(_walk(both)) if i in main for s in leaf.slots}
    if found:
        return found, bool(named)
    page = _weighed(skeleton, chars)
    own = _named_slots(page)
    return own or _heaviest_slots(page), bool(named and own)


_PARTIAL = "host string, part bigint, parts bigint, wrapper string, chars array<bigint>, pages bigint"


def _partial(key: tuple, ranked: list[tuple[int, str, list[int]]]) -> pa.Table:
    """A row of ``_PARTIAL`` from (pages, skeleton or wrapper, characters), aligned most pages first."""
    wrapper = inferred([(text, chars) for _, text, chars in sorted(ranked, key=lambda r: (-r[0], r[1]))])
    host, part, parts = (k.as_py() for k in key)
    return pa.table({
        "host": pa.array([host], pa.string()), "part": pa.array([part], pa.int64()), "parts": pa.array([parts], pa.int64()),
        "wrapper": pa.array([written(wrapper)], pa.string()), "chars": pa.array([[leaf.chars for leaf, _ in _walk(wrapper)]], pa.list_(pa.int64())),
        "pages": pa.array([sum(r[0] for r in ranked)], pa.int64()),
    })


def _of_skeletons(key: tuple, rows: pa.Table) -> pa.Table:
    held: dict[bytes, dict[int, int]] = {}
    texts: dict[bytes, tuple[int, str]] = {}
    for digest, slot, skeleton, n, chars in zip(*(rows[c].to_pylist() for c in ("digest", "slot", "skeleton", "pages", "chars"))):
        of_digest = held.setdefault(digest, {})
        if slot < 0:
            texts[digest] = (n, skeleton)
        else:
            of_digest[slot] = chars
    return _partial(key, [(*texts[d], [c for _, c in sorted(slots.items())]) for d, slots in held.items()])


def _of_partials(key: tuple, rows: pa.Table) -> pa.Table:
    return _partial(key, list(zip(*(rows[c].to_pylist() for c in ("pages", "wrapper", "chars")))))


def infer_wrappers(pages: DataFrame, *, fan_in: int = 64) -> DataFrame:
    """(host, wrapper, chars) for (host, html): a wrapper and the characters each of its slots holds.

    All skeletons of a host are aligned, the most frequent first where they are up to ``fan_in``. More are
    dealt by hash to parts of about that many, whose wrappers are merged in the same way, round by
    round, until one is left.
    """
    counted = pages.mapInArrow(_counted, "host string, digest binary, slot int, skeleton string, pages bigint, chars bigint")
    sums = checkpointed(
        counted.groupBy("host", "digest", "slot").agg(F.max("skeleton").alias("skeleton"), F.sum("pages").alias("pages"), F.sum("chars").alias("chars"))
    )
    many = sums.where("slot = -1").groupBy("host").agg(F.ceil(F.count(F.lit(1)) / fan_in).alias("parts")).where("parts > 1")
    dealt = sums.join(checkpointed(many), "host", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("bigint")))
    part = F.pmod(F.xxhash64("digest"), "parts").alias("part")
    first = dealt.select("host", part, "parts", "digest", "slot", "skeleton", "pages", "chars")
    found = checkpointed(first.groupBy("host", "part", "parts").applyInArrow(_of_skeletons, _PARTIAL))
    while not (rest := found.where("parts > 1")).isEmpty():
        parts = F.ceil(F.col("parts") / fan_in)
        fewer = rest.select("host", F.pmod("part", parts).alias("part"), parts.alias("parts"), "wrapper", "chars", "pages")
        merged = fewer.groupBy("host", "part", "parts").applyInArrow(_of_partials, _PARTIAL)
        found = checkpointed(found.where("parts = 1").unionByName(merged))
    return found.select("host", "wrapper", "chars")


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *, broadcast_bytes: int = 8 << 20
) -> DataFrame:
    """(id, url, ``text``, ``n_chars``): the article of every page.

    The text has its character references decoded and white space within a block made one space;
    blocks are joined by a space in page order. A null, empty or text-less page gives an empty text. Pages
    without a host share a wrapper. Repeated rows get equal results; ties between skeletons go by
    their text. An empty table gives an empty result; other columns are not read. Wrappers are sent to all
    tasks only if they measure up to ``broadcast_bytes``, otherwise joined by host.
    """
    named = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host"))
    wrappers = infer_wrappers(named.select("host", "html"))
    size = wrappers.agg(F.sum(F.length("host") + F.length("wrapper") + 8 * F.size("chars"))).first()[0] or 0
    if size <= broadcast_bytes:
        shared = pages.sparkSession.sparkContext.broadcast({r.host: (r.wrapper, r.chars) for r in wrappers.collect()})
        joined = named
    else:
        shared, joined = None, named.join(wrappers, "host").select("id", "url", "html", "host", "wrapper", "chars")

    def read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settled: dict[tuple[str, str], set[int]] = {}
        parsed_of: dict[str, Node] = {}
        length = 0
        for batch in batches:
            found = []
            for at, (page, host) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                root, texts, skeleton = _skeleton(page or "")
                main = settled.get((host, skeleton))
                if main is None:
                    if host not in parsed_of:
                        wrapper, chars = shared.value[host] if shared else (batch.column(i)[at].as_py() for i in (4, 5))
                        length += len(wrapper)
                        if length > _PARSED:
                            parsed_of.clear()
                            length = len(wrapper)
                        parsed_of[host] = _weighed(wrapper, chars)
                    main, by_names = _placed(parsed_of[host], skeleton, _lengths(root, texts))
                    if by_names:
                        if len(settled) > 20_000:
                            settled.clear()
                        settled[host, skeleton] = main
                chosen = sorted(t for i, (slot, _) in enumerate(_walk(root)) if i in main for t in slot.texts)
                found.append(" ".join(c for t in chosen if (c := _clean(texts[t]))))
            yield pa.record_batch({
                "id": batch.column(0), "url": batch.column(1), "text": pa.array(found, pa.string()),
                "n_chars": pa.array([len(t) for t in found], pa.int64()),
            })

    kind, url_kind = dict(pages.dtypes)[id_col], dict(pages.dtypes)[url_col]
    result = joined.mapInArrow(read_pages, f"id {kind}, url {url_kind}, text string, n_chars bigint")
    return result.withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
