"""HTML main text by wrapper induction (operator 4).

Each page becomes a small tree of slots: elements of one tag and class under one parent
are one slot, so a list of any length is a single node. The different trees of all pages
of a host are aligned by simple tree matching and merged into the host's wrapper, a few at
a time in rounds. Then every page of the host is aligned with it (nodes of one path of
labels, which stand side by side for pages of another order, are one node), and it is
counted in how many pages (pages equal in every slot count once) it holds the same text:
constant nodes are template, varying ones content. The content root is the innermost
container element that holds all varying text; an ``article`` or ``main`` element goes
before it.

A page's text is what its content root holds without template nodes and without elements
that by tag, class, id or role aren't the article: menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and comments. A class or id says so as a whole, not
by a word in it (``with-sidebar``), and where nothing else is left, names don't count. In a
declared article constant nodes go only behind all that varies, and headings never do.
Character references are decoded, white space inside a block becomes one space, and blocks
are joined by line feeds.

Defined cases: a null or empty page has an empty text; a URL without host belongs to the
host ''; a host of too few different pages has no template nodes; repeated pages give
equal rows; elements below a depth of ``MOST_DEPTH`` count to their ancestor there, unless
they aren't the article or begin one; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairgauge.llm.cascade import split_url
from fairgauge.llm.common import materialise

#: Depth of a tree, and different pages of a host that tell template from content.
MOST_DEPTH = 60
LEAST_PAGES = 4
#: Trees of a host that are merged at a time, on average; hosts, alignments and characters
#: of trees that a task remembers.
MERGED_TREES, HOSTS, ALIGNMENTS, TREE_CHARS = 32, 256, 1024, 1 << 24
#: Share of a host's pages that makes a text constant.
CONSTANT = 0.75

# Elements and words in class, id or role that aren't the article.
NEVER_TAGS = frozenset(
    """head title nav footer aside form button select option datalist fieldset label input textarea dialog menu noscript
    script style template iframe object embed canvas svg math audio video map""".split()
)
NEVER_WORDS = frozenset(
    """ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu
    breadcrumb breadcrumbs footer contentinfo sidebar aside complementary widget widgets cookie cookies consent gdpr
    notice notices alert alerts popup modal dialog newsletter subscribe subscription comment comments disqus reply
    replies respond social share sharing related recommended login signup signin search searchbox toolbar pagination
    pager skip""".split()
)
#: Parts of a compound name that say no more than its other parts: ``site-footer`` is a
#: footer, ``sidebar-left`` a sidebar, but ``with-sidebar`` or ``notice-period`` aren't.
PLAIN_PARTS = frozenset(
    """site page main top bottom left right box bar wrapper wrap container list block area section inner outer item items
    primary secondary global header head panel slot unit zone link links button buttons icon icons form mobile desktop""".split()
)
#: The same outside of an article only: an article's own header holds its title.
OUTER_WORDS, OUTER_TAGS = frozenset(["header", "masthead"]), frozenset(["header"])
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK_TAGS = frozenset(
    """html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol option p pre search section select summary table tbody
    td tfoot th thead tr ul""".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that may be a content root.
CONTAINER_TAGS = frozenset("html body div section article main center table tbody tr td".split())
#: Elements that a new element of the second kind ends.
CLOSES = {"p": BLOCK_TAGS - {"option"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
          "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "head": {"body"}}
CLOSED_BY = {tag: [t for t, tags in CLOSES.items() if tag in tags] for tag in frozenset().union(*CLOSES.values())}
SCOPES = frozenset("table td th ul ol dl article section div body main".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|iframe|svg|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*+)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
WORD = re.compile(r"[a-z]+")


class Slot:
    """A node of the slot tree."""

    __slots__ = ("children", "inside", "label", "number", "region", "skipped")

    def __init__(self, label: str, skipped: bool, inside: bool, region: str):
        self.label, self.skipped, self.inside, self.region = label, skipped, inside, region
        self.children: dict[str, Slot] = {}
        self.number = -1


@lru_cache(maxsize=4096)
def _says(token: str, words: frozenset[str], inside: bool) -> bool:
    """Whether a class, id or role is one of ``words``, or, outside of an article, made of
    those and plain parts."""
    parts = WORD.findall(token)
    if inside:
        return token in words
    return any(p in words for p in parts) and all(p in words or p in PLAIN_PARTS for p in parts)


def _slot(parent: Slot, tag: str, attributes: str, deep: bool, by_name: bool) -> Slot:
    """The child of ``parent`` for an element; ``parent`` itself if ``deep`` and the element
    is no different in what counts."""
    words: list[str] = []
    tokens: list[str] = []
    role = ""
    if attributes:
        for name, *values in ATTRIBUTE.findall(attributes):
            value = "".join(values).lower()
            words += WORD.findall(value)
            tokens += value.split()
            role = value if name.lower() == "role" else role
    label = " ".join([tag, *words])
    slot = parent.children.get(label)
    if slot is None:
        region = tag if tag in ("article", "main") else role if role in ("article", "main") else ""
        inside = parent.inside or bool(region)
        may = by_name and tag not in ("html", "body", "article", "main")
        named = may and any(_says(t, NEVER_WORDS, inside) for t in tokens)
        outer = not inside and (tag in OUTER_TAGS or (may and any(_says(t, OUTER_WORDS, False) for t in tokens)))
        skipped, region = parent.skipped or tag in NEVER_TAGS or named or outer, parent.region or region
        if deep and (skipped, inside, region) == (parent.skipped, parent.inside, parent.region):
            return parent
        slot = Slot(label, skipped, inside, region)
        parent.children[label] = slot
    return slot


def parse(page: str, by_name: bool = True) -> tuple[Slot, list[tuple[Slot | None, str]]]:
    """The slot tree and the page's texts in order; (None, '') stands between blocks.
    ``by_name``: classes, ids and roles tell what isn't the article, as tags do."""
    root = Slot("", False, False, "")
    stack: list[tuple[str, Slot]] = [("", root)]
    pieces: list[tuple[Slot | None, str]] = []
    opened: dict[str, list[int]] = {}  # places of each tag on the stack, and of the scopes
    scopes = [0]
    at = 0

    def close(k: int) -> None:
        while len(stack) > k:
            tag = stack.pop()[0]
            opened[tag].pop()
            if tag in SCOPES:
                scopes.pop()

    for token in TOKEN.finditer(page):
        if token.start() > at:
            pieces.append((stack[-1][1], page[at : token.start()]))
        at = token.end()
        tag = token[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in BLOCK_TAGS:
            pieces.append((None, ""))
        if token[2]:
            if opened.get(tag):
                close(opened[tag][-1])
            continue
        if tag == "br":
            pieces.append((stack[-1][1], " "))
        ended = max((opened[t][-1] for t in CLOSED_BY.get(tag, ()) if opened.get(t)), default=0)
        if ended and ended >= scopes[-1]:
            close(ended)
        if tag not in VOID_TAGS and not token[4].endswith("/"):
            opened.setdefault(tag, []).append(len(stack))
            if tag in SCOPES:
                scopes.append(len(stack))
            stack.append((tag, _slot(stack[-1][1], tag, token[4], len(stack) >= MOST_DEPTH, by_name)))
    if at < len(page):
        pieces.append((stack[-1][1], page[at:]))
    return root, pieces


def _text(parts: list[str]) -> str:
    joined = "".join(parts)
    return " ".join((html.unescape(joined) if "&" in joined else joined).split())


def blocks(pieces: list[tuple[Slot | None, str]], keeps: set[Slot] | None = None) -> Iterator[str]:
    parts: list[str] = []
    for slot, text in [*pieces, (None, "")]:
        if slot is None:
            if parts and (block := _text(parts)):
                yield block
            parts = []
        elif keeps is None or slot in keeps:
            parts.append(text)


def shape(slot: Slot) -> list:
    """A tree without texts: [label, children]."""
    return [slot.label, [shape(c) for c in slot.children.values()]]


def match(a: list, b: list) -> tuple[int, list]:
    """Simple tree matching of two trees with equal root labels: the number of matched
    nodes, and the pairs of matched children with their own matches."""
    shared = {c[0] for c in a[1]} & {c[0] for c in b[1]}  # others match nothing
    left, right = ([k for k, c in enumerate(x[1]) if c[0] in shared] for x in (a, b))
    n, m = len(left), len(right)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    inner: dict[tuple[int, int], tuple[int, list]] = {}
    for i, x in enumerate(left):
        for j, y in enumerate(right):
            most = max(best[i][j + 1], best[i + 1][j])
            if a[1][x][0] == b[1][y][0]:
                inner[i, j] = match(a[1][x], b[1][y])
                most = max(most, best[i][j] + inner[i, j][0])
            best[i + 1][j + 1] = most
    pairs, i, j = [], n, m
    while i and j:
        if (i - 1, j - 1) in inner and best[i][j] == best[i - 1][j - 1] + inner[i - 1, j - 1][0]:
            i, j = i - 1, j - 1
            pairs.append((left[i], right[j], inner[i, j][1]))
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return best[n][m] + 1, pairs[::-1]


def merge(a: list, b: list, pairs: list) -> list:
    """Both trees in one: matched nodes once, the others where they stand."""
    children, i, j = [], 0, 0
    for x, y, inner in [*pairs, (len(a[1]), len(b[1]), None)]:
        children += a[1][i:x] + b[1][j:y]
        if inner is not None:
            children.append(merge(a[1][x], b[1][y], inner))
        i, j = x + 1, y + 1
    return [a[0], children]


class Wrapper:
    """A host's merged tree; its nodes are numbered in preorder."""

    def __init__(self, tree: str):
        self.tree = json.loads(tree)
        self.sizes: list[int] = []
        #: For each node the first one of its path of labels.
        self.firsts: list[int] = []
        paths: dict[tuple[int, str], int] = {}

        def walk(node: list, parent: int) -> int:
            number = len(self.sizes)
            self.firsts.append(paths.setdefault((parent, node[0]), number))
            self.sizes.append(1)
            for child in node[1]:
                self.sizes[number] += walk(child, self.firsts[number])
            return self.sizes[number]

        walk(self.tree, -1)

    def numbers(self, tree: list) -> list[int]:
        """The wrapper's nodes that the nodes of a page's tree match, in preorder; -1 for none."""
        out: list[int] = []

        def walk(page: list, node: list | None, number: int, pairs: list) -> None:
            out.append(number if number < 0 else self.firsts[number])
            begins, matched = [], {i: (j, inner) for i, j, inner in pairs}
            after = number + 1
            for _ in node[1] if node else ():
                begins.append(after)
                after += self.sizes[after]
            for i, child in enumerate(page[1]):
                if i in matched:
                    j, inner = matched[i]
                    walk(child, node[1][j], begins[j], inner)
                else:
                    walk(child, None, -1, [])

        walk(tree, self.tree, 0, match(tree, self.tree)[1])
        return out

    def align(self, root: Slot) -> None:
        """Number the slots of a page by the nodes that they match."""
        todo, numbers = [root], iter(_numbers(self, json.dumps(shape(root))))
        while todo:
            slot = todo.pop()
            slot.number = next(numbers)
            todo += reversed(slot.children.values())


@lru_cache(maxsize=ALIGNMENTS)
def _numbers(wrapper: Wrapper, tree: str) -> list[int]:
    return wrapper.numbers(json.loads(tree))


@lru_cache(maxsize=HOSTS)
def _wrapper(tree: str) -> Wrapper:
    return Wrapper(tree)


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trees of the pages; few of them more than once."""
    seen: set[tuple[str, str]] = set()
    held = 0
    for batch in batches:
        hosts, trees = [], []
        for host, page in zip(batch.column("host"), batch.column("html"), strict=True):
            new = host.as_py(), json.dumps(shape(parse(page.as_py() or "")[0]))
            if new not in seen:
                if held > TREE_CHARS:
                    seen.clear()
                    held = 0
                seen.add(new)
                held += len(new[1])
                hosts.append(new[0])
                trees.append(new[1])
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(trees, pa.string())], names=["host", "tree"])


def _induce(group: pd.DataFrame) -> pd.DataFrame:
    tree, *others = [json.loads(t) for t in sorted(group["tree"])]
    for other in others:
        tree = merge(tree, other, match(tree, other)[1])
    return pd.DataFrame({"host": [group["host"].iloc[0]], "tree": [json.dumps(tree)]})


def _merged(trees: DataFrame) -> DataFrame:
    """host and tree: all trees of each host in one."""
    trees = materialise(trees.distinct(), "wrapper-shapes")
    while True:
        salts = F.ceil(F.count("*") / MERGED_TREES).alias("salts")
        most = trees.groupBy("host").agg(salts)
        rows = trees.join(most, "host").withColumn("salt", F.pmod(F.xxhash64("tree"), "salts"))
        merged = rows.groupBy("host", "salt").applyInPandas(_induce, "host string, tree string")
        one = (most.agg(F.max("salts")).first()[0] or 1) == 1
        trees = materialise(merged if one else merged.distinct(), "wrapper-trees")
        if one:
            return trees


def _slot_texts(pieces: list[tuple[Slot | None, str]]) -> dict[Slot, str]:
    own: dict[Slot, list[str]] = {}
    for slot, text in pieces:
        if slot is not None and not slot.skipped:
            own.setdefault(slot, []).append(text)
    return {s: t for s, parts in own.items() if (t := _text(parts))}


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each page: a hash of all its slots, and hash and length of each slot's text."""
    item = pa.struct([("node", pa.int32()), ("hash", pa.int64()), ("chars", pa.int64())])
    for batch in batches:
        pages, slots = [], []
        for page, tree in zip(batch.column("html"), batch.column("tree"), strict=True):
            root, pieces = parse(page.as_py() or "")
            _wrapper(tree.as_py()).align(root)
            texts = sorted((s.number, _hash(t.encode()), len(t)) for s, t in _slot_texts(pieces).items())
            pages.append(_hash(repr(texts).encode()))
            slots.append([{"node": k, "hash": h, "chars": n} for k, h, n in texts])
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), pa.array(pages, pa.int64()), pa.array(slots, pa.list_(item))], names=["host", "page", "slots"]
        )


def _hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def judge(wrapper: Wrapper, nodes: dict[int, tuple[int, int, int]]) -> tuple[set[int], int]:
    """Template nodes and the content root. ``nodes``: pages, pages with the commonest
    text, and characters of each wrapper node that holds text."""
    enough = max((p for p, _, _ in nodes.values()), default=0) >= LEAST_PAGES
    constant = {k for k, (p, same, _) in nodes.items() if enough and p >= LEAST_PAGES and same >= CONSTANT * p}
    if not any(k not in constant for k in nodes):
        constant = set()

    sizes, chars = wrapper.sizes, [0] * len(wrapper.sizes)
    for k, (_, _, n) in nodes.items():
        chars[k] = n * (k not in constant)
    sums = [0, *accumulate(chars)]
    chars = [sums[k + n] - sums[k] for k, n in enumerate(sizes)]

    def narrow(node: list, number: int) -> int:
        child_number = number + 1
        for child in node[1]:
            if chars[child_number] and chars[child_number] == chars[number]:
                inner = narrow(child, child_number)  # nothing that varies is left outside
                return inner if inner != child_number or child[0].split(" ")[0] in CONTAINER_TAGS else number
            child_number += sizes[child_number]
        return number

    return constant, wrapper.firsts[narrow(wrapper.tree, 0)]


def main_text(page: str, tree: str | None, template: set[int], root_number: int) -> str:
    text = _main_text(page, tree, template, root_number, True)
    # A page that has no text but in elements that their names alone rule out was named badly.
    return text or _main_text(page, None, set(), 0, False)


def _main_text(page: str, tree: str | None, template: set[int], root_number: int, by_name: bool) -> str:
    root, pieces = parse(page, by_name)
    if tree:
        _wrapper(tree).align(root)
    slots: list[tuple[Slot, bool]] = []
    todo = [(root, False)]
    while todo:
        slot, inside = todo.pop()
        inside = inside or (tree is not None and slot.number == root_number)
        slots.append((slot, inside))
        todo += [(c, inside) for c in slot.children.values()]
    usable = [(s, i) for s, i in slots if not s.skipped]
    for region in ("article", "main"):
        if any(s.region == region for s, _ in usable):
            return _region_text(pieces, {s for s, _ in usable if s.region == region}, template)
    chosen = [s for s, i in usable if i] if any(i for _, i in usable) else [s for s, _ in usable]
    return "\n".join(blocks(pieces, {s for s in chosen if s.number < 0 or s.number not in template}))


def _region_text(pieces: list[tuple[Slot | None, str]], region: set[Slot], template: set[int]) -> str:
    """The text of a declared article: what is constant on its host goes only at its end,
    behind all that varies; headings and lines between stay."""
    def constant(slot: Slot) -> bool:
        return slot.number >= 0 and slot.number in template

    varying = [k for k, (slot, text) in enumerate(pieces) if slot in region and not constant(slot) and text.strip()]
    last = varying[-1] if varying else len(pieces)
    kept = [
        (slot, text) for k, (slot, text) in enumerate(pieces)
        if slot is None or k <= last or not constant(slot) or slot.label.split(" ")[0] in HEADINGS
    ]
    return "\n".join(blocks(kept, region))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    judged: dict[str, tuple[set[int], int]] = {}
    for batch in batches:
        texts = []
        columns = (batch.column(c) for c in ("html", "host", "tree", "nodes"))
        for page, host, tree, nodes in zip(*columns, strict=True):
            host, tree = host.as_py(), tree.as_py()
            if host not in judged:
                if len(judged) >= HOSTS:
                    judged.clear()
                seen = {n["node"]: (n["pages"], n["same"], n["chars"]) for n in nodes.as_py() or []}
                judged[host] = judge(_wrapper(tree), seen) if tree else (set(), 0)
            texts.append(main_text(page.as_py() or "", tree, *judged[host]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], names=["id", "url", "text"]
        )


def induce_wrappers(pages: DataFrame) -> DataFrame:
    """host, tree and nodes (node, pages, same, chars) of each host. ``pages``: id, host, html."""
    wrappers = _merged(pages.select("host", "html").mapInArrow(_trees, "host string, tree string"))
    rows = pages.select("host", "html").join(wrappers, "host").mapInArrow(
        _statistics, "host string, page long, slots array<struct<node:int,hash:bigint,chars:bigint>>"
    )
    # Pages equal in every slot count once, whichever of them is taken.
    texts = rows.groupBy("host", "page").agg(F.first("slots").alias("slots")).select("host", F.inline("slots"))
    counts = texts.groupBy("host", "node", "hash").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))
    nodes = counts.groupBy("host", "node").agg(F.sum("n").alias("pages"), F.max("n").alias("same"), F.sum("chars").alias("chars"))
    per_host = nodes.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("node", "pages", "same", "chars"))).alias("nodes"))
    return materialise(wrappers.join(per_host, "host", "left"), "wrappers")


def extract_main_text(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """``id_col``, url, text and n_chars (code points) of each page."""
    rows = pages.select(F.col(id_col).alias("id"), "url", split_url(F.col("url"))[0].alias("host"), "html")
    wrappers = induce_wrappers(rows.select("id", "host", "html"))
    schema = rows.select("id", "url").schema.add("text", "string")
    texts = rows.join(wrappers, "host", "left").mapInArrow(_extract, schema)
    return texts.select(F.col("id").alias(id_col), "url", "text", F.length("text").cast("long").alias("n_chars"))
