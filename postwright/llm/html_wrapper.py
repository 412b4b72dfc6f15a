"""Main text of web pages by wrapper induction.

Pages of a host are parsed to trees and aligned, by simple tree matching, with
a few pivot pages of the same host.  A node whose text is the same in most of
the pages aligned with it is part of the host's template; nodes whose text
varies are slots.  The article is read from the slots: what HTML marks as
furniture (menus, headers, footers, sidebars, forms, scripts and the like, by
element, role or class name) is left out, and where a page has ``article`` or
``main`` elements, only these are read.

A text inside the article counts as template only where the whole host has it
in the same place: it must be the same in ``MIN_SAME`` of the pages aligned,
and these must be at least ``MIN_PAGES`` pages with different articles.

Cases: null, empty and text-free pages give an empty text; broken markup is
repaired (open elements are closed at the end, stray end tags ignored); plain
text is one block; pages without a URL form a host of their own; hosts of few
pages have no template; repeated rows are extracted each, and identical pages
count once in the alignment; very long and very deep pages are read whole, with
explicit stacks; an empty table gives an empty one; extra columns are not read.

One pass reduces each page to a light tree (tags, depths, hashes of texts),
which is staged.  Pivots are the pages of least hash, found by a partial
minimum.  Trees meet their pivots, and pages their host's template, by a
broadcast when the small side is small, else by a shuffle join on the host in
which adaptive execution splits hot hosts.  Counts of equal nodes are summed
before the exchange.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postwright.llm.common import map_rows, small_side, stage, with_fields

#: Pivot pages per host.
PIVOTS = 3
#: Share of the aligned pages in which a template node has the same text, and their least number.
MIN_SAME = 0.8
MIN_PAGES = 4

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
#: Elements that never belong to an article.
FURNITURE = frozenset(
    "head script style noscript template iframe object embed svg math canvas audio video nav "
    "header footer aside form button select option textarea input label fieldset dialog menu "
    "title xmp noembed noframes map datalist progress meter".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu "
    "menubar toolbar status note".split()
)
#: Words in class names and ids that mark furniture.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adbox adslot banner breadcrumb breadcrumbs "
    "byline comment comments commentlist comentarios kommentare commentaires consent cookie "
    "cookies disqus footer footnav header masthead menu menubar modal nav navbar navigation "
    "newsletter notice notices notification outbrain overlay pagination paging pager popup "
    "promo promoted promotion recommended related replies reply responses respond rail share "
    "sharing sidebar sidemenu sitemap skip social sponsor sponsored subscribe subscription "
    "taboola tags toolbar topbar widget widgets alert disclaimer gdpr login signup search".split()
)
#: Elements that separate blocks of text.
BLOCKS = frozenset(
    "address article blockquote body caption center dd details dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol "
    "optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that an opening tag closes, when open in the same container.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
    "body": {"head"},
}
#: A closing search does not look beyond these.
SCOPE = frozenset("table ul ol dl div article section main body html select td th".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|$)",
    re.S,
)
ATTRIBUTE = re.compile(r"(?:^|[\s\"'])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
NAME_PARTS = re.compile(r"[a-z]+|[0-9]+")
SPACE = re.compile(r"[ \t\n\r\f\v\xa0 -     　 \x85]+")


class Node:
    """An element or a text (tag ``#``)."""

    __slots__ = ("tag", "attributes", "children", "text", "number")

    def __init__(self, tag: str, attributes: str = "", text: str = "") -> None:
        self.tag, self.attributes, self.text = tag, attributes, text
        self.children: list[Node] = []
        self.number = 0


def parse(page: str) -> Node:
    """The tree of a page, forgiving about its markup."""
    root = Node("#root")
    stack = [root]
    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        if start < 0:
            start = size
        match = TOKEN.match(page, start) if start < size else None
        while start < size and match is None:  # a lone < is text
            start = page.find("<", start + 1)
            if start < 0:
                start = size
                break
            match = TOKEN.match(page, start)
        if start > at:
            stack[-1].children.append(Node("#", text=page[at:start]))
        if match is None:
            break
        at = match.end()
        if match[0].startswith("<![CDATA["):
            stack[-1].children.append(Node("#", text=match[0][9:].removesuffix("]]>")))
        if not match[2]:
            continue
        tag = match[2].lower()
        if match[1]:
            _close(stack, tag)
            continue
        _imply(stack, tag)
        node = Node(tag, match[3] or "")
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(f"</{tag}\\b[^>]*(?:>|$)", re.I).search(page, at)
            stop = end.start() if end else size
            node.children.append(Node("#", text=page[at:stop]))
            at = end.end() if end else size
        elif tag not in VOID and not (match[3] or "").rstrip().endswith("/"):
            stack.append(node)
        elif tag not in VOID and tag in BLOCKS:
            stack.append(node)  # the slash means nothing on such elements
    for number, node in enumerate(walk(root)):
        node.number = number
    return root


def _close(stack: list[Node], tag: str) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag == tag:
            del stack[k:]
            return
        # an inline end tag does not close the blocks around it
        if tag not in BLOCKS and stack[k].tag in SCOPE:
            return


#: Inline elements that stay open across paragraphs are ended by a block start.
_FORMAT = frozenset(
    "b i em strong u s a font small big tt code span strike q sub sup mark abbr cite p".split()
)


def _imply(stack: list[Node], tag: str) -> None:
    """Close what the start of an element ends by the rules of HTML."""
    if tag in BLOCKS:
        # a block ends an open paragraph of the same container, with what is open in it
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == "p":
                del stack[k:]
                break
            if stack[k].tag not in _FORMAT:
                break
    ends = CLOSES.get(tag)
    if ends:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in ends:
                del stack[k:]
                break
            if stack[k].tag in SCOPE and not (tag in ("tr", "tbody", "tfoot") and
                                             stack[k].tag in ("td", "th")):
                break


def walk(root: Node) -> Iterator[Node]:
    """All nodes, parents before children, in page order."""
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(reversed(node.children))


def is_furniture(node: Node) -> bool:
    """Whether the element, its role, class or id says that it is not part of an article."""
    if node.tag in FURNITURE:
        return True
    if not node.attributes or node.tag in ("body", "html", "article", "main", "#root"):
        return False
    for name, value in ATTRIBUTE.findall(node.attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value in ROLES:
            return True
        if name in ("class", "id") and any(w in NAMES for w in NAME_PARTS.findall(value)):
            return True
    return False


def slots(root: Node) -> list[Node]:
    """Roots of what can be article: article or main elements, else the page."""
    found = _tops(root, ("article",)) or _tops(root, ("main",))
    if found:
        return found
    return [root]


def _tops(root: Node, tags: tuple[str, ...]) -> list[Node]:
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.tag in tags:
            out.append(node)
        elif not is_furniture(node):
            stack.extend(reversed(node.children))
    return out


def normal(text: str) -> str:
    return SPACE.sub(" ", entities.unescape(text)).strip(" ")


def blocks(root: Node, template: set[int] = frozenset()) -> list[str]:
    """Blocks of the article, without nodes of the template (keys as in ``node_keys``)."""
    dropped = _dropped(root, template) if template else frozenset()
    out: list[str] = []
    parts: list[str] = []

    def end() -> None:
        block = SPACE.sub(" ", "".join(parts)).strip(" ")
        if block:
            out.append(block)
        parts.clear()

    for top in slots(root):
        end()
        stack: list[Node | None] = [top]
        while stack:
            node = stack.pop()
            if node is None:
                end()
                continue
            if node.tag == "#":
                if node.number not in dropped:
                    parts.append(entities.unescape(node.text))
                continue
            if node.tag == "br":
                parts.append("\n")
                continue
            if node is not top and is_furniture(node):
                if node.tag in BLOCKS:
                    end()
                continue
            if node.tag in BLOCKS or node.tag == "#root":
                end()
                stack.append(None)
            stack.extend(reversed(node.children))
    end()
    return out


# ------------------------------------------------------------------ alignment


class Tree:
    """A light tree: hash of tag and depth per node, hash of the text below each text's path."""

    __slots__ = ("tags", "texts", "children", "key")

    def __init__(self, tags: np.ndarray, depths: np.ndarray, texts: np.ndarray) -> None:
        self.tags, self.texts = tags, texts
        self.children: list[list[int]] = [[] for _ in range(len(tags))]
        path: list[int] = []
        for number, depth in enumerate(depths.tolist()):
            del path[depth:]
            if path:
                self.children[path[-1]].append(number)
            path.append(number)

    def shapes(self, seen: dict) -> list[int]:
        """A number for the shape of each subtree; equal shapes have equal numbers."""
        out = [0] * len(self.tags)
        tags = self.tags.tolist()
        for number in range(len(out) - 1, -1, -1):
            form = (tags[number], *[out[c] for c in self.children[number]])
            out[number] = seen.setdefault(form, len(seen))
        return out


def light(root: Node) -> tuple[bytes, bytes, bytes, int]:
    """Tags (32-bit hashes), depths and text hashes (64 bit, 0 for none) of the nodes in order.

    Furniture is left out: it is dropped whether it repeats or not.  Also a hash
    of all texts, by which identical pages are known.
    """
    tags, depths, texts = [], [], []
    whole = xxhash.xxh3_64()
    numbers: list[int] = []
    stack = [(root, 0)]
    while stack:
        node, depth = stack.pop()
        if node.tag == "#":
            text = normal(node.text)
            if not text:
                continue
            value = xxhash.xxh3_64_intdigest(text) or 1
            whole.update(text + "\n")
        elif node.tag != "#root" and is_furniture(node):
            continue
        else:
            value = 0
        tags.append(xxhash.xxh32_intdigest(node.tag))
        depths.append(depth)
        texts.append(value)
        numbers.append(node.number)
        stack.extend((c, depth + 1) for c in reversed(node.children))
    return (
        np.array(tags, dtype="<u4").tobytes(), np.array(depths, dtype="<u4").tobytes(),
        np.array(texts, dtype="<u8").tobytes(), whole.intdigest() >> 1,
    )


def match(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """Pairs of nodes of a largest alignment of two trees that keeps order and parents.

    The recursion of simple tree matching: the value of two nodes with equal
    tags is 1 plus the best sum over their child lists in order.  Value and
    alignment follow from the shapes, so each pair of shapes is aligned once,
    however many nodes have them.  Equal shapes are aligned node by node without
    a table.
    """
    if not len(a.tags) or not len(b.tags) or a.tags[0] != b.tags[0]:
        return []
    seen: dict = {}
    shape_a, shape_b = a.shapes(seen), b.shapes(seen)
    size_a, tags_a, tags_b = _sizes(a), a.tags.tolist(), b.tags.tolist()
    values: dict[tuple[int, int], int] = {}
    choices: dict[tuple[int, int], list[tuple[int, int]]] = {}

    # pairs of different shapes that can be reached from the roots, by nodes that have them
    pairs, todo = {}, [(0, 0)]
    while todo:
        x, y = todo.pop()
        shapes = shape_a[x], shape_b[y]
        if shapes[0] == shapes[1] or shapes in pairs:
            continue
        pairs[shapes] = x, y
        left = {shape_a[p]: p for p in a.children[x]}.values()
        right = {shape_b[q]: q for q in b.children[y]}.values()
        todo.extend((p, q) for p in left for q in right if tags_a[p] == tags_b[q])
    # children before parents
    for shapes, (x, y) in sorted(pairs.items(), key=lambda pair: size_a[pair[1][0]]):
        left, right = [shape_a[p] for p in a.children[x]], [shape_b[q] for q in b.children[y]]
        sizes = {shape_a[p]: size_a[p] for p in a.children[x]}

        @lru_cache(maxsize=256)
        def gains(of: int, sizes: dict = sizes, right: list = right) -> np.ndarray:
            return np.array([sizes[of] if of == q else values.get((of, q), 0) for q in right])

        best, choices[shapes] = aligned(lambda i: gains(left[i]), len(left), len(right))  # noqa: B023
        values[shapes] = 1 + best
    out, todo = [], [(0, 0)]
    while todo:
        x, y = todo.pop()
        out.append((x, y))
        left, right = a.children[x], b.children[y]
        if shape_a[x] == shape_b[y]:
            todo.extend(zip(left, right, strict=True))
        else:
            todo.extend((left[i], right[k]) for i, k in choices[shape_a[x], shape_b[y]])
    return out


def aligned(
    gains: Callable[[int], np.ndarray], n: int, width: int
) -> tuple[int, list[tuple[int, int]]]:
    """The largest sum of gains of pairs of two lists in order, and its pairs, last first.

    ``gains`` gives those of an element of the first list with all of the second.
    Of the table's rows only every so-manieth is kept; those between are made
    again on the way back.
    """
    step = max(1, math.isqrt(n))

    def after(above: np.ndarray, row: np.ndarray) -> np.ndarray:
        here = np.zeros_like(above)
        np.maximum.accumulate(np.maximum(above[1:], above[:-1] + row), out=here[1:])
        return here

    kept, row = [np.zeros(width + 1, dtype=np.int64)], np.zeros(width + 1, dtype=np.int64)
    for i in range(n):
        row = after(row, gains(i))
        if (i + 1) % step == 0:
            kept.append(row)
    chosen, i, k = [], n, width
    while i and k:
        low = (i - 1) // step * step
        rows = [kept[low // step]]
        for j in range(low, i):
            rows.append(after(rows[-1], gains(j)))
        lists = [r.tolist() for r in rows]
        while i > low and k:
            here, above = lists[i - low], lists[i - low - 1]
            if here[k] == above[k]:
                i -= 1
            elif here[k] == here[k - 1]:
                k -= 1
            else:
                i, k = i - 1, k - 1
                chosen.append((i, k))
    return int(row[-1]), chosen


def _sizes(tree: Tree) -> list[int]:
    out = [1] * len(tree.tags)
    for number in range(len(out) - 1, -1, -1):
        for child in tree.children[number]:
            out[number] += out[child]
    return out


def node_keys(tree: Tree) -> np.ndarray:
    """For each text node: hash of its path of tags and its text; 0 for elements."""
    paths = np.zeros(len(tree.tags), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for number, children in enumerate(tree.children):
            for child in children:
                paths[child] = paths[number] * np.uint64(0x100000001B3) + np.uint64(
                    tree.tags[child]
                )
        keys = (paths ^ (tree.texts * np.uint64(0x9E3779B97F4A7C15))) | np.uint64(1)
    return np.where(tree.texts > 0, keys, np.uint64(0)).astype(np.int64)


def _tree(row: tuple[bytes, bytes, bytes]) -> Tree:
    return Tree(
        np.frombuffer(row[0], "<u4"), np.frombuffer(row[1], "<u4"), np.frombuffer(row[2], "<u8")
    )


def _dropped(root: Node, template: set[int]) -> set[int]:
    """Numbers of the text nodes whose keys are in the template."""
    numbers: list[int] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if node.tag == "#" and not normal(node.text):
            continue
        if node.tag not in ("#", "#root") and is_furniture(node):
            continue
        numbers.append(node.number)
        stack.extend(reversed(node.children))
    keys = node_keys(_tree(light(root)[:3]))
    return {n for n, k in zip(numbers, keys.tolist(), strict=True) if k in template}


# ------------------------------------------------------------------ the operator


def host_of(url: F.Column) -> F.Column:
    """Lower-cased host of a URL; empty without one."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


TREES = "tags binary, depths binary, texts binary, whole bigint"


def induce(trees: DataFrame) -> DataFrame:
    """(host, template): the keys of the template nodes of each host.

    ``trees`` has one row per different page of a host.  Each is aligned with
    the pivots of its host; a node of a pivot is counted for each page that has
    a node aligned with it, and again where the text is the same.
    """
    slot = F.pmod("whole", F.lit(PIVOTS))
    pivots = stage(
        trees.groupBy("host", slot.alias("slot"))
        .agg(F.min(F.struct(F.xxhash64("whole").alias("order"), "tags", "depths", "texts",
                            "whole")).alias("p"))
        .groupBy("host")
        .agg(F.collect_list(F.struct("p.tags", "p.depths", "p.texts", "p.whole")).alias("pivots")),
        "pivots",
    )
    weight = F.expr("aggregate(pivots, 64L, (n, p) -> n + octet_length(p.tags) * 4L)")
    paired = trees.join(small_side(pivots, weight), "host").select(
        "host", "tags", "depths", "texts", "whole", "pivots"
    )
    schema = T.StructType.fromDDL("host string, key bigint, aligned bigint, same bigint")

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        held: dict[tuple, Tree] = {}
        for batch in batches:
            counts: dict[tuple[str, int], list[int]] = {}
            for row in batch.to_pylist():
                own = _tree((row["tags"], row["depths"], row["texts"]))
                once: dict[int, int] = {}
                for pivot in row["pivots"]:
                    if pivot["whole"] == row["whole"]:
                        continue
                    name = (row["host"], pivot["whole"])
                    if name not in held:
                        if len(held) > 500:
                            held.clear()
                        tree = _tree((pivot["tags"], pivot["depths"], pivot["texts"]))
                        held[name] = tree, node_keys(tree)
                    tree, keys = held[name]
                    for x, y in match(tree, own):
                        if keys[x]:
                            same = int(tree.texts[x] == own.texts[y])
                            key = int(keys[x])
                            once[key] = max(once.get(key, 0), same)
                for key, same in once.items():
                    total = counts.setdefault((row["host"], key), [0, 0])
                    total[0] += 1
                    total[1] += same
            yield pa.RecordBatch.from_pydict(
                {
                    "host": [h for h, _ in counts], "key": [k for _, k in counts],
                    "aligned": [v[0] for v in counts.values()],
                    "same": [v[1] for v in counts.values()],
                },
                schema=target,
            )

    counted = paired.mapInArrow(run, schema).groupBy("host", "key").agg(
        F.sum("aligned").alias("aligned"), F.sum("same").alias("same")
    )
    totals = trees.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    # the pivot has the text too
    constant = counted.join(totals, "host").filter(
        (F.col("same") + 1 >= MIN_SAME * F.col("pages")) & (F.col("same") + 1 >= MIN_PAGES)
    )
    return constant.groupBy("host").agg(F.collect_set("key").alias("template"))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url",
            html: str = "html") -> DataFrame:
    """(key, url, text, n_chars, n_blocks) of each page."""
    source = pages.select(
        key, F.col(url).alias("url"), F.col(html).alias("_html"), host_of(F.col(url)).alias("host")
    )

    def make_trees():
        def work(batch: pa.RecordBatch) -> dict:
            found = [light(parse(t or "")) for t in batch.column(0).to_pylist()]
            return {"host": batch.column(1)} | {
                name: [x[k] for x in found]
                for k, name in enumerate(("tags", "depths", "texts", "whole"))
            }

        return work

    light_pages = source.select("_html", "host")
    trees = stage(
        map_rows(light_pages, with_fields(light_pages, ["host"], TREES), make_trees),
        "trees",
    )
    distinct = stage(
        trees.groupBy("host", "whole").agg(
            F.first("tags").alias("tags"), F.first("depths").alias("depths"),
            F.first("texts").alias("texts"),
        ),
        "different",
    )
    template = stage(induce(distinct), "template")
    joined = source.join(small_side(template, F.size("template") * 8 + 64), "host", "left").select(
        key, "url", "_html", "template"
    )
    schema = with_fields(joined, [key, "url"], "text string, n_chars bigint, n_blocks bigint")

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            templates = batch.column(3).to_pylist()
            found = [
                blocks(parse(t or ""), set(x or ()))
                for t, x in zip(batch.column(2).to_pylist(), templates, strict=True)
            ]
            text = ["\n".join(x) for x in found]
            return {
                key: batch.column(0), "url": batch.column(1), "text": text,
                "n_chars": [len(t) for t in text], "n_blocks": [len(x) for x in found],
            }

        return work

    return map_rows(joined, schema, make)
