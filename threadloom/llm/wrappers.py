"""Main text of web pages by wrapper induction.

All distinct layouts of a host (trees of folded elements without their texts) are aligned, tree by tree, by
simple tree matching (the largest order-keeping mapping of nodes with equal signatures) and merged into its
wrapper. Over all distinct pages of the host, each text is counted at its node of the wrapper: one that
stands on most pages that have the node is template, nodes whose text varies are slots. Each page is then
aligned with the wrapper; its content is the text of its slots inside the region that the markup marks as
main, without the regions that are navigation, forms or the like by their element. Class names decide only
where the alignment cannot: regions named as notices, comments or menus go, unless they hold the main region.
"""

from __future__ import annotations

import json
import re
from collections import OrderedDict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from threadloom.llm.dom import INLINE, RAW, Folded, Node, descendants, digest, fold, joins_parent, own_text, parse
from threadloom.llm.scratch import Scratch

#: Layouts, or wrappers merged from them, that one task merges at a time; more are merged in rounds.
MERGED_AT_ONCE = 64
#: A text is template if it stands on this share of the host's distinct pages that have its node, two at least.
CONSTANT_SHARE = 0.6
#: Inside article and main elements it stands on so many distinct pages at least: two articles may share a passage.
LEAST_IN_MAIN = 3
#: Wrappers are broadcast up to this many bytes together.
BROADCAST_BYTES = 32_000_000
#: Alignments of a layout with its host's wrapper that a worker remembers.
CACHE_LAYOUTS = 1024

# --- fixed values: elements and names of regions that are not main text -----------------------
ASIDE_TAGS = RAW | frozenset("head nav header footer aside form button select input dialog menu title".split())
ASIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|promotion|cookie|cookies|consent|gdpr"
    r"|notice|notification|alert|popup|modal|overlay|newsletter|subscribe|signup|login|comment|comments|reply|replies|disqus|sidebar|menu"
    r"|nav|navbar|navigation|breadcrumb|breadcrumbs|pagination|pager|share|sharing|social|related|recommended|footer|masthead|topbar"
    r"|search|searchbox|complementary|contentinfo)(?:$|[\s_-])")
MAIN_TAGS = ("article", "main")
# --------------------------------------------------------------------------------------------


def is_aside_tag(node: Node, inside_main: bool) -> bool:
    return node.tag in ASIDE_TAGS and not (inside_main and node.tag == "header")


def is_named_aside(node: Node) -> bool:
    return bool(node.names) and node.tag not in ("html", "body", *MAIN_TAGS) and ASIDE_NAMES.search(node.names) is not None


def is_main(node: Node, tag: str) -> bool:
    return (node.tag == tag or (tag == "main" and node.names == "main")) and not ASIDE_NAMES.search(node.names)


def holds_most(node: Node, region: Node) -> bool:
    """Whether a node holds an article or main element, and at least half of the region's text: then it is a
    layout box around the content, not a list of teasers or comments."""
    inside = any(is_main(n, tag) for n in descendants(node) if isinstance(n, Node) for tag in MAIN_TAGS)
    size = lambda top: sum(len(n) for n in descendants(top) if isinstance(n, str))
    return inside and 2 * size(node) >= size(region)


class Pattern:
    """A node of a wrapper or of a layout."""

    __slots__ = ("signature", "kids")

    def __init__(self, signature: str):
        self.signature, self.kids = signature, []


def match(pattern: Pattern, page: Folded, memo: dict) -> int:
    """Simple tree matching: the number of node pairs in the largest mapping that keeps order and ancestry."""
    if pattern.signature != page.signature:
        return 0
    todo = [(pattern, page)]
    while todo:
        a, b = todo[-1]
        if (id(a), id(b)) in memo:
            todo.pop()
            continue
        missing = [(x, y) for x in a.kids for y in b.kids if x.signature == y.signature and (id(x), id(y)) not in memo]
        if missing:
            todo += missing
        else:
            memo[id(a), id(b)] = 1 + _table(a, b, memo)[-1][-1]
    return memo[id(pattern), id(page)]


def _table(pattern: Pattern, page: Folded, memo: dict) -> list[list[int]]:
    """The best sums for the first children of both; the children's own matches are in ``memo``."""
    rows = [[0] * (len(page.kids) + 1)]
    for a in pattern.kids:
        last, row = rows[-1], [0]
        for j, b in enumerate(page.kids):
            row.append(max(row[j], last[j + 1], last[j] + memo.get((id(a), id(b)), 0)))
        rows.append(row)
    return rows


def pairs(pattern: Pattern, page: Folded, memo: dict) -> Iterator[tuple[int | None, int | None]]:
    """Children in order, as (index in pattern, index in page); None where one side has no partner."""
    match(pattern, page, memo)
    rows, i, j, back = _table(pattern, page, memo), len(pattern.kids), len(page.kids), []
    while i or j:
        gain = memo.get((id(pattern.kids[i - 1]), id(page.kids[j - 1])), 0) if i and j else 0
        if gain and rows[i][j] == rows[i - 1][j - 1] + gain:
            i, j = i - 1, j - 1
            back.append((i, j))
        elif i and rows[i][j] == rows[i - 1][j]:
            i -= 1
            back.append((i, None))
        else:
            j -= 1
            back.append((None, j))
    return reversed(back)


def absorb(pattern: Pattern, page: Folded, memo: dict) -> None:
    """Merges an aligned page into the wrapper; nodes without partner are added in place."""
    todo = [(pattern, page, memo)]
    while todo:
        pattern, page, memo = todo.pop()
        kids = []
        for i, j in pairs(pattern, page, memo):
            if j is None:
                kids.append(pattern.kids[i])
                continue
            kids.append(pattern.kids[i] if i is not None else Pattern(page.kids[j].signature))
            todo.append((kids[-1], page.kids[j], memo if i is not None else {}))
        pattern.kids = kids


def preorder(top) -> list:
    """The nodes of a tree, each before its children."""
    nodes, todo = [], [top]
    while todo:
        node = todo.pop()
        nodes.append(node)
        todo.extend(reversed(node.kids))
    return nodes


def layout_of(nodes: list) -> str:
    """A tree in text form: signature and number of children of each node, in order."""
    return json.dumps([x for node in nodes for x in (node.signature, len(node.kids))], separators=(",", ":"))


def load(layout: str) -> Pattern:
    items = json.loads(layout)
    top, open_nodes = Pattern("#page"), []
    for i in range(0, len(items), 2):
        node = Pattern(items[i]) if i else top
        if i:
            open_nodes[-1][0].kids.append(node)
            open_nodes[-1][1] -= 1
        open_nodes.append([node, items[i + 1]])
        while open_nodes and not open_nodes[-1][1]:
            open_nodes.pop()
    return top


def merge(layouts: list[str]) -> str:
    """The layouts aligned one after the other and merged."""
    wrapper = load(layouts[0])
    for layout in layouts[1:]:
        absorb(wrapper, load(layout), {})
    return layout_of(preorder(wrapper))


def align(wrapper: str, layout: str) -> list[int]:
    """For each node of the layout the number of its partner in the wrapper, or -1."""
    pattern, page = load(wrapper), load(layout)
    number = {id(node): i for i, node in enumerate(preorder(pattern))}
    partner, memo, todo = {}, {}, [(pattern, page)]
    while todo:
        a, b = todo.pop()
        partner[id(b)] = number[id(a)]
        todo += [(a.kids[i], b.kids[j]) for i, j in pairs(a, b, memo) if i is not None and j is not None]
    return [partner.get(id(node), -1) for node in preorder(page)]


def main_text(root: Node, constants: dict[int, dict[int, int]]) -> str:
    """The text of a page's content slots, blocks joined by one space.

    ``constants`` has, by id of folded node, its template texts and on how many distinct pages each stands.
    """
    mains = _mains(root)
    parts: list[str] = []
    in_main = bool(mains)
    for region in mains or [root]:
        todo: list = [(region, False)]
        while todo:
            node, template = todo.pop()
            if isinstance(node, str):
                if not template:
                    parts.append(node)
                continue
            if is_aside_tag(node, in_main) or (is_named_aside(node) and not holds_most(node, region)):
                continue
            if not joins_parent(node):
                known = constants.get(id(node.folded), {}).get(digest(own_text(node)), 0)
                template = known >= (LEAST_IN_MAIN if in_main and node.tag not in ("a", "li") else 2)
            kids = [(kid, template) for kid in reversed(node.kids)]
            todo += kids if node.tag in INLINE else [(" ", False), *kids, (" ", False)]
    return " ".join("".join(parts).split())


def _mains(root: Node) -> list[Node]:
    """Outermost article elements that are not asides, or else outermost main elements.

    Named asides and forms are searched only if there is none outside of them.
    """
    for enter in (False, True):
        for tag in MAIN_TAGS:
            found: list[Node] = []
            todo = [root]
            while todo:
                node = todo.pop()
                if node.tag == tag or (tag == "main" and node.names == "main"):
                    if is_main(node, tag):
                        found.append(node)
                elif (enter and node.tag == "form") or not (is_aside_tag(node, False) or (is_named_aside(node) and not enter)):
                    todo.extend(kid for kid in reversed(node.kids) if isinstance(kid, Node))
            if found:
                return found
    return []


def _outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        layouts, places, keys = [], [], []
        for page in batch.column("html").to_pylist():
            nodes = preorder(fold([parse(page)]))
            texts = [(i, key) for i, node in enumerate(nodes) for key in sorted({digest(t) for t in node.texts})]
            layouts.append(layout_of(nodes))
            places.append([i for i, _ in texts])
            keys.append([key for _, key in texts])
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), batch.column("page_hash"), pa.array(layouts, pa.string()), pa.array([digest(x) for x in layouts], pa.int64()),
             pa.array(places, pa.list_(pa.int32())), pa.array(keys, pa.list_(pa.int64()))],
            names=["host", "page_hash", "layout", "layout_id", "places", "keys"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        wrappers = [merge(layouts) for layouts in batch.column("layouts").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(wrappers, pa.string()), pa.array([digest(x) for x in wrappers], pa.int64())],
                                         names=["host", "layout", "layout_id"])


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes = [align(w, x) for w, x in zip(batch.column("wrapper").to_pylist(), batch.column("layout").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("layout_id"), pa.array(nodes, pa.list_(pa.int32()))],
                                         names=["host", "layout_id", "nodes"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache: OrderedDict[tuple[str, str], list[tuple[int, dict[int, int]]]] = OrderedDict()
    for batch in batches:
        texts = []
        for host, page, wrapper, nodes, keys, seen in zip(*(batch.column(c) for c in ("host", "html", "wrapper", "nodes", "keys", "seen"))):
            host, root = host.as_py(), parse(page.as_py())
            folded = preorder(fold([root]))
            at = (host, layout_of(folded))
            if at not in cache:
                known: dict[int, dict[int, int]] = {}
                for node, key, n in zip(nodes.as_py() or [], keys.as_py() or [], seen.as_py() or []):
                    known.setdefault(node, {})[key] = n
                partners = align(wrapper.as_py(), at[1]) if known else []
                cache[at] = [(i, known[node]) for i, node in enumerate(partners) if node in known]
                if len(cache) > CACHE_LAYOUTS:
                    cache.popitem(last=False)
            texts.append(main_text(root, {id(folded[i]): known for i, known in cache[at]}))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))


def merged_layouts(layouts: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, wrapper) from distinct (host, layout, layout_id), in rounds of about MERGED_AT_ONCE per task.

    Groups follow from the layouts alone, so the result does not depend on how the rows are dealt.
    """
    while True:
        sizes = layouts.groupBy("host").agg(F.count("*").alias("n")).select(F.col("host").alias("s_host"), "n")
        most = sizes.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
        if most <= 1:
            return layouts.select("host", F.col("layout").alias("wrapper"))
        bucket = F.expr(f"pmod(layout_id, cast(ceil(n / {MERGED_AT_ONCE}) as bigint))").alias("bucket")
        grouped = layouts.join(sizes, F.col("host") == F.col("s_host")).select("host", bucket, "layout").groupBy("host", "bucket").agg(
            F.sort_array(F.collect_list("layout")).alias("layouts"))
        layouts = scratch.store(grouped.select("host", "layouts").mapInArrow(_merge, "host string, layout string, layout_id long").distinct(), "merged")


def host_wrappers(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, wrapper, nodes, keys, seen): the merged layout of each host, its template texts by node, and their pages.

    ``pages`` has host, html. All distinct pages of a host count, each once; the texts themselves are not shuffled.
    """
    outlines = scratch.store(pages.select("host", F.xxhash64("html").alias("page_hash"), "html").mapInArrow(
        _outline, "host string, page_hash long, layout string, layout_id long, places array<int>, keys array<long>"), "outlines")
    layouts = scratch.store(outlines.groupBy("host", "layout_id").agg(F.min("layout").alias("layout")).select("host", "layout", "layout_id"), "layouts")
    wrappers = scratch.store(merged_layouts(layouts, scratch), "trees")
    named = wrappers.select(F.col("host").alias("w_host"), "wrapper")
    aligned = scratch.store(layouts.join(named, F.col("host") == F.col("w_host")).select("host", "layout_id", "layout", "wrapper").mapInArrow(
        _align, "host string, layout_id long, nodes array<int>"), "aligned")
    once = outlines.groupBy("host", "page_hash").agg(F.first(F.struct("layout_id", "places", "keys")).alias("page")).select("host", "page.*")
    having = outlines.select("host", "page_hash", "layout_id").distinct().groupBy("host", "layout_id").agg(F.count("*").alias("n")).join(
        aligned, ["host", "layout_id"]).select("host", "n", F.explode("nodes").alias("node")).groupBy("host", "node").agg(F.sum("n").alias("having"))
    marks = F.explode(F.arrays_zip(F.transform("places", lambda i: F.get("nodes", i)).alias("node"), F.col("keys").alias("key"))).alias("mark")
    counts = once.join(aligned, ["host", "layout_id"]).select("host", marks).select("host", F.col("mark.node").alias("node"), F.col("mark.key").alias("key"))
    counts = counts.where("node >= 0").groupBy("host", "node", "key").agg(F.count("*").alias("n")).where("n >= 2")
    constant = counts.join(having, ["host", "node"]).where(F.col("n") >= CONSTANT_SHARE * F.col("having"))
    known = constant.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("node", "key", "n"))).alias("known"))
    return wrappers.join(known, "host", "left").select("host", "wrapper", F.col("known.node").alias("nodes"), F.col("known.key").alias("keys"), F.col("known.n").alias("seen"))


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text for every row of ``pages`` (page_id, url, html; more columns are ignored).

    Null and empty pages have an empty text. Pages without a readable host share a wrapper of their own.
    """
    scratch = Scratch(pages.sparkSession, "wrappers")
    read = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).withColumn("host", host_of(F.col("url")))
    wrappers = scratch.store(host_wrappers(read, scratch), "wrappers")
    size = wrappers.agg(F.coalesce(F.sum(F.length("wrapper") + F.length("host") + 20 * F.coalesce(F.size("keys"), F.lit(0)) + 64), F.lit(0))).first()[0]
    beside = F.broadcast(wrappers) if size <= BROADCAST_BYTES else wrappers
    return read.join(beside, "host", "left").select("page_id", "url", "host", "html", "wrapper", "nodes", "keys", "seen").mapInArrow(
        _extract, "page_id long, url string, text string")
