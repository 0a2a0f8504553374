"""A small tolerant HTML reader: elements, text, and the folded trees that are aligned."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator
from hashlib import blake2b

# --- fixed values: names of HTML elements ----------------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math object canvas textarea".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main "
                     "nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "option": {"option"}}
# --------------------------------------------------------------------------------------------

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_NAME = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


class Node:
    """An element: ``kids`` holds elements and decoded text in page order."""

    __slots__ = ("tag", "names", "kids", "folded")

    def __init__(self, tag: str, names: str = ""):
        self.tag, self.names, self.kids, self.folded = tag, names, [], None

    @property
    def signature(self) -> str:
        return f"{self.tag}.{self.names}" if self.names else self.tag


def parse(page: str) -> Node:
    """The element tree of a page; unclosed and stray tags are repaired as browsers usually do."""
    root = Node("#page")
    stack, place = [root], 0
    opened: Counter = Counter()  # open elements by tag: a stray end tag costs no walk down the stack

    def close(depth: int) -> None:
        opened.subtract(node.tag for node in stack[depth:])
        del stack[depth:]

    while True:
        found = _MARKUP.search(page, place)
        text = page[place:found.start()] if found else page[place:]
        if text:
            stack[-1].kids.append(html.unescape(text))
        if not found:
            return root
        place = found.end()
        closing, tag, rest = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if opened[tag]:
                close(next(depth for depth in range(len(stack) - 1, 0, -1) if stack[depth].tag == tag))
            continue
        _imply_ends(stack, opened, close, tag)
        node = Node(tag, " ".join(sorted({v.lower() for m in _NAME.finditer(rest) for v in m.group(2, 3, 4) if v})))
        stack[-1].kids.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, place)
            place = end.end() if end else len(page)
        elif tag not in VOID and not rest.endswith("/"):
            stack.append(node)
            opened[tag] += 1


def _imply_ends(stack: list[Node], opened: Counter, close: Callable[[int], None], tag: str) -> None:
    if tag in CLOSES_P:
        for depth in range(len(stack) - 1 if opened["p"] else 0, 0, -1):
            if stack[depth].tag == "p":
                close(depth)
                break
            if stack[depth].tag not in INLINE:
                break
    elif tag in SIBLINGS:
        for depth in range(len(stack) - 1 if any(opened[t] for t in SIBLINGS[tag]) else 0, 0, -1):
            if stack[depth].tag in SIBLINGS[tag]:
                close(depth)
                if tag != "tr":
                    break
            elif stack[depth].tag in ("ul", "ol", "dl", "table", "tbody", "select"):
                break


def plain(text: str) -> str:
    return " ".join(text.split())


def digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def descendants(node: Node) -> Iterator[Node | str]:
    todo = list(node.kids)
    while todo:
        kid = todo.pop()
        yield kid
        if isinstance(kid, Node):
            todo += kid.kids


def joins_parent(node: Node) -> bool:
    """Inline elements but links are part of the text around them."""
    return node.tag in INLINE and node.tag != "a"


def own_text(node: Node) -> str:
    """The text that stands directly in an element, or in inline elements inside it."""
    parts, todo = [], list(reversed(node.kids))
    while todo:
        kid = todo.pop()
        if isinstance(kid, str):
            parts.append(kid)
        elif joins_parent(kid):
            todo.extend(reversed(kid.kids))
    return plain("".join(parts))


class Folded:
    """Consecutive siblings with one signature, seen as a single node of the tree that is aligned."""

    __slots__ = ("signature", "texts", "kids")

    def __init__(self, signature: str):
        self.signature, self.texts, self.kids = signature, [], []


def fold(nodes: list[Node]) -> Folded:
    """Folds siblings and, level by level, their children."""
    top = Folded(nodes[0].signature)
    todo = [(top, nodes)]
    while todo:
        folded, nodes = todo.pop()
        run: list[Node] = []
        for node in nodes:
            node.folded = folded
            text = "" if joins_parent(node) else own_text(node)
            if text:
                folded.texts.append(text)
            for kid in node.kids:
                if not isinstance(kid, Node) or kid.tag in RAW:
                    continue
                if not run or run[0].signature != kid.signature:
                    run = []
                    folded.kids.append(Folded(kid.signature))
                    todo.append((folded.kids[-1], run))
                run.append(kid)
    return top
