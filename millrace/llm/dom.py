"""Trees of HTML pages, their blocks of text, and simple tree matching, inside Spark tasks.

The parser takes any text for a page: it closes what HTML closes by itself (`p`, `li`, cells, ...), drops
what holds no text to read (scripts, styles, comments), and flattens nesting beyond `DEEPEST`.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np

DEEPEST = 150
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_TOLD = frozenset("class id role itemprop hidden aria-hidden".split())
_TELLS = re.compile("class|id|role|itemprop|hidden", re.I)
_DIGITS = re.compile(r"\d+")

#: Elements whose content is not markup, and of those the ones that hold no text to read.
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre search section summary table tbody tfoot thead tr ul caption".split()
)
CLOSES_P = BLOCK - frozenset("dd dt li option tbody tfoot thead tr caption body html".split())
#: An element that opens ends open ones of the first set that stand inside the nearest of the second.
ENDS = {
    "li": (frozenset(("li",)), frozenset("ul ol menu dir".split())),
    "dt": (frozenset("dt dd".split()), frozenset(("dl",))),
    "dd": (frozenset("dt dd".split()), frozenset(("dl",))),
    "tr": (frozenset("tr td th".split()), frozenset(("table",))),
    "td": (frozenset("td th".split()), frozenset("table tr".split())),
    "th": (frozenset("td th".split()), frozenset("table tr".split())),
    "tbody": (frozenset("thead tbody tfoot tr td th".split()), frozenset(("table",))),
    "thead": (frozenset("thead tbody tfoot tr td th".split()), frozenset(("table",))),
    "tfoot": (frozenset("thead tbody tfoot tr td th".split()), frozenset(("table",))),
    "option": (frozenset(("option",)), frozenset("select datalist".split())),
}


class Node:
    """An element: its name, hints (class, id, role, itemprop) and children, which are nodes or texts.

    `label` is what tree matching compares, `shape` names the structure below without texts, `whole` the
    structure with them, `size` counts elements.
    """

    __slots__ = ("tag", "hints", "children", "label", "shape", "whole", "size", "number", "nodes")

    def __init__(self, tag: str, hints: str = ""):
        self.tag, self.hints, self.children = tag, hints, []
        self.label = f"{tag} {_DIGITS.sub('', hints)}" if hints else tag

    @property
    def own(self) -> str:
        """The text that stands in the element itself, white space made single."""
        return " ".join(" ".join(c for c in self.children if type(c) is str).split())


def _hints(attributes: str) -> str:
    if not _TELLS.search(attributes):
        return ""
    found = ((name.lower(), a or b or c) for name, a, b, c in _ATTRIBUTE.findall(attributes))
    return " ".join(f"{name}={value.lower().strip()}" for name, value in found if name in _TOLD)


def parse(page: str) -> Node:
    """The tree of a page, below one root; character references are decoded."""
    root = Node("html")
    stack, at = [root], 0

    def text(low: int, high: int) -> None:
        if high > low:
            found = page[low:high]
            stack[-1].children.append(html.unescape(found) if "&" in found else found)

    def end(names, until=frozenset()) -> None:
        """Close the nearest open element of some names, unless one of `until` comes before it."""
        for place in range(len(stack) - 1, 0, -1):
            tag = stack[place].tag
            if tag in names:
                del stack[place:]
                return
            if tag in until:
                return

    while True:
        token = _TOKEN.search(page, at)
        if token is None:
            text(at, len(page))
            break
        text(at, token.start())
        at = token.end()
        closed, opened, attributes = token.groups()
        if closed:
            tag = closed.lower()
            # The end of an inline element counts inside its block only.
            end((tag,), frozenset() if tag in BLOCK or tag in ("td", "th") else BLOCK)
        elif opened:
            tag = opened.lower()
            if tag in CLOSES_P:
                end(("p",), frozenset(("button", "td", "th", "table", "caption")))
            if tag in ENDS:
                names, until = ENDS[tag]
                base = _last(stack, until)
                cut = next((place for place in range(base + 1, len(stack)) if stack[place].tag in names), None)
                if cut is not None:
                    del stack[cut:]
            if tag in ("html", "body"):
                continue
            node = Node(tag, _hints(attributes))
            stack[-1].children.append(node)
            if tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
                at = close.end() if close else len(page)
            elif tag not in VOID and not attributes.endswith("/") and len(stack) < DEEPEST:
                stack.append(node)
    _name(root)
    return root


def _last(stack: list[Node], names: frozenset) -> int:
    return next((place for place in range(len(stack) - 1, 0, -1) if stack[place].tag in names), 0)


def _name(root: Node) -> None:
    """Names of shapes and contents from the leaves up, and running numbers from the top down."""
    order, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        node.number = len(order)
        order.append(node)
        node.nodes = [c for c in node.children if type(c) is Node]
        waiting.extend(reversed(node.nodes))
    for node in reversed(order):
        nodes = node.nodes
        if nodes:
            node.size = 1 + sum([c.size for c in nodes])
            node.shape = hash((node.label, *[c.shape for c in nodes]))
            node.whole = hash((node.label, *[c.whole if type(c) is Node else c for c in node.children]))
        else:
            node.size, node.shape = 1, hash((node.label,))
            node.whole = hash((node.label, *node.children))


class Matcher:
    """Simple tree matching: the largest number of elements of two trees that can be paired so that names are
    equal and order and nesting are kept; among such pairings, one with many equal subtrees."""

    def __init__(self):
        self._known: dict[tuple[int, int], int] = {}

    def weight(self, a: Node, b: Node) -> int:
        """Elements paired below and with two nodes."""
        if a.label != b.label:
            return 0
        if a.shape == b.shape:
            return a.size
        key = (a.shape, b.shape)
        if key not in self._known:
            if len(self._known) > 200_000:
                self._known.clear()
            self._known[key] = 1 + (_score(self._weights(a.nodes, b.nodes)) if a.nodes and b.nodes else 0)
        return self._known[key]

    def _weights(self, some: list[Node], others: list[Node]) -> np.ndarray | list[list[int]]:
        """Weights of all pairs; in a large table each pair of shapes is looked at once."""
        if len(some) * len(others) <= _SMALL:
            return [[self.weight(x, y) if x.label == y.label else 0 for y in others] for x in some]
        one: dict[int, int] = {}
        two: dict[int, int] = {}
        first: list[Node] = []
        second: list[Node] = []
        for nodes, known, kept in ((some, one, first), (others, two, second)):
            for n in nodes:
                if n.shape not in known:
                    known[n.shape] = len(kept)
                    kept.append(n)
        table = np.array([[self.weight(x, y) for y in second] for x in first], np.int64)
        return table[np.ix_([one[n.shape] for n in some], [two[n.shape] for n in others])]

    def pairs(self, a: Node, b: Node) -> Iterator[tuple[Node, Node]]:
        """The paired nodes of two trees whose roots have one name."""
        waiting = [(a, b)]
        while waiting:
            x, y = waiting.pop()
            yield x, y
            some, others = x.nodes, y.nodes
            if x.whole == y.whole:
                waiting.extend(zip(some, others, strict=True))
                continue
            # Equal subtrees at both ends can always be paired.
            low = 0
            while low < min(len(some), len(others)) and some[low].whole == others[low].whole:
                low += 1
            high = 0
            while high < min(len(some), len(others)) - low and some[-1 - high].whole == others[-1 - high].whole:
                high += 1
            waiting.extend(zip(some[:low], others[:low], strict=True))
            if high:
                waiting.extend(zip(some[-high:], others[-high:], strict=True))
            some, others = some[low : len(some) - high], others[low : len(others) - high]
            if some and others:
                table, most = self._weights(some, others), 2 * min(len(some), len(others)) + 1
                if isinstance(table, list):
                    table = [[w * most + (x.whole == y.whole) for w, y in zip(row, others)] for row, x in zip(table, some)]
                else:
                    same = np.array([n.whole for n in some])[:, None] == np.array([n.whole for n in others])
                    table = table * most + same
                waiting.extend((some[i], others[j]) for i, j in _chosen(table))


#: Cells up to which a table is worked on without arrays, and up to which it is traced back at once; larger
#: ones are halved first.
_SMALL, _CELLS = 400, 4 << 20


def _row(before: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The next row of the table of best sums."""
    row = np.empty_like(before)
    row[0] = 0
    np.maximum(before[1:], before[:-1] + weights, out=row[1:])
    return np.maximum.accumulate(row, out=row)


def _sums(table: list[list[int]]) -> list[list[int]]:
    """The table of best sums, without arrays."""
    sums = [[0] * (len(table[0]) + 1)]
    for weights in table:
        before, here, row = sums[-1], 0, [0]
        for j, w in enumerate(weights):
            up, both = before[j + 1], before[j] + w
            here = both if both > here and both > up else up if up > here else here
            row.append(here)
        sums.append(row)
    return sums


def _score(table: np.ndarray | list[list[int]]) -> int:
    if isinstance(table, list):
        return _sums(table)[-1][-1]
    row = np.zeros(table.shape[1] + 1, np.int64)
    for weights in table:
        row = _row(row, weights)
    return int(row[-1])


def _chosen(table: np.ndarray | list[list[int]]) -> list[tuple[int, int]]:
    """Pairs in order, of positive weight and the largest sum."""
    if isinstance(table, list):
        return _traced(_sums(table))
    n, m = table.shape
    if n * m > _CELLS and n > 1:  # halve the rows, and the columns where both halves sum up best
        half = n // 2
        up, down = np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64)
        for weights in table[:half]:
            up = _row(up, weights)
        for weights in table[half:][::-1]:
            down = _row(down, weights[::-1])
        cut = int(np.argmax(up + down[::-1]))
        return _chosen(table[:half, :cut]) + [(half + i, cut + j) for i, j in _chosen(table[half:, cut:])]
    sums = np.zeros((n + 1, m + 1), np.int64)
    for i, weights in enumerate(table):
        sums[i + 1] = _row(sums[i], weights)
    return _traced(sums)


def _traced(sums: np.ndarray | list[list[int]]) -> list[tuple[int, int]]:
    found, i, j = [], len(sums) - 1, len(sums[0]) - 1
    while i and j:
        if sums[i][j] == sums[i - 1][j]:
            i -= 1
        elif sums[i][j] == sums[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            found.append((i, j))
    return found[::-1]
