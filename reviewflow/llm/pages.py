"""Main text of web pages by wrapper induction.

Pages of a host are aligned as trees by simple tree matching. Nodes whose text
stays the same on nearly all pages of the host are its template; the varying
slots are content. What markup itself declares to be no article (menus,
footers, adverts, forms, comments) is left out on every page, also on those
whose host has too few pages for a wrapper.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Generator, Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.tables import saved
from reviewflow.llm.urls import host_of

# A node is template when its text is the same on this share of the host's pages, and on so many pages at least.
CONSTANT_SHARE = 0.9
LEAST_PAGES = 5
# Of an article, template nodes are removed only up to this share of its text: beyond, the pages are copies of each other.
MOST_TEMPLATE = 0.5
# Larger sibling lists get the same alignment without their whole table in memory.
CELLS = 40_000
# While pages are folded, nodes and texts on at most this share of the pages so far are forgotten. What may have been
# forgotten is added where a node is judged, so none with CONSTANT_SHARE is missed; one with less than that by this may pass.
FORGOTTEN_SHARE = 0.1
HOSTS_HELD = 2_000

BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot "
    "th thead title tr ul caption noscript template object iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section table ul".split())
SIBLINGS = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
            "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
NO_ARTICLE = frozenset(
    "head nav header footer aside form script style noscript template button select textarea svg object canvas iframe audio video "
    "dialog menu search".split())
NO_ARTICLE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo nav navbar navigation menu sidebar header masthead footer "
    "copyright cookie cookies consent gdpr notice notices banner alert popup modal newsletter subscribe subscription signup login "
    "search comment comments disqus replies reply share sharing social related recommended breadcrumb breadcrumbs pagination pager "
    "toolbar widget hidden".split())
NO_ARTICLE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<rest>(?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[A-Za-z][^\s/>]*)(?P<rest2>[^>]*+)>", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style|itemprop)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "children", "text", "out", "body", "article", "shape", "mark", "size", "pages", "missed")

    def __init__(self, tag: str, text: str | dict = "", out: bool = False, body: bool = False, article: bool = False) -> None:
        self.tag, self.text, self.out, self.body, self.article = tag, text, out, body, article
        self.children: list[Node] = []
        self.shape, self.mark, self.size = 0, 0, 1
        self.pages, self.missed = 1, 0


def _declared(tag: str, rest: str, inside_article: bool) -> tuple[bool, bool]:
    """Whether the markup says that an element is no article, or that it is the article's body."""
    out = tag in NO_ARTICLE and not (tag == "header" and inside_article)
    body = tag in ("article", "main")
    if rest and not rest.isspace():
        for name, value in _ATTRIBUTE.findall(rest):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id"):
                words = set(_WORDS.findall(_CAMEL.sub(" ", value).lower()))
                out |= tag not in ("html", "body", "article", "main") and bool(words & NO_ARTICLE_WORDS)
                out |= tag == "article" and bool(words & {"comment", "comments", "reply", "ad", "ads", "related", "promo"})
            elif name == "role":
                out |= value.lower() in NO_ARTICLE_ROLES
                body |= value.lower() in ("main", "article")
            elif name == "itemprop":
                body |= value.lower() == "articlebody"
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                out = True
            elif name == "style" and re.search(r"display\s*:\s*none", value, re.I):
                out = True
    return out, body


def parse(source: str) -> Node:
    """Tree of block elements with their text; inline elements only take part in the text.

    An inline element that is declared no article is cut out with all in it,
    up to its end tag or the end of its block, which stays one text.
    """
    root = Node("#root")
    stack, parts, opened = [root], [], Counter()
    # Place in the stack of the open element that is cut out, 0 for none.
    cut = 0

    def end_text(owner: Node | None = None) -> None:
        if cut and not owner:
            return
        owner = owner or stack[-1]
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                owner.children.append(Node("#text", text, owner.out))

    def add(text: str) -> None:
        if not cut:
            parts.append(text)

    def push(node: Node) -> None:
        stack.append(node)
        opened[node.tag] += 1

    def close_to(names, limits) -> None:
        nonlocal cut
        if not any(opened[name] for name in names):
            return
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in names:
                if depth < cut:
                    end_text(stack[cut - 1])
                if depth <= cut:
                    cut = 0
                opened.subtract(node.tag for node in stack[depth:])
                del stack[depth:]
                return
            if stack[depth].tag in limits:
                return

    place, size = 0, len(source)
    while place < size:
        match = _MARKUP.search(source, place)
        if not match:
            add(source[place:])
            break
        if match.start() > place:
            add(source[place:match.start()])
        place = match.end()
        if match["cdata"] is not None:
            add(html.escape(match["cdata"]))
            continue
        tag = (match["tag"] or match["tag2"] or "").lower()
        if not tag:
            continue
        closing = match["close"] or match["close2"]
        if closing:
            if tag in BLOCKS:
                end_text()
                close_to((tag,), ())
            elif cut:
                # Inline elements are on the stack only from the cut on.
                close_to((tag,), ())
            continue
        rest = match["rest"] or match["rest2"] or ""
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(source, place)
            place = end.end() if end else size
            if tag in BLOCKS:
                end_text()
            continue
        if tag == "br":
            add(" ")
        if tag not in BLOCKS:
            if tag in VOID or rest.endswith("/") or not (cut or tag in NO_ARTICLE or rest and _declared(tag, rest, False)[0]):
                continue
            cut = cut or len(stack)
            push(Node(tag, "", True))
            continue
        end_text()
        if tag in CLOSES_P:
            close_to(("p",), ("article", "section", "div", "td", "th", "li", "blockquote", "body", "button"))
        if tag in SIBLINGS:
            names, limits = SIBLINGS[tag]
            close_to(names.split(), limits.split())
        if cut:
            if tag not in VOID and not rest.endswith("/"):
                push(Node(tag, "", True))
            continue
        out, body = _declared(tag, rest, stack[-1].article)
        node = Node(tag, "", stack[-1].out or out, body, stack[-1].article or tag == "article")
        stack[-1].children.append(node)
        if tag not in VOID and not rest.endswith("/"):
            push(node)
    end_text(stack[cut - 1] if cut else None)
    return root


def _nodes(root: Node) -> list[Node]:
    """All nodes, parents before their children."""
    found = [root]
    for node in found:
        found += node.children
    return found


def _face(node: Node) -> str:
    """Hash of a page's text, or the most frequent one of a template."""
    if not node.text:
        return ""
    if isinstance(node.text, str):
        return _hash(node.text)
    return next(iter(node.text)) if len(node.text) == 1 else max(sorted(node.text), key=lambda text: node.text[text][0])


def shape(root: Node, known: dict) -> None:
    """Number the shapes and marks of all subtrees: equal shapes mean equal trees but for texts, equal marks with texts."""
    for node in reversed(_nodes(root)):
        shapes, marks, size = [node.tag], [node.tag, _face(node)], 1
        for child in node.children:
            shapes.append(child.shape)
            marks.append(child.mark)
            size += child.size
        node.size = size
        node.shape = known.setdefault((True, *shapes), len(known) + 1)
        node.mark = known.setdefault((False, *marks), len(known) + 1)


def _solve(call: Generator) -> object:
    """Result of a recursive function that yields its calls, so pages of any depth need no deep call stack."""
    waiting, value = [call], None
    while waiting:
        try:
            call = waiting[-1].send(value)
        except StopIteration as done:
            waiting.pop()
            value = done.value
        else:
            waiting.append(call)
            value = None
    return value


def _known_weight(a: Node, b: Node, memo: dict) -> int | None:
    if a.tag != b.tag:
        return 0
    if a.shape == b.shape:
        return a.size
    return memo.get((a.shape, b.shape))


def _weight(a: Node, b: Node, memo: dict) -> Generator:
    """Size of the best matching of two trees with one tag at the root; texts play no part."""
    total = 1
    pairs = yield _match(a.children, b.children, memo)
    for i, j in pairs:
        weight = _known_weight(a.children[i], b.children[j], memo)
        if weight is None:
            weight = yield _weight(a.children[i], b.children[j], memo)
        total += weight
    memo[a.shape, b.shape] = total
    return total


def _match(left: list[Node], right: list[Node], memo: dict) -> Generator:
    """Best order-keeping matching of two sibling lists. Equal shapes at both ends belong together in some best one."""
    start = 0
    while start < len(left) and start < len(right) and left[start].shape == right[start].shape:
        start += 1
    end = 0
    while end < min(len(left), len(right)) - start and left[-1 - end].shape == right[-1 - end].shape:
        end += 1
    pairs = [(k, k) for k in range(start)]
    rows, columns = left[start:len(left) - end], right[start:len(right) - end]
    if rows and columns:
        found = yield (_dynamic if len(rows) * len(columns) <= CELLS else _dynamic_in_blocks)(rows, columns, memo)
        pairs += [(start + i, start + j) for i, j in found]
    pairs += [(len(left) - 1 - k, len(right) - 1 - k) for k in range(end - 1, -1, -1)]
    return pairs


def _anchors(left: list[Node], right: list[Node]) -> list[tuple[int, int]]:
    """Siblings that are once in both lists with all their texts, as many as keep their order."""
    if {node.mark for node in left}.isdisjoint([node.mark for node in right]):
        return []
    if len(left) == len(right) == 1:
        return [(0, 0)]
    first, second = Counter(node.mark for node in left), Counter(node.mark for node in right)
    place = {node.mark: j for j, node in enumerate(right)}
    both = [(i, place[node.mark]) for i, node in enumerate(left) if first[node.mark] == 1 and second.get(node.mark) == 1]
    # Longest increasing run of places on the right.
    ends: list[int] = []
    chains: list[tuple] = []
    for i, j in both:
        at = bisect_left(ends, j)
        chain = ((i, j), chains[at - 1] if at else None)
        ends[at:at + 1], chains[at:at + 1] = [j], [chain]
    kept, chain = [], chains[-1] if chains else None
    while chain:
        kept.append(chain[0])
        chain = chain[1]
    return kept[::-1]


def _pairs(left: list[Node], right: list[Node], memo: dict) -> list[tuple[int, int]]:
    """Matching of two sibling lists: equal texts first, so that a constant block meets itself after bodies of any
    length, then the best matching of what lies between them."""
    pairs: list[tuple[int, int]] = []
    place = other = 0
    for i, j in [*_anchors(left, right), (len(left), len(right))]:
        if place < i and other < j:
            pairs += [(place + a, other + b) for a, b in _solve(_match(left[place:i], right[other:j], memo))]
        if i < len(left):
            pairs.append((i, j))
        place, other = i + 1, j + 1
    return pairs


def _dynamic(rows: list[Node], columns: list[Node], memo: dict) -> Generator:
    table = [[0] * (len(columns) + 1) for _ in range(len(rows) + 1)]
    for i, row in enumerate(rows):
        above, here = table[i], table[i + 1]
        for j, column in enumerate(columns):
            weight = _known_weight(row, column, memo)
            if weight is None:
                weight = yield _weight(row, column, memo)
            here[j + 1] = max(above[j] + weight, above[j + 1], here[j])
    pairs, i, j = [], len(rows), len(columns)
    while i and j:
        if table[i][j] == table[i - 1][j]:
            i -= 1
        elif table[i][j] == table[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return pairs[::-1]


def _dynamic_in_blocks(rows: list[Node], columns: list[Node], memo: dict) -> Generator:
    """The pairs that ``_dynamic`` finds, a row of its table at a time; of all rows about the root is kept, and those between
    are made again on the way back."""
    heads = {node.shape: node for node in columns}
    place = {kind: at for at, kind in enumerate(heads)}
    which = np.array([place[node.shape] for node in columns])
    gains: dict[int, np.ndarray] = {}
    for row in rows:
        if row.shape in gains:
            continue
        gain = np.zeros(len(heads), np.int32)
        for at, column in enumerate(heads.values()):
            weight = _known_weight(row, column, memo)
            if weight is None:
                weight = yield _weight(row, column, memo)
            gain[at] = weight
        gains[row.shape] = gain

    def below(above: np.ndarray, row: Node) -> np.ndarray:
        here = np.zeros_like(above)
        np.maximum.accumulate(np.maximum(above[:-1] + gains[row.shape][which], above[1:]), out=here[1:])
        return here

    step = max(1, isqrt(len(rows)))
    kept, line = [], np.zeros(len(columns) + 1, np.int32)
    for i, row in enumerate(rows):
        if i % step == 0:
            kept.append(line)
        line = below(line, row)
    pairs, j = [], len(columns)
    for block in range(len(kept) - 1, -1, -1):
        first = block * step
        table = [kept.pop()]
        for row in rows[first:first + step]:
            table.append(below(table[-1], row))
        i = len(table) - 1
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((first + i, j))
    return pairs[::-1]


def align(a: Node, b: Node, memo: dict) -> Iterator[tuple[Node, Node]]:
    """Nodes of both trees that simple tree matching puts together."""
    waiting = [(a, b)]
    while waiting:
        a, b = waiting.pop()
        if a.tag != b.tag:
            continue
        yield a, b
        waiting += [(a.children[i], b.children[j]) for i, j in _pairs(a.children, b.children, memo)]


# A template is a tree whose texts are {text hash: [pages, missed]}, each node with its pages and missed; missed is how many
# more pages there may have been before it was forgotten. On all others texts are only compared by hash. Stored, it is the
# list of its nodes from the top, each with its number of children.

def _hash(text: str) -> str:
    return f"{xxhash.xxh3_64_intdigest(text):x}"


def _template(page: Node) -> Node:
    """A page as template of itself; ``page`` is used up."""
    for node in _nodes(page):
        node.children = [child for child in node.children if not (child.out and child.tag != "#text")]
        node.text = {_hash(node.text): [1, 0]} if node.tag == "#text" else {}
    return page


def _dump(template: Node) -> str:
    rows, waiting = [], [template]
    while waiting:
        node = waiting.pop()
        rows.append([node.tag, len(node.children), node.text, node.pages, node.missed])
        waiting += reversed(node.children)
    return json.dumps(rows, separators=(",", ":"))


def _load(stored: str) -> Node:
    top = Node("")
    # Open nodes, and how many of their children are still to come.
    waiting = [[top, 1]]
    for tag, children, text, pages, missed in json.loads(stored):
        node = Node(tag, text)
        node.pages, node.missed = pages, missed
        waiting[-1][0].children.append(node)
        waiting[-1][1] -= 1
        if not waiting[-1][1]:
            waiting.pop()
        if children:
            waiting.append([node, children])
    return top.children[0]


def _forgotten(pages: int) -> int:
    """On how many of the pages something may have been that their template no longer has."""
    return int(FORGOTTEN_SHARE * pages)


def _alone(node: Node, missed: int, least: int) -> list[Node]:
    """A node that only one of two templates has; none if it is on too few pages."""
    if not missed and not least:
        return [node]
    top = Node("")
    waiting = [(node, top)]
    while waiting:
        old, parent = waiting.pop()
        if old.pages + old.missed + missed <= least:
            continue
        new = Node(old.tag, {text: [pages, gone + missed] for text, (pages, gone) in old.text.items() if pages + gone + missed > least})
        new.pages, new.missed = old.pages, old.missed + missed
        parent.children.append(new)
        waiting += [(child, new) for child in reversed(old.children)]
    return top.children


def _both(a: Node, b: Node, gone: tuple[int, int], least: int) -> Node:
    """Two matched nodes as one, without children; ``gone`` is what the template of each side may have forgotten."""
    texts = {}
    for text in [*a.text, *(text for text in b.text if text not in a.text)]:
        one, two = a.text.get(text, (0, gone[0])), b.text.get(text, (0, gone[1]))
        if one[0] + two[0] + one[1] + two[1] > least:
            texts[text] = [one[0] + two[0], one[1] + two[1]]
    node = Node(a.tag, texts)
    node.pages, node.missed = a.pages + b.pages, a.missed + b.missed
    return node


def merge_templates(a: Node, b: Node) -> Node:
    """The nodes of both templates with the pages of each, matched ones as one; both are used up."""
    known: dict = {}
    memo: dict = {}
    shape(a, known)
    shape(b, known)
    gone, least = (_forgotten(a.pages), _forgotten(b.pages)), _forgotten(a.pages + b.pages)
    merged = _both(a, b, gone, least)
    waiting = [(a, b, merged)]
    while waiting:
        a, b, node = waiting.pop()
        place = other = 0
        pairs = [(i, j) for i, j in _pairs(a.children, b.children, memo) if a.children[i].tag == b.children[j].tag]
        for i, j in [*pairs, (len(a.children), len(b.children))]:
            for child in a.children[place:i]:
                node.children += _alone(child, gone[1], least)
            for child in b.children[other:j]:
                node.children += _alone(child, gone[0], least)
            if i < len(a.children):
                child = _both(a.children[i], b.children[j], gone, least)
                if child.pages + child.missed > least:
                    node.children.append(child)
                    waiting.append((a.children[i], b.children[j], child))
            place, other = i + 1, j + 1
    return merged


def _induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A template of each host from the pages of one task; the task holds a bounded number of hosts."""
    task = TaskContext.get().partitionId()
    held: dict[str, tuple[int, Node]] = {}

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([
            pa.array(held.keys(), pa.string()), pa.array([task] * len(held), pa.int32()),
            pa.array([pages for pages, _ in held.values()], pa.int64()), pa.array([_dump(t) for _, t in held.values()], pa.string())],
            ["host", "task", "pages", "template"])
        held.clear()
        return batch

    for batch in batches:
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            template = _template(parse(source or ""))
            if host in held:
                pages, known = held[host]
                held[host] = pages + 1, merge_templates(known, template)
            else:
                if len(held) >= HOSTS_HELD:
                    yield flush()
                held[host] = 1, template
    if held:
        yield flush()


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("task")
    merged = None
    for template in group["template"]:
        merged = _load(template) if merged is None else merge_templates(merged, _load(template))
    return pd.DataFrame({
        "host": group["host"].iloc[:1], "task": group["task"].iloc[:1], "pages": [group["pages"].sum()], "template": [_dump(merged)]})


def _constants(template: Node, least: float) -> bool:
    """Keep only the constant texts, and say if there are any; nodes without one keep their place for alignment."""
    nodes = _nodes(template)
    for node in nodes:
        node.text = {text: [pages, missed] for text, (pages, missed) in node.text.items() if pages >= LEAST_PAGES and pages + missed >= least}
    return any(node.text for node in nodes)


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, wrappers = [], []
        for host, pages, template in zip(*(batch.column(name).to_pylist() for name in ("host", "pages", "template"))):
            wrapper = _load(template)
            if _constants(wrapper, CONSTANT_SHARE * pages):
                hosts.append(host)
                wrappers.append(_dump(wrapper))
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(wrappers, pa.string())], ["host", "wrapper"])


def induce_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) of the hosts with a template, from all their pages (host, html).

    Each task folds its own pages of a host into one template, and templates
    are folded in two steps, so no task holds the pages of a frequent host.
    """
    parts = pages.select("host", "html").mapInArrow(_induce, "host string, task int, pages long, template string")
    kind = "host string, task int, pages long, template string"
    some = saved(parts, "templates")
    enough = some.groupBy("host").agg(F.sum("pages").alias("all_pages")).where(F.col("all_pages") >= LEAST_PAGES).select("host")
    some = some.join(enough, "host", "left_semi")
    half = some.groupBy("host", F.pmod("task", F.lit(64)).alias("part")).applyInPandas(_merge, kind)
    return saved(half.groupBy("host").applyInPandas(_merge, kind).mapInArrow(_close, "host string, wrapper string"), "wrappers")


def _blocks(node: Node) -> list[Node]:
    found, waiting = [], [node]
    while waiting:
        node = waiting.pop()
        if node.out:
            continue
        if node.tag == "#text":
            found.append(node)
        else:
            waiting += reversed(node.children)
    return found


def _bodies(root: Node) -> list[Node]:
    """The outermost elements declared to be an article, else those declared to be the main part."""
    found, waiting = {"article": [], "other": []}, [root]
    while waiting:
        node = waiting.pop()
        if node.out:
            continue
        if node.body:
            found["article" if node.tag == "article" else "other"].append(node)
            if node.tag == "article":
                continue
        waiting += reversed(node.children)
    return found["article"] or found["other"][:1]


def main_text(source: str, wrapper: Node | None) -> str:
    """Text of the article of one page, blocks on lines."""
    root = parse(source)
    bodies = _bodies(root)
    blocks = [block for body in bodies or [root] for block in _blocks(body)]
    if wrapper is not None:
        known: dict = {}
        shape(root, known)
        shape(wrapper, known)
        constant = {id(mine) for mine, fixed in align(root, wrapper, {}) if mine.tag == "#text" and _hash(mine.text) in fixed.text}
        slots = [block for block in blocks if id(block) not in constant]
        total = sum(len(block.text) for block in blocks)
        if not bodies or sum(len(block.text) for block in slots) >= (1 - MOST_TEMPLATE) * total:
            blocks = slots
    return "\n".join(block.text for block in blocks)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, tree = None, None
    for batch in batches:
        texts = []
        for source, wrapper in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist()):
            if wrapper != last:
                last, tree = wrapper, wrapper and _load(wrapper)
            texts.append(main_text(source or "", tree))
        text = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), text, pc.utf8_length(text).cast(pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract_articles(pages: DataFrame) -> DataFrame:
    """Main text of each page.

    Takes page_id, url and html. Returns one row per row: page_id, url, text
    (blocks in page order, joined by a line break; white space inside a block
    is one blank), n_chars. All outermost article elements of a page count. A
    null html, or one without article text, gives an empty text; a page may be
    of any length and depth. Other columns, whatever their names, are not looked
    at. Pages without a host (null urls too) share a host named by the
    empty string. Repeated rows are extracted alike. No rows give no rows.
    """
    pages = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    wrappers = induce_wrappers(pages)
    return pages.join(wrappers, "host", "left").select("page_id", "url", "html", "wrapper").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long")
