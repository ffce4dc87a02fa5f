"""Main text of web pages by wrapper induction.

Every page is reduced to its outline, the tree of its block elements in which like neighbours are one. A host's outlines
are clustered by simple tree matching (the largest set of nodes that match in order under matching parents): the most
frequent outline is a reference, outlines that match it in most of their nodes are aligned with it, and what is left is
clustered in the same way, until nothing is left. So the blocks of all pages of a layout fall into the slots of one tree.
A block that stands in its slot in nearly all articles of the layout that have the slot is template, and goes from that
slot; elsewhere the same words stay. Pages that carry the same article count once for this, so copies of an article are no
template. What varies is content.

Some of what is no article varies too (menus, adverts). Tags, roles and names tell these, and the article elements where
there are any; where there are none, the varying blocks of the body are taken. A name tells only if all its words do:
`share-buttons` does, `share-of-vote` does not.

Trees are walked with stacks of our own, so pages may be nested as deeply as they like.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import stage
from wardlight.llm.url_rules import host

#: A block is template if at least this share of the articles that have its slot has it there, of this many at least.
TEMPLATE_SHARE, TEMPLATE_ARTICLES = 0.9, 8
#: Outlines of one layout match in at least this share of their nodes.
ALIKE = 0.6

MARKUP = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes noscript".split())
BLOCK = frozenset("""html head body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot
    tr td th caption blockquote pre figure figcaption nav aside header footer form fieldset address details summary hr
    hgroup center menu dialog template""".split())
#: An element that starts ends an open one of these, up to the named ancestors.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"}), "body": ({"head"}, set())}
CLOSES_P = BLOCK - {"html", "head", "body", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "template"}
NO_TEXT = frozenset("""head script style noscript template nav aside footer form button select textarea iframe object svg
    canvas video audio dialog menu title xmp noembed noframes datalist map math""".split())
NO_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words of class names and ids that mark what is no article.
NO_CLASS = frozenset("""ad ads advert adverts advertisement advertising adsbygoogle adbox adslot sponsor sponsored sponsors
    promo promoted promotion banner cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe
    subscription signup sidebar widget widgets nav navbar navigation navi menu menus breadcrumb breadcrumbs footer share
    sharing social related recommended recommendations comment comments disqus respond reply replies pagination pager
    toolbar login paywall alert toc hidden""".split())
#: Words that may stand beside them in such a name and tell nothing.
NO_WORD = frozenset("""area articles bar block box btn button buttons container content group header heading icons inner
    item items js left link links list outer panel posts right section slot small text title top wrap wrapper unit""".split())
COMMENTS = frozenset("comment comments reply replies disqus respond".split())
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []


def parse(page: str) -> Node:
    """The tree of a page: nodes and strings with character references decoded. Unclosed and stray tags are allowed."""
    root = Node("")
    stack, at = [root], 0

    def text(upto: int) -> None:
        if upto > at:
            stack[-1].children.append(html.unescape(page[at:upto]))
    while True:
        m = MARKUP.search(page, at)
        if m is None:
            text(len(page))
            return root
        text(m.start())
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in CLOSES_P:
            _close(stack, {"p"}, {"td", "th", "button", "object", "caption"})
        if tag in CLOSES:
            _close(stack, *CLOSES[tag])
        node = Node(tag, m[3])
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = len(page) if end is None else end.end()
        elif tag not in VOID and not (m[3].endswith("/") and tag not in BLOCK):
            stack.append(node)


def _close(stack: list[Node], tags: set, within: set) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in tags:
            del stack[k:]
            return
        if stack[k].tag in within:
            return


@lru_cache(100_000)
def _names(attributes: str) -> tuple[frozenset, str, bool]:
    """Words, in lower case, of each class name and of the id; the role; and whether the element is hidden."""
    found = {name.lower(): a or b or c or "" for name, a, b, c in ATTRIBUTE.findall(attributes)}
    names = frozenset(frozenset(w.lower() for w in NAME.findall(name)) for name in (found.get("class", "") + " " + found.get("id", "")).split())
    style = found.get("style", "").replace(" ", "").lower()
    return (names, found.get("role", "").lower(), "hidden" in found or found.get("aria-hidden") == "true"
            or "display:none" in style or "visibility:hidden" in style)


def _apart(node: Node, inside: bool) -> bool:
    """Whether an element is no part of the article; `inside`: it stands in the article element."""
    if node.tag in NO_TEXT or node.tag == "header" and not inside:
        return True
    if not node.attributes.strip() or node.tag in ("", "html", "body"):
        return False
    names, role, hidden = _names(node.attributes)
    if hidden or role in NO_ROLE:
        return True
    told = COMMENTS if node.tag in ("article", "main") else NO_CLASS
    return any(name & told and name <= told | NO_WORD for name in names) or not inside and frozenset({"header"}) in names


TEXT, OVER, INTO, END = range(4)


def _walk(root: Node, enter) -> Iterator[tuple]:
    """What is below a node in page order: (string, TEXT), (node, INTO) and later (node, END), or (node, OVER) where
    `enter` says not to go in."""
    stack = [(root, iter(root.children))]
    while stack:
        for child in stack[-1][1]:
            if isinstance(child, str):
                yield child, TEXT
            elif enter(child):
                yield child, INTO
                stack.append((child, iter(child.children)))
                break
            else:
                yield child, OVER
        else:
            node, _ = stack.pop()
            if stack:
                yield node, END


def _is_article(node: Node) -> bool:
    return node.tag == "article" or _names(node.attributes)[1] == "article" or "articleBody" in node.attributes


def _articles(root: Node) -> list[Node]:
    """The outermost article elements that are no comments and stand in nothing that is set apart."""
    return [n for n, state in _walk(root, lambda n: not _apart(n, False) and not _is_article(n))
            if state == OVER and not _apart(n, False)]


def _main(root: Node) -> Node | None:
    for node, state in _walk(root, lambda n: not _apart(n, False)):
        if state == INTO and (node.tag == "main" or _names(node.attributes)[1] == "main"):
            return node
    return None


def _blocks(root: Node, inside: bool) -> list[tuple[str, Node]]:
    """The blocks below an element that are not set apart, each with the innermost block element around it."""
    held: list[str] = []
    out: list[tuple[str, Node]] = []
    around = [root]

    def flush() -> None:
        block = " ".join("".join(held).split())
        held.clear()
        if block:
            out.append((block, around[-1]))
    for item, state in _walk(root, lambda n: not _apart(n, inside)):
        if state == TEXT:
            held.append(item)
        elif item.tag not in BLOCK:
            if item.tag == "br" and state == INTO:
                held.append(" ")
        else:
            flush()
            if state == INTO:
                around.append(item)
            elif state == END:
                around.pop()
    flush()
    return out


def article(root: Node) -> list[tuple[str, Node]]:
    """The blocks of the article in page order, before any template is taken out; of all articles where there are several."""
    found = _articles(root)
    if found:
        return [block for node in found for block in _blocks(node, True)]
    main = _main(root)
    return _blocks(main or root, main is not None)


# -- outlines and their alignment

class Slot:
    """A node of an outline: the block elements that became it, their blocks, and what is below."""
    __slots__ = ("label", "children", "blocks", "shape", "joined", "number")

    def __init__(self, label: str):
        self.label, self.children, self.blocks, self.shape, self.joined, self.number = label, [], [], 0, None, 0


class Outline:
    """Of a page: block elements only; a neighbour of the same outline joins the one before it."""

    def __init__(self, root: Node):
        self.slot_of: dict[int, Slot] = {}
        shapes: dict[tuple, int] = {}
        self.root = Slot("page")
        self.slot_of[id(root)] = self.root
        open_, held = [self.root], []

        def flush() -> None:
            block = " ".join("".join(held).split())
            held.clear()
            if block:
                open_[-1].blocks.append(block)

        def close(slot: Slot) -> None:
            slot.shape = shapes.setdefault((slot.label, *[c.shape for c in slot.children]), len(shapes))
        for item, state in _walk(root, lambda n: True):
            if state == TEXT:
                held.append(item)
            elif item.tag not in BLOCK:
                if item.tag == "br" and state == INTO:
                    held.append(" ")
            elif state == INTO:
                flush()
                slot = self.slot_of[id(item)] = Slot(item.tag)
                open_.append(slot)
            else:
                flush()
                slot = open_.pop()
                close(slot)
                beside = open_[-1].children
                if beside and beside[-1].shape == slot.shape:
                    self._join(beside[-1], slot)
                else:
                    beside.append(slot)
        flush()
        self.slots: list[Slot] = []
        words: list[str] = []
        todo: list = [self.root]
        while todo:
            slot = todo.pop()
            if isinstance(slot, str):
                words.append(slot)
                continue
            slot.number = len(self.slots)
            self.slots.append(slot)
            words.append(slot.label)
            if slot.children:
                todo += [")", *reversed(slot.children), "("]
        self.written = " ".join(words)

    @staticmethod
    def _join(first: Slot, second: Slot) -> None:
        todo = [(first, second)]
        while todo:
            a, b = todo.pop()
            a.blocks += b.blocks
            b.joined = a
            todo += zip(a.children, b.children)

    def number(self, node: Node) -> int:
        """The slot of a block element of the page."""
        slot = self.slot_of[id(node)]
        while slot.joined is not None:
            slot = slot.joined
        return slot.number


class _Tree:
    """A written outline: for each node its label, children and shape; nodes are numbered in order."""

    def __init__(self, written: str, shapes: dict[tuple, int]):
        self.labels: list[str] = []
        self.children: list[list[int]] = []
        stack: list[list[int]] = [[]]
        for word in written.split():
            if word == "(":
                stack.append(self.children[-1])
            elif word == ")":
                stack.pop()
            else:
                stack[-1].append(len(self.labels))
                self.labels.append(word)
                self.children.append([])
        self.shape, self.size = [0] * len(self.labels), [1] * len(self.labels)
        for n in range(len(self.labels) - 1, -1, -1):
            self.shape[n] = shapes.setdefault((self.labels[n], *[self.shape[c] for c in self.children[n]]), len(shapes))
            self.size[n] += sum(self.size[c] for c in self.children[n])


@lru_cache(10_000)
def aligned(own: str, reference: str) -> tuple[float, dict[int, int]]:
    """Simple tree matching of two written outlines: the share of their nodes that match, and the slot of the reference
    for each slot of the first that does.

    Pairs of nodes are found from the roots down and worked out from the leaves up. Children of equal shape at either end
    of two lists match as they are, which no other choice betters; the rest is a table over both lists.
    """
    shapes: dict[tuple, int] = {}
    a, b = _Tree(own, shapes), _Tree(reference, shapes)
    order, seen = [(0, 0)] if a.labels[0] == b.labels[0] else [], {(0, 0)}
    ends: dict[tuple[int, int], tuple[int, int]] = {}
    for x, y in order:
        if a.shape[x] == b.shape[y]:
            continue
        xs, ys = a.children[x], b.children[y]
        low, high = 0, 0
        while low < min(len(xs), len(ys)) and a.shape[xs[low]] == b.shape[ys[low]]:
            low += 1
        while high < min(len(xs), len(ys)) - low and a.shape[xs[-1 - high]] == b.shape[ys[-1 - high]]:
            high += 1
        ends[x, y] = low, high
        for p in xs[low:len(xs) - high]:
            for q in ys[low:len(ys) - high]:
                if a.labels[p] == b.labels[q] and (p, q) not in seen:
                    seen.add((p, q))
                    order.append((p, q))
    best: dict[tuple[int, int], int] = {}
    steps: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for x, y in reversed(order):
        if a.shape[x] == b.shape[y]:
            best[x, y] = a.size[x]
            continue
        low, high = ends[x, y]
        xs, ys = a.children[x], b.children[y]
        fixed = [*zip(xs[:low], ys[:low]), *zip(xs[len(xs) - high:], ys[len(ys) - high:])]
        xs, ys = xs[low:len(xs) - high], ys[low:len(ys) - high]
        table = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        for i, p in enumerate(xs, 1):
            for j, q in enumerate(ys, 1):
                table[i][j] = max(table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + best.get((p, q), 0))
        chosen, i, j = list(fixed), len(xs), len(ys)
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                chosen.append((xs[i], ys[j]))
        steps[x, y] = chosen
        best[x, y] = 1 + table[len(xs)][len(ys)] + sum(a.size[p] for p, _ in fixed)
    pairs: dict[int, int] = {}
    todo = order[:1]
    while todo:
        x, y = todo.pop()
        if a.shape[x] == b.shape[y]:
            pairs.update((x + k, y + k) for k in range(a.size[x]))
        else:
            pairs[x] = y
            todo += steps[x, y]
    return 2 * len(pairs) / (len(a.labels) + len(b.labels)), pairs


def _hash(text: str) -> int:
    n = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return n - (1 << 64) if n >> 63 else n


def _outliner():
    @F.arrow_udf("struct<outline:string,article:bigint,slots:array<struct<slot:int,block:bigint>>>")
    def outline(pages: pa.Array) -> pa.Array:
        rows = []
        for page in pages:
            root = parse(page.as_py() or "")
            tree = Outline(root)
            slots = sorted({(s.number, _hash(b)) for s in tree.slots for b in s.blocks})
            rows.append({"outline": tree.written, "article": _hash("\n\n".join(b for b, _ in article(root))),
                         "slots": [{"slot": n, "block": b} for n, b in slots]})
        slot = pa.struct([("slot", pa.int32()), ("block", pa.int64())])
        return pa.array(rows, pa.struct([("outline", pa.string()), ("article", pa.int64()), ("slots", pa.list_(slot))]))
    return outline


def _aligner():
    @F.arrow_udf("struct<score:double,slots:array<struct<slot:int,reference_slot:int>>>")
    def align(own: pa.Array, reference: pa.Array) -> pa.Array:
        pair = pa.struct([("slot", pa.int32()), ("reference_slot", pa.int32())])
        found = [aligned(x, y) for x, y in zip(own.to_pylist(), reference.to_pylist())]
        return pa.array([{"score": score, "slots": [{"slot": a, "reference_slot": b} for a, b in sorted(pairs.items())]}
                         for score, pairs in found], pa.struct([("score", pa.float64()), ("slots", pa.list_(pair))]))
    return align


def layouts(outlines: DataFrame, alike: float = ALIKE) -> DataFrame:
    """host, outline, layout (a number), reference and the aligned slots of every outline of `outlines` (host, outline, count).

    A round takes each host's most frequent outline that is left as reference, with all that are alike; rounds are as many
    as the layouts of the most varied host.
    """
    left, parts, number = outlines, [], 0
    while not left.isEmpty():
        best = left.groupBy("host").agg(F.max(F.struct("count", "outline"))["outline"].alias("reference"))
        tried = stage(left.join(best, "host").withColumn("m", _aligner()("outline", "reference")), "aligned-outlines")
        near = F.col("m.score") >= alike
        parts.append(tried.where(near).select("host", "outline", F.lit(number).alias("layout"), "reference", "m.slots"))
        left, number = tried.where(~near).select("host", "outline", "count"), number + 1
    return reduce(DataFrame.union, parts) if parts else outlines.select(
        "host", "outline", F.lit(0).alias("layout"), F.col("outline").alias("reference"),
        F.array().cast("array<struct<slot:int,reference_slot:int>>").alias("slots"))


def templates(pages: DataFrame, share: float = TEMPLATE_SHARE, least: int = TEMPLATE_ARTICLES, alike: float = ALIKE) -> DataFrame:
    """host and `layouts` (reference outline and template: slots with block hashes, in order of the layouts' numbers) of
    every host that has template blocks.

    Counted over all pages. Blocks are counted by hash, an article once for each outline that it comes in; a slot that fewer
    than `least` articles have has no template.
    """
    seen = stage(pages.select(host(F.col("url")).alias("host"), _outliner()("html").alias("o")).select("host", "o.*"), "outlines")
    outlines = seen.groupBy("host", "outline").agg(F.count("*").alias("count"), F.count_distinct("article").alias("articles"))
    outlines = stage(outlines, "distinct-outlines")
    placed = stage(layouts(outlines.select("host", "outline", "count"), alike), "layouts")
    slots = placed.select("host", "outline", "layout", F.explode("slots").alias("m")).select("host", "outline", "layout", "m.*")
    there = (slots.join(outlines, ["host", "outline"]).groupBy("host", "layout", "reference_slot").agg(F.sum("articles").alias("articles"))
             .where(F.col("articles") >= least))
    blocks = (seen.select("host", "outline", "article", F.explode("slots").alias("s"))
              .select("host", "outline", "article", "s.slot", "s.block").distinct()
              .groupBy("host", "outline", "slot", "block").agg(F.count("*").alias("n")))
    often = (blocks.join(slots, ["host", "outline", "slot"]).groupBy("host", "layout", "reference_slot", "block").agg(F.sum("n").alias("n"))
             .join(there, ["host", "layout", "reference_slot"]).where(F.col("n") >= share * F.col("articles")))
    template = often.groupBy("host", "layout").agg(F.collect_list(F.struct(F.col("reference_slot").alias("slot"), "block")).alias("template"))
    every = (placed.groupBy("host", "layout").agg(F.first("reference").alias("reference")).join(template, ["host", "layout"], "left")
             .groupBy("host").agg(F.array_sort(F.collect_list(F.struct("layout", "reference", "template"))).alias("layouts")))
    return every.where(F.exists("layouts", lambda l: l["template"].isNotNull()))


def kept_blocks(root: Node, known: list[dict], alike: float = ALIKE) -> list[str]:
    """The blocks of a page's article without its layout's template."""
    blocks = article(root)
    if known:
        tree = Outline(root)
        for layout in known:
            score, slots = aligned(tree.written, layout["reference"])
            if score >= alike:
                fixed = {(t["slot"], t["block"]) for t in layout["template"] or ()}
                return [b for b, node in blocks if (slots.get(tree.number(node)), _hash(b)) not in fixed]
    return [b for b, _ in blocks]


def _extractor(alike: float):
    @F.arrow_udf("string")
    def extract(pages: pa.Array, layouts: pa.Array) -> pa.Array:
        return pa.array(["\n\n".join(kept_blocks(parse(page.as_py() or ""), known.as_py() or [], alike))
                         for page, known in zip(pages, layouts)], pa.string())
    return extract


def main_text(pages: DataFrame, share: float = TEMPLATE_SHARE, least: int = TEMPLATE_ARTICLES, alike: float = ALIKE) -> DataFrame:
    """page_id, url and text of every row of `pages`; other columns are left out.

    NULL and empty pages have an empty text. Rows are extracted one by one: repeated rows and ids are all kept. Pages
    without host (NULL urls, or none in them) are taken as pages of one host. An empty table gives no rows.
    """
    known = stage(templates(pages.select("url", "html"), share, least, alike), "templates")
    return (pages.select("page_id", "url", "html", host(F.col("url")).alias("host")).join(known, "host", "left")
            .select("page_id", "url", _extractor(alike)("html", "layouts").alias("text")))
