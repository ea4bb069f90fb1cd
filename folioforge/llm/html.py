"""Main text of web pages by wrapper induction.

Pages of a host are dealt into groups of about GROUP pages. In a group each page's tree of block elements is aligned
with that of a middling page, and with the largest, by simple tree matching: two trees match only if their roots have the
same tag and class, and then in as many nodes as the best order-keeping matching of their children allows. The wrapper
comes from what is aligned:

- A text that says the same in most of the pages aligned there belongs to the host's template, and so does what is
  aligned with it and says the same; an equal text elsewhere doesn't. Only pages that differ in most of their content are
  compared, so copies of an article don't make it template.
- The rest varies, but menus and adverts vary as well. So the slot that holds the article is sought in the aligned tree:
  from the root down into the element that holds most of the varying text outside links, summed over the group's pages,
  as long as one does. Each page's content is what is aligned with that slot (and with headings right before it).
- Names are only a prior: article and main elements count MAIN times, elements for menus, headers, footers, asides and
  forms not at all (but a form that is nearly all of the page). Elements whose class and id say just that (and hold
  neither article or main elements nor nearly all of the page) are left out; where these say something else as well,
  only outside article and main elements, and only if the element recurs in most of the group's pages. In an article
  its header is its own, and the id of a chapter is an anchor.

A page without such a group, or that doesn't align with its slot, is judged by its own tree alone in the same way.
Outside article and main elements, blocks that are mostly links go too, but for paragraphs. Headings in an article stay,
even if all pages have them ("Conclusion").

The text is the blocks' text in page order, one line each: character references decoded, white space as single
spaces. A null or empty page has empty text. Pages without a host form groups like any others; equal pages are extracted
once; all pages are processed whole.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Scratch

#: Pages aligned together, about, and their bytes.
GROUP, GROUP_BYTES = 48, 16 << 20
#: Hosts with several groups, and equal pages, (about 60 bytes each) up to which their table is broadcast; more are joined by shuffle.
LOOKED_UP = 200_000
#: Equal pages from which on only one goes to a group; of those, pages joined with one copy of the text.
EQUAL, TOGETHER = 16, 50_000
#: Children of two elements, multiplied, above which their table is made by rows of numpy arrays, not all held at once.
TABLE = 2500
#: Cells of two pages' tables that are held for the way back and for the elements around; others are made again.
HELD = 1 << 18
#: Levels of a tree; what elements further inside hold are the last level's children, with roles of their own.
DEEP = 200
#: Share of the compared pages that must say the same for a text to be template, and pages compared at least.
CONSTANT, COMPARED = 0.6, 2
#: Share of an element's varying text that one inside must hold to be the content's slot; for tables, whose cells may be layout or content.
MOST, MOST_OF_TABLE = 0.7, 0.95
#: Share of a page's text from which on an element is the page, whatever its name.
THE_PAGE = 0.95
#: How much more text in article and main elements counts.
MAIN = 3

#: Elements by role.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul hr button".split()
)
LEFT_OUT = {"nav", "footer", "aside", "form", "menu", "dialog", "search", "head", "button", "select", "fieldset"}
HOLDERS = {"#", "html", "body", "div", "section", "center", "article", "main"}
TABLES = {"table", "tbody", "tr", "td"}
HEADINGS = {"h1", "h2", "h3", "hgroup"}
TITLES = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements whose id in an article is a chapter's anchor, and words that name an article's own head there.
CHAPTERS, OWN_HEAD = {"section", "p", *TITLES}, {"header", "masthead"}
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ROLE = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}
ASIDE = set(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos promotion banner nav navbar navigation menu menus breadcrumb breadcrumbs sidebar footer masthead header cookie cookies consent notice notices newsletter subscribe popup modal share sharing social related comment comments respond disqus login signup toolbar pagination skip".split()
)
PLAIN = set("area bar block bottom box button buttons container content global group holder inner item items left link links list outer page panel post posts primary right row secondary section site slot thread top unit widget wrap wrapper".split())
MODIFIED = {"has", "with", "no", "without", "is", "hide", "show"}

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    """A block element, left out by its tag or role (1) or hidden (2); its children are elements and texts [text, share of it in links, left out by elements too deep for a node]."""

    __slots__ = ("tag", "kind", "out", "named", "main", "children")

    def __init__(self, tag: str, kind: str, out: int = 0, named: int = 0, main: bool = False) -> None:
        self.tag, self.kind, self.out, self.named, self.main, self.children = tag, kind, out, named, main, []


def named(names: str, inside: bool = False) -> int:
    """What a class and id say: 2 that the element is none of the article, 1 that and something else, 0 neither. `inside` an article its head is its own."""
    words = [x.lower() for x in _WORD.findall(names)]
    words = [x for x in words if x not in OWN_HEAD] if inside else words
    if not ASIDE.intersection(words) or MODIFIED.intersection(words):
        return 0
    return 2 if all(x in ASIDE or x in PLAIN for x in words) else 1


def parse(page: str) -> Node:
    """The tree of block elements; inline markup is only text."""
    root = Node("#", "#")
    # open elements (tag, node, left out below the last node, in an article), also those too deep for a node, and how many of each tag
    stack, opened, parts, links, depth = [("#", root, False, False)], Counter(), [], 0, 0
    at, n = 0, len(page)

    def flush() -> None:
        nonlocal links
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                _, node, out, _ = stack[-1]
                node.children.append([text, links / max(1, sum(map(len, parts))), out])
            parts.clear()
        links = 0

    def add(raw: str) -> None:
        nonlocal links
        if raw:
            parts.append(raw)
            links += len(raw) if depth else 0

    def close_from(i: int) -> None:
        opened.subtract(x[0] for x in stack[i:])
        del stack[i:]

    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if not tag:
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "a":
                depth = 0
            elif tag in BLOCK:
                flush()
                for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                    if stack[i][0] == tag:
                        close_from(i)
                        break
            continue
        if tag in RAW:
            if not m[3].endswith("/") or tag not in ("svg", "math"):
                end = re.compile(rf"</{tag}\s*>|</{tag}\s", re.I).search(page, at)
                at = end.end() if end else n
            continue
        if tag == "a":
            depth = 1
        elif tag == "br":
            add(" ")
        elif tag in BLOCK:
            flush()
            if tag == "hr":
                continue
            close = CLOSED_BY.get(tag)
            if close:
                for i in range(len(stack) - 1, 0, -1) if any(opened[x] for x in close) else ():
                    if stack[i][0] in close:
                        close_from(i)
                        break
                    if stack[i][0] in ("ul", "ol", "dl", "table", "menu", "select"):
                        break
            elif stack[-1][0] == "p":
                close_from(len(stack) - 1)
            _, up, up_out, up_main = stack[-1]
            kind, out, main, own, hidden = tag, tag in LEFT_OUT, tag in ("article", "main"), 0, False
            if m[3]:
                a = {k.lower(): x or y or z for k, x, y, z in _ATTRIBUTE.findall(m[3])}
                kind = f"{tag}.{a.get('class', '')}"
                role = a.get("role", "").lower()
                main = main or role in ("main", "article")
                out = out or role in ROLE
                hidden = "hidden" in a or a.get("aria-hidden", "").lower() == "true" or bool(re.search(r"display\s*:\s*none", a.get("style", ""), re.I))
                anchor = "" if up_main and tag in CHAPTERS else a.get("id", "")
                own = 0 if main or tag in ("body", "html") else named(f"{a.get('class', '')} {anchor}", up_main)
            out = out or tag == "header" and not up_main
            node = up
            if len(stack) < DEEP:
                node = Node(tag, kind, 2 if hidden else int(out), own, main)
                up.children.append(node)
            stack.append((tag, node, node is up and (up_out or out or hidden or own == 2), main or up_main))
            opened[tag] += 1
    flush()
    return root


def texts_of(node: Node, found: list) -> list:
    """The texts in page order; the text's list itself identifies it."""
    for c in node.children:
        if type(c) is Node:
            texts_of(c, found)
        else:
            found.append(c)
    return found


class Pair:
    """What the alignment of two pages knows: signatures of nodes that align alike with all nodes of the other page."""

    def __init__(self, a: list, b: list) -> None:
        self.shared = {c[0] for c in a} & {c[0] for c in b}
        self.codes: dict = {}
        self.signed: dict[int, int] = {}
        self.weights: dict[tuple[int, int], int] = {}
        self.leaves: dict[int, tuple | None] = {}
        self.tables: dict[tuple[int, int], list | Rows] = {}
        self.scores: dict[tuple[int, int], int] = {}
        self.room = HELD

    def leaf(self, c) -> tuple | None:
        """(kind, weight of a match, text) of a text or an element that holds just one; a text that only one page has is None."""
        if type(c) is not Node:
            return None, 1, c[0] if c[0] in self.shared else None
        found = self.leaves.get(id(c), self)
        if found is self:
            inner = c.children
            alone = len(inner) == 1 and type(inner[0]) is not Node
            found = self.leaves[id(c)] = (c.kind, 2, inner[0][0] if inner[0][0] in self.shared else None) if alone else None
        return found

    def table(self, x: list, y: list) -> list | Rows:
        """The rows of best matches of two lists of children, made once while there is room."""
        rows = self.tables.get(key := (id(x), id(y)))
        if rows is None:
            large = len(x) * len(y) > TABLE
            rows = Rows(x, y, self) if large else rows_of(x, y, self)
            cells = (2 * math.isqrt(len(x)) + 2 if large else len(x) + 1) * (len(y) + 1)
            if cells <= self.room:
                self.room -= cells
                self.tables[key] = rows
        return rows

    def score(self, x: list, y: list) -> int:
        """Nodes that match in two lists of children (equal texts count double)."""
        found = self.scores.get(key := (id(x), id(y)))
        if found is None:
            found = int(self.table(x, y)[len(x)][len(y)])
            if len(self.scores) < HELD:
                self.scores[key] = found
        return found

    def code(self, key) -> int:
        return self.codes.setdefault(key, len(self.codes))

    def sign(self, c) -> int:
        """Texts that only one page has are alike, since they equal none of the other's."""
        if type(c) is not Node:
            return self.code(c[0] if c[0] in self.shared else None)
        found = self.signed.get(id(c))
        if found is None:
            found = self.signed[id(c)] = self.code((c.kind, *map(self.sign, c.children)))
        return found

    def weight(self, p, q) -> int:
        key = self.sign(p), self.sign(q)
        found = self.weights.get(key)
        if found is None:
            found = self.weights[key] = weight(p, q, self)
        return found


def align(a: Node, b: Node, pairs: list, elements: dict, known: Pair) -> None:
    """Appends the text nodes of a and b that simple tree matching aligns, and adds to elements b's by a's id."""
    elements[id(a)] = b
    for p, q in matched(a.children, b.children, known):
        if type(p) is Node:
            align(p, q, pairs, elements, known)
        else:
            pairs.append((p, q))


def matched(x: list, y: list, known: Pair) -> list:
    """The pairs of nodes that match in two lists of children, in order."""
    rows = known.table(x, y)
    i, j = len(x), len(y)
    found = []
    while i and j:
        if rows[i][j] == rows[i - 1][j]:
            i -= 1
        elif rows[i][j] == rows[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            found.append((x[i], y[j]))
    return found[::-1]


def rows_of(x: list, y: list, known: Pair) -> list:
    """The rows of a small table. Leaves of one kind and text have the same weights, so these are told once."""
    above = [0] * (len(y) + 1)
    rows, told = [above], {}
    leaves = [known.leaf(q) for q in y]
    for p in x:
        leaf = known.leaf(p)
        weights, same = told.get(leaf, (None, None)) if leaf else (None, None)
        if weights is None:
            weights = [weight(p, q, known) if not leaf or not other else 0 if leaf[0] != other[0] else leaf[1] + (leaf[2] is not None and leaf[2] == other[2]) for q, other in zip(y, leaves, strict=True)]
            same = weights[0] if weights and weights.count(weights[0]) == len(weights) else None
            if leaf:
                told[leaf] = weights, same
        if same is not None:
            row = [0, *[a + same if a + same > b else b for a, b in zip(above, above[1:], strict=False)]] if same else above
        else:
            row, last = [0], 0
            for before, best, w in zip(above, above[1:], weights, strict=False):
                if last > best:
                    best = last
                if w and before + w > best:
                    best = before + w
                row.append(best)
                last = best
        rows.append(row)
        above = row
    return rows


class Rows:
    """The rows of a large table: every so many are held, those between are made again when the way back needs them."""

    def __init__(self, x: list, y: list, known: Pair) -> None:
        self.known, self.x = known, [known.sign(p) for p in x]
        first = {known.sign(q): q for q in reversed(y)}
        order = {k: i for i, k in enumerate(first)}
        self.y, self.column = list(first.values()), np.array([order[known.sign(q)] for q in y])
        features = [self.features(q) for q in self.y]
        self.kinds, self.lone, self.texts = (np.array(f) for f in zip(*features, strict=True))
        nodes = dict(zip(self.x, x, strict=True))
        self.weights = {k: self.against(p) for k, p in nodes.items()}
        self.step = max(1, math.isqrt(len(x)))
        row = np.zeros(len(y) + 1, np.int64)
        self.held, self.block = {0: row}, {}
        for i in range(1, len(x) + 1):
            row = self.next(row, i)
            if i % self.step == 0 or i == len(x):
                self.held[i] = row

    def features(self, c) -> tuple[int, bool, int]:
        """Code of its kind, whether it's a text or holds just one, and that text's code."""
        if type(c) is not Node:
            return -1, True, self.known.code(c[0])
        lone = len(c.children) == 1 and type(c.children[0]) is not Node
        return self.known.code((c.kind, "kind")), lone, self.known.code(c.children[0][0]) if lone else -1

    def against(self, p) -> np.ndarray:
        kind, lone, text = self.features(p)
        w, alike = np.zeros(len(self.y), np.int32), self.kinds == kind
        if lone:
            w[alike & self.lone] = 1 if kind < 0 else 2
            w[alike & self.lone & (self.texts == text)] += 1
            alike &= ~self.lone
        for j in np.flatnonzero(alike).tolist():
            w[j] = self.known.weight(p, self.y[j])
        return w

    def next(self, above: np.ndarray, i: int) -> np.ndarray:
        row = above.copy()
        np.maximum(row[1:], above[:-1] + self.weights[self.x[i - 1]][self.column], out=row[1:])
        return np.maximum.accumulate(row)

    def __getitem__(self, i: int) -> np.ndarray:
        found = self.held.get(i)
        if found is None:
            found = self.block.get(i)
        if found is None:
            at = i // self.step * self.step
            row, self.block = self.held[at], {}
            for k in range(at + 1, min(at + self.step, len(self.x) + 1)):
                row = self.block[k] = self.next(row, k)
            found = self.block[i]
        return found


def weight(p, q, known: Pair) -> int:
    if type(p) is not Node:
        return 0 if type(q) is Node else 2 if p[0] == q[0] else 1
    if type(q) is not Node or p.kind != q.kind:
        return 0
    x, y = p.children, q.children
    if len(x) == 1 == len(y) and type(x[0]) is not Node and type(y[0]) is not Node:
        return 3 if x[0][0] == y[0][0] else 2
    if not x or not y:
        return 1
    return 1 + known.score(x, y)


class Page:
    """A tree, its texts, and what is known of them: template texts and elements that recur."""

    def __init__(self, tree: Node) -> None:
        self.tree, self.texts = tree, texts_of(tree, [])
        self.constant: set[int] = set()
        self.recurs: set[int] = set()

    def weigh(self) -> None:
        """Of each element the characters outside links that aren't template or left out, and whether it is left out."""
        self.mass, self.out, self.holds_main, self.all = {}, {}, {}, {}
        self._measure(self.tree)
        self._weigh(self.tree, False, False)

    def _measure(self, node: Node) -> tuple[int, bool]:
        n, main = 0, node.main
        for c in node.children:
            if type(c) is Node:
                k, inside = self._measure(c)
                n, main = n + k, main or inside
            else:
                n += len(c[0])
        self.all[id(node)], self.holds_main[id(node)] = n, main
        return n, main

    def _weigh(self, node: Node, out: bool, main: bool) -> float:
        share = self.all[id(node)] / max(1, self.all[id(self.tree)])
        if not out and node.out:
            out = node.out == 2 or not self.holds_main[id(node)] and not (node.tag == "form" and share >= THE_PAGE)
        elif not out and node.named and not self.holds_main[id(node)]:
            # in an article elements recur because articles are alike
            out = share < THE_PAGE if node.named == 2 else not main and 2 * share <= 1 and id(node) in self.recurs
        main = main or node.main
        self.out[id(node)] = out
        n = 0.0
        for c in node.children:
            if type(c) is Node:
                n += self._weigh(c, out, main)
            elif not out and not c[2] and id(c) not in self.constant:
                n += len(c[0]) * (1 - c[1])
        self.mass[id(node)] = n
        return n

    def kept(self, slots: list[Node]) -> str:
        found: list = []
        for node in slots:
            self._keep(node, node.main, found)
        return "\n".join(found)

    def _keep(self, node: Node, main: bool, found: list) -> None:
        if self.out[id(node)]:
            return
        for c in node.children:
            if type(c) is Node:
                self._keep(c, main or c.main, found)
            elif not c[2] and (id(c) not in self.constant or main and node.tag in TITLES) and (main or c[1] <= 0.5 or node.tag == "p"):
                found.append(c[0])


def slots(tree: Node, mass: dict[int, float], out: dict[int, bool]) -> list[Node]:
    """The elements that hold the content, in page order, by the varying text in each element."""
    mains = topmost(tree, out, [])
    inside = sum(mass[id(x)] for x in mains)
    if mains and MAIN * inside >= mass[id(tree)] - inside:
        return mains
    node, before = tree, []
    while True:
        inner = [c for c in node.children if type(c) is Node and not out[id(c)]]
        best = max(inner, key=lambda c: mass[id(c)], default=None)
        if best is None or best.tag not in HOLDERS | TABLES or mass[id(best)] < (MOST_OF_TABLE if best.tag in TABLES else MOST) * mass[id(node)] or not mass[id(best)]:
            return [*before, node]
        before += [c for c in inner[: inner.index(best)] if c.tag in HEADINGS]
        node = best


def topmost(node: Node, out: dict[int, bool], found: list) -> list[Node]:
    """The outermost article and main elements that aren't left out."""
    for c in node.children:
        if type(c) is Node and not out[id(c)]:
            if c.main:
                found.append(c)
            else:
                topmost(c, out, found)
    return found


def extract(pages: list[str], induced: bool = True) -> list[str]:
    """The main texts of pages of one host."""
    distinct: dict = {}
    names = []
    for p in pages:
        page = Page(parse(p or ""))
        names.append((tuple(c[0] for c in page.texts), tuple(shape(page.tree, []))))
        distinct.setdefault(names[-1], page)
    slot = induce(distinct) if induced else {}
    done = {}
    for k, page in distinct.items():
        if k not in slot:
            page.weigh()
        done[k] = page.kept(slot.get(k) or slots(page.tree, page.mass, page.out))
    return [done[k] for k in names]


def induce(distinct: dict[tuple, Page]) -> dict[tuple, list[Node]]:
    """Marks the pages' template texts and recurring elements; of pages that align with the content's slot, the elements there."""
    order = sorted(distinct, key=lambda k: (len(k[0]), k))
    if len(order) <= COMPARED:
        return {}
    middle, largest = order[len(order) // 2], order[-1]
    found = None
    for base in dict.fromkeys((largest, middle)):
        found = compare(distinct, order, base)
    if found is None:
        return {}
    # the middling page's tree, with the pages' text summed over what is aligned
    tree = distinct[middle].tree
    total: Counter = Counter()
    for k, elements in found.items():
        page = distinct[k]
        page.weigh()
        for p, q in elements.items():
            total[p] += page.mass[id(q)]
    chosen = slots(tree, total, distinct[middle].out)
    own = {k: [elements[id(x)] for x in chosen if id(x) in elements] for k, elements in found.items()}
    return {k: x for k, x in own.items() if x and id(chosen[-1]) in found[k]}


def compare(distinct: dict[tuple, Page], order: list[tuple], base: tuple) -> dict[tuple, dict] | None:
    """Marks what alignment with one page shows; of each page its elements by the base's they are aligned with. None: too few pages differ."""
    tree, known = distinct[base].tree, distinct[base].texts
    same, there = Counter(), Counter()
    compared, seen, aligned = 0, {base[0]}, {}
    size = lambda pairs: sum(len(p[0]) for p, _ in pairs)
    for k in order:
        pairs, elements = [], {}
        if k == base:
            pairs = [(c, c) for c in known]
            own(tree, elements)
        else:
            align(tree, distinct[k].tree, pairs, elements, Pair(known, distinct[k].texts))
        equal = [(p, q) for p, q in pairs if p[0] == q[0]]
        aligned[k] = equal, elements
        if k[0] in seen or 2 * size(equal) > max(size(pairs), min(size([(c, c) for c in known]), size([(c, c) for c in distinct[k].texts]))):
            continue  # the same texts in other tags, or much the same article
        seen.add(k[0])
        compared += 1
        same.update(id(p) for p, _ in equal)
        there.update(elements.keys())
    if compared < COMPARED:
        return None
    for k, (equal, elements) in aligned.items():
        distinct[k].constant |= {id(q) for p, q in equal if same[id(p)] >= CONSTANT * compared}
        distinct[k].recurs |= {id(q) for p, q in elements.items() if there[p] >= CONSTANT * compared}
    return {k: elements for k, (_, elements) in aligned.items()}


def own(node: Node, elements: dict) -> None:
    elements[id(node)] = node
    for c in node.children:
        if type(c) is Node:
            own(c, elements)


def shape(node: Node, found: list) -> list:
    """Tells trees apart whose texts are the same."""
    found.append(node.kind)
    for c in node.children:
        if type(c) is Node:
            shape(c, found)
        else:
            found.append("")
    found.append(")")
    return found


def main_text(pages: DataFrame, carry: list[str], html_col: str = "html", url: str = "url") -> DataFrame:
    """`carry` (any columns of pages but one named text) and text."""
    if "text" in carry:
        raise ValueError("pages' column text clashes with the result")
    scratch = Scratch(pages.sparkSession)
    host = F.coalesce(F.regexp_extract(F.lower(F.col(url)), r"^[^:/?#]*://([^/?#]*)", 1), F.lit(""))
    content = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.struct(*[F.col(c) for c in dict.fromkeys(carry)], F.lit(0).alias("__none")).alias("__row"), content.alias("__html"), host.alias("__host"))
    # equal pages of a host: two hashes of 64 bits
    key = F.struct(F.col("__host"), F.xxhash64("__html").alias("one"), F.xxhash64(F.lit(7), "__html").alias("two"))
    rows = rows.withColumn("__key", key)
    sizes = scratch.write(rows.select("__key", F.octet_length("__html").cast("long").alias("bytes")).groupBy("__key").agg(F.count("*").alias("n"), F.first("bytes").alias("bytes")))
    small = lambda df: F.broadcast(df) if df.count() <= LOOKED_UP else df
    # a host's pages are spread over as many groups as it needs, by what they hold; only hosts that need several are looked up
    single = F.when(F.col("n") >= EQUAL, 1).otherwise(F.col("n"))
    groups = F.ceil(F.greatest(F.count("*") / GROUP, F.sum(single * F.col("bytes")) / GROUP_BYTES)).cast("long")
    large = scratch.write(sizes.groupBy(F.col("__key.__host").alias("__large")).agg(groups.alias("__groups")).where("__groups > 1"))
    equal = scratch.write(sizes.where(F.col("n") >= EQUAL).select(F.col("__key").alias("__equal"), F.ceil(F.col("n") / TOGETHER).cast("long").alias("__copies")))
    kind = rows.schema["__row"].dataType
    none = F.lit(None).cast(kind)
    one = None
    if not equal.isEmpty():
        few = small(equal)
        same = F.col("__key") == F.col("__equal")
        one = rows.join(few, same, "left_semi").groupBy("__key").agg(F.first("__html").alias("__html")).select(none.alias("__row"), "__html", F.col("__key.__host").alias("__host"), "__key")
        copies = rows.drop("__html").join(few, same).withColumn("__copy", F.pmod(F.monotonically_increasing_id(), F.col("__copies"))).select("__row", "__equal", "__copy")
        rows = rows.join(few, same, "left_anti").unionByName(one)
    dealt = rows.join(small(large), F.col("__host") == F.col("__large"), "left").withColumn("__group", F.pmod(F.col("__key.one"), F.coalesce("__groups", F.lit(1))))
    dealt = dealt.select("__row", "__html", "__host", "__group", *(["__key"] if one is not None else []))
    names = [f.name for f in dealt.select("__row", *(["__key"] if one is not None else [])).schema]
    schema = T.StructType([*(dealt.schema[x] for x in names), T.StructField("text", T.StringType(), False)])

    def run(group: pa.Table) -> pa.Table:
        found = extract(group.column("__html").to_pylist())
        return pa.table([*(group.column(c) for c in names), pa.array(found, pa.string())], names=[*names, "text"])

    done = dealt.groupBy("__host", "__group").applyInArrow(run, schema)
    if one is not None:
        # of equal pages the text goes back to all: so many copies of it that no task gets all pages of one
        done = scratch.write(done)
        texts = done.where(F.col("__row").isNull()).select(F.col("__key").alias("__equal"), "text").join(small(equal), "__equal").select("__equal", "text", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1)).alias("__copy"))
        done = done.where(F.col("__row").isNotNull()).select("__row", "text").unionByName(copies.join(texts, ["__equal", "__copy"]).select("__row", "text"))
    return done.select(*[F.col("__row").getField(c).alias(c) for c in dict.fromkeys(carry)], "text")
