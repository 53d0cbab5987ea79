"""Main text of web pages by wrapper induction (operator 9).

Pages of one host are taken together in groups of at most `GROUP_PAGES`; every page is in one group.
The DOM trees of a group are aligned by simple tree matching with a model, which is the tree of the
first page, extended by the nodes that each further page brings; runs of like siblings count as one
child, and inline elements belong to the text of their block. A node whose text is the same on most
pages of the group is template; the others are slots.

The slots decide where the article is: from the root on, the model's subtree that holds nearly all
text of the slots is entered, as long as nothing that reads like a part of the article stays beside
it. Names only help: what stands in menus, headers, footers, sidebars, notices, adverts, forms,
scripts and comments counts for nothing though it varies, text in links does not count, and an
`article` or `main` element is entered with less than nearly all text. A page that has little text in
the region of its group gets one of its own, by the same steps on its own tree.

Hosts may be large: those with more than a two-thousandth of all pages are salted, so at most two
thousand rows come to the driver, and a partition is read as a stream of groups.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, text_batches

GROUP_PAGES = 64
#: Pages with different source that must agree at least, and their share, before a text counts as template.
TEMPLATE = 3, 0.6
#: The same inside an `article` or `main` element, where near copies of one text must not pass for a template.
ARTICLE_TEMPLATE = 12, 0.9
HOT_SHARE = 2000
#: The share of the slots' text that a subtree must hold to be entered: any container, and `article` or `main`.
REGION_SHARE, ARTICLE_SHARE = 0.9, 0.5
#: The share of a page's text below which the region of its group is not its own.
PAGE_SHARE = 0.5
#: What a cell of the sparse chain takes, a row of the dense one and a place in it: the quicker is chosen, both give the same chain.
CELL_SECONDS, ROW_SECONDS, PLACE_SECONDS = 4e-6, 4e-5, 1.2e-8
#: Characters of source of a group, and of a partition, beyond which a new one begins.
GROUP_CHARS, PARTITION_CHARS = 8_000_000, 8_000_000
#: Partitions at most; beyond, each holds more groups, which are read as a stream.
MAX_PARTITIONS = 50_000

# Element names of HTML by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split())
SKIPPED = set("head nav footer aside form script style noscript template iframe object svg math canvas audio video button select textarea input menu dialog map title noembed noframes datalist".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Elements that may be the region of the article.
CONTAINERS = set("html body div section article main center table tbody tr td".split()) 
#: A start tag ends an open element of these names, unless one of the barriers is between.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
CLOSES_P = set("address article aside blockquote details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
BARRIERS = set("html body article section main div nav aside footer header form ul ol dl table td th blockquote figure button object details fieldset".split())
# Parts of class names and ids, and roles, of what is not the article.
NOT_CONTENT = set("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup menu menus nav navbar navigation breadcrumb breadcrumbs sidebar sidebars aside footer masthead topbar comment comments reply replies disqus respond share sharing social related recommended recommendations teaser teasers widget widgets toolbar pagination pager login search skip paywall disclaimer copyright".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar note".split())

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)""", re.S)
ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
SPACES = re.compile(r"\s+")
PARTS = re.compile(r"[a-z]+")
#: Class names that begin so tell what a page has, not what the element is.
PREFIXES = ("no-", "has-", "with-", "without-", "is-")


class Node:
    """An element; `items` holds its elements and texts in page order. Elements with equal `like` may be matched."""

    __slots__ = ("items", "keys", "like", "name", "up", "words")

    def __init__(self, name: str, up: Node | None, attrs: dict[str, str]) -> None:
        self.name, self.up, self.items = name, up, []
        own = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split() if attrs else ()
        self.words = {w for c in own if not c.startswith(PREFIXES) for w in PARTS.findall(c)} if own else ()
        self.keys = attrs
        self.like = (name, *sorted(self.words))

    @property
    def blocks(self) -> list[Node]:
        """The children that are aligned: no inline elements, and none without texts of their own."""
        return [x for x in self.items if isinstance(x, Node) and x.name not in INLINE and x.name not in RAW and x.name not in VOID]

    @property
    def elements(self) -> list[Node]:
        return [x for x in self.items if isinstance(x, Node)]

    def never_shown(self) -> bool:
        """No content by its name or because it is not displayed."""
        if self.name in SKIPPED:
            return True
        if not self.keys:
            return False
        style = self.keys.get("style", "").replace(" ", "").lower()
        return "hidden" in self.keys or self.keys.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style

    def hidden(self) -> bool:
        """No part of an article: also by its class, id or role."""
        if self.never_shown():
            return True
        return bool(self.keys) and self.name not in ("html", "body") and (not NOT_CONTENT.isdisjoint(self.words) or self.keys.get("role", "").lower() in ROLES)


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape((m[2] or "").strip("\"'")) for m in ATTR.finditer(text)} if text.strip(" /\t\r\n") else {}


def parse(source: str) -> Node:
    """The tree of a page; any text gives one."""
    root = here = Node("#root", None, {})
    at = 0
    while m := TAG.search(source, at):
        if m.start() > at:
            here.items.append(source[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            node = here
            while node is not None and node.name != name:
                node = node.up
            if node is not None and node.up is not None:
                here = node.up
            continue
        node, ends = here, {"p"} if name in CLOSES_P else ENDS.get(name)
        while ends and node.up is not None and (node.name not in BARRIERS or node.name in ends):
            if node.name in ends:
                here = node.up
                break
            node = node.up
        node = Node(name, here, attributes(m[3]))
        here.items.append(node)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
            at = end.end() if end else len(source)
        elif name not in VOID and not (m[3].endswith("/") and name in SKIPPED):
            here = node
    if at < len(source):
        here.items.append(source[at:])
    return root


def runs(node: Node) -> list[list[Node]]:
    """Blocks in runs of like siblings."""
    out: list[list[Node]] = []
    for x in node.blocks:
        if out and out[-1][0].like == x.like:
            out[-1].append(x)
        else:
            out.append([x])
    return out


def chain(cells: list[tuple[int, int, int]], width: int) -> list[int]:
    """The heaviest chain of cells (i, j, weight), i and j both rising; cells are in order of i, then of falling j.

    Of equally heavy chains that with the least last i counts, then the least last j, and so on backwards.
    """
    nothing = (0, 0, 0, -1)  # weight, -i, -j, cell
    best = [nothing] * (width + 1)  # prefix maxima in a Fenwick tree
    before, top = [], nothing
    for k, (i, j, weight) in enumerate(cells):
        at, reached = j, nothing
        while at:
            reached = max(reached, best[at])
            at &= at - 1
        before.append(reached[3])
        mine = (reached[0] + weight, -i, -j, k)
        top = max(top, mine)
        at = j + 1
        while at <= width:
            best[at] = max(best[at], mine)
            at += at & -at
    out, k = [], top[3]
    while k >= 0:
        out.append(k)
        k = before[k]
    return out[::-1]


def row_chain(rows: list[np.ndarray]) -> list[tuple[int, int]]:
    """The same chain from rows of weights (0: no cell), as places (i, j), for tables with many cells.

    A row of sums takes one pass of numpy. Every so many rows are kept and the others computed again
    on the way back, so memory grows with the root of the table.
    """
    width = len(rows[0])

    def step(sums: np.ndarray, row: np.ndarray) -> np.ndarray:
        out = sums.copy()
        np.maximum(out[1:], np.where(row > 0, sums[:-1] + row, 0), out=out[1:])
        return np.maximum.accumulate(out)

    stride = isqrt(len(rows)) + 1
    kept, sums = [], np.zeros(width + 1, np.int64)
    for i, row in enumerate(rows):
        if i % stride == 0:
            kept.append(sums)
        sums = step(sums, row)
    out, left, j = [], int(sums[-1]), width
    for block in reversed(range(len(kept))):
        lo = block * stride
        table = [kept[block]]
        for row in rows[lo : lo + stride]:
            table.append(step(table[-1], row))
        for i in reversed(range(1, len(table))):
            if left and table[i - 1][j] < left:
                j = int(np.searchsorted(table[i], left)) - 1
                out.append((lo + i - 1, j))
                left -= int(rows[lo + i - 1][j])
    return out[::-1]


class Shapes:
    """Numbers of trees by their shape, which is all that matching looks at, and the best matching of each pair of shapes.

    Equal shapes are compared once, however often they occur on the pages of a group.
    """

    def __init__(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.runs: list[tuple[int, ...]] = []  # of a shape
        self.run_numbers: dict[tuple, int] = {}
        self.members: list[tuple[int, ...]] = []  # of a run, as shapes
        self.likes: list[tuple] = []  # of a run
        self.plans: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}

    def of(self, root: Node) -> dict[int, int]:
        """The shape of each block of a tree, by the block's id."""
        blocks, todo = [], [root]
        while todo:
            x = todo.pop()
            blocks.append(x)
            todo += x.blocks
        out: dict[int, int] = {}
        for x in reversed(blocks):  # children come after their parents
            of_runs = tuple(self._number(self.run_numbers, (r[0].like, tuple(out[id(y)] for y in r)), self._add_run) for r in runs(x))
            out[id(x)] = self._number(self.numbers, (x.like, of_runs), lambda key: self.runs.append(key[1]))
        return out

    def _add_run(self, key: tuple) -> None:
        self.likes.append(key[0])
        self.members.append(key[1])

    @staticmethod
    def _number(known: dict[tuple, int], key: tuple, add: Callable[[tuple], None]) -> int:
        if key not in known:
            known[key] = len(known)
            add(key)
        return known[key]

    def plan(self, a: int, b: int) -> tuple[int, list[tuple[int, int]]]:
        """(score, pairs of runs) of the best matching of two shapes. Trees may be of any depth: a stack does the work."""
        stack = [] if (a, b) in self.plans else [self._visit(a, b)]
        while stack:
            pair = next(stack[-1], None)
            if pair is None:
                stack.pop()
            else:
                stack.append(self._visit(*pair))
        return self.plans[a, b]

    def _visit(self, a: int, b: int) -> Iterator[tuple[int, int]]:
        """Finds the plan of two shapes; yields pairs of shapes whose plans it needs first."""
        left, right = self.runs[a], self.runs[b]
        first, last, least = 0, 0, min(len(left), len(right))
        like = self.likes
        # Runs at both ends that are alike are paired first; only what differs between is compared.
        while first < least and like[left[first]] == like[right[first]]:
            first += 1
        while last < least - first and like[left[-1 - last]] == like[right[-1 - last]]:
            last += 1
        places = [(k, k) for k in range(first)] + [(len(left) - k, len(right) - k) for k in range(last, 0, -1)]
        by_like: dict[tuple, list[int]] = {}
        for j in range(first, len(right) - last):
            by_like.setdefault(like[right[j]], []).append(j)
        rows = [i for i in range(first, len(left) - last) if like[left[i]] in by_like]
        kinds = {r: dict.fromkeys(right[j] for j in by_like[like[r]]) for r in dict.fromkeys(left[i] for i in rows)}
        weights: dict[tuple[int, int], int] = {}
        for x, y in [*((left[i], right[j]) for i, j in places), *((x, y) for x, some in kinds.items() for y in some)]:
            if (x, y) not in weights:
                for pair in zip(self.members[x], self.members[y], strict=False):
                    if pair not in self.plans:
                        yield pair
                weights[x, y] = sum(self.plans[p][0] for p in zip(self.members[x], self.members[y], strict=False))
        score = 1 + sum(weights[left[i], right[j]] for i, j in places)
        for i, j in self._middle(rows, left, right, by_like, weights):
            score += weights[left[i], right[j]]
            places.append((i, j))
        self.plans[a, b] = score, places

    def _middle(self, rows: list[int], left: tuple[int, ...], right: tuple[int, ...], by_like: dict[tuple, list[int]], weights: dict[tuple[int, int], int]) -> list[tuple[int, int]]:
        likes = {self.likes[left[i]] for i in rows}
        columns = sorted(j for x in likes for j in by_like[x])
        cells = sum(len(by_like[self.likes[left[i]]]) for i in rows)
        if cells * CELL_SECONDS <= len(rows) * (ROW_SECONDS + len(columns) * PLACE_SECONDS):
            all_cells = [(i, j, weights[left[i], right[j]]) for i in rows for j in reversed(by_like[self.likes[left[i]]])]
            return [all_cells[k][:2] for k in chain(all_cells, len(right))]
        kinds, kind = np.unique([right[j] for j in columns], return_inverse=True)
        of_kind = {x: np.array([weights.get((x, y), 0) for y in kinds.tolist()], np.int64) for x in {left[i] for i in rows}}
        table = _Rows([of_kind[left[i]] for i in rows], kind)
        return [(rows[i], columns[j]) for i, j in row_chain(table)]


class _Rows:
    """Rows of weights by column, made when they are asked for from those by kind of column."""

    def __init__(self, by_kind: list[np.ndarray], kind: np.ndarray) -> None:
        self.by_kind, self.kind = by_kind, kind

    def __len__(self) -> int:
        return len(self.by_kind)

    def __getitem__(self, i):
        return [x[self.kind] for x in self.by_kind[i]] if isinstance(i, slice) else self.by_kind[i][self.kind]


def match(a: Node, b: Node, shapes: Shapes | None = None) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching: the most node pairs that keep names, order and ancestry.

    Of two nodes that are matched, the runs of like siblings at both ends are paired first, and of what
    differs between the heaviest chain of like runs counts, exactly, whatever its length.
    """
    shapes = shapes or Shapes()
    mine, theirs = shapes.of(a), shapes.of(b)
    score, _ = shapes.plan(mine[id(a)], theirs[id(b)])
    out, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        out.append((x, y))
        _, places = shapes.plan(mine[id(x)], theirs[id(y)])
        left, right = runs(x), runs(y)
        todo += reversed([pair for i, j in places for pair in zip(left[i], right[j], strict=False)])
    return score, out


def copy_of(node: Node, up: Node | None = None) -> tuple[Node, list[tuple[Node, Node]]]:
    """The blocks of a tree without texts, and pairs of (copy, node)."""

    def bare(x: Node, up: Node | None) -> Node:
        made = Node(x.name, up, {})
        made.words, made.like = x.words, x.like
        return made

    top = bare(node, up)
    pairs, todo = [(top, node)], [(top, node)]
    while todo:
        a, b = todo.pop()
        for x in b.blocks:
            c = bare(x, a)
            a.items.append(c)
            pairs.append((c, x))
            todo.append((c, x))
    return top, pairs


def grow(pairs: list[tuple[Node, Node]]) -> list[tuple[Node, Node]]:
    """Extends a model, given what of it a page was matched with, by the page's other nodes; pairs of all nodes."""
    twin, out = {id(b): a for a, b in pairs}, list(pairs)
    for a, b in pairs:
        theirs = b.blocks
        if all(id(x) in twin for x in theirs):
            continue
        place = {id(x): k for k, x in enumerate(a.items)}
        new: dict[int, list[Node]] = {}
        at = 0
        for x in theirs:
            if id(x) in twin:
                at = place[id(twin[id(x)])] + 1
            else:
                c, more = copy_of(x, a)
                new.setdefault(at, []).append(c)
                out += more
        a.items = [y for k in range(len(a.items) + 1) for y in [*new.get(k, ()), *a.items[k : k + 1]]]
    return out


def slot(node: Node) -> tuple[str, int]:
    """A block's own text with that of its inline elements, and how many characters of it stand in no link."""
    texts, links, todo = [], 0, [(x, False) for x in reversed(node.items)]
    while todo:
        x, linked = todo.pop()
        if isinstance(x, str):
            texts.append(x)
            links += len(x.strip()) * linked
        elif x.name in INLINE and not x.hidden():
            todo += [(y, linked or x.name == "a") for y in reversed(x.items)]
    text = SPACES.sub(" ", html.unescape("".join(texts))).strip()
    return text, max(len(text) - links, 0)


def is_main(node: Node) -> bool:
    return node.name == "main" or bool(node.keys) and node.keys.get("role", "").lower() == "main"


class Page:
    """A page's tree, its blocks in page order, their texts, and how much of these may be of an article."""

    def __init__(self, source: str) -> None:
        self.tree = parse(source)
        self.blocks, todo = [], [self.tree]
        while todo:
            x = todo.pop()
            self.blocks.append(x)
            todo += reversed(x.blocks)
        slots = [slot(x) for x in self.blocks]
        self.text = {id(x): t for x, (t, _) in zip(self.blocks, slots, strict=True)}
        self.open = self._open()
        closed: set[int] = set()
        self.weight = {}
        for x, (_, n) in zip(self.blocks, slots, strict=True):
            # A header's headings are those of an article, if it has one.
            shut = x.up is not None and id(x.up) in closed or not self.shown(x) or x.name == "header" and not self._in_article(x)
            if shut:
                closed.add(id(x))
            self.weight[id(x)] = 0 if shut else n

    def _open(self) -> set[int]:
        """What holds a main element or the longest article is not hidden by its class or role: names such as `sidebar-layout` are given to whole pages."""
        articles = [x for x in self.blocks if x.name == "article" and not x.hidden()]
        best = max(articles, key=lambda x: sum(len(t) for t in texts_below(x)), default=None) if len(articles) > 1 else articles[0] if articles else None
        found: set[int] = set()
        for x in [x for x in self.blocks if is_main(x)] + [best] * (best is not None):
            while x is not None and id(x) not in found:
                found.add(id(x))
                x = x.up
        return found

    def _in_article(self, x: Node | None) -> bool:
        while x is not None and x.name not in ("article", "main"):
            x = x.up
        return x is not None

    def shown(self, x: Node) -> bool:
        return not x.never_shown() if id(x) in self.open else not x.hidden()


def region(root: Node, weight: dict[int, float]) -> Node:
    """The subtree of a tree that holds its article, by the text that stands in its blocks."""
    blocks, todo = [], [root]
    while todo:
        x = todo.pop()
        blocks.append(x)
        todo += x.blocks
    below, headline = dict.fromkeys(map(id, blocks), 0.0), dict.fromkeys(map(id, blocks), False)
    for x in reversed(blocks):  # children come after their parents
        own = weight.get(id(x), 0)
        below[id(x)] += own
        headline[id(x)] |= x.name == "h1" and own > 0
        if x.up is not None and id(x.up) in below:
            below[id(x.up)] += below[id(x)]
            headline[id(x.up)] |= headline[id(x)]
    here = root
    while True:
        some = [x for x in here.blocks if below[id(x)] > 0]
        if not some:
            return here
        best = max(some, key=lambda x: below[id(x)])
        article = best.name == "article" or is_main(best) or "article" in (y.name for y in best.blocks if below[id(y)] > 0)
        alone = sum(x.like == best.like for x in some) == 1
        beside = any(headline[id(x)] for x in some if x is not best) and not headline[id(best)]
        enough = below[id(best)] >= (ARTICLE_SHARE if article else REGION_SHARE) * below[id(here)]
        if best.name not in CONTAINERS or not alone or beside or not enough:
            return here
        here = best


def texts_below(node: Node) -> list[str]:
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        out += [t for t in x.items if isinstance(t, str)]
        todo += x.elements
    return out


def text_of(root: Node, page: Page, template: set[int] = frozenset()) -> str:
    """The visible text of a tree; ends of blocks are spaces. `template` holds ids of blocks whose own text is dropped."""
    out: list[str] = []
    todo: list[tuple[Node | str, bool, bool]] = [(root, False, page._in_article(root))]
    while todo:
        x, title_only, inside = todo.pop()
        if isinstance(x, str):
            if not title_only:
                out.append(x)
            continue
        inside |= x.name == "article" or is_main(x)
        if x is not root and not page.shown(x):
            if x.name not in INLINE:
                out.append(" ")
            continue
        if x.name == "header":  # of an article, its headings are kept
            if not inside:
                continue
            title_only = True
        elif x.name in HEADINGS:
            title_only = False
        block = x.name not in INLINE
        if block:
            out.append(" ")
            todo.append((" ", False, inside))
        drop = id(x) in template
        todo += [(y, title_only, inside) for y in reversed(x.items) if not drop or isinstance(y, Node) and y.name not in INLINE]
    return SPACES.sub(" ", html.unescape("".join(out))).strip()


def extract_group(sources: list[str], aligned: bool = True) -> list[str]:
    """Main texts of same-host pages. Without `aligned` each page is a group of its own, which is what a test compares with."""
    if not aligned:
        return [extract_group([x])[0] for x in sources]
    # Copies count once, so a page that was stored often is no template by itself.
    pages = {x: Page(x) for x in sources}
    model, shapes = copy_of(next(iter(pages.values())).tree)[0], Shapes()
    pairs = {x: grow(match(model, page.tree, shapes)[1]) for x, page in pages.items()}
    seen = Counter((id(a), page.text[id(b)]) for x, page in pages.items() for a, b in pairs[x] if page.text[id(b)])
    weights: Counter[int] = Counter()
    fixed: dict[str, set[int]] = {}
    for x, page in pages.items():
        article = _below(page, lambda y: y.name == "article" or is_main(y))
        fixed[x] = set()
        for a, b in pairs[x]:
            least, share = ARTICLE_TEMPLATE if id(b) in article else TEMPLATE
            if seen[id(a), page.text[id(b)]] >= max(least, share * len(pages)):
                fixed[x].add(id(b))
            else:
                weights[id(a)] += page.weight[id(b)]
    best = region(model, weights)
    texts = {}
    for x, page in pages.items():
        own = {k: w for k, w in page.weight.items() if k not in fixed[x]}
        mine = next((b for a, b in pairs[x] if a is best), None)
        if mine is None or sum(own.get(k, 0) for k in _below(page, lambda y: y is mine)) < PAGE_SHARE * sum(own.values()):  # noqa: B023
            mine = region(page.tree, own)
        texts[x] = text_of(mine, page, fixed[x])
    return [texts[x] for x in sources]


def _below(page: Page, chosen: Callable[[Node], bool]) -> set[int]:
    """Ids of the blocks that are chosen, and of all below them."""
    out: set[int] = set()
    for x in page.blocks:
        if x.up is not None and id(x.up) in out or chosen(x):
            out.add(id(x))
    return out


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held, key, chars = [], None, 0

    def done() -> pd.DataFrame:
        texts = extract_group([r[3] or "" for r in held])
        return pd.DataFrame({"page_id": pd.array([r[1] for r in held], "Int64"), "url": [r[2] for r in held], "text": texts})

    for batch in batches:
        ids = [None if pd.isna(x) else int(x) for x in batch["page_id"]]
        for k, page_id, url, source in zip(batch["key"], ids, batch["url"], batch["html"], strict=True):
            if held and (k != key or len(held) >= GROUP_PAGES or chars >= GROUP_CHARS):
                yield done()
                held.clear()
                chars = 0
            key, chars = k, chars + len(source or "")
            held.append((k, page_id, url, source))
    if held:
        yield done()


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of `pages` (page_id, url, html).

    Null and empty pages have an empty text. A null or odd url counts as a host of its own name, so
    such pages are aligned with each other. Repeated rows stay. Pages are read whole, however long;
    broken markup gives the tree that its tags allow. An empty table gives no rows. Other columns
    are ignored.
    """
    text_batches(pages.sparkSession)
    host = F.lower(F.coalesce(F.regexp_extract(F.col("url"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"), host.alias("host"))
    sizes = cut_lineage(rows.groupBy("host").agg(F.count("*").alias("count"), F.sum(F.length("html")).alias("chars")))
    total, chars = sizes.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.sum("chars"), F.lit(0))).first()
    hot = {r["host"]: max(1, r["count"] // (8 * GROUP_PAGES)) for r in sizes.where(F.col("count") > max(total / HOT_SHARE, 8 * GROUP_PAGES)).collect()}
    salts = F.lit(1)
    if hot:
        salts = F.coalesce(F.create_map(*(F.lit(x) for kv in sorted(hot.items()) for x in kv))[F.col("host")], F.lit(1))
    keyed = rows.withColumn("key", F.concat_ws("\n", F.col("host"), F.pmod(F.xxhash64("page_id", "url"), salts).cast("string")))
    # Partitions follow the bytes; a key has at most some 512 pages, so none grows with the table.
    spark = pages.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(int(chars // PARTITION_CHARS) + 1, MAX_PARTITIONS))
    dealt = keyed.select("key", "page_id", "url", "html").repartition(n, "key").sortWithinPartitions("key", "page_id", "url", F.xxhash64("html"))
    out = dealt.mapInPandas(_groups, "page_id long, url string, text string")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


#: A plain reading of the generated pages: their one article, its blocks, and the references that occur in it.
SQL = r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS h FROM pages
), b AS (
  SELECT page_id, url, regexp_replace(regexp_replace(h, '(?s)</?(?:p|h1|br)(?:\s[^>]*)?>', ' ', 'g'), '(?s)<[^>]*>', '', 'g') AS t FROM a
), c AS (
  SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(t, '&#x27;', ''''), '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g') AS t FROM b
)
SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text, length(trim(regexp_replace(t, '\s+', ' ', 'g')))::BIGINT AS n_chars FROM c
"""
