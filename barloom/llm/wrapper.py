"""Main text of web pages by wrapper induction.

Pages of a host with the same outer elements are aligned with one of them, the pivot, by simple tree matching. Aligned
texts that say the same on most of the different pages are template. Of the slots that vary, the content region is the
innermost element that holds nearly all that the pages say outside of links, with all headings; what lies around it
(menus, adverts, footers, whose words may vary from page to page) is template too. Within the region, and on pages
without a wrapper, elements go that their tag, role, class or id marks as a menu, header, footer, sidebar, notice,
advert, form or comments. Only page skeletons (element names, text hashes and sizes) meet in the alignment.
"""

from __future__ import annotations

import html as _html
import re
from array import array
from bisect import bisect_right, insort
from collections.abc import Callable
from hashlib import blake2b
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, slices

#: A node is template if it says the same on this share of at least so many different pages of a host.
SHARE, PAGES = 0.8, 4
#: A region holds at least this share of what the element around it says outside of links.
REGION = 0.7
#: Elements of this depth count as texts of the element around them, which bounds the alignment's recursion.
DEPTH = 100
#: Levels whose elements make a page's layout.
OUTER = 3
#: Tables of up to so many pairs of children are kept whole; of larger ones some rows, from which the others are made again.
CELLS = 250_000
#: Pivots and wrappers of so many bytes are broadcast; more are joined by shuffle.
BROADCAST_BYTES = 8 << 20

# a tag without another `<` in it, which nearly all are; others are found step by step
_SIMPLE = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*+)([^<>\"']*+(?:(?:\"[^\"<>]*+\"|'[^'<>]*+')[^<>\"']*+)*+)>")
_PLAIN, _NAME_END = re.compile(r"[^>\"']*+"), re.compile(r"[\s/>]|\Z")
_ATTR = re.compile(r"([^\s=/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Fixed values of HTML: elements without content, with raw text, and those that break a line of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp".split())
BLOCK = frozenset(
    """address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hr html iframe li main menu nav noscript ol option p pre section select summary table tbody td template
    tfoot th thead title tr ul""".split()
)
_ENDS_P = BLOCK - frozenset("body button caption head html option tbody td tfoot th thead title tr".split())
_P, _TERMS, _CELLS, _LISTS = frozenset(("p",)), frozenset(("dt", "dd")), frozenset(("td", "th")), frozenset(("ul", "ol", "dl", "table", "select"))
_CLOSES = {"li": frozenset(("li",)), "dt": _TERMS, "dd": _TERMS, "tr": _CELLS | {"tr"}, "td": _CELLS, "th": _CELLS, "option": frozenset(("option",))}
_SCOPE = frozenset("html body div article section main table td th ul ol dl nav aside header footer form blockquote".split())
# What is no main text by its element, role, or a word of its class or id.
DROPPED = frozenset("head nav footer aside form script style noscript template iframe svg canvas object button select textarea input dialog menu title".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
DROPPED_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices
    alert newsletter subscribe subscription signup login sidebar side rail menu nav navbar navigation breadcrumb breadcrumbs footer masthead
    comment comments disqus respond reply replies discussion share sharing social related recommended popup modal overlay widget toolbar
    pagination pager search skip""".split()
)
_WORD = re.compile(r"[a-z]+")
_ODD = re.compile(r"[^\w-]+")
_DIGITS = re.compile(r"\d+")
# Fixed values of HTML: headings, and elements that group others.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
GROUPS = frozenset("html body main article section div td table tbody tr center form".split())


class Node:
    __slots__ = ("children", "linked", "main", "name", "off", "tag", "text")

    def __init__(self, tag: str, off: int, main: bool, name: str = ""):
        self.tag, self.off, self.main, self.name = tag, off, main, name or tag
        self.children: list = []
        self.text, self.linked = "", 0


#: Why an element is dropped: by a word of its class or id, which a main element inside outdoes, or by more than that.
BY_WORD, FOR_GOOD = 1, 2


def _marks(tag: str, attrs: str, parent: Node) -> tuple[int, bool, str]:
    """Whether the element is dropped, whether it lies in a main element, and its name: tag, class and id."""
    main = parent.main or tag in ("article", "main")
    off = parent.off
    if off == BY_WORD and tag in ("article", "main"):
        off = 0
    if tag in DROPPED or (tag == "header" and not parent.main):
        off = FOR_GOOD
    name = tag
    if attrs:
        for key, *values in _ATTR.findall(attrs):
            key, value = key.lower(), "".join(values).lower()
            if key in ("class", "id"):
                name += "." + _ODD.sub("_", _DIGITS.sub("0", value))
                found = DROPPED_WORDS.intersection(_WORD.findall(value))
                if tag == "article" and {"comment", "comments", "reply"} & found:
                    off = FOR_GOOD
                elif found and tag not in ("html", "body", "article", "main"):
                    off = off or BY_WORD
            elif key == "role":
                if value in DROPPED_ROLES:
                    off = FOR_GOOD
                main = main or value in ("main", "article")
            elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "")):
                off = FOR_GOOD
    return off, main, name


class _Tokens:
    """Tags and comments of a page, each found once however the page is broken."""

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.name_end, self.dead = -1, []  # stretches outside of quotes from which no tag ends, ascending

    def after(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """(start, end, closing, name, attributes) of the first one from a place on; places ascend. Comments and declarations have no name."""
        page = self.page
        while (at := page.find("<", at)) >= 0:
            if m := _SIMPLE.match(page, at):
                return at, m.end(), m[1] != "", m[2].lower(), m[3]
            then = page[at + 1 : at + 3]
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                return at, len(page) if end < 0 else end + 3, False, "", ""
            if at > self.last:  # only a comment needs no end
                at = page.find("<!--", at)
                return None if at < 0 else (at, len(page), False, "", "")
            if then[:1] in ("!", "?"):
                return at, page.find(">", at) + 1, False, "", ""
            closing = then[0] == "/"
            if _is_letter(then[1:] if closing else then[0]):
                start = at + 1 + closing
                if self.name_end < start:
                    self.name_end = _NAME_END.search(page, start).start()
                stop = self.name_end
                if (end := self._end(stop)) >= 0:
                    return at, end + 1, closing, page[start:stop].lower(), page[stop:end]
            at += 1
        return None

    def _end(self, at: int) -> int:
        """The place of the `>` that ends a tag whose attributes begin at a place, outside of quotes; -1 if there is none."""
        page, seen = self.page, []
        while True:
            k = bisect_right(self.dead, (at, len(page))) - 1
            if k >= 0 and at <= self.dead[k][1]:
                break
            stop = _PLAIN.match(page, at).end()
            seen.append((at, stop))
            if stop == len(page):
                break
            if page[stop] == ">":
                return stop
            at = page.find(page[stop], stop + 1) + 1
            if not at:
                break
        for stretch in seen:
            insort(self.dead, stretch)
        return -1


def _is_letter(c: str) -> bool:
    return "a" <= c <= "z" or "A" <= c <= "Z"


class _Stack:
    """Open elements, and where those of each tag lie."""

    def __init__(self, root: Node):
        self.nodes, self.places = [root], {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def find(self, tags: frozenset) -> int:
        """The innermost element of one of tags; 0 if there is none."""
        found = 0
        for tag in tags:
            own = self.places.get(tag)
            if own and own[-1] > found:
                found = own[-1]
        return found

    def cut(self, at: int) -> None:
        for node in self.nodes[at:]:
            self.places[node.tag].pop()
        del self.nodes[at:]


def parse(page: str) -> Node:
    """Tree of a page's block elements; inline elements melt into their block, whose texts are nodes of tag ''."""
    root = Node("html", 0, False)
    stack, text = _Stack(root), []
    link, linked = False, 0

    def flush() -> None:
        nonlocal linked
        if text:
            said = " ".join(_html.unescape("".join(text)).split())
            text.clear()
            if said:
                top = stack.nodes[-1]
                leaf = Node("", top.off, top.main)
                leaf.text, leaf.linked = said, min(linked, len(said))
                top.children.append(leaf)
            linked = 0

    def close(tags: frozenset, scope: frozenset) -> None:
        """Close the innermost of tags and all in it, unless an element of scope lies in it."""
        at = stack.find(tags)
        if at and at > stack.find(scope):
            flush()
            stack.cut(at)

    at, low, tokens = 0, None, _Tokens(page)
    while token := tokens.after(at):
        start, end, closing, tag, attrs = token
        if start > at:
            text.append(page[at:start])
            if link:
                linked += start - at
        at = end
        if not tag:
            continue
        if tag == "a":
            link = not closing
        if closing:
            if tag in BLOCK or tag in DROPPED:
                close(frozenset((tag,)), frozenset())
            continue
        if tag in ("br", "wbr"):
            text.append(" " if tag == "br" else "")
            continue
        if tag not in BLOCK and tag not in DROPPED:
            off, *_ = _marks(tag, attrs, stack.nodes[-1])
            if not off or stack.nodes[-1].off or tag in VOID:
                continue
        if tag in _ENDS_P:
            close(_P, _SCOPE)
        if tag in _CLOSES:
            close(_CLOSES[tag], _LISTS)
        flush()
        node = Node(tag, *_marks(tag, attrs, stack.nodes[-1]))
        stack.nodes[-1].children.append(node)
        if tag in RAW:
            low = page.lower() if low is None else low
            if len(low) != len(page):
                low = page
            end = low.find("</" + tag, at)
            at = len(page) if end < 0 else end
            continue
        if tag not in VOID and not attrs.endswith("/"):
            stack.push(node)
    if at < len(page):
        text.append(page[at:])
    flush()
    return root


def _hash(said: str) -> int:
    return int.from_bytes(blake2b(said.encode(), digest_size=8).digest(), "big", signed=True)


def texts_of(root: Node) -> list[tuple[Node, str]]:
    """(text, path) in page order; a path has the names of the elements from the root, at most DEPTH of them."""
    stack, out = [(root, "", 0)], []
    while stack:
        node, path, depth = stack.pop()
        if node.tag == "":
            out.append((node, path))
        elif node.children:
            own = f"{path}/{node.name}" if depth < DEPTH else path
            stack += [(c, own, depth + 1) for c in reversed(node.children)]
    return out


def layout(root: Node) -> int:
    """A hash of the set of paths of all elements of the first OUTER levels."""
    found, level = set(), [(root, "")]
    for _ in range(OUTER):
        level = [(c, f"{path}/{c.name}") for node, path in level for c in node.children if c.tag]
        found.update(path for _, path in level)
    return _hash(" ".join(sorted(found)))


def pack_tree(root: Node) -> str:
    """The tree's element names with their texts as (hash of path and text, size, size outside of links)."""
    out: list[str] = []
    stack: list = [(root, "", 0)]
    while stack:
        item = stack.pop()
        if item is None:
            out.append(")")
            continue
        node, path, depth = item
        if node.tag == "":
            out.append(f"#{_hash(path + ' ' + node.text)},{len(node.text)},{len(node.text) - node.linked} ")
            continue
        own = path
        if depth < DEPTH:
            own = f"{path}/{node.name}"
            out.append(node.name + "(")
            stack.append(None)
        stack += [(c, own, depth + 1) for c in reversed(node.children)]
    return "".join(out)


class Tree:
    """An unpacked node: name ('' for a text), hash, sizes, children, number in page order."""

    __slots__ = ("children", "heading", "key", "name", "number", "open")

    def __init__(self, name: str, key: int, size: int, number: int):
        self.name, self.key, self.open, self.number = name, key, size, number
        self.heading = 0
        self.children: list[Tree] = []


_PACKED = re.compile(r"#(-?\d+),\d+,(\d+) |([^()#]+)\(|\)")


def unpack_tree(said: str) -> Tree:
    """The tree of pack_tree; each element's open is what it says outside of links, heading what of that in headings."""
    root = Tree("", 0, 0, -1)
    stack, number = [root], 0
    for m in _PACKED.finditer(said):
        if m[2]:
            stack[-1].children.append(Tree("", int(m[1]), int(m[2]), number))
            stack[-1].open += int(m[2])
        elif m[3]:
            node = Tree(m[3], 0, 0, number)
            stack[-1].children.append(node)
            stack.append(node)
        else:
            node = stack.pop()
            if node.name.partition(".")[0] in HEADINGS:
                node.heading = node.open
            stack[-1].open += node.open
            stack[-1].heading += node.heading
            continue
        number += 1
    return root.children[0]


def _said(u: Tree) -> list[int]:
    """Hashes of all texts of a tree."""
    return [u.key] if u.name == "" else [key for c in u.children for key in _said(c)]


def _form(u: Tree, keys: frozenset) -> str:
    """Names of a tree's elements in their order, and the hashes of its texts that are among keys."""
    if u.name == "":
        return f"#{u.key}" if u.key in keys else "#"
    return f"{u.name}({''.join(_form(c, keys) for c in u.children)})"


def _numbered(names: list) -> tuple[np.ndarray, list[int]]:
    """Numbers of names as they first appear, and the places of these."""
    found: dict = {}
    number = np.array([found.setdefault(x, len(found)) for x in names], np.int64)
    return number, np.unique(number, return_index=True)[1].tolist()


class _Wide:
    """The table of many children, of which every some rows are kept and those between made again; total is its last entry.

    Children of one form, in which texts that are not on both sides are alike, have a row of weights in common. Where
    two children share no text but such as many hold, their weight is that of their elements and those texts.
    """

    def __init__(self, x: list[Tree], y: list[Tree], keys: frozenset | None):
        self.x, self.y = x, y
        both = frozenset(k for u in x for k in _said(u)).intersection(k for v in y for k in _said(v))
        both = both if keys is None else both & keys
        self.kind = [_form(u, both) for u in x]
        self.of, self.kinds = _numbered([_form(v, both) for v in y])
        holders: dict[int, list[int]] = {}
        for n, j in enumerate(self.kinds):
            for key in both.intersection(_said(y[j])):
                holders.setdefault(key, []).append(n)
        many = frozenset(key for key, own in holders.items() if len(own) > isqrt(len(self.kinds)))
        self.holders = {key: own for key, own in holders.items() if key not in many}
        self.shape = [_form(u, many) for u in x]
        self.shape_of, self.shapes = _numbered([_form(y[j], many) for j in self.kinds])
        (self.tables, self.weight), (self.bare_tables, self.bare) = _weigher(both), _weigher(many)
        self.bases: dict[str, np.ndarray] = {}
        self.rows: dict[str, np.ndarray] = {}
        self.every = max(1, isqrt(len(x)))
        above = np.zeros(len(y) + 1, np.int32)
        self.kept = [above]
        for i in range(len(x)):
            above = self._next(above, i)
            if (i + 1) % self.every == 0:
                self.kept.append(above)
        self.total = int(above[-1])

    def _weights(self, i: int) -> np.ndarray:
        found = self.rows.get(self.kind[i])
        if found is None:
            u, base = self.x[i], self.bases.get(self.shape[i])
            if base is None:
                base = np.array([self.bare(u, self.y[self.kinds[n]]) for n in self.shapes], np.int32)[self.shape_of]
                self.bare_tables.clear()
                if len(self.bases) >= 64:
                    self.bases.clear()
                self.bases[self.shape[i]] = base
            found = base.copy()
            for n in {n for key in _said(u) for n in self.holders.get(key, ())}:
                found[n] = self.weight(u, self.y[self.kinds[n]])
                self.tables.clear()
            if len(self.rows) >= 64:
                self.rows.clear()
            self.rows[self.kind[i]] = found
        return found[self.of]

    def _next(self, above: np.ndarray, i: int) -> np.ndarray:
        row = above.copy()
        np.maximum(above[1:], above[:-1] + self._weights(i), out=row[1:])
        return np.maximum.accumulate(row)

    def __getitem__(self, i: int) -> np.ndarray:
        """Row i; asked from the last one on, rows between two kept ones are made once."""
        block = i // self.every
        if getattr(self, "block", None) != block:
            made = [self.kept[block]]
            for k in range(block * self.every, min((block + 1) * self.every - 1, len(self.x))):
                made.append(self._next(made[-1], k))
            self.block, self.made = block, made
        return self.made[i - block * self.every]


def _weigher(keys: frozenset | None = None) -> tuple[dict, Callable[[Tree, Tree], int]]:
    """The tables made so far, by the ids of two elements, and the function that weighs two trees. keys: no other texts are equal."""
    tables: dict[tuple[int, int], tuple] = {}

    def weight(u: Tree, v: Tree) -> int:
        if u.name != v.name:
            return 0
        if u.name == "":
            return 2 if u.key == v.key and (keys is None or u.key in keys) else 1
        x, y = u.children, v.children
        if not x or not y:
            return 1
        if len(x) == 1 and len(y) == 1:
            return 1 + weight(x[0], y[0])
        known = tables.get((id(u), id(v)))
        if known is None:
            known = tables[id(u), id(v)] = table(x, y)
        return 1 + known[0]

    def table(x: list[Tree], y: list[Tree]) -> tuple:
        if len(x) * len(y) > CELLS:
            wide = _Wide(x, y, keys)
            return wide.total, wide
        above = array("i", bytes(4 * (len(y) + 1)))
        rows = [above]
        for u in x:
            row, best = array("i", above), 0
            for j, v in enumerate(y):
                w = above[j] + weight(u, v) if u.name == v.name else 0
                best = max(best, w, above[j + 1])
                row[j + 1] = best
            rows.append(row)
            above = row
        return above[len(y)], rows

    return tables, weight


def match(a: Tree, b: Tree) -> tuple[int, list[tuple[Tree, Tree]]]:
    """Simple tree matching: weight and pairs of a heaviest order-preserving match of two trees whose roots have one name.

    A pair of nodes has equal names and matched parents; it weighs 1, a pair of equal texts 2.
    """
    tables, weight = _weigher()
    total, pairs, todo = weight(a, b), [], [(a, b)] if a.name == b.name else []
    while todo:
        u, v = todo.pop()
        pairs.append((u, v))
        x, y = u.children, v.children
        if not x or not y:
            continue
        if len(x) == 1 and len(y) == 1:
            if x[0].name == y[0].name:
                todo.append((x[0], y[0]))
            continue
        weight(u, v)  # the tables within a wide element's children were not kept
        found = tables[id(u), id(v)][1]
        i, j = len(x), len(y)
        while i and j:
            if found[i][j] == found[i - 1][j]:
                i -= 1
            elif found[i][j] == found[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                todo.append((x[i], y[j]))
    return total, pairs


def region(pivot: Tree, said: dict[int, tuple[float, float]]) -> str:
    """Path of the content region: from the root on, the group that holds nearly all of what is said and all headings.

    said has, by the number of a pivot's element, what the pages say in it outside of links, and in headings.
    """
    node, path = pivot, "/" + pivot.name
    while True:
        total, heading = said.get(node.number, (0, 0))
        best = max((c for c in node.children if c.name), key=lambda c: (said.get(c.number, (0, 0)), -c.number), default=None)
        if best is None or best.name.partition(".")[0] not in GROUPS:
            return path
        own, inside = said.get(best.number, (0, 0))
        beside = any(c.name.partition(".")[0] == "p" and said.get(c.number, (0, 0))[0] > 0 for c in node.children)
        if beside or own < REGION * total or own == 0 or inside < 0.98 * heading:
            return path
        node, path = best, f"{path}/{best.name}"


def _parsed(batches):
    for part in slices(batches, "html"):
        layouts, prints, trees, texts, paths, keys, kept = [], [], [], [], [], [], []
        for page in part.column("html").to_pylist():
            root = parse(page or "")
            found = texts_of(root)
            layouts.append(layout(root))
            prints.append(_hash("\n".join(n.text for n, _ in found)) if found else None)
            trees.append(pack_tree(root))
            texts.append([n.text for n, _ in found])
            paths.append([path + "/" for _, path in found])
            keys.append([_hash(path + " " + n.text) for n, path in found])
            main = any(n.main and not n.off for n, _ in found)
            kept.append([not n.off and (n.main or not main) for n, _ in found])
        columns = [pa.array(layouts, pa.int64()), pa.array(prints, pa.int64()), pa.array(trees, pa.string()), pa.array(texts, pa.list_(pa.string())), pa.array(paths, pa.list_(pa.string())), pa.array(keys, pa.list_(pa.int64())), pa.array(kept, pa.list_(pa.bool_()))]
        yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("page_id", "url", "host")), *columns], names=["page_id", "url", "host", "layout", "print", "tree", "texts", "paths", "keys", "kept"])


def _aligned(batches):
    """Per page and pivot's node: for an element what the page says there, for a text its hash if both say the same."""
    pivots: dict[str, Tree] = {}
    for part in slices(batches, "tree"):
        out: list[tuple] = []
        for h, own, tree, pivot in zip(*(part.column(c).to_pylist() for c in ("host", "layout", "tree", "pivot")), strict=True):
            if pivot not in pivots:
                if len(pivots) > 1000:
                    pivots.clear()
                pivots[pivot] = unpack_tree(pivot)
            same = set()
            for a, b in match(unpack_tree(tree), pivots[pivot])[1]:
                if a.name:
                    out.append((h, own, b.number, None, a.open, a.heading))
                elif a.key == b.key:
                    same.add(a.key)
            out += [(h, own, -1, key, 0, 0) for key in same]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * 6, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=["host", "layout", "slot", "key", "open", "heading"])


def _wrapped(batches):
    for batch in batches:
        regions, constant = [], []
        for pivot, pages, stats in zip(*(batch.column(c).to_pylist() for c in ("pivot", "pages", "stats")), strict=True):
            said = {r["slot"]: (r["open"], r["heading"]) for r in stats if r["slot"] >= 0}
            regions.append(region(unpack_tree(pivot), said) + "/")
            constant.append([r["key"] for r in stats if r["slot"] < 0 and r["n"] >= SHARE * pages])
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("layout"), pa.array(regions, pa.string()), pa.array(constant, pa.list_(pa.int64()))], names=["host", "layout", "region", "constant"])


def _small(df: DataFrame, size: F.Column) -> DataFrame:
    """df, written, marked for broadcast if its size in bytes is small."""
    df = materialize(df, "wrappers")
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES else df


def wrappers(parsed: DataFrame) -> DataFrame:
    """Rows (host, layout, region, constant): the region's path and the hashes of the texts that are template.

    Equal pages count once, empty ones not at all; hosts' layouts with fewer than PAGES different pages have none.
    """
    trees = parsed.where("host is not null and print is not null").groupBy("host", "layout", "print").agg(F.min("tree").alias("tree"))
    trees = materialize(trees, "trees", "zstd")
    key, size = ["host", "layout"], F.length("tree")
    sizes = trees.groupBy(key).agg((F.sum(size) / F.count("*")).alias("mean"), F.count("*").alias("pages")).where(F.col("pages") >= PAGES)
    usual = F.struct(F.abs(size - F.col("mean")), "tree")
    pivots = trees.join(_small(sizes, F.length("host") + 24), key).groupBy(*key, "pages").agg(F.min_by("tree", usual).alias("pivot"))
    pivots = _small(pivots, F.length("pivot") + F.length("host") + 16)
    rows = trees.join(pivots, key).select("host", "layout", "tree", "pivot").mapInArrow(_aligned, "host string, layout long, slot int, key long, open long, heading long")
    stats = rows.groupBy(*key, "slot", "key").agg(F.count("*").alias("n"), F.sum("open").alias("open"), F.sum("heading").alias("heading"))
    # a pivot's nodes and texts bound the rows of a group
    stats = stats.groupBy(key).agg(F.collect_list(F.struct("slot", "key", "n", "open", "heading")).alias("stats"))
    return stats.join(pivots, key).select("host", "layout", "pivot", "pages", "stats").mapInArrow(_wrapped, "host string, layout long, region string, constant array<long>")


def extract(pages: DataFrame, rules: bool = True) -> DataFrame:
    """Rows (page_id, url, text, n_chars), one per page.

    pages needs page_id, url and html; other columns are ignored. A null or empty html gives an empty text. Pages
    without a host in their url, and of a host's layouts with fewer than PAGES different pages, have no wrapper: their
    dropped elements alone go. Repeated rows are extracted each and count once in the wrapper. Where the wrapper would
    leave nothing of what the element rules keep, they alone decide. rules=False leaves them out where a wrapper is.
    """
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    pages = pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url", "cast(html as string) html").withColumn("host", F.when(host != "", host))
    schema = "page_id long, url string, host string, layout long, print long, tree string, texts array<string>, paths array<string>, keys array<long>, kept array<boolean>"
    parsed = materialize(pages.mapInArrow(_parsed, schema), "pages", "zstd")
    found = _small(wrappers(parsed), F.length("region") + F.length("host") + 8 * F.size("constant") + 16)
    rows = parsed.select("page_id", "url", "host", "layout", "texts", "paths", "keys", "kept").join(found, ["host", "layout"], "left")
    number = F.sequence(F.lit(0), F.size("texts") - 1)
    number = F.when(F.size("texts") > 0, number).otherwise(F.array().cast("array<int>"))
    inside = lambda i: F.startswith(F.get("paths", i), F.col("region")) & ~F.array_contains("constant", F.get("keys", i))
    by_rules = F.filter(number, lambda i: F.get("kept", i))
    by_both = F.filter(number, lambda i: (F.get("kept", i) if rules else F.lit(True)) & inside(i))
    rows = rows.select("page_id", "url", "texts", F.when(F.col("region").isNull(), by_rules).otherwise(F.when(F.size(by_both) > 0, by_both).otherwise(by_rules)).alias("own"))
    text = F.array_join(F.transform("own", lambda i: F.get("texts", i)), "\n")
    return rows.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
