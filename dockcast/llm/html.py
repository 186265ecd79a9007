"""HTML extraction (operator 10): wrappers by union-free regular-expression inference.

A page is read as a stream of tags and texts; implied end tags are closed, so the stream
nests.  The pages of one host are aligned one after another with the host's wrapper, a
union-free regular expression over the same tokens:

* equal neighbours, single or in groups of two or three, become one repeated group ``( )+``,
* tokens that only one side has become optional ``( )?``,
* texts that differ become slots, texts that agree stay template text.

Alignment is a longest common subsequence of sibling labels, then the same inside each
pair.  As merging wrappers is the same step, every task merges what it reads of a host, and
those partial wrappers are merged in two rounds (parts of a host, then the host), so no task
holds a host's pages.  The pages of a host have a wrapper
for each kind: with text inside ``article`` or ``main`` (or what is named so), or without.  From
the finished wrapper the places of the main text are chosen: inside that container for pages
that have it, in the whole body for the others, both without template text and lists of links
(in a container only what three pages or more agree on, and only on a page whose own text there is
longer than what would be left out: else the shared text is the article, mirrored); never inside menus, headers and footers of
the page, sidebars, notices, adverts, forms, scripts, styles or comments, by tag and by the
words of class, id and role.

Defined cases: null html is empty; null or unreadable urls are one host of their own; text
outside any tag is body text; unclosed comments, scripts and tags run to the end; where a quote
in a tag is never closed, that tag and those up to the quote end at their next ``>``; a page may nest as deep and have
as many siblings as its length allows (time linear in a page's length, but for the alignment of up to ``CELLS``
pairs of siblings at a time); repeated rows are extracted each; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import html as entities
import json
import re
import sys
from bisect import bisect_left
from collections import Counter
from contextlib import contextmanager

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import checked_join, materialise

# Element names of HTML by their role.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s",
          "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var"}
DROPPED = {"head", "script", "style", "noscript", "template", "iframe", "svg", "object", "nav", "footer", "aside", "form", "button",
           "select", "textarea", "dialog", "menu", "title"}
MAIN = {"article", "main"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
ENDS_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5",
          "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
SCOPES = {"article", "aside", "body", "div", "dl", "footer", "form", "header", "html", "main", "nav", "ol", "section", "table", "td", "th", "ul"}
# Words of class, id and role that name what is not the article, and what is.
AWAY = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
        "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "login", "menu", "modal", "nav", "navbar",
        "navigation", "newsletter", "notice", "notices", "popup", "promo", "promoted", "promotion", "related", "replies", "search", "share",
        "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
PAGE_HEAD = {"header", "masthead", "banner", "topbar"}
NAMED_MAIN = {"article", "main", "content", "post", "entry", "story"}

HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
_OPENING = re.compile(r"<(?:(!--)|([!?])|(/?)([A-Za-z][A-Za-z0-9:-]*))")
_VALUES = re.compile(r"(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+")
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[A-Za-z]+")
# Pages that must agree on a text inside the container before it counts as the host's.
AGREE = 3
# Partial wrappers of a host are merged in this many parts first.
PARTS = 16
# Cells of an alignment table; longer lists of siblings are split first.
CELLS = 1 << 20
# Calls a tree may need: a tag takes three characters at least, so this holds for pages of 3 MB of opening tags alone.
DEPTH = 4_000_000
# Hosts whose wrappers one task keeps before it passes them on.
HELD_HOSTS = 2000


def _label(tag: str, attributes: str) -> str:
    """An element's token: its tag and the words of its class, id and role."""
    if not attributes or "=" not in attributes:
        return tag
    found = sorted({w.lower() for m in _NAMED.finditer(attributes) for w in _WORDS.findall(next(x for x in m.groups() if x is not None))
                    if len(w) < 25} if "=" in attributes else ())
    return f"{tag}.{'.'.join(found)}" if found else tag


class Tags:
    """The tags of a page in order, in time linear in its length.

    A ``>`` inside a quoted value does not end a tag.  Where a quote is never closed, the
    tags before it end at their next ``>`` instead: such a tag is looked through once for
    each kind of quote, not again from every tag that follows.
    """

    def __init__(self, page: str):
        self.page, self.plain_until = page, 0

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, "/" or "", tag or "", attributes) of the first tag from ``at``; comments and the like have no tag."""
        page = self.page
        m = _OPENING.search(page, at)
        if not m:
            return None
        start = m.start()
        if m.group(1) or m.group(2):
            close, width = ("-->", 3) if m.group(1) else (">", 1)
            end = page.find(close, m.end())
            return start, len(page) if end < 0 else end + width, "", "", ""
        if start >= self.plain_until:
            end = _VALUES.match(page, m.end()).end()
            if end < len(page) and page[end] != ">":
                self.plain_until = end                          # a quote opens here and is never closed
        if start < self.plain_until:
            end = page.find(">", m.end())
            end = len(page) if end < 0 else end
        return start, min(end + 1, len(page)), m.group(3), m.group(4).lower(), page[m.end():end]


def read_page(page: str) -> list:
    """The page's tree: nodes ``[label, children]``; a text is a string, ``None`` is a line break; inline tags leave their texts."""
    root = ["#root", []]
    stack, at, n = [root], 0, len(page)
    open_tags: Counter = Counter()
    tags = Tags(page)

    def text(s):
        if s:
            stack[-1][1].append(entities.unescape(s))

    def close_to(names, stop):
        """Close the innermost open element of ``names``, unless one of ``stop`` is inside."""
        if not any(open_tags[t] for t in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            name = stack[i][0].partition(".")[0]
            if name in names:
                for node in stack[i:]:
                    open_tags[node[0].partition(".")[0]] -= 1
                del stack[i:]
                return
            if name in stop:
                return
    while at < n:
        found = tags.next(at)
        if not found:
            text(page[at:])
            break
        start, end, closing, tag, attributes = found
        text(page[at:start])
        at = end
        if not tag:
            continue
        if tag in INLINE:
            if tag == "a" and not closing:
                stack[-1][1].append(True)               # a link starts
            elif tag == "a":
                stack[-1][1].append(False)              # and ends
            continue
        if closing:
            close_to({tag}, set())
            continue
        if tag == "br":
            stack[-1][1].append(None)
            continue
        if tag in ENDS_P:
            close_to({"p"}, SCOPES)
        if tag in CLOSES:
            close_to(CLOSES[tag], {"ul", "ol", "dl", "table", "select"})
        if tag in VOID:
            continue
        node = [_label(tag, attributes), []]
        stack[-1][1].append(node)
        if tag in RAW:
            last = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            if tag in ("title", "textarea"):
                node[1].append(entities.unescape(page[at:last.start() if last else n]))
            at = last.end() if last else n
        elif not attributes.rstrip().endswith("/"):
            stack.append(node)
            open_tags[tag] += 1
    return root


def runs(children: list):
    """Children of a node with neighbouring texts joined: nodes, or (text, whether all of it is links)."""
    parts, plain, linked, link = [], False, False, False
    for c in [*children, ["", None]]:
        if isinstance(c, bool):
            link = c
        elif c is None:
            parts.append(" ")
        elif isinstance(c, str):
            parts.append(c)
            if c.strip():
                linked, plain = linked or link, plain or not link
        else:
            s = " ".join("".join(parts).split())
            if s:
                yield s, linked and not plain
            parts, plain, linked = [], False, False
            if c[1] is not None:
                yield c


# A wrapper item is [label, optional, repeated, children, text]: text items have the label "#" (or "#a" for
# texts that are all links) and their template text, or None once they are slots.
def page_wrapper(node: list) -> list:
    items = []
    for c in runs(node[1]):
        if isinstance(c, tuple):
            items.append(["#a" if c[1] else "#", False, False, [], c[0]])
        else:
            items.append(page_wrapper(c))
    return [node[0], False, False, fold(items), None]


def flat(item: list) -> list:
    """A wrapper as a list of items with the number of their children, parents first: JSON of any depth."""
    out, todo = [], [item]
    while todo:
        label, optional, repeated, children, text = todo.pop()
        out.append([label, optional, repeated, len(children), text])
        todo += reversed(children)
    return out


def nested(items: list) -> list:
    """The wrapper that ``flat`` wrote."""
    root = None
    open_: list = []                                     # (item, children still to come)
    for label, optional, repeated, n, text in items:
        item = [label, optional, repeated, [], text]
        if root is None:
            root = item
        else:
            open_[-1][0][3].append(item)
            open_[-1][1] -= 1
        if n:
            open_.append([item, n])
        while open_ and not open_[-1][1]:
            open_.pop()
    return root


@contextmanager
def deep():
    """Room for trees as deep as pages are long: plain Python calls, whose frames are not on the C stack."""
    before = sys.getrecursionlimit()
    sys.setrecursionlimit(max(before, DEPTH))
    try:
        yield
    finally:
        sys.setrecursionlimit(before)


def fold(items: list) -> list:
    """Neighbouring equal groups of one, two or three items become one repeated group."""
    for size in (1, 2, 3):
        out, i = [], 0
        while i < len(items):
            j = i + size
            group = items[i:j]
            labels = [g[0] for g in group]
            while len(group) == size and [g[0] for g in items[j:j + size]] == labels and (size == 1 or len(set(labels)) > 1):
                group = [merge(a, b) for a, b in zip(group, items[j:j + size])]
                j += size
            if j == i + size:                            # nothing repeats here
                out.append(items[i])
                i += 1
            elif size == 1:
                group[0][2] = True
                out += group
                i = j
            else:
                out.append([f"({','.join(labels)})", False, True, group, None])
                i = j
        items = out
    return items


def merge(a: list, b: list) -> list:
    """The wrapper of everything that either of two wrappers with one label stands for."""
    text = a[4] if a[4] == b[4] else None
    return [a[0], a[1] or b[1], a[2] or b[2], align(a[3], b[3]), text]


def align(x: list, y: list) -> list:
    """Siblings aligned by a longest common subsequence of labels; the others become optional."""
    if not x and not y:
        return []
    if [i[0] for i in x] == [i[0] for i in y]:
        return [merge(a, b) for a, b in zip(x, y)]
    n, m = len(x), len(y)
    out, i, j = [], 0, 0
    if n * m > CELLS:
        for a, b in [*_matches([v[0] for v in x], [v[0] for v in y]), (n, m)]:
            out += [[v[0], True, *v[2:]] for v in x[i:a]] + [[v[0], True, *v[2:]] for v in y[j:b]]
            if a < n:
                out.append(merge(x[a], y[b]))
            i, j = a + 1, b + 1
        return fold(out) if len(out) > max(n, m) else out
    best = _table([v[0] for v in x], [v[0] for v in y])
    while i < n or j < m:
        if i < n and j < m and x[i][0] == y[j][0]:
            out.append(merge(x[i], y[j]))
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            out.append([x[i][0], True, *x[i][2:]])
            i += 1
        else:
            out.append([y[j][0], True, *y[j][2:]])
            j += 1
    return fold(out) if len(out) > max(n, m) else out


def _table(x: list, y: list) -> list[list[int]]:
    """Lengths of the longest common subsequences of all ends of ``x`` and ``y``."""
    n, m = len(x), len(y)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[i] == y[j] else max(best[i + 1][j], best[i][j + 1])
    return best


def _matches(x: list, y: list) -> list[tuple[int, int]]:
    """Index pairs of equal labels, rising in both, of lists too long for one table.

    Equal ends are matched first; labels that are unique on both sides are matched by a
    longest rising run and split the rest; a piece small enough is matched by its table,
    one without such labels from left to right.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and x[a] == y[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and x[b - 1] == y[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        n, m = b - a, d - c
        if not n or not m:
            continue
        if n * m <= CELLS:
            best, i, j = _table(x[a:b], y[c:d]), 0, 0
            while i < n and j < m:
                if x[a + i] == y[c + j]:
                    out.append((a + i, c + j))
                    i, j = i + 1, j + 1
                elif best[i + 1][j] >= best[i][j + 1]:
                    i += 1
                else:
                    j += 1
            continue
        once = [{v: k for k, v in enumerate(s[lo:hi], lo)} for s, lo, hi in ((x, a, b), (y, c, d))]
        counts = [Counter(x[a:b]), Counter(y[c:d])]
        anchors = _rising([(i, once[1][v]) for v, i in once[0].items() if counts[0][v] == 1 and counts[1].get(v) == 1])
        if anchors:
            out += anchors
            edges = [(a - 1, c - 1), *anchors, (b, d)]
            todo += [(i + 1, k, j + 1, q) for (i, j), (k, q) in zip(edges, edges[1:])]
            continue
        places: dict = {}
        for j in range(d - 1, c - 1, -1):
            places.setdefault(y[j], []).append(j)
        last = c - 1
        for i in range(a, b):
            left = places.get(x[i], [])
            while left and left[-1] <= last:
                left.pop()
            if left:
                last = left.pop()
                out.append((i, last))
    return sorted(out)


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of ``pairs`` (sorted by their first) whose second rises too."""
    tops, ends, before = [], [], {}
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tops, j)
        before[k] = ends[at - 1] if at else None
        tops[at:at + 1] = [j]
        ends[at:at + 1] = [k]
    out, k = [], ends[-1] if ends else None
    while k is not None:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def expression(item: list) -> str:
    """A wrapper as a union-free regular expression."""
    label, optional, repeated, children, text = item
    if label.startswith("#") and label != "#root":
        body = "#TEXT" if text is None else json.dumps(text)
    elif label.startswith("("):
        body = "(" + " ".join(map(expression, children)) + ")"
    else:
        body = f"<{label}>" + " ".join(map(expression, children)) + f"</{label.partition('.')[0]}>"
    if (optional or repeated) and not label.startswith("("):
        body = f"({body})"
    return body + ("+" if repeated else "") + ("?" if optional else "")


def _named(label: str) -> tuple[str, set[str]]:
    tag, _, words = label.partition(".")
    return tag, set(words.split(".")) if words else set()


def _step(label: str, inside: bool, article: bool, doubtful: bool) -> tuple[bool, bool] | None:
    """(in the main container, in an article) inside an element; None if the element is left out.

    An outermost article named by nothing but words of what is away is ``doubtful``: a comment
    or a notice beside the article, or the article itself where there is no other.
    """
    tag, words = _named(label)
    if tag in ("html", "body"):
        return inside, article
    if tag == "main" or tag == "article" and not article:
        if tag == "article" and words & AWAY and not words & NAMED_MAIN and not doubtful:
            return None
        return True, article or tag == "article"
    if tag in DROPPED or words & AWAY or not inside and (tag == "header" or words & PAGE_HEAD):
        return None
    return inside or tag in ("div", "section", "td") and bool(words & NAMED_MAIN) or "main" in words, article


def page_kind(tree: list) -> str:
    """Which pages of its host a page is laid out like: with main text in a container, in doubtful articles only, or in the plain body."""
    def held(node, inside, article, doubtful):
        for c in runs(node[1]):
            if isinstance(c, tuple):
                if inside:
                    return True
            elif (now := _step(c[0], inside, article, doubtful)) and held(c, *now, doubtful):
                return True
        return False
    return "main" if held(tree, False, False, False) else "doubtful" if held(tree, False, False, True) else "body"


def _path(parent: str, label: str) -> str:
    """The name of a place in a tree: a hash of the labels down to it, of one length at any depth."""
    return xxhash.xxh64_hexdigest(f"{parent}/{label}")


def main_paths(wrapper: list, kind: str | None = None, pages: int = 1) -> dict[str, list]:
    """Where the main text stands in the wrapper of a host's ``pages`` pages of one kind.

    ``paths`` are the label paths of kept text items, ``template`` texts to leave out at them.
    Inside a container ``fixed`` are the (path, text) that AGREE pages and more all have at
    one place, and ``lists`` the paths of repeated groups of links alone that all have.
    """
    def walk(item, path, inside, article, optional, repeated, out):
        label = item[0]
        optional, repeated = optional or item[1], repeated or item[2]
        if label.startswith("#") and label != "#root":
            out.append((path, inside, optional, repeated, item[4], label == "#a"))
            return
        if not label.startswith("(") and label != "#root":
            now = _step(label, inside, article, doubtful)
            if now is None:
                return
            inside, article = now
            path = _path(path, label)
        for c in item[3]:
            walk(c, path, inside, article, optional, repeated, out)
    for doubtful in [kind != "main"] if kind else [False, True]:
        places: list = []
        walk(wrapper, "", False, False, False, False, places)
        if inner := [p for p in places if p[1]]:
            fixed, lists = set(), set()
            if pages >= AGREE and any(text is None and not repeated for *_, repeated, text, _ in inner):
                fixed = {(p, text) for p, _, optional, repeated, text, _ in inner if text is not None and not optional and not repeated}
                mixed = {p for p, _, optional, repeated, _, linked in inner if not (linked and repeated) or optional}
                lists = {p for p, *_ in inner} - mixed
            return {"paths": sorted({p for p, *_ in inner}), "template": [], "links": True, "fixed": sorted(fixed), "lists": sorted(lists)}
    # template text stands at one place of every page; it shows only where pages differ somewhere
    differ = any(text is None and not repeated for *_, repeated, text, _ in places)
    template = {text for *_, optional, repeated, text, _ in places if text is not None and not optional and not repeated}
    return {"paths": sorted({p for p, *_ in places}), "template": sorted(template) if differ else [], "links": False}


def extract(page: str | list, rules: dict) -> str:
    """The main text of a page (or of its tree) by the rules of its host and kind."""
    kept, template, found = set(rules["paths"]), set(rules["template"]), []
    fixed, lists = set(map(tuple, rules.get("fixed", ()))), set(rules.get("lists", ()))

    def walk(node, path):
        for c in runs(node[1]):
            if isinstance(c, tuple):
                if path in kept and c[0] not in template and (rules["links"] or not c[1]):
                    found.append((c[0], "links" if c[1] and path in lists else "shared" if (path, c[0]) in fixed else "own"))
            else:
                walk(c, _path(path, c[0]))
    walk(read_page(page) if isinstance(page, str) else page, "")
    size = Counter()
    for text, kind in found:
        size[kind] += len(text)
    # what the host's pages share outweighs what is the page's own: it is the article (mirrored, reposted, in parts)
    left_out = {"links"} if size["shared"] >= size["own"] else {"links", "shared"}
    return " ".join([t for t, kind in found if kind not in left_out] or [t for t, _ in found])   # a container of nothing else is kept


_WRAPPER = "host string, part int, pages long, wrapper string"


def _dumps(kinds: dict) -> str:
    return json.dumps({kind: [n, flat(w)] for kind, (n, w) in kinds.items()})


def _loads(text: str) -> dict:
    return {kind: [n, nested(items)] for kind, (n, items) in json.loads(text).items()}


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, pages, wrapper): the wrappers of every host of ``pages`` (host, html) by kind of page, as JSON: kind -> [pages, wrapper]."""
    def joined(old, new):
        for kind, (n, w) in new.items():
            old[kind] = [old[kind][0] + n, merge(old[kind][1], w)] if kind in old else [n, w]
        return old

    def partial(batches):
        held, serial = {}, 0

        def rows():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array([(TaskContext.get().partitionId() + serial) % PARTS] * len(held), pa.int32()),
                 pa.array([n for n, _ in held.values()], pa.int64()), pa.array([_dumps(w) for _, w in held.values()], pa.string())],
                names=["host", "part", "pages", "wrapper"])
        for batch in batches:
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1)):
                tree = read_page(html.as_py() or "")
                n, old = held.get(host, (0, {}))
                with deep():
                    held[host] = (n + 1, joined(old, {page_kind(tree): [1, page_wrapper(tree)]}))
            if len(held) > HELD_HOSTS:
                serial += 1
                yield rows()
                held = {}
        if held:
            yield rows()

    def merged(pdf):
        total, w = 0, {}
        for n, s in zip(pdf["pages"], pdf["wrapper"]):
            with deep():
                total, w = total + n, joined(w, _loads(s))
        return pdf.iloc[:1].assign(pages=total, wrapper=_dumps(w))
    parts = pages.select("host", "html").mapInArrow(partial, _WRAPPER)
    for key in (["host", "part"], ["host"]):
        parts = parts.groupBy(*key).applyInPandas(merged, _WRAPPER)
    return parts.select("host", "pages", "wrapper")


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every row of ``pages`` (page_id, url, html)."""
    rows = pages.select("page_id", "url", F.coalesce(F.regexp_extract("url", HOST, 1), F.lit("")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    known = materialise(wrappers(rows))

    def run(batches):
        rules = {}
        for batch in batches:
            out = []
            for host, html, wrapper in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4))):
                if host not in rules:
                    if len(rules) > HELD_HOSTS:
                        rules.clear()
                    with deep():
                        rules[host] = {kind: main_paths(w, kind, n) for kind, (n, w) in _loads(wrapper).items()}
                tree = read_page(html)
                with deep():
                    out.append(extract(tree, rules[host][page_kind(tree)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=["page_id", "url", "text"])
    joined = checked_join(rows, known.select("host", "wrapper"), "host", "inner", 64, F.octet_length("wrapper"))
    return joined.select("page_id", "url", "host", "html", "wrapper").mapInArrow(run, "page_id long, url string, text string")


def html_query(pages: DataFrame) -> DataFrame:
    """Main texts by the contract of op10."""
    return extract_pages(pages).withColumn("n_chars", F.length("text").cast("long"))
