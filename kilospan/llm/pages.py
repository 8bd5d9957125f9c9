"""Main text of web pages by wrapper induction.

Pages of one host come from few templates. Each page is parsed into a tree of blocks; runs
of like siblings (list items, paragraphs) are one repeated node. Trees of a host are
aligned by simple tree matching: the largest set of matched nodes that keeps parents and
sibling order. The wrapper of a host is the merged tree; a node whose text has been the
same on every page is template, one whose text varies is a slot. Slots hold content,
unless the page itself marks them as something else (navigation, notices, adverts, forms,
comments ...); of the rest, article and main elements are taken alone if they hold most.
A class or id marks an element by its whole name or its head word, and never one that holds
an article, main or h1 or most of the page's text.

Wrappers are merged like partial sums: first over the pages of a task, then over tasks in
groups of FAN_IN. They are as large as a page's structure, not as the number of pages, so a
host with a third of all pages is no hot spot. Pages themselves are never shuffled by host
unless the table of template nodes is too large to broadcast, which is measured.

A node is template only on the evidence of MIN_PAGES different pages: on fewer, a title
that two pages share would look like one. Nodes are aligned by tag and names without digits.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilospan.llm.common import kept, row_slices, text_bytes

MIN_PAGES = 10
ID_WORDS = 2
FAN_IN = 64
MOST_DEPTH = 150
HELD_HOSTS = 5000
BROADCAST_BYTES = 64 << 20

# Elements of HTML that break a line of text, hold none, or stand apart.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "script style noscript template svg math button select option textarea label iframe object "
    "canvas audio video map datalist output progress meter head title".split()
)
# Of these, the ones whose text HTML reads as raw; and what may stand in a head.
RAW = frozenset("script style textarea title iframe".split())
IN_HEAD = frozenset("head title script style noscript template meta link base basefont bgsound".split())
APART = frozenset("nav header footer aside form menu dialog search".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
APART_NAMES = frozenset(
    "ad ads adv advert advertisement advertising banner sponsor sponsored promo promotion "
    "cookie cookies consent notice notices alert popup modal newsletter subscribe subscription "
    "signup login sidebar side menu nav navbar navigation breadcrumb breadcrumbs footer header "
    "masthead comment comments reply replies respond disqus social share sharing related "
    "recommended widget toolbar pagination pager skip tags".split()
)
APART_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert menu menubar".split()
)
# Words behind a name that make it a part of the same kind, and words before a name that
# say what something else looks like.
PART_WORDS = frozenset(
    "list links link buttons button box wrap wrapper inner container area block section bar slot "
    "unit units items item posts form content".split()
)
LOOKS = frozenset("has with without no not is hide show hidden left right".split())
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-z0-9]+")
_DIGIT = re.compile(r"\d")
# "<!-->" and "<!--->" are whole comments, too
_COMMENT_END = re.compile(r"<!--(?:-?>)|--!?>")


class Node:
    __slots__ = (
        "tag", "label", "apart", "named", "texts", "children", "parent", "open_text", "depth"
    )

    def __init__(self, tag, label, apart, parent, named=False):
        self.tag, self.label, self.apart, self.parent = tag, label, apart, parent
        self.named, self.depth = named, 0 if parent is None else parent.depth + 1
        self.texts, self.children, self.open_text = [], [], []


def names_apart(names: str) -> bool:
    """Whether one of these names says that an element is no content."""
    for name in names.split():
        words = _NAME.findall(name)
        if words and words[0] not in LOOKS:
            while len(words) > 1 and words[-1] in PART_WORDS:
                words.pop()
            if words[-1] in APART_NAMES:
                return True
    return False


def label_of(tag: str, classes: str, name: str) -> str:
    """What a node is aligned by. Names with a digit, and ids of more than ID_WORDS words,
    tell one page from another and are no part of it."""
    known = {c for c in classes.split() if not _DIGIT.search(c)}
    if name and not _DIGIT.search(name) and len(_NAME.findall(name)) <= ID_WORDS:
        known.add(f"#{name.strip()}")
    return ".".join([tag, *sorted(known)])


def _mark_apart(builder: "_Builder") -> None:
    """Settle what stands apart: by tag, role and hidden at once, by name only if it does not
    hold the page's content."""
    nodes = [builder.root]
    for node in nodes:
        nodes += node.children
    size = {id(n): sum(map(len, n.texts)) for n in nodes}
    holds = {id(n): n.tag == "h1" or n.tag in ("article", "main") and not n.named for n in nodes}
    for node in reversed(nodes[1:]):
        size[id(node.parent)] += size[id(node)]
        holds[id(node.parent)] |= holds[id(node)]
    most = size[id(builder.root)]
    for node in nodes[1:]:
        by_name = node.named and node.tag not in ("html", "body", "article", "main")
        by_name = by_name and not holds[id(node)] and 2 * size[id(node)] <= most
        node.apart = node.parent.apart or node.apart or by_name


class _Silence:
    """An open element without text of its own, and how things stood when it began."""

    __slots__ = ("tag", "depth", "n_said", "text", "n_children")

    def __init__(self, tag, builder):
        self.tag, self.depth = tag, len(builder.open)
        self.n_said, self.text = len(builder.order), list(builder.at.open_text)
        self.n_children = len(builder.at.children)


class _Builder(HTMLParser):
    """Blocks and their texts, in page order. Inline elements do not cut a text.

    When a silent element ends, what was said in it is taken back. One that never ends, or
    that the end of an element around it ends, was no real one and keeps its text; only raw
    text, which HTML itself lets run to the end, has none in any case. What may not stand in
    the head ends it. Nodes deeper than MOST_DEPTH are children of the one at that depth.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#page", "#page", False, None)
        self.open, self.count = [self.root], Counter()
        self.silent: list[_Silence] = []
        self.order: list[tuple[Node, str]] = []

    @property
    def at(self) -> Node:
        return self.open[-1]

    def _flush(self):
        text = _SPACE.sub(" ", "".join(self.at.open_text)).strip()
        self.at.open_text = []
        if text:
            self.order.append((self.at, text))

    def _pop(self):
        self.count[self.open.pop().tag] -= 1

    def _take_back(self, place: int):
        """The silent element at this place has ended: forget what was said in it."""
        began = self.silent[place]
        while len(self.open) > began.depth:
            self._pop()
        del self.order[began.n_said :], self.at.children[began.n_children :]
        self.at.open_text = began.text
        del self.silent[place:]

    def handle_starttag(self, tag, attrs):
        if self.silent:
            around = self.silent[-1].tag
            if around in RAW:
                return
            if around == "head" and tag not in IN_HEAD:
                self._take_back(-1)
        if tag in VOID:
            if tag == "hr":
                self._flush()
            elif tag == "br":
                self.at.open_text.append(" ")
            return
        if tag in SILENT:
            self.silent.append(_Silence(tag, self))
            return
        if tag not in BLOCKS:
            return
        classes, name = (
            " ".join(v or "" for k, v in attrs if k == key).lower() for key in ("class", "id")
        )
        role = next((v or "" for k, v in attrs if k == "role"), "").lower()
        hidden = any(k == "hidden" or k == "aria-hidden" and v == "true" for k, v in attrs)
        self._flush()
        self._imply(tag)
        apart = tag in APART or role in APART_ROLES or hidden
        named = names_apart(f"{classes} {name}")
        above = self.at if self.at.depth < MOST_DEPTH else self.at.parent
        node = Node(tag, label_of(tag, classes, name), apart, above, named)
        above.children.append(node)
        self.open.append(node)
        self.count[tag] += 1

    def _imply(self, tag):
        """Elements that end where another one begins, within the same silent element."""
        ends = {"p"} if tag in BLOCKS and tag not in ("html", "body") else set()
        if tag in ("li",):
            ends = {"p", "li"}
        elif tag in ("dt", "dd"):
            ends = {"p", "dt", "dd"}
        elif tag in ("td", "th"):
            ends = {"p", "td", "th"}
        elif tag == "tr":
            ends = {"p", "td", "th", "tr"}
        least = self.silent[-1].depth if self.silent else 1
        while len(self.open) > least and self.at.tag in ends:
            self._pop()

    def handle_endtag(self, tag):
        for place in reversed(range(len(self.silent))):
            if self.silent[place].tag == tag:
                self._take_back(place)
                return
        if self.silent and self.silent[-1].tag in RAW:
            if tag not in ("html", "body"):
                return
            self.silent.pop()
        if tag not in BLOCKS or not self.count[tag]:
            return
        self._flush()
        while self.at.tag != tag:
            self._pop()
        self._pop()
        while self.silent and self.silent[-1].depth > len(self.open):
            self.silent.pop()

    def parse_comment(self, i, report=1):
        """To the end of the comment; one that never ends goes to the end of the page."""
        end = _COMMENT_END.match(self.rawdata, i) or _COMMENT_END.search(self.rawdata, i + 4)
        return end.end() if end else len(self.rawdata)

    def parse_marked_section(self, i, report=1):
        """What begins with <![ is a comment up to the next > in HTML."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else len(self.rawdata)

    def handle_data(self, data):
        if self.silent:
            around = self.silent[-1].tag
            if around in RAW:
                return
            if around == "head" and data.strip():
                self._take_back(-1)
        self.at.open_text.append(data)


def parse(html: str) -> _Builder:
    """The block tree of any text; broken markup ends where the text ends."""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    builder._flush()
    for node, text in builder.order:
        node.texts.append(text)
    _mark_apart(builder)
    return builder


def skeleton(node: Node) -> list:
    """[label, digest of texts, children]: like siblings in a row become one node."""
    rows: list[tuple[str, list[Node]]] = []
    for child in node.children:
        if rows and rows[-1][0] == child.label:
            rows[-1][1].append(child)
        else:
            rows.append((child.label, [child]))
    children = []
    for _, like in rows:
        if len(like) == 1:
            children.append(skeleton(like[0]))
        else:
            merged = Node(like[0].tag, like[0].label, like[0].apart, None)
            merged.texts = ["\0".join(x.texts) for x in like]
            merged.children = [c for x in like for c in x.children]
            children.append(skeleton(merged))
    texts = hashlib.blake2b("\1".join(node.texts).encode(), digest_size=8).hexdigest()
    return [node.label, texts if node.texts else "", children]


# A wrapper is [label, digest or None if it varies, children, pages with the node].


def wrapper(tree: list) -> list:
    return [tree[0], tree[1], [wrapper(c) for c in tree[2]], 1]


def _size_of(tree: list) -> int:
    return 1 + sum(_size_of(c) for c in tree[2])


def match(a: list, b: list) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: matched nodes, and which children are aligned with which."""
    if a[0] != b[0]:
        return 0, []
    left, right = a[2], b[2]
    best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    gain = {}
    for i, x in enumerate(left):
        for j, y in enumerate(right):
            gain[i, j] = match(x, y)[0] if x[0] == y[0] else 0
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + gain[i, j])
    pairs, i, j = [], len(left), len(right)
    while i and j:
        if gain[i - 1, j - 1] and best[i][j] == best[i - 1][j - 1] + gain[i - 1, j - 1]:
            i, j = i - 1, j - 1
            pairs.append((i, j))
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return 1 + best[-1][-1], pairs[::-1]


def constant(w: list) -> bool:
    return w[1] is not None and all(constant(c) for c in w[2])


def _equal(a: list, b: list) -> bool:
    return a[:2] == b[:2] and len(a[2]) == len(b[2]) and all(map(_equal, a[2], b[2]))


def merge(a: list, b: list) -> list:
    """Two wrappers of one host as one. The same page twice is no further evidence."""
    if constant(a) and _equal(a, b):
        return a if a[3] >= b[3] else b
    return _merge(a, b)


def _merge(a: list, b: list) -> list:
    """Aligned children become one. Of those left over, like ones of the two sides become
    one, too, in order: no label is more frequent among the children than on one side."""
    _, pairs = match(a, b)
    left, right = {x for x, _ in pairs}, {y for _, y in pairs}
    waiting: dict[str, list[int]] = {}
    for x, child in enumerate(a[2]):
        if x not in left:
            waiting.setdefault(child[0], []).append(x)
    alike = {}
    for y, child in enumerate(b[2]):
        if y not in right and waiting.get(child[0]):
            alike[waiting[child[0]].pop(0)] = y
    elsewhere = set(alike.values())
    children, i, j = [], 0, 0
    for x, y in [*pairs, (len(a[2]), len(b[2]))]:
        for k in range(i, x):
            children.append(_merge(a[2][k], b[2][alike[k]]) if k in alike else a[2][k])
        children += [b[2][k] for k in range(j, y) if k not in elsewhere]
        if x < len(a[2]):
            children.append(_merge(a[2][x], b[2][y]))
        i, j = x + 1, y + 1
    return [a[0], a[1] if a[1] == b[1] else None, children, a[3] + b[3]]


def template_paths(w: list, min_pages: int = MIN_PAGES, path: str = "") -> set[str]:
    """Paths of nodes whose own text is the same on every one of enough pages."""
    path = f"{path}/{w[0]}"
    found = {path} if w[1] and w[3] >= min_pages else set()
    varies = set() if w[1] or w[1] == "" else {path}
    for child in w[2]:
        found |= template_paths(child, min_pages, path)
    return found - varies


def main_text(html: str, template: frozenset[str] = frozenset()) -> str:
    """Content blocks in page order, joined by an empty line."""
    page = parse(html)
    paths: dict[int, str] = {}

    def path(node):
        if id(node) not in paths:
            head = path(node.parent) if node.parent else ""
            paths[id(node)] = f"{head}/{node.label}"
        return paths[id(node)]

    def within(node, tags):
        while node is not None:
            if node.tag in tags:
                return node
            node = node.parent
        return None

    article = ("article", "main")
    blocks = []
    for node, text in page.order:
        apart = node.apart
        if apart and node.tag in HEADINGS:  # a headline in the article's own header
            around, apart = node.parent, True
            inside = within(node, article)
            if inside is not None and not inside.apart and around.tag in ("header", "hgroup"):
                apart = within(around.parent, APART) is not None
        if not apart and path(node) not in template:
            blocks.append((node, text))
    inside = [t for n, t in blocks if within(n, article) is not None]
    if inside and 2 * sum(map(len, inside)) >= sum(len(t) for _, t in blocks):
        return "\n\n".join(inside)
    return "\n\n".join(t for _, t in blocks)


def host_of(url: Column) -> Column:
    """Lower-case host without port and user; empty if the text has none."""
    return F.lower(
        F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit(""))
    )


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper as JSON) over all (host, html) rows."""

    def fold(batches):
        held: dict[str, list] = {}

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held)), pa.array([json.dumps(w) for w in held.values()], pa.string())],
                ["host", "wrapper"],
            )

        for batch in batches:
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w = wrapper(skeleton(parse(html or "").root))
                held[host] = merge(held[host], w) if host in held else w
                if len(held) > HELD_HOSTS:
                    yield out()
                    held = {}
        if held:
            yield out()

    schema = "host string, wrapper string"
    folded = pages.mapInArrow(fold, schema).withColumn("part", F.spark_partition_id().cast("bigint"))
    parts = kept(folded, "wrappers")
    rounds, groups = 1, (parts.agg(F.max("part")).first()[0] or 0) + 1
    while groups > FAN_IN:
        groups, rounds = -(-groups // FAN_IN), rounds + 1

    def join(key, frame):
        folded = None
        for text in frame.sort_values(["part", "wrapper"])["wrapper"]:
            w = json.loads(text)
            folded = w if folded is None else merge(folded, w)
        frame = frame.iloc[:1].copy()
        frame["wrapper"] = json.dumps(folded)
        return frame[["host", "wrapper", "part"]]

    for _ in range(rounds):
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("bigint"))
        parts = parts.groupBy("host", "part").applyInPandas(
            join, "host string, wrapper string, part bigint"
        )
    return parts.select("host", "wrapper")


def host_templates(found: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, template): paths of template nodes, for hosts that have any."""

    def read(batches):
        for batch in batches:
            paths = [
                sorted(template_paths(json.loads(w), min_pages))
                for w in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(paths, pa.list_(pa.string()))], ["host", "template"]
            )

    rows = found.mapInArrow(read, "host string, template array<string>")
    return rows.where(F.size("template") > 0)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """One row per page: page_id, url, text.

    A null html is empty; a page without content has an empty text. A page with a null url
    or one without a host belongs to the host without a name. Repeated rows give repeated
    rows. Nothing is dropped or capped but what is template or marked as no content.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
        host_of(F.col(url_col)).alias("host"),
    )
    templates = kept(host_templates(wrappers(rows.select("host", "html")), min_pages), "templates")
    size = templates.agg(
        F.sum(F.length("host") + F.length(F.array_join("template", " ")))
    ).first()[0] or 0
    side = templates.withColumnRenamed("host", "known")
    side = F.broadcast(side) if size <= BROADCAST_BYTES else side
    joined = rows.join(side, F.col("host") == F.col("known"), "left")
    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"page_id {fields['page_id']}, url {fields['url']}, text string"

    def read(batches):
        for batch in batches:
            _, at = text_bytes(batch.column(2))
            for lo, hi in row_slices(at):
                part = batch.slice(lo, hi - lo)
                texts = [
                    main_text(html or "", frozenset(template or ()))
                    for html, template in zip(part.column(2).to_pylist(), part.column(3).to_pylist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string())],
                    ["page_id", "url", "text"],
                )

    return joined.select("page_id", "url", "html", "template").mapInArrow(read, schema)
