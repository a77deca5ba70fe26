"""HTML pages -> page trees (one row per page, text stored once) and the node table (one row per element).

The per-page work is a small tolerant tree builder on the standard-library ``html.parser``, run inside
``mapInArrow``; every later step (selectors, nearest-key lookups, extraction) is a fold, window or
aggregate in Spark. A page tree is::

    page_id    long
    text       binary  (UTF-8: all document text once, behind it the text of scripts and styles)
    nodes      array<struct<
        node_id   int  (pre-order number inside the page, from 0)   last   int  (largest node_id inside it)
        parent_id int  (NULL for a root)       sib_idx   int  (index among element siblings)
        depth     int                          tag       string (lower case)
        id        string                       cls       string (classes, a space around each)
        attrs     map<string,string>           start, len  int  (the element's text, in bytes of ``text``)
        kids      array<struct<is_text, start, len>>   (child pieces in order)
        path      array<struct<node_id, parent_id, sib_idx, tag, cls, id>>   (ancestors, root first)>>

so a node's descendants are those with a ``node_id`` in (``node_id``, ``last``], and its text is a
substring. :func:`flat` gives the node table, whose text columns (``own_text``: directly inside the
element; ``text``: all of its text, scripts and styles left out; ``children``) are cut out of the page's text
where a query asks for them.

Tree rules: void elements never hold children; a new ``p`` or block start tag closes an open ``p``;
``li`` closes an open ``li`` of the same list; an end tag closes every element opened after its
match; an end tag without an open match is ignored; comments, doctype and processing instructions
are skipped; whatever is open at the end is closed. Text outside any element is kept in a row of the
page's own (node -1, tag ``#page``), which only pages with such text have.
"""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import ship_package, spread

TREE_SCHEMA = (
    "page_id long, text binary, nodes array<struct<node_id:int,last:int,parent_id:int,sib_idx:int,depth:int,tag:string,id:string,cls:string,"
    "attrs:map<string,string>,start:int,len:int,kids:array<struct<is_text:boolean,start:int,len:int>>,"
    "path:array<struct<node_id:int,parent_id:int,sib_idx:int,tag:string,cls:string,id:string>>>>"
)

# Elements without content, elements whose start closes an open <p>, and elements
# whose text is not document text.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
CLOSES_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form",
            "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre",
            "section", "table", "ul"}
NON_TEXT = {"script", "style", "template"}
LIST_SCOPE = {"ul", "ol"}


PAGE = "#page"


class _Node:
    __slots__ = ("nid", "parent", "sib", "depth", "tag", "attrs", "id", "cls", "pieces", "kids", "start", "end", "last", "path")

    def __init__(self, nid, parent, sib, depth, tag, attrs, start, path):
        self.nid, self.parent, self.sib, self.depth = nid, parent, sib, depth
        self.tag, self.attrs, self.start, self.path = tag, attrs, start, path
        self.id = attrs.get("id")
        self.cls = " " + " ".join(attrs["class"].split()) + " " if attrs.get("class") else None
        self.pieces: list = []          # (kind, start, bytes) of text, (None, child node, None) of elements
        self.kids = 0
        self.end, self.last = start, nid


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes: list[_Node] = []
        self.stack: list[_Node] = []
        self.roots = 0
        self.page: list[tuple] = []     # root elements and the text outside any element
        self.text, self.raw = [], []    # document text; script and style text
        self.at, self.raw_at = 0, 0     # their bytes so far
        self.silent = 0                 # open elements whose text is not document text

    def _close_to(self, i: int) -> None:
        while len(self.stack) > i:
            n = self.stack.pop()
            n.end, n.last = self.at, len(self.nodes) - 1
            self.silent -= n.tag in NON_TEXT

    def _open_index(self, tag: str, stop: set[str] | None = None) -> int:
        for i in range(len(self.stack) - 1, -1, -1):
            t = self.stack[i].tag
            if t == tag:
                return i
            if stop and t in stop:
                return -1
        return -1

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            i = self._open_index("p")
            if i >= 0:
                self._close_to(i)
        if tag == "li":
            i = self._open_index("li", LIST_SCOPE)
            if i >= 0:
                self._close_to(i)
        parent = self.stack[-1] if self.stack else None
        if parent is None:
            sib = self.roots
            self.roots += 1
            path = []
        else:
            sib = parent.kids
            parent.kids += 1
            path = parent.path + [parent]
        node = _Node(len(self.nodes), parent, sib, len(self.stack), tag,
                     {k: (v if v is not None else "") for k, v in attrs}, self.at, path)
        self.nodes.append(node)
        (self.page if parent is None else parent.pieces).append((None, node, None))
        if tag not in VOID:
            self.stack.append(node)
            self.silent += tag in NON_TEXT

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack and self.stack[-1].tag == tag:
            self._close_to(len(self.stack) - 1)

    def handle_endtag(self, tag):
        i = self._open_index(tag)
        if i >= 0:
            self._close_to(i)

    def handle_data(self, data):
        data = data.encode("utf-8", "replace")
        to = self.stack[-1].pieces if self.stack else self.page
        if self.silent:
            to.append(("raw", self.raw_at, len(data)))
            self.raw.append(data)
            self.raw_at += len(data)
        else:
            to.append(("text", self.at, len(data)))
            self.text.append(data)
            self.at += len(data)

    def finish(self):
        self.close()
        self._close_to(0)

    def spans(self, pieces) -> list[tuple[bool, int, int]]:
        """(is_text, start, bytes) of child pieces in the page's whole text."""
        return [(False, x.start, x.end - x.start) if kind is None else (True, x + self.at * (kind == "raw"), n) for kind, x, n in pieces]


def parse_tree(html: str | None) -> tuple[bytes, list[tuple]]:
    """The text of a page and its nodes (the fields of ``nodes`` in order). A page with text outside any element
    (other than white space) has a row for itself before them: node -1, tag ``PAGE``, next to no root element."""
    b = _TreeBuilder()
    b.feed(html or "")
    b.finish()
    text = b"".join(b.text + b.raw)
    rows = []
    outside = b.spans(b.page)
    if b"".join(text[s:s + n] for is_text, s, n in outside if is_text).strip():
        rows.append((-1, len(b.nodes) - 1, None, -2, -1, PAGE, None, None, {}, 0, b.at, outside, []))
    for n in b.nodes:
        rows.append((n.nid, n.last, n.parent.nid if n.parent else None, n.sib, n.depth, n.tag, n.id, n.cls, n.attrs, n.start,
                     n.end - n.start, b.spans(n.pieces), n.path))
    return text, rows


def parse_page(page_id: int, html: str) -> list[tuple]:
    """Rows of one page as the node table has them, in document order."""
    text, rows = parse_tree(html)
    cut = lambda s, n: text[s:s + n].decode()
    return [(page_id, nid, parent, sib, depth, tag, attrs, "".join(cut(s, m) for is_text, s, m in kids if is_text), cut(start, n),
             [{"is_text": is_text, "text": cut(s, m)} for is_text, s, m in kids],
             [{"node_id": a.nid, "parent_id": a.parent.nid if a.parent else None, "sib_idx": a.sib} for a in path])
            for nid, last, parent, sib, depth, tag, id_, cls, attrs, start, n, kids, path in rows]


def _batch(ids: list, texts: list[bytes], trees: list[list[tuple]]):
    """Arrow batch of page trees, built column by column."""
    import numpy as np
    import pyarrow as pa

    def offsets(sizes):
        return pa.array(np.concatenate([[0], np.cumsum(np.fromiter(sizes, np.int64, len(sizes)))]), pa.int32())

    def lists(groups, names, columns):
        return pa.ListArray.from_arrays(offsets([len(g) for g in groups]), pa.StructArray.from_arrays(columns, names))

    def ints(values):
        return pa.array(list(values), pa.int32())

    nodes = [n for t in trees for n in t]
    cols = list(zip(*nodes)) if nodes else [[] for _ in range(13)]
    kids = [k for g in cols[11] for k in g]
    path = [a for g in cols[12] for a in g]
    attrs = pa.MapArray.from_arrays(offsets([len(x) for x in cols[8]]), pa.array([k for x in cols[8] for k in x], pa.string()),
                                    pa.array([v.encode("utf-8", "replace").decode() for x in cols[8] for v in x.values()], pa.string()))
    fields = [ints(cols[0]), ints(cols[1]), ints(cols[2]), ints(cols[3]), ints(cols[4])]
    fields += [pa.array(list(cols[i]), pa.string()) for i in (5, 6, 7)] + [attrs, ints(cols[9]), ints(cols[10])]
    fields.append(lists(cols[11], ["is_text", "start", "len"], [pa.array([k[0] for k in kids], pa.bool_()), ints(k[1] for k in kids), ints(k[2] for k in kids)]))
    fields.append(lists(cols[12], ["node_id", "parent_id", "sib_idx", "tag", "cls", "id"],
                        [ints(a.nid for a in path), ints(a.parent.nid if a.parent else None for a in path), ints(a.sib for a in path),
                         pa.array([a.tag for a in path], pa.string()), pa.array([a.cls for a in path], pa.string()), pa.array([a.id for a in path], pa.string())]))
    names = ["node_id", "last", "parent_id", "sib_idx", "depth", "tag", "id", "cls", "attrs", "start", "len", "kids", "path"]
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.binary()), lists(trees, names, fields)], names=["page_id", "text", "nodes"])


#: Nodes, and bytes of text, that a task holds at most before it hands on a batch of trees (a page stays whole).
BATCH_NODES, BATCH_BYTES = 5_000, 4 << 20

#: Small pages that one task parses where their number is known, so that tasks become more with the input.
TASK_PAGES = 5_000


def _parse_batches(batches):
    """mapInArrow body: Arrow batches of (page_id, html) in, Arrow batches of page trees out. One page at a time is
    taken out of the batch that came in."""
    for batch in batches:
        ids, texts, trees, size, held = [], [], [], 0, 0
        for pid, html in zip(batch.column(0), batch.column(1)):
            text, rows = parse_tree(html.as_py())
            ids.append(pid.as_py())
            texts.append(text)
            trees.append(rows)
            size += len(rows)
            held += len(text)
            if size >= BATCH_NODES or held >= BATCH_BYTES:
                yield _batch(ids, texts, trees)
                ids, texts, trees, size, held = [], [], [], 0, 0
        if ids:
            yield _batch(ids, texts, trees)


def page_trees(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", count: int | None = None) -> DataFrame:
    """Pages (id, html) -> page trees (see module docstring). One task parses whole pages; where their ``count`` is
    given, about ``TASK_PAGES`` of them, however few bytes they are derived from."""
    spark = pages.sparkSession
    ship_package(spark)
    src = pages.select(pages[id_col].cast("long").alias("page_id"), pages[html_col].alias("html"))
    tasks = None if count is None else max(spark.sparkContext.defaultParallelism, -(-count // TASK_PAGES))
    return spread(src, "page_id", min_partitions=tasks).mapInArrow(_parse_batches, TREE_SCHEMA)


def flat(trees: DataFrame) -> DataFrame:
    """Page trees -> node table. Only the node fields and, for a text column, the page text that a query uses are read."""
    cut = "cast(substring(__text, {0}start + 1, {0}len) as string)"
    rows = trees.select("page_id", F.col("text").alias("__text"), F.explode("nodes").alias("n"))
    return rows.select(
        "page_id", *[F.col(f"n.{c}").alias(c) for c in ("node_id", "parent_id", "sib_idx", "depth", "tag", "attrs")],
        F.expr(f"array_join(transform(filter(n.kids, k -> k.is_text), k -> {cut.format('k.')}), '')").alias("own_text"),
        F.expr(cut.format("n.")).alias("text"),
        F.expr(f"transform(n.kids, k -> struct(k.is_text as is_text, {cut.format('k.')} as text))").alias("children"),
        *[F.col(f"n.{c}").alias(c) for c in ("path", "last", "id", "cls")])


def node_table(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Pages (id, html) -> node table, one row per element."""
    return flat(page_trees(pages, id_col, html_col))


# --- extractors as table functions ------------------------------------------------------------------

def _attributes(html: str | None, tag: str, name: str):
    """(node_id, value) of each element with the attribute, in document order."""
    for n in parse_tree(html)[1]:
        if n[5] == tag and name in n[8]:
            yield n[0], n[8][name]


def _texts(html: str | None, tag: str, least: int):
    """(node_id, text) of each element whose text has at least ``least`` characters without white space around it."""
    text, nodes = parse_tree(html)
    for n in nodes:
        if n[5] == tag and len(t := text[n[9]:n[9] + n[10]].decode().strip()) >= least:
            yield n[0], t


#: Table functions by name: what they emit for one page and their arguments behind the page.
TABLE_FUNCTIONS = {"node_attributes": _attributes, "node_texts": _texts}


def register_table_function(spark, name: str, fn, schema: str = "node_id int, value string") -> None:
    """Make ``fn(html, *arguments)``, which emits rows for one page, a table function of the session, to be called in
    ``FROM pages, LATERAL name(html, ...)``. Rows go to and from Python in Arrow batches."""
    ship_package(spark)

    class Extract:
        def eval(self, *arguments):
            yield from fn(*arguments)

    spark.udtf.register(name, F.udtf(Extract, returnType=schema, useArrow=True))


def register_table_functions(spark) -> None:
    for name, fn in TABLE_FUNCTIONS.items():
        register_table_function(spark, name, fn)
