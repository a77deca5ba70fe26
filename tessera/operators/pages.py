"""Article extraction from the node table and link handling on raw pages.

All steps are keyed by page: aggregates group by ``page_id`` (one page is one bounded group) and
ordered text joins use ``array_sort(collect_list(struct(order, text)))`` within that group.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import stage

# Section headings, text-bearing blocks, the dropped trailing heading and the
# default link pattern (in-site article links without a namespace colon).
MAJOR, MINOR = "h2", "h3"
TEXT_BLOCKS = ["p", "ul", "ol"]
DROPPED_HEADING = "References"
ARTICLE_LINK = r"^/wiki/[^:]*$"


def _ordered_join(order: Column, text: Column, sep: str = "") -> Column:
    arr = F.array_sort(F.collect_list(F.struct(order.alias("o"), text.alias("t"))))
    return F.array_join(F.transform(arr, lambda x: x["t"]), sep)


def _rooted(nodes: DataFrame) -> DataFrame:
    """Page roots as siblings under the parent -1, so that joins on the parent keep them."""
    return nodes.withColumn("parent_id", F.coalesce("parent_id", F.lit(-1)))


def page_title(nodes: DataFrame) -> DataFrame:
    """(page_id, title): text of the first h1."""
    h1 = nodes.filter(F.col("tag") == "h1")
    return h1.groupBy("page_id").agg(F.min_by("text", "node_id").alias("title"))


def page_paragraphs(nodes: DataFrame) -> DataFrame:
    """(page_id, content): every paragraph's text prefixed with '<p>', in document order."""
    p = nodes.filter(F.col("tag") == "p")
    return p.groupBy("page_id").agg(_ordered_join(F.col("node_id"), F.concat(F.lit("<p>"), F.col("text")))
                                    .alias("content"))


def page_text_blocks(nodes: DataFrame) -> DataFrame:
    """(page_id, node_id, tag, text) for p / ul / ol blocks."""
    return nodes.filter(F.col("tag").isin(TEXT_BLOCKS)).select("page_id", "node_id", "tag", "text")


def page_intro(nodes: DataFrame) -> DataFrame:
    """(page_id, introduction): from the first p, the p siblings up to the next h2 (or the last
    sibling), each text followed by a newline."""
    nodes = _rooted(nodes)
    first_p = (nodes.filter(F.col("tag") == "p").groupBy("page_id")
               .agg(F.min_by(F.struct("parent_id", "sib_idx"), "node_id").alias("f"))
               .select("page_id", F.col("f.parent_id").alias("parent_id"), F.col("f.sib_idx").alias("start")))
    sibs = nodes.join(first_p, ["page_id", "parent_id"]).filter(F.col("sib_idx") >= F.col("start"))
    stop = (sibs.filter(F.col("tag") == MAJOR).groupBy("page_id").agg(F.min("sib_idx").alias("stop")))
    body = sibs.join(stop, "page_id", "left").filter(F.col("stop").isNull() | (F.col("sib_idx") < F.col("stop")))
    intro = (body.filter(F.col("tag") == "p").groupBy("page_id")
             .agg(_ordered_join(F.col("sib_idx"), F.concat(F.col("text"), F.lit("\n"))).alias("introduction")))
    return intro


def page_infobox(nodes: DataFrame) -> DataFrame:
    """(page_id, infobox): the first table whose first class starts with 'infobox'; the text of
    every td of that table (not of tables nested in it), each followed by a newline. Pages without one
    get ''."""
    is_box = lambda cls: F.coalesce(F.trim(cls).startswith("infobox"), F.lit(False))
    # a cell belongs to the nearest table among its ancestors
    tables = F.filter("path", lambda a: a["tag"] == "table")
    nearest = F.try_element_at(tables, F.lit(-1))
    cell = (F.col("tag") == "td") & is_box(nearest["cls"])
    found = nodes.groupBy("page_id").agg(
        F.min(F.when((F.col("tag") == "table") & is_box(F.col("cls")), F.col("node_id"))).alias("box"),
        F.collect_list(F.when(cell, F.struct("node_id", nearest["node_id"].alias("table"), "text"))).alias("cells"))
    own = F.filter(F.array_sort("cells"), lambda c: c["table"] == F.col("box"))
    return found.select("page_id", F.array_join(F.transform(own, lambda c: F.concat(c["text"], F.lit("\n"))), "").alias("infobox"))


def page_sections(nodes: DataFrame) -> DataFrame:
    """(page_id, section, subsection, content): h2 / h3 headings roll up the text of the p / ul / ol
    siblings that follow them; empty headings and the trailing 'References' are dropped."""
    rows = roll_up(nodes, [(MAJOR, TEXT_BLOCKS, []), (MINOR, TEXT_BLOCKS, [MAJOR])])
    kept = rows.where((F.col("tags")[0] == MAJOR) & (F.length(F.trim("content")) > 0) & (F.col("path")[0] != DROPPED_HEADING))
    return kept.select("page_id", F.col("path")[0].alias("section"), F.get("path", F.lit(1)).alias("subsection"), "content")


def roll_up(nodes: DataFrame, levels: Sequence[tuple[str, Sequence[str], Sequence[str]]]) -> DataFrame:
    """(page_id, parent_id, ord, path, tags, content): every heading that is open somewhere with text blocks of its
    own, ``path`` being the headings it stands under, outermost first and itself last, and ``tags`` their tags.

    ``levels`` lists heading tags, outermost first: (tag, tags of the blocks it takes, tags that end it, besides
    its own). Headings are a stack over the order of siblings: one is open from its own place to the next sibling that
    ends it, and what ends a heading must also end the levels below it. A block goes to the innermost open
    heading, if that takes its tag; ``content`` is the blocks' text, a newline after each. ``ord`` is the heading's
    place among its siblings. All levels are found by one window over the siblings.
    """
    ends = [{tag, *stop} for tag, _, stop in levels]
    for (outer, *_), held, below in zip(levels, ends, ends[1:]):
        if not held <= below:
            raise ValueError(f"what ends {outer!r} must end the levels below it: {sorted(held - below)}")
    w = Window.partitionBy("page_id", "parent_id").orderBy("sib_idx").rowsBetween(Window.unboundedPreceding, 0)
    last = lambda value, when: F.last(F.when(when, value), ignorenulls=True).over(w)
    head = F.struct(F.col("sib_idx").alias("at"), F.trim("text").alias("heading"), "tag")
    tags = {t for tag, takes, stop in levels for t in (tag, *takes, *stop)}
    s = _rooted(nodes).where(F.col("tag").isin(*tags)).select("page_id", "parent_id", "sib_idx", "tag", "text")
    for i, (tag, _, _) in enumerate(levels):
        s = s.withColumn(f"__h{i}", last(head, F.col("tag") == tag)).withColumn(f"__e{i}", last(F.col("sib_idx"), F.col("tag").isin(*ends[i])))
    open_ = [F.when(F.col(f"__h{i}.at") == F.col(f"__e{i}"), F.col(f"__h{i}")) for i in range(len(levels))]
    # a heading inside another begins after it, so the stack is in the order of the places
    s = s.withColumn("__stack", F.array_sort(F.array_compact(F.array(*open_))))
    inner = F.try_element_at("__stack", F.lit(-1))
    takes = F.lit(False)
    for i, (_, blocks, _) in enumerate(levels):
        takes = takes | ((inner["at"] == F.col(f"__h{i}.at")) & F.col("tag").isin(*blocks) & (F.col(f"__h{i}.at") < F.col("sib_idx")))
    blocks = s.where(F.coalesce(takes, F.lit(False))).select("page_id", "parent_id", "sib_idx", "text", "__stack")
    return blocks.groupBy("page_id", "parent_id", F.col("__stack")[F.size("__stack") - 1]["at"].alias("ord")).agg(
        F.first("__stack")["heading"].alias("path"), F.first("__stack")["tag"].alias("tags"),
        _ordered_join(F.col("sib_idx"), F.concat(F.col("text"), F.lit("\n"))).alias("content"))


def page_outline(nodes: DataFrame, levels: Sequence[tuple[str, Sequence[str], Sequence[str]]]) -> DataFrame:
    """(page_id, sections array<struct<path, content>>): the rolled-up sections of a page in document order."""
    rows = roll_up(nodes, levels)
    item = F.struct("parent_id", "ord", "path", "content")
    return rows.groupBy("page_id").agg(F.array_sort(F.collect_list(item)).alias("s")).select(
        "page_id", F.transform("s", lambda x: F.struct(x["path"].alias("path"), x["content"].alias("content"))).alias("sections"))


# --- links ---------------------------------------------------------------------------------------

def page_links(nodes: DataFrame, pattern: str = ARTICLE_LINK) -> DataFrame:
    """(page_id, ord, link): href values of the page's anchors matching ``pattern``, in page order (ord
    from 0), whatever their quoting and case; comments and scripts hold no anchors."""
    hrefs = nodes.filter(F.col("tag") == "a").select("page_id", "node_id", F.col("attrs")["href"].alias("link"))
    kept = hrefs.filter(F.col("link").rlike(pattern))
    w = Window.partitionBy("page_id").orderBy("node_id")
    return kept.select("page_id", (F.row_number().over(w) - 1).alias("ord"), "link")


def unvisited_links(links: DataFrame, visited: DataFrame, col: str = "link") -> DataFrame:
    """Links whose target is not in the visited list (hash anti-join, no linear scans)."""
    return links.join(visited.select(F.col(col).alias("link")).distinct(), "link", "left_anti")


def next_link(links: DataFrame) -> DataFrame:
    """(page_id, link): first link of each page in page order."""
    return links.groupBy("page_id").agg(F.min_by("link", "ord").alias("link"))


def random_link(links: DataFrame, seed: int = 0, step: int = 0) -> DataFrame:
    """(page_id, link): a pseudo-random link per page, repeatable for a given seed and step."""
    return links.groupBy("page_id").agg(
        F.min_by("link", F.md5(F.concat_ws("|", F.lit(seed), F.lit(step), F.col("ord"), F.col("link")).cast("binary"))).alias("link"))


def regex_flag(text: Column, pattern: str) -> Column:
    """1 when the case-insensitive ``pattern`` occurs in ``text``, else 0."""
    return F.coalesce(text.rlike("(?i)" + pattern), F.lit(False)).cast("int")


def regex_share(pages: DataFrame, pattern: str, col: str = "html") -> DataFrame:
    """(n_pages, n_matching, share): fraction of pages whose text matches ``pattern``."""
    flag = regex_flag(F.col(col), pattern)
    return pages.agg(F.count(F.lit(1)).alias("n_pages"), F.sum(flag).cast("bigint").alias("n_matching"),
                     F.avg(flag).alias("share"))


def best_match_by_length(values: Column, patterns: Sequence[str], default: str = "not found") -> Column:
    """Longest of the literal ``patterns`` contained in ``values``, else ``default``.

    The pattern list is a driver-side literal, so the lookup is one CASE expression evaluated in the
    scan (no join, no broadcast): patterns are tried longest first.
    """
    ordered = sorted(dict.fromkeys(patterns), key=lambda p: (-len(p), p))
    out = None
    for p in ordered:
        cond = F.instr(values, p) > 0
        out = F.when(cond, F.lit(p)) if out is None else out.when(cond, F.lit(p))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


#: Length of the parts by which values meet patterns.
GRAM = 4


def _grams(text: str, n: int) -> str:
    """SQL for the distinct parts of ``text`` that are ``n`` long."""
    return (f"case when length({text}) >= {n} then array_distinct(transform(sequence(1, length({text}) - {n} + 1), "
            f"i -> substring({text}, i, {n}))) else cast(array() as array<string>) end")


def anchored(patterns: DataFrame, pattern: str, values: DataFrame, value: str, n: int = GRAM) -> DataFrame:
    """(pattern, anchor): each distinct pattern under the one of its ``n``-long parts that fewest rows of
    ``values`` hold (the first by name of equal ones); a shorter pattern is its own anchor.

    Parts are counted over the values with partial aggregation, and only those that occur in some
    pattern. A pattern with a part that no value holds matches nothing and gets no anchor.
    """
    pats = patterns.select(F.col(pattern).alias("pattern")).where(F.length("pattern") > 0).distinct()
    parts = pats.select("pattern", F.explode(F.expr(f"case when length(pattern) < {n} then array(pattern) else {_grams('pattern', n)} end")).alias("gram"))
    seen = values.select(F.explode(F.expr(_grams(f"`{value}`", n))).alias("gram")).groupBy("gram").agg(F.count("*").alias("held"))
    known = parts.where(F.length("gram") == n).hint("merge").join(seen.hint("merge"), "gram", "left")
    best = known.groupBy("pattern").agg(F.min(F.struct(F.coalesce("held", F.lit(0)).alias("held"), "gram")).alias("a"))
    long = best.where("a.held > 0").select("pattern", F.col("a.gram").alias("anchor"))
    return long.unionByName(pats.where(F.length("pattern") < n).select("pattern", F.col("pattern").alias("anchor")))


def best_match_table(df: DataFrame, key: str, value: str, patterns: DataFrame, pattern: str,
                     default: str = "not found", n: int = GRAM) -> DataFrame:
    """``df`` with ``best``: the longest of the ``patterns`` contained in ``value`` (the first by name of
    equal ones), else ``default``. ``key`` tells rows apart; rows with one key must have one value.

    Equal values are matched once. Neither values nor patterns are broadcast: their tables are small only when
    compressed, and would be whole in the driver.

    The patterns are a table of any size. Each is stored under its rarest ``n``-long part (:func:`anchored`), values
    are cut into parts of that one length (and of the lengths below it that some pattern has), and a
    value meets only the patterns whose anchor it holds, which are then verified. A value without parts
    that anchor a pattern is never shuffled with one.
    """
    values = df.select(F.col(value).alias("__value")).where(F.col(value).isNotNull()).distinct()
    index = anchored(patterns, pattern, values, "__value", n)
    short = sorted(r[0] for r in index.where(F.length("anchor") < n).select(F.length("anchor")).distinct().collect())  # below n
    cuts = [F.expr(_grams("__value", k)) for k in [*short, n]]
    grams = values.select("__value", F.explode(F.array_distinct(F.concat(*cuts))).alias("anchor"))
    met = grams.hint("merge").join(index.hint("merge"), "anchor").where(F.expr("contains(__value, pattern)"))
    found = met.groupBy("__value").agg(F.min(F.struct((-F.length("pattern")).alias("n"), F.col("pattern").alias("best")))["best"].alias("best"))
    out = df.hint("merge").join(found.hint("merge"), df[value] == found["__value"], "left").drop("__value")
    return out.withColumn("best", F.coalesce("best", F.lit(default)))


def best_template(nodes: DataFrame, templates: Sequence[tuple[str, str, dict]]) -> DataFrame:
    """(page_id, node_id, template) for every node matched by a template.

    A template ``(name, tag, attrs)`` matches a node with that tag holding every listed attribute
    value; the match with the most attributes wins and, on equal counts, the template registered
    first. Nodes without a match get no row (no action). The literal template list becomes one CASE
    expression per node.
    """
    ranked = sorted(enumerate(templates), key=lambda it: (-len(it[1][2]), it[0]))
    pick = None
    for _, (name, tag, attrs) in ranked:
        cond = F.col("tag") == tag.lower()
        for k, v in attrs.items():
            cond = cond & F.coalesce(F.col("attrs")[k] == v, F.lit(False))
        pick = F.when(cond, F.lit(name)) if pick is None else pick.when(cond, F.lit(name))
    out = nodes.select("page_id", "node_id", pick.alias("template"))
    return out.filter(F.col("template").isNotNull())


#: Nodes that a task of :func:`best_template_table` takes, and the buckets in which it takes them; template tags, up to
#: which nodes of other tags are left out as they are read.
TASK_NODES, TASK_BUCKETS, MOST_TAGS = 200_000, 32, 1000

#: What rows of one node hold.
KIND = "array<struct<tag:string,attrs:array<struct<key:string,value:string>>>>"


def best_template_table(nodes: DataFrame, templates: DataFrame) -> DataFrame:
    """(page_id, node_id, template): as :func:`best_template`, with the templates (template, ord, tag, attrs
    map<string,string>) in a table of any size; ``ord`` is the order in which they were registered.

    What a node matches depends on its kind alone: its tag and attributes. Nodes are dealt out to buckets by their key,
    a task for every ``TASK_NODES`` of them, so that a task's memory does not grow with the input, however well its
    files are compressed. A bucket asks for each of its kinds once, kinds are matched once in all
    (:func:`_matched_kinds`), and the answers go back to the buckets that asked: a frequent kind is asked for as often
    as there are buckets, not nodes. Rows with one (page_id, node_id) are one node, which holds what any of them
    holds, as often as they hold it.
    """
    t = templates.select("template", "ord", F.lower("tag").alias("tag"), "attrs", F.coalesce(F.size("attrs"), F.lit(0)).alias("need"))
    t = t.withColumn("need", F.greatest("need", F.lit(0)))
    # templates with the same needs: the first of them
    same = t.groupBy("tag", F.array_sort(F.map_entries(F.coalesce("attrs", F.create_map().cast("map<string,string>")))).alias("needs")).agg(
        F.min(F.struct("ord", "template")).alias("t"), F.first("need").alias("need"))
    tags = [r.tag for r in t.select("tag").where("tag is not null").distinct().limit(MOST_TAGS + 1).collect()]
    if len(tags) <= MOST_TAGS:
        nodes = nodes.where(F.col("tag").isin(tags))
    tasks = max(nodes.sparkSession.sparkContext.defaultParallelism, -(-nodes.count() // TASK_NODES))
    bucket = F.pmod(F.xxhash64("page_id", "node_id"), F.lit(tasks * TASK_BUCKETS)).alias("bucket")
    held = F.struct("tag", F.expr("coalesce(map_entries(attrs), array())").alias("attrs")).alias("held")
    dealt = nodes.select("page_id", "node_id", held, bucket).repartition(tasks, "bucket")
    one = dealt.groupBy("bucket", "page_id", "node_id").agg(F.array_sort(F.collect_list("held")).cast(KIND).alias("kind"))
    asked = stage(one.select("bucket", "kind").distinct(), "asked_kinds").repartition(tasks, "kind")
    best = _matched_kinds(asked.select("kind").distinct(), same)
    answers = asked.hint("merge").join(best.hint("merge"), "kind")
    by = [tasks, "bucket", "kind"]
    return one.repartition(*by).join(answers.repartition(*by).hint("shuffle_hash"), by[1:]).select("page_id", "node_id", "template")


def _matched_kinds(kinds: DataFrame, same: DataFrame) -> DataFrame:
    """(kind, template): the best of the templates (tag, needs, t, need) for each kind (``KIND``) that one matches.

    A relational division: a template matches the kinds that hold as many of its attributes as it has. It stands under
    the attribute that fewest kinds hold, which a kind that holds each attribute once must hold, and is verified there.
    A kind that holds one twice meets templates under all of their attributes. Templates without attributes match on
    the tag alone; only the first of a tag can win there.
    """
    on = ["tag", "key", "value"]
    asks = same.where("need > 0").select("tag", "need", "t", F.explode("needs").alias("e")).groupBy("t").agg(
        F.first("need").alias("need"), F.collect_list(F.struct("tag", F.col("e.key").alias("key"), F.col("e.value").alias("value"))).alias("asks"))
    each = asks.select("t", "need", "asks", F.explode(F.array_distinct("asks")).alias("e")).select("t", "need", "asks", "e.*")
    kinds = kinds.withColumn("held", F.expr("flatten(transform(kind, k -> transform(k.attrs, e -> struct(k.tag as tag, e.key as key, e.value as value))))"))
    held = kinds.select("kind", (F.size(F.array_distinct("held")) < F.size("held")).alias("twice"), F.explode(F.array_distinct("held")).alias("e"))
    held = held.select("kind", "twice", "e.*")
    seen = held.groupBy(*on).agg(F.count("*").alias("n"))
    rated = each.hint("merge").join(seen.hint("merge"), on, "left")
    # templates that share (ord, template) are one, which asks for more than it needs: it also stands under all
    rarest = rated.where(F.size("asks") == F.col("need")).groupBy("t").agg(
        F.first("need").alias("need"), F.first("asks").alias("asks"), F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), *on)).alias("e"))
    once = rarest.where("e.n > 0").select("t", "need", "asks", *[F.col(f"e.{c}").alias(c) for c in on]).unionByName(
        each.where(F.size("asks") != F.col("need")))
    index = once.withColumn("twice", F.lit(False)).unionByName(each.withColumn("twice", F.lit(True)))
    met = held.hint("merge").join(index.hint("merge"), ["twice", *on])
    n = F.expr("aggregate(asks, 0, (n, a) -> n + aggregate(kind, 0, (m, k) -> m + "
               "if(k.tag = a.tag, size(filter(k.attrs, e -> e.key = a.key and e.value = a.value)), 0)))")
    full = met.where(n == F.col("need")).select("kind", "need", "t")
    tags = kinds.select("kind", F.explode(F.array_distinct("kind.tag")).alias("tag"))
    plain = tags.hint("merge").join(same.where("need = 0").select("tag", "need", "t").hint("merge"), "tag").drop("tag")
    best = full.unionByName(plain).groupBy("kind").agg(F.min(F.struct((-F.col("need")).alias("need"), "t")).alias("b"))
    return best.select("kind", F.col("b.t.template").alias("template"))
