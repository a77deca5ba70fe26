"""Page queries: node table, selectors, nearest-key rules, article parts, links, templates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from tessera.functions.extract import constant
from tessera.operators import pages as pg
from tessera.operators.nodes import key_left, key_right, key_up, select, selector
from tessera.operators.rules import Rule, post_process, record, record_long, run_rules
from tessera.plans.common import finalize
from tessera.plans.registry import query, table
from tessera.session import materialize, ship_package, spread
from tessera.sources.html_nodes import flat, page_trees, register_table_functions

# Link pattern for the test pages: in-site links are "/word" (no scheme, no query, no colon).
SITE_LINK = r"^/[^:?#/]+$"


def nodes(spark, sf_dir):
    """Node table of the pages, over page trees that are parsed once per application and stored as parquet
    (text once a page); a query reads the node fields and texts that it uses."""
    return flat(materialize(lambda: page_trees(table(spark, sf_dir, "pages")), "nodes", key=f"nodes:{sf_dir}", spark=spark))


def decode(x: str) -> str:
    """DuckDB entity decoding for the entities present in the pages (ampersand last). These are
    legacy named references, so the closing semicolon is optional, as in HTML5 parsing."""
    for ent, ch in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        x = f"regexp_replace({x}, '&{ent};?', '{ch}', 'g')"
    return x


def strip_tags(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]*>', '', 'g')"


TITLE_SQL = decode(strip_tags("regexp_extract(html, '<h1>(.*?)</h1>', 1)"))


@query("node_table", """
SELECT page_id, t AS tag, count(*) AS n
FROM (SELECT page_id, unnest(regexp_extract_all(html, '<([a-zA-Z0-9]+)', 1)) AS t FROM pages)
GROUP BY page_id, t
""")
def q_node_table(spark, sf_dir):
    return finalize(nodes(spark, sf_dir).groupBy("page_id", "tag").agg(F.count(F.lit(1)).alias("n")))


@query("sel_simple", f"""
SELECT page_id, {decode('t')} AS text
FROM (SELECT page_id, unnest(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1),
                                                '<a [^>]*>([^<]*)</a>', 1)) AS t FROM pages)
""")
def q_sel_simple(spark, sf_dir):
    return finalize(select(nodes(spark, sf_dir), selector("nav", " ", "li", " ", "a")).select("page_id", "text"))


def _count_per_page(df, name):
    return finalize(df.groupBy("page_id").agg(F.count(F.lit(1)).alias(name)))


@query("sel_child", """
SELECT page_id, CAST(len(regexp_extract_all(html, '<p>')) AS BIGINT) AS n FROM pages
WHERE len(regexp_extract_all(html, '<p>')) > 0
""")
def q_sel_child(spark, sf_dir):
    return _count_per_page(select(nodes(spark, sf_dir), selector("article", ">", "p")), "n")


@query("sel_descendant", """
SELECT page_id, CAST(len(regexp_extract_all(html, '<b>')) AS BIGINT) AS n FROM pages
WHERE len(regexp_extract_all(html, '<b>')) > 0
""")
def q_sel_descendant(spark, sf_dir):
    return _count_per_page(select(nodes(spark, sf_dir), selector("article", " ", "b")), "n")


@query("sel_adjacent", f"""
SELECT page_id, {decode(strip_tags("regexp_extract(html, '</h1><p>(.*?)(<p>|</p>|</article>)', 1)"))} AS text
FROM pages WHERE regexp_matches(html, '</h1><p>')
""")
def q_sel_adjacent(spark, sf_dir):
    return finalize(select(nodes(spark, sf_dir), selector("h1", "+", "p")).select("page_id", "text"))


@query("sel_sibling", """
SELECT page_id, CAST(len(regexp_extract_all(html, '<p>')) AS BIGINT) AS n FROM pages
WHERE len(regexp_extract_all(html, '<p>')) > 0
""")
def q_sel_sibling(spark, sf_dir):
    return _count_per_page(select(nodes(spark, sf_dir), selector("h1", "~", "p")), "n")


def _n_values(values):
    g = record_long(values)
    return finalize(g.select("page_id", "key", F.size("values").alias("n_values")))


@query("key_left", f"""
SELECT page_id, trim({TITLE_SQL}) AS key, CAST(len(regexp_extract_all(html, '<p>')) AS BIGINT) AS n_values
FROM pages WHERE len(regexp_extract_all(html, '<p>')) > 0
""")
def q_key_left(spark, sf_dir):
    rules = [Rule("h1", tuple(selector("h1")), key="text"),
             Rule("p", tuple(selector("article", ">", "p")), get=("h1", "<"), val="text")]
    return _n_values(run_rules(nodes(spark, sf_dir), rules))


@query("key_right", f"""
SELECT page_id, trim({decode(strip_tags("regexp_extract(html, '(?s)<div class=\"ad\">(.*?)</div>', 1)"))}) AS key,
       trim({decode(strip_tags("regexp_extract(html, '<nav>(.*?)</nav>', 1)"))}) AS value
FROM pages
""")
def q_key_right(spark, sf_dir):
    rules = [Rule("ad", tuple(selector("div.ad")), key="text"),
             Rule("nav", tuple(selector("nav")), get=("ad", ">"), val="text")]
    v = run_rules(nodes(spark, sf_dir), rules)
    return finalize(v.select("page_id", "key", "value"))


@query("key_up", f"""
SELECT page_id, trim({TITLE_SQL}) AS key, CAST(len(regexp_extract_all(html, '<b>')) AS BIGINT) AS n_values
FROM pages WHERE len(regexp_extract_all(html, '<b>')) > 0
""")
def q_key_up(spark, sf_dir):
    rules = [Rule("h1", tuple(selector("h1")), key="text"),
             Rule("b", tuple(selector("b")), get=("h1", "^"), val="text")]
    return _n_values(run_rules(nodes(spark, sf_dir), rules))


def page_rules():
    return [Rule("h1", tuple(selector("h1")), key="text"),
            Rule("links", tuple(selector("nav", " ", "li", " ", "a")), key=constant("links"), val="text"),
            Rule("paras", tuple(selector("article", ">", "p")), get=("h1", "<"), val="text"),
            Rule("bold", tuple(selector("article", " ", "b")), key=constant("bold"), val="text"),
            Rule("footer", tuple(selector("footer")), key=constant("footer"), val="text")]


RECORD_SQL = f"""
SELECT page_id, 'links' AS key, CAST(len(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1), '<a ')) AS BIGINT) AS n_values
FROM pages WHERE len(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1), '<a ')) > 0
UNION ALL
SELECT page_id, trim({TITLE_SQL}), CAST(len(regexp_extract_all(html, '<p>')) AS BIGINT)
FROM pages WHERE len(regexp_extract_all(html, '<p>')) > 0
UNION ALL
SELECT page_id, 'bold', CAST(len(regexp_extract_all(html, '<b>')) AS BIGINT)
FROM pages WHERE len(regexp_extract_all(html, '<b>')) > 0
UNION ALL
SELECT page_id, 'footer', CAST(len(regexp_extract_all(html, '<footer')) AS BIGINT)
FROM pages WHERE len(regexp_extract_all(html, '<footer')) > 0
"""


@query("rule_record", RECORD_SQL)
def q_rule_record(spark, sf_dir):
    return _n_values(run_rules(nodes(spark, sf_dir), page_rules()))


@query("worth_filter", """
SELECT page_id, CAST(len(regexp_extract_all(html, '<b>')) AS BIGINT) AS n_bold FROM pages
WHERE len(regexp_extract_all(html, '<b>')) > 0
""")
def q_worth_filter(spark, sf_dir):
    return finalize(_worth(spark, sf_dir))


def _worth(spark, sf_dir):
    """Pages with the key 'bold': only the rules that give this key are run."""
    rules = [r for r in page_rules() if r.key == constant("bold")]
    values = run_rules(nodes(spark, sf_dir), rules).filter(F.col("key") == "bold")
    return values.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_bold"))


@query("first_n_worth", """
SELECT page_id, CAST(len(regexp_extract_all(html, '<b>')) AS BIGINT) AS n_bold FROM pages
WHERE len(regexp_extract_all(html, '<b>')) > 0 ORDER BY page_id LIMIT 5
""")
def q_first_n_worth(spark, sf_dir):
    # the first n qualifying records in page order (the limit is the operator)
    return finalize(_worth(spark, sf_dir).orderBy("page_id").limit(5))


@query("page_title", f"""
SELECT page_id, {TITLE_SQL} AS title FROM pages WHERE regexp_matches(html, '<h1>')
""")
def q_page_title(spark, sf_dir):
    return finalize(pg.page_title(nodes(spark, sf_dir)))



PARAS_SQL = f"""
paras AS (
  SELECT page_id, idx,
         {decode(strip_tags("regexp_extract(part, '(?s)^(.*?)(</p>|</article>|$)', 1)"))} AS text
  FROM (SELECT page_id, unnest(parts[2:]) AS part, generate_subscripts(parts[2:], 1) AS idx
        FROM (SELECT page_id, string_split(html, '<p>') AS parts FROM pages))
)"""

@query("page_paragraphs", f"""
WITH {PARAS_SQL.strip()}
SELECT page_id, string_agg('<p>' || text, '' ORDER BY idx) AS content FROM paras GROUP BY page_id
""")
def q_page_paragraphs(spark, sf_dir):
    return finalize(pg.page_paragraphs(nodes(spark, sf_dir)))


@query("page_text_blocks", f"""
WITH {PARAS_SQL.strip()},
lists AS (
  SELECT page_id, 0 AS idx, {decode(strip_tags("regexp_extract(html, '(?s)<ul>(.*?)</ul>', 1)"))} AS text
  FROM pages WHERE regexp_matches(html, '<ul>')
),
blocks AS (SELECT page_id, 0 AS k, idx, 'ul' AS tag, text FROM lists
           UNION ALL SELECT page_id, 1, idx, 'p', text FROM paras)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY k, idx) - 1 AS BIGINT) AS ord, tag, text
FROM blocks
""")
def q_page_text_blocks(spark, sf_dir):
    # blocks numbered in document order within each page (a per-page window)
    b = pg.page_text_blocks(nodes(spark, sf_dir))
    w = Window.partitionBy("page_id").orderBy("node_id")
    return finalize(b.select("page_id", (F.row_number().over(w) - 1).alias("ord"), "tag", "text"))


@query("page_intro", f"""
WITH {PARAS_SQL.strip()}
SELECT page_id, string_agg(text || chr(10), '' ORDER BY idx) AS introduction FROM paras GROUP BY page_id
""")
def q_page_intro(spark, sf_dir):
    return finalize(pg.page_intro(nodes(spark, sf_dir)))


# Article pages derived from ``part``: an infobox, sections with and without content, a labelled bar.
def articles(spark, sf_dir):
    """Node table of the article pages, stored once per application."""
    return flat(materialize(lambda: page_trees(article_pages(spark, sf_dir), count=table(spark, sf_dir, "part").count()), "articles", key=f"articles:{sf_dir}", spark=spark))


def article_pages(spark, sf_dir):
    size = F.col("p_size").cast("string")
    html = F.concat(
        F.lit("<h1>"), "p_name", F.lit("</h1><p>About "), "p_brand", F.lit('.</p><table class="infobox wide"><tbody><tr><th>Type</th><td>'), "p_type",
        F.lit("</td></tr><tr><th>Size</th><td>"), size, F.lit("</td></tr></tbody></table><h2>Make</h2><p>Made by "), "p_brand",
        F.lit("</p><h3>Sizes</h3><ul><li>"), size, F.lit("</li></ul><h2>Price</h2><h3>None</h3><h2>References</h2><p>r</p>"
        '<div id="box"><p><b> Kind </b>: <i>of</i> '), "p_type", F.lit(", <u>"), "p_brand", F.lit('</u></p></div><span class="l">Width</span>'
        '<div class="bar" style="width:'), (F.col("p_size") * 21).cast("string"), F.lit('px;">.</div><p class="bio">'), "p_name",
        F.lit('</p><p class="bio">'), "p_brand", F.lit("</p>"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page_id"), html.alias("html"))


@query("page_infobox", """
SELECT p_partkey AS page_id, p_type || chr(10) || p_size || chr(10) AS infobox FROM part
""")
def q_page_infobox(spark, sf_dir):
    return finalize(pg.page_infobox(articles(spark, sf_dir)))


@query("page_sections", """
SELECT p_partkey AS page_id, 'Make' AS section, NULL AS subsection, 'Made by ' || p_brand || chr(10) AS content FROM part
UNION ALL SELECT p_partkey, 'Make', 'Sizes', p_size || chr(10) FROM part
""")
def q_page_sections(spark, sf_dir):
    return finalize(pg.page_sections(articles(spark, sf_dir)))


@query("rule_post_process", """
SELECT p_partkey AS page_id, 'Kind' AS key, CAST(NULL AS BIGINT) AS rating, 'of ' || p_type || '|' || p_brand AS parts, NULL AS content FROM part
UNION ALL SELECT p_partkey, 'Width', CASE WHEN p_size <= 6 THEN p_size ELSE 7 END, NULL, NULL FROM part
UNION ALL SELECT p_partkey, 'Content', NULL, NULL, p_name || p_brand FROM part
""")
def q_rule_post_process(spark, sf_dir):
    rules = [Rule("p", tuple(selector("#box", " ", "p")), key="bold", val="unmarkedtext"),
             Rule("label", tuple(selector("span.l")), key="text"),
             Rule("bar", tuple(selector("div.bar")), get=("label", "<"), val="width"),
             Rule("bio", tuple(selector("p.bio")), key=constant("Content"), val="text")]
    out = post_process(record_long(run_rules(articles(spark, sf_dir), rules)))
    return finalize(out.select("page_id", "key", F.col("rating").cast("bigint").alias("rating"), F.array_join("parts", "|").alias("parts"), "content"))


@query("selector_values", """
SELECT 'child' AS kind, p_partkey AS page_id, ' Kind : of ' || p_type || ', ' || p_brand AS text FROM part
UNION ALL SELECT 'descendant', p_partkey, p_type FROM part UNION ALL SELECT 'descendant', p_partkey, CAST(p_size AS VARCHAR) FROM part
UNION ALL SELECT 'adjacent', p_partkey, 'Made by ' || p_brand FROM part UNION ALL SELECT 'adjacent', p_partkey, 'r' FROM part
UNION ALL SELECT 'sibling', p_partkey, unnest(['r', p_name, p_brand]) FROM part
UNION ALL SELECT 'class', p_partkey, unnest([p_name, p_brand]) FROM part
""")
def q_selector_values(spark, sf_dir):
    n = articles(spark, sf_dir)
    picks = {"child": selector("#box", ">", "p"), "descendant": selector("table", " ", "td"), "adjacent": selector("h2", "+", "p"),
             "sibling": selector("h3", "~", "p"), "class": selector(".bio")}
    frames = [select(n, s).select(F.lit(k).alias("kind"), "page_id", "text") for k, s in picks.items()]
    return finalize(reduce(lambda a, b: a.unionByName(b), frames))


@query("key_values", """
SELECT 'left' AS side, p_partkey AS page_id, 'Make' AS key, 'Made by ' || p_brand AS value FROM part
UNION ALL SELECT 'left', p_partkey, 'References', unnest(['r', p_name, p_brand]) FROM part
UNION ALL SELECT 'left', p_partkey, NULL, 'About ' || p_brand || '.' FROM part
UNION ALL SELECT 'right', p_partkey, 'Make', 'About ' || p_brand || '.' FROM part
UNION ALL SELECT 'right', p_partkey, 'Price', 'Made by ' || p_brand FROM part
UNION ALL SELECT 'right', p_partkey, NULL, unnest(['r', p_name, p_brand]) FROM part
UNION ALL SELECT 'up', p_partkey, p_name, unnest([p_type, CAST(p_size AS VARCHAR)]) FROM part
""")
def q_key_values(spark, sf_dir):
    n = articles(spark, sf_dir)
    heads = select(n, selector("h2")).withColumn("key", F.col("text"))
    paras = select(n, selector("p")).filter(F.col("parent_id").isNull())
    cells, title = select(n, selector("td")), select(n, selector("h1")).withColumn("key", F.col("text"))
    frames = []
    for name, found, targets in (("left", key_left(heads, paras), paras), ("right", key_right(heads, paras), paras), ("up", key_up(title, cells), cells)):
        frames.append(targets.select("page_id", "node_id", F.col("text").alias("value")).join(found, ["page_id", "node_id"], "left")
                      .select(F.lit(name).alias("side"), "page_id", "key", "value"))
    return finalize(reduce(lambda a, b: a.unionByName(b), frames))


LINKS_SQL = """
hrefs AS (
  SELECT page_id, generate_subscripts(l, 1) AS pos, unnest(l) AS link
  FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages)
),
kept AS (
  SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS BIGINT) AS ord, link
  FROM hrefs WHERE regexp_matches(link, '^/[^:?#/]+$')
)"""


@query("page_links", f"""
WITH {LINKS_SQL.strip()}
SELECT page_id, ord, link FROM kept
""")
def q_page_links(spark, sf_dir):
    return finalize(pg.page_links(nodes(spark, sf_dir), SITE_LINK))


# Visited list derived from the pages: '/' + every page title, spaces as '_'.
def _visited(spark, sf_dir):
    t = pg.page_title(nodes(spark, sf_dir))
    return t.select(F.concat(F.lit("/"), F.replace(F.trim("title"), F.lit(" "), F.lit("_"))).alias("link"))


VISITED_SQL = f"visited AS (SELECT DISTINCT '/' || replace(trim({TITLE_SQL}), ' ', '_') AS link FROM pages WHERE regexp_matches(html, '<h1>'))"


@query("unvisited_links", f"""
WITH {LINKS_SQL.strip()}, {VISITED_SQL}
SELECT page_id, ord, link FROM kept WHERE link NOT IN (SELECT link FROM visited)
""")
def q_unvisited_links(spark, sf_dir):
    links = pg.page_links(nodes(spark, sf_dir), SITE_LINK)
    return finalize(pg.unvisited_links(links, _visited(spark, sf_dir)))


@query("next_link", f"""
WITH {LINKS_SQL.strip()}, {VISITED_SQL}
SELECT page_id, arg_min(link, ord) AS link FROM kept WHERE link NOT IN (SELECT link FROM visited) GROUP BY page_id
""")
def q_next_link(spark, sf_dir):
    links = pg.page_links(nodes(spark, sf_dir), SITE_LINK)
    return finalize(pg.next_link(pg.unvisited_links(links, _visited(spark, sf_dir))))


@query("random_link", f"""
WITH {LINKS_SQL.strip()}
SELECT page_id, arg_min(link, md5('7|0|' || ord || '|' || link)) AS link FROM kept GROUP BY page_id
""")
def q_random_link(spark, sf_dir):
    links = pg.page_links(nodes(spark, sf_dir), SITE_LINK)
    return finalize(pg.random_link(links, seed=7))


@query("regex_share", """
SELECT count(*) AS n_pages, CAST(sum(CASE WHEN regexp_matches(html, '(?i)ouelle') THEN 1 ELSE 0 END) AS BIGINT) AS n_matching,
       round(avg(CASE WHEN regexp_matches(html, '(?i)ouelle') THEN 1 ELSE 0 END), 6) AS share
FROM pages
""")
def q_regex_share(spark, sf_dir):
    out = pg.regex_share(table(spark, sf_dir, "pages"), "ouelle")
    return finalize(out.withColumn("share", F.round("share", 6)))


TEMPLATES = [("link", "a", {}), ("ad", "div", {"class": "ad"}), ("block", "div", {}), ("menu", "nav", {})]


@query("best_template", """
SELECT page_id, 'link' AS template, CAST(len(regexp_extract_all(html, '<a ')) AS BIGINT) AS n FROM pages
WHERE len(regexp_extract_all(html, '<a ')) > 0
UNION ALL
SELECT page_id, 'ad', CAST(len(regexp_extract_all(html, '<div class="ad"')) AS BIGINT) FROM pages
WHERE len(regexp_extract_all(html, '<div class="ad"')) > 0
UNION ALL
SELECT page_id, 'block', CAST(len(regexp_extract_all(html, '<div')) - len(regexp_extract_all(html, '<div class="ad"')) AS BIGINT)
FROM pages WHERE len(regexp_extract_all(html, '<div')) - len(regexp_extract_all(html, '<div class="ad"')) > 0
UNION ALL
SELECT page_id, 'menu', CAST(len(regexp_extract_all(html, '<nav')) AS BIGINT) FROM pages
WHERE len(regexp_extract_all(html, '<nav')) > 0
""")
def q_best_template(spark, sf_dir):
    m = pg.best_template(nodes(spark, sf_dir), TEMPLATES)
    return finalize(m.groupBy("page_id", "template").agg(F.count(F.lit(1)).alias("n")))


@query("best_template_table", """
SELECT p_partkey AS page_id, 'block' AS template FROM part
UNION ALL SELECT p_partkey, CASE WHEN p_size IN (SELECT 2 * p_size FROM part) THEN 'size ' || CAST(p_size / 2 AS BIGINT) ELSE 'bar' END FROM part
UNION ALL SELECT p_partkey, unnest(['life', 'life']) FROM part
""")
def q_best_template_table(spark, sf_dir):
    # templates from a table: one for the bar of each size of part, doubled, so bars of odd sizes fall back to the plain bar
    part = table(spark, sf_dir, "part")
    attrs = lambda **kv: F.create_map(*[x if isinstance(x, Column) else F.lit(x) for p in kv.items() for x in p])
    style = F.concat(F.lit("width:"), (F.col("p_size") * 42).cast("string"), F.lit("px;"))
    sizes = part.select("p_size").distinct().select(
        F.concat(F.lit("size "), "p_size").alias("template"), (F.col("p_size") + 100).alias("ord"), F.lit("div").alias("tag"),
        attrs(**{"class": "bar", "style": style}).alias("attrs"))
    one = spark.range(1)
    fixed = [("block", 3, "div", {}), ("bar", 2, "DIV", {"class": "bar"}), ("late bar", 9, "div", {"class": "bar"}), ("life", 4, "p", {"class": "bio"})]
    for name, ord_, tag, kv in fixed:
        made = attrs(**kv) if kv else F.create_map().cast("map<string,string>")
        sizes = sizes.unionByName(one.select(F.lit(name).alias("template"), F.lit(ord_).alias("ord"), F.lit(tag).alias("tag"), made.alias("attrs")))
    return finalize(pg.best_template_table(articles(spark, sf_dir), sizes).select("page_id", "template"))


def outline_pages(spark, sf_dir):
    """Pages with four levels of headings, derived from ``part``; odd parts lack the third."""
    h = [F.lit("<h1>"), "p_name", F.lit("</h1><p>before</p><h2>Make</h2><p>by "), "p_brand", F.lit("</p><h3>Kind</h3><ul><li>"), "p_type", F.lit("</li></ul>"),
         F.when(F.col("p_partkey") % 2 == 0, F.lit("<h4>Size</h4>")).otherwise(F.lit("")), F.lit("<p>"), F.col("p_size").cast("string"),
         F.lit("</p><h5>Price</h5><table><tr><td>skipped</td></tr></table><p>"), F.col("p_retailprice").cast("string"),
         F.lit("</p><hr><p>after the rule</p><h3>Late</h3><h2>End</h2><ol><li>"), "p_name", F.lit("</li></ol>")]
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page_id"), F.concat(*h).alias("html"))


# (heading, blocks it takes, what ends it besides itself); a rule ends the two lowest levels
OUTLINE = [("h2", pg.TEXT_BLOCKS, ["h1"]), ("h3", pg.TEXT_BLOCKS, ["h1", "h2"]), ("h4", ["p"], ["h1", "h2", "h3", "hr"]),
           ("h5", ["p"], ["h1", "h2", "h3", "h4", "hr"])]


@query("page_outline", """
WITH p AS (SELECT *, CAST(CAST(p_retailprice AS DOUBLE) AS VARCHAR) AS price FROM part)
SELECT p_partkey AS page_id, 'Make' AS path, 'by ' || p_brand || chr(10) AS content FROM p
UNION ALL SELECT p_partkey, 'Make/Kind', p_type || chr(10) || CASE WHEN p_partkey % 2 = 0 THEN '' ELSE p_size || chr(10) END || 'after the rule' || chr(10) FROM p
UNION ALL SELECT p_partkey, 'Make/Kind/Size', p_size || chr(10) FROM p WHERE p_partkey % 2 = 0
UNION ALL SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'Make/Kind/Size/Price' ELSE 'Make/Kind/Price' END, price || chr(10) FROM p
UNION ALL SELECT p_partkey, 'End', p_name || chr(10) FROM p
""")
def q_page_outline(spark, sf_dir):
    trees = materialize(lambda: page_trees(outline_pages(spark, sf_dir), count=table(spark, sf_dir, "part").count()), "outlines", key=f"outlines:{sf_dir}", spark=spark)
    out = pg.page_outline(flat(trees), OUTLINE).select("page_id", F.explode("sections").alias("s"))
    return finalize(out.select("page_id", F.array_join("s.path", "/").alias("path"), F.col("s.content").alias("content")))


@query("node_functions", f"""
WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS value FROM pages)
SELECT page_id, 'link' AS kind, {decode('value')} AS value FROM h
UNION ALL SELECT page_id, 'title', trim({TITLE_SQL}) FROM pages WHERE length(trim({TITLE_SQL})) >= 3
""")
def q_node_functions(spark, sf_dir):
    # two table functions with arguments, joined laterally with the pages
    register_table_functions(spark)
    spread(table(spark, sf_dir, "pages").select("page_id", "html"), "page_id").createOrReplaceTempView("tessera_pages")
    return finalize(spark.sql("""
        SELECT p.page_id, 'link' AS kind, f.value FROM tessera_pages p, LATERAL node_attributes(p.html, 'a', 'href') f
        UNION ALL SELECT p.page_id, 'title', f.value FROM tessera_pages p, LATERAL node_texts(p.html, 'h1', 3) f"""))


@query("rule_vector", """
SELECT p_partkey AS page_id, lower(replace(p_name, ' ', '-')) AS key, 'made-by-brand-' || replace(p_brand, 'Brand#', '') AS value FROM part
UNION ALL SELECT p_partkey, lower(replace(p_name, ' ', '-')), 'about-brand-' || replace(p_brand, 'Brand#', '') FROM part
""")
def q_rule_vector(spark, sf_dir):
    # a vectorised extractor for keys and values
    ship_package(spark)
    rules = [Rule("title", tuple(selector("h1")), key="slug"), Rule("make", tuple(selector("h2", "+", "p")), get=("title", "<"), val="slug"),
             Rule("about", tuple(selector("h1", "+", "p")), get=("title", "<"), val="slug")]
    values = run_rules(articles(spark, sf_dir), rules).filter(F.col("value") != "r")
    return finalize(values.select("page_id", "key", "value"))


URL_PATTERNS = ["example.com", "example.net", "example.org", ".example.com/en/", "https://", "http://",
                "?page=2", "#top", "/de/", "m."]


@query("longest_prefix_join", """
WITH pats(p) AS (VALUES ('example.com'), ('example.net'), ('example.org'), ('.example.com/en/'), ('https://'),
                        ('http://'), ('?page=2'), ('#top'), ('/de/'), ('m.'))
SELECT page_id, url, coalesce((SELECT p FROM pats WHERE contains(url, p) ORDER BY length(p) DESC, p ASC LIMIT 1),
                              'not found') AS best
FROM pages
""")
def q_longest_prefix_join(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return finalize(p.select("page_id", "url", pg.best_match_by_length(F.col("url"), URL_PATTERNS).alias("best")))


@query("longest_pattern_table", """
WITH v AS (SELECT 'part ' || p_partkey AS item, p_name || ' ' || p_brand || ' ' || p_type AS value FROM part
           UNION ALL SELECT 'supplier ' || s_suppkey, s_name FROM supplier
           UNION ALL SELECT 'customer ' || c_custkey, c_name || ' ' || c_mktsegment FROM customer),
pats AS (SELECT DISTINCT unnest([p_name, p_brand || ' ' || p_type, p_brand, string_split(p_name, ' ')[1], left(p_type, 3)]) AS p FROM part)
SELECT item, value, coalesce((SELECT arg_min(p, (-length(p), p)) FROM pats WHERE contains(value, p)), 'not found') AS best FROM v
""")
def q_longest_pattern_table(spark, sf_dir):
    part, supplier, customer = (table(spark, sf_dir, t) for t in ("part", "supplier", "customer"))
    pats = part.select(F.explode(F.array("p_name", F.concat_ws(" ", "p_brand", "p_type"), "p_brand", F.split("p_name", " ")[0],
                                         F.substring("p_type", 1, 3))).alias("p"))
    values = (part.select(F.concat(F.lit("part "), "p_partkey").alias("item"), F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("value"))
              .unionByName(supplier.select(F.concat(F.lit("supplier "), "s_suppkey").alias("item"), F.col("s_name").alias("value")))
              .unionByName(customer.select(F.concat(F.lit("customer "), "c_custkey").alias("item"),
                                           F.concat_ws(" ", "c_name", "c_mktsegment").alias("value"))))
    return finalize(pg.best_match_table(values, "item", "value", pats, "p"))
