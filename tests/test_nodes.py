"""Node table, selectors, nearest-key rules and article extraction (goldens by hand)."""

import pytest
from pyspark.sql import functions as F

from tessera.functions.extract import constant
from tessera.functions.text import rating_bucket, split_trim
from tessera.operators import pages as pg
from tessera.operators.nodes import key_left, key_right, key_up, select, selector
from tessera.operators.rules import Rule, record, run_rules
from tessera.sources.html_nodes import node_table, parse_page
from tests.conftest import DATA

WIKI = """<!DOCTYPE html><html><body><div id="content"><h1>Koala</h1>
<table class="infobox biota"><tr><th>Kingdom</th><td>Animalia</td></tr><tr><td>Phylum</td><td>Chordata</td></tr></table>
<p>The koala is a marsupial.</p><p>It lives in Australia.</p>
<h2>Taxonomy</h2><p>Named in 1817.</p><h3>Names</h3><p>Also koala bear.</p><ul><li>one</li></ul>
<h2>Empty</h2>
<h2>References</h2><p>ref 1</p>
</div></body></html>"""

TOLERANT = ('<html><head><script>var t="</p>";</script></head><body><article><h1>T &amp; U</h1>'
            '<p><b>Bold<br><p>Second</p></i><p>Third</article><!-- c --><footer>&copy; x</footer></body></html>')


def nodes_of(spark, pages):
    return node_table(spark.createDataFrame(pages, "page_id long, html string")).cache()


@pytest.fixture(scope="module")
def rule_nodes(spark):
    html = open(f"{DATA}/rules/content.html").read()
    return nodes_of(spark, [(1, html)])


def test_rule_golden(rule_nodes):
    rules = [Rule("h1", tuple(selector("h1")), key="text"),
             Rule("p", tuple(selector("p")), get=("h1", ">"), val="text"),
             Rule("a", tuple(selector("a")), get=("p", "^"), val="text")]
    rec = record(run_rules(rule_nodes, rules)).collect()[0].fields
    assert rec == {"Title": ["Hello There"], "Body": ["YoHi", "Hi"]}


def test_get_needs_earlier_rule(rule_nodes):
    with pytest.raises(ValueError):
        run_rules(rule_nodes, [Rule("p", tuple(selector("p")), get=("h1", ">"), val="text")])


def test_tolerant_tree():
    rows = parse_page(7, TOLERANT)
    by_tag = {}
    for r in rows:
        by_tag.setdefault(r[5], []).append(r)
    assert [r[8] for r in by_tag["p"]] == ["Bold", "Second", "Third"]
    art = by_tag["article"][0][1]
    assert all(r[2] == art for r in by_tag["p"])           # every p hangs under article
    assert by_tag["h1"][0][8] == "T & U"
    assert by_tag["footer"][0][8] == "© x"
    assert "script" in by_tag and by_tag["html"][0][8].find("</p>") < 0


def test_selectors(spark):
    n = nodes_of(spark, [(1, "<div><ul><li><a>x</a></li><li class='k'><a id='z'>y</a></li></ul>"
                             "<h1>h</h1><p>1</p><span>s</span><p>2</p></div>")])
    txt = lambda df: sorted(r.text for r in df.collect())
    assert txt(select(n, selector("ul", " ", "a"))) == ["x", "y"]
    assert txt(select(n, selector("ul", ">", "a"))) == []
    assert txt(select(n, selector("li.k", ">", "a#z"))) == ["y"]
    assert txt(select(n, selector("h1", "+", "p"))) == ["1"]
    assert txt(select(n, selector("h1", "~", "p"))) == ["1", "2"]
    assert txt(select(n, [selector("span"), selector("h1")])) == ["h", "s"]


def test_nearest_key_directions(spark):
    n = nodes_of(spark, [(1, "<body><h2>A</h2><p>1</p><h2>B</h2><div><p>2</p></div><p>3</p></body>")])
    reg = select(n, selector("h2")).withColumn("key", F.col("text"))
    ps = select(n, selector("p"))
    left = {r.node_id: r.key for r in key_left(reg, ps).collect()}
    right = {r.node_id: r.key for r in key_right(reg, ps).collect()}
    up = {r.node_id: r.key for r in key_up(reg, ps).collect()}
    ids = {r.text: r.node_id for r in ps.collect()}
    assert left == {ids["1"]: "A", ids["2"]: None, ids["3"]: "B"}
    assert right == {ids["1"]: "B", ids["2"]: None, ids["3"]: None}
    # up from p "2": parent div is not registered, its preceding sibling h2 "B" is
    assert up == {ids["2"]: "B"}


def test_article_parts(spark):
    n = nodes_of(spark, [(1, WIKI)])
    assert pg.page_title(n).collect()[0].title == "Koala"
    assert pg.page_infobox(n).collect()[0].infobox == "Animalia\nPhylum\nChordata\n"
    assert pg.page_intro(n).collect()[0].introduction == "The koala is a marsupial.\nIt lives in Australia.\n"
    secs = sorted((r.section, r.subsection or "", r.content) for r in pg.page_sections(n).collect())
    assert secs == [("Taxonomy", "", "Named in 1817.\n"), ("Taxonomy", "Names", "Also koala bear.\none\n")]
    paras = pg.page_paragraphs(n).collect()[0].content
    assert paras.startswith("<p>The koala") and paras.count("<p>") == 5


def test_best_template_most_attributes_then_first(spark):
    n = nodes_of(spark, [(1, '<div class="a" id="b">x</div><div class="a">y</div><div>z</div><span>q</span>')])
    t = [("plain", "div", {}), ("cls", "div", {"class": "a"}), ("cls2", "div", {"id": "b"}),
         ("both", "div", {"class": "a", "id": "b"}), ("cls_again", "div", {"class": "a"})]
    got = {r.node_id: r.template for r in pg.best_template(n, t).collect()}
    assert sorted(got.values()) == ["both", "cls", "plain"]


def test_extractors(spark):
    n = nodes_of(spark, [(1, '<div id="powerbox"><p><b> Energy </b>: <i>x</i> rest <u>y</u></p></div>'
                             '<div class="bar" style="width:42px;">.</div>')])
    rules = [Rule("p", tuple(selector("#powerbox", " ", "p")), key="bold", val="unmarkedtext"),
             Rule("bar", tuple(selector("div.bar")), key=constant("Bar"), val="width")]
    rec = record(run_rules(n, rules)).collect()[0].fields
    assert rec == {"Energy": ["x rest y"], "Bar": ["width:42px;"]}


def test_rating_and_split(spark):
    df = spark.createDataFrame([("width:21px;",), ("width:126px;",), ("width:30px;",), ("a, b ,c",)], "v string")
    out = df.select(rating_bucket(F.col("v")).alias("r"), split_trim(F.col("v")).alias("s")).collect()
    assert [r.r for r in out] == [1, 6, 7, None]
    assert out[3].s == ["a", "b", "c"]


def test_links(spark):
    pages = nodes_of(spark, [(1, '<!-- <a href="/wiki/No">n</a> --><a href="/wiki/A">a</a><a href="/wiki/File:x">f</a>'
                                 "<A HREF='/wiki/B'>b</A>" '<a href="http://x">x</a><a>none</a>')])
    links = pg.page_links(pages)
    assert [(r.ord, r.link) for r in links.orderBy("ord").collect()] == [(0, "/wiki/A"), (1, "/wiki/B")]
    seen = pages.sparkSession.createDataFrame([("/wiki/A",)], "link string")
    assert pg.next_link(pg.unvisited_links(links, seen)).collect()[0].link == "/wiki/B"
    r1 = pg.random_link(links, seed=3).collect()
    r2 = pg.random_link(links, seed=3).collect()
    assert r1 == r2


def test_post_process_ratings_content_split(spark):
    from tessera.operators.rules import post_process, record_long
    n = nodes_of(spark, [(1, '<div class="g"><span class="l">Power</span><div class="v" style="width:84px;">.</div>'
                             '<span class="l">Speed</span><div class="v" style="width:50px;">.</div></div>'
                             '<p class="bio">One.</p><p class="bio">Two.</p><i class="al">a, b ,c</i>')])
    rules = [Rule("label", tuple(selector(".g", " ", ".l")), key="text"),
             Rule("bar", tuple(selector(".g", " ", ".v")), get=("label", "<"), val="width"),
             Rule("bio", tuple(selector("p.bio")), key=constant("Content"), val="text"),
             Rule("al", tuple(selector("i.al")), key=constant("Aliases"), val="raw_text")]
    out = {r.key: r for r in post_process(record_long(run_rules(n, rules))).collect()}
    assert out["Power"].rating == 4 and out["Speed"].rating == 7
    assert out["Content"].content == "One.Two."
    assert out["Aliases"].parts == ["a", "b", "c"]


def test_side_table_declaration():
    from tessera.operators import side
    spec = side.TableSpec("docs", (("id", "TrieLong"), ("body", "Text")), "id")
    assert spec.side_tables() == {"body": {"name": "docs__body", "key": ["id", "position"],
                                           "columns": [("id", "BIGINT"), ("position", "INTEGER"),
                                                       ("piece", "VARCHAR")]}}


def test_same_tag_in_both_roles_never_finds_itself(spark):
    n = nodes_of(spark, [(1, "<body><p>a</p><p>b</p><p>c</p></body>")])
    reg = select(n, selector("p")).withColumn("key", F.col("text"))
    ps = select(n, selector("p"))
    left = {r.node_id: r.key for r in key_left(reg, ps).collect()}
    right = {r.node_id: r.key for r in key_right(reg, ps).collect()}
    ids = {r.text: r.node_id for r in ps.collect()}
    assert left == {ids["a"]: None, ids["b"]: "a", ids["c"]: "b"}
    assert right == {ids["a"]: "b", ids["b"]: "c", ids["c"]: None}


def test_key_up_takes_the_ancestor_itself_first(spark):
    n = nodes_of(spark, [(1, '<body><h2>H</h2><div class="s"><span><a>x</a></span></div></body>')])
    reg = (select(n, selector("div.s")).withColumn("key", F.lit("DIV"))
           .unionByName(select(n, selector("h2")).withColumn("key", F.col("text"))))
    a = select(n, selector("a"))
    assert [r.key for r in key_up(reg, a).collect()] == ["DIV"]
    only_h2 = select(n, selector("h2")).withColumn("key", F.col("text"))
    assert [r.key for r in key_up(only_h2, a).collect()] == ["H"]


def test_page_roots_are_siblings(spark):
    n = nodes_of(spark, [(1, "<h1>T</h1><p>one</p><p>two</p><h2>S</h2><p>three</p>")])
    assert [r.introduction for r in pg.page_intro(n).collect()] == ["one\ntwo\n"]
    assert [(r.section, r.content) for r in pg.page_sections(n).collect()] == [("S", "three\n")]
    assert select(n, selector("h1", "~", "p")).count() == 3 and select(n, selector("h1", "+", "p")).count() == 1


def test_infobox_cells_at_any_depth_but_not_of_nested_tables(spark):
    n = nodes_of(spark, [(1, '<table class="infobox x"><tbody><tr><td>a</td><td>b<table><tr><td>inner</td></tr></table></td></tr></tbody></table>'),
                         (2, "<p>none</p>")])
    assert {r.page_id: r.infobox for r in pg.page_infobox(n).collect()} == {1: "a\nbinner\n", 2: ""}


def test_a_value_without_a_key_is_an_error(spark):
    n = nodes_of(spark, [(1, "<body><h1>k</h1><p>v</p></body>"), (2, "<body><p>lost</p></body>")])
    rules = [Rule("h1", tuple(selector("h1")), key="text"), Rule("p", tuple(selector("p")), get=("h1", "<"), val="text")]
    with pytest.raises(Exception, match="no key found"):
        run_rules(n, rules).collect()
    assert [(r.key, r.value) for r in run_rules(n, rules, strict=False).collect()] == [("k", "v")]


def test_text_outside_elements_is_kept():
    rows = parse_page(1, "intro<p>x</p>tail &amp; end<p>y</p>\n")
    assert [(r[1], r[5], r[8]) for r in rows] == [(-1, "#page", "introxtail & endy\n"), (0, "p", "x"), (1, "p", "y")]
    assert rows[0][7] == "introtail & end\n" and [c["text"] for c in rows[0][9]] == ["intro", "x", "tail & end", "y", "\n"]
    assert [r[3] for r in rows[1:]] == [0, 1]                                # root elements stay neighbours
    assert [(r[5], r[7]) for r in parse_page(2, "plain text")] == [("#page", "plain text")]
    assert parse_page(3, " \n") == [] and [r[5] for r in parse_page(4, "\n<p>x</p>\n")] == ["p"]


def test_wildcards_do_not_match_the_page(spark):
    n = node_table(spark.createDataFrame([(1, "intro<p>x</p><b>y</b>")], "page_id long, html string"))
    assert n.where("tag = '#page'").count() == 1
    assert sorted(r.tag for r in select(n, selector("*")).collect()) == ["b", "p"]
    assert [r.tag for r in select(n, selector("*", "~", "*")).collect()] == ["b"]


def _random_html(rnd, depth=0):
    out = []
    for _ in range(rnd.randrange(1, 5)):
        tag, cls, id_ = rnd.choice("abis"), rnd.choice(["", " class='k'", " class='k  m'", " class='km'"]), rnd.choice(["", "", " id='z'"])
        inner = _random_html(rnd, depth + 1) if depth < 4 and rnd.random() < 0.6 else rnd.choice(["t", "", "é"])
        out.append(f"<{tag}{cls}{id_}>{inner}</{tag}>")
    return "".join(out)


def _matches(row, steps, by_id, kids):
    """Does a node match a selector, by walking its ancestors and siblings?"""
    def simple(n, s):
        classes = (n.attrs.get("class") or "").split()
        return (s.tag in (None, "*", n.tag)) and all(c in classes for c in s.classes) and (s.id is None or n.attrs.get("id") == s.id)

    def at(n, i):
        if not simple(n, steps[i][1]):
            return False
        comb = steps[i][0]
        if comb is None:
            return True
        if comb in " >":
            up = by_id.get(n.parent_id)
            while up is not None:
                if at(up, i - 1):
                    return True
                up = by_id.get(up.parent_id) if comb == " " else None
            return False
        left = [x for x in kids[n.parent_id] if x.sib_idx < n.sib_idx]
        return any(at(x, i - 1) for x in (left if comb == "~" else [x for x in left if x.sib_idx == n.sib_idx - 1]))
    return at(row, len(steps) - 1)


def test_selectors_match_a_walk_over_random_trees(spark):
    import random

    from tessera.operators.nodes import match

    rnd = random.Random(11)
    n = nodes_of(spark, [(i, _random_html(rnd)) for i in range(25)])
    pages = {}
    for r in n.collect():
        pages.setdefault(r.page_id, []).append(r)
    sels = []
    for _ in range(70):
        parts = [rnd.choice(["a", "b", ".k", "i.m", "#z", "*", "s"])]
        for _ in range(rnd.randrange(0, 5)):
            parts += [rnd.choice([" ", " ", ">", "+", "~"]), rnd.choice(["a", "b", ".k", "i.m", "#z", "*", "s"])]
        sels.append(selector(*parts))
    sels.append([selector("a", "+", "b"), selector("i", ">", "s"), selector("b", "~", "a", " ", "i")])   # a comma list
    mixed = [s for s in sels[:-1] if any(c in "+~" for c, _ in s[1:-1] if c) and s[-1][0] in (" ", ">")]
    assert len(mixed) > 5
    got = match(n, sels).collect()
    hits = {(r.page_id, r.node_id, i) for r in got for i in range(len(sels)) if r[f"hit_{i}"]}
    want = set()
    for rows in pages.values():
        by_id, kids = {r.node_id: r for r in rows}, {}
        for r in rows:
            kids.setdefault(r.parent_id, []).append(r)
        for r in rows:
            for i, s in enumerate(sels):
                if any(_matches(r, x, by_id, kids) for x in (s if i == len(sels) - 1 else [s])):
                    want.add((r.page_id, r.node_id, i))
    assert hits == want and len(want) > 300
    assert {(r.page_id, r.node_id) for r in got} == {(p, i) for p, i, _ in want}


def test_more_steps_than_one_machine_has_bits(spark):
    from tessera.operators.nodes import match

    n = nodes_of(spark, [(1, "<div>" * 3 + "<p>x</p>" + "</div>" * 3)])
    sels = [selector("div", ">", "div", " ", "p") for _ in range(30)] + [selector("div", ">", "p")]
    got = match(n, sels).collect()
    assert len(got) == 1 and all(got[0][f"hit_{i}"] for i in range(len(sels)))


def test_rules_scan_the_nodes_once_and_share_one_shuffle(spark, tmp_dir):
    from tessera.sources.html_nodes import flat, page_trees

    page_trees(spark.createDataFrame([(1, WIKI)], "page_id long, html string")).write.parquet(f"{tmp_dir}/trees")
    n = flat(spark.read.parquet(f"{tmp_dir}/trees"))
    rules = [Rule("h", tuple(selector("h2")), key="text"), Rule("p", tuple(selector("#content", " ", "p")), get=("h", "<"), val="text"),
             Rule("n", tuple(selector("div", ">", "h3")), get=("h", ">"), val="text"), Rule("c", tuple(selector("tr", " ", "td")), key=constant("cell"), val="text")]
    out = run_rules(n, rules, strict=False)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert sorted((r.key, r.value) for r in out.collect())[:3] == [("Empty", "Names"), ("References", "ref 1"), ("Taxonomy", "Also koala bear.")]
    from tessera.operators.rules import record_long
    plan = record_long(out)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1        # the record needs no shuffle of its own
    scans = spark.read.parquet(f"{tmp_dir}/trees")
    plan = select(flat(scans), selector("#content", ">", "p")).select("page_id")._jdf.queryExecution().executedPlan().toString()
    assert "text:binary" not in plan and "Exchange" not in plan               # neither texts read nor rows moved


def test_page_text_is_stored_once(spark):
    from tessera.sources.html_nodes import page_trees

    deep = "<div>" * 50 + "x" * 1000 + "é</div>" * 50 + "<script>var s = 'no text';</script>"
    t = page_trees(spark.createDataFrame([(1, deep), (2, None), (None, "<p>é</p>y")], "page_id long, html string")).collect()
    by_page = {r.page_id: r for r in t}
    assert len(by_page[1].text) < 1300 and len(by_page[1].nodes) == 51 and by_page[2].nodes == []
    n = node_table(spark.createDataFrame([(1, deep), (None, "<p>é</p>y")], "page_id long, html string")).collect()
    assert {r.text for r in n if r.tag == "div" and r.depth == 49} == {"x" * 1000 + "é"}
    assert [(r.own_text, r.text) for r in n if r.tag == "script"] == [("var s = 'no text';", "")]
    assert sorted((r.tag, r.text) for r in n if r.page_id is None) == [("#page", "éy"), ("p", "é")]


def test_templates_from_a_table_equal_the_literal_list(spark):
    import random

    rnd = random.Random(3)
    attr = lambda: {k: rnd.choice("xy") for k in rnd.sample(["class", "id", "k"], rnd.randrange(4))}
    html = "".join(f"<{t}{''.join(f' {k}={v!r}' for k, v in attr().items())}>z</{t}>" for t in rnd.choices(["div", "b", "i"], k=120))
    n = nodes_of(spark, [(1, html), (2, "<div>only</div>")])
    templates = [(f"t{i}", rnd.choice(["div", "B"]), attr()) for i in range(12)]
    rows = [(name, i, tag, attrs or None if i % 2 else attrs) for i, (name, tag, attrs) in enumerate(templates)]
    table = spark.createDataFrame(rows, "template string, ord int, tag string, attrs map<string,string>")
    want = {(r.page_id, r.node_id): r.template for r in pg.best_template(n, templates).collect()}
    assert {(r.page_id, r.node_id): r.template for r in pg.best_template_table(n, table).collect()} == want and len(want) > 30
    assert pg.best_template_table(n, table.limit(0)).count() == 0


def test_templates_from_a_table_take_tasks_by_nodes_and_match_kinds_once(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(pg, "TASK_NODES", 100, raising=False)
    monkeypatch.setattr(pg, "TASK_BUCKETS", 8, raising=False)
    monkeypatch.setattr(pg, "stage", lambda df, name: stored.append(df) or df, raising=False)
    n = nodes_of(spark, [(i, f"<i>left out</i><div class=a><p k={i % 3}>x</p></div>" * 20) for i in range(20)])
    templates = [("a", "div", {"class": "a"}), ("p", "p", {}), *((f"k{i}", "p", {"k": str(i)}) for i in (2, 0, 7))]
    table = spark.createDataFrame([(name, i, tag, attrs) for i, (name, tag, attrs) in enumerate(templates)],
                                  "template string, ord int, tag string, attrs map<string,string>")
    out = pg.best_template_table(n, table)
    assert out.rdd.getNumPartitions() == 8             # 800 nodes of the templates' tags
    assert {tuple(r) for r in out.collect()} == {tuple(r) for r in pg.best_template(n, templates).collect()}
    asked = stored[0].collect()
    assert len(asked) <= 64 * 4 and len({str(r.kind) for r in asked}) == 4   # kinds by bucket, not nodes
    monkeypatch.setattr(pg, "MOST_TAGS", 1)
    assert out.exceptAll(pg.best_template_table(n, table)).count() == 0


def test_template_nodes_that_come_twice_hold_what_their_rows_hold(spark):
    rows = [(1, 0, "div", {"a": "x", "b": "y"}), (1, 1, "div", {"a": "x"}), (1, 1, "div", {"b": "y"}), (1, 2, "div", {"a": "x"}), (1, 2, "div", {"a": "x"}),
            (None, 3, "p", None), (None, 3, "div", {"a": "x", "b": "y"}), (1, 4, "i", {"a": "x"}), (1, 5, "div", {"a": None})]
    n = spark.createDataFrame(rows, "page_id long, node_id int, tag string, attrs map<string,string>")
    templates = [("both", 1, "div", {"a": "x", "b": "y"}), ("a", 2, "div", {"a": "x"}), ("p", 3, "P", None), ("null", 4, "div", {"a": None}), ("other", 0, "div", {"a": "x", "b": "z"})]
    table = spark.createDataFrame(templates, "template string, ord int, tag string, attrs map<string,string>")
    got = {(r.page_id, r.node_id): r.template for r in pg.best_template_table(n, table).collect()}
    # a template matches where its attributes are held as often as it has some
    assert got == {(1, 0): "both", (1, 1): "both", (1, 2): "other", (None, 3): "both"}


def test_roll_up_is_a_stack_of_any_depth(spark):
    levels = [("h2", ["p"], []), ("h3", ["p"], ["h2"]), ("h4", ["p", "ul"], ["h2", "h3"]), ("h5", ["p"], ["h2", "h3", "h4"])]
    html = ("<p>0</p><h2>A</h2><p>a</p><h5>deep</h5><p>d</p><ul><li>not taken</li></ul><h4>B</h4><ul><li>b</li></ul><p>b2</p><h3>C</h3>"
            "<h4>D</h4><p>x</p><div><h2>inner</h2><p>i</p></div><h2>E</h2><h2>A</h2><p>again</p>")
    n = nodes_of(spark, [(1, html), (2, "<p>no headings</p>")])
    got = {r.page_id: [("/".join(s.path), s.content) for s in r.sections] for r in pg.page_outline(n, levels).collect()}
    assert got == {1: [("A", "a\n"), ("A/deep", "d\n"), ("A/B", "b\nb2\n"), ("A/C/D", "x\n"), ("A", "again\n"), ("inner", "i\n")]}
    two = [("h2", pg.TEXT_BLOCKS, []), ("h3", pg.TEXT_BLOCKS, ["h2"])]
    wiki = nodes_of(spark, [(1, WIKI)])
    rows = {tuple(r.path): r.content for r in pg.roll_up(wiki, two).collect()}
    old = {tuple(x for x in (r.section, r.subsection) if x): r.content for r in pg.page_sections(wiki).collect()}
    assert {k: v for k, v in rows.items() if k[0] != "References"} == old
    with pytest.raises(ValueError):
        pg.roll_up(n, [("h2", ["p"], ["hr"]), ("h3", ["p"], ["h2"])])


def test_vectorised_extractors_and_conditions(spark, monkeypatch):
    from tessera.functions import extract
    from tessera.functions.docpred import where_vector
    from tessera.operators import docs

    monkeypatch.setattr(extract, "VECTOR_ROWS", 3)            # more batches than one
    n = nodes_of(spark, [(i, f"<h1>Été  No. {i}!</h1><p>x</p>") for i in range(20)])
    rules = [Rule("h", tuple(selector("h1")), key="slug"), Rule("p", tuple(selector("p")), get=("h", "<"), val="text")]
    assert {r.key for r in run_rules(n, rules).collect()} == {f"ete-no-{i}" for i in range(20)}

    def longer(a, b):
        import pyarrow.compute as pc
        return pc.greater(pc.utf8_length(a), pc.utf8_length(b))

    d = spark.createDataFrame([(i, "x" * i, None if i == 4 else "yyy") for i in range(10)], "_id long, a string, b string")
    assert sorted(r["_id"] for r in docs.find(d, {"$where": where_vector(longer, "a", "b"), "_id": {"$lt": 9}}).collect()) == [5, 6, 7, 8]


def test_table_functions_emit_nodes_laterally(spark):
    from tessera.sources.html_nodes import register_table_function, register_table_functions

    register_table_functions(spark)
    register_table_function(spark, "letters", lambda html, most: ((i, c) for i, c in enumerate((html or "")[:most])))
    spark.createDataFrame([(1, '<a href="/x">one</a><a>no</a><a href="">two</a>'), (2, None)], "page_id long, html string").createOrReplaceTempView("t_pages")
    rows = lambda call: sorted(tuple(r) for r in spark.sql(f"SELECT p.page_id, f.* FROM t_pages p, LATERAL {call} f").collect())
    assert rows("node_attributes(p.html, 'a', 'href')") == [(1, 0, "/x"), (1, 2, "")]
    assert rows("node_texts(p.html, 'a', 3)") == [(1, 0, "one"), (1, 2, "two")]
    assert rows("letters(p.html, 2)") == [(1, 0, "<"), (1, 1, "a")]


def test_small_pages_get_tasks_by_their_number_and_small_batches(spark, monkeypatch):
    from tessera.sources import html_nodes

    import pyarrow as pa

    monkeypatch.setattr(html_nodes, "TASK_PAGES", 10)
    pages = spark.range(200).selectExpr("id as page_id", "concat('<p>', id, '</p>') as html")
    trees = html_nodes.page_trees(pages, count=200)
    assert trees.rdd.getNumPartitions() == 20 and trees.count() == 200
    wide = pa.RecordBatch.from_arrays([pa.array(range(12), pa.int64()), pa.array(["<b>x</b>" * 1000] * 11 + ["y" * (5 << 20)])], names=["page_id", "html"])
    out = list(html_nodes._parse_batches(iter([wide])))
    assert [b.num_rows for b in out] == [5, 5, 2] and sum(len(t) for b in out for t in b.column(2).to_pylist()) == 11_001
