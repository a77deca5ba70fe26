"""Field / tag documents (the 21-article corpus), templates and sinks."""

import os

import pytest
from pyspark.sql import functions as F

from tessera.functions.text import name_to_file
from tessera.operators import template as tpl
from tessera.sources import markup
from tests.conftest import DATA


def test_xml_reader_reads_20_of_21(spark):
    docs = markup.read_field_docs(spark, f"{DATA}/field_docs").cache()
    rows = docs.collect()
    assert sum(r._corrupt_record is None for r in rows) == 20
    assert sum(r._corrupt_record is not None for r in rows) == 1
    good = docs.filter(F.col("_corrupt_record").isNull())
    agg = good.select(F.sum(F.length(F.col("fields")["InfoBox"])).alias("ib"),
                      F.sum(F.length(F.col("fields")["Introduction"])).alias("intro"),
                      F.sum((F.col("fields")["InfoBox"] == "").cast("int")).alias("empty")).collect()[0]
    assert (agg.ib, agg.intro, agg.empty) == (4432, 28338, 9)


def test_tolerant_scan_reads_21(spark):
    docs = markup.scan_tolerant(spark, f"{DATA}/field_docs")
    titles = {r.t for r in docs.select(F.col("fields")["title"].alias("t")).collect()}
    assert len(titles) == 21 and "University of California, San Diego" in titles


def test_tag_docs_pair_with_field_docs(spark):
    tags = markup.read_tag_files(spark, f"{DATA}/tag_docs")
    fields = markup.scan_tolerant(spark, f"{DATA}/field_docs")
    t = {r.title: r.intro for r in tags.select(F.col("fields")["title"].alias("title"),
                                                F.col("fields")["Introduction"].alias("intro")).collect()}
    f = {r.title: r.intro for r in fields.select(F.col("fields")["title"].alias("title"),
                                                  F.col("fields")["Introduction"].alias("intro")).collect()}
    assert set(t) == set(f) and len(t) == 21
    assert t["Koala"] == f["Koala"]
    # the stored file names are the titles with space and parentheses escaped
    names = sorted(os.listdir(f"{DATA}/field_docs"))
    got = sorted(r.n for r in tags.select(name_to_file(F.col("fields")["title"]).alias("n")).collect())
    assert got == names


def test_field_doc_write_read_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a < b & c", "x"), (2, "", "y")], "id long, body string, tag string")
    markup.write_field_docs(df, f"{tmp_dir}/out")
    back = markup.read_field_docs(spark, f"{tmp_dir}/out").select(F.col("fields")["id"].alias("id"),
                                                                   F.col("fields")["body"].alias("body"))
    assert sorted((r.id, r.body) for r in back.collect()) == [("1", "a < b & c"), ("2", "")]
    raw = markup.scan_tolerant(spark, f"{tmp_dir}/out").select(F.col("fields")["body"].alias("b")).collect()
    assert "a &lt; b &amp; c" in {r.b for r in raw}


def test_last_duplicate_name_wins(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/d")
    open(f"{tmp_dir}/d/x.xml", "w").write('<add><doc><field name="a">1</field><field name="a">2</field></doc></add>')
    got = markup.read_field_docs(spark, f"{tmp_dir}/d").collect()[0].fields
    assert got == {"a": "2"}


def test_template_fill_from_bear(spark):
    page = open(f"{DATA}/page.html").read() + "<p>\\|{title} stays</p>"
    docs = markup.scan_tolerant(spark, f"{DATA}/field_docs").filter(F.col("fields")["title"] == "Bear")
    out = docs.select(tpl.fill(F.lit(page), F.col("fields")).alias("html"),
                      tpl.markers(F.lit(page)).alias("m")).collect()[0]
    assert out.m == ["title", "InfoBox", "Introduction"]
    assert "<h1>Bear</h1>" in out.html and "|{InfoBox}" not in out.html and "\\|{title} stays" in out.html


def test_template_missing_field_raises(spark):
    df = spark.createDataFrame([("<p>|{nope}</p>",)], "t string")
    with pytest.raises(Exception):
        df.select(tpl.fill(F.col("t"), F.create_map(F.lit("a"), F.lit("b")))).collect()
    soft = df.select(tpl.fill(F.col("t"), F.create_map(F.lit("a"), F.lit("b")), strict=False)).collect()[0][0]
    assert soft == "<p></p>"


def test_unpivot_and_pivot(spark):
    df = spark.createDataFrame([(1, "a", 2)], "id long, s string, n int")
    long = markup.unpivot_fields(df, "id")
    assert sorted((r.name, r.value) for r in long.collect()) == [("n", "2"), ("s", "a")]
    wide = markup.pivot_fields(long, "id", ["s", "n"]).collect()[0]
    assert (wide.s, wide.n) == ("a", "2")


def test_lines_and_csv(spark, tmp_dir):
    found = markup.read_lines(spark, f"{DATA}/found_articles.txt")
    assert found.count() == 22
    markup.write_lines(found, "value", f"{tmp_dir}/v")
    markup.write_lines(found.limit(2), "value", f"{tmp_dir}/v")
    assert markup.read_lines(spark, f"{tmp_dir}/v").count() == 24
    markup.write_csv_rows(found, f"{tmp_dir}/c")
    assert spark.read.csv(f"{tmp_dir}/c").count() == 22


def _field_files(tmp_dir, *records):
    os.makedirs(f"{tmp_dir}/f")
    open(f"{tmp_dir}/f/x.xml", "w").write("<add>" + "".join(f"<doc>{r}</doc>" for r in records) + "</add>")
    return f"{tmp_dir}/f"


def test_fields_at_any_depth_in_both_scans(spark, tmp_dir):
    path = _field_files(tmp_dir, '<field name="a">1</field><sec><field name="b">2 &amp; <i>x</i> y</field><sec><field name="c"/></sec></sec>',
                        '<field  name="d">x</field><field name=\'e\'>y</field><field boost="2" name="f" k="name">z</field>')
    got = [r.fields for r in markup.scan_tolerant(spark, path).collect()]
    assert got == [{"a": "1", "b": "2 &amp; ", "c": ""}, {"d": "x", "e": "y", "f": "z"}]
    got = [(r.fields, r._corrupt_record) for r in markup.read_field_docs(spark, path).collect()]
    assert got == [({"a": "1", "b": "2 & ", "c": ""}, None), ({"d": "x", "e": "y", "f": "z"}, None)]


def test_reading_stops_at_the_first_bad_closing_tag(spark, tmp_dir):
    bad = '<field name="a">1</field><sec><field name="b">2</sec><field name="c">3</field>'
    path = _field_files(tmp_dir, bad, '<field name="a">4</field>', "", 'no < tag & <field name="a">5</field>')
    assert [r.fields for r in markup.scan_tolerant(spark, path).collect()] == [{"a": "1"}, {"a": "4"}, {}, {"a": "5"}]
    strict = markup.read_field_docs(spark, path).collect()
    assert [r.fields for r in strict] == [None, {"a": "4"}, {}, None] and bad in strict[0]._corrupt_record


def test_elements_with_nested_equal_names():
    got = list(markup.elements("<t a='1'>x <t>y</t> z<!-- <!-- --></t><u/><t>w</t></q><t>no</t>"))
    assert [(d, n, c) for d, n, _, c in got] == [(0, "t", "x "), (1, "t", "y"), (0, "u", ""), (0, "t", "w")]
    assert markup.top_fields("<text>x <text>y</text> z</text>") == {"text": "x "}
    assert list(markup.elements("</a><b>x</b>")) == [] and list(markup.elements("<a>open")) == [] and list(markup.elements("")) == []
    assert [x[1] for x in markup.elements("<a><b>1</b><c>")] == ["a", "b"]                # c is neither closed nor a parent


def test_tag_documents_come_back_whatever_they_hold(spark, tmp_dir):
    odd = ["x </text> y", "a\u001eb", "<text>", "&lt; &amp;amp; &#30;", "", None, "line\nbreak \r\n é"]
    df = spark.createDataFrame(list(enumerate(odd)), "id long, text string")
    markup.write_tag_docs(df, f"{tmp_dir}/t")
    back = {r.fields["id"]: r.fields["text"] for r in markup.read_tag_docs(spark, f"{tmp_dir}/t").collect()}
    assert back == {str(i): t or "" for i, t in enumerate(odd)}
    markup.convert_directory(spark, f"{tmp_dir}/t", f"{tmp_dir}/c")
    back = {r.fields["id"]: r.fields["text"] for r in markup.read_field_docs(spark, f"{tmp_dir}/c").where("fields is not null").collect()}
    # XML has no way to write the separator
    assert {k: back[k] for k in "0 1 2 3 4".split()} == {"0": odd[0], "1": "a\ufffdb", "2": odd[2], "3": odd[3], "4": ""}


def test_a_directory_of_files_is_converted(spark, tmp_dir):
    markup.convert_directory(spark, f"{DATA}/tag_docs", f"{tmp_dir}/c")
    want = {r.fields["title"]: r.fields for r in markup.read_tag_files(spark, f"{DATA}/tag_docs").collect()}
    got = {r.fields["title"]: r.fields for r in markup.read_field_docs(spark, f"{tmp_dir}/c").collect()}
    assert len(got) == 21 and got == want
