"""Templates, markup-document scans and sinks, and value post-processing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import rating_bucket, split_trim
from tessera.operators import template as tpl
from tessera.plans.common import finalize
from tessera.plans.registry import query, table
from tessera.session import scratch_path
from tessera.sources import markup

# Per-customer template: the balance line carries an escaped marker for customers in debt.
def customer_templates(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    t = F.concat(
        F.lit('<tableName value="customer"/><h1>|{c_name}</h1><p>Segment: |{c_mktsegment}</p>'),
        F.when(F.col("c_acctbal") < 0, F.lit("<p>owes \\|{c_acctbal}</p>"))
         .otherwise(F.lit("<p>balance |{c_acctbal} in |{c_nationkey}</p>")),
        F.lit("<footer>#|{c_custkey}</footer>"))
    fields = F.create_map(F.lit("c_name"), F.col("c_name"), F.lit("c_mktsegment"), F.col("c_mktsegment"),
                          F.lit("c_acctbal"), F.col("c_acctbal").cast("string"),
                          F.lit("c_nationkey"), F.col("c_nationkey").cast("string"),
                          F.lit("c_custkey"), F.col("c_custkey").cast("string"))
    return c.select("c_custkey", t.alias("template"), fields.alias("fields"))


TEMPLATE_SQL = """
tpl AS (
  SELECT c_custkey, c_name, c_mktsegment, c_acctbal, c_nationkey,
         '<tableName value="customer"/><h1>|{c_name}</h1><p>Segment: |{c_mktsegment}</p>'
         || CASE WHEN c_acctbal < 0 THEN '<p>owes \\|{c_acctbal}</p>' ELSE '<p>balance |{c_acctbal} in |{c_nationkey}</p>' END
         || '<footer>#|{c_custkey}</footer>' AS template
  FROM customer
)"""


@query("template_markers", f"""
WITH {TEMPLATE_SQL.strip()}
SELECT c_custkey, regexp_extract(template, '<tableName\\s+value="([^"]*)"', 1) AS table_name,
       CAST(len(regexp_extract_all(template, '(^|[^\\\\])\\|\\{{([^{{}} ]*)\\}}', 2)) AS BIGINT) AS n_markers,
       array_to_string(regexp_extract_all(template, '(^|[^\\\\])\\|\\{{([^{{}} ]*)\\}}', 2), ',') AS markers
FROM tpl
""")
def q_template_markers(spark, sf_dir):
    t = customer_templates(spark, sf_dir)
    m = tpl.markers(F.col("template"))
    return finalize(t.select("c_custkey", tpl.table_name(F.col("template")).alias("table_name"),
                             F.size(m).alias("n_markers"), F.array_join(m, ",").alias("markers")))


@query("template_fill", f"""
WITH {TEMPLATE_SQL.strip()}
SELECT c_custkey,
  replace(replace(replace(replace(replace(replace(replace(template, '\\|{{', chr(1)),
    '|{{c_name}}', c_name), '|{{c_mktsegment}}', c_mktsegment), '|{{c_acctbal}}', CAST(c_acctbal AS VARCHAR)),
    '|{{c_nationkey}}', CAST(c_nationkey AS VARCHAR)), '|{{c_custkey}}', CAST(c_custkey AS VARCHAR)), chr(1), '\\|{{') AS page
FROM tpl
""")
def q_template_fill(spark, sf_dir):
    t = customer_templates(spark, sf_dir)
    return finalize(t.select("c_custkey", tpl.fill(F.col("template"), F.col("fields")).alias("page")))


DOC_COLS = ["doc_id", "lang", "source", "n_chars", "text"]


_STORED: dict[tuple[str, str], str] = {}


def _stored(spark, kind, sf_dir, write):
    """Stored document files derived from ``documents`` (written once per application)."""
    key = (spark.sparkContext.applicationId, f"{kind}:{sf_dir}")
    if key not in _STORED:
        path = scratch_path(spark, kind)
        write(table(spark, sf_dir, "documents"), path)
        _STORED[key] = path
    return _STORED[key]


def _field_docs(spark, sf_dir):
    return _stored(spark, "field-docs", sf_dir,
                   lambda d, p: markup.write_field_docs(d, p, DOC_COLS, mode="overwrite"))


def _wide(fields_df):
    f = F.col("fields")
    return fields_df.select(f["doc_id"].cast("bigint").alias("doc_id"), f["lang"].alias("lang"),
                            f["source"].alias("source"), f["n_chars"].cast("bigint").alias("n_chars"),
                            f["text"].alias("text"))


@query("scan_field_docs", """
SELECT doc_id, lang, source, n_chars, text FROM documents
""")
def q_scan_field_docs(spark, sf_dir):
    # malformed documents stay, as rows without fields
    return finalize(_wide(markup.read_field_docs(spark, _field_docs(spark, sf_dir))))


@query("field_doc_roundtrip", """
SELECT lang, count(*) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM documents GROUP BY lang
""")
def q_field_doc_roundtrip(spark, sf_dir):
    w = _wide(markup.read_field_docs(spark, _field_docs(spark, sf_dir)))
    return finalize(w.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"),
                                          F.sum(F.length("text")).cast("bigint").alias("n_chars")))


@query("scan_tolerant", """
SELECT doc_id, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS raw_text FROM documents
""")
def q_scan_tolerant(spark, sf_dir):
    docs = markup.scan_tolerant(spark, _field_docs(spark, sf_dir))
    f = F.col("fields")
    return finalize(docs.select(f["doc_id"].cast("bigint").alias("doc_id"), f["text"].alias("raw_text")))


@query("scan_tag_docs", """
SELECT doc_id, lang, source, n_chars, text FROM documents
""")
def q_scan_tag_docs(spark, sf_dir):
    path = _stored(spark, "tag-docs", sf_dir, lambda d, p: markup.write_tag_docs(d, p, DOC_COLS, mode="overwrite"))
    return finalize(_wide(markup.read_tag_docs(spark, path)))


@query("convert_directory", """
SELECT doc_id, lang, source, n_chars, text FROM documents
""")
def q_convert_directory(spark, sf_dir):
    # a stored directory of tag documents becomes one of field documents, which is read back
    source = _stored(spark, "tag-docs", sf_dir, lambda d, p: markup.write_tag_docs(d, p, DOC_COLS, mode="overwrite"))
    target = scratch_path(spark, "converted")
    markup.convert_to_fields(markup.read_tag_docs(spark, source), target)
    return finalize(_wide(markup.read_field_docs(spark, target)))


# Field documents with a field at each of three depths, odd spelling of its tag, and a part that breaks off.
def _nested_docs(spark, sf_dir):
    def write(_, path):
        o = table(spark, sf_dir, "orders")
        body = F.concat(
            F.lit("<doc><field  name='key'>"), "o_orderkey", F.lit('</field><part n="1"><field name="status" boost="2">'), "o_orderstatus",
            F.lit("</field><part><!-- deep --><field boost='1' name=total>"), F.col("o_totalprice").cast("string"), F.lit("<b>!</b></field></part></part>"),
            F.when(F.col("o_orderkey") % 3 == 0, F.lit('<part><field name="late">x</field></field><field name="status">lost</field>')).otherwise(F.lit('<field name="late"/>')))
        o.select(body.alias("value")).write.mode("overwrite").option("lineSep", "</doc>").text(path)
    return _stored(spark, "nested-docs", sf_dir, write)


@query("scan_nested", """
SELECT o_orderkey AS key, o_orderstatus AS status, CAST(o_totalprice AS DOUBLE) AS total, CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE '' END AS late FROM orders
""")
def q_scan_nested(spark, sf_dir):
    # fields at any depth; a field's content ends at its first child; reading ends at the first bad closing tag
    f = F.col("fields")
    docs = markup.scan_tolerant(spark, _nested_docs(spark, sf_dir))
    return finalize(docs.select(f["key"].cast("bigint").alias("key"), f["status"].alias("status"), f["total"].cast("double").alias("total"), f["late"].alias("late")))


@query("unpivot_fields", """
SELECT doc_id, name, value FROM (
  SELECT doc_id, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents
) UNPIVOT (value FOR name IN (lang, source, n_chars))
""")
def q_unpivot_fields(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return finalize(markup.unpivot_fields(d, "doc_id"))


@query("bulk_load", """
SELECT lang, count(*) AS n_docs FROM documents GROUP BY lang
""")
def q_bulk_load(spark, sf_dir):
    # all languages go into one directory in one job over one scan; the job commit is the single commit
    path = scratch_path(spark, "bulk")
    markup.write_field_docs(table(spark, sf_dir, "documents"), path, DOC_COLS, mode="overwrite")
    w = _wide(markup.read_field_docs(spark, path))
    return finalize(w.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs")))


@query("rating_bucket", """
SELECT p_partkey, 'width:' || CAST(p_size * 21 AS VARCHAR) || 'px;' AS style,
       CAST(CASE p_size * 21 WHEN 21 THEN 1 WHEN 42 THEN 2 WHEN 63 THEN 3 WHEN 84 THEN 4 WHEN 105 THEN 5
                             WHEN 126 THEN 6 ELSE 7 END AS BIGINT) AS rating
FROM part
""")
def q_rating_bucket(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    style = F.concat(F.lit("width:"), (F.col("p_size") * 21).cast("string"), F.lit("px;"))
    return finalize(p.select("p_partkey", style.alias("style"), rating_bucket(style).alias("rating")))


@query("split_trim", """
SELECT p_partkey, array_to_string(list_transform(string_split(p_name || ' , ' || p_brand || ',  ' || p_type, ','),
                                                 lambda x: trim(x)), '|') AS parts
FROM part
""")
def q_split_trim(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    v = F.concat("p_name", F.lit(" , "), "p_brand", F.lit(",  "), "p_type")
    return finalize(p.select("p_partkey", F.array_join(split_trim(v), "|").alias("parts")))


@query("csv_sink", """
SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer
""")
def q_csv_sink(spark, sf_dir):
    # CSV sink without a header line, read back with the declared schema
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    path = scratch_path(spark, "csv")
    markup.write_csv_rows(c, path, mode="overwrite")
    return finalize(spark.read.schema(c.schema).option("header", "false").csv(path))
