"""Typed tables with side tables: split, recombine, DML and conversions over the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.predicate import Cond
from tessera.functions.types import (TypeSpec, bool_from_storage, bool_to_storage, date_from_storage,
                                     date_to_storage, register_type)
from tessera.functions.text import name_to_file, name_to_url
from tessera.operators import side
from tessera.plans.common import finalize
from tessera.plans.registry import query, table

DOC_SPEC = side.TableSpec(
    "documents",
    (("doc_id", "TrieLong"), ("text", "Text"), ("lang", "Str"), ("source", "Str"), ("n_chars", "TrieLong")),
    "doc_id",
)

# The where-tree of the flagship: lang = 'en' AND n_chars > 2000 OR source = 'src7' AND lang <> 'de'
FLAGSHIP_WHERE = [Cond("lang", "=", "en"), "AND", Cond("n_chars", ">", 2000), "OR",
                  [Cond("source", "=", "src7"), "AND", Cond("lang", "<>", "de")]]
FLAGSHIP_WHERE_SQL = "(lang = 'en' AND n_chars > 2000) OR (source = 'src7' AND lang <> 'de')"

# DuckDB side frame: one row per 255-character piece (at least one piece per text).
SIDE_CTE = """
side AS (
  SELECT doc_id, position, substring(text, position * 255 + 1, 255) AS piece
  FROM (SELECT doc_id, text,
               unnest(range(0, greatest(ceil(length(text) / 255.0), 1)::BIGINT)) AS position
        FROM documents)
)"""


def documents_split(spark, sf_dir):
    return side.split(table(spark, sf_dir, "documents"), DOC_SPEC)


_STORED: dict[tuple[str, str], str] = {}


def stored_split(spark, sf_dir):
    """The split documents as they are stored: catalog tables, main and side bucketed alike by the key, made once per
    application. Queries on them join and recombine bucket by bucket, without a shuffle."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        name = f"tessera_documents_{uuid.uuid4().hex[:12]}"
        side.save_bucketed(documents_split(spark, sf_dir), name, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
        _STORED[key] = name
    return side.load_bucketed(spark, DOC_SPEC, _STORED[key])


@query("select_recombined", f"""
WITH {SIDE_CTE},
keys AS (SELECT doc_id, lang, source, n_chars FROM documents WHERE {FLAGSHIP_WHERE_SQL}),
comb AS (SELECT doc_id, string_agg(piece, '' ORDER BY position) AS text, count(*) AS text_pieces
         FROM side WHERE doc_id IN (SELECT doc_id FROM keys) GROUP BY doc_id)
SELECT k.doc_id, k.lang, k.source, k.n_chars, c.text, c.text_pieces
FROM keys k LEFT JOIN comb c USING (doc_id) ORDER BY k.doc_id
""")
def q_select_recombined(spark, sf_dir):
    t = stored_split(spark, sf_dir)
    return finalize(side.select_recombined(t, ["doc_id", "lang", "source", "n_chars", "text"],
                                           where=FLAGSHIP_WHERE, with_piece_counts=True))


@query("side_select", f"""
WITH {SIDE_CTE}
SELECT doc_id, position, piece FROM side
WHERE doc_id IN (SELECT doc_id FROM documents WHERE lang = 'de' OR n_chars < 500)
""")
def q_side_select(spark, sf_dir):
    t = stored_split(spark, sf_dir)
    w = [Cond("lang", "=", "de"), "OR", Cond("n_chars", "<", 500)]
    return finalize(side.side_select(t, "text", w).orderBy("doc_id", "position"))


@query("text_break", f"""
WITH {SIDE_CTE}
SELECT doc_id, position, length(piece) AS piece_len, piece FROM side
""")
def q_text_break(spark, sf_dir):
    t = documents_split(spark, sf_dir)
    return finalize(t.sides["text"].select("doc_id", "position", F.length("piece").alias("piece_len"), "piece"))


@query("text_combine", f"""
WITH {SIDE_CTE},
comb AS (SELECT doc_id, string_agg(piece, '' ORDER BY position) AS text, count(*) AS n_pieces
         FROM side GROUP BY doc_id)
SELECT c.doc_id, c.n_pieces, length(c.text) AS n_len, (c.text = d.text) AS same_text
FROM comb c JOIN documents d USING (doc_id)
""")
def q_text_combine(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    t = side.split(docs, DOC_SPEC)
    comb = side.combine(t.sides["text"], "doc_id", "text")
    out = comb.join(docs.select("doc_id", F.col("text").alias("orig")), "doc_id")
    return finalize(out.select("doc_id", F.col("text_pieces").alias("n_pieces"),
                               F.length("text").alias("n_len"), (F.col("text") == F.col("orig")).alias("same_text")))


@query("table_split", f"""
WITH {SIDE_CTE}
SELECT 'documents' AS table_name, count(*) AS n_rows, count(DISTINCT doc_id) AS n_keys,
       CAST(sum(n_chars) AS BIGINT) AS n_units FROM documents
UNION ALL
SELECT 'documents__text', count(*), count(DISTINCT doc_id), CAST(sum(length(piece)) AS BIGINT) FROM side
""")
def q_table_split(spark, sf_dir):
    t = documents_split(spark, sf_dir)
    main = t.main.agg(F.lit("documents").alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                      F.count_distinct("doc_id").alias("n_keys"), F.sum("n_chars").cast("bigint").alias("n_units"))
    sd = t.sides["text"].agg(F.lit(DOC_SPEC.side_name("text")).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                             F.count_distinct("doc_id").alias("n_keys"),
                             F.sum(F.length("piece")).cast("bigint").alias("n_units"))
    return finalize(main.unionByName(sd))


@query("child_tables", f"""
WITH {SIDE_CTE},
comb AS (SELECT doc_id, count(*) AS text_pieces FROM side GROUP BY doc_id)
SELECT 'documents__text' AS child, d.doc_id, d.text, c.text_pieces FROM documents d JOIN comb c USING (doc_id)
""")
def q_child_tables(spark, sf_dir):
    # the declared child tables are in the catalog, bucketed by the key like the main table; the text is read
    # back from them
    out = side.select_recombined(stored_split(spark, sf_dir), ["doc_id", "text"], with_piece_counts=True, order=False)
    return finalize(out.withColumn("child", F.lit(DOC_SPEC.side_name("text"))))


@query("select_main", """
SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id
""")
def q_select_main(spark, sf_dir):
    t = stored_split(spark, sf_dir)
    return finalize(side.select_recombined(t, ["doc_id", "lang", "n_chars"]))


# Upsert source derived from the tables: every Spanish document is rewritten (upper-cased text,
# source 'rewrite'), and every benchmark passage becomes a new document with key 10^9 + item_id.
def _upsert_source(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    bench = table(spark, sf_dir, "benchmark")
    changed = docs.filter(F.col("lang") == "es").select(
        "doc_id", F.upper("text").alias("text"), "lang", F.lit("rewrite").alias("source"), "n_chars")
    added = bench.select((F.col("item_id") + F.lit(1_000_000_000)).alias("doc_id"), "text",
                         F.lit("xx").alias("lang"), F.lit("benchmark").alias("source"),
                         F.length("text").cast("bigint").alias("n_chars"))
    return changed.unionByName(added)


UPSERT_SRC_SQL = """
src AS (
  -- Spark's upper() uses full case mapping (sharp s becomes SS); DuckDB maps it to capital sharp s
  SELECT doc_id, replace(upper(text), 'ẞ', 'SS') AS text, lang, 'rewrite' AS source, n_chars FROM documents WHERE lang = 'es'
  UNION ALL
  SELECT item_id + 1000000000, text, 'xx', 'benchmark', CAST(length(text) AS BIGINT) FROM benchmark
),
merged AS (
  SELECT doc_id, text, lang, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM src)
  UNION ALL SELECT * FROM src
)"""


@query("upsert", f"""
WITH {UPSERT_SRC_SQL}
SELECT doc_id, lang, source, n_chars, text FROM merged ORDER BY doc_id
""")
def q_upsert(spark, sf_dir):
    t = side.upsert(stored_split(spark, sf_dir), _upsert_source(spark, sf_dir))
    return finalize(side.select_recombined(t, ["doc_id", "lang", "source", "n_chars", "text"]))


@query("upsert_split", """
WITH src AS (SELECT doc_id, replace(text, ' ', '') AS text FROM documents WHERE lang = 'fr'),
merged AS (
  SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM src)
  UNION ALL SELECT * FROM src
)
SELECT doc_id, CAST(greatest(ceil(length(text) / 255.0), 1) AS BIGINT) AS text_pieces, text FROM merged
""")
def q_upsert_split(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    src = docs.filter(F.col("lang") == "fr").withColumn("text", F.replace("text", F.lit(" "), F.lit("")))
    t = side.upsert(stored_split(spark, sf_dir), src)        # untouched texts stay as they are broken
    out = side.select_recombined(t, ["doc_id", "text"], with_piece_counts=True, order=False)
    return finalize(out)


@query("delete_where", f"""
SELECT doc_id, lang, source, n_chars FROM documents
WHERE NOT coalesce({FLAGSHIP_WHERE_SQL}, false) ORDER BY doc_id
""")
def q_delete_where(spark, sf_dir):
    t = side.delete(stored_split(spark, sf_dir), FLAGSHIP_WHERE)
    return finalize(t.main.orderBy("doc_id"))


@query("delete_cascade", f"""
WITH {SIDE_CTE}
SELECT doc_id, count(*) AS n_pieces, CAST(sum(length(piece)) AS BIGINT) AS n_len FROM side
WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE {FLAGSHIP_WHERE_SQL})
GROUP BY doc_id
""")
def q_delete_cascade(spark, sf_dir):
    t = side.delete(stored_split(spark, sf_dir), FLAGSHIP_WHERE)
    s = t.sides["text"]
    return finalize(s.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pieces"),
                                            F.sum(F.length("piece")).cast("bigint").alias("n_len")))


@query("check_unique", """
SELECT lang, n_chars, count(*) AS n_rows FROM documents GROUP BY lang, n_chars HAVING count(*) > 1
""")
def q_check_unique(spark, sf_dir):
    return finalize(side.check_unique(table(spark, sf_dir, "documents"), ["lang", "n_chars"]))


# --- conversions -------------------------------------------------------------------------------

# Fixed token list used to exercise the Bool conversion (the storage truth set is 1,'1','t','T').
BOOL_TOKENS = ["1", "t", "T", "true", "f", "0"]


@query("bool_convert", """
SELECT doc_id, tok AS token,
       CAST(CASE WHEN tok IN ('1', 't', 'T') THEN 1 ELSE 0 END AS BIGINT) AS stored,
       CAST(CASE WHEN (CASE WHEN tok IN ('1', 't', 'T') THEN 1 ELSE 0 END) = 1 THEN 1 ELSE 0 END AS BIGINT) AS back,
       CAST(CASE WHEN CAST(quality AS VARCHAR) IN ('1', 't', 'T') THEN 1 ELSE 0 END AS BIGINT) AS quality_flag
FROM (SELECT doc_id, quality,
             (['1', 't', 'T', 'true', 'f', '0'])[CAST(doc_id % 6 AS BIGINT) + 1] AS tok FROM labels)
""")
def q_bool_convert(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    tok = F.element_at(F.array(*[F.lit(x) for x in BOOL_TOKENS]), (F.col("doc_id") % 6 + 1).cast("int"))
    out = lab.select("doc_id", "quality", tok.alias("token"))
    out = out.select("doc_id", "token", bool_to_storage(F.col("token")).alias("stored"),
                     bool_from_storage(bool_to_storage(F.col("token"))).alias("back"),
                     bool_to_storage(F.col("quality")).alias("quality_flag"))
    return finalize(out)


@query("date_convert", """
SELECT o_orderkey, search_form, storage_form,
       strftime(strptime(storage_form, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%dT%H:%M:%SZ') AS search_again,
       storage_form AS storage_twice
FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS search_form,
             strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS storage_form FROM orders)
""")
def q_date_convert(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    search = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    out = o.select("o_orderkey", search.alias("search_form"))
    out = out.select("o_orderkey", "search_form", date_to_storage(F.col("search_form")).alias("storage_form"))
    out = out.select("o_orderkey", "search_form", "storage_form",
                     date_from_storage(F.col("storage_form")).alias("search_again"),
                     date_to_storage(F.col("storage_form")).alias("storage_twice"))
    return finalize(out)


PART_SPEC = side.TableSpec(
    "part",
    (("p_partkey", "TrieLong"), ("p_name", "Str"), ("p_brand", "Str"), ("p_size", "TrieInt"),
     ("p_retailprice", "TrieDouble"), ("p_type", "GenericType")),
    "p_partkey",
)


@query("typed_projection", """
SELECT p_partkey, p_name, p_brand, CAST(p_size AS BIGINT) AS p_size, p_retailprice, p_type FROM part
""")
def q_typed_projection(spark, sf_dir):
    return finalize(side.typed_projection(table(spark, sf_dir, "part"), PART_SPEC))


# A search schema as such files have it: type aliases, fields, the key.
SCHEMA_XML = """<schema name="orders" version="1.5">
  <types><fieldType name="id" class="solr.TrieLongField"/><fieldType name="word" class="solr.StrField"/><fieldType name="flag" class="solr.BoolField"/>
    <fieldType name="amount" class="solr.TrieDoubleField"/><fieldType name="day" class="solr.DateRangeField"/></types>
  <fields><field name="o_orderkey" type="id"/><field name="o_orderpriority" type="word"/><field name="open" type="flag"/>
    <field name="o_totalprice" type="amount"/><field name="placed" type="day"/></fields>
  <uniqueKey>o_orderkey</uniqueKey>
</schema>"""


@query("typed_schema", """
SELECT o_orderkey, o_orderpriority, CAST(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS BIGINT) AS open, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS placed FROM orders
""")
def q_typed_schema(spark, sf_dir):
    # the declared schema is read from its file form and applied to the whole table
    spec = side.TableSpec.from_schema_xml(SCHEMA_XML, "orders")
    o = table(spark, sf_dir, "orders").withColumns({"open": F.when(F.col("o_orderstatus") == "O", "t").otherwise("f"),
                                                    "placed": F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")})
    return finalize(side.typed_projection(o, spec))


# A type of this module's own (upper-cased code), beside the built-in ones that need a conversion.
CODE = TypeSpec("Code", "VARCHAR", T.StringType(), lambda c: F.upper(c.cast("string")), lambda c: c)
register_type(CODE)
ORDER_SPEC = side.TableSpec("orders", (("o_orderkey", "TrieLong"), ("open", "Bool"), ("placed", "DateRange"), ("note", "Text"), ("rank", "Code")), "o_orderkey")


@query("typed_conversions", """
SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS BIGINT) AS open, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS placed,
       o_orderpriority || ' / ' || o_custkey AS note, upper('p' || o_orderpriority) AS rank
FROM orders
""")
def q_typed_conversions(spark, sf_dir):
    # Bool from a boolean column, DateRange from its search form, Text through its side table, a registered type
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_orderstatus") == "O").alias("open"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("placed"),
        F.concat("o_orderpriority", F.lit(" / "), F.col("o_custkey").cast("string")).alias("note"),
        F.concat(F.lit("p"), "o_orderpriority").alias("rank"))
    return finalize(side.select_recombined(side.split(o, ORDER_SPEC), order=False))


@query("name_normalise", """
SELECT p_partkey, replace(replace(replace(p_name || ' (' || p_brand || ')', ' ', '%20'), '(', '%28'), ')', '%29') AS file_name,
       replace(p_name || ' (' || p_brand || ')', ' ', '%20') AS url_name
FROM part
""")
def q_name_normalise(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    title = F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")"))
    return finalize(p.select("p_partkey", name_to_file(title).alias("file_name"), name_to_url(title).alias("url_name")))
