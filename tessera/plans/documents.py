"""Nested-document find / update / pipeline queries over documents built from ``orders`` and ``lineitem``.

``order_docs`` has one document per order::

    _id    o_orderkey
    ends   {first, last}: codes of the order's first and last line
    n      number of lines (0 for an order without any)      score  o_totalprice
    codes  return flag and status of every line, by line number (duplicates kept)
    marks  distinct codes in first-seen order
    close  code of the last line, missing when o_orderkey % 5 = 0

The arrays hold every line of an order, as many as the data model gives it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import variantdoc
from tessera.functions.docpred import where_vector
from tessera.operators import docs
from tessera.plans.common import finalize
from tessera.plans.registry import query, table
from tessera.session import materialize, scratch_path, ship_package


def order_docs(spark, sf_dir):
    """The stored documents: built from the tables once per application, kept as parquet."""
    return materialize(lambda: build_order_docs(spark, sf_dir), "order_docs", key=f"order_docs:{sf_dir}", spark=spark)


def build_order_docs(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", F.concat("l_returnflag", "l_linestatus").alias("code")).alias("line"))
    lines = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    out = o.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    out = out.withColumn("codes", F.coalesce(F.transform("lines", lambda x: x["code"]), F.array().cast("array<string>")))
    last = F.try_element_at("codes", F.lit(-1))
    return out.select(
        F.col("o_orderkey").alias("_id"),
        F.struct(F.try_element_at("codes", F.lit(1)).alias("first"), last.alias("last")).alias("ends"),
        F.size("codes").cast("bigint").alias("n"), F.col("o_totalprice").alias("score"), "codes",
        F.array_distinct("codes").alias("marks"),
        F.when(F.col("o_orderkey") % 5 != 0, last).alias("close"))


def flat(df):
    """Flatten a order frame for comparison: structs to fields, arrays to strings."""
    cols = []
    names = df.columns
    if "_id" in names:
        cols.append(F.col("_id"))
    if "ends" in names:
        cols += [F.col("ends.first").alias("first"), F.col("ends.last").alias("last")]
    for c in ("n", "score"):
        if c in names:
            cols.append(F.col(c))
    for c in ("codes", "marks"):
        if c in names:
            cols.append(F.array_join(F.col(c), ",").alias(c))
    for c in ("close", "band"):
        if c in names:
            cols.append(F.col(c))
    if "lots" in names:
        cols.append(F.array_join(F.transform("lots", lambda x: F.concat_ws(":", x["size"].cast("string"), x["flag"])), "|").alias("lots"))
    return finalize(df.select(*cols))


DOCS_CTE = """
WITH h AS (
  SELECT l_orderkey, list(l_returnflag || l_linestatus ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag || l_linestatus) AS c
  FROM lineitem GROUP BY l_orderkey
),
od AS (
  SELECT o_orderkey AS _id, c[1] AS first, c[-1] AS last, CAST(coalesce(len(c), 0) AS BIGINT) AS n, o_totalprice AS score,
         coalesce(c, []) AS codes, list_filter(coalesce(c, []), lambda x, i: list_position(c, x) = i) AS marks,
         CASE WHEN o_orderkey % 5 <> 0 THEN c[-1] END AS close
  FROM orders LEFT JOIN h ON l_orderkey = o_orderkey
)"""

FLAT = ("_id, first, last, n, score, array_to_string(codes, ',') AS codes, "
        "array_to_string(marks, ',') AS marks, close")


def _find(name, q, sql_where, **kw):
    @query(name, f"{DOCS_CTE}\nSELECT {FLAT} FROM od WHERE {sql_where}")
    def run(spark, sf_dir):
        return flat(docs.find(order_docs(spark, sf_dir), q, **kw))
    return run


# --- find ------------------------------------------------------------------------------------
_find("doc_eq", {"$or": [{"ends": {"first": "AF", "last": "NO"}},
                         {"ends.last": "RF", "ends.first": "RO"}]},
      "(first = 'AF' AND last = 'NO') OR (last = 'RF' AND first = 'RO')")
_find("doc_range", {"n": {"$gte": 3, "$lt": 5}}, "n >= 3 AND n < 5")
_find("doc_ne", {"close": {"$ne": "AF"}}, "close IS DISTINCT FROM 'AF'")
_find("doc_in", {"ends.first": {"$in": ["NO", "RF"]}}, "first IN ('NO', 'RF')")
_find("doc_nin", {"close": {"$nin": ["NO", "RF"]}}, "close IS NULL OR close NOT IN ('NO', 'RF')")
# true exclusive or: exactly one of (codes contains RO, close is AF)
_find("doc_logic", {"$or": [{"codes": "RO", "close": {"$ne": "AF"}},
                            {"codes": {"$ne": "RO"}, "close": "AF"}],
                    "n": {"$not": {"$lt": 4}}},
      "((list_contains(codes, 'RO') AND close IS DISTINCT FROM 'AF') OR "
      "(NOT list_contains(codes, 'RO') AND close = 'AF')) AND NOT coalesce(n < 4, false)")
_find("doc_contains", {"codes": "AO"}, "list_contains(codes, 'AO')")
_find("doc_all", {"codes": {"$all": ["AF", "NO"]}}, "list_has_all(codes, ['AF', 'NO'])")
_find("doc_elem_match", {"codes": {"$elemMatch": {"$gte": "R", "$lt": "RO"}}},
      "len(list_filter(codes, lambda x: x >= 'R' AND x < 'RO')) > 0")
_find("doc_size", {"marks": {"$size": 3}}, "len(marks) = 3")
_find("doc_exists", {"close": {"$exists": False}}, "close IS NULL")
_find("doc_position", {"codes.0": "AF", "codes.2": {"$ne": "NO"}},
      "codes[1] = 'AF' AND codes[3] IS DISTINCT FROM 'NO'")
_find("doc_where", {"$where": lambda: F.col("ends.first") == F.col("ends.last")}, "first = last")


def _same_start(first, last, n):
    """Do the first and the last code begin alike, in an order of more than two lines?"""
    import pyarrow.compute as pc

    start = lambda x: pc.utf8_slice_codeunits(x, 0, 1)
    return pc.and_(pc.equal(start(first), start(last)), pc.greater(n, 2))


@query("doc_where_vector", f"""{DOCS_CTE}
SELECT {FLAT} FROM od WHERE left(first, 1) = left(last, 1) AND n > 2
""")
def q_doc_where_vector(spark, sf_dir):
    ship_package(spark)
    return flat(docs.find(order_docs(spark, sf_dir), {"$where": where_vector(_same_start, "ends.first", "ends.last", "n")}))


@query("doc_slice", f"""{DOCS_CTE}
SELECT _id, first, last, n, score, array_to_string(codes[greatest(len(codes) - 1, 1):], ',') AS codes,
       array_to_string(marks, ',') AS marks, close FROM od
""")
def q_doc_slice(spark, sf_dir):
    # a projection holding only $slice keeps every other field
    return flat(docs.find(order_docs(spark, sf_dir), None, projection={"codes": {"$slice": -2}}))


@query("doc_project", f"""{DOCS_CTE}
SELECT first, n FROM od
""")
def q_doc_project(spark, sf_dir):
    out = docs.find(order_docs(spark, sf_dir), None, projection={"ends.first": 1, "n": 1, "_id": 0})
    return finalize(out.select(F.col("ends.first").alias("first"), "n"))


@query("doc_sort_skip_limit", f"""{DOCS_CTE}
SELECT {FLAT} FROM od ORDER BY n DESC, _id ASC LIMIT 10 OFFSET 5
""")
def q_doc_sort_skip_limit(spark, sf_dir):
    # call order does not matter: sort -> skip -> limit
    return flat(docs.find(order_docs(spark, sf_dir), {}, limit=10, skip=5, sort={"n": -1, "_id": 1}))


@query("variant_mixed", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       json_extract_string(props, '$.k') AS k_text, json_extract(props, '$.missing') IS NOT NULL AS has_missing
FROM events
""")
def q_variant_mixed(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", F.parse_json("props").alias("v"))
    return finalize(ev.select(
        "event_id",
        F.try_variant_get("v", "$.k", "bigint").alias("k"),
        F.try_variant_get("v", "$.k", "string").alias("k_text"),
        F.try_variant_get("v", "$.missing", "string").isNotNull().alias("has_missing")))


# --- documents of any shape: VARIANT ------------------------------------------------------------
# Lines as JSON whose fields differ from row to row: flag is missing, null, a text, or an array; size.qty a number or a text.
def line_variants(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    shape = F.col("l_partkey") % 4
    flag = (F.when(shape == 0, "").when(shape == 1, ',"flag":null').when(shape == 2, F.concat(F.lit(',"flag":"'), "l_returnflag", F.lit('"')))
            .otherwise(F.concat(F.lit(',"flag":["'), "l_returnflag", F.lit('",'), F.col("l_linenumber").cast("string"), F.lit(",null]"))))
    qty = F.col("l_quantity").cast("bigint").cast("string")
    qty = F.when(F.col("l_suppkey") % 3 == 0, F.concat(F.lit('"'), qty, F.lit('"'))).otherwise(qty)
    text = F.concat(F.lit('{"line":'), F.col("l_linenumber").cast("string"), flag, F.lit(',"size":{"qty":'), qty, F.lit("}}"))
    return li.select("l_orderkey", "l_partkey", "l_suppkey", F.parse_json(text).alias("doc"))


SHAPE_SQL = "SELECT *, l_partkey % 4 AS shape, l_suppkey % 3 = 0 AS is_text, CAST(l_quantity AS BIGINT) AS qty FROM lineitem"


@query("variant_find", f"""
WITH l AS ({SHAPE_SQL})
SELECT 'exists' AS q, l_orderkey, l_partkey FROM l WHERE shape > 0
UNION ALL SELECT 'missing', l_orderkey, l_partkey FROM l WHERE shape = 0
UNION ALL SELECT 'null or missing', l_orderkey, l_partkey FROM l WHERE shape IN (0, 1, 3)
UNION ALL SELECT 'is null', l_orderkey, l_partkey FROM l WHERE shape = 1
UNION ALL SELECT 'not null', l_orderkey, l_partkey FROM l WHERE shape = 2
UNION ALL SELECT 'flag R', l_orderkey, l_partkey FROM l WHERE shape IN (2, 3) AND l_returnflag = 'R'
UNION ALL SELECT 'number', l_orderkey, l_partkey FROM l WHERE NOT is_text AND qty >= 30
UNION ALL SELECT 'text', l_orderkey, l_partkey FROM l WHERE is_text AND CAST(qty AS VARCHAR) >= '30'
UNION ALL SELECT 'element', l_orderkey, l_partkey FROM l WHERE shape = 3 AND l_linenumber > 4
UNION ALL SELECT 'or', l_orderkey, l_partkey FROM l WHERE NOT is_text AND qty < 5 OR shape = 3 AND l_returnflag NOT IN ('A', 'R')
""")
def q_variant_find(spark, sf_dir):
    finds = {"exists": {"flag": {"$exists": True}}, "missing": {"flag": {"$exists": False}}, "null or missing": {"flag": None},
             "is null": {"flag": {"$type": "null"}}, "not null": {"flag": {"$ne": None}}, "flag R": {"flag": "R"},
             "number": {"size.qty": {"$gte": 30}}, "text": {"size.qty": {"$gte": "30"}}, "element": {"flag": {"$gt": 4}},
             "or": {"$or": [{"size.qty": {"$lt": 5}}, {"flag": {"$type": "array", "$nin": ["A", "R"]}}]}}
    lines = line_variants(spark, sf_dir)
    tests = F.array(*[F.when(variantdoc.matches(F.col("doc"), q), F.lit(name)) for name, q in finds.items()])
    return finalize(lines.select(F.explode(F.array_compact(tests)).alias("q"), "l_orderkey", "l_partkey"))


@query("variant_update", f"""
WITH l AS ({SHAPE_SQL})
SELECT l_orderkey, l_partkey, json_object('line', l_linenumber + 10, 'size', json_object('unit', json_object('name', 'box'))) AS doc
FROM l WHERE shape = 0 AND l_linenumber = 3
UNION ALL
SELECT l_orderkey, l_partkey, json_object('flag', json_array(l_returnflag, 'mid', NULL), 'line', l_linenumber + 10, 'size', json_object('unit', json_object('name', 'box')))
FROM l WHERE shape = 3 AND l_linenumber = 3
""")
def q_variant_update(spark, sf_dir):
    lines = line_variants(spark, sf_dir)
    some = variantdoc.matches(F.col("doc"), {"line": 3, "flag": {"$type": "array"}})
    kept = lines.where(variantdoc.matches(F.col("doc"), {"line": 3, "$or": [{"flag": {"$exists": False}}, {"flag": {"$type": "array"}}]}))
    made = variantdoc.update(F.col("doc"), {"$inc": {"line": 10}, "$set": {"size.unit.name": "box"}, "$unset": {"size.qty": ""}})
    made = F.when(some, variantdoc.update(made, {"$set": {"flag.1": "mid"}})).otherwise(made)
    return finalize(kept.select("l_orderkey", "l_partkey", F.to_json(made).alias("doc")))


# --- grouping (G4-G6) --------------------------------------------------------------------------
@query("doc_distinct", f"""{DOCS_CTE}
SELECT DISTINCT close AS _id FROM od
""")
def q_doc_distinct(spark, sf_dir):
    return finalize(docs.pipeline(order_docs(spark, sf_dir), [{"$group": {"_id": "$close"}}]))


@query("doc_group_stats", f"""{DOCS_CTE}
SELECT first AS _id, round(avg(n), 6) AS avg_n, max(score) AS max_score, min(n) AS min_n
FROM od GROUP BY first
""")
def q_doc_group_stats(spark, sf_dir):
    out = docs.pipeline(order_docs(spark, sf_dir), [{"$group": {
        "_id": "$ends.first", "avg_n": {"$avg": "$n"}, "max_score": {"$max": "$score"},
        "min_n": {"$min": "$n"}}}])
    return finalize(out.withColumn("avg_n", F.round("avg_n", 6)))


@query("doc_sum_first_last", f"""{DOCS_CTE}
SELECT close AS _id, CAST(sum(n) AS BIGINT) AS total, arg_min(last, _id) AS first_last,
       arg_max(first, _id) AS last_first
FROM od GROUP BY close
""")
def q_doc_sum_first_last(spark, sf_dir):
    out = docs.pipeline(order_docs(spark, sf_dir), [{"$group": {
        "_id": "$close", "total": {"$sum": "$n"}, "first_last": {"$first": "$ends.last"},
        "last_first": {"$last": "$ends.first"}}}])
    return finalize(out)


# --- update ------------------------------------------------------------------------------------
def _flat_sql(select_list: str) -> str:
    return f"{DOCS_CTE},\nupd AS ({select_list})\nSELECT {FLAT} FROM upd"


DOCS_COLS = "_id, first, last, n, score, codes, marks, close"


@query("upd_inc_one", _flat_sql(f"""
SELECT _id, first, last, CASE WHEN _id = (SELECT min(_id) FROM od WHERE close = 'NO') THEN n + 1 ELSE n END AS n,
       score, codes, marks, close FROM od"""))
def q_upd_inc_one(spark, sf_dir):
    return flat(docs.update(order_docs(spark, sf_dir), {"close": "NO"}, {"$inc": {"n": 1}}))


@query("upd_inc_all", _flat_sql("""
SELECT _id, first, last, CASE WHEN close = 'NO' THEN n + 1 ELSE n END AS n, score, codes, marks, close FROM od"""))
def q_upd_inc_all(spark, sf_dir):
    return flat(docs.update(order_docs(spark, sf_dir), {"close": "NO"}, {"$inc": {"n": 1}}, multi=True))


@query("upd_set", f"""{DOCS_CTE}
SELECT {FLAT}, CASE WHEN n > 5 THEN 'large' END AS band FROM od
""")
def q_upd_set(spark, sf_dir):
    return flat(docs.update(order_docs(spark, sf_dir), {"n": {"$gt": 5}}, {"$set": {"band": "large"}}, multi=True))


@query("upd_unset", _flat_sql("""
SELECT _id, first, last, n, score, codes, marks, CASE WHEN n < 3 THEN NULL ELSE close END AS close FROM od"""))
def q_upd_unset(spark, sf_dir):
    return flat(docs.update(order_docs(spark, sf_dir), {"n": {"$lt": 3}}, {"$unset": {"close": ""}}, multi=True))


@query("upd_push_slice", _flat_sql("""
SELECT _id, first, last, n, score, list_concat(codes, ['XX'])[-4:] AS codes, marks, close FROM od"""))
def q_upd_push_slice(spark, sf_dir):
    return flat(docs.update(order_docs(spark, sf_dir), {}, {"$push": {"codes": {"$each": ["XX"], "$slice": -4}}},
                            multi=True))


@query("upd_add_to_set", _flat_sql("""
SELECT _id, first, last, n, score, codes,
       list_concat(marks, list_filter(['AF', 'ZZ', 'NO'], lambda x: NOT list_contains(marks, x))) AS marks,
       close FROM od"""))
def q_upd_add_to_set(spark, sf_dir):
    return flat(docs.update(order_docs(spark, sf_dir), {}, {"$addToSet": {"marks": {"$each": ["AF", "ZZ", "NO"]}}},
                            multi=True))


@query("upd_set_nested", _flat_sql("""
SELECT _id, first, CASE WHEN first = 'RF' THEN 'changed' ELSE last END AS last, n, score, codes, marks, close
FROM od"""))
def q_upd_set_nested(spark, sf_dir):
    return flat(docs.update(order_docs(spark, sf_dir), {"ends.first": "RF"}, {"$set": {"ends.last": "changed"}},
                            multi=True))


# Lots: the lines of an order as documents {size, flag}; no two different lines of an order have one size.
def lot_docs(spark, sf_dir):
    return materialize(lambda: build_lot_docs(spark, sf_dir), "lot_docs", key=f"lot_docs:{sf_dir}", spark=spark)


def build_lot_docs(spark, sf_dir):
    size = ((F.col("l_quantity").cast("bigint") * 100000 + F.col("l_partkey")) * 10000 + F.col("l_suppkey")) * 10 + F.col("l_linenumber")
    lots = table(spark, sf_dir, "lineitem").select("l_orderkey", F.struct(size.alias("size"), F.col("l_returnflag").alias("flag")).alias("lot"))
    return lots.groupBy(F.col("l_orderkey").alias("_id")).agg(F.sort_array(F.collect_list("lot"), asc=False).alias("lots")).withColumn(
        "n", F.size("lots").cast("bigint"))


LOTS_CTE = """
WITH ld AS (
  SELECT l_orderkey AS _id, count(*) AS n, list({'size': ((CAST(l_quantity AS BIGINT) * 100000 + l_partkey) * 10000 + l_suppkey) * 10 + l_linenumber,
    'flag': l_returnflag} ORDER BY ((CAST(l_quantity AS BIGINT) * 100000 + l_partkey) * 10000 + l_suppkey) * 10 + l_linenumber DESC, l_returnflag DESC) AS lots
  FROM lineitem GROUP BY l_orderkey
)"""


def _lots_sql(lots: str) -> str:
    return f"{LOTS_CTE}\nSELECT _id, n, array_to_string(list_transform({lots}, lambda x: x.size || ':' || x.flag), '|') AS lots FROM ld"


def _split_lots(spark, sf_dir):
    """The largest lot of orders with two or more gets a companion of half its size."""
    half = {"size": F.floor(F.col("lots")[0]["size"] / 2), "flag": F.lit("H")}
    return docs.update(lot_docs(spark, sf_dir), {"n": {"$gte": 2}}, {"$push": {"lots": half}}, multi=True)


@query("upd_push_docs", _lots_sql("CASE WHEN n >= 2 THEN list_append(lots, {'size': lots[1].size // 2, 'flag': 'H'}) ELSE lots END"))
def q_upd_push_docs(spark, sf_dir):
    return flat(_split_lots(spark, sf_dir))


SMALLEST_SQL = """list_sort(list_concat(lots, [{'size': _id, 'flag': 'U'}, {'size': -_id - 1, 'flag': 'V'}]))[:3]"""


def _smallest_lots(spark, sf_dir):
    """The three smallest lots after two small ones have come in."""
    new = [{"size": F.col("_id"), "flag": F.lit("U")}, {"size": -F.col("_id") - 1, "flag": F.lit("V")}]
    return docs.update(lot_docs(spark, sf_dir), {}, {"$push": {"lots": {"$each": new, "$sort": {"size": 1}, "$slice": 3}}}, multi=True)


@query("upd_push_sort", _lots_sql(SMALLEST_SQL))
def q_upd_push_sort(spark, sf_dir):
    return flat(_smallest_lots(spark, sf_dir))


@query("upd_set_position", _lots_sql("list_transform(lots, lambda x, i: CASE WHEN i = 3 AND n % 2 = 0 THEN {'size': x.size, 'flag': 'seen'} ELSE x END)"))
def q_upd_set_position(spark, sf_dir):
    return flat(docs.update(lot_docs(spark, sf_dir), {"$where": "n % 2 = 0"}, {"$set": {"lots.2.flag": "seen"}}, multi=True))


# all array updates inside a sub-document: marks of the order and a list that is made there
@query("upd_nested_arrays", f"""{DOCS_CTE}
SELECT _id, first, array_to_string(CASE WHEN n > 3 THEN list_concat(list_filter(marks, lambda x: x <> 'NO'), CASE WHEN list_contains(marks, 'AF') THEN ['ZZ'] ELSE ['AF', 'ZZ'] END)
         ELSE marks END, ',') AS marks,
       array_to_string(CASE WHEN n > 3 THEN codes[2:] ELSE codes END, ',') AS codes, CASE WHEN n > 3 THEN 'x,y' END AS seen
FROM od
""")
def q_upd_nested_arrays(spark, sf_dir):
    d = order_docs(spark, sf_dir).select("_id", "n", F.struct("ends.first", "marks", F.struct("codes").alias("deep")).alias("sheet"))
    some = {"n": {"$gt": 3}}
    d = docs.update(d, some, {"$pull": {"sheet.marks": "NO"}, "$pop": {"sheet.deep.codes": -1}, "$push": {"sheet.deep.seen": {"$each": ["x", "y"]}}}, multi=True)
    d = docs.update(d, some, {"$addToSet": {"sheet.marks": {"$each": ["AF", "ZZ"]}}, "$pull": {"sheet.none": 1}}, multi=True)
    text = lambda c: F.array_join(c, ",")
    return finalize(d.select("_id", "sheet.first", text("sheet.marks").alias("marks"), text("sheet.deep.codes").alias("codes"), text("sheet.deep.seen").alias("seen")))


@query("upd_pull", _flat_sql("""
SELECT _id, first, last, n, score, list_filter(codes, lambda x: x <> 'NO') AS codes, marks, close FROM od"""))
def q_upd_pull(spark, sf_dir):
    return flat(docs.update(order_docs(spark, sf_dir), {}, {"$pull": {"codes": "NO"}}, multi=True))


@query("upd_pop", _flat_sql("""
SELECT _id, first, last, n, score, CASE WHEN n > 4 THEN codes[2:] ELSE codes END AS codes, marks, close FROM od"""))
def q_upd_pop(spark, sf_dir):
    return flat(docs.update(order_docs(spark, sf_dir), {"n": {"$gt": 4}}, {"$pop": {"codes": -1}}, multi=True))


@query("upd_upsert", f"""{DOCS_CTE}
SELECT {FLAT} FROM od
UNION ALL
SELECT CAST(-1 AS BIGINT), NULL, NULL, CAST(0 AS BIGINT), NULL, NULL, NULL, 'QQ'
WHERE NOT EXISTS (SELECT 1 FROM od WHERE close = 'QQ')
""")
def q_upd_upsert(spark, sf_dir):
    return flat(docs.update(order_docs(spark, sf_dir), {"close": "QQ"}, {"$set": {"n": 0, "_id": -1}}, upsert=True))


# --- literals of other types, null elements, nested and absent paths --------------------------------
_find("doc_fraction", {"n": {"$gte": 4.5}, "_id": {"$ne": 7.5}}, "n >= 4.5")
_find("doc_type_mismatch", {"$or": [{"n": "5"}, {"close": {"$gt": 3}}, {"codes": {"$in": [1, "NF"]}}]}, "list_contains(codes, 'NF')")


@query("upd_pull_null", _flat_sql("""
SELECT _id, first, last, n, score, list_filter(codes, lambda x: x <> 'NO') AS codes,
       ['1'] AS marks, close FROM od"""))
def q_upd_pull_null(spark, sf_dir):
    # a null element is not the pulled value: it stays (marks counts the nulls, which join() leaves out)
    base = docs.update(order_docs(spark, sf_dir), {}, {"$push": {"codes": {"$each": [None, "NO"]}}}, multi=True)
    out = docs.update(base, {}, {"$pull": {"codes": "NO"}}, multi=True)
    return flat(out.withColumn("marks", F.array(F.size(F.filter("codes", lambda x: x.isNull())).cast("string"))))


@query("upd_upsert_inc", f"""{DOCS_CTE}
SELECT {FLAT}, CAST(NULL AS BIGINT) AS hits FROM od
UNION ALL
SELECT CAST(-2 AS BIGINT), NULL, NULL, CAST(5 AS BIGINT), NULL, 'AA', NULL, 'ZZ', CAST(3 AS BIGINT)
""")
def q_upd_upsert_inc(spark, sf_dir):
    # every operator runs on the inserted document, absent fields included
    out = docs.update(order_docs(spark, sf_dir), {"close": "ZZ"}, {"$inc": {"n": 5, "hits": 3}, "$push": {"codes": "AA"}, "$set": {"_id": -2}}, upsert=True)
    return finalize(flat(out).join(out.select("_id", "hits"), "_id"))


@query("upd_nested_paths", f"""{DOCS_CTE}
SELECT _id, CASE WHEN n > 4 THEN NULL ELSE first END AS first, last, CAST(CASE WHEN n > 4 THEN 7 END AS BIGINT) AS tries,
       CAST(CASE WHEN n > 4 THEN 13 END AS BIGINT) AS weight
FROM od
""")
def q_upd_nested_paths(spark, sf_dir):
    boxed = docs.update(order_docs(spark, sf_dir), {"n": {"$gt": 4}}, {"$push": {"boxes": {"weight": 3}}}, multi=True)
    out = docs.update(boxed, {"n": {"$gt": 4}}, {"$unset": {"ends.first": ""}, "$inc": {"ends.tries": 7, "boxes.0.weight": 10}}, multi=True)
    return finalize(out.select("_id", "ends.first", "ends.last", "ends.tries", F.get("boxes", F.lit(0))["weight"].alias("weight")))


@query("doc_skip_all", f"""{DOCS_CTE}
SELECT {FLAT} FROM od ORDER BY n DESC, _id ASC OFFSET 25
""")
def q_doc_skip_all(spark, sf_dir):
    return flat(docs.find(order_docs(spark, sf_dir), {}, skip=25, sort={"n": -1, "_id": 1}))


@query("doc_project_elements", f"""{LOTS_CTE}
SELECT _id, array_to_string(list_transform(lots, lambda x: x.size), ',') AS sizes FROM ld
""")
def q_doc_project_elements(spark, sf_dir):
    out = docs.find(lot_docs(spark, sf_dir), None, projection={"lots.size": 1})
    return finalize(out.select("_id", F.array_join(F.transform("lots", lambda x: F.to_json(x)), ",").alias("sizes"))
                    .withColumn("sizes", F.regexp_replace("sizes", '[^0-9,]', "")))


@query("doc_exclude_elements", f"""{LOTS_CTE}
SELECT _id, n, array_to_string(list_transform(lots, lambda x: '{{"flag":"' || x.flag || '"}}'), ',') AS lots FROM ld
""")
def q_doc_exclude_elements(spark, sf_dir):
    # a field of every element is left out, all others stay
    out = docs.find(lot_docs(spark, sf_dir), None, projection={"lots.size": 0})
    return finalize(out.select("_id", "n", F.array_join(F.transform("lots", lambda x: F.to_json(x)), ",").alias("lots")))


@query("doc_logic_as_written", f"""{DOCS_CTE}
SELECT {FLAT} FROM od WHERE (list_contains(codes, 'RO') AND close IS DISTINCT FROM 'AF')
   OR (NOT list_contains(codes, 'RO') AND close = 'AF' AND close IS DISTINCT FROM 'AF')
""")
def q_doc_logic_as_written(spark, sf_dir):
    # the exclusive or with a second branch that asks for a value and against it: that branch never holds
    return flat(docs.find(order_docs(spark, sf_dir), {"$or": [
        {"codes": "RO", "close": {"$ne": "AF"}}, {"codes": {"$ne": "RO"}, "$and": [{"close": "AF"}, {"close": {"$ne": "AF"}}]}]}))


@query("doc_remove", f"""{DOCS_CTE}
SELECT {FLAT} FROM od WHERE NOT (n < 2 OR close IS NULL)
""")
def q_doc_remove(spark, sf_dir):
    return flat(docs.remove(order_docs(spark, sf_dir), {"$or": [{"n": {"$lt": 2}}, {"close": {"$exists": False}}]}))


@query("doc_drop", f"""{DOCS_CTE}
SELECT {FLAT} FROM od WHERE n >= 6
""")
def q_doc_drop(spark, sf_dir):
    # a stored collection is dropped, then documents are inserted one batch after another
    d = order_docs(spark, sf_dir)
    path = scratch_path(spark, "dropped")
    docs.save(docs.find(d, {"n": {"$lt": 6}}), path)
    docs.drop(spark, path, d.schema)
    for codes in ({"$gte": 7}, {"$gte": 6, "$lt": 7}):
        docs.save(docs.find(d, {"n": codes}), path)
    return flat(spark.read.schema(d.schema).parquet(path))


@query("doc_insert", f"""{DOCS_CTE}
SELECT {FLAT} FROM od
UNION ALL
SELECT c_custkey + 10000000000, c_mktsegment, c_name, CAST(c_nationkey AS BIGINT), c_acctbal, NULL, NULL, NULL FROM customer
""")
def q_doc_insert(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    new = c.select((F.col("c_custkey") + 10_000_000_000).alias("_id"),
                   F.struct(F.col("c_mktsegment").alias("first"), F.col("c_name").alias("last")).alias("ends"),
                   F.col("c_nationkey").cast("bigint").alias("n"), F.col("c_acctbal").alias("score"))
    return flat(docs.insert(order_docs(spark, sf_dir), new))


# --- aggregation pipeline ----------------------------------------------------------------------
def events_coll(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumnRenamed("event_id", "_id")


@query("pipe_match", f"""{DOCS_CTE}
SELECT {FLAT} FROM od WHERE n > 4 AND close IS NOT NULL
""")
def q_pipe_match(spark, sf_dir):
    return flat(docs.pipeline(order_docs(spark, sf_dir), [{"$match": {"n": {"$gt": 4}, "close": {"$exists": True}}}]))


@query("pipe_project", f"""{DOCS_CTE}
SELECT first AS who, n FROM od
""")
def q_pipe_project(spark, sf_dir):
    return finalize(docs.pipeline(order_docs(spark, sf_dir), [{"$project": {"_id": 0, "who": "$ends.first", "n": 1}}]))


@query("pipe_upper", f"""{DOCS_CTE}
SELECT _id, coalesce(upper(first), '') AS up, coalesce(lower(close), '') AS low FROM od
""")
def q_pipe_upper(spark, sf_dir):
    return finalize(docs.pipeline(order_docs(spark, sf_dir), [{"$project": {
        "up": {"$toUpper": "$ends.first"}, "low": {"$toLower": "$close"}}}]))


@query("pipe_initials", f"""{DOCS_CTE}
SELECT _id, upper(substring(first, 1, 1)) || substring(last, 1, 2) AS initials FROM od
""")
def q_pipe_initials(spark, sf_dir):
    return finalize(docs.pipeline(order_docs(spark, sf_dir), [{"$project": {"initials": {"$concat": [
        {"$toUpper": {"$substr": ["$ends.first", 0, 1]}}, {"$substr": ["$ends.last", 0, 2]}]}}}]))


@query("pipe_math", """
SELECT event_id AS _id, round(value * 2, 6) AS v2, round(value + user_id, 6) AS vplus,
       round(value / 4, 6) AS vdiv, user_id % 7 AS umod, round(value - 1.5, 6) AS vsub FROM events
""")
def q_pipe_math(spark, sf_dir):
    out = docs.pipeline(events_coll(spark, sf_dir), [{"$project": {
        "v2": {"$multiply": ["$value", 2]}, "vplus": {"$add": ["$value", "$user_id"]},
        "vdiv": {"$divide": ["$value", 4]}, "umod": {"$mod": ["$user_id", 7]},
        "vsub": {"$subtract": ["$value", 1.5]}}}])
    return finalize(out.select("_id", *[F.round(c, 6).alias(c) for c in ("v2", "vplus", "vdiv")], "umod",
                               F.round("vsub", 6).alias("vsub")))


@query("pipe_date", """
SELECT event_id AS _id, CAST(year(ts) AS BIGINT) AS y, CAST(month(ts) AS BIGINT) AS m,
       CAST(day(ts) AS BIGINT) AS d, CAST(hour(ts) AS BIGINT) AS h FROM events
""")
def q_pipe_date(spark, sf_dir):
    return finalize(docs.pipeline(events_coll(spark, sf_dir), [{"$project": {
        "y": {"$year": "$ts"}, "m": {"$month": "$ts"}, "d": {"$dayOfMonth": "$ts"}, "h": {"$hour": "$ts"}}}]))


@query("pipe_logic", """
SELECT event_id AS _id, (value > 50 AND event_type = 'purchase') AS big_buy,
       (event_type = 'error' OR value < 1) AS odd, NOT (user_id > 100) AS low_user,
       CASE WHEN value >= 25 THEN 'high' ELSE 'low' END AS band FROM events
""")
def q_pipe_logic(spark, sf_dir):
    return finalize(docs.pipeline(events_coll(spark, sf_dir), [{"$project": {
        "big_buy": {"$and": [{"$gt": ["$value", 50]}, {"$eq": ["$event_type", "purchase"]}]},
        "odd": {"$or": [{"$eq": ["$event_type", "error"]}, {"$lt": ["$value", 1]}]},
        "low_user": {"$not": [{"$gt": ["$user_id", 100]}]},
        "band": {"$cond": [{"$gte": ["$value", 25]}, "high", "low"]}}}]))


@query("pipe_unwind", f"""{DOCS_CTE}
SELECT _id, unnest(codes) AS codes FROM od
""")
def q_pipe_unwind(spark, sf_dir):
    return finalize(docs.pipeline(order_docs(spark, sf_dir), [{"$project": {"codes": 1}}, {"$unwind": "$codes"}]))


@query("pipe_group", f"""{DOCS_CTE}
SELECT close AS _id, CAST(sum(n) AS BIGINT) AS total, round(avg(score), 6) AS avg_score, count(*) AS docs
FROM od GROUP BY close
""")
def q_pipe_group(spark, sf_dir):
    out = docs.pipeline(order_docs(spark, sf_dir), [{"$group": {
        "_id": "$close", "total": {"$sum": "$n"}, "avg_score": {"$avg": "$score"}, "docs": {"$sum": 1}}}])
    return finalize(out.withColumn("avg_score", F.round("avg_score", 6)))


@query("pipe_sort", f"""{DOCS_CTE}
SELECT * FROM (SELECT {FLAT} FROM od ORDER BY n DESC, _id ASC LIMIT 8) ORDER BY n DESC, _id ASC OFFSET 3
""")
def q_pipe_sort(spark, sf_dir):
    # order is significant in a pipeline: limit 8 first, then skip 3 of those
    return flat(docs.pipeline(order_docs(spark, sf_dir), [{"$sort": {"n": -1, "_id": 1}}, {"$limit": 8},
                                                      {"$skip": 3}]))


@query("pipe_chain", f"""{DOCS_CTE}
SELECT DISTINCT unnest(codes) AS _id FROM od ORDER BY 1
""")
def q_pipe_chain(spark, sf_dir):
    return finalize(docs.pipeline(order_docs(spark, sf_dir), [{"$unwind": "$codes"}, {"$group": {"_id": "$codes"}},
                                                          {"$sort": {"_id": 1}}]))
