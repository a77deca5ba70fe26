"""Statement objects over the TPC-H-like tables: where-trees, select lists, grouping, FROM lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.predicate import Cond, Field
from tessera.operators.statement import Statement, fld, fn, val
from tessera.plans.common import finalize
from tessera.plans.registry import query, table

CUST_WHERE = [Cond("c_acctbal", ">", 5000.0), "AND", Cond("c_mktsegment", "=", "BUILDING"), "OR",
              [Cond("c_nationkey", "<", 5), "AND", Cond("c_acctbal", "<", 0.0)]]
CUST_WHERE_SQL = "(c_acctbal > 5000 AND c_mktsegment = 'BUILDING') OR (c_nationkey < 5 AND c_acctbal < 0)"


@query("where_tree", f"""
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE {CUST_WHERE_SQL}
""")
def q_where_tree(spark, sf_dir):
    st = (Statement().from_(table(spark, sf_dir, "customer"))
          .select(fld("c_custkey"), fld("c_name"), fld("c_acctbal")).where(CUST_WHERE))
    return finalize(st.to_frame())


@query("filter_field_field", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_tax, l_discount
FROM lineitem WHERE l_tax > l_discount
""")
def q_filter_field_field(spark, sf_dir):
    st = (Statement().from_(table(spark, sf_dir, "lineitem"))
          .select(fld("l_orderkey"), fld("l_linenumber"), fld("l_tax"), fld("l_discount"))
          .where(Cond("l_tax", ">", Field("l_discount"))))
    return finalize(st.to_frame())


@query("select_alias", """
SELECT c.c_custkey AS id, c.c_name AS the_name, c.c_mktsegment AS segment FROM customer c
""")
def q_select_alias(spark, sf_dir):
    st = (Statement().from_(table(spark, sf_dir, "customer"), "c")
          .select(fld("c.c_custkey", "id"), fld("c.c_name", "the_name"), fld("c.c_mktsegment", "segment")))
    return finalize(st.to_frame())


@query("select_const", """
SELECT c_custkey AS id, c_name AS the_value, 'ok' AS const, CAST(1 AS BIGINT) AS one FROM customer
""")
def q_select_const(spark, sf_dir):
    st = (Statement().from_(table(spark, sf_dir, "customer"))
          .select(fld("c_custkey", "id"), fld("c_name", "the_value"), val("ok", "const"), val(1, "one")))
    return finalize(st.to_frame())


@query("select_distinct", """
SELECT DISTINCT c_mktsegment, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer
""")
def q_select_distinct(spark, sf_dir):
    st = (Statement().from_(table(spark, sf_dir, "customer"))
          .select(fld("c_mktsegment", distinct=True), fld("c_nationkey")))
    return finalize(st.to_frame())


@query("count_distinct", """
SELECT o_orderpriority, count(DISTINCT o_custkey) AS n_customers FROM orders GROUP BY o_orderpriority
""")
def q_count_distinct(spark, sf_dir):
    st = (Statement().from_(table(spark, sf_dir, "orders"))
          .select(fld("o_orderpriority"), fn("COUNT", "o_custkey", "n_customers", distinct=True))
          .group_by("o_orderpriority"))
    return finalize(st.to_frame())


@query("sql_count", f"""
SELECT count(c_name) AS count, 'ok' AS const FROM customer WHERE {CUST_WHERE_SQL}
""")
def q_sql_count(spark, sf_dir):
    st = (Statement().from_(table(spark, sf_dir, "customer"))
          .select(fn("COUNT", "c_name", "count"), val("ok", "const")).where(CUST_WHERE))
    return finalize(st.to_frame())


@query("sql_group", """
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
       round(avg(l_extendedprice), 4) AS avg_price, round(min(l_discount), 4) AS min_disc,
       round(max(l_tax), 4) AS max_tax, count(*) AS count_order
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def q_sql_group(spark, sf_dir):
    st = (Statement().from_(table(spark, sf_dir, "lineitem"))
          .select(fld("l_returnflag"), fld("l_linestatus"), fn("SUM", "l_quantity", "sum_qty"),
                  fn("AVG", "l_extendedprice", "avg_price"), fn("MIN", "l_discount", "min_disc"),
                  fn("MAX", "l_tax", "max_tax"), fn("COUNT", "*", "count_order"))
          .group_by("l_returnflag", "l_linestatus"))
    df = st.to_frame()
    return finalize(df.select("l_returnflag", "l_linestatus", F.round("sum_qty", 2).alias("sum_qty"),
                              F.round("avg_price", 4).alias("avg_price"), F.round("min_disc", 4).alias("min_disc"),
                              F.round("max_tax", 4).alias("max_tax"), "count_order"))


@query("sql_having", """
SELECT o_custkey, count(o_orderkey) AS n_orders, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY o_custkey
HAVING (count(o_orderkey) >= 15 AND sum(o_totalprice) > 1500000) OR count(o_orderkey) < 3
""")
def q_sql_having(spark, sf_dir):
    st = (Statement().from_(table(spark, sf_dir, "orders"))
          .select(fld("o_custkey"), fn("COUNT", "o_orderkey", "n_orders"), fn("SUM", "o_totalprice", "total"))
          .group_by("o_custkey")
          .having([Cond("n_orders", ">=", 15), "AND", Cond("total", ">", 1500000.0), "OR",
                   Cond("n_orders", "<", 3)]))
    df = st.to_frame()
    return finalize(df.select("o_custkey", "n_orders", F.round("total", 2).alias("total")))


@query("sql_having_unselected", """
SELECT o_custkey, max(o_totalprice) AS best FROM orders GROUP BY o_custkey
HAVING count(DISTINCT o_orderpriority) >= 4 AND (avg(o_totalprice) > min(o_totalprice) * 3 OR count(*) > 18)
""")
def q_sql_having_unselected(spark, sf_dir):
    # functions that the statement does not select, on both sides of a condition
    least = Statement().from_(table(spark, sf_dir, "orders").withColumn("thrice", F.col("o_totalprice") * 3))
    st = (least.select(fld("o_custkey"), fn("MAX", "o_totalprice", "best")).group_by("o_custkey")
          .having([Cond(fn("COUNT", "o_orderpriority", distinct=True), ">=", 4), "AND",
                   [Cond(fn("AVG", "o_totalprice"), ">", fn("MIN", "thrice")), "OR", Cond(fn("COUNT", "*"), ">", 18)]]))
    return finalize(st.to_frame())


@query("sql_functions", """
SELECT l_returnflag, round(stddev(l_quantity), 6) AS sd, round(var_pop(l_quantity), 6) AS vp, median(l_quantity) AS med,
       bool_and(l_quantity > 0) AS all_in, bool_or(l_quantity >= 50) AS some_big, CAST(count_if(l_tax = 0) AS BIGINT) AS untaxed
FROM (SELECT *, l_quantity >= 50 AS big, l_quantity > 0 AS ok, l_tax = 0 AS free FROM lineitem) GROUP BY l_returnflag
""")
def q_sql_functions(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumns({"big": F.col("l_quantity") >= 50, "ok": F.col("l_quantity") > 0, "free": F.col("l_tax") == 0})
    st = (Statement().from_(li).group_by("l_returnflag").select(
        fld("l_returnflag"), fn("STDDEV", "l_quantity", "sd"), fn("VAR_POP", "l_quantity", "vp"), fn("MEDIAN", "l_quantity", "med"),
        fn("EVERY", "ok", "all_in"), fn("SOME", "big", "some_big"), fn("COUNT_IF", "free", "untaxed")))
    return finalize(st.to_frame().withColumns({"sd": F.round("sd", 6), "vp": F.round("vp", 6)}))


@query("sql_order", """
SELECT c_mktsegment, count(c_name) AS count FROM customer GROUP BY c_mktsegment ORDER BY count DESC
""")
def q_sql_order(spark, sf_dir):
    st = (Statement().from_(table(spark, sf_dir, "customer"))
          .select(fld("c_mktsegment"), fn("COUNT", "c_name", "count"))
          .group_by("c_mktsegment").order_by(("count", "DSC")))
    return finalize(st.to_frame())


@query("from_list_join", """
SELECT o.o_orderkey, c.c_name, n.n_name, o.o_totalprice
FROM customer c, nation n, orders o
WHERE c.c_nationkey = n.n_nationkey AND o.o_custkey = c.c_custkey AND o.o_orderstatus = 'O'
""")
def q_from_list_join(spark, sf_dir):
    st = (Statement()
          .from_(table(spark, sf_dir, "customer"), "c")
          .from_(table(spark, sf_dir, "nation"), "n")
          .from_(table(spark, sf_dir, "orders"), "o")
          .select(fld("o.o_orderkey"), fld("c.c_name"), fld("n.n_name"), fld("o.o_totalprice"))
          .where([Cond("c.c_nationkey", "=", Field("n.n_nationkey")), "AND",
                  Cond("o.o_custkey", "=", Field("c.c_custkey")), "AND",
                  Cond("o.o_orderstatus", "=", "O")]))
    return finalize(st.to_frame())


@query("from_list_any_order", """
SELECT n_name, l_returnflag, o_totalprice FROM nation, lineitem, orders, customer
WHERE l_orderkey = o_orderkey AND c_custkey = o_custkey AND c_nationkey = n_nationkey AND l_quantity > 49
""")
def q_from_list_any_order(spark, sf_dir):
    # the second table is tied to the third only, the first to the last only; names are unqualified
    st = Statement()
    for name in ("nation", "lineitem", "orders", "customer"):
        st = st.from_(table(spark, sf_dir, name), name)
    st = st.select(fld("n_name"), fld("l_returnflag"), fld("o_totalprice")).where(
        [Cond("l_orderkey", "=", Field("o_orderkey")), "AND", Cond("c_custkey", "=", Field("o_custkey")), "AND",
         Cond("c_nationkey", "=", Field("n_nationkey")), "AND", Cond("l_quantity", ">", 49.0)])
    return finalize(st.to_frame())


@query("distinct_functions", """
SELECT c_mktsegment, avg(DISTINCT c_nationkey) AS a, CAST(min(DISTINCT c_nationkey) AS BIGINT) AS lo, CAST(max(DISTINCT c_nationkey) AS BIGINT) AS hi
FROM customer GROUP BY c_mktsegment
""")
def q_distinct_functions(spark, sf_dir):
    st = (Statement().from_(table(spark, sf_dir, "customer")).group_by("c_mktsegment")
          .select(fld("c_mktsegment"), fn("AVG", "c_nationkey", "a", distinct=True), fn("MIN", "c_nationkey", "lo", distinct=True),
                  fn("MAX", "c_nationkey", "hi", distinct=True)))
    return finalize(st.to_frame())
