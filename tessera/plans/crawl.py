"""Crawl and de-duplication queries, and the streaming forms of the incremental operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import crawl, side
from tessera.operators import pages as pg
from tessera.plans.common import finalize
from tessera.plans.pages import TITLE_SQL, nodes
from tessera.plans.registry import query, table
from tessera.plans.typed import DOC_SPEC
from tessera.session import materialize, scratch_path
from tessera.sources import markup
from tessera.streaming import streams

WALK_STEPS = 5


def part_edges(spark, sf_dir):
    """The stored link graph (built once per application from lineitem, kept as parquet)."""
    return materialize(lambda: build_part_edges(spark, sf_dir), "edges", key=f"edges:{sf_dir}", spark=spark)


def build_part_edges(spark, sf_dir):
    """Link graph from lineitem: each line links its part to the part of the next line of the same
    order; link order is (order key, line number)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")
    e = li.select(F.col("l_partkey").alias("src"), F.lead("l_partkey").over(w).alias("dst"),
                  (F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("ord"))
    return e.filter(F.col("dst").isNotNull())


EDGES_SQL = """
edges AS (
  SELECT src, dst, ord FROM (
    SELECT l_partkey AS src, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS dst,
           l_orderkey * 1000 + l_linenumber AS ord FROM lineitem)
  WHERE dst IS NOT NULL
)"""


@query("crawl_reach", f"""
WITH RECURSIVE {EDGES_SQL.strip()},
start AS (SELECT arg_min(src, ord) AS node FROM edges),
e AS (SELECT DISTINCT src, dst FROM edges),
r(node, hops) USING KEY (node) AS (
  SELECT node, 0 FROM start
  UNION
  SELECT e.dst, min(r.hops) + 1 FROM r JOIN e ON e.src = r.node
  WHERE e.dst NOT IN (SELECT node FROM recurring.r) GROUP BY e.dst
)
SELECT node, CAST(hops AS BIGINT) AS hops FROM r
""")
def q_crawl_reach(spark, sf_dir):
    e = part_edges(spark, sf_dir)
    start = e.agg(F.min_by("src", "ord").alias("node"))
    return finalize(crawl.reach(e, start))


@query("crawl_walk", f"""
WITH RECURSIVE {EDGES_SQL.strip()},
firsts AS (SELECT src, dst, min(ord) AS ord FROM edges GROUP BY src, dst),
w(walk_id, step, node, seen) AS (
  SELECT DISTINCT src, 0, src, [src] FROM edges
  UNION ALL
  SELECT walk_id, step + 1, nxt, list_append(seen, nxt) FROM (
    SELECT w.walk_id, w.step, w.seen, arg_min(f.dst, (f.ord, f.dst)) AS nxt
    FROM w JOIN firsts f ON f.src = w.node AND NOT list_contains(w.seen, f.dst)
    WHERE w.step < {WALK_STEPS}
    GROUP BY w.walk_id, w.step, w.seen)
)
SELECT walk_id, CAST(step AS BIGINT) AS step, node FROM w
""")
def q_crawl_walk(spark, sf_dir):
    e = part_edges(spark, sf_dir)
    starts = e.select(F.col("src").alias("node")).distinct()
    return finalize(crawl.walk(e, starts, WALK_STEPS))


@query("crawl_walk_visited", f"""
WITH RECURSIVE {EDGES_SQL.strip()},
visited AS (SELECT p_partkey AS node FROM part WHERE p_size > 40),
firsts AS (SELECT src, dst, min(ord) AS ord FROM edges WHERE dst NOT IN (SELECT node FROM visited) GROUP BY src, dst),
w(walk_id, step, node, seen) AS (
  SELECT * FROM (
    SELECT DISTINCT src, 0, src, [src] FROM edges WHERE src NOT IN (SELECT node FROM visited)
    UNION ALL SELECT src, 0, arg_min(dst, (ord, dst)), [arg_min(dst, (ord, dst))] FROM firsts
    WHERE src IN (SELECT node FROM visited) GROUP BY src)
  UNION ALL
  SELECT walk_id, step + 1, nxt, list_append(seen, nxt) FROM (
    SELECT w.walk_id, w.step, w.seen, arg_min(f.dst, (f.ord, f.dst)) AS nxt
    FROM w JOIN firsts f ON f.src = w.node AND NOT list_contains(w.seen, f.dst)
    WHERE w.step < {WALK_STEPS}
    GROUP BY w.walk_id, w.step, w.seen)
)
SELECT walk_id, CAST(step AS BIGINT) AS step, node FROM w
""")
def q_crawl_walk_visited(spark, sf_dir):
    e = part_edges(spark, sf_dir)
    visited = table(spark, sf_dir, "part").filter("p_size > 40").select(F.col("p_partkey").alias("node"))
    starts = e.select(F.col("src").alias("node")).distinct()
    return finalize(crawl.walk(e, starts, WALK_STEPS, visited))


@query("dedup_hash", """
SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents
WHERE text NOT IN (SELECT text FROM benchmark) GROUP BY text
""")
def q_dedup_hash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    seen = crawl.seen_hashes(table(spark, sf_dir, "benchmark"), F.col("text"))
    return finalize(crawl.dedup_by_hash(docs, F.col("text"), "doc_id", seen=seen))


@query("visited_list", f"""
WITH titles AS (
  SELECT '/' || replace(trim({TITLE_SQL}), ' ', '_') AS link
  FROM pages WHERE regexp_matches(html, '<h1>')
)
SELECT link, count(*) AS n FROM (SELECT link FROM titles UNION ALL SELECT link FROM titles WHERE link LIKE '/A%')
GROUP BY link
""")
def q_visited_list(spark, sf_dir):
    # two appends to one line list, read back: names visited twice count twice
    t = pg.page_title(nodes(spark, sf_dir))
    names = t.select(F.concat(F.lit("/"), F.replace(F.trim("title"), F.lit(" "), F.lit("_"))).alias("link"))
    path = scratch_path(spark, "visited")
    markup.write_lines(names, "link", path, mode="append")
    markup.write_lines(names.filter(F.col("link").startswith("/A")), "link", path, mode="append")
    back = markup.read_lines(spark, path)
    return finalize(back.groupBy(F.col("value").alias("link")).agg(F.count(F.lit(1)).alias("n")))


# --- streams -------------------------------------------------------------------------------------

def _arrivals(spark, name, *frames):
    """A source folder and a function that lands the next frame in it as new files."""
    src = scratch_path(spark, name)
    todo = list(frames)
    return src, lambda: todo.pop(0).write.mode("append").parquet(src)


@query("stream_dedup", """
SELECT text FROM documents UNION SELECT text FROM benchmark
""")
def q_stream_dedup(spark, sf_dir):
    # the second arrival repeats texts of the first: the state remembers them across runs
    docs = table(spark, sf_dir, "documents").select("text")
    both = table(spark, sf_dir, "benchmark").select("text").unionByName(docs)
    src, land = _arrivals(spark, "dedup-src", docs, both)
    out, ckpt = scratch_path(spark, "dedup-out"), scratch_path(spark, "dedup-ckpt")
    for _ in range(2):
        land()
        streams.dedup_stream(spark, src, docs.schema, "text", out, ckpt)
    return finalize(spark.read.parquet(out).select("text"))


@query("stream_dedup_within", """
WITH k AS (SELECT user_id || ' ' || event_type AS key, ts, ts < TIMESTAMP '2024-01-16' AS early FROM events),
a AS (SELECT key, early, min(ts) AS ts FROM k GROUP BY key, early),
seen AS (SELECT key, ts FROM a WHERE early),
held AS (SELECT key FROM seen WHERE ts > (SELECT max(ts) FROM seen) - INTERVAL 4 DAY)
SELECT key, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM a WHERE early OR key NOT IN (SELECT key FROM held)
""")
def q_stream_dedup_within(spark, sf_dir):
    # two arrivals; between them the stream's time passes the early values by the horizon, and they count as new again
    ev = table(spark, sf_dir, "events").select(F.concat_ws(" ", F.col("user_id").cast("string"), "event_type").alias("key"), F.col("ts").cast("timestamp").alias("ts"))
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    firsts = lambda df: df.groupBy("key").agg(F.min("ts").alias("ts"))
    src, land = _arrivals(spark, "within-src", firsts(ev.filter(early)), firsts(ev.filter(~early)))
    out, ckpt = scratch_path(spark, "within-out"), scratch_path(spark, "within-ckpt")
    for _ in range(2):
        land()
        streams.dedup_stream_within(spark, src, firsts(ev).schema, "key", "ts", "2 days", out, ckpt)
    return finalize(spark.read.parquet(out).select("key", "ts"))


@query("stream_ingest", """
SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type
""")
def q_stream_ingest(spark, sf_dir):
    # two arrivals and a run without a new one: no file is processed twice
    ev = table(spark, sf_dir, "events")
    late = F.col("event_type").isin("error", "signup")
    src, land = _arrivals(spark, "ingest-src", ev.filter(~late), ev.filter(late))
    out, ckpt = scratch_path(spark, "ingest-out"), scratch_path(spark, "ingest-ckpt")
    for _ in range(2):
        land()
        streams.ingest_new_files(spark, src, ev.schema, out, ckpt)
    streams.ingest_new_files(spark, src, ev.schema, out, ckpt)
    got = spark.read.parquet(out)
    return finalize(got.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"),
                                                  F.round(F.sum("value"), 4).alias("total")))


@query("stream_upsert", """
SELECT doc_id, lang, CASE WHEN lang = 'es' THEN replace(text, ' ', '_') ELSE text END AS text
FROM documents WHERE lang <> 'de'
""")
def q_stream_upsert(spark, sf_dir):
    # the second arrival changes documents of the first
    docs = table(spark, sf_dir, "documents")
    changed = docs.filter(F.col("lang") == "es").withColumn("text", F.replace("text", F.lit(" "), F.lit("_")))
    src, land = _arrivals(spark, "upsert-src", docs, changed)
    root, ckpt = scratch_path(spark, "upsert-table"), scratch_path(spark, "upsert-ckpt")
    for _ in range(2):
        land()
        streams.upsert_stream(spark, src, docs.schema, DOC_SPEC, root, ckpt, keep=lambda b: b["lang"] != "de", buckets=8)
    t = streams.read_table(spark, DOC_SPEC, docs.schema, root)
    return finalize(side.select_recombined(t, ["doc_id", "lang", "text"], order=False))
