"""Crawling over a stored edge table ``(src, ord, dst)``: reach, walks and de-duplication.

Iterations are bounded driver loops that only build plans and test one step for emptiness. Each
step's state is cached (its lineage is one join on top of the previous step) and every few steps it is
written as parquet under the shared checkpoint folder (``stage``) and read back, so lineage stays short
and a lost executor recomputes at most a few steps.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import stage


def reach(edges: DataFrame, starts: DataFrame, max_hops: int | None = None, cut_every: int = 4) -> DataFrame:
    """(node, hops): every node reachable from ``starts`` (column ``node``) (within ``max_hops``
    where given), with its least hop count (breadth-first, semi-naive: only the new frontier is expanded).

    The distinct edge set is cached; each new level is cached (its lineage is one join on the
    previous level) and an empty level ends the search. Every ``cut_every`` levels the whole visited
    set is staged to the shared folder, so plans and lineage stay a few levels deep.
    """
    # the edges keep one partitioning by source, so no level moves them again
    e = edges.select("src", "dst").distinct().repartition("src").persist()
    visited = starts.select("node").distinct().withColumn("hops", F.lit(0)).persist()
    frontier, kept = visited, [e, visited]
    for h in itertools.count(1):
        if max_hops is not None and h > max_hops:
            break
        nxt = (frontier.join(e, frontier["node"] == e["src"]).select(F.col("dst").alias("node")).distinct()
               .join(visited.select("node"), "node", "left_anti").withColumn("hops", F.lit(h))).persist()
        kept.append(nxt)
        if nxt.isEmpty():
            break
        visited = visited.unionByName(nxt)
        if h % cut_every == 0:
            visited = stage(visited, f"reach-{h}")
            nxt = visited.filter(F.col("hops") == h)
        frontier = nxt
    found = stage(visited, "reach")
    for df in kept:
        df.unpersist()
    return found


def first_links(edges: DataFrame, k: int) -> DataFrame:
    """(src, dst, ord): the first ``k`` distinct targets of every source in link order.

    ``row_number() <= k`` is limited map-side before the shuffle, so a source holding a third of
    all edges still ships only k rows per map task.
    """
    d = edges.groupBy("src", "dst").agg(F.min("ord").alias("ord"))
    w = Window.partitionBy("src").orderBy("ord", "dst")
    return d.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= k).drop("__r")


def walk(edges: DataFrame, starts: DataFrame, steps: int, visited: DataFrame | None = None) -> DataFrame:
    """(walk_id, step, node): from each start, ``steps`` moves to the first not-yet-visited link.

    A walk that has visited v nodes needs at most v + 1 distinct candidates, so only the first
    ``steps + 1`` distinct links of each source are ever joined (exact, bounded per walk). A walk
    with no unvisited link stops. Nodes of the ``visited`` list (column ``node``) are not moved to; a walk from
    one of them begins at its first unvisited link instead, and there is none without such a link.
    """
    if visited is not None:
        seen = visited.select("node").distinct()
        edges = edges.join(seen.withColumnRenamed("node", "dst"), "dst", "left_anti")
    cand = stage(first_links(edges, steps + 1), "walk-links")
    begin = starts.select(F.col("node").alias("walk_id"), F.col("node").alias("cur"))
    if visited is not None:
        known = begin.join(seen.withColumnRenamed("node", "cur"), "cur", "left_semi")
        moved = known.join(cand, known["cur"] == cand["src"]).groupBy("walk_id").agg(F.min_by("dst", F.struct("ord", "dst")).alias("cur"))
        begin = begin.join(seen.withColumnRenamed("node", "cur"), "cur", "left_anti").select("walk_id", "cur").unionByName(moved)
    state = begin.withColumn("seen", F.array("cur"))
    out = state.select("walk_id", F.lit(0).alias("step"), F.col("cur").alias("node"))
    for s in range(1, steps + 1):
        moves = (state.join(cand, state["cur"] == cand["src"])
                 .filter(~F.array_contains("seen", F.col("dst")))
                 .groupBy("walk_id").agg(F.min_by("dst", F.struct("ord", "dst")).alias("nxt"),
                                         F.first("seen").alias("seen")))
        state = moves.select("walk_id", F.col("nxt").alias("cur"), F.concat("seen", F.array(F.col("nxt"))).alias("seen"))
        state = stage(state, f"walk-{s}")
        out = out.unionByName(state.select("walk_id", F.lit(s).alias("step"), F.col("cur").alias("node")))
    return out


SALT = "tessera"


def seen_hashes(df: DataFrame, value: Column, hash_fn=F.xxhash64) -> DataFrame:
    """(h, h2): the 128-bit key of every value, to be kept as a seen-list."""
    return df.select(hash_fn(value).alias("h"), hash_fn(F.lit(SALT), value).alias("h2"))


def dedup_by_hash(df: DataFrame, value: Column, order: str, seen: DataFrame | None = None,
                  hash_fn=F.xxhash64) -> DataFrame:
    """Keep one row per distinct value (the least ``order``) with its number of copies, skipping
    values whose two hashes are in ``seen`` (columns ``h`` and ``h2``, see :func:`seen_hashes`).

    Rows are grouped on a 128-bit key (two chained 64-bit hashes of the value), so the shuffle
    carries hashes and ids, never the values themselves, and a group of copies holding a third of
    all rows collapses map-side (partial aggregation). Two values share a 128-bit key with
    probability about n^2 / 2^129 (~1e-15 for 10^12 values).
    """
    h = df.withColumns({"__h": hash_fn(value), "__h2": hash_fn(F.lit(SALT), value)})
    if seen is not None:
        h = h.join(seen.select(F.col("h").alias("__h"), F.col("h2").alias("__h2")).distinct(), ["__h", "__h2"], "left_anti")
    keep = h.groupBy("__h", "__h2").agg(F.min(order).alias(order), F.count(F.lit(1)).alias("copies"))
    return keep.drop("__h", "__h2")
