"""Connected components of a link table: union-find inside partitions, then alternating star rounds."""

from __future__ import annotations

from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import python_ready, written


class UnionFind:
    """Union-find whose roots are the smallest members."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        parent = self.parent
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def union(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one partition as a forest of stars (at most one link for each of its nodes)."""
    sets = UnionFind()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sets.union(a, b)
    found = [(x, r) for x in list(sets.parent) if (r := sets.find(x)) != x]
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()),
                                      pa.array([r for _, r in found], pa.int64())], names=["u", "v"])


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (two bigint columns, no nulls); the component
    is its smallest node.

    Each partition first turns its links into a forest. Then large-star and small-star rounds
    re-hang every node on the smallest node known around it until nothing changes: the number of
    links never grows, no node's neighbours are gathered in one place, and each round is written
    to the shared folder.
    """
    python_ready(links.sparkSession)
    a, b = links.columns
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    edges = written(edges.mapInArrow(_forest, "u bigint, v bigint").distinct(), "links")
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.min("v").alias("m")).where("m < u"), "low")
        large = (both.where("v > u").join(low, "u", "left")
                 .select(F.col("v").alias("u"), F.coalesce("m", "u").alias("v")))
        large = written(large.where("u <> v").unionAll(low.select("u", F.col("m").alias("v"))).distinct(), "large")
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(low.select("u", F.col("m").alias("v"))))
        edges = written(small.where("u <> v").distinct(), "links")
    roots = edges.select(F.col("v").alias("u")).distinct()
    return (edges.groupBy("u").agg(F.min("v").alias("component"))
            .unionAll(roots.select("u", F.col("u").alias("component"))).withColumnRenamed("u", "node"))
