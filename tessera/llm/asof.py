"""As-of joins that stay even under hot keys: a key's rows are split by order buckets.

Inside a bucket the last fact is found by a window over (keys, bucket); what reaches a bucket from
the buckets before it is a table of one row for each (keys, bucket), so no window ever holds more
than one key's rows of one bucket, or one key's buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import written


def last_fact(probes: DataFrame, facts: DataFrame, keys: list[str], order: str, width, *, strict: bool = False) -> DataFrame:
    """``probes`` with ``fact``: the columns of the last of ``facts`` at or before (``strict``: before)
    their place in ``order`` with equal ``keys``, as a struct; null without one.

    ``order`` is a bigint column of both frames, ``width`` the size of an order bucket. Null keys or
    orders match nothing. Of facts with equal keys and order, the largest by its other columns counts.
    """
    rest = [c for c in facts.columns if c not in keys]
    own = [c for c in probes.columns if c not in keys and c != order]
    bucket: Column = F.floor(F.col(order) / F.lit(width))
    f = facts.dropna(subset=[*keys, order]).groupBy(*keys, order).agg(F.max(F.struct(*rest)).alias("fact"))
    f = f.select(*keys, order, bucket.alias("__bucket"), F.lit(1 if strict else 0).alias("__probe"), "fact")
    p = probes.select(*keys, order, bucket.alias("__bucket"), F.lit(0 if strict else 1).alias("__probe"),
                      F.struct(*own).alias("__own"), F.lit(True).alias("__is_probe"))
    both = f.unionByName(p, allowMissingColumns=True)
    here = Window.partitionBy(*keys, "__bucket").orderBy(order, "__probe").rowsBetween(Window.unboundedPreceding, 0)
    ends = both.groupBy(*keys, "__bucket").agg(F.max(F.when(F.col("fact").isNotNull(), F.struct(order, "fact"))).alias("end"))
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = written(ends.withColumn("__carry", F.last("end.fact", ignorenulls=True).over(before)).where("__carry is not null").drop("end"), "carry")
    local = both.withColumn("__local", F.last("fact", ignorenulls=True).over(here)).where("__is_probe")
    out = local.join(carry, [*keys, "__bucket"], "left")
    return out.select(*keys, order, *[F.col(f"__own.`{c}`").alias(c) for c in own], F.coalesce("__local", "__carry").alias("fact"))


def with_next(facts: DataFrame, keys: list[str], order: str, width, name: str = "next") -> DataFrame:
    """``facts`` with the next larger ``order`` of their keys as ``name`` (null for the last).
    Facts of one key must differ in ``order``."""
    f = facts.withColumn("__bucket", F.floor(F.col(order) / F.lit(width)))
    inside = Window.partitionBy(*keys, "__bucket").orderBy(order)
    firsts = f.groupBy(*keys, "__bucket").agg(F.min(order).alias("first"))
    later = written(firsts.withColumn("__later", F.lead("first").over(Window.partitionBy(*keys).orderBy("__bucket"))).drop("first"), "later")
    f = f.withColumn("__next", F.lead(order).over(inside)).join(later, [*keys, "__bucket"], "left")
    return f.withColumn(name, F.coalesce("__next", "__later")).drop("__bucket", "__next", "__later")
