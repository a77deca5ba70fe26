"""Rule-driven extraction: ordered rules map matched nodes to keys and values per page.

Rule kinds (one :class:`Rule` each, applied in order):

* create: ``key`` and ``val`` extractors -> key and value from the same node;
* key only: ``key`` extractor, no value -> registers keys for later rules;
* get: ``get=(rule_name, direction)`` -> the key of the nearest node registered by an *earlier*
  rule, searched left ``<`` / right ``>`` among siblings or up ``^`` through the ancestors;
  an optional ``val`` adds a value.

The result is long rows ``(page_id, rule_ord, node_id, key, value)``; :func:`record` folds them into
``map<key, array<value>>`` per page, values in rule order then document order.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import extract
from tessera.operators.nodes import KEYS, SEARCHES, match
from tessera.session import stage


@dataclass(frozen=True)
class Rule:
    name: str
    selector: tuple
    key: str | None = None
    get: tuple[str, str] | None = None
    val: str | None = None

    def __post_init__(self):
        if (self.key is None) == (self.get is None):
            raise ValueError(f"rule {self.name!r} needs exactly one of key= or get=")


def run_rules(nodes: DataFrame, rules: Sequence[Rule], strict: bool = True) -> DataFrame:
    """Long (page_id, rule_ord, node_id, key, value) rows for every value-producing rule. A value without
    a key is an error raised in the job; ``strict=False`` leaves such values out.

    One scan of the node table matches all rules' selectors and extracts their keys and values; only matched
    nodes go on. Keys searched to the left or right are windows over the siblings among them, in one
    shuffle by page for all rules, which a record of the values by page needs too. An upward search, and an extractor that looks at other nodes, read the matched nodes
    again, which are stored for that.
    """
    place = {r.name: i for i, r in enumerate(rules)}
    for i, r in enumerate(rules):
        if r.get is not None:
            ref, direction = r.get
            if place.get(ref, i) >= i:
                raise ValueError(f"rule {r.name!r} gets keys from {ref!r}, which is not an earlier rule")
            if direction not in SEARCHES:
                raise ValueError(f"unknown search {direction!r}")
    if not any(r.val is not None for r in rules):
        raise ValueError("no rule produces values")

    hit = lambda i: F.col(f"hit_{i}")
    wanted = [(f"key_{i}", i, r.key) for i, r in enumerate(rules) if r.key is not None]
    wanted += [(f"value_{i}", i, r.val) for i, r in enumerate(rules) if r.val is not None]
    upward = any(r.get is not None and r.get[1] == "^" for r in rules)
    frames = [(c, i, name) for c, i, name in wanted if extract.kind(name) == "frame"]
    found = match(nodes, [r.selector for r in rules])
    found = found.select(*KEYS, *["path"] * upward, *[f"hit_{i}" for i in range(len(rules))],
                         *[F.when(hit(i), extract.column(name).cast("string")).alias(c) for c, i, name in wanted if extract.kind(name) == "col"])
    if frames:
        found = stage(found, "matched")
        for c, i, name in frames:
            found = extract.apply(name, found.where(hit(i)).select("page_id", "node_id"), nodes, c).join(
                found, ["page_id", "node_id"], "right")

    if any(r.get is not None for r in rules):
        # one shuffle by page serves the searches among siblings and what is then grouped by page
        found = found.repartition("page_id")
    siblings = Window.partitionBy("page_id", "parent_id").orderBy("sib_idx")
    for i, r in enumerate(rules):
        if r.get is None:
            continue
        ref, direction = r.get
        held = F.when(hit(place[ref]), F.col(f"key_{place[ref]}"))
        if direction == "<":
            found = found.withColumn("__found", F.last(held, ignorenulls=True).over(siblings.rowsBetween(Window.unboundedPreceding, -1)))
        elif direction == ">":
            found = found.withColumn("__found", F.first(held, ignorenulls=True).over(siblings.rowsBetween(1, Window.unboundedFollowing)))
        else:
            found = stage(found, "matched")
            registered = found.where(held.isNotNull()).select(*KEYS, held.alias("key"))
            up = SEARCHES["^"](registered, found.where(hit(i))).withColumnRenamed("key", "__found")
            found = found.join(up, ["page_id", "node_id"], "left")
        missing = F.raise_error(F.concat(F.lit(f"no key found for rule {r.name} on page "), F.col("page_id").cast("string")))
        key = F.when(F.col("__found").isNull(), missing).otherwise(F.col("__found")) if strict else F.col("__found")
        found = found.withColumn(f"key_{i}", F.when(hit(i), key)).drop("__found")

    values = []
    for i, r in enumerate(rules):
        if r.val is not None:
            there = hit(i) if strict else hit(i) & F.col(f"key_{i}").isNotNull()
            values.append(F.when(there, F.struct(F.lit(i).alias("rule_ord"), F.col(f"key_{i}").alias("key"), F.col(f"value_{i}").alias("value"))))
    rows = found.select("page_id", "node_id", F.explode(F.array_compact(F.array(*values))).alias("v"))
    return rows.select("page_id", "v.rule_ord", "node_id", "v.key", "v.value")


def record_long(values: DataFrame) -> DataFrame:
    """(page_id, key, values array) with values in rule then document order; one row per key."""
    g = values.groupBy("page_id", "key").agg(
        F.array_sort(F.collect_list(F.struct("rule_ord", "node_id", "value"))).alias("__v"))
    return g.select("page_id", "key", F.col("__v.value").alias("values"),
                    F.col("__v")[0]["rule_ord"].alias("__r"), F.col("__v")[0]["node_id"].alias("__n"))


def record(values: DataFrame) -> DataFrame:
    """(page_id, fields map<string, array<string>>) keys in first-value order."""
    g = record_long(values)
    per_page = g.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("__r", "__n", "key", "values")))
                                        .alias("__k"))
    return per_page.select("page_id", F.map_from_arrays(F.col("__k.key"), F.col("__k.values")).alias("fields"))


# Fixed value: the key whose values are joined into one text instead of being post-processed.
CONTENT_KEY = "Content"


def post_process(long: DataFrame) -> DataFrame:
    """Per (page, key) record values -> one post-processed value row.

    ``Content`` values are concatenated in order; otherwise the first value is rated when it holds a
    ``width:Npx;`` bar (1..6 for the grid widths, 7 for other widths), else split on commas and
    trimmed. Output: (page_id, key, rating int, parts array<string>, content string).
    """
    from tessera.functions.text import WIDTH_RE, rating_bucket, split_trim

    first = F.col("values")[0]
    is_content = F.col("key") == CONTENT_KEY
    has_width = F.regexp_extract(first, WIDTH_RE, 1) != ""
    return long.select(
        "page_id", "key",
        F.when(~is_content & has_width, rating_bucket(first)).alias("rating"),
        F.when(~is_content & ~has_width, split_trim(first)).alias("parts"),
        F.when(is_content, F.array_join("values", "")).alias("content"))
