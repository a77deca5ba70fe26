"""Merkle dataset manifest: one digest for a whole table, a proof for every row, built level by level.

Rows are the leaves of one tree for each source; the trees' roots (subroots), in order of source, are
the leaves of a tree above them. A tree has ``fanout`` children to a node: at each level every node
is equijoined with its siblings by their computed index (index XOR 1 in a binary tree, otherwise
the run's first index plus the node's slot shifted by 1, 2, ... ``fanout`` - 1, modulo ``fanout``), which
gives every node its proof step, and the nodes of slot zero, which then know the whole run, emit the
parents. A last run may be short, even of one node, which is hashed all the same; a tree of one node is
its own root. Proofs go down again: a node's path is its own step and its parent's path.

H is the lower-case hex SHA-256 of its inputs, digests as hex text; digests are stored as 32 bytes.
Places in a tree are prefix sums over a range sort, and joins are by (tree, index), so a source
with a third of the rows is as many tasks as its rows need. Nothing but the root and the largest
tree's size comes to the driver.

Cases: a null field is ``-`` and so differs from an empty one; null sources are one tree, which comes first;
null ids come first in their tree; rows with one id are ordered by their leaf, equal rows being
leaves each by itself; an empty table has no root and gives no rows; long texts are hashed whole;
other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import query, ranked, read_table, written
from tessera.llm.lines import LOWER, UPPER, ascii_lower

FANOUT = 16
_PATH = "array<struct<before: binary, after: binary>>"


def _hex(c) -> Column:
    return F.lower(F.hex(c))


def leaf_digest(*fields: Column) -> Column:
    """Digest (32 bytes) of a row: each field as UTF-8 byte count, ``:`` and value, ``-`` where null."""
    texts = [f.cast("string") for f in fields]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                                     for t in texts]), 256))


def sibling_step(nodes: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` (tree, idx, of, digest, item) with ``before`` and ``after``: the digests of the siblings to
    the left and right, one after another."""
    slot = F.col("idx") % fanout
    if fanout == 2:
        sibling = F.col("idx").bitwiseXOR(1)
    else:
        shift = F.explode(F.sequence(F.lit(1), F.lit(fanout - 1)))
        sibling = F.col("idx") - slot + (slot + F.col("shift")) % fanout
        shifted = nodes.select("tree", "idx", "digest", shift.alias("shift"))
    given = (nodes if fanout == 2 else shifted).select("tree", sibling.alias("idx"), slot.alias("slot"), F.col("digest").alias("sibling"))
    met = nodes.join(given, ["tree", "idx"], "left").groupBy("tree", "idx").agg(
        *[F.first(c).alias(c) for c in ("of", "digest", "item")],
        F.sort_array(F.collect_list(F.when(F.col("slot").isNotNull(), F.struct("slot", "sibling")))).alias("run"))
    side = "aggregate(filter(run, x -> x.slot {} idx % {}), X'', (a, x) -> concat(a, x.sibling))"
    return met.select("tree", "idx", "of", "digest", "item", F.expr(side.format("<", fanout)).alias("before"),
                      F.expr(side.format(">", fanout)).alias("after"))


@dataclass
class Tree:
    """``levels``: per level the nodes of trees with more than one there, with their siblings;
    ``roots``: (tree, digest, level) of each tree; ``single``: the leaves that are trees of their own."""

    levels: list[DataFrame]
    roots: DataFrame
    single: DataFrame


def build(nodes: DataFrame, fanout: int = FANOUT) -> Tree:
    """Trees over the leaves ``nodes`` (tree, idx from 0, of: leaves in the tree, digest, item)."""
    most = nodes.agg(F.max("of")).first()[0] or 0
    root = lambda df, level: df.where("of = 1").select("tree", "digest", F.lit(level).alias("level"))
    levels, roots, single = [], root(nodes, 0), nodes.where("of = 1")
    while most > 1:
        step = written(sibling_step(nodes.where("of > 1"), fanout), "siblings")
        levels.append(step)
        nodes = step.where(F.col("idx") % fanout == 0).select(
            "tree", (F.col("idx") / fanout).cast("bigint").alias("idx"), F.ceil(F.col("of") / fanout).alias("of"),
            F.unhex(F.sha2(F.concat(_hex("digest"), _hex("after")), 256)).alias("digest"), F.lit(None).cast("int").alias("item"))
        roots = roots.unionByName(root(nodes, len(levels)))
        most = -(-most // fanout)
    return Tree(levels, roots, single)


def paths(tree: Tree, above: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(digest, item, path, subroot) of every leaf. ``above``: (tree, level, path, subroot), one row for each
    tree: its root's level in it and what lies over its root."""
    down = None
    for level in range(len(tree.levels) - 1, -1, -1):
        over = above.where(F.col("level") == level + 1).select("tree", F.lit(0).cast("bigint").alias("up"), F.col("path").alias("rest"), "subroot")
        if down is not None:
            over = over.unionByName(down)
        step = tree.levels[level].withColumn("up", (F.col("idx") / fanout).cast("bigint")).join(over, ["tree", "up"])
        path = F.concat(F.array(F.struct("before", "after")), "rest").alias("path")
        if level:
            down = written(step.select("tree", F.col("idx").alias("up"), path.alias("rest"), "subroot"), "paths")
        else:
            leaves = step.select("digest", "item", path, "subroot")
    lone = tree.single.join(above.where("level = 0"), "tree").select("digest", "item", "path", "subroot")
    return leaves.unionByName(lone) if tree.levels else lone


@dataclass
class Manifest:
    root: str | None                                         # hex; None for an empty table
    proofs: DataFrame                                        # digest, item, path, subroot


def manifest(leaves: DataFrame, tree: str, order: str, *, fanout: int = FANOUT) -> Manifest:
    """The manifest of ``leaves``: rows with a ``digest`` (see ``leaf_digest``) and an ``item`` (any value that
    comes back with the proof), in a tree for each value of the column ``tree``, ascending by ``order``.
    A proof's path has a step (before, after) for each level, subroot's tree first, then the tree above."""
    named = leaves.select(F.coalesce(F.concat(F.lit("s"), F.col(f"`{tree}`").cast("string")), F.lit("")).alias("tree"),
                          F.col(f"`{order}`").alias("by"), "digest", "item")
    places = ranked(written(named, "leaves"), ["tree", "by", "digest"], within="tree", out="idx")
    below = build(written(places.select("tree", "idx", "of", "digest", "item"), "nodes"), fanout)
    subroots = written(below.roots, "subroots")
    tops = ranked(subroots, ["tree"], out="idx").select(
        F.lit("").alias("tree"), "idx", "of", "digest", F.struct("tree", "level").alias("item"))
    top = build(written(tops, "tops"), fanout)
    found = top.roots.first()                                # one row at most
    if found is None:
        return Manifest(None, below.single.select("digest", "item", F.lit(None).cast(_PATH).alias("path"), F.lit(None).cast("binary").alias("subroot")))
    start = subroots.sparkSession.range(1).select(
        F.lit("").alias("tree"), F.lit(int(found["level"])).alias("level"),
        F.array().cast(_PATH).alias("path"), F.lit(None).cast("binary").alias("subroot"))
    over = paths(top, start, fanout).select("item.tree", "item.level", "path", F.col("digest").alias("subroot"))
    return Manifest(found["digest"].hex(), paths(below, written(over, "over"), fanout))


def proof_digest(path: str = "path") -> Column:
    """H of all siblings on the way to the root."""
    return F.sha2(_hex(F.expr(f"aggregate({path}, X'', (a, p) -> concat(a, p.before, p.after))")), 256)


def fold(digest: str, path: str = "path") -> Column:
    """The root (hex) that a leaf's digest and its path give."""
    return F.expr(f"aggregate({path}, lower(hex({digest})), (a, p) -> sha2(concat(lower(hex(p.before)), a, lower(hex(p.after))), 256))")


def _oracle(levels: int = 7, top: int = 4) -> str:
    """Unrolled levels: trees of up to 16^7 rows, 16^4 sources."""
    h = lambda c: f"coalesce(strlen({c}) || ':' || {c}, '-')"
    row = lambda text: "sha256(" + " || ".join(map(h, ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text))) + ")"
    steps = "list_concat([4294967295], flatten(list_transform(range(length(d)), lambda i: [CAST(ascii(d[i + 1]) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])))"
    crc = f"""xor(list_reduce({steps}, lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)"""
    out = [f"""
WITH docs AS (SELECT *, CAST(doc_id AS VARCHAR) d, coalesce('s' || source, '') tree, {row('text')} leaf,
                     {row(f"translate(text, '{UPPER}', '{LOWER}')")} other FROM documents),
l AS (SELECT doc_id, tree, leaf, CASE WHEN {crc} % 5 = 0 THEN other ELSE leaf END given,
             row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 idx, count(*) OVER (PARTITION BY tree) n0 FROM docs),
a0 AS (SELECT tree, idx, n0 n, leaf h FROM l)"""]
    for prefix, count in (("a", levels), ("t", top)):
        for i in range(count):
            out.append(f"r{prefix}{i} AS (SELECT tree, idx // 16 run, n, list(h ORDER BY idx) hs FROM {prefix}{i} WHERE n > 1 GROUP BY tree, idx // 16, n)")
            out.append(f"{prefix}{i + 1} AS (SELECT tree, run idx, (n + 15) // 16 n, sha256(array_to_string(hs, '')) h FROM r{prefix}{i})")
        if prefix == "a":
            union = " UNION ALL ".join(f"SELECT tree, h FROM a{i} WHERE n = 1" for i in range(levels + 1))
            out.append(f"sub AS ({union})")
            out.append("ts AS (SELECT tree sub, h, row_number() OVER (ORDER BY tree) - 1 idx, count(*) OVER () n FROM sub)")
            out.append("t0 AS (SELECT '' tree, idx, n, h FROM ts)")
    root = " UNION ALL ".join(f"SELECT h FROM t{i} WHERE n = 1" for i in range(top + 1))
    out.append(f"root AS ({root})")
    joins, before, after, proof = [], [], [], []
    for prefix, count, idx, tree in (("a", levels, "l.idx", "l.tree"), ("t", top, "ts.idx", "''")):
        for i in range(count):
            r, at = f"r{prefix}{i}", f"({idx} // {16 ** i})"
            joins.append(f"LEFT JOIN {r} ON {r}.tree = {tree} AND {r}.run = {idx} // {16 ** (i + 1)}")
            before.append(f"coalesce(array_to_string({r}.hs[1:{at} % 16], ''), '')")
            after.append(f"coalesce(array_to_string({r}.hs[{at} % 16 + 2:], ''), '')")
            proof.append(f"{before[-1]} || {after[-1]}")
    fold = "given"
    for i, (b, a) in enumerate(zip(before, after)):
        r = f"r{'a' if i < levels else 't'}{i if i < levels else i - levels}"
        fold = f"f{i - 1}" if i else "given"
        out_fold = f"CASE WHEN {r}_hs IS NULL THEN {fold} ELSE sha256(b{i} || {fold} || e{i}) END f{i}"
        before[i], after[i], joins[i] = f"{b} b{i}", f"{a} e{i}", (joins[i], f"{r}.hs {r}_hs", out_fold)
    out.append(f"j AS (SELECT l.doc_id, l.leaf, l.given, ts.h subroot, {', '.join(before)}, {', '.join(after)}, {', '.join(x[1] for x in joins)}, "
               f"sha256({' || '.join(proof)}) proof_sha256 FROM l JOIN ts ON ts.sub = l.tree {' '.join(x[0] for x in joins)})")
    last = "j"
    for i, x in enumerate(joins):
        out.append(f"g{i} AS (SELECT *, {x[2]} FROM {last})")
        last = f"g{i}"
    return ",\n".join(out) + f"""
SELECT doc_id, leaf, subroot, root.h root, proof_sha256, f{len(joins) - 1} folded_root, f{len(joins) - 1} = root.h verified FROM {last}, root"""


@query("op11_merkle_manifest", _oracle())
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents; every proof folded again from rows of which a fifth are tampered with."""
    docs = read_table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    leaf = leaf_digest(*fields)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    given = F.when(tampered, leaf_digest(*fields[:-1], ascii_lower(F.col("text")))).otherwise(leaf)
    made = manifest(docs.select("source", "doc_id", leaf.alias("digest"), F.struct("doc_id", given.alias("given")).alias("item")),
                    "source", "doc_id")
    root = F.lit(made.root).cast("string")
    return made.proofs.select("item.doc_id", "item.given", "digest", "path", "subroot").select(
        "doc_id", _hex("digest").alias("leaf"), _hex("subroot").alias("subroot"), root.alias("root"),
        proof_digest().alias("proof_sha256"), fold("given").alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
