"""Selectors and nearest-key lookups over the node table.

Selectors are structured: a list of steps ``(combinator, Simple)`` where the first combinator is
``None`` and later ones are ``' '`` (descendant), ``'>'`` (child), ``'+'`` (adjacent sibling) or
``'~'`` (general sibling).

Any number of selectors are matched in one pass (:func:`match`). Their descendant and child steps are
the bits of one state machine, which is folded along each node's ancestor path (a node's row knows its
ancestors' tags, classes and ids), so these steps need no join and no shuffle. Sibling steps at the end of
a selector are one window over the siblings, for all selectors together. Only a sibling step that
other steps follow is an equi-join on page and position.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Sequence, Union

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.html_nodes import PAGE

KEYS = ["page_id", "node_id", "parent_id", "sib_idx"]


@dataclass(frozen=True)
class Simple:
    tag: str | None = None
    classes: tuple[str, ...] = ()
    id: str | None = None

    def predicate(self, of: Column | None = None) -> Column:
        """Does the node (or the path entry ``of``) match? Never null."""
        field = (lambda c: F.col(c)) if of is None else (lambda c: of[c])
        p = F.lit(True)
        if self.tag and self.tag != "*":
            p = p & (field("tag") == self.tag.lower())
        elif not self.classes and not self.id:
            p = p & (field("tag") != PAGE)               # the page's own row is no element
        for c in self.classes:
            p = p & F.coalesce(F.contains(field("cls"), F.lit(f" {c} ")), F.lit(False))
        if self.id:
            p = p & F.coalesce(field("id") == self.id, F.lit(False))
        return p


_SIMPLE = re.compile(r"^(?P<tag>[A-Za-z0-9*]+)?(?P<rest>(?:[.#][A-Za-z0-9_-]+)*)$")


def simple(token: str) -> Simple:
    """``tag``, ``.class``, ``#id`` and their compounds (``p.intro#x``)."""
    m = _SIMPLE.match(token)
    if not m:
        raise ValueError(f"not a simple selector: {token!r}")
    parts = re.findall(r"([.#])([A-Za-z0-9_-]+)", m.group("rest") or "")
    return Simple(m.group("tag"), tuple(v for k, v in parts if k == "."),
                  next((v for k, v in parts if k == "#"), None))


Step = tuple[Union[str, None], Simple]


def selector(*parts: Union[str, Simple]) -> list[Step]:
    """``selector("nav", " ", "li", " ", "a")`` / ``selector("h1", "+", "p")``."""
    if len(parts) % 2 == 0:
        raise ValueError("a selector alternates simple selectors and combinators")
    first = parts[0] if isinstance(parts[0], Simple) else simple(parts[0])
    steps: list[Step] = [(None, first)]
    for comb, s in zip(parts[1::2], parts[2::2]):
        if comb not in (" ", ">", "+", "~"):
            raise ValueError(f"unknown combinator {comb!r}")
        steps.append((comb, s if isinstance(s, Simple) else simple(s)))
    return steps


def _select_one(nodes: DataFrame, steps: Sequence[Step]) -> DataFrame:
    # page roots are siblings of each other: they share the parent -1
    nodes = nodes.withColumn("__p", F.coalesce("parent_id", F.lit(-1)))
    cur = nodes.filter(steps[0][1].predicate())
    for comb, s in steps[1:]:
        cand = nodes.filter(s.predicate())
        prev = cur.select(*KEYS, "__p")
        if comb == ">":
            cur = cand.join(prev.select("page_id", F.col("node_id").alias("parent_id")),
                            ["page_id", "parent_id"], "left_semi")
        elif comb == " ":
            anc = cand.select("page_id", "node_id", F.explode("path.node_id").alias("anc"))
            hit = anc.join(prev.select("page_id", F.col("node_id").alias("anc")), ["page_id", "anc"], "left_semi")
            cur = cand.join(hit.select("page_id", "node_id"), ["page_id", "node_id"], "left_semi")
        elif comb == "+":
            cur = cand.join(prev.select("page_id", "__p", (F.col("sib_idx") + 1).alias("sib_idx")),
                            ["page_id", "__p", "sib_idx"], "left_semi")
        else:  # '~'
            first = prev.groupBy("page_id", "__p").agg(F.min("sib_idx").alias("__m"))
            cur = cand.join(first, ["page_id", "__p"]).filter(F.col("sib_idx") > F.col("__m")).drop("__m")
    return cur.select(*[c for c in nodes.columns if c != "__p"])


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), use)[0]


class _Machine:
    """Child and descendant steps of many selectors as bits: step i is matched where its simple selector
    matches and step i - 1 is matched at the parent (child) or at some ancestor (descendant)."""

    BITS = 62

    def __init__(self):
        self.simples: list[Simple] = []
        self.first = self.child = self.inside = 0

    def add(self, steps: Sequence[Step]) -> int:
        """Bit of the last step."""
        for comb, s in steps:
            bit = 1 << len(self.simples)
            self.simples.append(s)
            if comb is None:
                self.first |= bit
            elif comb == ">":
                self.child |= bit
            else:
                self.inside |= bit
        return bit

    def _mask(self, of: Column | None = None) -> Column:
        out = F.lit(0).cast("bigint")
        for i, s in enumerate(self.simples):
            out = out.bitwiseOR(F.when(s.predicate(of), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
        return out

    def _open(self, state: Column) -> Column:
        """Steps that may match below ``state``."""
        big = lambda x: F.lit(x).cast("bigint")
        return (big(self.first).bitwiseOR(F.shiftleft(state["last"], 1).bitwiseAND(big(self.child)))
                .bitwiseOR(F.shiftleft(state["ever"], 1).bitwiseAND(big(self.inside))))

    def hits(self, ends: int) -> Column:
        """Bits of the steps that a node matches, folded along its path; 0 where none of ``ends`` can match."""
        start = F.struct(F.lit(0).cast("bigint").alias("last"), F.lit(0).cast("bigint").alias("ever"))

        def step(state, entry):
            return _bind(self._mask(entry).bitwiseAND(self._open(state)),
                         lambda now: F.struct(now.alias("last"), state["ever"].bitwiseOR(now).alias("ever")))

        possible = F.lit(False)
        for i, s in enumerate(self.simples):
            if ends >> i & 1:
                possible = possible | s.predicate()
        own = _bind(F.aggregate("path", start, step), lambda state: self._mask().bitwiseAND(self._open(state)))
        return F.when(possible, own).otherwise(F.lit(0).cast("bigint"))


def _split(steps: Sequence[Step]) -> tuple[list[Step], list[Step]] | None:
    """(child and descendant steps, sibling steps behind them), or None where the two are mixed."""
    n = next((i for i, (comb, _) in enumerate(steps) if comb in ("+", "~")), len(steps))
    return (list(steps[:n]), list(steps[n:])) if all(comb in ("+", "~") for comb, _ in steps[n:]) else None


def alternatives(sel) -> list[Sequence[Step]]:
    """A selector, or a comma list of selectors, as a list of selectors."""
    return [sel] if sel and isinstance(sel[0], tuple) and sel[0][0] is None else list(sel)


def match(nodes: DataFrame, selectors: Sequence, prefix: str = "hit_") -> DataFrame:
    """Nodes that some of ``selectors`` (each a selector or a comma list) match, with a boolean column
    ``hit_<i>`` for each; one scan of the nodes."""
    machines, plans, joined = [_Machine()], [], []
    for i, sel in enumerate(selectors):
        for steps in alternatives(sel):
            parts = _split(steps)
            if parts is None:
                joined.append((i, steps))
                continue
            if len(machines[-1].simples) + len(parts[0]) > _Machine.BITS:
                machines.append(_Machine())
            plans.append((i, len(machines) - 1, machines[-1].add(parts[0]), parts[1]))
    ends = [0] * len(machines)
    for _, m, bit, _ in plans:
        ends[m] |= bit
    out = nodes
    for m, machine in enumerate(machines):
        if machine.simples:
            out = out.withColumn(f"__m{m}", machine.hits(ends[m]))
    found: dict[int, Column] = {}
    fetch = lambda m, bit: F.col(f"__m{m}").bitwiseAND(F.lit(bit).cast("bigint")) != 0
    for i, m, bit, rest in plans:
        if not rest:
            found[i] = found.get(i, F.lit(False)) | fetch(m, bit)
    for k, (i, steps) in enumerate(joined):
        keys = _select_one(nodes, steps).select("page_id", "node_id", F.lit(True).alias(f"__j{k}"))
        out = out.join(keys, ["page_id", "node_id"], "left")
        found[i] = found.get(i, F.lit(False)) | F.coalesce(f"__j{k}", F.lit(False))
    behind = [(i, m, bit, rest) for i, m, bit, rest in plans if rest]
    candidate = F.lit(False)
    for c in found.values():
        candidate = candidate | c
    for i, m, bit, rest in behind:
        candidate = candidate | fetch(m, bit)
        for _, s in rest:
            candidate = candidate | s.predicate()
    out = out.where(candidate)
    w = Window.partitionBy("page_id", "parent_id").orderBy("sib_idx").rowsBetween(Window.unboundedPreceding, -1)
    for k, (i, m, bit, rest) in enumerate(behind):
        flag = fetch(m, bit)
        for n, (comb, s) in enumerate(rest):
            before = F.max(F.when(flag, F.col("sib_idx"))).over(w)
            near = before == F.col("sib_idx") - 1 if comb == "+" else before.isNotNull()
            out = out.withColumn(f"__s{k}_{n}", s.predicate() & F.coalesce(near, F.lit(False)))
            flag = F.col(f"__s{k}_{n}")
        found[i] = found.get(i, F.lit(False)) | flag
    out = out.select(*nodes.columns, *[found.get(i, F.lit(False)).alias(f"{prefix}{i}") for i in range(len(selectors))])
    if behind:
        some = F.lit(False)
        for i in range(len(selectors)):
            some = some | F.col(f"{prefix}{i}")
        out = out.where(some)
    return out


def select(nodes: DataFrame, sel: Sequence[Step] | Sequence[Sequence[Step]]) -> DataFrame:
    """Rows of the node table matched by a selector or a comma list of selectors."""
    return match(nodes, [sel]).where("hit_0").drop("hit_0")


# --- nearest-key lookups (as-of joins over sibling order) ---------------------------------------

def _asof(registered: DataFrame, targets: DataFrame, direction: str) -> DataFrame:
    """Key of the nearest registered sibling to the left ('<') or right ('>') of every target."""
    cand = registered.select("page_id", "parent_id", "sib_idx", F.col("key").alias("__k"),
                             F.lit(None).cast("int").alias("__t"),
                             F.lit(1 if direction == "<" else 0).alias("__role"))
    tgt = targets.select("page_id", "parent_id", "sib_idx", F.lit(None).cast("string").alias("__k"),
                         F.col("node_id").alias("__t"), F.lit(0 if direction == "<" else 1).alias("__role"))
    u = cand.unionByName(tgt)
    w = Window.partitionBy("page_id", "parent_id").orderBy("sib_idx", "__role")
    if direction == "<":
        found = F.last("__k", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    else:
        found = F.first("__k", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    hits = u.withColumn("key", found).filter(F.col("__t").isNotNull())
    return hits.select("page_id", F.col("__t").alias("node_id"), "key")


def key_left(registered: DataFrame, targets: DataFrame) -> DataFrame:
    """(page_id, node_id, key) for every target: key of the closest preceding registered sibling."""
    return _asof(registered, targets, "<")


def key_right(registered: DataFrame, targets: DataFrame) -> DataFrame:
    """(page_id, node_id, key): key of the closest following registered sibling."""
    return _asof(registered, targets, ">")


def key_up(registered: DataFrame, targets: DataFrame) -> DataFrame:
    """(page_id, node_id, key): walk parent, grandparent, ...; at each ancestor take the ancestor
    itself if registered, else its closest preceding registered sibling; the nearest ancestor with a
    hit wins. One window over sibling order answers every ancestor of every target at once."""
    anc = targets.select("page_id", F.col("node_id").alias("__t"),
                         F.posexplode("path").alias("__pos", "a"), F.size("path").alias("__n"))
    anc = anc.select("page_id", "__t", (F.col("__n") - F.col("__pos")).alias("__dist"),
                     F.col("a.parent_id").alias("parent_id"), F.col("a.sib_idx").alias("sib_idx"))
    cand = registered.select("page_id", "parent_id", "sib_idx", F.col("key").alias("__k"),
                             F.lit(None).cast("int").alias("__t"), F.lit(None).cast("int").alias("__dist"),
                             F.lit(0).alias("__role"))
    u = cand.unionByName(anc.select("page_id", "parent_id", "sib_idx", F.lit(None).cast("string").alias("__k"),
                                    "__t", "__dist", F.lit(1).alias("__role")))
    w = (Window.partitionBy("page_id", "parent_id").orderBy("sib_idx", "__role")
         .rowsBetween(Window.unboundedPreceding, 0))
    found = u.withColumn("__f", F.last("__k", ignorenulls=True).over(w))
    found = found.filter(F.col("__t").isNotNull() & F.col("__f").isNotNull())
    return found.groupBy("page_id", F.col("__t").alias("node_id")).agg(F.min_by("__f", "__dist").alias("key"))


SEARCHES = {"<": key_left, ">": key_right, "^": key_up}
