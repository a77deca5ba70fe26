"""Single-block statements built as objects: select list, FROM list, where/having trees, GROUP BY,
ORDER BY. The statement compiles straight to a DataFrame plan (there is no SQL text in between).

A FROM list with several tables is joined on the equalities between their fields found at the top
AND level of the where-tree (``c.c_custkey = o.o_custkey``); a FROM list without such an equality is
rejected rather than planned as a cross product.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.predicate import Cond, Field, where as where_tree

# Aggregate function names accepted in a select list, and the descending keywords
# (the statement objects spell descending 'DSC').
AGGREGATES = {
    "COUNT": F.count, "SUM": F.sum, "AVG": F.avg, "MIN": F.min, "MAX": F.max, "STDDEV": F.stddev, "STDDEV_POP": F.stddev_pop,
    "VARIANCE": F.variance, "VAR_POP": F.var_pop, "MEDIAN": F.median, "EVERY": F.every, "SOME": F.some,
    "PRODUCT": F.product, "COUNT_IF": F.count_if, "SKEWNESS": F.skewness,
}
DISTINCT_AGGREGATES = {
    "COUNT": F.count_distinct, "SUM": F.sum_distinct, "MIN": F.min, "MAX": F.max,
    "AVG": lambda c: F.sum_distinct(c) / F.count_distinct(c),
}
DESCENDING = {"DESC", "DSC"}


def register_aggregate(name: str, fn, distinct=None) -> None:
    """Make an aggregate (Column -> Column) usable in statements under ``name``; ``distinct`` is its form over
    distinct values."""
    AGGREGATES[name.upper()] = fn
    if distinct is not None:
        DISTINCT_AGGREGATES[name.upper()] = distinct


@dataclass(frozen=True)
class Item:
    """One select-list entry: a field, a constant value or a function over a field."""

    kind: str
    name: str | None = None
    value: Any = None
    func: str | None = None
    alias: str | None = None
    keywords: tuple[str, ...] = ()

    def output_name(self) -> str:
        if self.alias:
            return self.alias
        if self.kind == "field":
            return self.name.split(".")[-1]
        if self.kind == "function":
            return f"{self.func.lower()}_{self.name.split('.')[-1]}"
        return str(self.value)


def fld(name: str, alias: str | None = None, distinct: bool = False) -> Item:
    return Item("field", name=name, alias=alias, keywords=("DISTINCT",) if distinct else ())


def val(value: Any, alias: str | None = None) -> Item:
    return Item("value", value=value, alias=alias)


def fn(func: str, name: str, alias: str | None = None, distinct: bool = False) -> Item:
    f = func.upper()
    if f not in (DISTINCT_AGGREGATES if distinct else AGGREGATES):
        raise ValueError(f"unknown function {func!r}" + " of distinct values" * distinct)
    return Item("function", name=name, func=f, alias=alias, keywords=("DISTINCT",) if distinct else ())


def _col(name: str) -> Column:
    return F.lit(1) if name == "*" else F.col(name)


@dataclass(frozen=True)
class Statement:
    tables: tuple[tuple[DataFrame, str | None], ...] = ()
    items: tuple[Item, ...] = ()
    where_: Any = None
    groups: tuple[str, ...] = ()
    having_: Any = None
    orders: tuple[tuple[str, str], ...] = ()
    extra: dict = field(default_factory=dict)

    def from_(self, df: DataFrame, alias: str | None = None) -> "Statement":
        return replace(self, tables=self.tables + ((df, alias),))

    def select(self, *items: Item) -> "Statement":
        return replace(self, items=self.items + tuple(items))

    def where(self, tree: Any) -> "Statement":
        return replace(self, where_=tree)

    def group_by(self, *names: str) -> "Statement":
        return replace(self, groups=self.groups + tuple(names))

    def having(self, tree: Any) -> "Statement":
        """Conditions on groups: on selected fields and aliases, or on functions (``Cond(fn("SUM", "x"), ...)``)
        whether the statement selects them or not."""
        return replace(self, having_=tree)

    def order_by(self, *specs: str | tuple[str, str]) -> "Statement":
        norm = tuple((s, "ASC") if isinstance(s, str) else (s[0], s[1].upper()) for s in specs)
        for _, d in norm:
            if d not in DESCENDING | {"ASC"}:
                raise ValueError(f"unknown direction {d!r}")
        return replace(self, orders=self.orders + norm)

    # -- compilation ------------------------------------------------------------------------------
    def _source(self) -> DataFrame:
        if not self.tables:
            raise ValueError("a statement needs a FROM table")
        frames = [(df.alias(a) if a else df, a) for df, a in self.tables]
        # the next table is always one that an equality ties to those already joined, whatever the
        # order of the FROM list
        (out, first), *waiting = frames
        joined = {first}
        equalities = [(self._owner(a), a, self._owner(b), b) for a, b in _top_level_equalities(self.where_)]
        while waiting:
            for i, (df, alias) in enumerate(waiting):
                conds = [F.col(a) == F.col(b) for own_a, a, own_b, b in equalities
                         if (own_a in joined and own_b == alias) or (own_b in joined and own_a == alias)]
                if conds:
                    out = out.join(df, reduce(lambda x, y: x & y, conds), "inner")
                    joined.add(alias)
                    del waiting[i]
                    break
            else:
                raise ValueError(f"FROM tables {[a for _, a in waiting]} have no equality with the others; "
                                 "cross products are not built")
        return out

    def _owner(self, name: str) -> str | None:
        """Alias of the FROM table that a field belongs to; unqualified names must be in one table only."""
        head, _, rest = name.partition(".")
        aliases = [a for _, a in self.tables]
        if rest and head in aliases:
            return head
        holders = [a for df, a in self.tables if name in df.columns]
        if len(holders) > 1:
            raise ValueError(f"field {name!r} is in several FROM tables")
        return holders[0] if holders else None

    def to_frame(self) -> DataFrame:
        df = self._source()
        if self.where_ is not None:
            df = df.filter(where_tree(self.where_))
        having, hidden = _named(self.having_, [])
        aggregated = bool(self.groups) or bool(hidden) or any(i.kind == "function" for i in self.items)
        if aggregated:
            aggs = []
            for i in [*self.items, *hidden]:
                if i.kind == "function":
                    table = DISTINCT_AGGREGATES if "DISTINCT" in i.keywords else AGGREGATES
                    aggs.append(table[i.func](_col(i.name)).alias(i.output_name()))
            grouped = df.groupBy(*[F.col(g) for g in self.groups]).agg(*aggs) if aggs else \
                df.groupBy(*[F.col(g) for g in self.groups]).count().drop("count")
            out_cols = []
            for i in self.items:
                if i.kind == "field":
                    out_cols.append(F.col(i.name.split(".")[-1]).alias(i.output_name()))
                elif i.kind == "value":
                    out_cols.append(F.lit(i.value).alias(i.output_name()))
                else:
                    out_cols.append(F.col(i.output_name()))
            if having is not None:
                grouped = grouped.filter(where_tree(having))
            out = grouped.select(*out_cols)
        else:
            cols = []
            for i in self.items:
                if i.kind == "field":
                    cols.append(F.col(i.name).alias(i.output_name()))
                else:
                    cols.append(F.lit(i.value).alias(i.output_name()))
            out = df.select(*cols)
            if any("DISTINCT" in i.keywords for i in self.items):
                out = out.distinct()
        if self.orders:
            out = out.orderBy(*[F.col(n).desc() if d in DESCENDING else F.col(n).asc()
                                for n, d in self.orders])
        return out


def _named(tree: Any, hidden: list[Item]) -> tuple[Any, list[Item]]:
    """A having-tree with names in place of its functions, and the functions under these names."""
    def name(x):
        if not isinstance(x, Item):
            return x
        hidden.append(replace(x, alias=f"__having_{len(hidden)}"))
        return hidden[-1].alias

    if isinstance(tree, Cond):
        rhs = Field(name(tree.rhs)) if isinstance(tree.rhs, Item) else tree.rhs
        return replace(tree, field=name(tree.field), rhs=rhs), hidden
    if isinstance(tree, (list, tuple)):
        return [_named(t, hidden)[0] if not isinstance(t, str) else t for t in tree], hidden
    return tree, hidden


def _top_level_equalities(tree: Any) -> list[tuple[str, str]]:
    """field = field conditions joined by AND at the top level of a where-tree."""
    if tree is None:
        return []
    if isinstance(tree, Cond):
        items: Sequence = [tree]
    elif isinstance(tree, (list, tuple)):
        items = list(tree)
        if any(str(op).upper() == "OR" for op in items[1::2]):
            return []
    else:
        return []
    out = []
    for it in items[::2]:
        if isinstance(it, Cond) and it.op.strip() in ("=", "==") and isinstance(it.rhs, Field):
            out.append((it.field, it.rhs.name))
    return out
