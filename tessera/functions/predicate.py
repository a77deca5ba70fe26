"""Condition trees for typed tables (field op value / field op field, AND/OR groups).

A where-tree is written as a flat sequence ``operand, 'AND'|'OR', operand, ...`` where an operand is
a :class:`Cond`, a nested sequence (a parenthesised group) or a ready ``Column``. SQL precedence
applies inside every level: AND binds before OR, so the tree folds to an OR over runs of ANDs.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    """Reference to another column on the right-hand side of a condition (``id = value``)."""

    name: str


@dataclass(frozen=True)
class Cond:
    """``field op rhs``; ``rhs`` is a literal or a :class:`Field`."""

    field: str
    op: str
    rhs: Any = None

    def column(self) -> Column:
        left = F.col(self.field)
        right = F.col(self.rhs.name) if isinstance(self.rhs, Field) else self.rhs
        return compare(left, self.op, right)


def compare(left: Column, op: str, right: Any) -> Column:
    o = op.strip().upper()
    if o in ("=", "=="):
        return left == right
    if o in ("!=", "<>"):
        return left != right
    if o == "<":
        return left < right
    if o == "<=":
        return left <= right
    if o == ">":
        return left > right
    if o == ">=":
        return left >= right
    if o == "LIKE":
        return left.like(right)
    if o == "NOT LIKE":
        return ~left.like(right)
    if o == "IN":
        return left.isin(list(right))
    if o == "NOT IN":
        return ~left.isin(list(right))
    if o == "IS NULL":
        return left.isNull()
    if o == "IS NOT NULL":
        return left.isNotNull()
    raise ValueError(f"unsupported operator {op!r}")


def _operand(x: Any) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, Cond):
        return x.column()
    if isinstance(x, (list, tuple)):
        return where(x)
    raise TypeError(f"not a condition: {x!r}")


def where(tree: Sequence[Any] | Cond | Column | None) -> Column:
    """Fold a where-tree into one boolean Column (``None`` selects every row)."""
    if tree is None:
        return F.lit(True)
    if isinstance(tree, (Cond, Column)):
        return _operand(tree)
    items = list(tree)
    if not items:
        return F.lit(True)
    if len(items) % 2 == 0:
        raise ValueError("a where-tree alternates operands and AND/OR")
    or_terms: list[Column] = []
    run = _operand(items[0])
    for op, rhs in zip(items[1::2], items[2::2]):
        o = str(op).strip().upper()
        if o == "AND":
            run = run & _operand(rhs)
        elif o == "OR":
            or_terms.append(run)
            run = _operand(rhs)
        else:
            raise ValueError(f"unknown boolean operator {op!r}")
    or_terms.append(run)
    out = or_terms[0]
    for t in or_terms[1:]:
        out = out | t
    return out


def not_true(pred: Column) -> Column:
    """Rows for which ``pred`` is not TRUE (FALSE or NULL): the complement used by deletes."""
    return ~F.coalesce(pred, F.lit(False))
