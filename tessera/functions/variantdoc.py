"""Queries and updates over documents kept as VARIANT: any field may be of any type, null or missing.

A DataFrame column of a struct cannot tell a null field from a missing one, and has one type for all rows; a
VARIANT column can. Paths are dotted (``a.b``, ``lines.0.part``). The rules of comparison:

* values compare only inside their own bracket: numbers with numbers, text with text, booleans with booleans;
* a value tested against an array matches when the whole array or any of its elements does;
* ``None`` equals null and missing; ``$exists`` asks for the field alone, null or not; ``$type`` for its kind;
* ``$ne``, ``$nin`` and ``$not`` match whatever their positive form does not.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Kinds of values by the name that ``schema_of_variant`` gives them.
NUMBERS = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"
_KIND = {"number": NUMBERS, "string": "^STRING$", "bool": "^BOOLEAN$", "object": "^OBJECT", "array": "^ARRAY", "null": "^VOID$"}


def _json_path(path: str) -> str:
    out = "$"
    for p in path.split("."):
        out += f"[{p}]" if p.isdigit() else "['" + p.replace("\\", "\\\\").replace("'", "\\'") + "']"
    return out


def get(doc: Column, path: str) -> Column:
    """The VARIANT at ``path``: NULL where it is missing, a null VARIANT where it holds null."""
    return F.try_variant_get(doc, _json_path(path), "variant")


def kind_is(value: Column, kind: str) -> Column:
    """Is a VARIANT a ``number``, ``string``, ``bool``, ``object``, ``array`` or ``null``? False for a missing one."""
    return F.coalesce(F.schema_of_variant(value).rlike(_KIND[kind]), F.lit(False))


def _scalar(value: Column, op: str, arg: Any) -> Column:
    """One comparison of a VARIANT that is no array; false outside the argument's bracket."""
    if arg is None:
        return kind_is(value, "null") if op in ("$eq", "$gte", "$lte") else F.lit(False)
    kind, cast = ("bool", "boolean") if isinstance(arg, bool) else ("number", "double") if isinstance(arg, float) else \
        ("number", "decimal(38,9)") if isinstance(arg, int) else ("string", "string")
    have, want = F.try_variant_get(value, "$", cast), F.lit(arg)
    test = {"$eq": have == want, "$gt": have > want, "$gte": have >= want, "$lt": have < want, "$lte": have <= want}[op]
    return kind_is(value, kind) & F.coalesce(test, F.lit(False))


def _same(value: Column, arg: Any) -> Column:
    """Equality with a whole object or array: the same fields (in any order of an object) and values."""
    return F.coalesce(F.to_json(value) == F.to_json(F.parse_json(F.lit(json.dumps(arg)))), F.lit(False))


def _compare(value: Column, op: str, arg: Any) -> Column:
    if op == "$eq" and arg is None:
        return value.isNull() | kind_is(value, "null") | _any(value, lambda x: kind_is(x, "null"))
    if isinstance(arg, (dict, list)):
        if op != "$eq":
            raise ValueError(f"{op} needs a plain value")
        return _same(value, arg) | _any(value, lambda x: _same(x, arg))
    return _scalar(value, op, arg) | _any(value, lambda x: _scalar(x, op, arg))


def _any(value: Column, test) -> Column:
    """Does any element of an array pass? False for what is no array."""
    return F.coalesce(F.exists(F.try_variant_get(value, "$", "array<variant>"), test), F.lit(False))


def _test(value: Column, op: str, arg: Any) -> Column:
    if op in ("$eq", "$gt", "$gte", "$lt", "$lte"):
        return _compare(value, op, arg)
    if op == "$ne":
        return ~_compare(value, "$eq", arg)
    if op in ("$in", "$nin"):
        found = F.lit(False)
        for x in arg:
            found = found | _compare(value, "$eq", x)
        return found if op == "$in" else ~found
    if op == "$exists":
        return value.isNotNull() if arg else value.isNull()
    if op == "$type":
        return kind_is(value, arg)
    if op == "$size":
        return F.coalesce(F.size(F.try_variant_get(value, "$", "array<variant>")) == arg, F.lit(False)) & kind_is(value, "array")
    if op == "$not":
        return ~_tests(value, arg)
    raise ValueError(f"unsupported operator {op}")


def _tests(value: Column, cond: Any) -> Column:
    if isinstance(cond, dict) and cond and all(k.startswith("$") for k in cond):
        out = F.lit(True)
        for op, arg in cond.items():
            out = out & _test(value, op, arg)
        return out
    return _compare(value, "$eq", cond)


def matches(doc: Column, query: dict) -> Column:
    """A find query over a VARIANT column; never null."""
    out = F.lit(True)
    for k, v in query.items():
        if k in ("$or", "$and", "$nor"):
            parts = [matches(doc, q) for q in v]
            term = parts[0]
            for p in parts[1:]:
                term = term & p if k == "$and" else term | p
            term = ~term if k == "$nor" else term
        else:
            term = _tests(get(doc, k), v)
        out = out & term
    return out


def _variant(value: Any) -> Column:
    return value.cast("variant") if isinstance(value, Column) else F.parse_json(F.lit(json.dumps(value)))


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), use)[0]


def _rewrite(value: Column, parts: list[str], change) -> Column:
    """``value`` with ``change(old)`` at a path; ``change`` gives NULL to take the field away. What is on the way and
    is no object becomes one; positions of arrays must be there."""
    if not parts:
        return change(value)
    key, rest = parts[0], parts[1:]
    if key.isdigit():
        old = F.try_variant_get(value, "$", "array<variant>")
        new = F.transform(old, lambda x, i: F.when(i == int(key), F.coalesce(_rewrite(x, rest, change), F.parse_json(F.lit("null")))).otherwise(x))
        return F.when(old.isNotNull(), new.cast("variant")).otherwise(value)
    held = F.coalesce(F.try_variant_get(value, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>"))
    others = F.map_filter(held, lambda k, _: k != key)
    with_it = lambda new: F.when(new.isNull(), others).otherwise(F.map_concat(others, F.create_map(F.lit(key), new)))
    return F.to_variant_object(_bind(_bind(get(value, key), lambda old: _rewrite(old, rest, change)), with_it))


def update(doc: Column, ops: dict) -> Column:
    """``doc`` after ``$set``, ``$unset`` and ``$inc`` (which counts from 0 where there is no number)."""
    for op, fields in ops.items():
        for path, arg in fields.items():
            if op == "$set":
                change = _constant(arg)
            elif op == "$unset":
                change = lambda old: F.lit(None).cast("variant")
            elif op == "$inc":
                change = _plus(arg)
            else:
                raise ValueError(f"unsupported update operator {op}")
            doc = _bind(doc, _step(path, change, only_held=op == "$unset"))
    return doc


def _step(path: str, change, only_held: bool):
    def step(doc):
        new = _rewrite(doc, path.split("."), change)
        return F.when(get(doc, path).isNotNull(), new).otherwise(doc) if only_held else new
    return step


def _constant(arg: Any):
    return lambda old: _variant(arg)


def _plus(arg):
    kind = "double" if isinstance(arg, float) else "bigint"

    def change(old):
        whole = F.coalesce(F.schema_of_variant(old) == "BIGINT", F.lit(True))
        if kind == "bigint":
            return F.when(whole, (F.coalesce(F.try_variant_get(old, "$", "bigint"), F.lit(0)) + arg).cast("variant")).otherwise(
                (F.coalesce(F.try_variant_get(old, "$", "double"), F.lit(0.0)) + arg).cast("variant"))
        return (F.coalesce(F.try_variant_get(old, "$", "double"), F.lit(0.0)) + arg).cast("variant")
    return change
