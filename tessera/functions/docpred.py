"""Document query predicates and paths (find-style) compiled to Spark Columns.

Paths are dotted: ``name.last`` reads a struct field, ``kinds.0`` the first array element,
``comments.rating`` the ``rating`` of every element of an array of structs. Missing and null are the
same in a DataFrame; the null rules below follow the find semantics:

* comparisons (``$gt`` ...) and equality never match a missing field;
* ``$ne`` / ``$nin`` / ``$not`` *do* match a missing field;
* a scalar tested against an array field matches when any element matches.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def resolve(path: str, schema: T.StructType) -> tuple[Column, T.DataType]:
    """Column and type for a dotted path (positional parts are 0-based)."""
    parts = path.split(".")
    head = parts[0]
    if head not in schema.fieldNames():
        return F.lit(None), T.NullType()
    col = F.col(f"`{head}`")
    typ = schema[head].dataType
    for p in parts[1:]:
        if isinstance(typ, T.ArrayType) and p.isdigit():
            col = F.try_element_at(col, F.lit(int(p) + 1))
            typ = typ.elementType
        elif isinstance(typ, T.ArrayType) and isinstance(typ.elementType, T.StructType):
            st = typ.elementType
            if p not in st.fieldNames():
                return F.lit(None), T.NullType()
            col = F.transform(col, lambda x, p=p: x[p])
            typ = T.ArrayType(st[p].dataType)
        elif isinstance(typ, T.StructType):
            if p not in typ.fieldNames():
                return F.lit(None), T.NullType()
            col = col[p]
            typ = typ[p].dataType
        else:
            return F.lit(None), T.NullType()
    return col, typ


def comparable(value: Any, typ: T.DataType) -> bool:
    """Whether a query value can equal a field of this type (numbers only compare with numbers, text
    with text, dates with dates or their text form)."""
    if value is None or isinstance(value, (Column, dict, list, tuple)):
        return True
    if isinstance(typ, T.BooleanType) or isinstance(value, bool):
        return isinstance(typ, T.BooleanType) and isinstance(value, bool)
    if isinstance(typ, T.NumericType) or isinstance(value, (int, float)):
        return isinstance(typ, T.NumericType) and isinstance(value, (int, float))
    return True


def literal(value: Any, typ: T.DataType | None = None) -> Column:
    """Literal for a query value; dicts become structs, lists arrays (cast to ``typ`` when known)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dict):
        if isinstance(typ, T.StructType):
            fields = [literal(v, typ[k].dataType if k in typ.fieldNames() else None).alias(k)
                      for k, v in value.items()]
        else:
            fields = [literal(v).alias(k) for k, v in value.items()]
        return F.struct(*fields)
    if isinstance(value, (list, tuple)):
        et = typ.elementType if isinstance(typ, T.ArrayType) else None
        return F.array(*[literal(v, et) for v in value]) if value else F.array().cast(typ or T.ArrayType(T.StringType()))
    c = F.lit(value)
    if isinstance(typ, T.IntegralType) and isinstance(value, float):
        return c                                             # compared as a double: 70.5 is not 70
    if isinstance(typ, T.IntegralType) and isinstance(value, int) and not isinstance(value, bool):
        return c.cast("bigint")
    if typ is not None and not isinstance(typ, (T.NullType, T.StructType, T.ArrayType)) and value is not None:
        c = c.cast(typ)
    return c


def _struct_equal(col: Column, typ: T.DataType, value: dict) -> Column:
    # exact sub-document equality: same fields, same order, same values
    if not isinstance(typ, T.StructType) or list(value.keys()) != typ.fieldNames():
        return F.lit(False)
    out = col.isNotNull()
    for k, v in value.items():
        out = out & F.coalesce(_cmp(col[k], typ[k].dataType, "$eq", v), F.lit(False))
    return out


def _any_of(col: Column, typ: T.DataType, vals: list) -> Column:
    """Membership without three-valued results: a null field is a member only of lists with None."""
    some = [literal(x, typ) for x in vals if x is not None]
    member = F.coalesce(col.isin(some), F.lit(False)) if some else F.lit(False)
    return member | col.isNull() if None in vals else member


def _is_array(typ: T.DataType) -> bool:
    return isinstance(typ, T.ArrayType)


def _cmp(col: Column, typ: T.DataType, op: str, v: Any) -> Column:
    """One comparison operator against a path; array paths match when any element does."""
    if _is_array(typ) and op in ("$eq", "$gt", "$gte", "$lt", "$lte") and not isinstance(v, (list, tuple)):
        et = typ.elementType
        return F.exists(col, lambda x: _cmp(x, et, op, v))
    if op in ("$eq", "$gt", "$gte", "$lt", "$lte") and not isinstance(typ, T.NullType) and not comparable(v, typ):
        return F.lit(False)
    if op == "$eq":
        if isinstance(v, dict):
            return _struct_equal(col, typ, v)
        if v is None:
            return col.isNull()
        return col == literal(v, typ)
    if op == "$gt":
        return col > literal(v, typ)
    if op == "$gte":
        return col >= literal(v, typ)
    if op == "$lt":
        return col < literal(v, typ)
    if op == "$lte":
        return col <= literal(v, typ)
    if op == "$ne":
        return ~F.coalesce(_cmp(col, typ, "$eq", v), F.lit(False))
    if op == "$in":
        vals = [x for x in v if isinstance(typ, T.NullType) or comparable(x, typ.elementType if _is_array(typ) else typ)]
        if _is_array(typ):
            here = F.exists(col, lambda x: _any_of(x, typ.elementType, vals))
            return F.coalesce(here, F.lit(None in vals))
        return _any_of(col, typ, vals)
    if op == "$nin":
        return ~F.coalesce(_cmp(col, typ, "$in", v), F.lit(False))
    if op == "$all":
        et = typ.elementType if _is_array(typ) else typ
        out = col.isNotNull()
        for x in v:
            out = out & _cmp(col, typ, "$eq", x) if comparable(x, et) else F.lit(False)
        return out
    if op == "$size":
        return F.size(col) == int(v)
    if op == "$exists":
        return col.isNotNull() if v else col.isNull()
    if op == "$regex":
        return col.rlike(v)
    if op == "$mod":
        d, r = v
        return (col % d) == r
    if op == "$elemMatch":
        et = typ.elementType if _is_array(typ) else typ
        return F.coalesce(F.exists(col, lambda x: _elem_pred(x, et, v)), F.lit(False))
    if op == "$not":
        return ~F.coalesce(_field_pred(col, typ, v), F.lit(False))
    raise ValueError(f"unsupported operator {op}")


def _elem_pred(x: Column, typ: T.DataType, cond: dict) -> Column:
    out = F.lit(True)
    for k, v in cond.items():
        if k.startswith("$"):
            out = out & _cmp(x, typ, k, v)
        else:
            sub, st = (x[k], typ[k].dataType) if isinstance(typ, T.StructType) and k in typ.fieldNames() \
                else (F.lit(None), T.NullType())
            out = out & _field_pred(sub, st, v)
    return out


def _field_pred(col: Column, typ: T.DataType, v: Any) -> Column:
    if isinstance(v, dict) and v and all(k.startswith("$") for k in v):
        out = None
        for op, arg in v.items():
            c = _cmp(col, typ, op, arg)
            out = c if out is None else out & c
        return out
    return _cmp(col, typ, "$eq", v)


def doc_pred(query: dict | Column | None, schema: T.StructType) -> Column:
    """Compile a find query (dict) into a boolean Column; ``None`` / ``{}`` match everything."""
    if query is None:
        return F.lit(True)
    if isinstance(query, Column):
        return query
    out = None
    for k, v in query.items():
        if k == "$or":
            parts = [doc_pred(q, schema) for q in v]
            term = parts[0]
            for p in parts[1:]:
                term = term | p
        elif k == "$and":
            parts = [doc_pred(q, schema) for q in v]
            term = parts[0]
            for p in parts[1:]:
                term = term & p
        elif k == "$nor":
            parts = [~F.coalesce(doc_pred(q, schema), F.lit(False)) for q in v]
            term = parts[0]
            for p in parts[1:]:
                term = term & p
        elif k == "$where":
            # arbitrary per-document condition: a Column, a callable building one (or one of where_vector), or SQL text
            term = v if isinstance(v, Column) else v() if callable(v) else F.expr(v)
        else:
            col, typ = resolve(k, schema)
            term = _field_pred(col, typ, v)
        out = term if out is None else out & term
    # NULL means "does not match": filter() drops it, so no coalesce wrapper is needed here and the
    # comparisons stay visible to parquet predicate pushdown. Negations coalesce on their own.
    return F.lit(True) if out is None else out


def where_vector(fn, *paths: str):
    """A ``$where`` condition by a vectorised function: ``fn`` takes an Arrow array for each of ``paths`` and
    returns booleans (null counts as false)."""
    from tessera.functions.extract import vectorised

    return lambda: F.coalesce(vectorised(fn, "boolean")(*[F.col(p) for p in paths]), F.lit(False))
