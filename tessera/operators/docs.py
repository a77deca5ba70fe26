"""Nested-document collections as DataFrames: find, update, remove, insert and aggregation pipelines.

A collection is a DataFrame whose rows are documents (structs and arrays allowed) with an ``_id``
column that also serves as the explicit natural order. Every operation is a whole-frame rewrite;
updates touch only matching rows through ``when(pred, new).otherwise(old)``.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.docpred import _any_of, comparable, doc_pred, literal, resolve
from tessera.session import materialize

ORDER = "_id"


# --- find --------------------------------------------------------------------------------------

def find(df: DataFrame, query: dict | Column | None = None, projection: dict | None = None,
         sort: dict | None = None, skip: int | None = None, limit: int | None = None) -> DataFrame:
    """find(query, projection).sort().skip().limit(): always applied as sort -> skip -> limit."""
    out = df.filter(doc_pred(query, df.schema))
    if not sort and (skip or limit) and ORDER in df.columns:
        sort = {ORDER: 1}     # skip / limit without a sort walk the natural (_id) order
    if sort:
        out = out.orderBy(*[F.col(k).asc() if v >= 0 else F.col(k).desc() for k, v in sort.items()])
    if skip and limit:
        out = out.offset(skip).limit(limit)
    elif skip:
        out = skip_rows(out, sort, skip) if sort else out.offset(skip)
    elif limit:
        out = out.limit(limit)
    if projection:
        out = project(out, projection)
    return out


def _ordering(sort: dict) -> list[Column]:
    return [F.col(k).asc() if v >= 0 else F.col(k).desc() for k, v in sort.items()]


#: Sort keys that ``skip_rows`` reads to find its place; beyond that many rows places are counted instead.
SKIP_KEYS = 10_000


def _after(sort: dict, row) -> Column:
    """Does a document come after ``row`` in the order ``sort`` (nulls before all values)?"""
    out, same = F.lit(False), F.lit(True)
    for k, direction in sort.items():
        c, v = F.col(k), row[k]
        if direction >= 0:
            later = c.isNotNull() if v is None else c > F.lit(v)
        else:
            later = F.lit(False) if v is None else c.isNull() | (c < F.lit(v))
        out = out | (same & F.coalesce(later, F.lit(False)))
        same = same & c.eqNullSafe(F.lit(v))
    return out


def skip_rows(df: DataFrame, sort: dict, n: int) -> DataFrame:
    """All rows but the first ``n`` of the order ``sort`` (an OFFSET without a limit would pass the whole result
    through one task).

    The keys of the first ``n`` rows and one more are found by a top-n pass; what comes after them is a
    filter. Where that row falls among equal keys, or ``n`` is over ``SKIP_KEYS``, rows are numbered
    instead from the row counts of range partitions.
    """
    order = _ordering(sort)
    if n <= SKIP_KEYS and all("." not in k for k in sort):
        head = df.select(*[F.col(k) for k in sort]).orderBy(*order).limit(n + 1).collect()
        if len(head) <= n:
            return df.limit(0)
        if head[n] != head[n - 1]:
            return df.where(_after(sort, head[n - 1])).orderBy(*order)
    ranged = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumn("__part", F.shiftright("__at", 33))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)   # one row per partition
    bases = ranged.groupBy("__part").count().select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__base"))
    kept = ranged.join(bases, "__part").where(F.col("__base") + F.col("__at").bitwiseAND((1 << 33) - 1) >= n)
    return kept.drop("__part", "__at", "__base").orderBy(*order)


def _slice(arr: Column, spec: Any) -> Column:
    if isinstance(spec, (list, tuple)):
        skip, n = spec
        start = F.lit(skip + 1) if skip >= 0 else F.greatest(F.size(arr) + skip + 1, F.lit(1))
        return F.slice(arr, start, F.lit(n))
    n = int(spec)
    if n >= 0:
        return F.slice(arr, 1, n)
    return F.slice(arr, F.greatest(F.size(arr) + n + 1, F.lit(1)), F.lit(-n))


def _only(col: Column, typ: T.DataType, tree: dict) -> Column:
    """``col`` with just the fields named in ``tree``, in structs and in the elements of arrays."""
    if not tree:
        return col
    if isinstance(typ, T.ArrayType):
        return F.transform(col, lambda x: _only(x, typ.elementType, tree))
    if not isinstance(typ, T.StructType):
        return F.lit(None).cast(typ)                         # a plain value has no fields
    fields = [_only(col[k], typ[k].dataType, sub).alias(k) for k, sub in tree.items() if k in typ.fieldNames()]
    return F.when(col.isNotNull(), F.struct(*fields)) if fields else F.lit(None)


def _without(col: Column, typ: T.DataType, parts: list[str]) -> Column:
    """``col`` without the field at a path, in structs and in the elements of arrays. The last field of a struct
    cannot be taken away from it and becomes null."""
    if isinstance(typ, T.ArrayType):
        return F.transform(col, lambda x: _without(x, typ.elementType, parts))
    if not isinstance(typ, T.StructType) or parts[0] not in typ.fieldNames():
        return col
    name, rest = parts[0], parts[1:]
    fields = [(_without(col[f], typ[f].dataType, rest) if f == name else col[f]).alias(f) for f in typ.fieldNames() if rest or f != name]
    if not fields:
        fields = [F.lit(None).cast(typ[name].dataType).alias(name)]
    return F.when(col.isNotNull(), F.struct(*fields))


def project(df: DataFrame, spec: dict) -> DataFrame:
    """Projection: include (1) or exclude (0) paths, ``$slice`` on arrays; ``_id`` kept unless 0."""
    schema = df.schema
    slices = {k: v["$slice"] for k, v in spec.items() if isinstance(v, dict) and "$slice" in v}
    plain = {k: v for k, v in spec.items() if k not in slices}
    include = [k for k, v in plain.items() if v and k != "_id"]
    exclude = [k for k, v in plain.items() if not v]
    if include:
        cols = []
        if plain.get("_id", 1) and "_id" in schema.fieldNames():
            cols.append(F.col("_id"))
        tree: dict = {}
        for k in include + list(slices):
            at = tree
            for part in k.split("."):
                at = at.setdefault(part, {})
        for top, below in tree.items():
            if top in slices:
                cols.append(_slice(F.col(top), slices[top]).alias(top))
            elif top in schema.fieldNames():
                cols.append(_only(F.col(f"`{top}`"), schema[top].dataType, below).alias(top))
        return df.select(*cols)
    out = df
    for k in exclude:
        top, *rest = k.split(".")
        if not rest:
            out = out.drop(top)
        elif top in schema.fieldNames():
            out = out.withColumn(top, _without(F.col(f"`{top}`"), out.schema[top].dataType, rest))
    for k, s in slices.items():
        out = out.withColumn(k, _slice(F.col(k), s))
    return out


# --- update ------------------------------------------------------------------------------------

def _target(df: DataFrame, query, multi: bool, order: str) -> Column:
    pred = doc_pred(query, df.schema)
    if multi:
        return pred
    # first match only: the match with the least order key (a scalar subquery, evaluated once)
    first = df.filter(pred).agg(F.min(order)).scalar()
    return pred & (F.col(order) == first)


def _rewrite(col: Column, typ: T.DataType, parts: list[str], fn) -> Column:
    """``col`` with the value at a path (struct fields, 0-based array positions) replaced by
    ``fn(old value, its type)``; absent fields on the way are made."""
    if not parts:
        return fn(col, typ)
    p, rest = parts[0], parts[1:]
    if isinstance(typ, T.ArrayType) and p.isdigit():
        i, et = int(p), typ.elementType
        return F.transform(col, lambda x, j: F.when(j == i, _rewrite(x, et, rest, fn)).otherwise(x))
    if isinstance(typ, T.StructType):
        known = typ[p].dataType if p in typ.fieldNames() else T.NullType()
        new = _rewrite(col[p] if p in typ.fieldNames() else F.lit(None), known, rest, fn)
        fields = [new.alias(p) if f == p else col[f].alias(f) for f in typ.fieldNames()]
        return F.struct(*fields, *([] if p in typ.fieldNames() else [new.alias(p)]))
    if isinstance(typ, T.NullType):
        return F.struct(_rewrite(F.lit(None), T.NullType(), rest, fn).alias(p))
    raise ValueError(f"cannot go to {p!r} in a {typ.simpleString()} field")


def _at_path(df: DataFrame, path: str, hit: Column, fn) -> DataFrame:
    """``df`` with ``fn(old value, its type)`` at ``path`` in the rows that ``hit`` marks."""
    top, *rest = path.split(".")
    schema = df.schema
    if top not in schema.fieldNames():
        return df.withColumn(top, F.when(hit, _rewrite(F.lit(None), T.NullType(), rest, fn)))
    typ = schema[top].dataType
    new = _rewrite(F.col(f"`{top}`"), typ, rest, fn)
    made = df.select(new.alias("x")).schema["x"].dataType
    old = _widened(F.col(f"`{top}`"), typ, made)
    return df.withColumn(top, F.when(hit, new).otherwise(old))


def _widened(col: Column, typ: T.DataType, made: T.DataType) -> Column:
    """``col`` with the struct fields that ``made`` has beyond ``typ``, as nulls."""
    if typ == made:
        return col
    if isinstance(typ, T.StructType) and isinstance(made, T.StructType):
        fields = [_widened(col[f.name], typ[f.name].dataType, f.dataType).alias(f.name) if f.name in typ.fieldNames()
                  else F.lit(None).cast(f.dataType).alias(f.name) for f in made.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(typ, T.ArrayType) and isinstance(made, T.ArrayType):
        return F.transform(col, lambda x: _widened(x, typ.elementType, made.elementType))
    return col.cast(made)


def _set_path(df: DataFrame, path: str, hit: Column, new: Any) -> DataFrame:
    return _at_path(df, path, hit, lambda old, typ: literal(new, None if isinstance(typ, T.NullType) else typ))


def _infer_type(df: DataFrame, v: Any) -> T.DataType:
    if isinstance(v, Column):
        return df.select(v.alias("x")).schema["x"].dataType
    if isinstance(v, bool):
        return T.BooleanType()
    if isinstance(v, int):
        return T.LongType()
    if isinstance(v, float):
        return T.DoubleType()
    if isinstance(v, dict):
        return T.StructType([T.StructField(k, _infer_type(df, x)) for k, x in v.items()])
    return T.StringType()


def _array(df: DataFrame, old: Column, typ: T.DataType, example: Any) -> tuple[Column, T.DataType]:
    """(the array, its element type) of a field; an absent one is an empty array of the example's type."""
    et = typ.elementType if isinstance(typ, T.ArrayType) else _infer_type(df, example)
    empty = F.array().cast(T.ArrayType(et))
    return (F.coalesce(old, empty) if isinstance(typ, T.ArrayType) else empty), et


def _push(df: DataFrame, old: Column, typ: T.DataType, arg: Any) -> Column:
    if isinstance(arg, dict) and "$each" in arg:
        each = list(arg["$each"])
        sort = arg.get("$sort")
        keep = arg.get("$slice")
    else:
        each, sort, keep = [arg], None, None
    cur, et = _array(df, old, typ, each[0])
    new = F.concat(cur, F.array(*[literal(v, et) for v in each]).cast(T.ArrayType(et)))
    if sort is not None:
        if isinstance(sort, dict):
            (key, direction), = sort.items()
            if direction >= 0:
                cmp = lambda a, b: F.when(a[key] < b[key], -1).when(a[key] > b[key], 1).otherwise(0)
            else:
                cmp = lambda a, b: F.when(a[key] > b[key], -1).when(a[key] < b[key], 1).otherwise(0)
            new = F.array_sort(new, cmp)
        else:
            new = F.array_sort(new) if sort >= 0 else F.reverse(F.array_sort(new))
    return new if keep is None else _slice(new, keep)


def _add_to_set(df: DataFrame, old: Column, typ: T.DataType, arg: Any) -> Column:
    each = list(arg["$each"]) if isinstance(arg, dict) and "$each" in arg else [arg]
    cur, et = _array(df, old, typ, each[0])
    return F.concat(cur, F.array_except(F.array(*[literal(v, et) for v in each]).cast(T.ArrayType(et)), cur))


def _pull(old: Column, typ: T.ArrayType, arg: Any) -> Column:
    et = typ.elementType
    gone = list(arg["$in"]) if isinstance(arg, dict) and "$in" in arg else [arg]
    return F.filter(old, lambda x: ~_any_of(x, et, [v for v in gone if comparable(v, et)]))


def _pop(old: Column, arg: Any) -> Column:
    n = F.greatest(F.size(old) - 1, F.lit(0))
    new = F.slice(old, 1, n) if arg >= 0 else F.slice(old, F.lit(2), n)
    return F.when(F.size(old) <= 0, old).otherwise(new)


def update(df: DataFrame, query: dict | Column | None, ops: dict, multi: bool = False,
           upsert: bool = False, order: str = ORDER) -> DataFrame:
    """update(query, ops, upsert, multi): ``$inc $set $unset $push $addToSet $pull $pop``.

    ``multi=False`` changes only the first matching document by ``order``. With ``upsert=True`` a
    document built by running the operators on the query's equality fields is inserted when nothing
    matches. All operators take paths (``ends.last``, ``notes.0.stars``, ``sheet.tags``); absent fields are
    made by ``$set``, ``$inc``, ``$push`` and ``$addToSet``, and left alone by the others.
    """
    hit = _target(df, query, multi, order)
    base = df
    out = df.withColumn("__hit", hit)
    h = F.col("__hit")
    for op, fields in ops.items():
        for name, arg in fields.items():
            if op == "$inc":
                out = _at_path(out, name, h, lambda old, typ: F.coalesce(old, F.lit(0).cast(typ) if isinstance(typ, T.NumericType) else F.lit(0)) + F.lit(arg))
            elif op == "$set":
                out = _set_path(out, name, h, arg)
            elif op == "$unset":
                if not isinstance(resolve(name, out.schema)[1], T.NullType):
                    out = _at_path(out, name, h, lambda old, typ: F.lit(None).cast(typ))
            elif op == "$push":
                out = _at_path(out, name, h, lambda old, typ: _push(df, old, typ, arg))
            elif op == "$addToSet":
                out = _at_path(out, name, h, lambda old, typ: _add_to_set(df, old, typ, arg))
            elif op in ("$pull", "$pop"):
                if isinstance(resolve(name, out.schema)[1], T.ArrayType):        # an absent array has nothing to take
                    out = _at_path(out, name, h, lambda old, typ: _pull(old, typ, arg) if op == "$pull" else _pop(old, arg))
            else:
                raise ValueError(f"unsupported update operator {op}")
    out = out.drop("__hit")
    if upsert:
        # every operator runs on a document of the query's equality fields
        seed = {k: v for k, v in (query or {}).items() if not k.startswith("$") and not isinstance(v, dict)}
        row = update(_document_row(base, seed), None, ops, multi=True)
        nothing = ~base.filter(doc_pred(query, base.schema)).exists()
        out = out.unionByName(row.filter(nothing), allowMissingColumns=True)
    return out


def _document_row(like: DataFrame, values: dict) -> DataFrame:
    """One-row frame with the collection's columns (missing ones NULL) holding ``values``."""
    spark = like.sparkSession
    cols = []
    for f in like.schema.fields:
        if f.name in values:
            cols.append(literal(values[f.name], f.dataType).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return spark.range(1).select(*cols)


def remove(df: DataFrame, query: dict | Column | None = None) -> DataFrame:
    """remove(query): drop matching documents; ``None`` removes all."""
    if not query:
        return df.limit(0)
    return df.filter(~F.coalesce(doc_pred(query, df.schema), F.lit(False)))


def insert(df: DataFrame, docs: DataFrame) -> DataFrame:
    """insert / batchInsert: append documents (columns aligned by name, missing -> NULL)."""
    return df.unionByName(docs, allowMissingColumns=True)


def save(docs: DataFrame, path: str) -> None:
    """Append documents to a stored collection (made where there is none)."""
    docs.write.mode("append").parquet(path)


def drop(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Drop a stored collection: all documents go in one commit, and an empty collection of ``schema`` is left, so
    that readers find one at any time."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


# --- aggregation pipeline ----------------------------------------------------------------------

def expr(e: Any, schema: T.StructType) -> Column:
    """Pipeline expression -> Column: ``"$path"``, literals and operator documents."""
    if isinstance(e, Column):
        return e
    if isinstance(e, str) and e.startswith("$"):
        return resolve(e[1:], schema)[0]
    if not isinstance(e, dict):
        return F.lit(e)
    if len(e) != 1 or not next(iter(e)).startswith("$"):
        return F.struct(*[expr(v, schema).alias(k) for k, v in e.items()])
    (op, arg), = e.items()
    args = arg if isinstance(arg, list) else [arg]
    a = [expr(x, schema) for x in args]
    if op == "$toUpper":
        return F.coalesce(F.upper(a[0]), F.lit(""))
    if op == "$toLower":
        return F.coalesce(F.lower(a[0]), F.lit(""))
    if op == "$concat":
        return F.concat(*a)
    if op == "$substr":
        return F.substring(a[0], args[1] + 1, args[2])
    if op == "$add":
        out = a[0]
        for x in a[1:]:
            out = out + x
        return out
    if op == "$subtract":
        return a[0] - a[1]
    if op == "$multiply":
        out = a[0]
        for x in a[1:]:
            out = out * x
        return out
    if op == "$divide":
        return a[0] / a[1]
    if op == "$mod":
        return a[0] % a[1]
    if op == "$year":
        return F.year(a[0])
    if op == "$month":
        return F.month(a[0])
    if op == "$dayOfMonth":
        return F.dayofmonth(a[0])
    if op == "$dayOfWeek":
        return F.dayofweek(a[0])
    if op == "$hour":
        return F.hour(a[0])
    # a missing operand is false in logic, equal to another missing one, and below every value
    truth = lambda c: F.coalesce(c.cast("boolean"), F.lit(False))
    if op == "$and":
        out = truth(a[0])
        for x in a[1:]:
            out = out & truth(x)
        return out
    if op == "$or":
        out = truth(a[0])
        for x in a[1:]:
            out = out | truth(x)
        return out
    if op == "$not":
        return ~truth(a[0])
    if op in ("$eq", "$ne"):
        same = a[0].eqNullSafe(a[1])
        return same if op == "$eq" else ~same
    if op in ("$gt", "$gte", "$lt", "$lte"):
        l, r = a if op in ("$gt", "$gte") else a[::-1]
        above = F.coalesce(l > r, l.isNotNull() & r.isNull())
        return above if op in ("$gt", "$lt") else above | l.eqNullSafe(r)
    if op == "$cond":
        return F.when(truth(a[0]), a[1]).otherwise(a[2])
    if op == "$size":
        return F.size(a[0])
    raise ValueError(f"unsupported expression operator {op}")


ACCUMULATORS = {"$sum", "$avg", "$max", "$min", "$first", "$last", "$count"}


def _group(df: DataFrame, spec: dict, order: str) -> DataFrame:
    schema = df.schema
    key = spec["_id"]
    if isinstance(key, dict):
        keys = [expr(v, schema).alias(k) for k, v in key.items()]
        key_out = F.struct(*[F.col(k) for k in key]).alias("_id")
        key_names = list(key)
    elif key is None:
        keys, key_out, key_names = [], F.lit(None).alias("_id"), []
    else:
        keys, key_out, key_names = [expr(key, schema).alias("_id")], F.col("_id"), ["_id"]
    aggs = []
    for name, acc in spec.items():
        if name == "_id":
            continue
        (op, arg), = acc.items()
        c = expr(arg, schema)
        if op == "$sum":
            aggs.append(F.sum(c).alias(name))
        elif op == "$avg":
            aggs.append(F.avg(c).alias(name))
        elif op == "$max":
            aggs.append(F.max(c).alias(name))
        elif op == "$min":
            aggs.append(F.min(c).alias(name))
        elif op == "$first":
            aggs.append(F.min_by(c, F.col(order)).alias(name))
        elif op == "$last":
            aggs.append(F.max_by(c, F.col(order)).alias(name))
        elif op == "$count":
            aggs.append(F.count(F.lit(1)).alias(name))
        else:
            raise ValueError(f"unsupported accumulator {op} (unbounded list accumulators are not built)")
    grouped = df.groupBy(*keys).agg(*aggs) if aggs else df.select(*keys).distinct()
    rest = [n for n in spec if n != "_id"]
    if key_names == ["_id"]:
        return grouped.select("_id", *rest)
    return grouped.select(key_out, *rest)


def _unwind(df: DataFrame, parts: list[str]) -> DataFrame:
    """One row for each element of the array at a path; the element takes the array's place."""
    out = df.withColumn("__item", F.explode(resolve(".".join(parts), df.schema)[0]))
    if len(parts) == 1:
        return out.withColumn(parts[0], F.col("__item")).drop("__item")
    place = _rewrite(F.col(f"`{parts[0]}`"), df.schema[parts[0]].dataType, parts[1:], lambda old, typ: F.col("__item"))
    return out.withColumn(parts[0], place).drop("__item")


def pipeline(df: DataFrame, stages: list[dict], order: str = ORDER) -> DataFrame:
    """Run aggregation stages in the order written; each stage is DataFrame -> DataFrame.

    ``$first`` / ``$last`` use ``order`` as the explicit document order.
    """
    out, sort = df, None
    for i, st in enumerate(stages):
        (name, arg), = st.items()
        if name == "$match":
            out = out.filter(doc_pred(arg, out.schema))
        elif name == "$project":
            schema = out.schema
            cols = []
            if arg.get("_id", 1) and "_id" in schema.fieldNames():
                cols.append(F.col("_id"))
            for k, v in arg.items():
                if k == "_id":
                    continue
                if v == 1 or v is True:
                    cols.append(resolve(k, schema)[0].alias(k))
                elif v == 0 or v is False:
                    continue
                else:
                    cols.append(expr(v, schema).alias(k))
            if all(v in (0, False) for k, v in arg.items() if k != "_id") and any(k != "_id" for k in arg):
                out = out.drop(*[k for k in arg if k != "_id"])
                if not arg.get("_id", 1):
                    out = out.drop("_id")
            else:
                out = out.select(*cols)
        elif name == "$unwind":
            path = arg[1:] if isinstance(arg, str) else arg["path"][1:]
            out = _unwind(out, path.split("."))
        elif name == "$group":
            out = _group(out, arg, order)
        elif name == "$sort":
            out, sort = out.orderBy(*_ordering(arg)), arg
            continue
        elif name == "$limit":
            out, sort = out.limit(int(arg)), None
        elif name == "$skip":
            bounded = sort is None or (i + 1 < len(stages) and "$limit" in stages[i + 1])
            out = out.offset(int(arg)) if bounded else skip_rows(out, sort, int(arg))
            continue
        else:
            raise ValueError(f"unsupported stage {name}")
    return out
