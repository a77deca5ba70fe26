"""Nested-document find / update / pipeline goldens (FIXTURES section 4) and null semantics."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import docs

BOOKS = "_id long, by struct<given:string,family:string>, pages int, shelf string, topics array<string>"


@pytest.fixture()
def books(spark):
    rows = [(1, ("Iva", "Holm"), 30, "north", ["a", "b", "c"]),
            (2, ("Teo", "Marsh"), 40, None, ["maps", "tides"]),
            (3, ("Ug", "Holm"), 50, "attic", ["bells", "maps"])]
    return spark.createDataFrame(rows, BOOKS)


def ids(df):
    return sorted(r["_id"] for r in df.collect())


def test_exact_subdocument_equality(books):
    assert ids(docs.find(books, {"by": {"given": "Iva", "family": "Holm"}})) == [1]
    assert ids(docs.find(books, {"by": {"family": "Holm", "given": "Iva"}})) == []  # field order matters
    assert ids(docs.find(books, {"by.family": "Holm"})) == [1, 3]


def test_missing_field_rules(books):
    assert ids(docs.find(books, {"shelf": {"$ne": "north"}})) == [2, 3]
    assert ids(docs.find(books, {"shelf": {"$nin": ["north"]}})) == [2, 3]
    assert ids(docs.find(books, {"shelf": {"$gt": "a"}})) == [1, 3]
    assert ids(docs.find(books, {"shelf": {"$exists": False}})) == [2]
    assert ids(docs.find(books, {"shelf": {"$not": {"$eq": "north"}}})) == [2, 3]


def test_array_operators(books):
    assert ids(docs.find(books, {"topics": "maps"})) == [2, 3]
    assert ids(docs.find(books, {"topics": {"$all": ["maps", "tides"]}})) == [2]
    assert ids(docs.find(books, {"topics": {"$size": 3}})) == [1]
    assert ids(docs.find(books, {"topics.0": "bells"})) == [3]
    assert ids(docs.find(books, {"topics": {"$in": ["c", "tides"]}})) == [1, 2]
    assert ids(docs.find(books, {"topics": {"$elemMatch": {"$gte": "b", "$lt": "c"}}})) == [1, 3]


def test_logic_and_where(books):
    q = {"$or": [{"pages": {"$lt": 35}}, {"by.given": "Ug"}]}
    assert ids(docs.find(books, q)) == [1, 3]
    assert ids(docs.find(books, {"$where": "length(by.given) = 2"})) == [3]


def test_sort_skip_limit_fixed_order(books):
    a = docs.find(books, {}, sort={"pages": -1}, skip=1, limit=1).collect()
    assert [r["_id"] for r in a] == [2]


def test_projection(books):
    out = docs.find(books, {}, projection={"by.given": 1, "_id": 0})
    assert out.columns == ["by"]
    sl = docs.find(books, {"_id": 1}, projection={"topics": {"$slice": -2}}).collect()[0]
    assert sl.topics == ["b", "c"] and sl.pages == 30


def one(df, i, col):
    return [r[col] for r in df.collect() if r["_id"] == i][0]


def test_push_each_slice(books):
    out = docs.update(books, {"_id": 1}, {"$push": {"topics": {"$each": ["z"], "$slice": -3}}})
    assert one(out, 1, "topics") == ["b", "c", "z"]


def test_add_to_set_each(books):
    out = docs.update(books, {"_id": 2}, {"$addToSet": {"topics": {"$each": ["ink", "tides", "salt"]}}})
    assert one(out, 2, "topics") == ["maps", "tides", "ink", "salt"]


def test_loans_are_pushed_kept_sorted_and_returned(books):
    loan = lambda day, to: {"day": day, "to": to}
    out = docs.update(books, {"pages": {"$gt": 35}}, {"$push": {"loans": loan(12, "reading room")}}, multi=True)
    out = docs.update(out, {}, {"$push": {"loans": {"$each": [loan(F.col("pages"), "desk"), loan(3, "bindery")], "$sort": {"day": 1}, "$slice": -2}}}, multi=True)
    assert {i: [(x.day, x.to) for x in one(out, i, "loans")] for i in (1, 2, 3)} == {
        1: [(3, "bindery"), (30, "desk")], 2: [(12, "reading room"), (40, "desk")], 3: [(12, "reading room"), (50, "desk")]}
    out = docs.update(out, {"_id": 2}, {"$set": {"loans.0.to": "returned"}, "$inc": {"loans.1.day": 2}})
    assert [(x.day, x.to) for x in one(out, 2, "loans")] == [(12, "returned"), (42, "desk")]
    assert [x.to for x in one(out, 3, "loans")] == ["reading room", "desk"]


def test_array_updates_inside_sub_documents(spark):
    d = spark.createDataFrame([(1, (["a", "b", "a"], 5)), (2, (None, 6)), (3, None)], "_id long, s struct<tags:array<string>,n:int>")
    tags = lambda df: {r["_id"]: r.s.tags if r.s else None for r in df.collect()}
    some = {"_id": {"$lt": 3}}
    out = docs.update(d, some, {"$push": {"s.tags": {"$each": ["z", "c"], "$sort": 1}}}, multi=True)
    assert out.columns == ["_id", "s"] and tags(out) == {1: ["a", "a", "b", "c", "z"], 2: ["c", "z"], 3: None}
    assert tags(docs.update(d, some, {"$addToSet": {"s.tags": {"$each": ["b", "q"]}}}, multi=True)) == {1: ["a", "b", "a", "q"], 2: ["b", "q"], 3: None}
    assert tags(docs.update(d, some, {"$pull": {"s.tags": "a"}}, multi=True)) == {1: ["b"], 2: None, 3: None}
    out = docs.update(d, some, {"$pop": {"s.tags": 1}, "$pull": {"s.none": "x"}}, multi=True)
    assert out.columns == ["_id", "s"] and tags(out) == {1: ["a", "b"], 2: None, 3: None}
    made = docs.update(d, {"_id": 3}, {"$push": {"s.log": {"at": 1}}, "$addToSet": {"new.list": 7}})
    row = {r["_id"]: r for r in made.collect()}
    assert row[3].s.log[0].at == 1 and row[3].new.list == [7] and row[1].s.log is None and row[1].new is None and row[1].s.n == 5


def test_exclusion_inside_arrays(spark):
    d = spark.createDataFrame([(1, [(1, "x", (2, 3))]), (2, None)], "_id long, arr array<struct<w:int,v:string,o:struct<p:int,q:int>>>")
    rows = {r["_id"]: r.arr for r in docs.find(d, None, projection={"arr.w": 0, "arr.o.p": 0}).collect()}
    assert rows[2] is None and [x.asDict(recursive=True) for x in rows[1]] == [{"v": "x", "o": {"q": 3}}]
    assert docs.find(d, None, projection={"arr.none": 0, "gone.x": 0}).columns == ["_id", "arr"]


def test_skipping_rows_with_ties_nulls_and_beyond_the_end(spark, monkeypatch):
    rows = [(i, None if i % 7 == 0 else i % 5) for i in range(60)]
    d = spark.createDataFrame(rows, "_id long, k int").repartition(5)
    for sort in ({"k": 1, "_id": -1}, {"k": -1, "_id": 1}):
        want = sorted(rows, key=lambda r: ((-1 if r[1] is None else r[1]) * sort["k"], r[0] * sort["_id"]))
        for limit in (10_000, 0):
            monkeypatch.setattr(docs, "SKIP_KEYS", limit)
            for n in (1, 8, 9, 37, 60, 99):
                assert [tuple(r) for r in docs.skip_rows(d, sort, n).collect()] == want[n:]
    monkeypatch.setattr(docs, "SKIP_KEYS", 10_000)
    tied = [r.k for r in docs.skip_rows(d, {"k": 1}, 20).collect()]
    assert tied == sorted((r[1] for r in rows), key=lambda k: -1 if k is None else k)[20:]


def test_variant_documents_tell_null_from_missing(spark):
    from tessera.functions import variantdoc as vd

    texts = {1: '{"a":null,"b":[1,"x",null,2.5],"o":{"p":1,"q":"z"}}', 2: '{"a":5,"b":"x","o":[]}', 3: '{"b":{"k":true},"o":{"q":"z","p":1}}',
             4: '[1]', 5: None, 6: '{"a":5.0,"b":true}'}
    d = spark.createDataFrame(list(texts.items()), "id int, j string").withColumn("v", F.parse_json("j"))
    hits = lambda q: sorted(r.id for r in d.where(vd.matches(F.col("v"), q)).collect())
    assert hits({"a": {"$exists": True}}) == [1, 2, 6] and hits({"a": {"$exists": False}}) == [3, 4, 5]
    assert hits({"a": None}) == [1, 3, 4, 5] and hits({"a": {"$ne": None}}) == [2, 6] and hits({"a": {"$type": "null"}}) == [1]
    assert hits({"a": 5}) == [2, 6] and hits({"a": "5"}) == [] and hits({"a": {"$gte": 4.5}}) == [2, 6] and hits({"a": True}) == []
    assert hits({"b": "x"}) == [1, 2] and hits({"b": {"$gt": 2}}) == [1] and hits({"b": True}) == [6] and hits({"b.k": True}) == [3]
    assert hits({"b.0": 1}) == [1] and hits({"b": {"$size": 4}}) == [1] and hits({"o": {"$size": 0}}) == [2] and hits({"b": None}) == [1, 4, 5]
    assert hits({"o": {"p": 1, "q": "z"}}) == [1, 3] and hits({"b": [1, "x", None, 2.5]}) == [1]
    assert hits({"b": {"$in": ["x", True]}}) == [1, 2, 6] and hits({"b": {"$nin": ["x", True]}}) == [3, 4, 5] and hits({"a": {"$not": {"$gt": 4}}}) == [1, 3, 4, 5]
    assert hits({"$nor": [{"a": 5}, {"b": {"$exists": False}}]}) == [1, 3]

    def made(i, ops):
        return d.where(F.col("id") == i).select(F.to_json(vd.update(F.col("v"), ops)).alias("j")).first().j
    assert made(1, {"$set": {"a": 1, "o.r.s": [1], "b.1": None}}) == '{"a":1,"b":[1,null,null,2.5],"o":{"p":1,"q":"z","r":{"s":[1]}}}'
    assert made(1, {"$unset": {"a": "", "o.p": "", "none.x": ""}}) == '{"b":[1,"x",null,2.5],"o":{"q":"z"}}'
    assert made(2, {"$inc": {"a": 2, "c.d": 1}}) == '{"a":7,"b":"x","c":{"d":1},"o":[]}'
    assert made(6, {"$inc": {"a": 1.5}}) == '{"a":6.5,"b":true}' and made(2, {"$set": {"b": F.col("id")}}) == '{"a":5,"b":2,"o":[]}'


def test_first_match_only_and_multi(books):
    one_upd = docs.update(books, {"by.family": "Holm"}, {"$inc": {"pages": 1}})
    assert [r.pages for r in one_upd.orderBy("_id").collect()] == [31, 40, 50]
    all_upd = docs.update(books, {"by.family": "Holm"}, {"$inc": {"pages": 1}}, multi=True)
    assert [r.pages for r in all_upd.orderBy("_id").collect()] == [31, 40, 51]


def test_set_unset_nested(books):
    out = docs.update(books, {"_id": 1}, {"$set": {"by.family": "Quill", "cover": "linen"}, "$unset": {"shelf": ""}})
    r = [x for x in out.collect() if x["_id"] == 1][0]
    assert (r.by.family, r.cover, r.shelf) == ("Quill", "linen", None)


def test_pull_pop(books):
    out = docs.update(books, {}, {"$pull": {"topics": "maps"}}, multi=True)
    assert one(out, 3, "topics") == ["bells"]
    out = docs.update(books, {"_id": 1}, {"$pop": {"topics": 1}})
    assert one(out, 1, "topics") == ["a", "b"]
    out = docs.update(books, {"_id": 1}, {"$pop": {"topics": -1}})
    assert one(out, 1, "topics") == ["b", "c"]


def test_upsert_only_when_nothing_matches(books):
    out = docs.update(books, {"shelf": "cellar"}, {"$set": {"_id": 9, "pages": 1}}, upsert=True)
    assert ids(out) == [1, 2, 3, 9]
    same = docs.update(books, {"shelf": "north"}, {"$set": {"pages": 1}}, upsert=True)
    assert ids(same) == [1, 2, 3]


def test_remove(books):
    assert ids(docs.remove(books, {"pages": {"$gte": 40}})) == [1]
    assert docs.remove(books, None).count() == 0


def test_pipeline_unwind_group_sort(books):
    out = docs.pipeline(books, [{"$unwind": "$topics"}, {"$group": {"_id": "$topics"}}, {"$sort": {"_id": 1}}])
    assert [r["_id"] for r in out.collect()] == ["a", "b", "bells", "c", "maps", "tides"]
    g = docs.pipeline(books, [{"$group": {"_id": "$by.family", "n": {"$sum": 1}, "first": {"$first": "$pages"},
                                           "last": {"$last": "$pages"}, "avg": {"$avg": "$pages"}}}])
    lee = [r for r in g.collect() if r["_id"] == "Holm"][0]
    assert (lee.n, lee.first, lee.last, lee.avg) == (2, 30, 50, 40.0)


def test_pipeline_order_is_significant(books):
    a = docs.pipeline(books, [{"$sort": {"pages": 1}}, {"$skip": 1}, {"$limit": 1}]).collect()
    b = docs.pipeline(books, [{"$sort": {"pages": 1}}, {"$limit": 1}, {"$skip": 1}]).collect()
    assert [r["_id"] for r in a] == [2] and b == []


def test_pipeline_expressions(books):
    out = docs.pipeline(books, [{"$project": {"initials": {"$concat": [{"$substr": ["$by.given", 0, 1]},
                                                                        {"$substr": ["$by.family", 0, 1]}]},
                                               "up": {"$toUpper": "$by.given"},
                                               "older": {"$add": ["$pages", 10]}}}]).orderBy("_id").collect()
    assert [(r.initials, r.up, r.older) for r in out] == [("IH", "IVA", 40), ("TM", "TEO", 50), ("UH", "UG", 60)]


def test_mixed_types_with_variant(spark):
    parcels = spark.createDataFrame([("p1", '{"weight": 70, "route": "hill"}'),
                                     ("p2", '{"weight": "light", "route": ["sea", "rail"]}'),
                                     ("p3", '{"weight": 5, "route": "road", "insured": true}')],
                                    "name string, doc string")
    v = parcels.select("name", F.parse_json("doc").alias("v"))
    out = v.select("name", F.try_variant_get("v", "$.weight", "int").alias("weight_int"),
                   F.try_variant_get("v", "$.weight", "string").alias("weight_text"),
                   F.try_variant_get("v", "$.insured", "boolean").alias("ins")).orderBy("name").collect()
    assert [(r.weight_int, r.weight_text, r.ins) for r in out] == [(70, "70", None), (None, "light", None),
                                                               (5, "5", True)]


def test_predicates_match_a_python_evaluator(spark):
    """Random find queries: Spark's compiled predicate selects exactly what a direct evaluation of
    the find semantics (missing never matches comparisons, $ne/$nin/$not match missing, a scalar
    against an array means contains) selects."""
    import random

    from hypothesis import given, settings, strategies as st

    rnd = random.Random(7)
    letters = ["a", "b", "c", "d"]
    rows = []
    for i in range(80):
        n = rnd.choice([None, rnd.randint(0, 9)])
        hair = rnd.choice([None] + letters)
        kinds = rnd.choice([None, [rnd.choice(letters) for _ in range(rnd.randint(0, 4))]])
        rows.append((i, n, hair, kinds))
    df = spark.createDataFrame(rows, "_id long, n int, shelf string, kinds array<string>").cache()

    def ev(q, r):
        _, n, hair, kinds = r
        doc = {"n": n, "shelf": hair, "kinds": kinds}
        for k, v in q.items():
            if k == "$or":
                if not any(ev(x, r) for x in v):
                    return False
                continue
            val = doc[k]
            if not isinstance(v, dict):
                ok = (val is not None and v in val) if k == "kinds" else (val is not None and val == v)
            else:
                (op, a), = v.items()
                if op == "$gt":
                    ok = val is not None and val > a
                elif op == "$lte":
                    ok = val is not None and val <= a
                elif op == "$ne":
                    ok = not ((val is not None and a in val) if k == "kinds" else val == a)
                elif op == "$in":
                    ok = val is not None and (bool(set(val) & set(a)) if k == "kinds" else val in a)
                elif op == "$nin":
                    ok = not (val is not None and (bool(set(val) & set(a)) if k == "kinds" else val in a))
                elif op == "$all":
                    ok = val is not None and set(a) <= set(val)
                elif op == "$size":
                    ok = val is not None and len(val) == a
                elif op == "$exists":
                    ok = (val is not None) == a
                elif op == "$not":
                    ok = not ev({k: a}, r)
                else:
                    raise AssertionError(op)
            if not ok:
                return False
        return True

    scalar = st.sampled_from(letters)
    num = st.integers(0, 9)
    n_cond = st.one_of(num, st.builds(lambda o, v: {o: v}, st.sampled_from(["$gt", "$lte", "$ne"]), num),
                       st.builds(lambda v: {"$not": {"$gt": v}}, num), st.builds(lambda b: {"$exists": b}, st.booleans()))
    hair_cond = st.one_of(scalar, st.builds(lambda v: {"$ne": v}, scalar),
                          st.builds(lambda v: {"$in": v}, st.lists(scalar, min_size=1, max_size=2)),
                          st.builds(lambda v: {"$nin": v}, st.lists(scalar, min_size=1, max_size=2)),
                          st.builds(lambda b: {"$exists": b}, st.booleans()))
    kinds_cond = st.one_of(scalar, st.builds(lambda v: {"$all": v}, st.lists(scalar, min_size=1, max_size=2)),
                           st.builds(lambda v: {"$size": v}, st.integers(0, 4)),
                           st.builds(lambda v: {"$ne": v}, scalar),
                           st.builds(lambda v: {"$in": v}, st.lists(scalar, min_size=1, max_size=2)))
    leaf = st.fixed_dictionaries({}, optional={"n": n_cond, "shelf": hair_cond, "kinds": kinds_cond})
    query = st.one_of(leaf, st.builds(lambda a, b: {"$or": [a, b]}, leaf, leaf))

    @settings(max_examples=30, deadline=None)
    @given(query)
    def check(q):
        got = sorted(r["_id"] for r in docs.find(df, q).select("_id").collect())
        want = sorted(r[0] for r in rows if ev(q, r))
        assert got == want, q

    check()


def test_skip_limit_without_sort_use_natural_order(books):
    assert [r["_id"] for r in docs.find(books, {}, skip=1, limit=1).collect()] == [2]


def test_literals_of_other_types_match_nothing(books):
    assert ids(docs.find(books, {"pages": 40.5})) == [] and ids(docs.find(books, {"pages": {"$gte": 40.5}})) == [3]
    assert ids(docs.find(books, {"pages": "40"})) == [] and ids(docs.find(books, {"pages": {"$ne": "40"}})) == [1, 2, 3]
    assert ids(docs.find(books, {"topics": {"$in": [3, "b"]}})) == [1]


def test_null_elements_stay_when_others_are_pulled(spark):
    df = spark.createDataFrame([(1, ["x", None, "y"])], "_id long, v array<string>")
    assert one(docs.update(df, {}, {"$pull": {"v": "y"}}), 1, "v") == ["x", None]
    assert one(docs.update(df, {}, {"$pull": {"v": {"$in": ["x", None]}}}), 1, "v") == ["y"]


def test_absent_and_nested_paths(books):
    out = docs.update(books, {"_id": 1}, {"$inc": {"loans": 2, "by.titles": 3}, "$unset": {"by.given": ""}, "$addToSet": {"tags": "t"}})
    r = [x for x in out.collect() if x["_id"] == 1][0]
    assert (r.loans, r.by.titles, r.by.given, r.by.family, r.tags) == (2, 3, None, "Holm", ["t"])
    r = [x for x in out.collect() if x["_id"] == 2][0]
    assert (r.loans, r.by.titles, r.by.given, r.tags) == (None, None, "Teo", None)


def test_upsert_runs_every_operator(books):
    out = docs.update(books, {"shelf": "cellar"}, {"$inc": {"pages": 5}, "$push": {"topics": "n"}, "$set": {"_id": 9}}, upsert=True)
    r = [x for x in out.collect() if x["_id"] == 9][0]
    assert (r.pages, r.topics, r.shelf) == (5, ["n"], "cellar")


def test_skip_without_limit_and_missing_operands(books):
    assert [r["_id"] for r in docs.find(books, {}, skip=1, sort={"pages": -1}).collect()] == [2, 1]
    assert [r["_id"] for r in docs.pipeline(books, [{"$sort": {"_id": 1}}, {"$skip": 2}]).collect()] == [3]
    out = docs.pipeline(books, [{"$project": {"no": {"$and": ["$gone", True]}, "eq": {"$eq": ["$shelf", "north"]}, "up": {"$toUpper": "$shelf"}}}])
    assert sorted((r["_id"], r.no, r.eq, r.up) for r in out.collect()) == [(1, False, True, "NORTH"), (2, False, False, ""), (3, False, False, "ATTIC")]


def test_unwind_of_a_nested_array(spark):
    df = spark.createDataFrame([(1, ("k", ["a", "b"]))], "_id long, o struct<name:string,parts:array<string>>")
    assert [(r.o.name, r.o.parts) for r in docs.pipeline(df, [{"$unwind": "$o.parts"}]).collect()] == [("k", "a"), ("k", "b")]
