"""Statement objects: where-tree precedence, select list, grouping, FROM lists."""

import pytest

from pyspark.sql import functions as F

from tessera.functions.predicate import Cond, Field, where
from tessera.operators.statement import Statement, fld, fn, val


@pytest.fixture()
def t(spark):
    return spark.createDataFrame([(1, "1", "world"), (2, "x", "a"), (3, "3", "a"), (4, "y", "b")],
                                 "id int, value string, name string")


def test_precedence_and_groups(t):
    # a AND b OR c  ==  (a AND b) OR c
    tree = [Cond("id", ">", 1), "AND", Cond("name", "=", "a"), "OR", Cond("id", "=", 1)]
    assert sorted(r.id for r in t.filter(where(tree)).collect()) == [1, 2, 3]
    grouped = [Cond("id", ">", 1), "AND", [Cond("name", "=", "a"), "OR", Cond("id", "=", 1)]]
    assert sorted(r.id for r in t.filter(where(grouped)).collect()) == [2, 3]


def test_field_to_field(spark):
    # both sides of a field-to-field condition have the same type
    t = spark.createDataFrame([(1, 1), (2, 5), (3, 3)], "id int, value int")
    c = Cond("id", "=", Field("value"))
    assert sorted(r.id for r in t.filter(where([c, "AND", [c], "OR", c])).collect()) == [1, 3]


def test_select_list_and_order(t):
    st = (Statement().from_(t).select(fld("name"), val("ok", "const"), fn("COUNT", "id", "count"))
          .group_by("name").order_by(("count", "DSC")))
    rows = st.to_frame().collect()
    assert rows[0]["count"] == 2 and rows[0]["name"] == "a" and rows[0]["const"] == "ok"


def test_having_and_distinct(t):
    st = (Statement().from_(t).select(fld("name"), fn("COUNT", "id", "n")).group_by("name")
          .having([Cond("n", ">", 1)]))
    assert [r.name for r in st.to_frame().collect()] == ["a"]
    d = Statement().from_(t).select(fld("name", distinct=True)).to_frame()
    assert d.count() == 3


def test_from_list_needs_equality(spark, t):
    other = spark.createDataFrame([(1, "p")], "k int, w string")
    st = Statement().from_(t, "a").from_(other, "b").select(fld("a.id"), fld("b.w"))
    with pytest.raises(ValueError):
        st.where([Cond("a.id", ">", 0)]).to_frame()
    out = st.where([Cond("a.id", "=", Field("b.k"))]).to_frame().collect()
    assert [(r.id, r.w) for r in out] == [(1, "p")]


def test_where_tree_precedence_property(spark):
    """Random where-trees select what Python selects under SQL precedence (AND before OR) and
    three-valued logic (a NULL comparison is not true)."""
    from hypothesis import given, settings, strategies as st

    rows = [(i, (i * 7) % 10 if i % 6 else None, (i * 3) % 10) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, a int, b int").cache()

    def val(op, x, y):
        if x is None or y is None:
            return None
        return {"<": x < y, ">": x > y, "=": x == y, "<>": x != y}[op]

    def and3(p, q):
        if p is False or q is False:
            return False
        return None if p is None or q is None else True

    def or3(p, q):
        if p is True or q is True:
            return True
        return None if p is None or q is None else False

    def ev(tree, r):
        items = tree if isinstance(tree, list) else [tree]
        row = {"a": r[1], "b": r[2]}
        def one(x):
            if isinstance(x, list):
                return ev(x, r)
            return val(x.op, row[x.field], row[x.rhs.name] if isinstance(x.rhs, Field) else x.rhs)
        result, run = False, one(items[0])
        for op, rhs in zip(items[1::2], items[2::2]):
            if op == "AND":
                run = and3(run, one(rhs))
            else:
                result, run = or3(result, run), one(rhs)
        return or3(result, run)

    cond = st.builds(Cond, st.sampled_from(["a", "b"]), st.sampled_from(["<", ">", "=", "<>"]),
                     st.one_of(st.integers(0, 9), st.just(Field("b")), st.just(Field("a"))))
    flat = st.lists(cond, min_size=1, max_size=4).flatmap(
        lambda cs: st.lists(st.sampled_from(["AND", "OR"]), min_size=len(cs) - 1, max_size=len(cs) - 1).map(
            lambda ops: [x for pair in zip(cs, ops + [None]) for x in pair if x is not None]))
    tree = st.one_of(flat, st.tuples(flat, st.sampled_from(["AND", "OR"]), flat).map(lambda t: t[0] + [t[1], t[2]]))

    @settings(max_examples=30, deadline=None)
    @given(tree)
    def check(t):
        got = sorted(r.id for r in df.filter(where(t)).select("id").collect())
        want = sorted(r[0] for r in rows if ev(t, r) is True)
        assert got == want, t

    check()


def test_having_on_functions_that_are_not_selected(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("b", 2), ("b", 2), ("c", 9)], "g string, v int")
    st = Statement().from_(df).select(fld("g")).group_by("g")
    keys = lambda tree: sorted(r.g for r in st.having(tree).to_frame().collect())
    assert keys(Cond(fn("COUNT", "*"), ">", 1)) == ["a", "b"]
    assert keys([Cond(fn("COUNT", "v", distinct=True), "=", 1), "AND", [Cond(fn("SUM", "v"), ">", 4), "OR", Cond("g", "=", "b")]]) == ["b", "c"]
    assert keys(Cond(fn("MAX", "v"), ">", fn("MIN", "v"))) == ["a"]
    assert st.having(Cond(fn("MAX", "v"), ">", 1)).to_frame().columns == ["g"]
    with pytest.raises(ValueError):
        fn("NOPE", "v")
    with pytest.raises(ValueError):
        fn("MEDIAN", "v", distinct=True)


def test_registered_aggregates(spark):
    from tessera.operators.statement import register_aggregate

    register_aggregate("span", lambda c: F.max(c) - F.min(c))
    df = spark.createDataFrame([("a", 1), ("a", 5), ("b", 2)], "g string, v int")
    rows = Statement().from_(df).select(fld("g"), fn("SPAN", "v", "w"), fn("median", "v", "m")).group_by("g").to_frame().collect()
    assert sorted(map(tuple, rows)) == [("a", 4, 3.0), ("b", 0, 2.0)]
