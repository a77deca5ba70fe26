"""Declared types, text pieces, side tables and DML on typed tables."""

import pytest
from pyspark.sql import functions as F

from tessera.functions.predicate import Cond
from tessera.functions.types import (bool_from_storage, bool_to_storage, break_text, date_from_storage,
                                     date_to_storage, piece_count)
from tessera.operators import side
from tests.conftest import DATA

SPEC = side.TableSpec("docs", (("id", "TrieLong"), ("body", "Text"), ("tag", "Str")), "id")


def test_break_edges(spark):
    rows = [(n, "x" * n) for n in (0, 255, 256, 510, 600)]
    df = spark.createDataFrame(rows, "n int, t string")
    out = df.select("n", piece_count(F.col("t")).alias("k"), break_text(F.col("t")).alias("p")).collect()
    got = {r.n: (r.k, [len(x) for x in r.p]) for r in out}
    assert got == {0: (1, [0]), 255: (1, [255]), 256: (2, [255, 1]), 510: (2, [255, 255]),
                   600: (3, [255, 255, 90])}


def test_combine_of_break_is_identity(spark):
    texts = ["", "a", "é" * 700, "line\nbreak " * 80]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id long, body string, tag string")
    t = side.split(df, SPEC)
    back = side.select_recombined(t, ["id", "body"]).collect()
    assert [r.body for r in back] == texts


def test_bool_tokens(spark):
    df = spark.createDataFrame([("1",), ("t",), ("T",), ("true",), ("0",), ("f",), (None,)], "v string")
    got = [r[0] for r in df.select(bool_to_storage(F.col("v"))).collect()]
    assert got == [1, 1, 1, 0, 0, 0, 0]
    ints = spark.createDataFrame([(1,), (0,)], "v int").select(bool_to_storage(F.col("v"))).collect()
    assert [r[0] for r in ints] == [1, 0]
    back = spark.createDataFrame([(1,), (0,)], "v int").select(bool_from_storage(F.col("v"))).collect()
    assert [r[0] for r in back] == [1, 0]


def test_date_conversion_is_idempotent(spark):
    df = spark.createDataFrame([("2015-12-14T13:41:00Z",), ("2015-12-14 13:41:00",)], "v string")
    row = df.select(date_to_storage(F.col("v")).alias("s"),
                    date_to_storage(date_to_storage(F.col("v"))).alias("ss"),
                    date_from_storage(date_to_storage(F.col("v"))).alias("back"),
                    date_from_storage(date_from_storage(date_to_storage(F.col("v")))).alias("back2")).collect()
    for r in row:
        assert r.s == r.ss == "2015-12-14 13:41:00"
        assert r.back == r.back2 == "2015-12-14T13:41:00Z"


def test_table_spec_rules():
    with pytest.raises(ValueError):
        side.TableSpec("t", (("a", "Str"), ("a", "Str")), "a")
    with pytest.raises(ValueError):
        side.TableSpec("t", (("a", "Str"),), "b")
    with pytest.raises(ValueError):
        side.TableSpec("t", (("a", "Text"),), "a")
    with pytest.raises(ValueError):
        side.TableSpec("t", (("a", "Nope"),), "a")


def test_schema_xml():
    spec = side.TableSpec.from_schema_xml(open(f"{DATA}/schema.xml").read(), "articles")
    assert spec.pk == "title"
    assert dict(spec.fields) == {"title": "Str", "InfoBox": "Text", "Introduction": "Text", "_version_": "TrieLong"}
    assert spec.text_fields == ["InfoBox", "Introduction"]


def _table(spark):
    df = spark.createDataFrame([(1, "a" * 600, "x"), (2, "b" * 10, "y"), (3, "c" * 300, "x")],
                               "id long, body string, tag string")
    return side.split(df, SPEC)


def test_upsert_replaces_all_pieces(spark):
    t = _table(spark)
    src = spark.createDataFrame([(1, "short", "z"), (4, "d" * 256, "w")], "id long, body string, tag string")
    new = side.upsert(t, src)
    rows = {r.id: (r.body, r.tag) for r in side.select_recombined(new).collect()}
    assert rows == {1: ("short", "z"), 2: ("b" * 10, "y"), 3: ("c" * 300, "x"), 4: ("d" * 256, "w")}
    assert new.sides["body"].filter("id = 1").count() == 1
    again = side.upsert(new, src)
    assert sorted(side.select_recombined(again).collect()) == sorted(side.select_recombined(new).collect())


def test_upsert_last_by_order_wins(spark):
    t = _table(spark)
    src = spark.createDataFrame([(2, "old", "y", 1), (2, "new", "y", 2)], "id long, body string, tag string, v int")
    new = side.upsert(t, src, order_col="v")
    assert side.select_recombined(new, where=[Cond("id", "=", 2)]).collect()[0].body == "new"


def test_upsert_needs_every_field(spark):
    t = _table(spark)
    with pytest.raises(ValueError):
        side.upsert(t, spark.createDataFrame([(9, "z")], "id long, body string"))


def test_delete_cascades_and_partitions(spark):
    t = _table(spark)
    gone = side.delete(t, [Cond("tag", "=", "x")])
    assert sorted(r.id for r in gone.main.collect()) == [2]
    assert sorted({r.id for r in gone.sides["body"].collect()}) == [2]
    kept = side.delete(t, [Cond("tag", "<>", "x")])
    assert gone.main.count() + kept.main.count() == t.main.count()
    assert side.delete(t, None).sides["body"].count() == 0


def test_check_unique(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, name string")
    assert [r.name for r in side.check_unique(df, ["name"]).collect()] == ["a"]
    with pytest.raises(ValueError):
        side.assert_unique(df, ["name"])
    side.assert_unique(df, ["id"])


def test_write_and_read_split(spark, tmp_dir):
    t = _table(spark)
    side.write_split(t, f"{tmp_dir}/t", buckets=2)
    back = side.read_split(spark, SPEC, f"{tmp_dir}/t")
    assert sorted(side.select_recombined(back).collect()) == sorted(side.select_recombined(t).collect())


def test_bucketed_tables_recombine_without_shuffle(spark, tmp_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(i, ("t%d " % i) * (i * 7), "x" if i % 2 else "y") for i in range(40)]
        t = side.split(spark.createDataFrame(rows, "id long, body string, tag string"), SPEC)
        side.save_bucketed(t, "docs_bucketed", 4, mode="overwrite")
        b = side.load_bucketed(spark, SPEC, "docs_bucketed")
        out = side.select_recombined(b, ["id", "tag", "body"], order=False)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert sorted((r.id, r.body) for r in out.collect()) == sorted((i, b_) for i, b_, _ in rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS docs_bucketed")
        spark.sql("DROP TABLE IF EXISTS docs_bucketed__body")


def test_break_combine_property(spark):
    from hypothesis import given, settings, strategies as st

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.text(min_size=0, max_size=900), min_size=1, max_size=40))
    def check(texts):
        df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id long, body string, tag string")
        t = side.split(df, SPEC)
        counts = {r.id: r.n for r in t.sides["body"].groupBy("id").agg(F.count("*").alias("n")).collect()}
        assert all(counts[i] == max(1, -(-len(s) // 255)) for i, s in enumerate(texts))
        back = {r.id: r.body for r in side.select_recombined(t, ["id", "body"], order=False).collect()}
        assert [back[i] for i in range(len(texts))] == texts

    check()


def test_bool_storage_of_booleans_and_numbers(spark):
    from tessera.functions.types import bool_to_storage
    row = spark.sql("select true b, false f, 1 i, 2 j, 1.0D d, 't' s, 'true' w, cast(null as boolean) n").select(
        *[bool_to_storage(F.col(c)).alias(c) for c in "bfijdswn"]).first()
    assert list(row) == [1, 0, 1, 0, 1, 1, 0, 0]


def test_null_text_and_duplicate_source_keys(spark):
    from tessera.operators import side
    spec = side.TableSpec("d", (("id", "TrieLong"), ("body", "Text")), "id")
    t = side.split(spark.createDataFrame([(1, None), (2, ""), (3, "é" * 600)], "id long, body string"), spec)
    assert [tuple(r) for r in side.select_recombined(t).collect()] == [(1, None), (2, ""), (3, "é" * 600)]
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "id long, body string")
    with pytest.raises(Exception, match="several source rows"):
        side.upsert(t, twice).main.collect()


def test_breaking_a_long_text_takes_linear_time(spark):
    import time

    from tessera.functions.types import break_text

    def seconds(n):
        t0 = time.perf_counter()
        assert spark.range(1).select(F.size(break_text(F.repeat(F.lit("abcde"), F.lit(n // 5) + F.col("id").cast("int")))).alias("k")).first().k == -(-n // 255)
        return time.perf_counter() - t0

    seconds(100_000)
    small, large = seconds(500_000), seconds(4_000_000)
    assert large < 8 * max(small, 0.25) * 3                                    # eight times the text; a quadratic form takes 64 times
