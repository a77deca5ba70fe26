"""Incremental operators: only new files are processed; streamed upserts equal the batch upsert."""

import os

import pytest

from pyspark.sql import functions as F

from tessera.operators import side
from tessera.streaming import streams

SCHEMA = "id long, body string, tag string"
SPEC = side.TableSpec("docs", (("id", "TrieLong"), ("body", "Text"), ("tag", "Str")), "id")


def _write(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_ingest_processes_each_file_once(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    schema = spark.createDataFrame([], SCHEMA).schema
    _write(spark, [(1, "a", "x"), (2, "b", "y")], src)
    streams.ingest_new_files(spark, src, schema, out, ckpt)
    streams.ingest_new_files(spark, src, schema, out, ckpt)          # nothing new
    assert spark.read.parquet(out).count() == 2
    _write(spark, [(3, "c", "x")], src)                               # a new file arrives
    streams.ingest_new_files(spark, src, schema, out, ckpt)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_dedup_stream_remembers_across_runs(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    schema = spark.createDataFrame([], SCHEMA).schema
    _write(spark, [(1, "same", "x"), (2, "other", "y")], src)
    streams.dedup_stream(spark, src, schema, "body", out, ckpt)
    _write(spark, [(3, "same", "z"), (4, "new", "z")], src)
    streams.dedup_stream(spark, src, schema, "body", out, ckpt)
    assert sorted(r.body for r in spark.read.parquet(out).collect()) == ["new", "other", "same"]


def test_upsert_stream_equals_batch(spark, tmp_dir):
    src, root, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    schema = spark.createDataFrame([], SCHEMA).schema
    first = [(1, "x" * 600, "a"), (2, "y" * 10, "b")]
    second = [(1, "short", "c"), (3, "z" * 300, "skip")]
    _write(spark, first, src)
    streams.upsert_stream(spark, src, schema, SPEC, root, ckpt, keep=lambda b: b["tag"] != "skip")
    _write(spark, second, src)
    streams.upsert_stream(spark, src, schema, SPEC, root, ckpt, keep=lambda b: b["tag"] != "skip")
    got = sorted(tuple(r) for r in side.select_recombined(streams.read_table(spark, SPEC, schema, root)).collect())
    batch = side.upsert(side.split(spark.createDataFrame(first, SCHEMA), SPEC),
                        spark.createDataFrame(second, SCHEMA).filter(F.col("tag") != "skip"))
    want = sorted(tuple(r) for r in side.select_recombined(batch).collect())
    assert got == want == [(1, "short", "c"), (2, "y" * 10, "b")]
    assert len([d for d in os.listdir(root) if d.startswith("v")]) == 2


def test_upsert_stream_loses_nothing_when_the_listing_fails(spark, tmp_dir, monkeypatch):
    src, root, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    schema = spark.createDataFrame([], SCHEMA).schema
    _write(spark, [(1, "a", "x"), (2, "b", "y")], src)
    streams.upsert_stream(spark, src, schema, SPEC, root, ckpt)
    _write(spark, [(3, "c", "z")], src)
    real = streams.committed

    def broken(*a, **k):
        raise OSError("listing failed")

    monkeypatch.setattr(streams, "committed", broken)
    with pytest.raises(Exception, match="listing failed"):
        streams.upsert_stream(spark, src, schema, SPEC, root, ckpt)
    monkeypatch.setattr(streams, "committed", real)
    streams.upsert_stream(spark, src, schema, SPEC, root, ckpt)                # the batch is replayed
    got = side.select_recombined(streams.read_table(spark, SPEC, schema, root)).collect()
    assert sorted(tuple(r) for r in got) == [(1, "a", "x"), (2, "b", "y"), (3, "c", "z")]


def test_a_row_without_a_key_fails_its_batch_and_is_not_lost(spark, tmp_dir):
    src, root, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    schema = spark.createDataFrame([], SCHEMA).schema
    _write(spark, [(1, "a", "x"), (None, "b", "y")], src)
    with pytest.raises(Exception, match="without its key"):
        streams.upsert_stream(spark, src, schema, SPEC, root, ckpt)
    assert streams.committed(spark, root) == {}
    # a predicate may leave such rows out on purpose
    streams.upsert_stream(spark, src, schema, SPEC, root, f"{ckpt}2", keep=lambda b: b["id"].isNotNull())
    assert [r.id for r in streams.read_table(spark, SPEC, schema, root).main.collect()] == [1]


def test_a_seen_set_with_a_horizon_forgets_and_stays_small(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    schema = spark.createDataFrame([], "t timestamp, v string").schema

    def arrive(*rows):
        spark.createDataFrame([(f"2024-01-{day:02d} 00:00:00", v) for day, v in rows], "t string, v string").select(
            F.col("t").cast("timestamp").alias("t"), "v").coalesce(1).write.mode("append").parquet(src)
        return streams.dedup_stream_within(spark, src, schema, "v", "t", "2 days", out, ckpt)

    assert arrive((1, "a"), (1, "a"), (2, "b")) == 2
    arrive((3, "b"), (3, "c"))                                # b is remembered
    kept = arrive((9, "d"))                                   # the stream's time passes a, b and c
    arrive((10, "a"), (10, "d"))                              # a counts as new again, d does not
    got = sorted((r.t.day, r.v) for r in spark.read.parquet(out).collect())
    assert got == [(1, "a"), (2, "b"), (3, "c"), (9, "d"), (10, "a")]
    for day in range(11, 20):
        kept = arrive((day, f"x{day}"))
    assert kept <= 5                                          # two horizons of values, not all of them
    with pytest.raises(RuntimeError, match="late"):
        arrive((2, "too late"))
