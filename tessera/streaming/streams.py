"""Incremental operators as Structured Streaming queries.

* :func:`dedup_stream` keeps a seen-set of 128-bit value hashes in the state store across runs.
* :func:`dedup_stream_within` forgets values after a stated horizon, so its state does not grow for ever.
* :func:`ingest_new_files` processes only files not seen by an earlier run (file source + checkpoint).
* :func:`upsert_stream` applies each micro-batch to a stored split table with ``foreachBatch``; only the
  key buckets that the batch touches are rewritten.

All of them run with ``Trigger.AvailableNow`` (process what is there, then stop); the checkpoint
folder makes a rerun continue where the last one stopped, and a lost executor only replays the
current micro-batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import side

BUCKETS = 64


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Parquet file stream over a directory; ``dir/name.parquet`` streams only files named so."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if path.endswith(".parquet"):
        folder, _, name = path.rstrip("/").rpartition("/")
        return r.option("pathGlobFilter", name).parquet(folder)
    return r.parquet(path)


def _run(writer) -> None:
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def dedup_stream(spark: SparkSession, src: str, schema: T.StructType, value_col: str, out: str, ckpt: str) -> None:
    """Append each value the first time its two 64-bit hashes are seen (state kept in ``ckpt``)."""
    s = file_stream(spark, src, schema).withColumns(
        {"h": F.xxhash64(F.col(value_col)), "h2": F.xxhash64(F.lit("tessera"), F.col(value_col))})
    dedup = s.dropDuplicates(["h", "h2"])
    _run(dedup.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .outputMode("append"))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def dedup_stream_within(spark: SparkSession, src: str, schema: T.StructType, value_col: str, time_col: str, horizon: str,
                        out: str, ckpt: str, max_files: int | None = None) -> int:
    """As :func:`dedup_stream`, but a value is remembered only until the stream's time (its latest ``time_col`` less
    ``horizon``) has passed its own time by ``horizon``: then it counts as new again. Returns the number of
    remembered values.

    The state holds the hashes of about two horizons of values, whatever the stream's length, on the executors' disks
    (RocksDB) rather than in their heaps. Rows that are more than ``horizon`` late for the stream's time cannot
    be held against a state that has forgotten their time: they fail the run instead of being dropped unseen, unless
    the caller has filtered them out.
    """
    s = file_stream(spark, src, schema, max_files).withColumns(
        {"h": F.xxhash64(F.col(value_col)), "h2": F.xxhash64(F.lit("tessera"), F.col(value_col))})
    fresh = s.withWatermark(time_col, horizon).dropDuplicatesWithinWatermark(["h", "h2"])
    provider = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(provider, None)
    spark.conf.set(provider, ROCKSDB)
    try:
        q = (fresh.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).outputMode("append")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.unset(provider) if old is None else spark.conf.set(provider, old)
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    states = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    late = sum(st["numRowsDroppedByWatermark"] for st in states)
    if late:
        raise RuntimeError(f"{late} rows came more than {horizon} late")
    return states[-1]["numRowsTotal"] if states else 0


def ingest_new_files(spark: SparkSession, src: str, schema: T.StructType, out: str, ckpt: str) -> None:
    """Copy rows of files not processed before into ``out`` (exactly once across reruns)."""
    s = file_stream(spark, src, schema).withColumn("ingest_file", F.col("_metadata.file_path"))
    _run(s.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).outputMode("append"))


def committed(spark: SparkSession, table_root: str, before: int | None = None) -> dict[int, int]:
    """Bucket -> version holding its rows, from the newest commit (older than ``before``, if given).

    Each version writes its manifest after all its data, as (epoch, bucket, version) rows; a manifest names all
    buckets, so only the newest is read, however many commits there have been. Only a missing commit folder means
    that nothing is there; any other error goes to the caller.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{table_root}/commits")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return {}
    # a manifest counts once its job has ended
    epochs = [int(st.getPath().getName()) for st in fs.listStatus(path) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))]
    last = max((e for e in epochs if before is None or e < before), default=None)
    if last is None:
        return {}
    rows = spark.read.schema("epoch int, bucket int, version int").json(f"{table_root}/commits/{last:06d}")
    return {r.bucket: r.version for r in rows.collect()}


def _read_buckets(spark: SparkSession, spec: side.TableSpec, table_root: str, where: dict[int, int],
                  empty: side.SplitTable) -> side.SplitTable:
    """The split table of some buckets (an empty one for none)."""
    def frame(name: str, like: DataFrame) -> DataFrame:
        paths = [f"{table_root}/v{v:06d}/{name}/bucket={b}" for b, v in sorted(where.items())]
        return spark.read.schema(like.schema).parquet(*paths).filter(F.col(spec.pk).isNotNull()) if paths else like

    return side.SplitTable(spec, frame("main", empty.main), {f: frame(f"side_{f}", s) for f, s in empty.sides.items()})


def read_table(spark: SparkSession, spec: side.TableSpec, schema: T.StructType, table_root: str) -> side.SplitTable:
    """The newest committed state of a table that :func:`upsert_stream` keeps."""
    return _read_buckets(spark, spec, table_root, committed(spark, table_root), side.split(spark.createDataFrame([], schema), spec))


def upsert_stream(spark: SparkSession, src: str, schema: T.StructType, spec: side.TableSpec, table_root: str,
                  ckpt: str, keep=None, order_col: str | None = None, buckets: int = BUCKETS) -> None:
    """Upsert every micro-batch (filtered by ``keep``) into the split table under ``table_root``.

    Rows live in ``buckets`` hash buckets of the key. Batch ``e`` reads the buckets it touches as of the
    newest commit before ``e``, writes them to the version folder ``v{e}`` and then commits the manifest
    of all buckets; a batch that dies half way leaves no commit, and its replay writes the same folder
    again. Every bucket of a version exists, also when it holds no rows of a side table. A kept row without
    a key fails its batch: it could be found and replaced by nothing.
    """
    bucket: Column = F.pmod(F.xxhash64(spec.pk), F.lit(buckets)).cast("int")
    empty = side.split(spark.createDataFrame([], schema), spec)

    def apply(batch: DataFrame, epoch: int) -> None:
        b = batch.filter(keep(batch)) if keep is not None else batch
        keyed = F.when(F.col(spec.pk).isNull(), F.raise_error(F.lit(f"a row without its key {spec.pk}"))).otherwise(F.col(spec.pk))
        b = b.withColumn(spec.pk, keyed)
        held = committed(spark, table_root, before=epoch)
        touched = sorted(r[0] for r in b.select(bucket).distinct().collect())
        cur = _read_buckets(spark, spec, table_root, {k: held[k] for k in touched if k in held}, empty)
        new = side.upsert(cur, b, order_col)
        # a row of nulls for each touched bucket makes its folder; readers drop it by the null key
        marks = spark.createDataFrame([(k,) for k in touched], "bucket int")
        for name, df in (("main", new.main), *((f"side_{f}", s) for f, s in new.sides.items())):
            rows = df.filter(F.col(spec.pk).isNotNull()).withColumn("bucket", bucket).unionByName(marks, allowMissingColumns=True)
            rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{table_root}/v{epoch:06d}/{name}")
        manifest = held | {k: epoch for k in touched}
        rows = spark.createDataFrame([(epoch, k, v) for k, v in manifest.items()], "epoch int, bucket int, version int")
        rows.coalesce(1).write.mode("overwrite").json(f"{table_root}/commits/{epoch:06d}")

    s = file_stream(spark, src, schema)
    _run(s.writeStream.foreachBatch(apply).option("checkpointLocation", ckpt))
