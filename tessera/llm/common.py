"""Helpers shared by the training-data operators: inputs, the shared folder, files, range shards."""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir, ship_package

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``, with DuckDB SQL where SQL can express it."""
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh URI under the shared folder that the session names in ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: computed once, short
    lineage, and a lost executor costs a re-read only."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def python_ready(spark: SparkSession) -> None:
    """Ship this package to the Python workers (operators whose tasks run Python)."""
    ship_package(spark)


def open_fs(uri: str):
    """(file system, path) of a URI in the shared folder. Local paths are memory-mapped on read."""
    from pyarrow import fs as pafs

    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[len("file:"):]
    fs, path = pafs.FileSystem.from_uri(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        fs = pafs.LocalFileSystem(use_mmap=True)
    return fs, path


def range_shards(df: DataFrame, key: str, shards: int, out: str = "_shard", per_shard: int = 64,
                 keys: DataFrame | None = None) -> DataFrame:
    """``df`` dealt into ``shards`` ranges of the integer ``key`` (column ``out`` numbers them).

    The cut points come from a hash sample of the keys, about ``per_shard`` for each shard, so they
    depend on the rows alone, not on how Spark has split them: the same rows always give the same
    shards. The sample only places the cuts; every row is dealt. Null keys go to the first shard.
    ``keys`` is a cheaper frame to take the sample from (its first column), where ``df`` is a plan.
    """
    spark = df.sparkSession
    keys = (df.select(key) if keys is None else keys).toDF("k").select(F.col("k").cast("bigint")).where(F.col("k").isNotNull())
    n = keys.count()
    every = max(1, n // (shards * per_shard))
    sample = sorted(r[0] for r in keys.where(F.pmod(F.xxhash64("k"), F.lit(every)) == 0).distinct().collect())
    cuts = sorted({sample[len(sample) * i // shards] for i in range(1, shards)}) if sample else []
    number = F.lit(0)
    if cuts:
        number = _bisect(F.col(key).cast("bigint"), cuts, 0)
    return df.withColumn(out, F.coalesce(number, F.lit(0)).cast("int")).repartitionById(len(cuts) + 1, F.col(out))


def ranked(df: DataFrame, order: list[str], within: str | None = None, out: str = "rank", total: str = "of") -> DataFrame:
    """``df`` with each row's place (from 0, column ``out``) in the order of the columns ``order``, and how
    many there are (``total``); or both among the rows with its value of ``within``, which must then be
    the first of ``order`` and without nulls.

    Rows go through one range shuffle, so a value with most of the rows is many partitions; places
    are prefix sums over the partitions' counts. Rows that ``order`` does not tell apart have
    neighbouring places in any order. ``df`` should be a stored table: the ranges come from a sample.
    """
    at = F.monotonically_increasing_id()                     # partition << 33 | place in the partition
    dealt = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at), "ranked")
    dealt = dealt.withColumns({"_part": F.shiftright("_at", 33), "_place": F.col("_at").bitwiseAND((1 << 33) - 1)})
    keys = ["_part", within] if within else ["_part"]
    counts = written(dealt.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_place").alias("_first")), "counts")
    before = Window.partitionBy(*keys[1:]).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(*keys, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_base"),
                          F.sum("_n").over(Window.partitionBy(*keys[1:])).alias(total))
    return (dealt.join(bases, keys).withColumn(out, F.col("_base") + F.col("_place"))
            .drop("_at", "_part", "_place", "_base"))


def _bisect(col, cuts: list[int], base: int):
    """Number of cuts at or below ``col`` as nested CASE expressions of logarithmic depth."""
    if not cuts:
        return F.lit(base)
    mid = len(cuts) // 2
    return (F.when(col < F.lit(cuts[mid]), _bisect(col, cuts[:mid], base))
            .when(col >= F.lit(cuts[mid]), _bisect(col, cuts[mid + 1:], base + mid + 1)))
