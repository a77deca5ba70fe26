"""Session construction and cluster-safety helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every query in this library is written against.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce shuffle output to the advisory size rather than to the core count (the setting
    # Spark recommends for shared clusters; on small shuffles it also means fewer tiny tasks)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's base configuration.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster leave them unset and let
    the deployment decide (AQE coalesces shuffle partitions at runtime either way).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. Only a local-mode session (tests, laptops) may
    fall back to a fresh temporary folder; on a cluster a machine-local folder would not survive the
    loss of an executor, so the setting is required there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh URI under the shared checkpoint folder for a written intermediate table."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_MATERIALIZED: dict[tuple[str, str], DataFrame] = {}


def clear_caches() -> None:
    """Forget stored collections and resolved inputs (after input files have changed)."""
    from tessera.plans import markup, registry, typed

    _MATERIALIZED.clear()
    registry._TABLES.clear()
    markup._STORED.clear()
    typed._STORED.clear()


def materialize(df, name: str, key: str | None = None, partition_cols: list[str] | None = None,
                spark: SparkSession | None = None, sort_cols: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    Used for derived tables that many plan branches read (e.g. the node table): the expensive
    producer runs once, lineage is cut (a lost executor re-reads files instead of recomputing),
    and readers get column pruning and filter pushdown from parquet. ``key`` memoises the path per
    application so a second request reuses the written table; ``df`` may then be a zero-argument
    callable so the producing plan is not even built again (pass ``spark`` in that case).
    """
    spark = spark or df.sparkSession
    memo = (spark.sparkContext.applicationId, key) if key else None
    if memo and memo in _MATERIALIZED:
        return _MATERIALIZED[memo]
    if callable(df):
        df = df()
    path = scratch_path(spark, name)
    if sort_cols:
        # clustered files: row-group statistics then let equality filters skip most row groups
        df = df.sortWithinPartitions(*sort_cols)
    w = df.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
    out = spark.read.parquet(path)
    if memo:
        _MATERIALIZED[memo] = out      # the written files never change: reuse the resolved frame
    return out


def input_splits(df: DataFrame) -> int | None:
    """Number of partitions in which ``df`` is read, or None where it comes out of a shuffle. The plan is
    only looked at: nothing runs."""
    executed = df._jdf.queryExecution().executedPlan()
    if executed.nodeName() == "AdaptiveSparkPlan":
        return None
    return executed.execute().getNumPartitions()


def spread(df: DataFrame, *keys: str, min_partitions: int | None = None) -> DataFrame:
    """Hash-partition ``df`` by ``keys`` when it is read in fewer splits than the cluster can run tasks at
    once; otherwise return it unchanged, so splits only ever become more. A frame that comes out of a
    shuffle is left as that has dealt it.

    Used in front of CPU-heavy per-row work (HTML parsing, tokenising, text breaking). On a large
    input, whether of many files or of a large one, this is a no-op; hashing by the key (not
    round-robin) keeps retries deterministic and lets a following aggregate on the same key reuse the
    partitioning.
    """
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    splits = input_splits(df)
    if splits is None or splits >= target:
        return df
    return df.repartition(target, *keys) if keys else df.repartition(target)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Materialise one step of an iteration to the shared folder and read it back: the step is
    computed once, lineage is cut, and a lost executor re-reads files instead of recomputing."""
    return materialize(df, name)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make the ``tessera`` package importable in Python workers (``addPyFile`` of a zip).

    Python code that runs inside tasks (the HTML tree builder) is pickled by reference to this
    package, so executors need it; Spark distributes the zip to every executor, once per context.
    """
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="tessera-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    _SHIPPED.add(app)
