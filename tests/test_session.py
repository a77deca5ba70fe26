"""Spreading an input over the cluster never lowers the number of its splits."""

from pyspark.sql import functions as F

from tessera.session import input_splits, spread


def test_one_file_of_many_splits_keeps_them(spark, tmp_dir):
    path = f"{tmp_dir}/one"
    spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t")).coalesce(1).write.option(
        "parquet.block.size", 16 << 10).parquet(path)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        df = spark.read.parquet(path)
        assert len(df.inputFiles()) == 1 and input_splits(df) > 8
        assert spread(df, "id") is df
        assert input_splits(spread(df, "id", min_partitions=1000)) is None          # too few: one shuffle
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_few_splits_become_as_many_as_tasks_can_run(spark, tmp_dir):
    path = f"{tmp_dir}/few"
    spark.range(10).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    assert input_splits(df) == 1 and spread(df, "id", min_partitions=3).rdd.getNumPartitions() <= 3
    shuffled = df.repartition(2, "id")
    assert input_splits(shuffled) is None and spread(shuffled, "id") is shuffled
