import pytest
from pyspark.sql import functions as F

from workload import inputs


@pytest.fixture
def one_row_group(spark, tmp_path):
    folder = str(tmp_path / "orders.parquet")
    spark.range(20_000).select(F.col("id").alias("o_orderkey")).coalesce(1).write.parquet(folder)
    return folder


def _tasks_with_rows(df):
    return df.select(F.spark_partition_id().alias("task")).distinct().count()


def test_a_row_group_in_many_splits_is_dealt_over_all_cores(spark, one_row_group):
    small = {"spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "0"}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        df = spark.read.parquet(one_row_group)
        cores = spark.sparkContext.defaultParallelism
        assert df.rdd.getNumPartitions() >= cores
        assert _tasks_with_rows(inputs.spread(df, "orders")) >= cores
    finally:
        for name in small:
            spark.conf.unset(name)


def test_tasks_grow_with_the_table(spark, one_row_group, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    df = spark.read.parquet(one_row_group)
    assert inputs.spread(df, "orders").rdd.getNumPartitions() == cores
    monkeypatch.setattr(inputs, "TASK_BYTES", 1024)
    tasks = inputs.spread(df, "orders").rdd.getNumPartitions()
    assert tasks > 3 * cores and tasks == inputs.tasks_for(df)
