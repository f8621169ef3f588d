import os

from pyspark.sql import functions as F

from tabloom import runtime


def test_stored_tables_are_read_as_parquet_with_pruned_columns(spark):
    stored = runtime.store(spark.range(100).select("id", (F.col("id") * 2).alias("twice"), F.lit("x").alias("text")))
    plan = stored.filter("twice > 10").select("twice")._jdf.queryExecution().toString()
    assert "FileScan parquet" in plan and "ReadSchema: struct<twice:bigint>" in plan
    assert stored.count() == 100


def test_scratch_files_lie_below_the_shared_folder(spark):
    path = runtime.scratch_path(spark, "x")
    assert path.startswith(runtime.shared_folder(spark))
    assert os.path.isdir(os.path.dirname(path))


def test_size_of_nested_values_is_measured(spark):
    wide = spark.createDataFrame([(["x" * 100_000],)], "a array<string>")
    assert wide.select(runtime.row_bytes(wide)).first()[0] > 100_000


def test_small_tables_are_dealt_out_and_others_left_alone(spark):
    small = runtime.store(spark.range(1000).repartition(1).withColumn("text", F.lit("x")))
    assert small.rdd.getNumPartitions() == 1
    dealt = runtime.dealt(small, "id")
    assert dealt.rdd.getNumPartitions() > 1 and dealt.count() == 1000
    assert sorted(r["id"] for r in runtime.spread(small, "id").collect()) == list(range(1000))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100b")
    try:
        assert runtime.spread(small, "id") is small and runtime.dealt(small, "id") is small
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
