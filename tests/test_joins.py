"""Joins beyond the broadcast bound: the same rows, and no task with a key of its own."""

import statistics

import pytest
from pyspark.sql import functions as F

from wagelens import contract
from wagelens.operators import joins as J

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sides(spark):
    # a third of the rows under one key, some of them equal, and null keys
    big = spark.range(12_000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 97 == 1, F.lit(None)).otherwise(F.col("id") % 40).cast("int").alias("k"),
                                     (F.col("id") % 2000).alias("v")).repartition(6)
    small = spark.range(90).select((F.col("id") % 45).cast("int").alias("k"), F.concat(F.lit("t"), "id").alias("t"))
    return big, small


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("split_rows", [50, 1_000_000])
def test_split_join_gives_the_same_rows(sides, how, split_rows):
    big, small = sides
    got = sorted(map(tuple, J.join_split(big, small, ["k"], how, split_rows).select("k", "v", "t").collect()), key=str)
    assert got == sorted(map(tuple, big.join(small, "k", how).select("k", "v", "t").collect()), key=str)


def test_split_join_has_no_hot_task(spark, sides):
    big, small = sides
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in J.join_split(big, small, ["k"], split_rows=50).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 8 and max(sizes) <= 2 * statistics.median(sizes)


def test_relation_without_any_broadcast_of_its_sides(spark):
    parts = contract.parts(spark, SF)
    plain, split = parts.relation(), parts.relation(max_bytes=0)
    key = [F.count("*"), F.sum(F.xxhash64(*[F.round(c, 6) if t == "double" else F.col(c) for c, t in plain.dtypes]) % 1_000_003)]
    assert split.columns == plain.columns and split.agg(*key).first() == plain.agg(*key).first()
    assert "SortMergeJoin" in split._jdf.queryExecution().executedPlan().toString()


def test_sizes_are_in_bytes(spark):
    df = spark.createDataFrame([("x" * 1000, 1), (None, 2)], "t string, n int")
    assert J.size_bytes(df) == 2 * 8 * 3 + 1000 and J.size_bytes(df.limit(0)) == 0
