"""Small helpers of the subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from wagelens.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written once as Parquet in the shared checkpoint folder and read back (a lineage cut that survives lost executors)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
