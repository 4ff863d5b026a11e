"""Exports (S12-S16): CSV / Parquet datasets, read-back and the size report.

Outputs are folders of part files written by the executors (no single-file
funnel through the driver); sizes are summed from the file listing, without
opening a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Header CSV; dates as ISO text."""
    df.write.mode(mode).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """S13."""
    df.write.mode(mode).parquet(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV read back with an explicit schema (no inference pass)."""
    return spark.read.schema(schema).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def folder_bytes(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """Total bytes of the data files of an output folder (one row); only names and lengths are read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", f"*.{fmt}").option("recursiveFileLookup", True)
             .load(path).select("path", "length"))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("bytes"))


def format_sizes(spark: SparkSession, csv_path: str, parquet_path: str) -> DataFrame:
    """KB per format and the share saved by Parquet (NULL when the CSV is empty)."""
    c = folder_bytes(spark, csv_path, "csv").select(F.lit("csv").alias("formato"), "bytes")
    p = folder_bytes(spark, parquet_path, "parquet").select(F.lit("parquet").alias("formato"), "bytes")
    sizes = c.unionByName(p)
    csv_bytes = F.max(F.when(F.col("formato") == "csv", F.col("bytes"))).over(Window.partitionBy())  # two rows
    return sizes.select(
        "formato", (F.col("bytes") / 1024.0).alias("kb"),
        F.when(csv_bytes > 0, (1 - F.col("bytes") / csv_bytes) * 100).alias("ahorro_pct"))
