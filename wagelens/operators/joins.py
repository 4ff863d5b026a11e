"""Join helpers: broadcast only behind a size check, shuffle join beyond it.

Without table statistics Spark estimates a join's size as the product of its
inputs, so a small dimension that is itself a join (supplier x nation) can look
larger than a fact table, and the planner may broadcast the fact side.  These
helpers decide explicitly:

* ``join_checked`` takes the size of the candidate side in bytes (rows times the width of its columns, texts by their
  measured length) and broadcasts it when that is at most ``BROADCAST_MAX_BYTES``; otherwise the join is a sort-merge
  join, by named keys a split one.
* ``join_split`` spreads a key that holds many rows of the big side over several tasks: its rows are dealt to as many
  splits as it has ``SPLIT_ROWS`` rows, and the small side's rows of that key are repeated for each split.
* ``join_fixed`` is for tables whose size is fixed by definition (the 25
  nations, 5 regions, 7 sources, 19 coordinates).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Far below an executor's memory, and below the 8 GB that Spark can broadcast.
BROADCAST_MAX_BYTES = 200_000_000
#: Rows of one key that one task of a split join works on.
SPLIT_ROWS = 1_000_000
#: Bytes of a text whose length is not measured, and of a value's place in a row.
TEXT_BYTES, SLOT_BYTES = 64, 8


def join_fixed(big: DataFrame, fixed: DataFrame, on, how: str = "inner") -> DataFrame:
    return big.join(F.broadcast(fixed), on, how)


def _texts(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "binary", "array", "map", "struct")]


def size_bytes(df: DataFrame) -> int:
    """Bytes of a frame's rows as Spark holds them: a slot for each value, and its texts."""
    texts = [F.octet_length(F.col(f"`{c}`").cast("string")) for c in _texts(df)]
    length = sum((F.coalesce(F.sum(x), F.lit(0)) for x in texts), F.lit(0))
    rows, texts_bytes = df.agg(F.count(F.lit(1)), length).first()
    return rows * SLOT_BYTES * (len(df.columns) + 1) + texts_bytes


def join_checked(big: DataFrame, small: DataFrame, on: Column | str | list, how: str = "inner",
                 max_bytes: int = BROADCAST_MAX_BYTES, bound: DataFrame | None = None) -> DataFrame:
    """``bound``: a frame with at least as many rows as ``small`` that is cheaper
    to count (the plain table under a join with fixed-size tables: a Parquet
    count reads file footers only); its texts are taken at ``TEXT_BYTES``."""
    if bound is not None:
        size = bound.count() * (SLOT_BYTES * (len(small.columns) + 1) + TEXT_BYTES * len(_texts(small)))
    else:
        size = size_bytes(small)
    if size <= max_bytes:
        return big.join(F.broadcast(small), on, how)
    if isinstance(on, Column) or how not in ("inner", "left"):
        return big.join(small.hint("merge"), on, how)
    return join_split(big, small, [on] if isinstance(on, str) else list(on), how)


def join_split(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner", split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Inner or left join by named keys in which no key is one task's work.

    The table of hot keys has at most rows / ``split_rows`` rows.  Which split a row goes to follows from its columns and
    its partition, so a task that is run again deals its rows as before, and equal rows of different partitions part.
    """
    hot = big.groupBy(*keys).count().filter(F.col("count") > split_rows).select(*keys, F.ceil(F.col("count") / split_rows).cast("int").alias("_splits"))
    splits = F.coalesce("_splits", F.lit(1))
    dealt = (big.withColumn("_row", F.xxhash64(*(F.col(f"`{c}`") for c in big.columns), F.spark_partition_id()))
             .join(F.broadcast(hot), list(keys), "left").withColumn("_split", F.pmod("_row", splits).cast("int")).drop("_row", "_splits"))
    repeated = small.join(F.broadcast(hot), list(keys), "left").withColumn("_split", F.explode(F.sequence(F.lit(0), splits - 1))).drop("_splits")
    return dealt.join(repeated.hint("merge"), [*keys, "_split"], how).drop("_split")
