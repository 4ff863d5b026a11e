"""Dimension lookup-or-create, set-based.

The row-at-a-time "select id; insert if missing" becomes: group the candidate
rows by natural key keeping the first creator's attributes, anti-join against
the stored dimension, and number the new keys after the stored maximum in
order of first appearance.  The numbering cuts the new keys into ranges of
their order: each range is numbered by a window of its own and starts where
the ranges before it end, so no task sorts all keys.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagelens.session import scratch_path

#: New keys that one window numbers.
RANGE_ROWS = 1_000_000


def first_appearance(candidates: DataFrame, key: Column, key_name: str, order: Column,
                     attrs: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per natural key: first ordinal and the first creator's attributes."""
    attrs = dict(attrs or {})
    cols = [key.alias(key_name), order.alias("first_ord")] + [c.alias(n) for n, c in attrs.items()]
    base = candidates.select(*cols).filter(F.col(key_name).isNotNull())
    aggs = [F.min("first_ord").alias("first_ord")] + [F.min_by(n, "first_ord").alias(n) for n in attrs]
    return base.groupBy(key_name).agg(*aggs)


def new_members(firsts: DataFrame, stored: DataFrame, key_name: str, stored_key: str, id_name: str,
                max_id: int) -> DataFrame:
    """Keys not stored yet, numbered max_id + 1, + 2, ... by first appearance."""
    fresh = firsts.join(stored.select(F.col(stored_key).alias(key_name)), key_name, "left_anti")
    path = scratch_path(firsts.sparkSession, f"members-{uuid.uuid4().hex}")
    fresh.write.parquet(path)  # read several times below; the rows they come from are the whole payload
    return numbered(firsts.sparkSession.read.schema(fresh.schema).parquet(path), "first_ord", id_name, max_id)


def numbered(rows: DataFrame, order: str, id_name: str, after: int = 0, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rows with consecutive numbers after ``after``, by the (distinct) numbers of column ``order``."""
    n = rows.count()
    place = F.col(order).cast("double")  # keeps the order, up to equality, so a range's rows stay together
    bounds: list[float] = []
    if n > range_rows:
        k = -(-n // range_rows)
        found = rows.agg(F.percentile_approx(place, [i / k for i in range(1, k)], 100 * k)).first()[0]
        bounds = sorted(set(found))
    ranged = rows.withColumn("_range", F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < place)) if bounds else F.lit(0))
    starts = [after]
    if bounds:
        sizes = {r["_range"]: r["count"] for r in ranged.groupBy("_range").count().collect()}
        starts = list(accumulate((sizes.get(i, 0) for i in range(len(bounds))), initial=after))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(order))
    start = F.get(F.array(*(F.lit(x).cast("long") for x in starts)), F.col("_range"))
    return ranged.withColumn(id_name, within.cast("long") + start).drop("_range")


def max_id(stored: DataFrame, id_name: str, known_empty: bool = False) -> int:
    """Largest stored surrogate id (one scalar; 0 for an empty dimension)."""
    if known_empty:
        return 0
    row = stored.agg(F.max(id_name).alias("m")).first()
    return int(row["m"] or 0)
