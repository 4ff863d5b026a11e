"""First-row-wins loading (insert-or-ignore semantics) as set operations.

Insert-or-ignore keeps, for every unique key, the first row in load order and
skips rows whose key is already stored.  Two details decide correctness:

* NULL key parts never conflict: a row with a NULL in any key column is always
  inserted (SQL UNIQUE treats NULLs as distinct).  Such rows bypass the
  aggregate, and the anti-join uses plain equality, which never matches NULL.
* "First" is the packed BIGINT load ordinal, so ``min_by(value, ord)`` stays a
  hash aggregate with map-side partial aggregation: a hot key (one series or
  period holding a third of the rows) is reduced on every mapper before the
  shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def any_null(columns: Sequence[str]) -> Column:
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.col(c).isNull()
    return cond


def first_wins(rows: DataFrame, keys: Sequence[str], values: Sequence[str], order: str = "ord",
               null_keys_conflict: bool = False) -> DataFrame:
    """Keep the first row (smallest ``order``) per key.

    ``null_keys_conflict=True`` is the opt-in corrected behaviour: NULL key
    parts compare equal (rows are grouped with NULLs as a value).
    """
    aggs = [F.min_by(v, order).alias(v) for v in values] + [F.min(order).alias(order)]
    if null_keys_conflict:
        return rows.groupBy(*keys).agg(*aggs)
    nullish = any_null(keys)
    keyed = rows.filter(~nullish).groupBy(*keys).agg(*aggs)
    loose = rows.filter(nullish).select(*keys, *values, order)
    return keyed.unionByName(loose)


def insert_or_ignore(new_rows: DataFrame, stored: DataFrame, keys: Sequence[str],
                     null_keys_conflict: bool = False) -> DataFrame:
    """Rows of ``new_rows`` whose key is not stored yet (NULL parts never match)."""
    stored_keys = stored.select(*keys)
    if null_keys_conflict:
        cond = None
        for k in keys:
            c = new_rows[k].eqNullSafe(stored_keys[k])
            cond = c if cond is None else cond & c
        return new_rows.join(stored_keys, cond, "left_anti")
    return new_rows.join(stored_keys, list(keys), "left_anti")
