"""M3: a test share of exactly ceil(fraction * n) rows, chosen by hash without a global sort.

The rows with the smallest md5 of their key are the test rows.  The boundary is found by selection: the rows are counted
by the first hex digits of their hash (at most 65,536 bins a round), the bin that holds the k-th smallest is taken, and
its rows are counted by the next digits, until one hash is left.  Rows that share the boundary's hash are told apart by
the hash of all their columns, and equal rows by number, so the share is exact whatever the ties, and one key may hold
any part of the rows.
"""

from __future__ import annotations

from fractions import Fraction
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits a round, and rows few enough for their hashes to be counted one by one.
DIGITS = 4
FEW = 1000


def _kth(hashed: DataFrame, column: str, k: int) -> tuple[str, int, int]:
    """The k-th smallest hash (k from 1), the rows below it and the rows that have it."""
    prefix, below = "", 0
    while True:
        rows = hashed.filter(F.col(column).startswith(prefix)) if prefix else hashed
        bins = rows.groupBy(F.substring(column, 1, len(prefix) + DIGITS).alias("bin")).count().collect()
        for bin_, n in sorted(bins):
            if below + n >= k:
                break
            below += n
        prefix = bin_
        if n <= FEW or len(prefix) >= 32:
            exact = hashed.filter(F.col(column).startswith(prefix)).groupBy(column).count().collect()
            for hash_, n in sorted(exact):
                if below + n >= k:
                    return hash_, below, n
                below += n


def with_exact_share(df: DataFrame, key: Column, fraction: float, flag: str = "en_test") -> DataFrame:
    """Adds ``flag``: true for exactly ceil(fraction * n) rows, those of the smallest md5 of ``key``."""
    share = Fraction(str(fraction))
    n = df.count()
    k = ceil(share * n)
    if k <= 0 or k >= n:
        return df.withColumn(flag, F.lit(k > 0))
    hashed = df.withColumn("_h", F.md5(key))
    last, below, ties = _kth(hashed, "_h", k)
    if below + ties == k:
        return hashed.withColumn(flag, F.col("_h") <= last).drop("_h")
    # The boundary's hash is shared: its rows are ordered by all their columns.
    tied = hashed.filter(F.col("_h") == last).withColumn("_row", F.md5(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})))
    row, before, equal = _kth(tied, "_row", k - below)
    parts = [hashed.filter(F.col("_h") != last).withColumn(flag, F.col("_h") < last),
             tied.filter(F.col("_row") != row).withColumn(flag, F.col("_row") < row)]
    # Equal in every column: which of them go is all one, so the copies are made anew with their flag.
    first = tied.filter(F.col("_row") == row).limit(1)
    wanted = k - below - before
    parts.append(first.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(equal)))).withColumn(flag, F.col("_copy") <= wanted))
    out = [p.select(*df.columns, flag) for p in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])
