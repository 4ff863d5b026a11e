"""Aggregates over the gold fan-out without materialising it.

The gold relation joins wages W with the index P on date, then with
unemployment E on (date, sex).  For one (date, sex) and one wage group g the
joined rows are every triple (w, p, e), so with per-side summaries

    n   = n_w * n_p * n_e
    sum of wage       = S_w * n_p * n_e
    sum of ratio      = S_w * S_q * n_e           (q = 1 / p)
    sum of unemployment = n_w * n_p * S_e
    max ratio         = max_w * max_q              (w, p > 0 after cleaning)

and the ratio variance of the block needs no subtraction of large numbers:
    Var(w q) = Vw Vq + Vw mq^2 + Vq mw^2          (population variances, >= 0)
Blocks are then combined with Chan's formula, M2 = sum M2_b + sum n_b (m_b - m)^2,
again a sum of non-negative terms.  Each side is reduced by a hash aggregate
with map-side partials before any join, so the joins run on summaries whose
size is bounded by dates x sexes x groups, whatever the fan-out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_GRAIN = ["sector_cnae", "comunidad"]


def wage_side(wages: DataFrame, grain: Sequence[str]) -> DataFrame:
    return wages.groupBy("fecha_iso", "sexo", *grain).agg(
        F.count(F.lit(1)).alias("n_w"),
        F.sum("valor_salario").alias("s_w"),
        F.avg("valor_salario").alias("m_w"),
        F.var_pop("valor_salario").alias("v_w"),
        F.max("valor_salario").alias("max_w"),
    )


def index_side(index: DataFrame) -> DataFrame:
    q = F.lit(1.0) / F.col("valor_ipc")
    return index.groupBy("fecha_iso").agg(
        F.count(F.lit(1)).alias("n_p"),
        F.sum(q).alias("s_q"),
        F.avg(q).alias("m_q"),
        F.var_pop(q).alias("v_q"),
        F.max(q).alias("max_q"),
    )


def unemployment_side(paro: DataFrame) -> DataFrame:
    return paro.groupBy("fecha_iso", "sexo").agg(
        F.count(F.lit(1)).alias("n_e"),
        F.sum("valor_empleo").alias("s_e"),
    )


def blocks(wages: DataFrame, index: DataFrame, paro: DataFrame,
           grain: Sequence[str] = BLOCK_GRAIN) -> DataFrame:
    """One row per (fecha_iso, sexo, *grain) with the block's fan-out moments."""
    return joined(wage_side(wages, grain), index_side(index), unemployment_side(paro), grain)


def joined(wage_moments: DataFrame, index_moments: DataFrame, paro_moments: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Blocks from the three sides' moments."""
    b = wage_moments.join(index_moments, "fecha_iso").join(paro_moments, ["fecha_iso", "sexo"])
    n_pe = F.col("n_p") * F.col("n_e")
    return b.select(
        "fecha_iso", "sexo", *grain,
        (F.col("n_w") * n_pe).alias("n"),
        (F.col("s_w") * n_pe).alias("sum_wage"),
        (F.col("s_w") * F.col("s_q") * F.col("n_e")).alias("sum_ratio"),
        (F.col("n_w") * F.col("n_p") * F.col("s_e")).alias("sum_unemployment"),
        (F.col("m_w") * F.col("m_q")).alias("mean_ratio_b"),
        (F.col("n_w") * n_pe * (F.col("v_w") * F.col("v_q")
                                + F.col("v_w") * F.col("m_q") * F.col("m_q")
                                + F.col("v_q") * F.col("m_w") * F.col("m_w"))).alias("m2_ratio_b"),
        (F.col("max_w") * F.col("max_q")).alias("max_ratio"),
    )


def merged(moments: DataFrame, keys: Sequence[str], suffix: str, value: str) -> DataFrame:
    """Moments n, s, m, v, max (named as a side's are) of several sets of rows added up per key, by Chan's formula."""
    n, s, m, v, top = (f"n_{suffix}", f"s_{value}", f"m_{value}", f"v_{value}", f"max_{value}")
    own = Window.partitionBy(*keys)
    dev = F.col(m) - F.sum(s).over(own) / F.sum(n).over(own)
    parts = moments.select(*keys, n, s, v, top, (F.col(n) * (F.col(v) + dev * dev)).alias("_m2"))
    return parts.groupBy(*keys).agg(F.sum(n).alias(n), F.sum(s).alias(s), (F.sum(s) / F.sum(n)).alias(m), (F.sum("_m2") / F.sum(n)).alias(v), F.max(top).alias(top))


def weighted_means(block_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fan-out-weighted means per key: n, mean wage, mean ratio, mean unemployment."""
    return block_df.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        (F.sum("sum_wage") / F.sum("n")).alias("mean_wage"),
        (F.sum("sum_ratio") / F.sum("n")).alias("mean_ratio"),
        (F.sum("sum_unemployment") / F.sum("n")).alias("mean_unemployment"),
    )


def ratio_moments(block_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: n, mean, max and sample std of the ratio over the fan-out."""
    w = Window.partitionBy(*keys)
    n_total = F.sum("n").over(w)
    mean = F.sum("sum_ratio").over(w) / n_total
    with_mean = block_df.select(*keys, "n", "sum_ratio", "m2_ratio_b", "max_ratio", "mean_ratio_b",
                                mean.alias("_mean"))
    dev = F.col("mean_ratio_b") - F.col("_mean")
    agg = with_mean.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        (F.sum("sum_ratio") / F.sum("n")).alias("media"),
        F.max("max_ratio").alias("max"),
        (F.sum("m2_ratio_b") + F.sum(F.col("n") * dev * dev)).alias("_m2"),
    )
    std = F.when(F.col("n") > 1, F.sqrt(F.col("_m2") / (F.col("n") - 1)))
    return agg.select(*keys, "n", "media", "max", std.alias("std"))
