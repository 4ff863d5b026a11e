"""Dashboard / app summaries (Q3-Q10) over the gold layer.

Every summary over the gold relation is computed factorised by default
(``method="factorised"``): per-side aggregates, joined on (date, sex), then
combined.  ``method="materialised"`` aggregates the joined relation itself and
is kept as the checked reference; both give the same numbers up to rounding.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagelens import constants as C
from wagelens.functions.filters import eq_unless_all, isin_unless_all, kpi_format
from wagelens.operators import factorised as FZ
from wagelens.plans.gold import GoldParts

FACTORISED, MATERIALISED = "factorised", "materialised"


def _check(method: str) -> None:
    if method not in (FACTORISED, MATERIALISED):
        raise ValueError(f"method must be {FACTORISED!r} or {MATERIALISED!r}, not {method!r}")


def coordinates(spark: SparkSession) -> DataFrame:
    schema = T.StructType([T.StructField("comunidad", T.StringType()), T.StructField("lat", T.DoubleType()),
                           T.StructField("lon", T.DoubleType())])
    return spark.createDataFrame([(k, lat, lon) for k, (lat, lon) in C.COORDINATES.items()], schema)


# ------------------------------------------------------------------ Q3


def price_chart(index: DataFrame) -> DataFrame:
    """One point per date; ties (several index rows per date) keep the smallest
    (indicador, valor_ipc): the reference leaves that order unspecified."""
    first = F.min(F.struct("indicador", "valor_ipc", "categoria_gasto")).alias("p")
    return (index.groupBy("fecha_iso").agg(first)
            .select("fecha_iso", "p.valor_ipc", "p.categoria_gasto", "p.indicador")
            .orderBy("fecha_iso"))


def price_series(index: DataFrame, years: Iterable | None = None) -> DataFrame:
    """Dashboard form of the price chart: every index row of the chosen years, sorted by date (not deduplicated)."""
    return (index.where(isin_unless_all(F.year("fecha_iso"), years))
            .select("valor_ipc", "categoria_gasto", "fecha_iso", "indicador").orderBy("fecha_iso", "indicador", "valor_ipc"))


# ------------------------------------------------------------------ Q9


def ratio_stats(parts: GoldParts, method: str = FACTORISED) -> DataFrame:
    """Flagship: mean, max and sample std of the purchasing-power ratio by sector and sex."""
    _check(method)
    keys = ["sector_cnae", "sexo"]
    if method == MATERIALISED:
        r = F.col("ratio_poder_adquisitivo")
        return parts.relation().groupBy(*keys).agg(
            F.avg(r).alias("media"), F.max(r).alias("max"), F.stddev_samp(r).alias("std"))
    b = parts.blocks(keys)
    return FZ.ratio_moments(b, keys).select(*keys, "media", "max", "std")


# ------------------------------------------------------------------ Q4


def wage_trend_region(parts: GoldParts, years: Iterable | None = None, regions: Iterable | None = None,
                      method: str = FACTORISED) -> DataFrame:
    """Mean wage by date and region, national total excluded; year/region filters."""
    _check(method)
    p = parts.where((F.col("comunidad") != C.NATIONAL_TOTAL)
                    & isin_unless_all(F.year("fecha_iso"), years)
                    & isin_unless_all(F.col("comunidad"), regions))
    keys = ["fecha_iso", "comunidad"]
    if method == MATERIALISED:
        out = p.relation().groupBy(*keys).agg(F.avg("valor_salario").alias("valor_salario"))
    else:
        b = p.blocks(["comunidad"])
        out = FZ.weighted_means(b, keys).select(*keys, F.col("mean_wage").alias("valor_salario"))
    return out.orderBy("fecha_iso", "comunidad")


# ------------------------------------------------------------------ Q5


def purchasing_power_rank(parts: GoldParts, years: Iterable | None = None, sexes: Iterable | None = None,
                          sectors: Iterable | None = None, method: str = FACTORISED) -> DataFrame:
    """Mean ratio by sector and sex, 'Total'/'N/A' sectors excluded, descending."""
    _check(method)
    p = parts.where((F.col("sector_cnae") != C.TOTAL) & (F.col("sector_cnae") != C.NOT_AVAILABLE)
                    & isin_unless_all(F.year("fecha_iso"), years)
                    & isin_unless_all(F.col("sexo"), sexes)
                    & isin_unless_all(F.col("sector_cnae"), sectors))
    keys = ["sector_cnae", "sexo"]
    if method == MATERIALISED:
        out = p.relation().groupBy(*keys).agg(F.avg("ratio_poder_adquisitivo").alias("ratio_poder_adquisitivo"))
    else:
        b = p.blocks(keys)
        out = FZ.weighted_means(b, keys).select(*keys, F.col("mean_ratio").alias("ratio_poder_adquisitivo"))
    return out.orderBy(F.desc("ratio_poder_adquisitivo"), "sector_cnae", "sexo")


# ------------------------------------------------------------------ Q6


def region_summary(parts: GoldParts, method: str = FACTORISED) -> DataFrame:
    """Mean wage and mean ratio by region, national total excluded."""
    _check(method)
    p = parts.where(F.col("comunidad") != C.NATIONAL_TOTAL)
    if method == MATERIALISED:
        return p.relation().groupBy("comunidad").agg(
            F.avg("valor_salario").alias("salario_medio"),
            F.avg("ratio_poder_adquisitivo").alias("poder_adquisitivo"))
    b = p.blocks(["comunidad"])
    return FZ.weighted_means(b, ["comunidad"]).select(
        "comunidad", F.col("mean_wage").alias("salario_medio"), F.col("mean_ratio").alias("poder_adquisitivo"))


def region_map(parts: GoldParts, method: str = FACTORISED) -> DataFrame:
    """Region summary with coordinates; regions without a coordinate are dropped."""
    summary = region_summary(parts, method)
    coords = F.broadcast(coordinates(summary.sparkSession))  # fixed 19 rows
    return summary.join(coords, "comunidad").select("comunidad", "salario_medio", "poder_adquisitivo",
                                                     "lat", "lon")


# ------------------------------------------------------------------ Q7


def dashboard_kpis(parts: GoldParts, method: str = FACTORISED) -> DataFrame:
    """Long form (kpi, valor, texto): latest index, mean wage, mean unemployment."""
    _check(method)
    if method == MATERIALISED:
        means = parts.relation().agg(F.avg("valor_salario").alias("w"), F.avg("valor_empleo").alias("e"))
    else:
        b = parts.blocks([])
        means = b.agg((F.sum("sum_wage") / F.sum("n")).alias("w"),
                      (F.sum("sum_unemployment") / F.sum("n")).alias("e"))
    kpis = (parts.latest_index().select(F.lit("ipc_actual").alias("kpi"), "valor")
            .unionByName(means.selectExpr("stack(2, 'salario_medio', w, 'paro_medio', e) AS (kpi, valor)")))
    wage = F.col("kpi") == "salario_medio"  # only the wage is shown with thousands separators
    return kpis.withColumn("texto", F.when(wage, kpi_format(F.col("valor"), 2))
                           .otherwise(F.format_string("%.2f", F.col("valor"))))


# ------------------------------------------------------------------ Q8, Q10 (app)


def app_filter(app: DataFrame, region=C.ALL_REGIONS) -> DataFrame:
    return app.where(eq_unless_all(F.col("comunidad"), region))


def app_kpis(app: DataFrame, region=C.ALL_REGIONS) -> DataFrame:
    """Mean wage and sample size of the (region-filtered) app input."""
    return app_filter(app, region).agg(F.avg("salario").alias("salario_medio"),
                                       F.count(F.lit(1)).alias("muestra"))


def wage_by_sector(app: DataFrame, region=C.ALL_REGIONS) -> DataFrame:
    return (app_filter(app, region).groupBy("sector_cnae").agg(F.avg("salario").alias("salario"))
            .orderBy("salario", "sector_cnae"))


def gender_gap(app: DataFrame, region=C.ALL_REGIONS) -> DataFrame:
    return (app_filter(app, region).where(F.col("sexo") != C.TOTAL)
            .groupBy("sector_cnae", "sexo").agg(F.avg("salario").alias("salario")))


PREVIEW_ROWS = 100
APP_ORDER = ["fecha_iso", "comunidad", "sector_cnae", "sexo", "salario"]


def master_preview(app: DataFrame, region=C.ALL_REGIONS, rows: int = PREVIEW_ROWS) -> DataFrame:
    """K4: first rows of the (region-filtered) master set.  The source shows an
    unordered head; a total order makes it deterministic (top-k, no global sort)."""
    return app_filter(app, region).orderBy(*APP_ORDER).limit(rows)


# ------------------------------------------------------------------ A10


def distinct_filters(parts: GoldParts, app: DataFrame) -> DataFrame:
    """Sorted option lists of the dashboard/app selectors, long form (filtro, valor)."""
    gold_keys = parts.blocks(["sector_cnae", "comunidad"]) \
        .select("fecha_iso", "sector_cnae", "comunidad").distinct()
    def option(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("filtro"), value.cast("string").alias("valor"))

    def options(df: DataFrame, *pairs: Column) -> DataFrame:
        """All lists of one frame in one pass; options that don't apply are NULL."""
        return df.select(F.explode(F.array(*pairs)).alias("o")).where(F.col("o").isNotNull()).select("o.filtro", "o.valor")

    sector = F.col("sector_cnae")
    gold = options(gold_keys, option("anio_salario", F.year("fecha_iso")),
                   F.when(F.col("comunidad") != C.NATIONAL_TOTAL, option("comunidad", F.col("comunidad"))),
                   F.when((sector != C.TOTAL) & (sector != C.NOT_AVAILABLE), option("sector", sector)))
    index = options(parts.index, option("anio_ipc", F.year("fecha_iso")))
    own = options(app, option("comunidad_app", F.col("comunidad")), option("sector_app", sector), option("sexo_app", F.col("sexo")))
    return gold.unionByName(index).unionByName(own).distinct().orderBy("filtro", "valor")
