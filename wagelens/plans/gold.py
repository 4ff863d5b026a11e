"""Gold layer: star-schema reads, cleaning, general index, gold relation.

Readers S7-S11 join facts with their dimensions (small tables: the planner
broadcasts them; the indicator dimension is bounded by the 7-source registry).
The gold relation joins wages with the general price index on date and with
unemployment on date and sex: both joins are many-to-many on very few keys,
so ``GoldParts`` keeps the three cleaned sides apart and the summaries
aggregate them factorised (see ``operators.factorised``); the relation is only
materialised on request (export, checks).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagelens import constants as C
from wagelens import schemas as S
from wagelens.functions.filters import not_null_all, sex_code, year_from_text
from wagelens.functions.series import strip_ws
from wagelens.operators import factorised as FZ
from wagelens.operators.joins import BROADCAST_MAX_BYTES, join_checked
from wagelens.plans.ingest import Star


def _dated(facts: DataFrame, star: Star) -> DataFrame:
    """Facts with their date.  Stored facts lie in folders by year: the join takes the year along, so that a filter on the
    date prunes the folders (dynamic partition pruning) before anything is read."""
    if S.FACT_YEAR in facts.columns:
        per = star.periodo.select("id_periodo", "fecha_iso", F.col("anio").alias(S.FACT_YEAR))
        return facts.join(per, ["id_periodo", S.FACT_YEAR])
    return facts.join(star.periodo.select("id_periodo", "fecha_iso"), "id_periodo")


def _dims(star: Star):
    ind = F.broadcast(star.indicador.select("id_indicador", F.col("nombre").alias("_ind")))  # <= 7 rows
    geo = star.geografia.select("id_geografia", F.col("nombre").alias("_geo"))
    return ind, geo


def read_prices(star: Star) -> DataFrame:
    """valor_ipc, categoria_gasto, fecha_iso, indicador (no geography)."""
    ind, _ = _dims(star)
    return (_dated(star.precios, star).join(ind, "id_indicador")
            .select(F.col("valor").alias("valor_ipc"), "categoria_gasto", "fecha_iso",
                    F.col("_ind").alias("indicador")))


def read_wages(star: Star) -> DataFrame:
    """valor_salario, sexo, sector_cnae, ocupacion_cno11, fecha_iso, indicador_salario, comunidad."""
    ind, geo = _dims(star)
    return (_dated(star.salarios, star).join(ind, "id_indicador").join(geo, "id_geografia")
            .select(F.col("valor").alias("valor_salario"), "sexo", "sector_cnae", "ocupacion_cno11",
                    "fecha_iso", F.col("_ind").alias("indicador_salario"), F.col("_geo").alias("comunidad")))


def read_employment(star: Star) -> DataFrame:
    """valor_empleo, sexo, fecha_iso, indicador_empleo."""
    ind, _ = _dims(star)
    return (_dated(star.empleo, star).join(ind, "id_indicador")
            .select(F.col("valor").alias("valor_empleo"), "sexo", "fecha_iso",
                    F.col("_ind").alias("indicador_empleo")))


def model_input(star: Star) -> DataFrame:
    """Salario, sector_cnae, sexo, comunidad, fecha_iso (text), anio, sexo_num.

    Predicates as in the source query: sector not NULL, sex not 'Total' (which
    also drops NULL), date not NULL / not empty; then drop-nulls on all columns.
    """
    _, geo = _dims(star)
    fecha = F.date_format("fecha_iso", "yyyy-MM-dd")
    df = (_dated(star.salarios, star).join(geo, "id_geografia")
          .where(F.col("sector_cnae").isNotNull() & (F.col("sexo") != C.TOTAL)
                 & F.col("fecha_iso").isNotNull() & (fecha != ""))
          .select(F.col("valor").cast("double").alias("salario"), "sector_cnae", "sexo",
                  F.col("_geo").alias("comunidad"), fecha.alias("fecha_iso")))
    df = df.where(not_null_all(df.columns))
    return df.select("*", year_from_text(F.col("fecha_iso")).alias("anio"),
                     sex_code(F.col("sexo")).alias("sexo_num"))


def app_input(star: Star) -> DataFrame:
    """Salario, sector_cnae, sexo, comunidad, fecha_iso (text); sector not 'N/A', date not empty."""
    _, geo = _dims(star)
    fecha = F.date_format("fecha_iso", "yyyy-MM-dd")
    return (_dated(star.salarios, star).join(geo, "id_geografia")
            .where((F.col("sector_cnae") != C.NOT_AVAILABLE) & (fecha != ""))
            .select(F.col("valor").alias("salario"), "sector_cnae", "sexo",
                    F.col("_geo").alias("comunidad"), fecha.alias("fecha_iso")))


# ---------------------------------------------------------------- cleaning


def clean_prices(prices: DataFrame) -> DataFrame:
    return prices.where(not_null_all(prices.columns) & (F.col("valor_ipc") > 0))


def clean_wages(wages: DataFrame, strip_sector: bool = True) -> DataFrame:
    """Batch cleaning strips the sector; the dashboard variant does not."""
    if strip_sector:
        wages = wages.withColumn("sector_cnae", strip_ws(F.col("sector_cnae")))
    return wages.where(not_null_all(wages.columns) & (F.col("valor_salario") > 0))


def clean_employment(employment: DataFrame) -> DataFrame:
    return employment.where(not_null_all(employment.columns))


def general_index(prices_clean: DataFrame) -> DataFrame:
    """Q1: general category AND indicator containing 'Indice' (both price indicators)."""
    return prices_clean.where((F.col("categoria_gasto") == C.GENERAL_CATEGORY)
                              & F.col("indicador").contains(C.INDEX_WORD))


def unemployment(employment_clean: DataFrame) -> DataFrame:
    return employment_clean.where(F.col("indicador_empleo") == C.UNEMPLOYMENT)


@dataclass
class GoldParts:
    """The three cleaned sides of the gold relation, not yet joined."""
    wages: DataFrame      # cleaned wages (wage-side filters apply here)
    index: DataFrame      # general price index rows
    paro: DataFrame       # unemployment rows

    def where(self, cond: Column) -> "GoldParts":
        """Filter on wage-side columns (sexo, sector_cnae, comunidad, fecha_iso, ...).

        Every gold column except the index/unemployment values comes from the
        wage side, and fecha_iso/sexo are join keys, so the filter commutes
        with the joins.
        """
        return GoldParts(self.wages.where(cond), self.index, self.paro)

    def blocks(self, grain: Sequence[str]) -> DataFrame:
        """The fan-out's moments per (fecha_iso, sexo, *grain), the fan-out itself not being built."""
        return FZ.blocks(self.wages, self.index, self.paro, grain)

    def latest_index(self) -> DataFrame:
        """Q7: value of the last index row by date; ties broken by (indicador, valor_ipc) descending."""
        return self.index.agg(F.max(F.struct("fecha_iso", "indicador", "valor_ipc")).alias("l")).select(F.col("l.valor_ipc").alias("valor"))

    def relation(self, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
        """Q2: the materialised gold relation, 13 columns in source order.

        Both joins have very few distinct keys (dates, sexes), so a shuffle join
        would put a date's whole fan-out into one task.  The index and
        unemployment sides are broadcast after a check of their bytes instead:
        the fan-out is then produced map-side, spread like the wage side.
        Beyond the bound a date's wages are dealt to several tasks, each with
        the date's index and unemployment rows.
        """
        joined = join_checked(self.wages, self.index, "fecha_iso", max_bytes=max_bytes)
        joined = joined.withColumn("ratio_poder_adquisitivo", F.col("valor_salario") / F.col("valor_ipc"))
        joined = join_checked(joined, self.paro, ["fecha_iso", "sexo"], max_bytes=max_bytes)
        return joined.select(*S.GOLD_COLUMNS)


def gold_parts(star: Star, strip_sector: bool = True) -> GoldParts:
    prices = clean_prices(read_prices(star))
    wages = clean_wages(read_wages(star), strip_sector)
    paro = unemployment(clean_employment(read_employment(star)))
    return GoldParts(wages, general_index(prices), paro)
