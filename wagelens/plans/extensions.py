"""Outputs the reference's README describes but its code does not compute.

They are labelled extensions; each is a plain DataFrame plan over the same
star schema / gold layer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagelens import constants as C
from wagelens.operators import factorised as FZ
from wagelens.operators.dedup import first_wins
from wagelens.plans import gold as G
from wagelens.plans import ingest as I
from wagelens.plans import summaries as SM

WAGE_COST_WORD = "salarial"            # D3: "Coste salarial ..." kept, "Coste laboral ..." dropped
FULL_TIME_WORD = "completa"            # D4: "Jornada completa", "Completa"
TEMPORARY = "Temporal"                 # D4
TEMPORALITY = "Temporalidad"           # D4 indicator name
BOTH_SEXES = ["Ambos", "Ambos sexos", C.TOTAL]  # D1/D6: aggregate sex labels


def wage_share(parts: G.GoldParts) -> DataFrame:
    """Share (%) of the gold wage sum by sex, both-sexes rows excluded."""
    p = parts.where(~F.col("sexo").isin(BOTH_SEXES))
    b = FZ.blocks(p.wages, p.index, p.paro, [])
    by_sex = b.groupBy("sexo").agg(F.sum("sum_wage").alias("s"))
    total = F.sum("s").over(Window.partitionBy())  # at most a handful of sex labels
    return by_sex.select("sexo", (F.lit(100.0) * F.col("s") / total).alias("porcentaje"))


def wages_by_sector_dataset(parts: G.GoldParts, method: str = SM.FACTORISED) -> DataFrame:
    """Mean wage by sector over the gold relation (written by ``sources.export``)."""
    b = FZ.blocks(parts.wages, parts.index, parts.paro, ["sector_cnae"])
    return FZ.weighted_means(b, ["sector_cnae"]).select("sector_cnae", F.col("mean_wage").alias("salario_medio"))


def wage_cost_only(rows: DataFrame) -> DataFrame:
    """D3: load the labour-cost source keeping only its wage-cost measure.

    The measure label is parsed but never stored, so wage cost and labour cost
    compete for one key and the first wins.  Filtering on the parsed label
    before the load keeps wage cost only.  Returns the labour-cost-survey wage
    rows (sex defaulted to 'Ambos') with their names.  ``rows`` are parsed rows
    (``ingest.parse(...).rows``).
    """
    other_measure = ((F.col("code") == C.ETCL)
                     & ~F.lower(F.coalesce(F.col("meta_indicador"), F.lit(""))).contains(WAGE_COST_WORD))
    wages = rows.where((F.col("family") == C.WAGES) & F.col("has_datum") & F.col("valor").isNotNull() & ~other_measure)
    keys = ["fecha_iso", "indicador", "geografia", "sexo", "sector_cnae", "ocupacion_cno11"]
    # the natural keys stand for the ids, so no dimension is built
    firsts = first_wins(wages.select(*keys, "valor", "code", "ord"), keys, ["valor", "code"])
    return firsts.where(F.col("code") == C.ETCL).select("fecha_iso", "geografia", "sector_cnae", "valor")


def temporality_rate(star: I.Star) -> DataFrame:
    """Temporary / all full-time employees (%), by date, region and sex.

    All employees are the 'Total' contract row where there is one, else the sum
    of the contract types.
    """
    per = star.periodo.select("id_periodo", "fecha_iso")
    ind = F.broadcast(star.indicador.where(F.col("nombre") == TEMPORALITY).select("id_indicador"))
    geo = star.geografia.select("id_geografia", F.col("nombre").alias("geografia"))
    rows = (star.empleo.join(ind, "id_indicador")
            .where(F.lower("tipo_jornada").contains(FULL_TIME_WORD))
            .join(per, "id_periodo").join(geo, "id_geografia"))
    temp = F.sum(F.when(F.col("tipo_contrato") == TEMPORARY, F.col("valor")).otherwise(F.lit(0.0)))
    is_total = F.coalesce(F.col("tipo_contrato") == C.TOTAL, F.lit(False))
    stated, summed = F.sum(F.when(is_total, F.col("valor"))), F.sum(F.when(~is_total, F.col("valor")))
    out = rows.groupBy("fecha_iso", "geografia", "sexo").agg(temp.alias("t"), F.coalesce(stated, summed).alias("total"))
    return out.select("fecha_iso", "geografia", "sexo",
                      F.when(F.col("total") > 0, F.lit(100.0) * F.col("t") / F.col("total"))
                      .alias("tasa_temporalidad"))


def annual_change(star: I.Star) -> DataFrame:
    """Change (%) of every general price series against the same month a year before."""
    per = star.periodo.select("id_periodo", "fecha_iso")
    ind = F.broadcast(star.indicador.select("id_indicador", F.col("nombre").alias("indicador")))
    geo = star.geografia.select("id_geografia", F.col("nombre").alias("geografia"))
    rows = (star.precios.where(F.col("categoria_gasto") == C.GENERAL_CATEGORY)
            .join(per, "id_periodo").join(ind, "id_indicador").join(geo, "id_geografia")
            .select("indicador", "geografia", "fecha_iso", "valor"))
    w = Window.partitionBy("indicador", "geografia", F.month("fecha_iso")).orderBy("fecha_iso")
    prev_date = F.lag("fecha_iso").over(w)
    prev_val = F.lag("valor").over(w)
    change = F.when((F.year(prev_date) == F.year("fecha_iso") - 1) & (prev_val != 0),
                    F.lit(100.0) * (F.col("valor") / prev_val - 1))
    return rows.select("indicador", "geografia", "fecha_iso", "valor", change.alias("variacion_anual"))


def model_rows_without_aggregates(model_input: DataFrame) -> DataFrame:
    """Drop aggregate rows (national total, 'Total' sector, both sexes) before modelling."""
    return model_input.where((F.col("comunidad") != C.NATIONAL_TOTAL) & (F.col("sector_cnae") != C.TOTAL)
                             & ~F.col("sexo").isin(BOTH_SEXES))
