"""Named queries over the driver tables (the contract of ``__spark_entry__``).

Every query reads the driver tables of ``sf_dir`` and runs the whole chain:
driver tables -> statistics payload -> parsed rows -> star schema -> gold
layer -> summary.  Computed doubles are rounded to ``DECIMALS`` places so that
the DuckDB oracle (``wagelens.oracle``), which sums in another order, hashes
alike.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagelens import constants as C
from wagelens import schemas as S
from wagelens.plans import extensions as X
from wagelens.plans import gold as G
from wagelens.plans import ingest as I
from wagelens.plans import summaries as SM
from wagelens.sources import driver_tables as D
from wagelens.session import scratch_path, session_key
from wagelens.sources import export as E
from wagelens.sources import landing as L
from wagelens.sources.warehouse import LoadReport, Warehouse
from wagelens.streaming.gold_view import GoldView

DECIMALS = 4

# Filter selections of the filtered dashboard views (feature parameters).
TREND_YEARS = [1996, 1998, 2000]
TREND_REGIONS = ["Andalucía", "Cataluña", "Galicia", "Madrid, Comunidad de"]
RANK_YEARS = [1997, 1999]
RANK_SEXES = ["Hombres", "Mujeres"]
RANK_SECTORS = ["AUTOMOBILE", "BUILDING", "MACHINERY"]
UNKNOWN_CODE = 99999
APP_REGION = "Madrid, Comunidad de"


def R(c: Column | str) -> Column:
    """round(x * 10^d) / 10^d: the same arithmetic as the SQL oracle's rounding."""
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** DECIMALS)
    return F.round(c * scale, 0) / scale


def _rounded(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[R(c).alias(c) if c in cols else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ chain
#
# The ETL runs once per session and driver-table folder as a warehouse load
# (written Parquet tables under the shared checkpoint folder); every query then
# reads the star schema it produced, as the dashboards read the database.

_WAREHOUSES: dict[tuple[str, str], tuple[Warehouse, LoadReport]] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> tuple[Warehouse, LoadReport]:
    key = (session_key(spark), os.path.abspath(sf_dir))
    if key not in _WAREHOUSES:
        wh = Warehouse(spark)
        report = wh.load(D.observations(spark, sf_dir))
        _WAREHOUSES[key] = (wh, report)
    return _WAREHOUSES[key]


def parsed(spark: SparkSession, sf_dir: str) -> I.Parsed:
    wh, report = warehouse(spark, sf_dir)
    return wh.staged(report)


_STARS: dict[str, I.Star] = {}


def star(spark: SparkSession, sf_dir: str) -> I.Star:
    """The snapshot of the session's load; its folders are listed once."""
    wh, _ = warehouse(spark, sf_dir)
    if wh.root not in _STARS:
        _STARS[wh.root] = wh.star()
    return _STARS[wh.root]


def parts(spark: SparkSession, sf_dir: str) -> G.GoldParts:
    return G.gold_parts(star(spark, sf_dir))


def dashboard_parts(spark: SparkSession, sf_dir: str) -> G.GoldParts:
    """The dashboard's cleaning: sectors as stored, not stripped."""
    return G.gold_parts(star(spark, sf_dir), strip_sector=False)


# ------------------------------------------------------------------ gold and summaries


def q_price_index_general(spark, sf_dir):
    return SM.price_series(parts(spark, sf_dir).index)


def q_price_series_filtered(spark, sf_dir):
    """Dashboard price chart: the year filter, every row, sorted by date."""
    return SM.price_series(dashboard_parts(spark, sf_dir).index, TREND_YEARS)


def q_price_chart(spark, sf_dir):
    return SM.price_chart(parts(spark, sf_dir).index)


def q_gold_relation(spark, sf_dir):
    return parts(spark, sf_dir).relation()


def q_ratio_stats(spark, sf_dir):
    return _rounded(SM.ratio_stats(parts(spark, sf_dir)), ["media", "max", "std"])


def q_ratio_stats_materialised(spark, sf_dir):
    return _rounded(SM.ratio_stats(parts(spark, sf_dir), SM.MATERIALISED), ["media", "max", "std"])


def q_wage_trend_region(spark, sf_dir):
    return _rounded(SM.wage_trend_region(parts(spark, sf_dir)), ["valor_salario"])


def q_year_filtered_trend(spark, sf_dir):
    return _rounded(SM.wage_trend_region(dashboard_parts(spark, sf_dir), TREND_YEARS, TREND_REGIONS), ["valor_salario"])


def q_purchasing_power_rank(spark, sf_dir):
    return _rounded(SM.purchasing_power_rank(parts(spark, sf_dir)), ["ratio_poder_adquisitivo"])


def q_purchasing_power_filtered(spark, sf_dir):
    out = SM.purchasing_power_rank(dashboard_parts(spark, sf_dir), RANK_YEARS, RANK_SEXES, RANK_SECTORS)
    return _rounded(out, ["ratio_poder_adquisitivo"])


def q_region_summary(spark, sf_dir):
    return _rounded(SM.region_summary(parts(spark, sf_dir)), ["salario_medio", "poder_adquisitivo"])


def q_region_map(spark, sf_dir):
    return _rounded(SM.region_map(dashboard_parts(spark, sf_dir)), ["salario_medio", "poder_adquisitivo"])


def q_dashboard_kpis(spark, sf_dir):
    return _rounded(SM.dashboard_kpis(dashboard_parts(spark, sf_dir)), ["valor"])


def _app(spark, sf_dir):
    return G.app_input(star(spark, sf_dir))


def q_app_kpis(spark, sf_dir):
    return _rounded(SM.app_kpis(_app(spark, sf_dir)), ["salario_medio"])


def q_app_region_kpis(spark, sf_dir):
    return _rounded(SM.app_kpis(_app(spark, sf_dir), APP_REGION), ["salario_medio"])


def q_wage_by_sector(spark, sf_dir):
    return _rounded(SM.wage_by_sector(_app(spark, sf_dir)), ["salario"])


def q_gender_gap(spark, sf_dir):
    return _rounded(SM.gender_gap(_app(spark, sf_dir)), ["salario"])


def q_distinct_filters(spark, sf_dir):
    s = star(spark, sf_dir)
    return SM.distinct_filters(G.gold_parts(s, strip_sector=False), G.app_input(s))


def _incremental(spark, sf_dir):
    """A warehouse loaded in three batches (by year, so no key is in two), each batch's moments written as it comes.

    The payload is landed once, a folder for each batch: the driver tables are read once, and a load reads its folder alone.
    """
    key = (session_key(spark), os.path.abspath(sf_dir), "batches")
    if key not in _WAREHOUSES:
        wh = Warehouse(spark)
        obs = D.observations(spark, sf_dir).withColumn("batch", F.pmod(F.coalesce("anyo", F.lit(0)), F.lit(3)))
        path = scratch_path(spark, f"batches-{uuid.uuid4().hex}")
        obs.write.partitionBy("batch").parquet(path)
        landed = spark.read.schema(obs.schema).parquet(path)
        for i in range(3):
            report = wh.load(landed.where(F.col("batch") == i).drop("batch"), load_id=f"batch-{i}")
            GoldView(wh).refresh()
        _WAREHOUSES[key] = (wh, report)
    return GoldView(_WAREHOUSES[key][0]).moments()


def q_incremental_ratio_stats(spark, sf_dir):
    return _rounded(SM.ratio_stats(_incremental(spark, sf_dir)), ["media", "max", "std"])


def q_incremental_trend(spark, sf_dir):
    return _rounded(SM.wage_trend_region(_incremental(spark, sf_dir)), ["valor_salario"])


# ------------------------------------------------------------------ ingestion


def q_series_name_parse(spark, sf_dir):
    return I.series_table(parsed(spark, sf_dir))


def q_period_map(spark, sf_dir):
    return star(spark, sf_dir).periodo


def q_category_normalise(spark, sf_dir):
    rows = parsed(spark, sf_dir).rows.where(F.col("family") == C.PRICES)
    return rows.select("code", F.col("meta_categoria").alias("categoria"), "categoria_gasto").distinct()


def q_wage_defaults(spark, sf_dir):
    rows = parsed(spark, sf_dir).rows.where(F.col("family") == C.WAGES)
    return rows.select("code", F.col("meta_geografia").alias("geografia_origen"), "geografia", "sexo",
                       "sector_cnae", "ocupacion_cno11").distinct()


def _named_facts(s: I.Star, table: str) -> DataFrame:
    per = s.periodo.select("id_periodo", "fecha_iso")
    ind = s.indicador.select("id_indicador", F.col("nombre").alias("indicador"))
    geo = s.geografia.select("id_geografia", F.col("nombre").alias("geografia"))
    f = s.table(table).join(per, "id_periodo").join(ind, "id_indicador").join(geo, "id_geografia")
    return f.drop("id_periodo", "id_indicador", "id_geografia")


def q_first_wins_load(spark, sf_dir):
    return _named_facts(star(spark, sf_dir), "T_precios")


def q_wage_facts(spark, sf_dir):
    return _named_facts(star(spark, sf_dir), "T_salarios")


def q_null_key_load(spark, sf_dir):
    return _named_facts(star(spark, sf_dir), "T_empleo")


def q_reload_idempotent(spark, sf_dir):
    p = parsed(spark, sf_dir)
    once = star(spark, sf_dir)
    again = I.load_delta(p, once)
    marks = spark.createDataFrame([(n, 0, 0) for n in S.TABLES], "tabla string, una int, dos int")
    for name in S.TABLES:  # one union of row marks, one aggregate
        marks = marks.unionAll(once.table(name).select(F.lit(name), F.lit(1), F.lit(1)))
        marks = marks.unionAll(again.table(name).select(F.lit(name), F.lit(0), F.lit(1)))
    return marks.groupBy("tabla").agg(F.sum("una").alias("filas_una_carga"), F.sum("dos").alias("filas_dos_cargas"))


def q_dimension_build(spark, sf_dir):
    s = star(spark, sf_dir)
    geo = s.geografia.select(F.lit("tbl_geografia").alias("tabla"), F.col("id_geografia").alias("id"),
                             F.col("nombre").alias("clave"), F.lit(None).cast("string").alias("unidad"))
    ind = s.indicador.select(F.lit("tbl_indicador").alias("tabla"), F.col("id_indicador").alias("id"),
                             F.col("nombre").alias("clave"), "unidad")
    return geo.unionByName(ind)


def q_rejects(spark, sf_dir):
    return parsed(spark, sf_dir).rejects


def q_source_samples(spark, sf_dir):
    return I.source_samples(parsed(spark, sf_dir))


def q_source_counts(spark, sf_dir):
    return I.source_counts(parsed(spark, sf_dir))


# ------------------------------------------------------------------ model inputs


def _model_input(spark, sf_dir):
    return G.model_input(star(spark, sf_dir))


def q_model_input(spark, sf_dir):
    return _model_input(spark, sf_dir)


def q_correlation_long(spark, sf_dir):
    from wagelens.operators.models import correlation_long
    return _rounded(correlation_long(_model_input(spark, sf_dir), ["salario", "sexo_num", "anio"]), ["corr"])


def q_hash_split(spark, sf_dir):
    from wagelens.operators.models import with_bucket
    return with_bucket(_model_input(spark, sf_dir))


# ------------------------------------------------------------------ extensions


def q_wage_share(spark, sf_dir):
    return _rounded(X.wage_share(parts(spark, sf_dir)), ["porcentaje"])


def q_annual_change(spark, sf_dir):
    return _rounded(X.annual_change(star(spark, sf_dir)), ["variacion_anual"])


def q_temporality_rate(spark, sf_dir):
    return _rounded(X.temporality_rate(star(spark, sf_dir)), ["tasa_temporalidad"])


def q_wage_cost_only(spark, sf_dir):
    return X.wage_cost_only(parsed(spark, sf_dir).rows)


def q_wages_by_sector_dataset(spark, sf_dir):
    return _rounded(X.wages_by_sector_dataset(parts(spark, sf_dir)), ["salario_medio"])


def q_model_rows_clean(spark, sf_dir):
    return X.model_rows_without_aggregates(_model_input(spark, sf_dir))


# ------------------------------------------------------------------ landing and exports


def _scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _landed_lines(spark, sf_dir) -> str:
    """The driver-derived payload landed as JSON lines (one series per line)."""
    path = _scratch(spark, "landing")
    L.series_lines(D.observations(spark, sf_dir)).write.text(path)
    return path


def q_landing_roundtrip(spark, sf_dir):
    return L.read_payload_lines(spark, _landed_lines(spark, sf_dir), clean=True)


def q_schema_report(spark, sf_dir):
    return L.schema_report(spark, _landed_lines(spark, sf_dir), multi_line=False)


def _conflicting_lines(spark, sf_dir):
    """The landed series, the values of every third one given as text."""
    lines = spark.read.text(_landed_lines(spark, sf_dir))
    as_text = F.regexp_replace("value", r'"Valor":([0-9.Ee+-]+)', '"Valor":"$1"')
    third = F.get_json_object("value", "$.series_pos").cast("long") % 3 == 0
    return lines.select(F.when(third, as_text).otherwise(F.col("value")).alias("value"))


def q_path_statistics(spark, sf_dir):
    return L.path_statistics(_conflicting_lines(spark, sf_dir))


def q_merged_types(spark, sf_dir):
    return L.merged_types(L.path_statistics(_conflicting_lines(spark, sf_dir)))


def q_export_roundtrip(spark, sf_dir):
    index = parts(spark, sf_dir).index.select("valor_ipc", "categoria_gasto", "fecha_iso", "indicador")
    path = E.write_csv(index, _scratch(spark, "export-ipc-csv"))
    return E.read_csv(spark, path, index.schema)


def q_parquet_roundtrip(spark, sf_dir):
    """The index series written as Parquet and read back."""
    index = parts(spark, sf_dir).index.select("valor_ipc", "categoria_gasto", "fecha_iso", "indicador")
    return E.read_parquet(spark, E.write_parquet(index, _scratch(spark, "export-ipc-parquet")))


def q_reject_unknown_code(spark, sf_dir):
    """The labour-cost rows under a code that no source has, rejected one by one."""
    obs = D.observations(spark, sf_dir).where(F.col("code") == C.ETCL).withColumn("code", F.lit(UNKNOWN_CODE))
    return I.parse(obs).rejects.groupBy("code", "reason").agg(F.count("*").alias("filas"))


def q_typed_reread(spark, sf_dir):
    """The master set re-read from text columns, dates and values cast back (NULL where they don't parse)."""
    app = _app(spark, sf_dir)
    text = E.read_csv(spark, E.write_csv(app, _scratch(spark, "export-text-csv")), "salario string, sector_cnae string, sexo string, comunidad string, fecha_iso string")
    return text.select(F.col("salario").try_cast("double").alias("salario"), "sector_cnae", "sexo", "comunidad",
                       F.try_to_date("fecha_iso", "yyyy-MM-dd").alias("fecha"))


def q_schema_create(spark, sf_dir):
    """Tables of a fresh warehouse after create-if-absent and one load of the price sources."""
    wh = Warehouse(spark).create()
    wh.load(D.observations(spark, sf_dir).where(F.col("code").isin(C.IPC, C.IPV)))
    return wh.create().counts()


def q_format_sizes(spark, sf_dir):
    relation = parts(spark, sf_dir).relation()
    pq = E.write_parquet(relation, _scratch(spark, "export-gold-parquet"))
    csv = E.write_csv(E.read_parquet(spark, pq), _scratch(spark, "export-gold-csv"))  # the fan-out is built once
    return E.format_sizes(spark, csv, pq)


def q_master_export(spark, sf_dir):
    """The master set written as CSV (no index column) and read back."""
    app = _app(spark, sf_dir)
    path = E.write_csv(app, _scratch(spark, "export-master-csv"))
    return E.read_csv(spark, path, app.schema)


def q_master_preview(spark, sf_dir):
    return SM.master_preview(_app(spark, sf_dir))


ROWS_ONLY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "schema_report": q_schema_report,
    "format_sizes": q_format_sizes,
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ratio_stats": q_ratio_stats,
    "ratio_stats_materialised": q_ratio_stats_materialised,
    "price_index_general": q_price_index_general,
    "price_chart": q_price_chart,
    "price_series_filtered": q_price_series_filtered,
    "parquet_roundtrip": q_parquet_roundtrip,
    "reject_unknown_code": q_reject_unknown_code,
    "typed_reread": q_typed_reread,
    "schema_create": q_schema_create,
    "gold_relation": q_gold_relation,
    "wage_trend_region": q_wage_trend_region,
    "year_filtered_trend": q_year_filtered_trend,
    "purchasing_power_rank": q_purchasing_power_rank,
    "purchasing_power_filtered": q_purchasing_power_filtered,
    "region_summary": q_region_summary,
    "region_map": q_region_map,
    "dashboard_kpis": q_dashboard_kpis,
    "app_kpis": q_app_kpis,
    "app_region_kpis": q_app_region_kpis,
    "wage_by_sector": q_wage_by_sector,
    "gender_gap": q_gender_gap,
    "distinct_filters": q_distinct_filters,
    "series_name_parse": q_series_name_parse,
    "period_map": q_period_map,
    "category_normalise": q_category_normalise,
    "wage_defaults": q_wage_defaults,
    "first_wins_load": q_first_wins_load,
    "wage_facts": q_wage_facts,
    "null_key_load": q_null_key_load,
    "reload_idempotent": q_reload_idempotent,
    "dimension_build": q_dimension_build,
    "rejects": q_rejects,
    "source_counts": q_source_counts,
    "source_samples": q_source_samples,
    "model_input": q_model_input,
    "correlation_long": q_correlation_long,
    "hash_split": q_hash_split,
    "wage_share": q_wage_share,
    "annual_change": q_annual_change,
    "temporality_rate": q_temporality_rate,
    "wage_cost_only": q_wage_cost_only,
    "wages_by_sector_dataset": q_wages_by_sector_dataset,
    "model_rows_clean": q_model_rows_clean,
    "landing_roundtrip": q_landing_roundtrip,
    "path_statistics": q_path_statistics,
    "incremental_ratio_stats": q_incremental_ratio_stats,
    "incremental_trend": q_incremental_trend,
    "merged_types": q_merged_types,
    "export_roundtrip": q_export_roundtrip,
    "master_export": q_master_export,
    "master_preview": q_master_preview,
    **ROWS_ONLY,
}
