"""Golden example: hand-made payloads through landing, parsing, load and gold layer."""

import json
import math
import tempfile

import pytest
from pyspark.sql import functions as F

from wagelens.plans import gold as G
from wagelens.plans import ingest as I
from wagelens.plans import summaries as SM
from wagelens.sources import landing as L
from wagelens.sources.warehouse import Warehouse

PAYLOADS = {
    50913: [
        {"Nombre": "Nacional. Índice general. Índice. ",
         "Data": [{"Anyo": 2022, "FK_Periodo": 1, "Valor": 100}, {"Anyo": 2022, "FK_Periodo": 2, "Valor": 101},
                  {"Anyo": 2023, "FK_Periodo": 1, "Valor": 105}, {"Anyo": 2023, "FK_Periodo": 2, "Valor": None},
                  {"Anyo": 2025, "FK_Periodo": 1, "Valor": None}, {"Anyo": 2025, "FK_Periodo": 2, "Valor": 120}]},
        {"Nombre": "Nacional. Índice general. Variación anual. ",
         "Data": [{"Anyo": 2022, "FK_Periodo": 1, "Valor": 3.1}, {"Anyo": 2024, "FK_Periodo": 1, "Valor": 2.8}]},
        {"Nombre": "Nacional. Alimentos. Índice. ", "Data": [{"Anyo": 2022, "FK_Periodo": 1, "Valor": 110}]},
        {"Nombre": "Canarias. Transporte. Índice. ", "Data": []},
    ],
    25171: [{"Nombre": "Madrid. General. Índice. ",
             "Data": [{"Anyo": 2022, "FK_Periodo": 19, "Valor": 140}, {"Anyo": 2022, "FK_Periodo": 20, "Valor": 141}]}],
    65334: [
        {"Nombre": "Tasa de paro. Hombres. Total Nacional. 16-24. ", "Data": [{"Anyo": 2022, "FK_Periodo": 19, "Valor": 27}]},
        {"Nombre": "Tasa de paro. Mujeres. Total Nacional. 16-24. ", "Data": [{"Anyo": 2022, "FK_Periodo": 19, "Valor": 30}]},
    ],
    65132: [{"Nombre": "Total Nacional. Asalariados. Mujeres. Temporal. Completa. ",
             "Data": [{"Anyo": 2022, "FK_Periodo": 19, "Valor": 1200}]}],
    28186: [
        {"Nombre": "Directores. Hombres. España. ", "Data": [{"Anyo": 2022, "FK_Periodo": 28, "Valor": 50000}]},
        {"Nombre": "Directores. Mujeres. España. ", "Data": [{"Anyo": 2022, "FK_Periodo": 28, "Valor": 42000}]},
    ],
    28191: [
        {"Nombre": "Mujeres. Madrid. Todas. Mediana. ", "Data": [{"Anyo": 2022, "FK_Periodo": 28, "Valor": 21000}]},
        {"Nombre": "Mujeres. Madrid. Todas. Percentil 10. ", "Data": [{"Anyo": 2022, "FK_Periodo": 28, "Valor": 9000}]},
    ],
    6061: [
        {"Nombre": "Nacional. Industria. Coste laboral total. ", "Data": [{"Anyo": 2022, "FK_Periodo": 19, "Valor": 2900}]},
        {"Nombre": "Nacional. Industria. Coste salarial total. ", "Data": [{"Anyo": 2022, "FK_Periodo": 19, "Valor": 2200}]},
    ],
}


def _land(payloads, lone_object_code=None):
    d = tempfile.mkdtemp(prefix="wagelens-landing-")
    for code, series in payloads.items():
        body = series[0] if code == lone_object_code else series
        with open(f"{d}/{code}.json", "w", encoding="utf-8") as fh:
            json.dump(body, fh, ensure_ascii=False)
    return d


@pytest.fixture(scope="module")
def loaded(spark):
    obs = L.read_payload_files(spark, _land(PAYLOADS))
    wh = Warehouse(spark)
    report = wh.load(obs)
    return wh, report, obs


def _named(star, table):
    per = star.periodo.select("id_periodo", "fecha_iso")
    ind = star.indicador.select("id_indicador", F.col("nombre").alias("ind"))
    geo = star.geografia.select("id_geografia", F.col("nombre").alias("geo"))
    return star.table(table).join(per, "id_periodo").join(ind, "id_indicador").join(geo, "id_geografia")


def test_dimensions(loaded):
    wh, _, _ = loaded
    s = wh.star()
    per = sorted((r.id_periodo, str(r.fecha_iso), r.mes, r.trimestre) for r in s.periodo.collect())
    assert per == [(1, "2022-01-01", 1, 1), (2, "2023-01-01", 1, 1), (3, "2025-01-01", 1, 1),
                   (4, "2024-01-01", 1, 1), (5, "2022-04-01", 4, 20)]
    geo = sorted((r.id_geografia, r.nombre) for r in s.geografia.collect())
    assert geo == [(1, "Nacional"), (2, "Canarias"), (3, "Madrid"), (4, "Total Nacional")]
    ind = sorted((r.id_indicador, r.nombre, r.unidad) for r in s.indicador.collect())
    assert ind == [(1, "IPC Indice", "Índice"), (2, "IPV Indice", "Índice"), (3, "Tasa_Paro", "%"),
                   (4, "Temporalidad", "%"), (5, "Salario_Anual_Ocupacion", "Euros")]


def test_prices_first_row_wins(loaded):
    wh, _, _ = loaded
    rows = sorted((str(r.fecha_iso), r.ind, r.geo, r.categoria_gasto, r.valor)
                  for r in _named(wh.star(), "T_precios").collect())
    assert rows == sorted([
        ("2022-01-01", "IPC Indice", "Nacional", "IPC General", 100.0),
        ("2023-01-01", "IPC Indice", "Nacional", "IPC General", 105.0),
        ("2025-01-01", "IPC Indice", "Nacional", "IPC General", 120.0),
        ("2024-01-01", "IPC Indice", "Nacional", "IPC General", 2.8),
        ("2022-01-01", "IPC Indice", "Nacional", "Alimentos", 110.0),
        ("2022-01-01", "IPV Indice", "Madrid", "IPC General", 140.0),
        ("2022-04-01", "IPV Indice", "Madrid", "IPC General", 141.0),
    ])


def test_wages_and_employment(loaded):
    wh, _, _ = loaded
    s = wh.star()
    wages = sorted((r.geo, r.sexo, r.sector_cnae, r.ocupacion_cno11, r.valor) for r in _named(s, "T_salarios").collect())
    assert wages == sorted([
        ("Total Nacional", "Hombres", "Directores", "Directores", 50000.0),
        ("Total Nacional", "Mujeres", "Directores", "Directores", 42000.0),
        ("Madrid", "Mujeres", "Total", "Total", 21000.0),
        ("Nacional", "Ambos", "Industria", "Total", 2900.0),
    ])
    emp = sorted((r.ind, r.sexo, r.grupo_edad, r.tipo_jornada, r.tipo_contrato, r.valor)
                 for r in _named(s, "T_empleo").collect())
    assert emp == sorted([
        ("Tasa_Paro", "Hombres", "16-24", None, None, 27.0),
        ("Tasa_Paro", "Mujeres", "16-24", None, None, 30.0),
        ("Temporalidad", "Mujeres", None, "Completa", "Temporal", 1200.0),
    ], key=lambda t: tuple("" if v is None else str(v) for v in t))


def test_second_load(spark, loaded):
    _, _, obs = loaded
    wh = Warehouse(spark)
    wh.load(obs)
    wh.load(obs)
    counts = {r.tabla: r.filas for r in wh.counts().collect()}
    assert counts["T_precios"] == 7 and counts["T_salarios"] == 4 and counts["T_empleo"] == 6
    assert counts["tbl_periodo"] == 5 and counts["tbl_geografia"] == 4 and counts["tbl_indicador"] == 5


def test_gold_and_summaries(loaded):
    wh, _, _ = loaded
    parts = G.gold_parts(wh.star())
    assert parts.index.count() == 6
    assert parts.relation().count() == 6
    for method in (SM.FACTORISED, SM.MATERIALISED):
        stats = {(r.sector_cnae, r.sexo): (r.media, r["max"], r.std)
                 for r in SM.ratio_stats(parts, method).collect()}
        assert set(stats) == {("Directores", "Hombres"), ("Directores", "Mujeres"), ("Total", "Mujeres")}
        for key, (mean, mx, std) in {("Directores", "Hombres"): (428.571429, 500, 101.015254),
                                     ("Directores", "Mujeres"): (360, 420, 84.852814),
                                     ("Total", "Mujeres"): (180, 210, 42.426407)}.items():
            got = stats[key]
            assert math.isclose(got[0], mean, rel_tol=1e-8) and math.isclose(got[1], mx, rel_tol=1e-12)
            assert math.isclose(got[2], std, rel_tol=1e-7)
        kpis = {r.kpi: r.valor for r in SM.dashboard_kpis(parts, method).collect()}
        assert kpis["ipc_actual"] == 120.0
        assert math.isclose(kpis["salario_medio"], 37666.666667, rel_tol=1e-9)
        assert math.isclose(kpis["paro_medio"], 29.0, rel_tol=1e-12)
        region = {r.comunidad: (r.salario_medio, r.poder_adquisitivo) for r in SM.region_summary(parts, method).collect()}
        assert region.keys() == {"Madrid"}
        assert math.isclose(region["Madrid"][0], 21000) and math.isclose(region["Madrid"][1], 180)
        assert SM.region_map(parts, method).count() == 0


def test_rejects_and_lone_object(spark):
    bad = {
        65132: [{"Nombre": "Total Nacional. Asalariados. Mujeres. Temporal. ", "Data": [{"Anyo": 2022, "FK_Periodo": 19, "Valor": 1}]}],
        99999: [{"Nombre": "a. b. c. d. ", "Data": [{"Anyo": 2022, "FK_Periodo": 19, "Valor": 1}]}],
        50913: [{"Nombre": "Nacional. General. Índice. ", "Data": [{"Anyo": None, "FK_Periodo": 1, "Valor": 1},
                                                                  {"Anyo": 2022, "FK_Periodo": 1, "Valor": 2}]}],
        28186: [{"Nombre": "Directores. Hombres. España. ", "Data": [{"Anyo": 2022, "FK_Periodo": 28, "Valor": 5}]}],
    }
    d = _land(bad, lone_object_code=28186)
    with open(f"{d}/25171.json", "w") as fh:
        fh.write("{not json")
    obs = L.read_payload_files(spark, d)
    assert [r.code for r in L.unreadable_files(spark, d).collect()] == [25171]
    p = I.parse(obs)
    reasons = sorted((r.code, r.reason) for r in p.rejects.collect())
    assert reasons == [(25171, "unreadable_file"), (50913, "null_year"), (65132, "short_name"), (99999, "unknown_code")]
    assert p.rows.where("code = 28186 AND has_datum").count() == 1      # lone object wrapped
    with pytest.raises(ValueError):
        I.parse(obs, raise_on_reject=True)


def test_schema_report(spark):
    d = _land({50913: PAYLOADS[50913]})
    rep = {r.campo: r.tipo for r in L.schema_report(spark, d).collect()}
    assert rep["Nombre"] == "STRING" and rep["Data"] == "ARRAY"
    assert rep["Data[].Anyo"] == "INTEGER" and rep["Data[].Valor"] in ("FLOAT", "INTEGER")


def test_json_lines_roundtrip(spark, loaded):
    _, _, obs = loaded
    d = tempfile.mkdtemp(prefix="wagelens-lines-")
    L.series_lines(obs).write.mode("overwrite").text(d + "/lines")
    back = L.read_payload_lines(spark, d + "/lines")
    cols = ["code", "series_pos", "nombre", "data_pos", "anyo", "fk_periodo", "valor"]
    assert sorted(map(tuple, back.select(*cols).collect()), key=str) == \
        sorted(map(tuple, obs.select(*cols).collect()), key=str)


def test_rerun_after_partial_load(spark, loaded):
    """A load that died after writing its dimensions, re-run in full, gives one load's rows."""
    _, _, obs = loaded
    wh = Warehouse(spark)
    rows = I.parse(obs).rows
    d_per, d_ind, d_geo = I.new_dimensions(rows, wh.star())
    d_per.write.parquet(wh.path("tbl_periodo"))
    d_ind.write.parquet(wh.path("tbl_indicador"))
    d_geo.write.parquet(wh.path("tbl_geografia"))
    wh.load(obs)
    counts = {r.tabla: r.filas for r in wh.counts().collect()}
    assert counts == {"tbl_periodo": 5, "tbl_indicador": 5, "tbl_geografia": 4,
                      "T_precios": 7, "T_salarios": 4, "T_empleo": 3}


def test_empty_load_writes_nothing(spark):
    from wagelens import schemas as S
    wh = Warehouse(spark)
    report = wh.load(spark.createDataFrame([], S.OBSERVATIONS))
    assert report.added == {}
    assert wh.star().empty
    assert {r.filas for r in wh.counts().collect()} == {0}
