"""Label rules on hand-made tables, and models on data whose answer is known."""

import datetime as dt
import itertools

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from wagelens.operators import models as M
from wagelens.plans import extensions as X
from wagelens.plans import gold as G
from wagelens.plans import ingest as I
from wagelens.plans import summaries as SM


def _obs(spark, rows):
    return spark.createDataFrame(rows, "code int, series_pos long, nombre string, data_pos long, anyo int, fk_periodo int, valor double")


@pytest.fixture(scope="module")
def parts(spark):
    rows = [(50913, 0, "Nacional. General. Índice. ", 0, 2022, 19, 1234.5), (50913, 1, "Nacional. General. Índice. ", 1, 2021, 19, 100.0),
            (65334, 0, "Tasa de paro. Hombres. Galicia. Total. ", 0, 2022, 19, 12.0), (65334, 1, "Tasa de paro. Mujeres. Galicia. Total. ", 0, 2022, 19, 14.0),
            (65334, 2, "Tasa de paro. Total. Galicia. Total. ", 0, 2022, 19, 13.0)]
    rows += [(28186, i, f"Directores. {sex}. Galicia. ", 0, 2022, 19, wage) for i, (sex, wage) in enumerate((("Hombres", 30000.0), ("Mujeres", 10000.0), ("Total", 20000.0)))]
    return G.gold_parts(I.build_star(I.parse(_obs(spark, rows))))


def test_wage_share_leaves_the_total_out(parts):
    assert {r.sexo: round(r.porcentaje, 6) for r in X.wage_share(parts).collect()} == {"Hombres": 75.0, "Mujeres": 25.0}


def test_kpi_texts(parts):
    got = {r.kpi: r.texto for r in SM.dashboard_kpis(parts).collect()}
    assert got == {"ipc_actual": "1234.50", "salario_medio": "20,000.00", "paro_medio": "13.00"}


def test_price_series_keeps_all_rows_in_date_order(parts):
    assert [r.fecha_iso.year for r in SM.price_series(parts.index).collect()] == [2021, 2022]
    assert [r.fecha_iso.year for r in SM.price_series(parts.index, [2022]).collect()] == [2022]


def test_dashboard_cleaning_keeps_the_sector_as_stored(spark):
    wages = spark.createDataFrame([(1.0, " Industria ", "Hombres")], "valor_salario double, sector_cnae string, sexo string")
    assert [r.sector_cnae for r in G.clean_wages(wages).collect()] == ["Industria"]
    assert [r.sector_cnae for r in G.clean_wages(wages, strip_sector=False).collect()] == [" Industria "]


@pytest.mark.parametrize("contracts, rate", [({"Total": 100, "Temporal": 25, "Indefinido": 75}, 25.0), ({"Temporal": 25, "Indefinido": 75}, 25.0)])
@pytest.mark.parametrize("time", ["Jornada completa", "Completa"])
def test_temporality_rate(spark, contracts, rate, time):
    rows = [(65132, i, f"Galicia. Asalariados. Hombres. {c}. {t}. ", 0, 2022, 19, float(n) if t == time else 1000.0)
            for i, (c, n, t) in enumerate((c, n, t) for (c, n), t in itertools.product(contracts.items(), (time, "Jornada a tiempo parcial")))]
    got = X.temporality_rate(I.build_star(I.parse(_obs(spark, rows)))).collect()
    assert [(r.fecha_iso, r.geografia, r.sexo, r.tasa_temporalidad) for r in got] == [(dt.date(2022, 1, 1), "Galicia", "Hombres", rate)]


@pytest.fixture(scope="module")
def known(spark):
    """salario = 10000 + sector + region + 500 * sex + 100 * (year - 2000), 480 rows."""
    sectors, regions = {"A": 0, "B": 4000, "C": 9000}, {"x": 0, "y": 1000, "z": 2500, "w": 3000}
    rows = [(10000.0 + s + r + 500 * (sex == "Mujeres") + 100 * (year - 2000), sector, sex, region, f"{year}-01-01", year, int(sex == "Mujeres"))
            for (sector, s), (region, r), sex, year in itertools.product(sectors.items(), regions.items(), ("Hombres", "Mujeres"), range(2000, 2020))]
    return spark.createDataFrame(rows, "salario double, sector_cnae string, sexo string, comunidad string, fecha_iso string, anio int, sexo_num int")


def _scores(frame):
    return {r.metrica: r.valor for r in frame.collect()}


def test_encoder_slots(known):
    model = Pipeline(stages=M.encoder_stages(M.MODEL_CATEGORICALS, M.MODEL_NUMERIC)).fit(known)
    names = M.feature_names(model, known)
    assert names == ["anio", "sexo_num", "sector_cnae_A", "sector_cnae_B", "sector_cnae_C", *(f"comunidad_{c}" for c in "wxyz")]
    row = model.transform(known.filter("sector_cnae = 'B' AND comunidad = 'w' AND anio = 2003 AND sexo_num = 1")).first()
    assert row.features.toArray().tolist() == [2003, 1, 0, 1, 0, 1, 0, 0, 0]
    unseen = model.transform(known.limit(1).withColumn("sector_cnae", F.lit("new"))).first()
    assert unseen.features.toArray()[2:5].tolist() == [0, 0, 0]


def test_linear_regression_finds_the_rule(known):
    for n in (1, 7):
        _, pred, scores = M.fit_and_score(M.linear_regression(), known.repartition(n), "Regresión Lineal")
        assert _scores(scores)["r2"] > 0.999
    assert pred.count() == M.with_split(known).filter("en_test").count()


def test_forest_is_close_and_does_not_depend_on_partitions(known):
    results, predictions = [], []
    for n in (1, 7):
        model, pred, scores = M.fit_and_score(M.random_forest(trees=20), known.repartition(n), "Random Forest")
        results.append(_scores(scores))
        predictions.append(sorted((r.salario, r.prediction) for r in pred.collect()))
    assert predictions[0] == predictions[1]
    assert results[0]["r2"] > 0.95 and all(abs(results[0][m] - results[1][m]) < 1e-9 for m in results[0])
    importances = M.feature_importance(model, top=100).collect()
    assert abs(sum(r.importancia for r in importances) - 1) < 1e-9
    assert importances[0].variable.startswith("sector_cnae")
    assert model.forest.nodes.filter("column IS NOT NULL").agg(F.min("rows")).first()[0] >= M.MIN_SPLIT


def test_batch_scoring_of_unseen_levels(known):
    model = M.app_forest().fit(known)
    scored = M.score_batch(model, known.select(*M.APP_CATEGORICALS).distinct().withColumn("sector_cnae", F.lit("new")))
    assert scored.filter("salario_estimado IS NULL").count() == 0


def test_four_separated_clusters_are_found(spark):
    rows = [(float(s * 1000 + i), s % 2, 2000 + 10 * (s // 2)) for s in range(4) for i in range(25)]
    df = spark.createDataFrame([(w, "A", "Hombres", "x", f"{y}-01-01", y, sx) for w, sx, y in rows],
                               "salario double, sector_cnae string, sexo string, comunidad string, fecha_iso string, anio int, sexo_num int")
    found = M.kmeans_clusters(df)
    groups = found.labelled.groupBy("anio", "sexo_num").agg(F.collect_set("cluster").alias("c")).collect()
    assert len(found.centres) == 4 and all(len(g.c) == 1 for g in groups) and len({g.c[0] for g in groups}) == 4
    assert found.silhouette > 0.6 and found.error_bound == 0 and M.nearer_elsewhere(found).agg(F.sum("mas_cerca_de_otro")).first()[0] == 0


def test_model_names(known):
    assert {r.modelo for r in M.model_comparison(known).collect()} == {"Regresión Lineal", "Random Forest"}


def test_correlation_is_one_scan(known):
    plan = M.correlation_long(known, ["salario", "sexo_num", "anio"])
    assert plan._jdf.queryExecution().executedPlan().toString().count("Scan") <= 1
    assert plan.count() == 9
