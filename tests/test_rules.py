"""Rule-level checks of the column functions and operators."""

import math

from pyspark.sql import Row
from pyspark.sql import functions as F

from wagelens.functions.series import name_parts, period_date, price_category, wage_geography
from wagelens.operators.dedup import first_wins, insert_or_ignore


def test_name_parts_strip_like_python(spark):
    names = ["a. b .c", " x. y .\tz\n. ", "...", "uno"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r.p for r in df.select(name_parts(F.col("n")).alias("p")).collect()]
    want = [[p.strip() for p in n.split(".") if p.strip()] for n in names]
    assert got == want


def test_period_and_labels(spark):
    df = spark.createDataFrame([(2022, 19), (2022, 22), (2022, 7), (2021, 28)], "y int, fk int")
    got = [str(r.d) for r in df.select(period_date(F.col("y"), F.col("fk")).alias("d")).collect()]
    assert got == ["2022-01-01", "2022-10-01", "2022-01-01", "2021-01-01"]
    cats = spark.createDataFrame([("Índice GENERAL",), ("Vivienda general",), ("Alimentos",)], "c string")
    assert [r.c for r in cats.select(price_category(F.col("c")).alias("c")).collect()] == \
        ["IPC General", "IPC General", "Alimentos"]
    geos = spark.createDataFrame([("España",), (None,), ("Madrid",)], "g string")
    assert [r.g for r in geos.select(wage_geography(F.col("g")).alias("g")).collect()] == \
        ["Total Nacional", "Total Nacional", "Madrid"]


def test_first_wins_null_keys(spark):
    rows = spark.createDataFrame([
        Row(k1=1, k2="a", valor=1.0, ord=5), Row(k1=1, k2="a", valor=2.0, ord=3),
        Row(k1=1, k2=None, valor=3.0, ord=1), Row(k1=1, k2=None, valor=4.0, ord=2),
    ], "k1 int, k2 string, valor double, ord long")
    out = sorted(((r.k1, r.k2, r.valor) for r in first_wins(rows, ["k1", "k2"], ["valor"]).collect()), key=str)
    assert out == sorted([(1, "a", 2.0), (1, None, 3.0), (1, None, 4.0)], key=str)
    corrected = first_wins(rows, ["k1", "k2"], ["valor"], null_keys_conflict=True).collect()
    assert len(corrected) == 2
    stored = rows.limit(0).union(spark.createDataFrame([Row(k1=1, k2="a", valor=9.0, ord=0),
                                                         Row(k1=1, k2=None, valor=9.0, ord=0)], rows.schema))
    kept = insert_or_ignore(rows, stored, ["k1", "k2"]).collect()
    assert sorted(r.valor for r in kept) == [3.0, 4.0]


def test_factorised_equals_materialised(spark):
    from wagelens import contract
    from wagelens.plans import summaries as SM
    sf = "/root/testdata/sf0.001"
    parts = contract.parts(spark, sf)
    a = {(r.sector_cnae, r.sexo): r for r in SM.ratio_stats(parts).collect()}
    b = {(r.sector_cnae, r.sexo): r for r in SM.ratio_stats(parts, SM.MATERIALISED).collect()}
    assert a.keys() == b.keys() and a
    for k in a:
        assert math.isclose(a[k].media, b[k].media, rel_tol=1e-10)
        assert math.isclose(a[k]["max"], b[k]["max"], rel_tol=1e-12)
        if b[k].std is None:
            assert a[k].std is None
        else:
            assert math.isclose(a[k].std, b[k].std, rel_tol=1e-8)
    ta = {(str(r.fecha_iso), r.comunidad): r.valor_salario for r in SM.wage_trend_region(parts).collect()}
    tb = {(str(r.fecha_iso), r.comunidad): r.valor_salario
          for r in SM.wage_trend_region(parts, method=SM.MATERIALISED).collect()}
    assert ta.keys() == tb.keys()
    assert all(math.isclose(ta[k], tb[k], rel_tol=1e-12) for k in ta)


def test_load_is_unchanged_under_repartition(spark):
    """First row wins by the explicit ordinal, so partitioning cannot change the facts."""
    from wagelens.plans import ingest as I
    from wagelens.sources import driver_tables as D
    obs = D.observations(spark, "/root/testdata/sf0.001")

    def facts(o):
        s = I.build_star(I.parse(o))
        return {t: sorted(map(str, s.table(t).collect())) for t in ("T_precios", "T_salarios", "T_empleo",
                                                                        "tbl_periodo", "tbl_geografia")}

    assert facts(obs.repartition(1)) == facts(obs.repartition(7, "nombre"))
