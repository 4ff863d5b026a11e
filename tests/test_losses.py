"""Nothing is lost silently: landing, ordinals, reloads, streams and storage."""

import json
import os
import tempfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wagelens import schemas as S
from wagelens.plans import ingest as I
from wagelens.session import ensure_checkpoint_dir
from wagelens.sources import landing as L
from wagelens.sources.warehouse import Warehouse
from wagelens.streaming import incremental

from test_golden import PAYLOADS


def _land(name, text):
    d = tempfile.mkdtemp(prefix="wagelens-landing-")
    with open(os.path.join(d, name), "w", encoding="utf-8") as fh:
        fh.write(text)
    return d


def _series(value, year=2022):
    return {"Nombre": "Nacional. General. Índice. ", "Data": [{"Anyo": year, "FK_Periodo": 1, "Valor": value}]}


def _counts(wh):
    return {r.tabla: r.filas for r in wh.counts().collect()}


def test_documents_are_validated_without_a_size_switch(spark):
    d = _land("50913.json", '[{"Nombre": "a", "Nombre": "Nacional. General. Índice. ", "Data": [{"Anyo": 2022, "FK_Periodo": 1, "Valor": 1}]}]')
    docs = L.observations_from_documents(L._documents(spark, d))
    assert [r.valor for r in docs.collect()] == [1.0]
    assert "parse_json" not in docs._jdf.queryExecution().analyzed().toString()
    for text in (" ", "[", "{not json", "[1, 2", '"text"', "17"):
        assert L.unreadable_files(spark, _land("50913.json", text)).count() == 1
    assert L.unreadable_files(spark, _land("50913.json", "[]")).count() == 0


def test_a_large_document_loads_in_full(spark):
    n = 60_000
    d = _land("50913.json", json.dumps([_series(i, 1900 + i % 100) for i in range(n)], ensure_ascii=False))
    assert os.path.getsize(f"{d}/50913.json") > 5_000_000
    rows = L.read_payload_files(spark, d)
    assert rows.count() == n and I.parse(rows).rejects.count() == 0


def test_text_values_are_kept_or_rejected(spark):
    values = ["1.5", " 2 ", "-3e1", "n/d", "1.5d", "NaN", "", True, None, 7, 0.25]
    d = _land("50913.json", json.dumps([_series(v, 2000 + i) for i, v in enumerate(values)], ensure_ascii=False))
    p = I.parse(L.read_payload_files(spark, d))
    kept = {r.anyo - 2000: r.valor for r in p.rows.filter("has_datum").collect()}
    assert kept == {0: 1.5, 1: 2.0, 2: -30.0, 8: None, 9: 7.0, 10: 0.25}
    assert {(r.anyo - 2000, r.reason) for r in p.rejects.collect()} == {(i, "bad_value") for i in (3, 4, 5, 6, 7)}


def test_no_position_is_too_large(spark):
    big = 2**40
    rows = [(50913, pos, "Nacional. General. Índice. ", datum, 2022, 1, float(value), None)
            for pos, datum, value in ((big, 3, 2), (big, 2**30, 3), (2, 2**30, 1), (2**62, 0, 4), (-5, 0, 0))]
    fields = "code int, series_pos long, nombre string, data_pos long, anyo int, fk_periodo int, valor double, extra string"
    p = I.parse(spark.createDataFrame(rows, fields).drop("extra"))
    assert p.rejects.count() == 0
    assert [r.valor for r in p.rows.orderBy("ord").collect()] == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert [r.valor for r in I.build_star(p).precios.collect()] == [0.0]


def _employment(spark):
    rows = [(65334, 0, "Tasa de paro. Hombres. Galicia. ", 0, 2022, 19, 5.0), (65334, 1, "Tasa de paro. Mujeres. Galicia. Total. ", 0, 2022, 19, 6.0)]
    return spark.createDataFrame(rows, S.OBSERVATIONS)


def test_replayed_load_replaces_itself(spark):
    obs = L.observations_from_documents(L.documents(spark.createDataFrame(
        [(f"/x/{c}.json", json.dumps(p, ensure_ascii=False)) for c, p in PAYLOADS.items()], "file string, value string")))
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="wagelens-wh-") + "/wh")
    wh.load(obs, load_id="a-0")
    once = _counts(wh)
    wh.load(obs, load_id="a-0")
    assert _counts(wh) == once
    wh.load(obs, load_id="a-1")     # another load: keyed tables as before, NULL-keyed employment again
    twice = _counts(wh)
    assert {t for t in once if twice[t] != once[t]} <= {"T_empleo"}
    wh.load(obs, load_id="a-1")
    assert _counts(wh) == twice


def test_load_after_a_crash_between_tables(spark):
    obs = L.observations_from_documents(L.documents(spark.createDataFrame(
        [("/x/50913.json", json.dumps(PAYLOADS[50913], ensure_ascii=False))], "file string, value string")))
    full = Warehouse(spark, tempfile.mkdtemp(prefix="wagelens-wh-") + "/wh")
    full.load(obs, load_id="x")
    crashed = Warehouse(spark, tempfile.mkdtemp(prefix="wagelens-wh-") + "/wh")
    write = crashed._write

    def failing(df, name, load_id):
        if name.startswith("T_"):
            raise RuntimeError("lost")
        write(df, name, load_id)
    crashed._write = failing
    with pytest.raises(RuntimeError):
        crashed.load(obs, load_id="x")
    crashed._write = write
    crashed.load(obs, load_id="x")
    assert _counts(crashed) == _counts(full)
    assert sorted(map(tuple, crashed.table("T_precios").collect())) == sorted(map(tuple, full.table("T_precios").collect()))


def test_tables_without_success_markers(spark):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    key = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf.set(key, "false")
    try:
        wh = Warehouse(spark, tempfile.mkdtemp(prefix="wagelens-wh-") + "/wh")
        obs = L.observations_from_documents(L.documents(spark.createDataFrame(
            [("/x/50913.json", json.dumps(PAYLOADS[50913], ensure_ascii=False))], "file string, value string")))
        wh.load(obs)
        once = _counts(wh)
        wh.load(obs)
    finally:
        conf.set(key, "true")
    assert once["T_precios"] > 0 and _counts(wh) == once


def test_storage_errors_are_raised(spark):
    wh = Warehouse(spark, "nosuchscheme://host/wh")
    with pytest.raises(Exception):
        wh.table("tbl_periodo")
    assert issubclass(PySparkException, Exception)


def test_create_makes_empty_tables(spark):
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="wagelens-wh-") + "/wh").create()
    assert set(_counts(wh).values()) == {0}
    wh.load(_employment(spark))
    assert _counts(wh.create())["T_empleo"] == 1    # the short name is rejected


def test_two_streams_into_one_warehouse(spark):
    root = tempfile.mkdtemp(prefix="wagelens-stream-wh-") + "/wh"
    for code in (50913, 25171):
        d = _land(f"{code}.json", json.dumps(PAYLOADS[code], ensure_ascii=False))
        incremental.start(spark, d, root, tempfile.mkdtemp(prefix="wagelens-stream-ckpt-")).awaitTermination(120)
    assert _counts(Warehouse(spark, root))["T_precios"] == 7


def test_no_local_fallback_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_units_come_from_the_registry_by_hash_aggregates(spark):
    rows = I.parse(_employment(spark)).rows
    for dim in I.new_dimensions(rows, I.empty_star(spark)):
        assert "SortAggregate" not in dim._jdf.queryExecution().executedPlan().toString()
    assert F is not None
