"""Snapshots, concurrent loads, pruned folders, numbering without a single window."""

import tempfile
import threading

import pytest
from pyspark.sql import functions as F

from wagelens import schemas as S
from wagelens.operators.dimensions import numbered
from wagelens.plans import gold as G
from wagelens.plans import summaries as SM
from wagelens.sources import export as E
from wagelens.sources.warehouse import ConcurrentLoad, Warehouse


def _wages(spark, years, region="Galicia", value=100.0):
    rows = [(28186, i, f"Directores. Hombres. {region}. ", j, y, 19, value + y) for i in range(2) for j, y in enumerate(years)]
    return spark.createDataFrame(rows, S.OBSERVATIONS)


def _prices(spark, years):
    return spark.createDataFrame([(50913, 0, "Nacional. General. Índice. ", j, y, 19, 1.0 * y) for j, y in enumerate(years)], S.OBSERVATIONS)


def _new(spark):
    return Warehouse(spark, tempfile.mkdtemp(prefix="wagelens-wh-") + "/wh")


def _counts(wh):
    return {r.tabla: r.filas for r in wh.counts().collect()}


def _facts(wh):
    s = wh.star()
    named = s.salarios.join(s.periodo, "id_periodo").join(s.geografia.select("id_geografia", "nombre"), "id_geografia")
    return sorted((r.fecha_iso, r.nombre, r.sexo, r.valor) for r in named.collect())


def test_a_reader_sees_whole_loads_only(spark):
    wh = _new(spark)
    wh.load(_wages(spark, [2020]), load_id="a")
    old, seen = _counts(wh), []
    commit = wh._commit

    def watched(load_id, folder):
        seen.append(_counts(Warehouse(spark, wh.root)))  # all tables are written, the load is not committed
        commit(load_id, folder)
    wh._commit = watched
    wh.load(_wages(spark, [2021, 2022], "Murcia"), load_id="b")
    assert seen == [old] and _counts(wh)["T_salarios"] == 3


def test_a_load_that_failed_leaves_nothing_and_blocks_nobody(spark):
    wh = _new(spark)
    wh.load(_wages(spark, [2020]), load_id="a")
    before, write = _facts(wh), wh._write

    def failing(df, name, folder):
        if name == "T_empleo":
            raise RuntimeError("lost")
        write(df, name, folder)
    wh._write = failing
    with pytest.raises(RuntimeError):
        wh.load(_wages(spark, [2021]), load_id="b")
    wh._write = write
    assert _facts(wh) == before
    wh.load(_wages(spark, [2022]), load_id="c")
    assert [r[0].year for r in _facts(wh)] == [2020, 2022]


def test_a_claim_of_a_dead_process(spark):
    wh = _new(spark)
    wh._claim("dead", "dead.1")
    with pytest.raises(ConcurrentLoad, match="dead"):
        wh.load(_wages(spark, [2020]), load_id="other")
    wh.load(_wages(spark, [2020]), load_id="dead")          # its own id takes over
    with pytest.raises(ConcurrentLoad):
        wh._commit("dead", "dead.1")                        # the run it came from comes too late
    wh._claim("gone", "gone.1")
    wh.abandon("gone")
    wh.load(_wages(spark, [2021]), load_id="other")
    assert [r[0].year for r in _facts(wh)] == [2020, 2021]


def test_two_loads_at_once_give_one_order_or_an_error(spark):
    wh = _new(spark)
    wh.load(_wages(spark, [2019]), load_id="first")
    outcome = {}

    def run(name, value):
        try:
            Warehouse(spark, wh.root).load(_wages(spark, [2019, 2020], value=value), load_id=name)
            outcome[name] = "done"
        except ConcurrentLoad:
            outcome[name] = "refused"
    threads = [threading.Thread(target=run, args=(f"t{i}", 1000.0 * i)) for i in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    done = [n for n, o in outcome.items() if o == "done"]
    assert len(outcome) == 2
    alone = _new(spark)
    alone.load(_wages(spark, [2019]), load_id="first")
    for n in sorted(done, key=lambda n: wh.live().index(next(f for f in wh.live() if f.startswith(n)))):
        alone.load(_wages(spark, [2019, 2020], value=1000.0 * int(n[1])), load_id=n)
    if len(done) < 2:
        assert _facts(wh) == _facts(alone)
    else:
        assert len(_facts(wh)) == len(_facts(alone)) == 2


def test_a_committed_load_that_others_followed_stays(spark):
    wh = _new(spark)
    wh.load(_wages(spark, [2020]), load_id="a")
    wh.load(_wages(spark, [2021], "Murcia"), load_id="b")
    once = _facts(wh)
    assert wh.load(_wages(spark, [2020]), load_id="a").rejects == 0
    assert _facts(wh) == once and len(once) == 2


def test_three_loads_equal_one_and_read_only_their_folders(spark, monkeypatch):
    one, three = _new(spark), _new(spark)
    one.load(_wages(spark, [2019, 2020, 2021]))
    plans = []
    new_facts = __import__("wagelens.plans.ingest", fromlist=["x"]).new_facts

    def spied(rows, dims, stored, *a, **k):
        if not stored.empty:
            plans.append(stored.salarios._jdf.queryExecution().executedPlan().toString())
        return new_facts(rows, dims, stored, *a, **k)
    monkeypatch.setattr("wagelens.plans.ingest.new_facts", spied)
    for years in ([2019, 2020], [2020, 2021], [2021]):
        three.load(_wages(spark, years))
    assert _facts(three) == _facts(one) and len(_facts(one)) == 3
    assert len(plans) == 2 and all("PartitionFilters" in p and S.FACT_YEAR in p.partition("PartitionFilters")[2] for p in plans)
    stored = three._touched(__import__("wagelens.plans.ingest", fromlist=["x"]).parse(_wages(spark, [2021])).rows, three.star(), three.star())
    assert {f.partition(f"{S.FACT_YEAR}=")[2][:4] for f in stored.salarios.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]} == {"2021"}


def test_a_year_filter_prunes_the_folders(spark):
    wh = _new(spark)
    wh.load(_prices(spark, range(2000, 2020)).unionByName(_wages(spark, range(2000, 2020))))
    parts = G.gold_parts(wh.star())
    chart = SM.price_series(parts.index, [2003, 2007])
    assert f"dynamicpruningexpression({S.FACT_YEAR}" in chart._jdf.queryExecution().executedPlan().toString()
    assert [r.fecha_iso.year for r in chart.collect()] == [2003, 2007]
    assert SM.price_series(parts.index).count() == 20


def test_unknown_table(spark):
    wh = _new(spark)
    for ask in (lambda: wh.table("T_otra"), lambda: wh.star().table("T_otra")):
        with pytest.raises(S.UnknownTable, match="T_otra.*tbl_periodo.*T_empleo"):
            ask()


@pytest.mark.parametrize("range_rows", [10_000, 100, 7, 1])
def test_numbering_by_ranges(spark, range_rows):
    rows = spark.range(500).select((F.col("id") * 7919 % 1009).cast("decimal(38,0)").alias("o"), "id").repartition(6)
    out = numbered(rows, "o", "n", after=40, range_rows=range_rows)
    got = sorted((r.o, r.n) for r in out.collect())
    assert [n for _, n in got] == list(range(41, 541))
    assert range_rows > 500 or "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()


def test_numbering_of_many_keys(spark):
    rows = spark.range(3_000_000).select((F.col("id") * 48271 % 2147483647).cast("decimal(38,0)").alias("o"))
    out = numbered(rows, "o", "n")
    total = out.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()
    assert tuple(total) == (1, 3_000_000, 3_000_000)


def test_sizes_come_from_the_listing(spark):
    df = spark.range(1000).repartition(3)
    path = tempfile.mkdtemp(prefix="wagelens-out-")
    E.write_csv(df, f"{path}/csv")
    E.write_parquet(df, f"{path}/pq")
    import glob
    import os
    for fmt, name in (("csv", "csv"), ("parquet", "pq")):
        assert E.folder_bytes(spark, f"{path}/{name}", fmt).first().bytes == sum(map(os.path.getsize, glob.glob(f"{path}/{name}/part-*")))
    assert {r.formato for r in E.format_sizes(spark, f"{path}/csv", f"{path}/pq").collect()} == {"csv", "parquet"}
