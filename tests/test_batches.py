"""The payload of the incremental queries: derived once from the driver tables, landed by batch; lines summed up before they are taken three times."""

from collections import defaultdict
from datetime import datetime

from wagelens import constants as C
from wagelens import contract
from wagelens.sources import driver_tables as D

LINES = [  # suppkey, quantity, discount, tax, returnflag, linestatus, shipdate
    (1, 10.0, 0.05, 0.02, "A", "O", datetime(1996, 1, 5)), (1, 20.0, 0.07, 0.0, "A", "O", datetime(1996, 3, 31)),
    (2, None, 0.01, None, "R", "F", datetime(1997, 12, 31)), (2, 7.0, None, 0.01, None, "F", datetime(1997, 10, 1)),
    (1, 31.0, 0.02, 0.03, "N", None, datetime(1998, 6, 30)), (3, 5.0, 0.0, 0.01, "N", "O", None), (9, 1.0, 0.01, 0.01, "A", "O", datetime(1996, 1, 1)),
    (1, 12.0, 0.06, 0.02, "A", "O", datetime(1996, 1, 31)), (None, 2.0, 0.01, 0.01, "A", "O", datetime(1996, 1, 1)),
]
ORDERS = [(1, "F", 100.5, datetime(1996, 5, 1), "1-URGENT"), (1, "F", 200.5, datetime(1996, 6, 1), "2-HIGH"), (2, "O", None, datetime(1997, 1, 1), None),
          (2, "P", 50.0, datetime(1998, 8, 1), "1-URGENT"), (7, "F", 1.0, datetime(1996, 5, 1), "1-URGENT")]


def _tables(spark, folder):
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    put("region", [(0, "R0"), (1, "R1")], "r_regionkey long, r_name string")
    put("nation", [(0, "N0", 0), (1, "N1", 1), (2, "N2", 5)], "n_nationkey long, n_name string, n_regionkey long")
    put("supplier", [(1, 1), (2, 0), (3, 2)], "s_suppkey long, s_nationkey long")
    put("customer", [(1, 1, "BUILDING"), (2, 0, None)], "c_custkey long, c_nationkey long, c_mktsegment string")
    put("lineitem", LINES, "l_suppkey long, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
    put("orders", ORDERS, "o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")


def test_lines_summed_up_first_give_each_datum_of_the_lines(spark, tmp_path):
    _tables(spark, tmp_path)
    nation_of, region_of = {1: 1, 2: 0, 3: 2}, {1: 1, 0: 0, 2: None}
    sums = defaultdict(list)
    for supp, quantity, discount, tax, flag, status, shipped in LINES:
        if supp not in nation_of:
            continue
        nation, sex = nation_of[supp], supp % 3
        year, month = (shipped.year, shipped.month) if shipped else (None, None)
        quarter = 18 + (month + 2) // 3 if month else None
        if region_of[nation] is not None:
            sums[C.IPC if status == "O" else C.IPV, region_of[nation] * 4 + {"A": 0, "N": 1, "R": 2}.get(flag, 3), year, month if status == "O" else quarter].append(quantity)
        sums[C.TASA_PARO, (nation * 3 + sex) * 4 + {"A": 0, "N": 1}.get(flag, 2), year, quarter].append(None if discount is None else round(discount * 100))
        time = 2 if not tax else 0 if status == "F" else 1
        sums[C.TEMPORALIDAD, ((nation * 3 + sex) * 2 + (flag != "R")) * 4 + time, year, quarter].append(quantity)
    expected = {}
    for key, values in sums.items():
        known = [v for v in values if v is not None]
        expected[key] = round(sum(known) / len(values) * 4) / 4 if known else None
    got = D.lineitem_observations(spark, str(tmp_path)).collect()
    assert {(r.code, r.series_pos, r.anyo, r.fk_periodo): r.valor for r in got} == expected and len(got) == len(expected)


def test_each_batch_reads_its_landed_folder_alone(spark, tmp_path, monkeypatch):
    _tables(spark, tmp_path)
    frames = []
    monkeypatch.setattr(contract.Warehouse, "load", lambda self, obs, load_id: frames.append(obs))
    monkeypatch.setattr(contract.GoldView, "refresh", lambda self: [])
    monkeypatch.setattr(contract.GoldView, "moments", lambda self: None)
    contract._incremental(spark, str(tmp_path))
    scanned = [[line for line in f._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line] for f in frames]
    assert len(frames) == 3 and all(len(s) == 1 and "lineitem" not in s[0] and "orders" not in s[0] for s in scanned)
    assert all(f"(batch#" in s[0] and f" = {i})" in s[0].partition("PartitionFilters")[2] for i, s in enumerate(scanned))
    whole = sorted(map(str, D.observations(spark, str(tmp_path)).collect()))
    assert sorted(str(r) for f in frames for r in f.collect()) == whole
    assert [{(r.anyo or 0) % 3 for r in f.collect()} for f in frames] == [{0}, {1}, {2}]
