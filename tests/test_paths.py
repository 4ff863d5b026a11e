"""Path statistics of raw payloads, against a plain traversal."""

import json
from collections import Counter

from wagelens.sources import landing as L


def walk(v, path, out):
    kind = ("NULL" if v is None else "BOOLEAN" if isinstance(v, bool) else "INTEGER" if isinstance(v, int) else "FLOAT" if isinstance(v, float)
            else "STRING" if isinstance(v, str) else "ARRAY" if isinstance(v, list) else "OBJECT")
    out[path, kind] += 1
    if isinstance(v, dict):
        for k, x in v.items():
            walk(x, f"{path}.{k}" if path else k, out)
    elif isinstance(v, list):
        for x in v:
            walk(x, f"{path}[]", out)


VALUES = [
    {"Nombre": "a", "Data": [{"Anyo": 2020, "Valor": 1.5}, {"Anyo": "2021", "Valor": 2}, {"Anyo": None, "Valor": "x"}]},
    {"Nombre": None, "Data": [], "extra": {"deep": {"deeper": [[1], [2, "b"], []]}}},
    {"Nombre": 7, "Data": {"not": "a list"}}, [], "text", 3, None, True, {"a.b": {"": 1}},
]


def test_paths_equal_a_plain_traversal(spark):
    rows = [(json.dumps(v),) for v in VALUES] + [("{broken",), (None,)]
    expected = Counter()
    for v in VALUES:
        walk(v, "", expected)
    expected["", "UNREADABLE"] += 1
    stats = L.path_statistics(spark.createDataFrame(rows, "value string").repartition(3))
    got = Counter({(r.campo, r.tipo): r.filas for r in stats.collect()})
    assert {k: n for k, n in got.items() if k[0] != "a.b."} == {k: n for k, n in expected.items() if k[0] != "a.b."}
    types = {r.campo: r.tipo for r in L.merged_types(stats).collect()}
    assert types["Data[].Anyo"] == "STRING" and types["Data[].Valor"] == "STRING" and types["Data"] == "STRING" and types["extra.deep.deeper[][]"] == "STRING"
    numbers = L.merged_types(L.path_statistics(spark.createDataFrame([('{"x": 1, "y": null}',), ('{"x": 1.5}',)], "value string")))
    assert {r.campo: r.tipo for r in numbers.collect()} == {"": "OBJECT", "x": "FLOAT", "y": "NULL"}


def test_documents_are_split_first(spark):
    docs = spark.createDataFrame([(json.dumps(VALUES[:3]),), (json.dumps(VALUES[0]),), ("{broken",)], "value string")
    got = Counter({(r.campo, r.tipo): r.filas for r in L.path_statistics(L.document_values(docs)).collect()})
    assert got["", "OBJECT"] == 4 and got["Data", "ARRAY"] == 3 and got["", "UNREADABLE"] == 1


def test_no_values(spark):
    assert L.path_statistics(spark.createDataFrame([], "value string")).count() == 0
