"""Exact split, forest rules, joint k-means and Euclidean silhouette against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wagelens.operators import clusters as K
from wagelens.operators import forest as FO
from wagelens.operators import split as SP

SCHEMA = "a string, b string, y int, s int, l double"


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(0)
    rows = []
    for _ in range(600):
        a, b, y, s = rng.choice("ABCDE"), rng.choice("xyzw"), rng.randint(2000, 2012), rng.randint(0, 1)
        rows.append((a, b, y, s, 1000.0 * "ABCDE".index(a) + 50 * (y - 2000) + 300 * s + rng.gauss(0, 50)))
    rows += [rows[0]] * 90 + [(None, "x", 2000, 1, 7.0)] * 3 + [("A", "x", 2001, 1, None), ("A", "x", None, 1, 3.0)]
    return rows


# ------------------------------------------------------------------ M3


@pytest.mark.parametrize("n", [1, 2, 5, 14, 100, 1003])
def test_the_share_is_exact(spark, n):
    df = spark.range(n).select(F.col("id"), (F.col("id") % 7).cast("string").alias("k")).repartition(3)
    got = SP.with_exact_share(df, F.concat_ws("|", "id", "k"), 0.2).collect()
    by_hash = sorted(hashlib.md5(f"{r.id}|{r.k}".encode()).hexdigest() for r in got)
    k = math.ceil(n * 2 / 10)
    assert sorted(hashlib.md5(f"{r.id}|{r.k}".encode()).hexdigest() for r in got if r.en_test) == by_hash[:k]
    assert sorted(r.id for r in got) == list(range(n))


def test_ties_keep_the_share_exact(spark):
    """One key holds nearly all rows, some of them equal in every column."""
    rows = [("hot", i % 5) for i in range(200)] + [("rare", 1), (None, None)]
    for share, k in ((0.2, 41), (0.5, 101), (0.01, 3)):
        got = SP.with_exact_share(spark.createDataFrame(rows, "k string, v int").repartition(4), F.coalesce("k", F.lit("")), share).collect()
        assert sum(r.en_test for r in got) == k
        assert sorted(((r.k, r.v) for r in got), key=str) == sorted(rows, key=str)


def test_selection_goes_digit_by_digit(spark, monkeypatch):
    monkeypatch.setattr(SP, "FEW", 0)
    monkeypatch.setattr(SP, "DIGITS", 1)
    got = SP.with_exact_share(spark.range(50), F.col("id").cast("string"), 0.3).collect()
    assert sum(r.en_test for r in got) == 15


# ------------------------------------------------------------------ M5, M6


def cart(rows, weights, counts, min_split, max_depth, depth=0):
    """Plain recursive CART over one-hot and numeric slots: {path: value}."""
    w = sum(weights)
    value = sum(a * r[-1] for a, r in zip(weights, rows)) / w
    if len({r[-1] for r in rows}) == 1 or sum(counts) < min_split or depth == max_depth:
        return value
    best = None
    for c in (2, 3):
        values = sorted({r[c] for r in rows})
        for low, high in zip(values, values[1:]):
            best = better(best, rows, weights, lambda r, c=c, t=(low + high) / 2: r[c] > t)
    for c in (0, 1):
        for level in sorted({r[c] for r in rows if r[c] is not None}):
            if any(r[c] != level for r in rows):
                best = better(best, rows, weights, lambda r, c=c, v=level: r[c] == v)
    if best is None:
        return value
    sides = ([i for i, r in enumerate(rows) if not best[1](r)], [i for i, r in enumerate(rows) if best[1](r)])
    return (best[1], *(cart([rows[i] for i in side], [weights[i] for i in side], [counts[i] for i in side], min_split, max_depth, depth + 1) for side in sides))


def better(best, rows, weights, goes):
    mean, w = sum(a * r[-1] for a, r in zip(weights, rows)) / sum(weights), [0, 0]
    for a, r in zip(weights, rows):
        w[goes(r)] += a
    off = sum(a * (r[-1] - mean) for a, r in zip(weights, rows) if not goes(r))
    score = np.float32((off / (max(r[-1] for r in rows) - min(r[-1] for r in rows))) ** 2 / (w[0] * w[1]))
    return (score, goes) if best is None or score > best[0] else best


def value_of(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if tree[0](row) else tree[1]
    return tree


@pytest.mark.parametrize("local_rows, max_depth, min_split", [(50_000, None, 2), (50_000, 4, 5), (60, None, 5), (60, 3, 2)])
def test_trees_equal_plain_cart(spark, table, local_rows, max_depth, min_split):
    """Grown in one task or level by level, each tree is the CART of the rows drawn for it."""
    df = spark.createDataFrame(table, SCHEMA).repartition(3)
    forest = FO.fit(df, ["a", "b"], ["y", "s"], "l", trees=3, max_depth=max_depth, min_split=min_split, local_rows=local_rows)
    assert {r.rule: r.violations for r in forest.violations(min_split, max_depth).collect()} == dict.fromkeys(
        ("split_below_minimum", "beyond_depth", "children_do_not_add_up", "leaf_could_be_split", "empty_node"), 0)
    merged = df.filter("y IS NOT NULL AND l IS NOT NULL").groupBy("a", "b", "y", "s", "l").count() \
        .withColumn("key", F.xxhash64("a", "b", F.col("y").cast("double"), F.col("s").cast("double"), "l")).collect()
    probe = sorted({(r.a, r.b, r.y, r.s) for r in merged}, key=str) + [("new", "x", 2005, 0), ("A", None, 2005, 1)]
    expected = np.zeros(len(probe))
    for t in range(3):
        weight, rows = FO.draw(np.array([r.key for r in merged]), np.array([r["count"] for r in merged]), t, 42)
        drawn = [(tuple(r)[:5], int(w), int(n)) for r, w, n in zip(merged, weight, rows) if w]
        tree = cart([x[0] for x in drawn], [x[1] for x in drawn], [x[2] for x in drawn], min_split, max_depth)
        expected += [value_of(tree, p) for p in probe]
    got = forest.predict(spark.createDataFrame([(*p, i) for i, p in enumerate(probe)], "a string, b string, y int, s int, i int")).collect()
    assert len(got) == len(probe) and max(abs(r.prediction - expected[r.i] / 3) for r in got) < 1e-8


def test_draws_follow_poisson_and_do_not_depend_on_order():
    keys = np.random.default_rng(0).integers(-2**62, 2**62, 20_000)
    weight, rows = FO.draw(keys, np.ones(len(keys), dtype=np.int64), 3, 42)
    assert abs(weight.mean() - 1) < 0.03 and abs((weight == 0).mean() - math.exp(-1)) < 0.02 and (rows == (weight > 0)).all()
    again, _ = FO.draw(keys[::-1], np.ones(len(keys), dtype=np.int64), 3, 42)
    assert (again[::-1] == weight).all() and not (FO.draw(keys, np.ones(len(keys), dtype=np.int64), 4, 42)[0] == weight).all()
    hot, some = FO.draw(keys[:50], np.full(50, 100_000), 0, 1)
    assert abs(hot / 100_000 - 1).max() < 0.03 and abs(some / 100_000 - (1 - math.exp(-1))).max() < 0.02


def test_minimum_split_differs_from_minimum_children(spark):
    """Five rows that differ in one: cut 1 : 4 at a minimum of 5, kept whole at 6."""
    df = spark.createDataFrame([("A", "x", 2000 + i, 0, 100.0 if i == 4 else 0.0) for i in range(5)], SCHEMA)
    for minimum, leaves in ((5, 2), (6, 1)):
        columns = {"a": np.array(["A"] * 5, dtype=object), "y": np.arange(5.0)}
        nodes = FO.grow(columns, ["a"], np.array([0.0, 0, 0, 0, 100]), np.ones(5), np.ones(5, dtype=int), 1, 0, None, minimum)
        assert sum(n[2] is None for n in nodes) == leaves
    assert df.count() == 5


def test_deep_chains_have_no_depth_limit():
    n = 60
    nodes = FO.grow({"x": np.arange(n, dtype=float)}, [], 3.0 ** np.arange(n), np.ones(n), np.ones(n, dtype=int), 1, 0, None, 2)
    assert sum(x[2] is None for x in nodes) == n and max(x[1] for x in nodes) > 40


def test_forest_of_nothing(spark):
    forest = FO.fit(spark.createDataFrame([], SCHEMA), ["a"], ["y"], "l", trees=2)
    assert forest.nodes.count() == 0 and forest.importances().count() == 0
    assert [r.prediction for r in forest.predict(spark.createDataFrame([("A", 1)], "a string, y int")).collect()] == [None]


# ------------------------------------------------------------------ M12, M13


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(c, 0.4 + 0.3 * i, (250, 3)) for i, c in enumerate(((0, 0, 0), (3, 0, 0), (0, 3, 0), (2, 2, 2)))]).round(1)
    df = spark.createDataFrame([*x.tolist(), [None, 1.0, 1.0]], "a double, b double, c double").repartition(3)
    return x, K.standardised(df, ["a", "b", "c"])


def test_restarts_in_one_pass_cost_what_single_runs_cost(points):
    x, (table, mean, deviation) = points
    assert np.allclose(mean, x.mean(axis=0)) and np.allclose(deviation, x.std(axis=0))
    centres, costs = K.kmeans(table, 3, 4, [1, 2, 3])
    for i, seed in enumerate((1, 2, 3)):
        alone, cost = K.kmeans(table, 3, 4, [seed])
        assert np.allclose(alone[0], centres[i]) and abs(cost[0] - costs[i]) < 1e-9 * costs[i]
    z = (x - mean) / deviation
    for c, cost in zip(centres, costs):
        far = ((z[:, None] - c[None]) ** 2).sum(axis=2)
        assert abs(far.min(axis=1).sum() - cost) < 1e-6 * cost
        means = np.array([z[far.argmin(axis=1) == j].mean(axis=0) for j in range(4)])
        assert ((means - c) ** 2).sum() < 1e-4


def test_silhouette_equals_all_pairs(points):
    x, (table, mean, deviation) = points
    z = (x - mean) / deviation
    centres = K.kmeans(table, 3, 4, [5])[0][0]
    label = ((z[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    far = np.sqrt(((z[:, None] - z[None]) ** 2).sum(axis=2))
    exact = []
    for i in range(len(z)):
        own = label == label[i]
        a, b = far[i][own].sum() / (own.sum() - 1), min(far[i][label == c].mean() for c in set(label) if c != label[i])
        exact.append((b - a) / max(a, b))
    got, bound = K.silhouette(table, 3, centres)
    assert abs(got - np.mean(exact)) < 1e-9 and bound < 1e-12
    widths = []
    for cells in (600, 100):
        got, bound = K.silhouette(table, 3, centres, cells=cells)
        assert abs(got - np.mean(exact)) <= bound < 0.2
        widths.append(bound)
    assert widths[0] < widths[1]


def test_fewer_rows_than_clusters(spark):
    table, _, _ = K.standardised(spark.createDataFrame([(1.0, 2.0)] * 3 + [(2.0, 2.0)], "a double, b double"), ["a", "b"])
    centres, costs = K.kmeans(table, 2, 4, [1])
    assert centres.shape == (1, 4, 2) and costs[0] == 0
    assert K.silhouette(table, 2, centres[0])[0] == 0.75  # three equal rows score 1, the single one 0
