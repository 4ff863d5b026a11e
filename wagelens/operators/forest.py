"""Regression forests by the rules of exact CART (M5-M7): minimum split size, unbounded depth, all features a split.

* *Rows* equal in features and label are merged first, with their number, so a hot row costs as much as any other.
* *Bagging* draws a Poisson(1) weight per row and tree from a hash of the row's content and the tree, so a fit does not
  depend on how the rows were dealt.  Size rules count the rows drawn at least once, sums use the weights.
* *Large nodes* are split level by level: every task routes its rows through the trees grown so far and adds up the
  moments of each (tree, node, column, value); Spark adds those up, and a window over a node's values finds the best
  cut.  The driver holds the splits of large nodes only, about rows / LOCAL_ROWS a tree.
* *Small nodes* (at most ``LOCAL_ROWS`` drawn rows) are finished inside one task each: the rows of a (tree, node) are
  grouped, and the rest of the tree is grown there in numpy to any depth.
* *Prediction* routes each different combination of features through the large nodes and joins it to the small node's
  subtree, so no executor holds a whole forest.

A split is ``column <= threshold`` for numbers, and ``column <> level`` (left) against ``column = level`` for
categories: the binary slots of a one-hot encoding, without building it.  An unseen or null category is no level, so it
always goes left.  Of equally good splits (the decrease of variance, as a share of its bound, compared in single precision,
so rounding does not choose) the first number, then category, smallest value or level is taken; a split need not improve the node, as long
as labels and some feature differ.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from math import exp, factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagelens.session import scratch_path

#: Drawn rows of a node that one task finishes, and different values of a numeric column told apart in larger nodes.
LOCAL_ROWS = 50_000
MAX_BINS = 1000
#: Copies of one row that are drawn one by one; of more, the numbers of 0, 1, 2 ... draws are drawn together.
ONE_BY_ONE = 64

NODES = ("tree int, root long, node long, depth int, column string, threshold double, level string, left long, right long, "
         "value double, rows long, weight double, decrease double, leaf string")
_NODE_FIELDS = [x.split()[0] for x in NODES.split(", ")]
_PMF = np.array([exp(-1) / factorial(i) for i in range(18)])
_CDF = np.cumsum(_PMF)


def _mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def draw(keys: np.ndarray, copies: np.ndarray, tree: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Draws of the copies of each row for a tree: their sum, and how many copies were drawn at all."""
    weight, rows = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
    salt = _mix(np.array([seed, tree], dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    base = _mix(keys.astype(np.int64).view(np.uint64) ^ salt[0]) + salt[1]
    single = np.flatnonzero(copies <= ONE_BY_ONE)
    for j in range(int(copies[single].max(initial=0))):
        at = single[copies[single] > j]
        u = (_mix(base[at] + np.uint64(j * 0xD1B54A32D192ED03 % 2 ** 64)) >> np.uint64(11)) / 2.0 ** 53
        n = np.searchsorted(_CDF, u, side="right")
        weight[at] += n
        rows[at] += n > 0
    for i in np.flatnonzero(copies > ONE_BY_ONE):
        counts = np.random.Generator(np.random.PCG64(int(base[i]))).multinomial(int(copies[i]), _PMF / _PMF.sum())
        weight[i], rows[i] = int(counts @ np.arange(len(counts))), int(counts[1:].sum())
    return weight, rows


@dataclass
class Trees:
    """The splits of the large nodes: per tree, node -> (column, threshold, level, left, right); node 1 is the root."""
    splits: list[dict[int, tuple]] = field(default_factory=list)

    def route(self, tree: int, columns: dict[str, np.ndarray]) -> np.ndarray:
        """The node of every row after the splits made so far."""
        n = len(next(iter(columns.values())))
        out = np.ones(n, dtype=np.int64)
        todo = [(1, np.arange(n))]
        while todo:
            node, at = todo.pop()
            if node not in self.splits[tree]:
                out[at] = node
                continue
            column, threshold, level, left, right = self.splits[tree][node]
            goes = columns[column][at] == level if level is not None else columns[column][at] > threshold
            todo += [(left, at[~goes]), (right, at[goes])]
        return out


def _columns(batch: pa.RecordBatch | pa.Table, categoricals: Sequence[str], numeric: Sequence[str]) -> dict[str, np.ndarray]:
    out = {c: np.array(batch.column(c).to_pylist(), dtype=object) for c in categoricals}
    return out | {c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) if isinstance(batch, pa.RecordBatch) else batch.column(c).to_numpy().astype(np.float64)
                  for c in numeric}


def grow(columns: dict[str, np.ndarray], categoricals: Sequence[str], label: np.ndarray, weight: np.ndarray, rows: np.ndarray,
         root: int, depth: int, max_depth: int | None, min_split: int) -> list[tuple]:
    """All nodes of the subtree of one node (NODES without tree and root).  The root keeps its number, the others follow it."""
    numbers = [(c, x) for c, x in columns.items() if c not in categoricals]
    codes = []
    for c in categoricals:
        levels = sorted({v for v in columns[c] if v is not None})
        place = {v: i for i, v in enumerate(levels)}
        codes.append((c, levels, np.array([place.get(v, len(levels)) for v in columns[c]], dtype=np.int64)))
    w = weight.astype(np.float64)
    out, made, todo = [], 0, [(root, np.arange(len(label)), depth)]
    while todo:
        node, at, d = todo.pop()
        y, own, total_r = label[at], w[at], int(rows[at].sum())
        total_w = own.sum()
        value = float(own @ y / total_w)
        off, spread = own * (y - value), float(y.max() - y.min())
        best = None

        def better(left_w, left_s):
            """Index of the first best cut, if it beats the best so far."""
            score = ((left_s / spread) ** 2 / (left_w * (total_w - left_w))).astype(np.float32)
            i = int(np.argmax(score))
            return (score[i], i) if best is None or score[i] > best[0] else None

        why = "pure" if y.min() == y.max() else "small" if total_r < min_split else "depth" if max_depth is not None and d >= max_depth else None
        if why is None:
            for c, x in numbers:
                order = np.argsort(x[at], kind="stable")
                v = x[at][order]
                cut = np.flatnonzero(v[1:] > v[:-1])
                if len(cut) and (found := better(np.cumsum(own[order])[cut], np.cumsum(off[order])[cut])):
                    middle = float((v[cut[found[1]]] + v[cut[found[1]] + 1]) / 2)
                    best = (found[0], c, middle, None, x[at] > middle)
            for c, levels, code in codes:
                mine = code[at]
                n = np.bincount(mine, minlength=len(levels) + 1)[: len(levels)]
                there = np.flatnonzero((n > 0) & (n < len(at)))
                if len(there) and (found := better(*(np.bincount(mine, weights=x, minlength=len(levels) + 1)[there] for x in (own, off)))):
                    best = (found[0], c, None, levels[there[found[1]]], mine == there[found[1]])
            why = None if best else "constant"
        if best is None:
            out.append((node, d, None, None, None, None, None, value, total_r, total_w, 0.0, why))
            continue
        _, c, threshold, level, goes = best
        left_w = own[~goes].sum()
        decrease = float(off[~goes].sum() ** 2 * (total_w / (left_w * (total_w - left_w))))
        left, right = (root << 32) + made + 1, (root << 32) + made + 2
        made += 2
        out.append((node, d, c, threshold, level, left, right, value, total_r, total_w, decrease, None))
        todo += [(right, at[goes], d + 1), (left, at[~goes], d + 1)]
    return out


@dataclass
class Forest:
    trees: int
    top: Trees
    nodes: DataFrame  # NODES, written
    categoricals: list[str]
    numeric: list[str]

    def predict(self, df: DataFrame, column: str = "prediction") -> DataFrame:
        """``df`` with the mean of the trees' values; equal features are routed once."""
        features = [*self.categoricals, *self.numeric]
        # Features may be null, so combinations are matched null-safe, by columns of their own names.
        types = {c: "string" for c in self.categoricals} | {c: "double" for c in self.numeric}
        keyed = df.select("*", *(F.col(c).cast(types[c]).alias(f"_f{i}") for i, c in enumerate(features)))
        names = [f"_f{i}" for i in range(len(features))]
        combos = keyed.select(*names).distinct()
        schema = ", ".join(f"_f{i} {types[c]}" for i, c in enumerate(features))
        top, trees, categoricals, numeric = self.top, self.trees, self.categoricals, self.numeric

        def named(batch):
            return batch.rename_columns([features[int(n[2:])] if n.startswith("_f") else n for n in (batch.schema.names)])

        def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = _columns(named(batch), categoricals, numeric)
                for t in range(trees):
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(t, pa.int32()), len(batch)), pa.array(top.route(t, columns)), *batch.columns],
                                                     names=["tree", "root", *batch.schema.names])

        def descend(rows: pa.Table, nodes: pa.Table) -> pa.Table:
            if not rows.num_rows or not nodes.num_rows:
                return rows.select(names).append_column("value", pa.nulls(rows.num_rows, pa.float64()))[:0]
            columns = _columns(named(rows), categoricals, numeric)
            read = {c: nodes.column(c).to_pylist() for c in ("node", "column", "threshold", "level", "left", "right", "value")}
            place = {node: i for i, node in enumerate(read["node"])}
            value = np.zeros(rows.num_rows)
            todo = [(rows.column("root")[0].as_py(), np.arange(rows.num_rows))]
            while todo:
                node, at = todo.pop()
                i = place[node]
                if not len(at):
                    continue
                if read["column"][i] is None:
                    value[at] = read["value"][i]
                    continue
                x = columns[read["column"][i]][at]
                goes = x == read["level"][i] if read["level"][i] is not None else x > read["threshold"][i]
                todo += [(read["left"][i], at[~goes]), (read["right"][i], at[goes])]
            return rows.select(names).append_column("value", pa.array(value))

        spread = combos.mapInArrow(routed, f"tree int, root long, {schema}")
        low = self.nodes.filter("root IS NOT NULL")
        values = spread.groupBy("tree", "root").cogroup(low.groupBy("tree", "root")).applyInArrow(descend, f"{schema}, value double")
        # Added up in order of size, so the last digit does not depend on the shuffle.
        means = values.groupBy(*names).agg((F.aggregate(F.array_sort(F.collect_list("value")), F.lit(0.0), lambda a, b: a + b) / trees).alias(column))
        match = None
        for n in names:
            match = keyed[n].eqNullSafe(means[n]) if match is None else match & keyed[n].eqNullSafe(means[n])
        return keyed.join(means, match, "left").select(*(keyed[c] for c in df.columns), means[column])

    def importances(self) -> DataFrame:
        """variable, importancia: the share of a slot in each tree's decrease of variance, averaged over the trees that split."""
        slot = F.when(F.col("level").isNull(), F.col("column")).otherwise(F.concat_ws("_", "column", "level"))
        per = self.nodes.filter("column IS NOT NULL").groupBy("tree", slot.alias("variable")).agg(F.sum("decrease").alias("d"))
        whole = per.groupBy("tree").agg(F.sum("d").alias("whole")).filter("whole > 0")
        mean = per.join(whole, "tree").groupBy("variable").agg(F.sum(F.col("d") / F.col("whole")).alias("share"))
        of = mean.agg(F.sum("share").alias("of"))
        return mean.crossJoin(F.broadcast(of)).select("variable", (F.col("share") / F.col("of")).alias("importancia"))  # `of` is one row

    def violations(self, min_split: int, max_depth: int | None) -> DataFrame:
        """rule, violations: nodes that break a rule of the forest, checked on the stored nodes alone."""
        n, splits = self.nodes, self.nodes.filter("column IS NOT NULL")
        children = (splits.select("tree", "node", "rows", "weight", "value", F.explode(F.array("left", "right")).alias("child"))
                    .join(n.select("tree", F.col("node").alias("child"), F.col("rows").alias("r"), F.col("weight").alias("w"), F.col("value").alias("v")), ["tree", "child"], "left")
                    .groupBy("tree", "node").agg(F.count("r").alias("n"), F.sum("r").alias("r"), F.sum("w").alias("w"), F.sum(F.col("w") * F.col("v")).alias("s"),
                                                 F.first("rows").alias("rows"), F.first("weight").alias("weight"), F.first("value").alias("value")))
        close = F.abs(F.col("s") - F.col("weight") * F.col("value")) <= 1e-9 * (1 + F.abs(F.col("weight") * F.col("value")))
        deep = F.lit(False) if max_depth is None else F.col("depth") > max_depth
        rules = [("split_below_minimum", splits.filter(F.col("rows") < min_split)), ("beyond_depth", n.filter(deep)),
                 ("children_do_not_add_up", children.filter(~((F.col("n") == 2) & (F.col("r") == F.col("rows")) & (F.col("w") == F.col("weight")) & close))),
                 ("leaf_could_be_split", n.filter((F.col("leaf") == "small") & (F.col("rows") >= min_split) | ((F.col("leaf") == "depth") & (F.lit(max_depth is None) | (F.col("depth") < (max_depth or 0)))))),
                 ("empty_node", n.filter("rows < 1"))]
        out = None
        for name, broken in rules:
            row = broken.agg(F.lit(name).alias("rule"), F.count("*").alias("violations"))
            out = row if out is None else out.unionByName(row)
        return out


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"forest-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _cuts(rows: DataFrame, column: str) -> tuple[np.ndarray, bool]:
    """The values of a numeric column, or (False) quantile bounds where there are too many."""
    found = [r[0] for r in rows.select(column).distinct().limit(MAX_BINS + 1).collect()]
    if len(found) <= MAX_BINS:
        return np.sort(np.array(found, dtype=np.float64)), True
    return np.unique(rows.approxQuantile(column, [i / MAX_BINS for i in range(MAX_BINS + 1)], 1 / (4 * MAX_BINS))), False


def fit(df: DataFrame, categoricals: Sequence[str], numeric: Sequence[str], label: str, trees: int, max_depth: int | None = None,
        min_split: int = 2, seed: int = 42, local_rows: int = LOCAL_ROWS) -> Forest:
    """A forest of ``trees`` trees; rows without label or number are left out."""
    spark, categoricals, numeric, local_rows = df.sparkSession, list(categoricals), list(numeric), max(local_rows, min_split)
    read = df.select(*(F.col(c).cast("string").alias(c) for c in categoricals), *(F.col(c).cast("double").alias(c) for c in numeric), F.col(label).cast("double").alias("_y"))
    for c in (*numeric, "_y"):
        read = read.filter(F.col(c).isNotNull() & ~F.isnan(c))
    features = [*categoricals, *numeric]
    merged = _written(read.groupBy(*features, "_y").agg(F.count("*").alias("_copies")).withColumn("_key", F.xxhash64(*features, "_y")), "rows")

    def drawn(batch: pa.RecordBatch, t: int, plain: frozenset[int]) -> tuple[np.ndarray, np.ndarray]:
        copies = batch.column("_copies").to_numpy()
        return (copies, copies) if t in plain else draw(batch.column("_key").to_numpy(), copies, t, seed)

    centre, total = merged.agg(F.sum(F.col("_copies") * F.col("_y")) / F.sum("_copies"), F.sum("_copies")).first()

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((trees, 3))
        for batch in batches:
            y = batch.column("_y").to_numpy() - centre
            for t in range(trees):
                weight, rows = drawn(batch, t, frozenset())
                found[t] += rows.sum(), weight.sum(), weight @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(trees, dtype=np.int32)), pa.array(found[:, 0].astype(np.int64)), pa.array(found[:, 1]), pa.array(found[:, 2])],
                                         names=["tree", "r", "w", "s"])

    found = {}
    if total:
        added = merged.mapInArrow(sizes, "tree int, r long, w double, s double").groupBy("tree").agg(F.sum("r").alias("r"), F.sum("w").alias("w"), F.sum("s").alias("s"))
        found = {x.tree: (x.r, x.w, x.s) for x in added.collect()}
    plain = frozenset(t for t, (r, _, _) in found.items() if not r)  # a tree that drew no row takes them all, once
    top = Trees([{} for _ in range(trees)])
    # Nodes larger than a task: drawn rows, weight, sum of labels less the centre, depth.
    large = {(t, 1): (*((total, float(total), 0.0) if t in plain else x), 0) for t, x in found.items()}
    large = {k: v for k, v in large.items() if v[0] > local_rows}
    top_rows: list[tuple] = []
    leaves: set[tuple[int, int]] = set()
    depth_of: dict[tuple[int, int], int] = {}
    cuts = {c: _cuts(merged, c) for c in numeric} if large else {}
    while large:
        open_ = frozenset(k for k, v in large.items() if max_depth is None or v[3] < max_depth)
        best = _best_splits(merged, drawn, plain, top, open_, categoricals, numeric, cuts, centre) if open_ else {}
        following = {}
        for (t, node), (r, w, total_s, depth) in large.items():
            b = best.get((t, node))
            if b is None:  # deep enough, pure, or no feature differs
                leaves.add((t, node))
                top_rows.append((t, node, node, depth, None, None, None, None, None, centre + total_s / w, r, w, 0.0, "pure" if (t, node) in open_ else "depth"))
                continue
            left = 2 * len(top.splits[t]) + 2
            c = [*numeric, *categoricals][b.col]
            threshold, level = (None, b.cat) if c in categoricals else (_threshold(cuts[c], b.bin, b.following), None)
            top.splits[t][node] = (c, threshold, level, left, left + 1)
            top_rows.append((t, None, node, depth, c, threshold, level, left, left + 1, centre + total_s / w, r, w, b.decrease, None))
            for child, of in ((left, (b.left_r, b.left_w, b.left_s)), (left + 1, (r - b.left_r, w - b.left_w, total_s - b.left_s))):
                depth_of[t, child] = depth + 1
                if of[0] > local_rows:
                    following[t, child] = (*of, depth + 1)
        large = following

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = _columns(batch, categoricals, numeric) if depth_of else None
            for t in range(trees):
                weight, rows = drawn(batch, t, plain)
                at = np.flatnonzero(weight > 0)
                if len(at):
                    node = top.route(t, columns)[at] if top.splits[t] else np.ones(len(at), dtype=np.int64)
                    done = np.array([n for u, n in leaves if u == t], dtype=np.int64)
                    at, node = at[~np.isin(node, done)], node[~np.isin(node, done)]
                    take = batch.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(t, pa.int32()), len(at)), pa.array(node), take.column("_key"), take.column("_y"), pa.array(weight[at]), pa.array(rows[at]),
                                                      *(take.column(c) for c in features)], names=["tree", "root", "_key", "_y", "_w", "_r", *features])

    def finish(group: pa.Table) -> pa.Table:
        group = group.sort_by([("_key", "ascending"), ("_y", "ascending")])
        t, root = group.column("tree")[0].as_py(), group.column("root")[0].as_py()
        nodes = grow(_columns(group, categoricals, numeric), categoricals, group.column("_y").to_numpy(), group.column("_w").to_numpy(), group.column("_r").to_numpy(),
                     root, depth_of.get((t, root), 0), max_depth, min_split)
        return pa.Table.from_arrays([pa.array(list(x), kind) for x, kind in zip(zip(*((t, root, *n) for n in nodes), strict=True), _NODE_TYPES, strict=True)], names=_NODE_FIELDS)

    kinds = [f"{c} string" for c in categoricals] + [f"{c} double" for c in numeric]
    spread = merged.mapInArrow(dealt, ", ".join(["tree int, root long, _key long, _y double, _w long, _r long", *kinds]))
    nodes = spread.groupBy("tree", "root").applyInArrow(finish, NODES)
    if top_rows:
        nodes = nodes.unionByName(spark.createDataFrame(top_rows, NODES))
    return Forest(trees, top, _written(nodes, "nodes"), categoricals, numeric)


_NODE_TYPES = [{"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string()}[x.split()[1]] for x in NODES.split(", ")]


def _threshold(cuts: tuple[np.ndarray, bool], bin_: int, following: int) -> float:
    """Between two values that follow one another in the node, or the bound of a bin."""
    values, exact = cuts
    return float((values[bin_] + values[following]) / 2) if exact else float(values[bin_])


def _best_splits(merged: DataFrame, drawn, plain: frozenset[int], top: Trees, large: frozenset, categoricals: list[str], numeric: list[str], cuts: dict, centre: float) -> dict:
    """(tree, node) -> the best split of each large node; nodes that can't be split are missing."""
    by_tree: dict[int, set[int]] = {}
    for t, node in large:
        by_tree.setdefault(t, set()).add(node)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = _columns(batch, categoricals, numeric)
            y = batch.column("_y").to_numpy()
            coded = []
            for i, c in enumerate([*numeric, *categoricals]):
                if c in categoricals:
                    encoded = batch.column(c).dictionary_encode()
                    levels = encoded.dictionary.to_pylist()
                    code = encoded.indices.fill_null(len(levels)).to_numpy().astype(np.int64)
                    coded.append((i, code, [*levels, None]))
                else:
                    coded.append((i, np.searchsorted(cuts[c][0], columns[c], side="left").astype(np.int64), None))
            for t, nodes in by_tree.items():
                weight, rows = drawn(batch, t, plain)
                routed = top.route(t, columns)
                for node in nodes:
                    at = np.flatnonzero((routed == node) & (weight > 0))
                    if not len(at):
                        continue
                    for i, code, levels in coded:
                        values, where = np.unique(code[at], return_inverse=True)
                        low, high = np.full(len(values), np.inf), np.full(len(values), -np.inf)
                        np.minimum.at(low, where, y[at])
                        np.maximum.at(high, where, y[at])
                        m = len(values)
                        yield pa.RecordBatch.from_arrays([
                            pa.repeat(pa.scalar(t, pa.int32()), m), pa.repeat(pa.scalar(node, pa.int64()), m), pa.repeat(pa.scalar(i, pa.int32()), m),
                            pa.nulls(m, pa.int64()) if levels else pa.array(values), pa.array([levels[v] for v in values], pa.string()) if levels else pa.nulls(m, pa.string()),
                            pa.array(np.bincount(where, weights=weight[at], minlength=m)), pa.array(np.bincount(where, weights=rows[at], minlength=m).astype(np.int64)),
                            pa.array(np.bincount(where, weights=weight[at] * (y[at] - centre), minlength=m)), pa.array(low), pa.array(high)],
                            names=["tree", "node", "col", "bin", "cat", "w", "r", "s", "low", "high"])

    key = ["tree", "node", "col"]
    added = merged.mapInArrow(moments, "tree int, node long, col int, bin long, cat string, w double, r long, s double, low double, high double").groupBy(*key, "bin", "cat").agg(
        F.sum("w").alias("w"), F.sum("r").alias("r"), F.sum("s").alias("s"), F.min("low").alias("low"), F.max("high").alias("high"))
    whole, upto = Window.partitionBy(*key), Window.partitionBy(*key).orderBy("bin")
    each = added.select("*", *(F.sum(c).over(whole).alias(f"all_{c}") for c in ("w", "r", "s")), F.min("low").over(whole).alias("least"), F.max("high").over(whole).alias("most"))
    # Left are the numbers up to a value, or all levels but one.
    numbers = each.filter("bin IS NOT NULL").select("*", *(F.sum(c).over(upto).alias(f"left_{c}") for c in ("w", "r", "s")), F.lead("bin").over(upto).alias("following"))
    levels = each.filter("bin IS NULL AND cat IS NOT NULL").select("*", *((F.col(f"all_{c}") - F.col(c)).alias(f"left_{c}") for c in ("w", "r", "s")), F.lit(None).cast("long").alias("following"))
    both = numbers.filter("following IS NOT NULL").unionByName(levels).filter("left_r > 0 AND left_r < all_r AND least < most")
    off = F.col("left_s") - F.col("all_s") * F.col("left_w") / F.col("all_w")
    decrease = off * off * F.col("all_w") / (F.col("left_w") * (F.col("all_w") - F.col("left_w")))
    best = both.groupBy("tree", "node").agg(F.min(F.struct((-decrease / (F.col("all_w") * (F.col("most") - F.col("least")) ** 2)).cast("float").alias("order"), "col", "bin", "cat", "following", "left_r", "left_w", "left_s", decrease.alias("decrease"))).alias("b"))
    return {(x.tree, x.node): x.b for x in best.select("tree", "node", "b").collect()}
