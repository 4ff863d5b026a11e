"""k-means with all restarts in one pass (M12), and the Euclidean silhouette without all pairs.

Equal rows are merged first, with their number, and standardised by mean and population deviation.

* *Restarts.*  All runs advance together: a step is one scan and one aggregate over (run, cluster), whatever the number
  of runs.  Each run starts by k-means++: the next centre is drawn with probability proportional to the squared distance
  to the nearest one, as the least of exponential clocks taken from a hash of (row, run, step), so a run does not depend
  on how rows were dealt, nor on the other runs.  A run stops when its centres move no further (``TOLERANCE``).
* *Silhouette.*  s = (b - a) / max(a, b) needs each row's mean distance to every cluster.  The rows of a cluster are
  grouped into cells of a grid (at most ``CELLS`` cells in all, so they fit into every task), and by Jensen's inequality
  the mean distance to the rows of a cell lies between the distance d to their centre and sqrt(d^2 + variance).  That
  gives bounds of a, b and s for every row; the result is the middle, with half the width as ``error_bound``.  While
  there are no more different rows than cells, each is a cell of its own and the result is exact.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagelens.operators.forest import _mix
from wagelens.session import scratch_path

MAX_STEPS = 300
#: Sum of squared moves of a run's centres, in units of the features' variance, at which it stops.
TOLERANCE = 1e-4
CELLS = 4096
#: Merged rows worth a task of their own (a scan over few rows should not cost a task for each small file).
TASK_ROWS = 50_000
_CHUNK = 256


def standardised(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(merged rows x0, x1, ... with their number n and a key, means, deviations); rows with a null are left out."""
    rows = df.select(*(F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(features)))
    for c in rows.columns:
        rows = rows.filter(F.col(c).isNotNull() & ~F.isnan(c))
    merged = rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
    path = scratch_path(df.sparkSession, f"points-{uuid.uuid4().hex}")
    merged.withColumn("key", F.xxhash64(*rows.columns)).write.parquet(path)
    merged = df.sparkSession.read.parquet(path)
    merged = merged.coalesce(max(1, -(-merged.count() // TASK_ROWS)))
    n = F.sum("n")
    mean = merged.agg(*(F.sum(F.col("n") * F.col(c)) / n for c in rows.columns)).first()
    if mean[0] is None:
        mean = [0.0] * len(features)
    var = merged.agg(*(F.sum(F.col("n") * (F.col(c) - m) ** 2) / n for c, m in zip(rows.columns, mean, strict=True))).first()
    deviation = np.array([(v or 0.0) ** 0.5 or 1.0 for v in var])
    scaled = [((F.col(c) - m) / float(d)).alias(f"x{i}") for i, (c, m, d) in enumerate(zip(rows.columns, mean, deviation, strict=True))]
    return merged.select(*scaled, "n", "key"), np.array(mean, dtype=float), deviation


def _points(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return np.stack([batch.column(f"x{i}").to_numpy() for i in range(d)], axis=1)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, by differences: (rows, centres)."""
    return sum((x[:, i, None] - centres[None, :, i]) ** 2 for i in range(x.shape[1]))


def _sums(points: DataFrame, part: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """Sum of a fixed number of cells over all rows: added up in each task, then by Spark."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            more = part(batch)
            total = more if total is None else total + more
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["cell", "value"])

    found = points.mapInArrow(add, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(len(found))
    for r in found:
        out[r.cell] = r.value
    return out


def _next_centres(points: DataFrame, d: int, centres: np.ndarray, seeds: Sequence[int]) -> np.ndarray:
    """One k-means++ draw for every run; centres: (runs, centres so far, d)."""
    step = centres.shape[1]

    def race(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, n = _points(batch, d), batch.column("n").to_numpy().astype(np.float64)
            key = batch.column("key").to_numpy().view(np.uint64)
            for run, seed in enumerate(seeds):
                weight = n * _distances(x, centres[run]).min(axis=1) if step else n
                salt = _mix(np.array([seed, step], dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15))
                u = ((_mix(_mix(key ^ salt[0]) + salt[1]) >> np.uint64(11)) + 0.5) / 2.0 ** 53
                with np.errstate(divide="ignore"):
                    clock = -np.log(u) / weight
                i = int(np.argmin(clock))
                yield pa.RecordBatch.from_arrays([pa.array([run], pa.int32()), pa.array([clock[i]]), pa.array([x[i].tolist()], pa.list_(pa.float64()))], names=["run", "clock", "x"])

    first = points.mapInArrow(race, "run int, clock double, x array<double>").groupBy("run").agg(F.min(F.struct("clock", "x")).alias("b")).collect()
    drawn = np.zeros((len(seeds), 1, d))
    for r in first:
        drawn[r.run, 0] = r.b.x
    return np.concatenate([centres, drawn], axis=1)


def kmeans(points: DataFrame, d: int, k: int, seeds: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """(centres (runs, k, d), costs) of one run per seed, all advancing in the same scans."""
    runs = len(seeds)
    centres = np.zeros((runs, 0, d))
    for _ in range(k):
        centres = _next_centres(points, d, centres, seeds)
    costs = np.zeros(runs)
    moving = list(range(runs))
    for step in range(MAX_STEPS + 1):
        now = centres[moving]

        def part(batch: pa.RecordBatch, now=now) -> np.ndarray:
            x, n = _points(batch, d), batch.column("n").to_numpy().astype(np.float64)
            out = []
            for own in now:
                far = _distances(x, own)
                at = np.argmin(far, axis=1)
                out.append(np.concatenate([np.bincount(at, weights=n, minlength=k), *(np.bincount(at, weights=n * x[:, i], minlength=k) for i in range(d)), [n @ far.min(axis=1)]]))
            return np.concatenate(out)

        added = _sums(points, part)
        if not len(added):
            return centres, costs
        still = []
        for run, cells in zip(moving, added.reshape(len(moving), -1), strict=True):
            size, total, costs[run] = cells[:k], cells[k: k * (d + 1)].reshape(d, k).T, cells[-1]
            means = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres[run])  # an empty cluster keeps its place
            if step < MAX_STEPS and ((means - centres[run]) ** 2).sum() > TOLERANCE:
                still.append(run)
                centres[run] = means
            elif step < MAX_STEPS and not np.array_equal(means, centres[run]):
                centres[run] = means  # the last small move; its cost is taken in one more scan
                still.append(run)
        moving = still
        if not moving:
            break
    return centres, costs


def nearest(centres: np.ndarray, x: Sequence[Column]) -> Column:
    """Number of the nearest centre (the first of equally near ones)."""
    far = F.array(*(sum(((c - float(v)) ** 2 for c, v in zip(x, centre, strict=True)), F.lit(0.0)) for centre in centres))
    return (F.array_position(far, F.array_min(far)) - 1).cast("int")


def silhouette(points: DataFrame, d: int, centres: np.ndarray, cells: int = CELLS) -> tuple[float, float]:
    """(silhouette, bound of its error) of the rows, each in the cluster of its nearest centre."""
    k = len(centres)
    names = [f"x{i}" for i in range(d)]
    labelled = points.withColumn("cluster", nearest(centres, [F.col(c) for c in names]))
    grid = _cells(labelled, names, cells)
    rows = sorted(grid.collect(), key=lambda r: r.cluster)
    if len({r.cluster for r in rows}) < 2:
        return 0.0, 0.0
    at = np.array([[r[c] for c in names] for r in rows])
    n, var = np.array([r.n for r in rows], dtype=np.float64), np.array([0.0 if r.different == 1 else max(0.0, r.var) for r in rows])
    here = np.array(sorted({r.cluster for r in rows}))
    start = np.searchsorted([r.cluster for r in rows], here)
    size = np.add.reduceat(n, start)
    place = np.full(k, -1)
    place[here] = np.arange(len(here))

    def part(batch: pa.RecordBatch) -> np.ndarray:
        x, weight, own = _points(batch, d), batch.column("n").to_numpy().astype(np.float64), place[batch.column("cluster").to_numpy()]
        out = np.zeros(3)
        for i in range(0, len(x), _CHUNK):
            square = _distances(x[i: i + _CHUNK], at)
            low = np.add.reduceat(np.sqrt(square) * n, start, axis=1)
            high = np.add.reduceat(np.sqrt(square + var) * n, start, axis=1)
            mine, w = own[i: i + _CHUNK], weight[i: i + _CHUNK]
            each = np.arange(len(mine))
            others = size[mine] - 1
            single = others < 1
            a = [s[each, mine] / np.where(single, 1.0, others) for s in (low, high)]
            b = []
            for s in (low, high):
                means = s / size
                means[each, mine] = np.inf
                b.append(means.min(axis=1))

            def score(a, b):
                most = np.maximum(a, b)
                return np.where(single | (most == 0), 0.0, (b - a) / np.where(most > 0, most, 1.0))

            out += w @ score(a[1], b[0]), w @ score(a[0], b[1]), w.sum()
        return out

    low, high, total = _sums(labelled.select(*names, "n", "cluster"), part)
    return float((low + high) / total / 2), float((high - low) / total / 2)


def _cells(labelled: DataFrame, names: Sequence[str], cells: int) -> DataFrame:
    """Per cluster and cell: rows, their mean, their variance around it, different rows.  The finest grid of at most ``cells`` cells."""
    by: list[Column] = [F.col(c) for c in names]
    if labelled.count() > cells:
        bounds = labelled.agg(*(f(c) for c in names for f in (F.min, F.max))).first()
        ranges = [(bounds[2 * i], max(bounds[2 * i + 1] - bounds[2 * i], 1e-300)) for i in range(len(names))]

        def cut(bits: int) -> list[Column]:
            return [F.least(F.floor((F.col(c) - low) / width * 2 ** bits), F.lit(2 ** bits - 1)) for c, (low, width) in zip(names, ranges, strict=True)]

        sizes = labelled.agg(*(F.approx_count_distinct(F.xxhash64("cluster", *cut(b))).alias(str(b)) for b in range(1, 21))).first()
        bits = max([b for b in range(1, 21) if sizes[str(b)] <= 0.9 * cells], default=0)
        while bits and labelled.select("cluster", *(c.alias(n) for n, c in zip(names, cut(bits), strict=True))).distinct().count() > cells:
            bits -= 1
        by = cut(bits)
    means = [(F.sum(F.col("n") * F.col(c)) / F.sum("n")).alias(c) for c in names]
    square = sum(((F.sum(F.col("n") * F.col(c) ** 2) / F.sum("n") - (F.sum(F.col("n") * F.col(c)) / F.sum("n")) ** 2) for c in names), F.lit(0.0))
    return labelled.groupBy("cluster", *(c.alias(f"cell_{n}") for n, c in zip(names, by, strict=True))).agg(
        *means, square.alias("var"), F.sum("n").alias("n"), F.count("*").alias("different")).select("cluster", *names, "var", "n", "different")
