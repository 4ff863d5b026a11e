"""Source divergence audit (operator 13): how far each (lang, source) group's term distribution is from its peers'.

The divergence of group g from group h of its language is the sum over the language's V kept terms of
f(p, q) = floor((p - q)^2 / q), with p = 1 + floor(10^9 (n + 1) / (N + V)) of g's count n and total N, and q that of h.
It is the product of a sparse matrix (groups by terms) with itself under f, built row by row (Gustavson):

* The *term-major index* has one row per (lang, term) with its postings, the sources that use it and how often.
* A task holds a block of the index (about ``BLOCK_POSTINGS`` postings of one language).  For each group it gathers the
  postings of the group's terms and scatters them into a dense accumulator with one cell per peer; only the accumulators
  leave the task, never a pair of postings.
* An absent term has the group's baseline z = 1 + floor(10^9 / (N + V)), not zero.  Over the whole vocabulary that is
  V f(z_g, z_h); the terms of one side alone correct it by f(p, z_h) - f(z_g, z_h) (taken once per distinct p), and the
  terms of both sides by f(p, q) - f(p, z_h) - f(z_g, q) + f(z_g, z_h), which is what is scattered.

All of it is integer arithmetic.  Hot groups do not matter: counts are added up in the mappers before they are shuffled,
a block is made of terms, not of a group's rows, and blocks of many groups are cut by ``ROW_GROUPS`` groups as well.

Defined results: null text, lang and source read as ''; a group without kept terms has N = 0; a language without kept
terms (V = 0) gives pairs of value 0 and no terms; a language with one source has no pairs; repeated rows count as often
as they stand; ties are ranked by item; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagelens.llm.shared import written
from wagelens.llm.text_kernel import string_chunks

SCALE = 1_000_000_000
MIN_DOCS = 3
TOP_TERMS = 200
#: Postings of a block of the index, groups whose rows a task works out, and postings gathered at a time.
BLOCK_POSTINGS = 400_000
ROW_GROUPS = 500
GATHER = 1_000_000
#: Distinct (group, term) counts that a task holds before it hands them on.
HELD_TERMS = 300_000

_TERM = np.full(256, 0x20, dtype=np.uint8)
_TERM[0x41:0x5B] = np.arange(0x61, 0x7B)
_TERM[0x61:0x7B] = np.arange(0x61, 0x7B)
_TERM[0x80:] = np.arange(0x80, 0x100)
_TERM_BYTES = _TERM.tobytes()

_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("d", pa.int64())])
_CELLS = pa.schema([("lang", pa.string()), ("g", pa.int32()), ("h", pa.int32()), ("part", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, text -> occurrences and documents per (lang, source, term), added up over the task's rows."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def release() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, d) in held.items():
            if n:
                terms = list(n)
                yield pa.RecordBatch.from_arrays([
                    pa.repeat(pa.scalar(lang), len(terms)), pa.repeat(pa.scalar(source), len(terms)),
                    pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n.values(), pa.int64()),
                    pa.array([d[t] for t in terms], pa.int64())], schema=_COUNTS)
        held.clear()

    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for first, offsets, data in string_chunks(batch.column("text")):
            text, at = data.tobytes().translate(_TERM_BYTES), offsets.tolist()
            for i in range(len(at) - 1):
                if terms := text[at[i]: at[i + 1]].split():
                    n, d = held.setdefault((langs[first + i], sources[first + i]), (Counter(), Counter()))
                    n.update(terms)
                    d.update(set(terms))
            if sum(len(n) for n, _ in held.values()) > HELD_TERMS:
                yield from release()
    yield from release()


def term_index(docs: DataFrame) -> DataFrame:
    """The term-major index: lang, term, n (its occurrences) and postings (source, n), for terms of MIN_DOCS documents and more."""
    counts = docs.mapInArrow(_count, "lang string, source string, term string, n long, d long")
    per_group = counts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    return (per_group.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"), F.collect_list(F.struct("source", "n")).alias("postings"))
            .filter(F.col("d") >= MIN_DOCS).drop("d"))


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE (n + 1) / total); by Python's integers where the product leaves 64 bits."""
    if len(n) and int(n.max()) > 9_000_000_000:
        return np.array([1 + SCALE * (int(a) + 1) // int(b) for a, b in zip(n, total, strict=True)], dtype=np.int64)
    return 1 + SCALE * (n + 1) // total


def _scatter(block: pa.Table, groups: pa.Table) -> pa.Table:
    """One block of the index against the language's groups: the corrections of every (group, peer) of the slice."""
    if block.num_rows == 0 or groups.num_rows == 0:
        return _CELLS.empty_table()
    groups = groups.sort_by("g")
    lang, low = groups.column("lang")[0].as_py(), groups.column("slice")[0].as_py() * ROW_GROUPS
    total = groups.column("total").to_numpy().astype(np.int64)
    z = 1 + SCALE // total
    postings = block.column("postings").combine_chunks()
    ends = np.r_[0, np.cumsum(pc.list_value_length(postings).to_numpy())]
    flat = postings.flatten()
    peer = pc.index_in(flat.field("source"), groups.column("source").combine_chunks()).to_numpy().astype(np.int64)
    p = _shares(flat.field("n").to_numpy().astype(np.int64), total[peer])
    term = np.repeat(np.arange(len(postings)), np.diff(ends))
    by_group = np.argsort(peer, kind="stable")
    bounds = np.searchsorted(peer[by_group], np.arange(len(z) + 1))
    rows, peers, parts = [], [], []
    everyone = np.arange(len(z), dtype=np.int64)
    for g in range(low, min(low + ROW_GROUPS, len(z))):
        own = by_group[bounds[g]: bounds[g + 1]]
        if not len(own):
            continue
        cells = np.zeros(len(z), dtype=np.int64)
        length = ends[term[own] + 1] - ends[term[own]]
        cut = np.searchsorted(np.cumsum(length), np.arange(0, int(length.sum()) + GATHER, GATHER), side="left")
        for a, b in zip(cut[:-1], np.r_[cut[1:-1], len(own)], strict=True):
            if a < b:
                n = length[a:b]
                at = np.repeat(ends[term[own[a:b]]] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(int(n.sum()))
                mine, h, q = np.repeat(p[own[a:b]], n), peer[at], p[at]
                np.add.at(cells, h, _distance(mine, q) - _distance(mine, z[h]) - _distance(z[g], q) + _distance(z[g], z[h]))
        other = np.zeros(len(z), dtype=np.int64)
        for value, times in zip(*np.unique(p[own], return_counts=True), strict=True):
            cells += times * (_distance(value, z) - _distance(z[g], z))
            other += times * (_distance(z, value) - _distance(z, z[g]))
        own_cells = np.full(len(z), g, dtype=np.int64)
        rows += [own_cells, everyone]
        peers += [everyone, own_cells]
        parts += [cells, other]
    if not rows:
        return _CELLS.empty_table()
    g, h = np.concatenate(rows), np.concatenate(peers)
    return pa.table([pa.repeat(pa.scalar(lang), len(g)), pa.array(g.astype(np.int32)), pa.array(h.astype(np.int32)), pa.array(np.concatenate(parts))], schema=_CELLS)


def _exact(n: str, total: str) -> str:
    return f"1 + CAST({SCALE} AS DECIMAL(10)) * (CAST({n} AS DECIMAL(19)) + 1) div CAST({total} AS DECIMAL(20))"


def _ranked(df: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def audit(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank: each group's divergence from its peers, and its 200 most over-used terms."""
    read = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    index = written(term_index(read), "term-index")
    postings = index.select("lang", "term", F.col("n").alias("n_lang"), F.inline("postings"))
    langs = index.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("total_lang"), F.sum(F.size("postings")).alias("postings"))
    # One number per source of a language: the language's sources only, never rows of documents.
    numbered = read.groupBy("lang", "source").count().select(
        "lang", "source", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("g"))
    groups = written(
        numbered.join(postings.groupBy("lang", "source").agg(F.sum("n").alias("n_group")), ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", "g", F.coalesce("v", F.lit(0)).alias("v"), "total_lang",
                (F.coalesce("n_group", F.lit(0)) + F.coalesce("v", F.lit(0))).alias("total"),
                F.ceil(F.coalesce("postings", F.lit(0)) / BLOCK_POSTINGS).cast("int").alias("blocks"),
                F.ceil(F.count("*").over(Window.partitionBy("lang")) / ROW_GROUPS).cast("int").alias("slices")), "groups")
    used = groups.filter("blocks > 0")
    cut = used.groupBy("lang").agg(F.max("blocks").alias("blocks"), F.max("slices").alias("slices"))
    blocked = (index.join(cut, "lang").withColumn("block", F.expr("pmod(xxhash64(term), blocks)").cast("int"))
               .select("lang", "block", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "postings"))
    spread = used.select("lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "slices", "source", "g", "total") \
        .select("lang", "block", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "source", "g", "total")
    key = ["lang", "block", "slice"]
    cells = (blocked.groupBy(*key).cogroup(spread.groupBy(*key)).applyInArrow(_scatter, "lang string, g int, h int, part long")
             .groupBy("lang", "g", "h").agg(F.sum("part").alias("part")))
    one = groups.select("lang", "source", "g", "v", "total")
    two = groups.select("lang", F.col("source").alias("item"), F.col("g").alias("h"), F.col("total").alias("total_h"))
    z, zh = f"(1 + {SCALE} div total)", f"(1 + {SCALE} div total_h)"
    pairs = (one.join(two, "lang").filter("g <> h").join(cells, ["lang", "g", "h"], "left")
             .withColumn("value", F.expr(f"CASE WHEN v = 0 THEN 0 ELSE v * (({z} - {zh}) * ({z} - {zh}) div {zh}) + coalesce(part, 0) END")))
    shares = (postings.join(groups, ["lang", "source"])
              .select("lang", "source", F.col("term").alias("item"), F.expr(_exact("n", "total")).alias("p"), F.expr(_exact("n_lang", "total_lang + v")).alias("q")))
    terms = _ranked(shares.filter("p > q").withColumn("value", F.expr("(p - q) * (p - q) div q")), "term").filter(F.col("rank") <= TOP_TERMS)
    return _ranked(pairs, "pair").unionByName(terms)
