"""Benchmark decontamination (operator 1) over a distributed positional inverted index.

``build_index`` turns documents into index segments, one row per run of documents of about 2 MB: for every term its
sorted list of word positions.  The index is partitioned by document, as phrases never cross documents, so building and
searching it needs no shuffle; it can be written and searched again for another benchmark.  Only terms of a given
vocabulary are stored when one is passed.

``search`` takes the benchmark's phrases (windows of ``WINDOW`` consecutive words; a shorter item is one phrase).  Per
phrase the terms are ordered by how often they occur in the whole corpus; the positions of the rarest term give
candidate starts, and the lists of the other terms, shifted by their offsets, are intersected with them one after the
other by binary search.  With ``slop`` > 0 a term may stand up to that many words from its exact place (proximity
match).

The benchmark is taken in blocks of at most ``BLOCK_CHARS`` characters, so what is broadcast is bounded; more blocks
mean more passes over the index.

Defined results: null or wordless texts have no words and no hits, wordless items no phrases; null item ids appear as
``null`` in lists; benchmark rows of one item id, or of none, count as one item; repeated rows are answered alike;
other columns are not read; with an empty benchmark no document has a hit; an empty document table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens.llm import repeats
from wagelens.llm.shared import written
from wagelens.llm.text_kernel import ALNUM, Words, words_of

WINDOW = 10
BLOCK_CHARS = 16_000_000
#: Contaminated rows up to which they are taken out by a broadcast join; beyond, by a shuffled one.
BROADCAST_KEYS = 500_000
SEGMENT = ("doc_ids array<long>, doc_starts array<int>, terms array<long>, term_starts array<int>, positions array<int>")


def _terms(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[Words, np.ndarray]]:
    for words in words_of(column, ALNUM, lower=True):
        yield words, words.word_hashes().view(np.int64)


def _lists(array: np.ndarray) -> pa.Array:
    """One list holding the whole array."""
    return pa.ListArray.from_arrays(pa.array([0, len(array)], pa.int32()), pa.array(array))


def _segments(vocabulary) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if vocabulary is None else vocabulary.value
        for batch in batches:
            ids = batch.column("doc_id")
            for words, term in _terms(batch.column("text")):
                at = np.arange(len(term))
                if known is not None:
                    at = at[_find(known, term) >= 0]
                order = at[np.argsort(term[at], kind="stable")]
                sorted_ = term[order]
                first = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]]) if len(order) else order
                own = ids.slice(words.first, words.n_docs)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own), _lists(words.indptr.astype(np.int32)),
                     _lists(sorted_[first]), _lists(np.append(first, len(order)).astype(np.int32)), _lists(order.astype(np.int32))],
                    names=["doc_ids", "doc_starts", "terms", "term_starts", "positions"])
    return run


def _find(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Index of each value in the sorted array, -1 where it isn't there."""
    if not len(known):
        return np.full(len(values), -1, dtype=np.int64)
    i = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[i] == values, i, -1)


def build_index(docs: DataFrame, vocabulary: np.ndarray | None = None) -> DataFrame:
    """Index segments of doc_id and text; vocabulary: sorted term hashes to keep (all terms if None)."""
    shared = None if vocabulary is None else docs.sparkSession.sparkContext.broadcast(vocabulary)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _segments(shared), SEGMENT)


@dataclass
class Phrases:
    """Phrases of one benchmark block: items, lengths, and per phrase its term indexes (-1 past the end)."""

    item_ids: list[str]
    vocabulary: np.ndarray
    item: np.ndarray
    length: np.ndarray
    term: np.ndarray
    n_blocks: int = 1


def phrases(item_ids: list, texts: list[str | None], window: int = WINDOW) -> Phrases:
    """All windows of the items, once per item id: rows that share an id (or have none) are one item."""
    rows, items = [], []
    names: dict[str, int] = {}
    number = [names.setdefault("null" if x is None else str(x), len(names)) for x in item_ids]
    for words, term in _terms(pa.array(texts, pa.string())):
        for i in range(words.n_docs):
            own = term[words.indptr[i]: words.indptr[i + 1]]
            if len(own):
                found = np.lib.stride_tricks.sliding_window_view(own, min(window, len(own)))
                found = np.unique(found, axis=0)
                rows.append(found)
                items.extend([number[words.first + i]] * len(found))
    vocabulary = np.unique(np.concatenate([r.ravel() for r in rows])) if rows else np.zeros(0, dtype=np.int64)
    term = np.full((len(items), window), -1, dtype=np.int64)
    at = 0
    for r in rows:
        term[at: at + len(r), : r.shape[1]] = _find(vocabulary, r.ravel()).reshape(r.shape)
        at += len(r)
    return Phrases(list(names), vocabulary, np.array(items, dtype=np.int64),
                   (term >= 0).sum(axis=1), term)


def document_frequencies(index: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Occurrences of each vocabulary term in the whole index (at most one row per term and task is shuffled)."""
    shared = index.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), dtype=np.int64)
        for batch in batches:
            for terms, starts in zip(batch.column("terms"), batch.column("term_starts"), strict=True):
                at = _find(shared.value, np.asarray(terms.values))
                np.add.at(total, at[at >= 0], np.diff(np.asarray(starts.values))[at >= 0])
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["term", "n"])

    out = np.zeros(len(vocabulary), dtype=np.int64)
    for r in index.select("terms", "term_starts").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r.term] = r.n
    return out


def match(p: Phrases, order: np.ndarray, doc_starts: np.ndarray, terms: np.ndarray, term_starts: np.ndarray,
          positions: np.ndarray, slop: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrase, start, document) of every occurrence in one segment; order: per phrase its offsets, rarest term first."""
    if not len(positions) or not len(p.item):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    place = _find(terms, p.vocabulary)
    empty = len(terms)
    starts = np.append(term_starts, term_starts[-1]).astype(np.int64)
    n = int(doc_starts[-1])
    # lists one after the other as one ascending key: list number * n + position
    key = np.repeat(np.arange(len(terms)), np.diff(term_starts)) * n + positions
    every = np.arange(len(p.item))

    def lists(offset: np.ndarray, which: np.ndarray) -> np.ndarray:
        t = p.term[which, offset]
        return np.where(t >= 0, place[t], -1)

    rarest = lists(order[:, 0], every)
    use = np.flatnonzero(rarest >= 0)
    own = rarest[use]
    size = starts[own + 1] - starts[own]
    which = np.repeat(use, size)
    within = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
    at = positions[np.repeat(starts[own], size) + within].astype(np.int64)
    start = at - order[which, 0]
    doc = np.searchsorted(doc_starts, at, side="right") - 1
    fits = (start >= doc_starts[doc]) & (start + p.length[which] <= doc_starts[doc + 1])
    if slop:
        fits = np.ones(len(at), dtype=bool)
    which, start, doc = which[fits], start[fits], doc[fits]
    for step in range(1, order.shape[1]):
        todo = step < p.length[which]
        offset = np.where(todo, order[which, min(step, order.shape[1] - 1)], 0)
        own = np.where(todo, lists(offset, which), empty)
        wanted = np.where(own >= 0, own, 0) * n + start + offset
        if slop:
            low = np.maximum(start + offset - slop, doc_starts[doc])
            high = np.minimum(start + offset + slop, doc_starts[doc + 1] - 1)
            base = np.where(own >= 0, own, 0) * n
            ok = np.searchsorted(key, base + high, side="right") > np.searchsorted(key, base + low)
        else:
            i = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
            ok = key[i] == wanted
        keep = ~todo | ((own >= 0) & ok)
        which, start, doc = which[keep], start[keep], doc[keep]
    return which, start, doc


def _answers(shared, slop: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, order = shared.value
        for batch in batches:
            for ids, *arrays in zip(*(batch.column(c) for c in ("doc_ids", "doc_starts", "terms", "term_starts", "positions")), strict=True):
                doc_starts, terms, term_starts, positions = (np.asarray(a.values) for a in arrays)
                which, start, doc = match(p, order, doc_starts.astype(np.int64), terms, term_starts, positions, slop)
                n = int(doc_starts[-1])
                # a proximity match may reach over its document's ends
                stop = np.minimum(start + p.length[which], doc_starts[doc + 1])
                start = np.maximum(start, doc_starts[doc])
                edge = np.zeros(n + 1, dtype=np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, stop, -1)
                hit = np.r_[0, np.cumsum(np.cumsum(edge[:n]) > 0)]
                n_hit = np.diff(hit[doc_starts])
                pairs = np.unique(doc * np.int64(max(len(p.item_ids), 1)) + p.item[which])
                found: list[list[str]] = [[] for _ in range(len(doc_starts) - 1)]
                for x in pairs.tolist():
                    found[x // len(p.item_ids)].append(p.item_ids[x % len(p.item_ids)])
                spans: list[list[int]] = [[] for _ in found]
                for d, s, size in zip(doc.tolist(), (start - doc_starts[doc]).tolist(), (stop - start).tolist(), strict=True):
                    spans[d].append((s << 24) + size)
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array(np.diff(doc_starts).astype(np.int64)), pa.array(n_hit.astype(np.int64)),
                     pa.array(found, pa.list_(pa.string())), pa.array([sorted(set(s)) for s in spans], pa.list_(pa.int64()))],
                    names=["doc_id", "n_words", "n_hit", "items", "spans"])
    return run


ANSWER = "doc_id long, n_words long, n_hit long, items array<string>, spans array<long>"


def search(index: DataFrame, p: Phrases, slop: int = 0) -> DataFrame:
    """doc_id, n_words, n_hit, items and spans (start * 2^24 + length, in words) of every indexed document."""
    often = document_frequencies(index, p.vocabulary)
    weight = np.where(p.term >= 0, often[p.term] if len(often) else 0, np.iinfo(np.int64).max)
    shared = index.sparkSession.sparkContext.broadcast((p, np.argsort(weight, axis=1, kind="stable")))
    return index.mapInArrow(_answers(shared, slop), ANSWER)


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS, window: int = WINDOW) -> Iterator[Phrases]:
    """The benchmark's phrases, block by block."""
    total = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(2 * total / block_chars))
    part = benchmark.withColumn("_part", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    for i in range(n):
        rows = part.filter(F.col("_part") == i).select("item_id", "text").collect() if n > 1 else benchmark.select("item_id", "text").collect()
        found = phrases([r.item_id for r in rows], [r.text for r in rows], window)
        found.n_blocks = n
        yield found


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        items = [sorted(x) for x in batch.column("items").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), batch.column("n_hit"), pa.array([len(x) for x in items], pa.int64()),
             pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]),
             pa.array([n > 0 for n in batch.column("n_hit").to_pylist()])],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union of the blocks' answers for one document: items together, hit words counted once."""
    for batch in batches:
        hits = []
        for spans in batch.column("spans").to_pylist():
            covered, end = 0, 0
            for s in sorted(spans):
                a, b = s >> 24, (s >> 24) + (s & 0xFFFFFF)
                covered += max(0, b - max(a, end))
                end = max(end, b)
            hits.append(covered)
        yield batch.drop_columns(["n_hit", "spans"]).append_column("n_hit", pa.array(hits, pa.int64()))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, n_words, n_hit and items of every document."""
    keyed = repeats.keyed(docs.select("doc_id", "text"))
    found = None
    for i, p in enumerate(blocks(benchmark, block_chars, window)):
        # the answers of several blocks meet again under the rows' keys
        own = keyed.select(F.col(repeats.KEY).alias("doc_id"), "text") if p.n_blocks > 1 else docs
        answer = search(build_index(own, p.vocabulary), p)
        if p.n_blocks == 1:
            return answer.drop("spans")
        answer = answer.withColumn("block", F.lit(i))
        found = answer if found is None else found.unionByName(answer)
    # identical rows share a key and an answer, given back as often as they occur
    merged = found.withColumnRenamed("doc_id", repeats.KEY).groupBy(repeats.KEY).agg(
        F.max("n_words").alias("n_words"), F.sum((F.col("block") == 0).cast("int")).alias("times"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"), F.lit(0).cast("long").alias("n_hit"))
    answered = merged.mapInArrow(_merge, f"{repeats.KEY} long, n_words long, times long, items array<string>, n_hit long")
    ids = keyed.select(repeats.KEY, F.col("row")["doc_id"].cast("long").alias("doc_id")).distinct()
    each = answered.join(ids, repeats.KEY).withColumn("_t", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return each.select("doc_id", "n_words", "n_hit", "items")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark phrase occurs, with all their columns as they were."""
    keyed = repeats.keyed(docs)
    found = hits(keyed.select(F.col(repeats.KEY).alias("doc_id"), "text"), benchmark)
    bad = written(found.filter("n_hit > 0").select(F.col("doc_id").alias(repeats.KEY)).distinct(), "contaminated")
    few = bad.count() <= BROADCAST_KEYS
    kept = keyed.join(F.broadcast(bad) if few else bad, repeats.KEY, "left_anti")
    return kept.select(*[(F.col("text") if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns])


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated, one row per document."""
    return hits(docs, benchmark).select("doc_id", "n_words", "n_hit", "items").mapInArrow(
        _finish, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")
