"""Shared stages of the two exact repeated-span operators (token De Bruijn graph, sparse suffix array).

A document is a row; its surrogate key is the first 64 bits of the md5 of (doc_id, text), so null ids work, identical
repeated rows are treated alike, and rows of one id have an order that SQL can state.  Only minimiser k-grams leave the first pass (about 2/(length-k+2) of all words), packed per
Arrow batch and k-gram: a passage that a third of all rows share costs one row per batch, not one per occurrence.

Stages, each one shuffle:

1. ``anchor_rows``    the k-gram that owns a run of windows, hash of those windows and one word more on either side,
                      coordinates;
2. ``mark_documents`` repeated k-grams, marked 1 if every visit has the same context (nonbranching), else 0, and sent
                      back to their documents;
3. ``candidate_rows`` per document: adjoining windows of nonbranching k-grams become one path row; each window of a
                      branching k-gram becomes a row of its own; two 64-bit hashes of the text at these coordinates;
4. ``settle``         rows of equal text met twice or more are repeats; coordinates go back to their documents.

A window that occurs twice is owned by the same k-gram at the same offset in both places, so the windows of a k-gram
seen once are not repeated.  All visits of a nonbranching k-gram agree one word beyond its windows, hence also on the
neighbouring windows and their owners: adjoining nonbranching k-grams are visited together, and their path is one
text.  The result is exact but for hash collisions.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagelens.llm.text_kernel import Words, minimisers, mix, window_hashes, words_of

KEY = "_row_key"
PACKED_FROM = 64
_COORD = np.dtype([("key", "<i8"), ("doc", "<i8"), ("pos", "<i4"), ("len", "<i4")])
ROWS = "h1 long, h2 long, n int, first_doc long, first_key long, first_pos int, coords binary, zipped boolean"


def keyed(docs: DataFrame) -> DataFrame:
    """One struct with all input columns but the text (so no name can clash), the order id, the text and the surrogate key.

    Both joins on the key take all four columns, so the texts are shuffled once and the exchange is reused.
    """
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"),
        F.coalesce(doc_id, F.lit(-(2**63))).alias("ord"), F.col("text").cast("string").alias("text"),
        # never null, and known to be: a filter on one of the joins would keep the exchange from being reused
        F.coalesce(F.conv(F.substring(F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("null")), F.coalesce(F.col("text"), F.lit("null")))), 1, 16), 16, -10)
                   .cast("long"), F.lit(0).cast("long")).alias(KEY))


def _pack(h1: np.ndarray, h2: np.ndarray, coords: np.ndarray, mixed_is_zero: bool) -> pa.RecordBatch:
    """One row per h1 (mixed_is_zero: h2 becomes 0 where it differs within h1) or per (h1, h2), with all coordinates."""
    place = (coords["pos"], coords["key"], coords["doc"])
    order = np.lexsort((*place, h2, h1) if not mixed_is_zero else (*place, h1))
    h1, h2, coords = h1[order], h2[order], coords[order]
    n = len(h1)
    new = np.ones(n, dtype=bool)
    new[1:] = h1[1:] != h1[:-1]
    if not mixed_is_zero:
        new[1:] |= h2[1:] != h2[:-1]
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, n))
    key2 = h2[first]
    if mixed_is_zero and n:
        key2 = np.where(np.minimum.reduceat(h2, first) == np.maximum.reduceat(h2, first), key2, np.uint64(0))
    big = size > PACKED_FROM
    width = _COORD.itemsize
    raw = coords.view(np.uint8).reshape(-1) if n else np.zeros(0, np.uint8)
    if big.any():
        parts = [raw[a * width: (a + s) * width].tobytes() for a, s in zip(first.tolist(), size.tolist(), strict=True)]
        column = pa.array([zlib.compress(p, 1) if z else p for p, z in zip(parts, big.tolist(), strict=True)], pa.binary())
    else:
        offsets = np.append(first, n).astype(np.int64) * width
        column = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]).cast(pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(h1[first].view(np.int64)), pa.array(key2.view(np.int64)), pa.array(size.astype(np.int32)),
         pa.array(coords["doc"][first]), pa.array(coords["key"][first]), pa.array(coords["pos"][first]), column, pa.array(big)],
        names=["h1", "h2", "n", "first_doc", "first_key", "first_pos", "coords", "zipped"])


def _coordinates(words: Words, keys: np.ndarray, order_ids: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    doc = words.doc[at] if len(at) else np.zeros(0, dtype=np.int64)
    out = np.empty(len(at), dtype=_COORD)
    out["key"], out["doc"] = keys[words.first + doc], order_ids[words.first + doc]
    out["pos"], out["len"] = at - words.indptr[doc], length
    return out


def _contexts(words: Words, hashes: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """Hash of all windows that a minimiser owns, and of one word more on either side; document edges count as such."""
    doc = words.doc[at]
    lo = np.maximum(first - 1, words.indptr[doc])
    hi = np.minimum(last + length + 1, words.indptr[doc + 1])
    place = (at - lo).astype(np.uint64) * np.uint64(4) + (lo < first).astype(np.uint64) * np.uint64(2) + (hi > last + length)
    return np.maximum(mix(window_hashes(hashes, lo, hi, second=False)[0] + place), np.uint64(1))


def _anchors(length: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = (np.asarray(batch.column(c)) for c in (KEY, "ord"))
            h1, h2, coords = [], [], []
            for words in words_of(batch.column("text")):
                hashes = words.word_hashes()
                at, grams, first, last = minimisers(words, hashes, k, length)
                if len(at):
                    h1.append(grams)
                    h2.append(_contexts(words, hashes, at, first, last, length))
                    coords.append(_coordinates(words, keys, ids, at, np.full(len(at), k)))
            if h1:
                yield _pack(np.concatenate(h1), np.concatenate(h2), np.concatenate(coords), mixed_is_zero=True)
    return run


def anchor_rows(docs: DataFrame, length: int, k: int) -> DataFrame:
    """h1: k-gram at a minimiser; h2: its context, 0 if the contexts of one batch differ; packed coordinates."""
    return docs.select(KEY, "ord", "text").mapInArrow(_anchors(length, k), ROWS)


def _unpack(value: Callable[[np.ndarray, dict[str, np.ndarray]], np.ndarray], fields: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            zipped = np.asarray(batch.column("zipped"))
            blobs = [zlib.decompress(b) if z else b for b, z in zip(batch.column("coords").to_pylist(), zipped.tolist(), strict=True)]
            coords = np.frombuffer(b"".join(blobs), dtype=_COORD)
            of = np.repeat(np.arange(batch.num_rows), np.asarray(batch.column("n")))
            more = {f: np.asarray(batch.column(f))[of] for f in fields}
            more["head"] = np.r_[True, of[1:] != of[:-1]] if len(of) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(coords["key"])), pa.array(value(coords, more))],
                                             names=[KEY, "v"])
    return run


def mark_documents(rows: DataFrame) -> DataFrame:
    """Per document with repeated k-grams: array of 2 * position + (1 if the k-gram is nonbranching)."""
    def value(coords: np.ndarray, more: dict[str, np.ndarray]) -> np.ndarray:
        return coords["pos"].astype(np.int64) * 2 + more["straight"]
    marked = rows.select("n", "coords", "zipped", "straight").mapInArrow(_unpack(value, ("straight",)), f"{KEY} long, v long")
    return marked.groupBy(KEY).agg(F.collect_list("v").alias("marks"))


def _candidates(length: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = (np.asarray(batch.column(c)) for c in (KEY, "ord"))
            marks = batch.column("marks")
            mark_ends = np.asarray(marks.offsets).astype(np.int64)
            marks = np.asarray(marks.values)
            h1, h2, coords = [], [], []
            for words in words_of(batch.column("text")):
                hashes = words.word_hashes()
                n = len(hashes)
                lo, hi = mark_ends[words.first], mark_ends[words.first + words.n_docs]
                marked = marks[lo:hi]
                at = np.repeat(words.indptr[:-1], np.diff(mark_ends[words.first: words.first + words.n_docs + 1])) + marked // 2
                owner, _, first, last = minimisers(words, hashes, k, length)
                state = np.zeros(n, dtype=np.int8)
                state[at] = 1 + marked % 2
                state = state[owner]
                path = np.flatnonzero(state == 2)
                # consecutive nonbranching owners whose windows adjoin make one path
                joint = np.r_[False, (np.diff(path) == 1) & (first[path[1:]] == last[path[:-1]] + 1)] if len(path) else path
                head = np.flatnonzero(~joint.astype(bool))
                start = first[path[head]]
                stop = last[path[np.append(head[1:], len(path)) - 1]] + length if len(path) else start
                branching = state == 1
                size = (last - first + 1)[branching]
                alone = np.repeat(first[branching] - np.r_[0, np.cumsum(size)[:-1]] if len(size) else size, size) + np.arange(size.sum())
                start, stop = np.append(alone, start), np.append(alone + length, stop)
                if not len(start):
                    continue
                one, two = window_hashes(hashes, start, stop)
                h1.append(one)
                h2.append(two)
                coords.append(_coordinates(words, keys, ids, start, stop - start))
            if h1:
                yield _pack(np.concatenate(h1), np.concatenate(h2), np.concatenate(coords), mixed_is_zero=False)
    return run


def candidate_rows(docs: DataFrame, marks: DataFrame, length: int, k: int) -> DataFrame:
    """h1, h2: text hashes of candidate spans (paths of windows, or single windows), with packed coordinates."""
    return docs.join(marks, KEY).select(KEY, "ord", "text", "marks", "row").mapInArrow(_candidates(length, k), ROWS)


def settle(rows: DataFrame, earlier: Column) -> DataFrame:
    """Per document: array of start * 2^32 + 2 * length + flag for every candidate whose text occurs twice or more.

    ``earlier`` says of a packed row whether its text also occurs before the row's first coordinate; the flag is 0
    only for the first occurrence of all.
    """
    same = Window.partitionBy("h1", "h2")
    met = rows.withColumn("total", F.sum("n").over(same)).withColumn("earlier", earlier).filter("total >= 2")

    def value(coords: np.ndarray, more: dict[str, np.ndarray]) -> np.ndarray:
        at_first = (coords["doc"] == more["first_doc"]) & (coords["key"] == more["first_key"]) & (coords["pos"] == more["first_pos"])
        flag = ~at_first | more["earlier"]
        return (coords["pos"].astype(np.int64) << 32) + coords["len"].astype(np.int64) * 2 + flag
    spans = met.select("n", "coords", "zipped", "first_doc", "first_key", "first_pos", "earlier").mapInArrow(
        _unpack(value, ("first_doc", "first_key", "first_pos", "earlier")), f"{KEY} long, v long")
    return spans.groupBy(KEY).agg(F.collect_list("v").alias("spans"))


def covered(spans: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of n words: those in any repeated span, and those in a span that also occurs earlier."""
    start, length = spans >> 32, (spans & 0xFFFFFFFF) >> 1
    out = []
    for chosen in (np.ones(len(spans), dtype=bool), (spans & 1) == 1):
        edges = np.zeros(n + 1, dtype=np.int32)
        np.add.at(edges, start[chosen], 1)
        np.add.at(edges, start[chosen] + length[chosen], -1)
        out.append(np.cumsum(edges[:n]) > 0)
    return out[0], out[1]
