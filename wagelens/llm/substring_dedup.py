"""Substring deduplication (operator 5): exact, by token k-grams and their contexts and not by compacting a graph.

This borrows from the De Bruijn graph, but builds no edge table and joins no paths.  Token k-grams at minimiser positions
are grouped by hash; one that is met twice or more, always with one context hash, is unambiguous.  The marks of repeated
k-grams are joined back to the documents, where runs of unambiguous ones become one span, and the words at the source
coordinates of each span (and of each window at an ambiguous k-gram) are compared by two hashes before anything is removed.

Result: every word covered by a window of ``length`` consecutive words whose sequence also starts anywhere else (same
document included, overlapping included) is removed; windows are judged on the input.

Defined results: null or empty text has 0 words and the hash of the empty string; texts shorter than ``length`` words
lose nothing; rows with null or repeated doc_id are documents of their own, so two identical rows repeat each other;
other columns are never read, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagelens.llm import repeats

LENGTH = 35
EDGE_WORDS = 18


def graph_edges(docs: DataFrame, length: int, k: int) -> DataFrame:
    """Repeated k-grams with their packed coordinates; ``straight`` is 1 where no visit branches."""
    node = Window.partitionBy("h1")
    visits = (repeats.anchor_rows(docs, length, k)
              .withColumn("visits", F.sum("n").over(node))
              .withColumn("least", F.min("h2").over(node)).withColumn("most", F.max("h2").over(node)))
    straight = (F.col("least") == F.col("most")) & (F.col("least") != 0)
    return visits.filter("visits >= 2").withColumn("straight", straight.cast("int"))


def repeated_spans(keyed: DataFrame, length: int = LENGTH, k: int = EDGE_WORDS) -> DataFrame:
    """Row key and spans (see ``repeats.settle``) of every document with a repeated window."""
    marks = repeats.mark_documents(graph_edges(keyed, length, k))
    return repeats.settle(repeats.candidate_rows(keyed, marks, length, k), F.lit(False))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {"doc_id": batch.column("row").field("doc_id"), "n_words": [], "n_removed": [], "kept_sha256": []}
        spans = batch.column("spans")
        for text, own in zip(batch.column("text"), spans, strict=True):
            words = (text.as_py() or "").encode().split()
            removed = 0
            if own.is_valid:
                gone, _ = repeats.covered(np.asarray(own.values), len(words))
                removed = int(gone.sum())
                kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            else:
                kept = words
            out["n_words"].append(len(words))
            out["n_removed"].append(removed)
            out["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [out["doc_id"], pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()),
             pa.array(out["kept_sha256"], pa.string())], names=list(out))


def remove_repeats(docs: DataFrame, length: int = LENGTH, k: int = EDGE_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words, one row per input row."""
    keyed = repeats.keyed(docs.select("doc_id", "text"))
    spans = repeated_spans(keyed, length, k)
    return (keyed.join(spans, repeats.KEY, "left").select("row", "ord", "text", "spans")
            .mapInArrow(_digest, "doc_id long, n_words long, n_removed long, kept_sha256 string"))
