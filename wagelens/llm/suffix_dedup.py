"""Repeated passages, one copy of each kept (operator 10): exact, by hashes of sparse suffixes and not by sorting them.

This is not a suffix array: the steps of the dealt method that are kept are the sparse suffixes at minimiser positions.
They are grouped by a hash of their first k words; a group whose members all have the same context hash up to the next
retained suffix on both sides needs no more work.  Around the others every placement of a ``length``-word window is
grouped by two hashes of its words, in (doc_id, row key, position) order.  No suffix text is sorted, and no longest
common prefix of neighbours is extended; the results are the same as if it were.

Result: a word is repeated if it lies in a window of ``length`` consecutive words that occurs twice or more in the
corpus, and removed if it lies in one that also occurs at an earlier (doc_id, row key, position).  So one copy of each
passage stays, in the document with the smallest doc_id; different rows of one doc_id, or of none, are ordered by their
key (``repeats.keyed``).

Defined results: null or empty text has 0 words; null doc_id sorts before all others; identical repeated rows count as
two occurrences at the same place, so each keeps its copy; other columns pass through ``drop_repeats`` unchanged and
may have any name; an empty table gives an empty result.  Documents that lose nothing keep their text byte for byte;
others become their kept words joined by one space.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagelens.llm import repeats

LENGTH = 50
SUFFIX_WORDS = 25


def sorted_suffixes(keyed: DataFrame, length: int, k: int) -> DataFrame:
    """Retained suffixes that share k words with a neighbour; ``straight``: all such neighbours agree on both sides."""
    array = Window.partitionBy("h1").orderBy("h2")
    block = Window.partitionBy("h1")
    suffixes = (repeats.anchor_rows(keyed, length, k)
                .withColumn("differs", (F.col("h2") == 0) | ~F.lag("h2", 1).over(array).eqNullSafe(F.col("h2")) & (F.row_number().over(array) > 1))
                .withColumn("branches", F.sum(F.col("differs").cast("int")).over(block))
                .withColumn("visits", F.sum("n").over(block)))
    return suffixes.filter("visits >= 2").withColumn("straight", (F.col("branches") == 0).cast("int"))


def repeated_spans(keyed: DataFrame, length: int = LENGTH, k: int = SUFFIX_WORDS) -> DataFrame:
    """Row key and spans (see ``repeats.settle``) of every document with a repeated window."""
    marks = repeats.mark_documents(sorted_suffixes(keyed, length, k))
    rows = repeats.candidate_rows(keyed, marks, length, k)
    order = Window.partitionBy("h1", "h2").orderBy("first_doc", "first_key", "first_pos")
    neighbour = F.lag("first_doc").over(order).isNotNull()
    # equal coordinates (identical repeated rows in two batches) are the same place, not an earlier one
    same_place = F.lit(True)
    for c in ("first_doc", "first_key", "first_pos"):
        same_place = same_place & (F.col(c) == F.first(c).over(order))
    return repeats.settle(rows, neighbour & ~same_place)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_repeated, n_removed, digest, texts = [], [], [], [], []
        for text, own in zip(batch.column("text").to_pylist(), batch.column("spans"), strict=True):
            words = (text or "").encode().split()
            repeated = removed = 0
            kept, left = words, None
            if own.is_valid:
                any_, gone = repeats.covered(np.asarray(own.values), len(words))
                repeated, removed = int(any_.sum()), int(gone.sum())
                if removed:
                    kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                    left = b" ".join(kept).decode()
            n_words.append(len(words))
            n_repeated.append(repeated)
            n_removed.append(removed)
            digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            texts.append(left)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("text"), *(pa.array(x, pa.int64()) for x in (n_words, n_repeated, n_removed)),
             pa.array(digest, pa.string()), pa.array(texts, pa.string())],
            names=["row", "text", "n_words", "n_repeated", "n_removed", "kept_sha256", "new_text"])


def _joined(docs: DataFrame, length: int, k: int) -> DataFrame:
    keyed = repeats.keyed(docs)
    spans = repeated_spans(keyed, length, k)
    source = keyed.join(spans, repeats.KEY, "left").select("row", "ord", "text", "spans")
    kind = keyed.schema["row"].dataType.simpleString()
    return source.mapInArrow(_apply, f"row {kind}, text string, n_words long, n_repeated long, n_removed long, kept_sha256 string, new_text string")


def report(docs: DataFrame, length: int = LENGTH, k: int = SUFFIX_WORDS) -> DataFrame:
    """doc_id, n_words, n_repeated, n_removed and the SHA-256 of the kept words, one row per input row."""
    return _joined(docs.select("doc_id", "text"), length, k).select(
        F.col("row")["doc_id"].alias("doc_id"), "n_words", "n_repeated", "n_removed", "kept_sha256")


def drop_repeats(docs: DataFrame, length: int = LENGTH, k: int = SUFFIX_WORDS) -> DataFrame:
    """The input with later copies of repeated passages cut out of ``text`` (``n_chars``, if there, follows)."""
    cut = _joined(docs, length, k)
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("new_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        old = F.col("row").getField("n_chars")
        new["n_chars"] = F.when(changed, F.length("new_text").cast(docs.schema["n_chars"].dataType)).otherwise(old)
    return cut.select(*[(new[c] if c in new else F.col("row").getField(c)).alias(c) for c in docs.columns])
