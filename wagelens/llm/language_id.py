"""Language identification (operator 3): multinomial naive Bayes over hashed character n-grams.

Counts of hashed 2- and 3-grams per language are summed by Spark (each task adds up its own batch first); the driver
holds only the count matrix, BUCKETS x languages, whose size does not depend on the number of documents.  The matrix
of log-probabilities is broadcast and each batch is scored as sparse rows: the n-grams of a document are the non-zero
columns, whose matrix rows are gathered and added up per document in numpy.

Training rows: a bounded sample of about ``TRAIN_ROWS`` labelled documents (chosen by a hash of doc_id and text, or all if there
are fewer), never those of the held-out fold crc32(doc_id as text) mod 5 = 0.  All documents are scored, by whole text.

Defined results: ``und`` with score 0 if the text is null or has no letter, or if nothing was learned; a null doc_id is
not held out and not learned from; null lang is not learned from; ties go to the language that sorts first; repeated
rows give repeated rows; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagelens.llm.text_kernel import string_chunks

BUCKETS = 1 << 16
TRAIN_ROWS = 20_000
FOLDS = 5
SMOOTHING = 0.5
SAMPLE_STEPS = 1_000_000

_tables: list[np.ndarray] = []


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: is it a letter, and its lower-case form (itself where that is longer)."""
    if not _tables:
        chars = [chr(i) if not 0xD800 <= i < 0xE000 else " " for i in range(0x110000)]
        low = (c.lower() for c in chars)
        _tables.extend((np.array([c.isalpha() for c in chars]),
                        np.array([ord(x) if len(x) == 1 else ord(c) for c, x in zip(chars, low, strict=True)], dtype=np.uint32)))
    return _tables[0], _tables[1]


def grams(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, has a letter per row, n-gram ends per row, hashed n-grams) of runs of rows.

    Texts are lower-cased and everything but letters becomes a space; grams of spaces only, and those of two spaces in
    a row, are left out.
    """
    is_letter, lower = _letters()
    for first, offsets, data in string_chunks(column):
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        starts = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=starts[1:])
        ends = starts[offsets]
        letter = is_letter[points]
        has = np.diff(np.r_[0, np.cumsum(letter)][ends]) > 0
        code = np.where(letter, lower[points], np.uint32(32)).astype(np.uint64)
        n = len(code)
        doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        found, where = [], []
        for size in (2, 3):
            if n < size:
                continue
            head = slice(0, n - size + 1)
            good = (doc[head] == doc[size - 1:]) & (letter[head] | letter[1: n - size + 2])
            key = code[head] * np.uint64(0x9E3779B97F4A7C15) + code[1: n - size + 2] * np.uint64(0xC2B2AE3D27D4EB4F)
            if size == 3:
                good &= letter[1: n - 1] | (letter[head] & letter[2:])
                key += code[2:] * np.uint64(0x165667B19E3779F9) + np.uint64(0x27D4EB2F165667C5)
            key = (key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            at = np.flatnonzero(good)
            found.append((key[at] >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1))
            where.append(doc[at])
        rows = np.concatenate(where) if where else np.zeros(0, dtype=np.int64)
        order = np.argsort(rows, kind="stable")
        hashed = np.concatenate(found)[order] if found else rows
        yield first, has, np.cumsum(np.bincount(rows, minlength=len(ends) - 1)), hashed


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for first, _, ends, hashed in grams(batch.column("text")):
            begin = 0
            for i, end in enumerate(ends.tolist()):
                lang = langs[first + i]
                total = totals.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                docs[lang] = docs.get(lang, 0) + 1
                total += np.bincount(hashed[begin:end], minlength=BUCKETS) if end - begin > 4096 else 0
                if end - begin <= 4096:
                    np.add.at(total, hashed[begin:end], 1)
                begin = end
    for lang, total in totals.items():
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * (len(used) + 1), pa.string()), pa.array(np.r_[-1, used]), pa.array(np.r_[docs[lang], total[used]])],
            names=["lang", "bucket", "n"])


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo FOLDS (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


class Model:
    """Languages in sorted order, BUCKETS x languages log-probabilities, log-priors."""

    def __init__(self, langs: list[str], logp: np.ndarray, prior: np.ndarray) -> None:
        self.langs, self.logp, self.prior = langs, logp, prior


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Learn from doc_id, text and lang of the rows that the fold rule and the sample bound allow."""
    labelled = docs.select("doc_id", "lang").filter(F.col("lang").isNotNull() & (fold(F.col("doc_id")) != 0))
    n = labelled.count()
    usable = docs.filter(F.col("lang").isNotNull() & (fold(F.col("doc_id")) != 0))
    if n > train_rows:
        share = int(SAMPLE_STEPS * train_rows / n)
        # by id and text: rows that share an id are drawn one by one
        usable = usable.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(SAMPLE_STEPS)) < share)
    counts = (usable.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
              .mapInArrow(_count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    table = counts.toPandas()
    langs = sorted(table["lang"].unique().tolist())
    matrix, prior = np.zeros((BUCKETS, len(langs))), np.ones(len(langs))
    for j, lang in enumerate(langs):
        own = table[table["lang"] == lang]
        bucket, n_own = own["bucket"].to_numpy(), own["n"].to_numpy()
        matrix[bucket[bucket >= 0], j] = n_own[bucket >= 0]
        prior[j] += n_own[bucket < 0].sum()
    matrix += SMOOTHING
    if langs:
        matrix = np.log(matrix / matrix.sum(axis=0))
        prior = np.log(prior / prior.sum())
    return Model(langs, matrix.astype(np.float32), prior)


def _score(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        names = np.array([*m.langs, "und"], dtype=object)
        for batch in batches:
            best = np.full(batch.num_rows, len(m.langs), dtype=np.int64)
            score = np.zeros(batch.num_rows)
            for first, has, ends, hashed in grams(batch.column("text")):
                if not m.langs:
                    continue
                # sparse rows times matrix: gather the rows of the n-grams present, add up per document
                sums = np.zeros((len(ends), len(m.langs)))
                begins = np.r_[0, ends[:-1]]
                full = np.flatnonzero(ends > begins)
                if len(full):
                    for j in range(len(m.langs)):
                        sums[full, j] = np.add.reduceat(m.logp[:, j][hashed], begins[full], dtype=np.float64)
                sums += m.prior
                top = sums.max(axis=1, keepdims=True)
                own = slice(first, first + len(ends))
                best[own] = np.where(has, sums.argmax(axis=1), len(m.langs))
                score[own] = np.where(has, 1.0 / np.exp(sums - top).sum(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names[best], pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; only text is an input of the prediction."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        _score(shared), "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Train on the table's labelled rows and predict the language of all its rows."""
    return predict(docs, train(docs, train_rows))
