"""Packing by cutting-stock column generation (operator 9).

1. Each document becomes token ids (tokenizer file ``word_bpe_49k.json``, id 1 at the end) and is cut into pieces of
   ``CAPACITY`` ids and one remainder.  Only (start, length, crc32, ...) leave the tokenizing tasks.
2. Remainders are counted by length class (``UNIT`` ids a class, at most 256 classes) - a histogram whose size does not
   depend on the data.
3. On the driver, a linear program over packing patterns of that histogram is solved by column generation: the revised
   simplex method gives a price per class, an unbounded-knapsack dynamic program finds the pattern of greatest price,
   until no pattern is worth noticeably more than one sequence.  Patterns are rounded down and
   the few pieces left over are packed first-fit decreasing by class.
4. Pieces are ranked within their class (in salted blocks, so no class is one task) and the rank picks the pattern, the
   sequence and the slot by binary search in the pattern table.

A sequence holds at most ``CAPACITY`` ids; what is short of it is padding, about half a class width per piece.

Defined results: a null text is empty and becomes one piece of the single id 1; identical repeated rows are packed as
documents of their own; null doc_id is kept; other columns are not read; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagelens.llm.shared import written
from wagelens.llm.text_kernel import Words, words_of

CAPACITY = 2048
UNIT = 8
END_ID = 1
#: Bytes of text whose different words are looked up at once.
WORD_CHUNK = 1_000_000
SALTS = 128
#: Blocks that the pieces that fill a sequence of their own are numbered in (the bulk of a corpus of long texts).
WHOLE_SALTS = 16_384
GAP = 1e-3
PATIENCE = 60
#: Words and word pieces whose ids one worker keeps at a time.
CACHED_WORDS = 400_000

CACHED_PIECES = 250_000

# The pre-tokenizer of the vocabulary file, restricted to lower-cased printable ASCII and Latin-1 letters.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+"
PLAIN = r"[!-~À-ÖØ-öø-ÿ]+"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Ids of white-space separated words, each worked out once by the tokenizer's own model.

    No token spans ASCII white space and the normalisers work within words, so a text's ids are those of its words.
    """

    def __init__(self, path: str) -> None:
        import re

        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.normal, self.pre = self.tokenizer.model, self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.split, self.plain = re.compile(PIECES).findall, re.compile(PLAIN).fullmatch
        # the byte-level spelling of the accented letters, as the library gives it
        self.spelling = {c: "".join(p for p, _ in self.pre.pre_tokenize_str(chr(c))) for c in range(0xDF, 0x100) if c != 0xF7}
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.pool = np.zeros(0, dtype=np.uint32)
        self.first = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)

    def _piece(self, piece: str) -> tuple[int, ...]:
        ids = self.pieces.get(piece)
        if ids is None:
            if len(self.pieces) >= CACHED_PIECES:
                self.pieces.clear()
            ids = self.pieces[piece] = tuple([t.id for t in self.model.tokenize(piece)])
        return ids

    def _word(self, word: bytes) -> tuple[int, ...] | list[int]:
        text = word.decode()
        if "<|" in text:
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        if self.plain(text):
            pieces = self.split(text.lower())
            if not text.isascii():
                pieces = [p.translate(self.spelling) for p in pieces]
        else:
            pieces = [p for p, _ in self.pre.pre_tokenize_str(self.normal.normalize_str(text))]
        if len(pieces) == 1:
            return self._piece(pieces[0])
        return [i for p in pieces for i in self._piece(p)]

    def of(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the documents one after the other, END_ID after each, and the documents' ends."""
        if len(self.index) > CACHED_WORDS:
            self.clear()
        _, where, inverse = np.unique(words.word_hashes(), return_index=True, return_inverse=True)
        if not _same_bytes(words, where[inverse]):  # words of one hash that differ: each word for itself
            where = inverse = np.arange(len(words.start))
        raw, index = words.data.tobytes(), self.index
        distinct = [raw[a:b] for a, b in zip(words.start[where].tolist(), words.end[where].tolist(), strict=True)]
        new = [w for w in distinct if w not in index]
        if new:
            ids = [self._word(w) for w in new]
            size = np.array([len(x) for x in ids], dtype=np.int64)
            base = len(self.first)
            index.update((w, base + i) for i, w in enumerate(new))
            self.first = np.append(self.first, len(self.pool) + np.cumsum(size) - size)
            self.size = np.append(self.size, size)
            self.pool = np.append(self.pool, np.array([i for x in ids for i in x], dtype=np.uint32))
        at = np.fromiter(map(index.__getitem__, distinct), dtype=np.int64, count=len(distinct))[inverse]
        size, first = self.size[at], self.first[at]
        after = np.r_[0, np.cumsum(size)]
        flat = self.pool[np.repeat(first - after[:-1], size) + np.arange(after[-1])]
        ends = after[words.indptr[1:]]
        return np.insert(flat, ends, np.uint32(END_ID)), ends + np.arange(1, len(ends) + 1)


def _same_bytes(words: Words, other: np.ndarray) -> bool:
    """Is every word of a chunk equal, byte by byte, to the word it is to be replaced by?"""
    size = words.end - words.start
    if not all(np.array_equal(x, x[other]) for x in (size, *words.first_bytes())):
        return False
    long = np.flatnonzero(size > 16)
    size, start, instead = size[long], words.start[long], words.start[other[long]]
    within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    return np.array_equal(words.data[np.repeat(start, size) + within], words.data[np.repeat(instead, size) + within])


_word_ids: dict[str, WordIds] = {}


def _cut(path: str, capacity: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _word_ids.setdefault(path, None) or WordIds(path)
        _word_ids[path] = encoder
        dealt = 0
        for batch in batches:
            doc, start, length, crc, total = [], [], [], [], []
            for words in words_of(batch.column("text"), chunk_bytes=WORD_CHUNK):
                row = words.first
                ids, ends = encoder.of(words)
                buffer = memoryview(ids.astype("<u4")).cast("B")
                begin = 0
                for i, end in enumerate(ends.tolist()):
                    for a in range(begin, end, capacity):
                        b = min(a + capacity, end)
                        doc.append(row + i)
                        start.append(a - begin)
                        length.append(b - a)
                        crc.append(zlib.crc32(buffer[4 * a: 4 * b]))
                        total.append(end - begin)
                    begin = end
            if not dealt and crc:
                dealt = crc[0]  # tasks begin at different blocks
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total)),
                 pa.array(np.arange(dealt, dealt + len(doc)))],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "deal"])
            dealt += len(doc)
    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, start, length, ids_crc32 and doc_tokens of each piece, and the number (deal) that a task gave it."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _cut(tokenizer, capacity), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, deal long")


def dealt(cut: DataFrame, capacity: int = CAPACITY, unit: int = UNIT, salts: int = SALTS) -> DataFrame:
    """Written pieces with their length class (kind) and block (salt): dealt out in turn, so equal rows part as well."""
    kind = F.when(F.col("length") == capacity, 0).otherwise(F.ceil(F.col("length") / unit)).cast("int")
    return cut.withColumn("kind", kind).withColumn("salt", F.pmod("deal", F.when(F.col("kind") == 0, WHOLE_SALTS).otherwise(salts).cast("long")).cast("int")).drop("deal")


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable multiset of sizes within the capacity."""
    best = np.zeros(capacity + 1)
    take = np.full(capacity + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), side="right")  # sizes ascend
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        k = fitting[room]
        if k:
            value = prices[:k] + best[room - sizes[:k]]
            i = value.argmax()
            if value[i] > best[room] + 1e-12:
                best[room], take[room] = value[i], i
    counts = np.zeros(len(sizes), dtype=np.int64)
    room = capacity
    while room > 0:
        if take[room] < 0:
            room -= 1
        else:
            counts[take[room]] += 1
            room -= sizes[take[room]]
    return float(best[capacity]), counts


def first_fit(left: np.ndarray, sizes: np.ndarray, capacity: int) -> list[tuple[int, np.ndarray]]:
    """First-fit decreasing by size class: (how often, count per size), every piece held exactly once."""
    left, out = left.copy(), []
    while left.any():
        column, room = np.zeros(len(sizes), dtype=np.int64), capacity
        for i in np.argsort(-sizes, kind="stable"):
            n = min(int(left[i]), room // int(sizes[i]))
            column[i] += n
            room -= n * int(sizes[i])
        held = column > 0
        times = int((left[held] // column[held]).min())
        out.append((times, column))
        left -= times * column
    return out


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Matrix by vector without BLAS, whose threads cost more than such small products."""
    return (matrix * vector).sum(axis=1)


def cutting_stock(demand: np.ndarray, sizes: np.ndarray, capacity: int) -> list[tuple[int, np.ndarray]]:
    """(how often, count per size) of patterns that hold all pieces: demand[i] pieces of sizes[i].

    First-fit patterns enter the basis first; then the knapsack prices new ones until none is worth more than
    1 + GAP sequences or ``PATIENCE`` columns together gain less than GAP.
    """
    m = len(sizes)
    if not m:
        return []
    patterns = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / (capacity // sizes))
    amounts = _times(inverse, demand)
    ready = [column for _, column in first_fit(demand.astype(np.int64), sizes, capacity)]
    step, mark = 0, np.inf
    while True:
        prices = inverse.sum(axis=0)
        if ready:
            column = ready.pop()
            if (prices * column).sum() <= 1 + 1e-9:
                continue
        else:
            if step % PATIENCE == 0:
                if amounts.sum() > mark * (1 - GAP):
                    break
                mark = amounts.sum()
            value, column = best_pattern(prices, sizes, capacity)
            if value <= 1 + GAP:
                break
            step += 1
        direction = _times(inverse, column)
        grows = direction > 1e-9
        if not grows.any():
            break
        ratio = np.where(grows, amounts / np.where(grows, direction, 1.0), np.inf)
        out = int(ratio.argmin())
        patterns[:, out] = column
        pivot = inverse[out] / direction[out]
        inverse = inverse - np.outer(direction, pivot)
        inverse[out] = pivot
        amounts = np.maximum(_times(inverse, demand), 0.0)
    used: dict[tuple[int, ...], int] = {}
    left = demand.astype(np.int64).copy()
    for j in np.argsort(-amounts, kind="stable"):
        column = patterns[:, j].round().astype(np.int64)
        times = int(np.floor(amounts[j] + 1e-9))
        if column.any():
            times = min(times, int((left[column > 0] // column[column > 0]).min()))
            if times > 0:
                used[tuple(column)] = used.get(tuple(column), 0) + times
                left -= times * column
    for times, column in first_fit(left, sizes, capacity):
        used[tuple(column)] = used.get(tuple(column), 0) + times
    return [(n, np.array(c)) for c, n in used.items()]


def pattern_table(histogram: dict[int, int], capacity: int = CAPACITY, unit: int = UNIT) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length class: upper rank of each pattern that holds it, pieces per sequence, first sequence, first rank."""
    classes = np.array(sorted(histogram), dtype=np.int64)
    demand = np.array([histogram[int(c)] for c in classes], dtype=float)
    base, rows = 0, {int(c): [] for c in classes}
    for times, column in cutting_stock(demand, classes, capacity // unit):
        for c, n in zip(classes.tolist(), column.tolist(), strict=True):
            if n:
                rows[c].append((times * n, n, base))
        base += times
    table = {}
    for c, entries in rows.items():
        size, per, first = (np.array(x, dtype=np.int64) for x in zip(*entries, strict=True))
        upper = np.cumsum(size)
        table[c] = (upper, per, first, upper - size)
    return table


def _place(table: dict[int, tuple[np.ndarray, ...]], shift: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, rank = np.asarray(batch.column("kind")), np.asarray(batch.column("rank"))
            sequence = rank.copy()  # whole sequences come first, one each
            for c in np.unique(kind[kind > 0]).tolist():
                upper, per, first, lower = table[c]
                own = np.flatnonzero(kind == c)
                p = np.searchsorted(upper, rank[own], side="right")
                sequence[own] = shift + first[p] + (rank[own] - lower[p]) // per[p]
            yield batch.drop_columns(["rank"]).append_column("sequence_id", pa.array(sequence))
    return run


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, unit: int = UNIT, salts: int = SALTS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    # the numbers that pieces were dealt are written with them, so both readings below agree on every piece's block
    cut = dealt(written(pieces(docs, tokenizer or default_tokenizer(), capacity), "pieces"), capacity, unit, salts)
    # at most (classes x salts + WHOLE_SALTS) rows, whatever the input
    blocks = sorted((r.kind, r.salt, r.n) for r in cut.groupBy("kind", "salt").agg(F.count("*").alias("n")).collect())
    histogram: dict[int, int] = {}
    before = []
    for k, s, n in blocks:
        before.append((k, s, histogram.get(k, 0)))
        histogram[k] = histogram.get(k, 0) + n
    whole = histogram.pop(0, 0)
    table = pattern_table(histogram, capacity, unit)
    offsets = docs.sparkSession.createDataFrame(before, "kind int, salt int, before long")
    order = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    block = Window.partitionBy("kind", "salt").orderBy(*order)
    ranked = (cut.withColumn("place", F.row_number().over(block))
              .join(F.broadcast(offsets), ["kind", "salt"])
              .select(*order, "kind", (F.col("before") + F.col("place") - 1).alias("rank")))
    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, kind int, sequence_id long"
    placed = ranked.mapInArrow(_place(table, whole), kinds)
    sequence = Window.partitionBy("sequence_id").orderBy(F.desc("kind"), *order).rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(*order, "sequence_id", F.coalesce(F.sum("length").over(sequence), F.lit(0)).cast("long").alias("offset"))
