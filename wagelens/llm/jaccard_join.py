"""N-gram Jaccard join (operator 6): exact, by prefix lists with pivots and binary probes.

Not DivideSkip: no short lists are heap-merged, no occurrences are counted and no long lists probed; see "Short lists".

A document's set holds the hashes of its distinct 5-word shingles.  Two sets link when 9 * overlap >= 4 * (sum of
sizes), that is Jaccard >= 0.8.  Equal sets form a class; everything below works on classes.

* Order: all shingles are counted over the whole table (delta-coded 40-bit values in hash buckets, about 2 bytes a
  shingle in the shuffle); the most frequent ones - at most ``ORDER_ROWS``, a bound on the broadcast - go last in every
  set's order.  The order decides the cost only, never the result.
* Short lists: sets that reach the required overlap share one of the first n - ceil(0.8 n) + 1 shingles of the order.
  Only these inverted lists are merged (sorted by Spark); the other, longer ones are not read at all here.
* Candidates: first each list is compared with one pivot, its most central member, which settles large groups of copies
  with one comparison per member.  Lists whose members then still lie in different components are joined with
  themselves, but only for pairs of different components, of fitting sizes, whose ranks on the list leave room for the
  required overlap.  No group is ever expanded into all its pairs.
* Long lists: a candidate's remaining shingles are probed by binary search in the other's sorted set, and the overlap is
  counted exactly.

Components are exact without the links inside a component that is already connected; ``linked`` does not look for
those.  ``link_pairs`` and ``counted`` find every link: a component is dealt into blocks of about ``BLOCK_SHINGLES``
shingles, blocks that meet on a short list are paired (all links share one), and a pair of blocks counts the overlaps of
all its sets at once.  Hot lists cost pairs of blocks, not pairs of classes, and texts travel once a pair of blocks.
Links are between classes; a class's copies are its members and no links.  ``counted`` adds them up inside the tasks.

Defined results: null, empty and wordless texts have an empty set and are linked with nothing; fewer than five words
make one shingle of the whole sequence; identical rows are one class; a null doc_id never becomes a component id unless
the component has no other; other columns are not read by ``linked`` and pass unchanged through ``keep_one``; an empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagelens.llm import repeats
from wagelens.llm.components import components
from wagelens.llm.repeats import KEY
from wagelens.llm.shared import written
from wagelens.llm.text_kernel import SPACED, mix, window_hashes, words_of

SHINGLE = 5
ORDER_FROM = 8
ORDER_ROWS = 1_000_000
BUCKET_BITS, ORDER_BITS = 8, 40
CODED_ROWS = 1_500_000
#: Rows of keys up to which the texts needed are found by a broadcast join; beyond, by a shuffled one.
BROADCAST_KEYS = 500_000
#: Shingles of a block of a component, and columns of overlap counts taken at a time.
BLOCK_SHINGLES, OVERLAP_COLUMNS = 100_000, 4096


class Sets:
    """Shingle sets of a run of rows: shingles[ptr[i]:ptr[i+1]], ascending, is the set of row first + i."""

    def __init__(self, first: int, ptr: np.ndarray, shingles: np.ndarray) -> None:
        self.first, self.ptr, self.shingles = first, ptr, shingles
        self.size = np.diff(ptr)
        self.doc = np.repeat(np.arange(len(self.size)), self.size)

    def classes(self) -> np.ndarray:
        """A 64-bit name of each set, the same in any order of its shingles (0 for the empty set)."""
        total = np.zeros((2, len(self.size)), dtype=np.uint64)
        full = np.flatnonzero(self.size)
        if len(full):
            for i, values in enumerate((mix(self.shingles.copy()), mix(self.shingles ^ np.uint64(0x5851F42D4C957F2D)))):
                total[i, full] = np.add.reduceat(values, self.ptr[full])
        name = mix(total[0] ^ mix(total[1] + self.size.astype(np.uint64)))
        return np.where(self.size > 0, np.maximum(name, np.uint64(1)), np.uint64(0)).view(np.int64)


def shingle_sets(column: pa.Array | pa.ChunkedArray) -> Iterator[Sets]:
    for words in words_of(column, SPACED, lower=True):
        hashes, counts = words.word_hashes(), words.counts
        at = np.flatnonzero(words.fits(SHINGLE))
        grams = window_hashes(hashes, at, at + SHINGLE, second=False)[0]
        doc = words.doc[at] if len(at) else at
        short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
        whole = window_hashes(hashes, words.indptr[short], words.indptr[short + 1], second=False)[0]
        doc, grams = np.append(doc, short), np.append(grams, whole)
        order = np.lexsort((grams, doc))
        doc, grams = doc[order], grams[order]
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])
        doc, grams = doc[new], grams[new]
        yield Sets(words.first, np.searchsorted(doc, np.arange(words.n_docs + 1)), grams)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size, cls = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows, dtype=np.int64)
        for sets in shingle_sets(batch.column("text")):
            own = slice(sets.first, sets.first + len(sets.size))
            size[own], cls[own] = sets.size, sets.classes()
        yield pa.RecordBatch.from_arrays([batch.column(KEY), batch.column("doc_id"), pa.array(size), pa.array(cls)],
                                         names=[KEY, "doc_id", "n_shingles", "cls"])


def _distinct_classes(sets: Sets, seen: set[int]) -> np.ndarray:
    """Rows whose class has not been met in this batch."""
    keep = np.zeros(len(sets.size), dtype=bool)
    for i, c in enumerate(sets.classes().tolist()):
        if c and c not in seen:
            seen.add(c)
            keep[i] = True
    return keep


def _coded(parts: list[np.ndarray]) -> pa.RecordBatch:
    """Per hash bucket: these shingles as sorted, delta-coded 32-bit values."""
    values = np.concatenate(parts) >> np.uint64(64 - ORDER_BITS)
    values.sort()
    cuts = np.searchsorted(values >> np.uint64(ORDER_BITS - BUCKET_BITS), np.arange(2**BUCKET_BITS + 1, dtype=np.uint64))
    rest = (values & np.uint64(2 ** (ORDER_BITS - BUCKET_BITS) - 1)).astype(np.uint32)
    used = [b for b in range(2**BUCKET_BITS) if cuts[b] < cuts[b + 1]]
    blobs = []
    for b in used:
        planes = np.diff(rest[cuts[b]: cuts[b + 1]], prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T
        blobs.append(zlib.compress(planes.tobytes(), 1))
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of all classes of a batch, coded about CODED_ROWS at a time."""
    for batch in batches:
        seen: set[int] = set()
        parts, held = [], 0
        for sets in shingle_sets(batch.column("text")):
            parts.append(sets.shingles[_distinct_classes(sets, seen)[sets.doc]])
            held += len(parts[-1])
            if held >= CODED_ROWS:
                yield _coded(parts)
                parts, held = [], 0
        if held:
            yield _coded(parts)


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles met ORDER_FROM times or more, of the buckets dealt to this task."""
    met: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob").to_pylist(), strict=True):
            planes = np.frombuffer(zlib.decompress(blob), dtype=np.uint8).reshape(4, -1)
            values = np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).reshape(-1), dtype=np.uint32)
            met.setdefault(bucket, []).append(values)
    for bucket in sorted(met):
        values, n = np.unique(np.concatenate(met.pop(bucket)), return_counts=True)
        often = n >= ORDER_FROM
        name = values[often].astype(np.int64) + (np.int64(bucket) << (ORDER_BITS - BUCKET_BITS))
        yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(n[often].astype(np.int64))], names=["name", "n"])


def frequent(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted 40-bit names of the most frequent shingles and the base-2 logarithm of their counts."""
    coded = docs.select("text").mapInArrow(_code, "bucket int, blob binary")
    counts = written(coded.repartition("bucket").mapInArrow(_tally, "name long, n long"), "shingle-counts")
    level = F.floor(F.log2("n")).cast("int")
    least, kept = 0, 0
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -r.level):
        if kept + r["count"] > ORDER_ROWS:
            least = r.level + 1
            break
        kept += r["count"]
    table = counts.select("name", level.alias("level")).filter(F.col("level") >= least).toPandas().sort_values("name")
    return table["name"].to_numpy(np.uint64), table["level"].to_numpy(np.int8)


def _short_lists(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, levels = shared.value
        for batch in batches:
            seen: set[int] = set()
            for sets in shingle_sets(batch.column("text")):
                level = np.zeros(len(sets.shingles), dtype=np.int8)
                if len(names):
                    short = sets.shingles >> np.uint64(64 - ORDER_BITS)
                    i = np.minimum(np.searchsorted(names, short), len(names) - 1)
                    level = np.where(names[i] == short, levels[i], 0)
                order = np.lexsort((sets.shingles, level, sets.doc))
                rank = np.arange(len(order)) - sets.ptr[sets.doc]
                size = sets.size[sets.doc]
                prefix = size - (4 * size + 4) // 5 + 1
                keep = (rank < prefix) & _distinct_classes(sets, seen)[sets.doc]
                cls = sets.classes()[sets.doc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sets.shingles[order][keep].view(np.int64)), pa.array(cls[keep]), pa.array((rank[keep] << 32) + size[keep])],
                    names=["h", "cls", "place"])
    return run


def short_lists(docs: DataFrame) -> DataFrame:
    """h, cls, rank, n: entries of the short inverted lists that hold two classes or more (written)."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent(docs))
    entries = docs.select("text").mapInArrow(_short_lists(shared), "h long, cls long, place long")
    in_order, whole = Window.partitionBy("h").orderBy("cls"), Window.partitionBy("h")
    merged = (entries.withColumn("again", F.lag("cls").over(in_order).eqNullSafe(F.col("cls")))
              .withColumn("least", F.min("cls").over(whole)).withColumn("most", F.max("cls").over(whole))
              .filter("least <> most and not again"))
    return written(merged.select("h", "cls", F.shiftright("place", 32).cast("int").alias("rank"),
                                 F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("n")), "short-lists")


def _required(a: str, b: str):
    """Least overlap of sizes a and b at which the sets link."""
    return F.ceil(4 * (F.col(a) + F.col(b)) / 9)


def pivot_pairs(lists: DataFrame) -> DataFrame:
    """Each list entry with the list's pivot: the member that shares lists with most others."""
    whole = Window.partitionBy("h")
    sized = lists.withColumn("length", F.count("*").over(whole))
    central = sized.groupBy("cls").agg(F.sum("length").alias("central"))
    head = F.max(F.struct("central", "cls", "n", "rank")).over(whole)
    paired = sized.join(central, "cls").withColumn("pivot", head)
    n, m = F.col("n"), F.col("pivot")["n"]
    fits = (5 * n >= 4 * m) & (5 * m >= 4 * n)
    return (paired.filter((F.col("cls") != F.col("pivot")["cls"]) & fits)
            .select(F.col("cls").alias("a"), F.col("pivot")["cls"].alias("b")).distinct())


def open_pairs(lists: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs of different components that may still link, from lists whose members lie in several components."""
    whole = Window.partitionBy("h")
    placed = (lists.join(parts.withColumnRenamed("node", "cls"), "cls", "left")
              .withColumn("component", F.coalesce("component", "cls"))
              .withColumn("least", F.min("component").over(whole)).withColumn("most", F.max("component").over(whole))
              .filter("least <> most").select("h", "cls", "rank", "n", "component"))
    placed = written(placed, "open-lists")
    left = placed.select(*[F.col(c).alias(c if c == "h" else c + "_a") for c in placed.columns])
    right = placed.select(*[F.col(c).alias(c if c == "h" else c + "_b") for c in placed.columns])
    room = F.least(F.col("n_a") - F.col("rank_a"), F.col("n_b") - F.col("rank_b"))
    on = ((left["h"] == right["h"]) & (F.col("cls_a") < F.col("cls_b")) & (F.col("component_a") != F.col("component_b"))
          & (5 * F.col("n_a") >= 4 * F.col("n_b")) & (5 * F.col("n_b") >= 4 * F.col("n_a")) & (room >= _required("n_a", "n_b")))
    return left.join(right, on).select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b")).distinct()


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = []
        for column in ("text_a", "text_b"):
            rows = []
            for sets in shingle_sets(batch.column(column)):
                rows.extend(np.split(sets.shingles, sets.ptr[1:-1]))
            sides.append(rows)
        linked = []
        for x, y in zip(*sides, strict=True):
            if len(x) > len(y):
                x, y = y, x
            if 5 * len(x) < 4 * len(y) or not len(x):
                linked.append(False)
                continue
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            linked.append(9 * int((y[at] == x).sum()) >= 4 * (len(x) + len(y)))
        yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))


def links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs of classes whose sets link; texts: cls, text."""
    one = texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b").mapInArrow(_probe, "a long, b long")


def _texts(keyed: DataFrame, signatures: DataFrame, lists: DataFrame) -> DataFrame:
    """cls, text of one document of each class on a short list (written)."""
    needed = signatures.join(lists.select("cls").distinct(), "cls", "left_semi").groupBy("cls").agg(F.min(KEY).alias(KEY))
    needed = written(needed, "needed")
    few = needed.count() <= BROADCAST_KEYS
    found = keyed.select(KEY, "text").join(F.broadcast(needed) if few else needed, KEY)
    return written(found.select("cls", "text"), "texts")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of shared shingles of every set of the one list with every set of the other."""
    both = left + right
    row = np.repeat(np.arange(len(both)), [len(x) for x in both])
    _, column = np.unique(np.concatenate(both), return_inverse=True)
    used = np.flatnonzero(np.bincount(column[row < len(left)], minlength=column.max() + 1)
                          * np.bincount(column[row >= len(left)], minlength=column.max() + 1))
    found = np.zeros((len(left), len(right)), dtype=np.int64)
    name = _find(used, column)
    order = np.argsort(name, kind="stable")
    row, name = row[order], name[order]
    for first in range(0, len(used), OVERLAP_COLUMNS):
        own = slice(*np.searchsorted(name, [first, first + OVERLAP_COLUMNS]))
        has = np.zeros((len(both), min(OVERLAP_COLUMNS, len(used) - first)), dtype=np.float32)
        has[row[own], name[own] - first] = 1
        found += (has[: len(left)] @ has[len(left):].T).astype(np.int64)
    return found


def _find(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Index of each value in the sorted array, -1 where it isn't there."""
    if not len(known):
        return np.full(len(values), -1, dtype=np.int64)
    i = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[i] == values, i, -1)


def _block_links(cls: list[list[int]], sets: list[list[np.ndarray]], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Linked classes (a, b) between two blocks, or within one (each pair once)."""
    names = [np.array(c, dtype=np.int64) for c in cls]
    common = overlaps(sets[0], sets[0] if same else sets[1])
    size = [np.array([len(x) for x in s], dtype=np.int64) for s in sets]
    met = 9 * common >= 4 * (size[0][:, None] + size[0 if same else 1][None, :])
    if same:
        met &= np.triu(np.ones(met.shape, dtype=bool), 1)
    i, j = np.nonzero(met)
    return names[0][i], names[0 if same else 1][j]


def _within(count: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links of the pairs of blocks that come one after the other: pairs of classes, or links a class."""
    def answer(block: tuple, cls: list[list[int]], sets: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if not cls[0] or (block[1] != block[2] and not cls[1]):
            return
        a, b = _block_links(cls, sets, block[1] == block[2])
        if count:
            a, b = np.unique(np.append(a, b), return_counts=True)
            names = ["cls", "n_links"]
        else:
            a, b = np.minimum(a, b), np.maximum(a, b)
            names = ["a", "b"]
        for i in range(0, len(a), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(a[i: i + 100_000]), pa.array(b[i: i + 100_000].astype(np.int64))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cls, sets = None, [[], []], [[], []]
        for batch in batches:
            rows = []
            for s in shingle_sets(batch.column("text")):
                rows.extend(np.split(s.shingles, s.ptr[1:-1]))
            blocks = zip(*(batch.column(c).to_pylist() for c in ("component", "block_a", "block_b", "side", "cls")), strict=True)
            for (*block, side, name), own in zip(blocks, rows, strict=True):
                if block != now:
                    if now is not None:
                        yield from answer(tuple(now), cls, sets)
                    now, cls, sets = block, [[], []], [[], []]
                cls[side].append(name)
                sets[side].append(own)
        if now is not None:
            yield from answer(tuple(now), cls, sets)
    return run


def _all_links(lists: DataFrame, texts: DataFrame, parts: DataFrame, count: bool) -> DataFrame:
    """All links between classes of the components: a < b, or cls and n_links (of each pair of blocks)."""
    sized = lists.groupBy("cls").agg(F.first("n").alias("n")).join(parts.withColumnRenamed("node", "cls"), "cls")
    blocks = sized.groupBy("component").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("n_blocks"))
    large = written(blocks.filter("n_blocks > 1"), "large-components")
    dealt = written(sized.select("cls", "component").join(large, "component", "left").select(
        "cls", "component", F.coalesce(F.pmod(F.xxhash64("cls"), F.col("n_blocks")), F.lit(0)).cast("long").alias("block")), "blocks")
    # every block with itself, and blocks of one component that meet on a short list
    itself = dealt.select("component", F.col("block").alias("block_a"), F.col("block").alias("block_b")).distinct()
    on_list = (lists.select("h", "cls").join(dealt.join(large, "component", "left_semi"), "cls")
               .groupBy("h", "component").agg(F.collect_set("block").alias("on")).filter(F.size("on") > 1)
               .select("component", F.array_sort("on").alias("on")).distinct())
    one = on_list.select("component", "on", F.explode("on").alias("block_a"))
    two = one.select("component", "block_a", F.explode("on").alias("block_b")).filter("block_a < block_b").distinct()
    pairs = written(itself.unionByName(two), "block-pairs")
    sides = pairs.select("*", F.col("block_a").alias("block"), F.lit(0).alias("side")).unionByName(
        pairs.filter("block_a < block_b").select("*", F.col("block_b").alias("block"), F.lit(1).alias("side")))
    sent = sides.join(dealt, ["component", "block"]).join(texts, "cls").select("component", "block_a", "block_b", "side", "cls", "text")
    in_turn = sent.repartition("component", "block_a", "block_b").sortWithinPartitions("component", "block_a", "block_b")
    return in_turn.mapInArrow(_within(count), "cls long, n_links long" if count else "a long, b long")


def _joined(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Keyed rows, signature rows, short lists, the texts of their classes, and class -> component of linked classes."""
    keyed = repeats.keyed(docs)
    signatures = written(keyed.select(KEY, F.col("row")["doc_id"].cast("long").alias("doc_id"), "text")
                         .mapInArrow(_signatures, f"{KEY} long, doc_id long, n_shingles long, cls long"), "signatures")
    lists = short_lists(keyed)
    texts = _texts(keyed, signatures, lists)
    first = written(pivot_pairs(lists), "pivot-pairs")
    edges = written(links(first, texts), "links")
    rest = open_pairs(lists, components(edges))
    seen = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = written(rest.join(seen, ["a", "b"], "left_anti"), "open-pairs")
    return keyed, signatures, lists, texts, components(edges.unionByName(links(rest, texts)))


def _named(signatures: DataFrame, parts: DataFrame) -> DataFrame:
    """cls, component, component_id of the classes that have copies or links (written)."""
    own = signatures.filter("cls <> 0").groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    named = own.join(parts.withColumnRenamed("node", "cls"), "cls", "left").filter("n > 1 or component is not null")
    named = written(named.select("cls", "doc_id", F.coalesce("component", "cls").alias("component")), "classes")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return written(named.join(least, "component").select("cls", "component", "component_id"), "class-components")


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with their key, signature rows (written) and class -> component, component_id of the classes that have copies or links."""
    keyed, signatures, _, _, parts = _joined(docs)
    return keyed, signatures, _named(signatures, parts)


def linked(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id, one row per input row."""
    _, signatures, named = classes(docs.select("doc_id", "text"))
    return signatures.join(named, "cls", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links, one row per input row; n_links: other sets that the row's set links with."""
    _, signatures, lists, texts, parts = _joined(docs.select("doc_id", "text"))
    n_links = _all_links(lists, texts, parts, count=True).groupBy("cls").agg(F.sum("n_links").alias("n_links"))
    return (signatures.join(_named(signatures, parts), "cls", "left").join(written(n_links, "link-counts"), "cls", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def link_pairs(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links as pairs of classes (a < b), and the members of the classes: cls, doc_id, n_shingles, one row per input row."""
    _, signatures, lists, texts, parts = _joined(docs.select("doc_id", "text"))
    return _all_links(lists, texts, parts, count=False), signatures.select("cls", "doc_id", "n_shingles")


def keep_one(docs: DataFrame) -> DataFrame:
    """The input without all but one document of each component (the smallest doc_id, null last; of equal rows, one).

    Components are told apart by their own name: several may have no doc_id at all or the same least one.
    """
    keyed, signatures, named = classes(docs)
    grouped = signatures.join(named, "cls").withColumn("ord", F.coalesce("doc_id", F.lit(2**63 - 1)))
    stays = grouped.groupBy("component").agg(F.min(F.struct("ord", KEY)).alias("s")).select(F.col("s")[KEY].alias(KEY))
    gone = written(grouped.select(KEY).distinct().join(stays, KEY, "left_anti"), "gone")
    again = written(signatures.filter("cls <> 0").groupBy(KEY).count().filter("count > 1").select(KEY), "again")
    few = gone.count() <= BROADCAST_KEYS
    kept = keyed.join(F.broadcast(gone) if few else gone, KEY, "left_anti")
    if not again.isEmpty():
        twice = kept.join(again, KEY, "left_semi").dropDuplicates([KEY])
        kept = kept.join(again, KEY, "left_anti").unionByName(twice)
    return kept.select(*[(F.col("text") if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns])
