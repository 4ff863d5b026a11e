"""Operators over documents against brute force on the whole small corpus."""

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from wagelens.llm import decontamination, jaccard_join, language_id, packing, quality_rules, substring_dedup, suffix_dedup
from wagelens.llm.text_kernel import words_of

SPACED, ALNUM = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text, pattern=SPACED):
    return re.findall(pattern, text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(ws):
    return hashlib.sha256(" ".join(ws).encode()).hexdigest()


def row_key(doc_id, text):
    """The first 64 bits of the md5 of id and text, signed: the order of rows of one id."""
    raw = f"{'null' if doc_id is None else doc_id}|{'null' if text is None else text}"
    return int.from_bytes(hashlib.md5(raw.encode()).digest()[:8], "big", signed=True)


def repeated(rows, length):
    texts = [words(t) for _, t in rows]
    keys = [row_key(d, t) for d, t in rows]
    at = defaultdict(list)
    for j, w in enumerate(texts):
        for i in range(len(w) - length + 1):
            at[tuple(w[i:i + length])].append((-(2**63) if rows[j][0] is None else rows[j][0], keys[j], i, j))
    covered, later = [set() for _ in rows], [set() for _ in rows]
    for met in at.values():
        if len(met) > 1:
            first = min(met)[:3]
            for d, k, i, j in met:
                covered[j].update(range(i, i + length))
                if (d, k, i) != first:
                    later[j].update(range(i, i + length))
    return texts, covered, later


def test_quality_measures(docs, rows, empty):
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in quality_rules.judge(docs).collect())
    expected = Counter()
    for i, t in rows:
        w, seen = words(t), defaultdict(list)
        lines = [x for x in (t or "").split("\n") if words(x)]
        for j in range(len(w) - 7):
            seen[tuple(w[j:j + 8])].append(j)
        again = {p for at in seen.values() if len(at) > 1 for j in at for p in range(j, j + 8)}
        expected[(i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(again),
                  len(w) < 20 or 100 * len(again) > 30 * len(w))] += 1
    assert got == expected
    assert quality_rules.judge(empty).count() == 0


def test_quality_threshold_table(spark):
    good = "the quick brown fox and the lazy dog of this house is on the way to it in a day " * 1
    text = {1: good, 2: "&&& ### " * 15, 3: "qwx " + " ".join(f"zz{i}" for i in range(40)), 4: None, 5: (good + "\n") * 8}
    docs = spark.createDataFrame(list(text.items()), "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(docs).collect()}
    assert kept == {1: True, 2: False, 3: False, 4: False, 5: False}
    assert [r.doc_id for r in quality_rules.keep_good(docs).collect()] == [1]
    strict = quality_rules.judge(docs, (quality_rules.Rule("n_words", 1000),))
    assert not any(r.kept for r in strict.collect())


def test_substring_dedup(docs, rows, empty):
    texts, covered, _ = repeated(rows, 35)
    expected = Counter((rows[j][0], len(w), len(covered[j]), sha([x for i, x in enumerate(w) if i not in covered[j]]))
                       for j, w in enumerate(texts))
    assert Counter(tuple(r) for r in substring_dedup.remove_repeats(docs).collect()) == expected
    assert substring_dedup.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("length, k", [(8, 3), (50, 25)])
def test_suffix_dedup(docs, rows, length, k):
    texts, covered, later = repeated(rows, length)
    expected = Counter((rows[j][0], len(w), len(covered[j]), len(later[j]), sha([x for i, x in enumerate(w) if i not in later[j]]))
                       for j, w in enumerate(texts))
    assert Counter(tuple(r) for r in suffix_dedup.report(docs, length, k).collect()) == expected


def test_suffix_dedup_rewrites_only_what_loses_words(docs, rows, empty):
    texts, _, later = repeated(rows, 50)
    expected = Counter((rows[j][0], " ".join(x for i, x in enumerate(w) if i not in later[j]) if later[j] else rows[j][1])
                       for j, w in enumerate(texts))
    cut = suffix_dedup.drop_repeats(docs)
    assert cut.columns == docs.columns and cut.schema == docs.schema
    assert Counter((r.doc_id, r.text) for r in cut.collect()) == expected
    assert suffix_dedup.drop_repeats(empty).count() == 0


def _components(rows):
    sets = []
    for _, t in rows:
        w = words(lower(t))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= 80 * (len(a) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = d if least[find(i)] is None else min(least[find(i)], d)
    return sets, [find(i) for i in range(len(rows))], least


def test_jaccard_components(docs, rows, empty):
    sets, root, least = _components(rows)
    expected = Counter((d, len(sets[i]), least[root[i]]) for i, (d, _) in enumerate(rows))
    assert Counter(tuple(r) for r in jaccard_join.linked(docs).collect()) == expected
    assert jaccard_join.linked(empty).count() == 0


def test_jaccard_keeps_one_of_each_component(docs, rows):
    sets, root, least = _components(rows)
    expected = Counter(least[c] for c in {root[i] for i in range(len(rows)) if sets[i]})
    expected.update(d for i, (d, _) in enumerate(rows) if not sets[i])
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == expected


def test_jaccard_keeps_one_of_each_component_under_null_and_shared_ids(spark):
    x, y, z, v = (" ".join(f"{c}{i}" for i in range(60)) for c in "xyzv")
    near = y.replace("y0 ", "other ")
    rows = [(None, x), (None, x), (None, y), (None, near), (7, z), (7, z), (8, z), (7, v), (9, v), (None, "alone of all"), (7, "alone too")]
    kept = jaccard_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    group = {near: y}
    assert Counter((r.doc_id, group.get(r.text, r.text)) for r in kept) == Counter(
        [(None, x), (None, y), (7, z), (7, v), (None, "alone of all"), (7, "alone too")])


@pytest.mark.parametrize("block_shingles", [jaccard_join.BLOCK_SHINGLES, 900])
def test_jaccard_loses_no_link(docs, rows, empty, monkeypatch, block_shingles):
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", block_shingles)
    sets, root, least = _components(rows)
    other = [{frozenset(b) for b in sets if b != a and a and 100 * len(a & b) >= 80 * len(a | b)} for a in sets]
    expected = Counter((d, len(sets[i]), least[root[i]], len(other[i])) for i, (d, _) in enumerate(rows))
    assert max(k[3] for k in expected) > 2
    assert Counter(tuple(r) for r in jaccard_join.counted(docs).collect()) == expected
    pairs, members = jaccard_join.link_pairs(docs)
    pairs = [(r.a, r.b) for r in pairs.collect()]
    assert len(set(pairs)) == len(pairs) == len({frozenset((frozenset(a), b)) for a, o in zip(sets, other, strict=True) for b in o})
    n = Counter(c for p in pairs for c in p)
    assert Counter((r.doc_id, r.n_shingles, n[r.cls]) for r in members.collect()) == Counter(
        (d, len(sets[i]), len(other[i])) for i, (d, _) in enumerate(rows))
    assert jaccard_join.counted(empty).count() == 0


def test_jaccard_order_is_only_a_heuristic(docs, rows, monkeypatch):
    monkeypatch.setattr(jaccard_join, "ORDER_ROWS", 0)
    sets, root, least = _components(rows)
    expected = Counter((d, len(sets[i]), least[root[i]]) for i, (d, _) in enumerate(rows))
    assert Counter(tuple(r) for r in jaccard_join.linked(docs).collect()) == expected


def _benchmark(rows):
    return [(1, " ".join(words(rows[2][1])[:30]).upper()), (2, "the of"), (3, ""), (4, None), (None, rows[9][1]), (5, "no such words here at all")]


@pytest.mark.parametrize("block_chars", [decontamination.BLOCK_CHARS, 500])
def test_decontamination(spark, docs, rows, empty, block_chars):
    items = _benchmark(rows)
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    windows = defaultdict(set)
    for i, t in items:
        w = words(lower(t), ALNUM)
        for j in range(max(0, len(w) - 9) if len(w) >= 10 else bool(w)):
            windows[tuple(w[j:j + 10])].add("null" if i is None else str(i))
    sizes, expected = {len(k) for k in windows}, Counter()
    for d, t in rows:
        w, hit, met = words(lower(t), ALNUM), set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if (k := tuple(w[j:j + n])) in windows:
                    hit.update(range(j, j + n))
                    met |= windows[k]
        expected[(d, len(w), len(hit), tuple(sorted(met)))] += 1
    found = decontamination.hits(docs, bench, block_chars=block_chars)
    by_id = Counter((r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"]))) for r in found.collect())
    assert by_id == expected
    if block_chars < 1000:
        return
    kept = decontamination.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(k[0] for k, n in expected.items() if not k[2] for _ in range(n))
    assert decontamination.report(empty, bench).count() == 0
    assert not any(r.contaminated for r in decontamination.report(docs, bench.limit(0)).collect())


@pytest.mark.parametrize("block_chars", [decontamination.BLOCK_CHARS, 40])
def test_decontamination_counts_an_item_once(spark, block_chars):
    items = [(7, "alpha beta gamma"), (7, "alpha beta gamma"), (7, "delta epsilon"), (None, "alpha beta"), (None, "delta epsilon"), (8, "zeta")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(1, "alpha beta gamma delta epsilon"), (2, "zeta"), (None, "eta")], "doc_id long, text string")
    got = {(r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"]))) for r in decontamination.hits(docs, bench, block_chars=block_chars).collect()}
    assert got == {(1, 5, 5, ("7", "null")), (2, 1, 1, ("8",)), (None, 1, 0, ())}
    if block_chars > 40:
        report = {r.doc_id: (r.n_items, r.items_sha256) for r in decontamination.report(docs, bench).collect()}
        assert report[1] == (2, hashlib.sha256(b"7,null").hexdigest())


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, "alpha x beta y gamma"), (3, "gamma beta alpha"), (4, "alpha beta")], "doc_id long, text string")
    p = decontamination.phrases([7], ["alpha beta gamma"], 10)
    index = decontamination.build_index(docs)
    exact = {r.doc_id for r in decontamination.search(index, p).collect() if r.n_hit}
    near = {r.doc_id for r in decontamination.search(index, p, slop=2).collect() if r["items"]}
    assert exact == {1} and near == {1, 2}


def test_packing(docs, rows, empty):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    placed = packing.pack(docs).collect()
    expected = Counter()
    for d, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for a in range(0, len(ids), 2048):
            own = ids[a:a + 2048]
            expected[(d, a, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own)), len(ids))] += 1
    assert Counter(tuple(r)[:5] for r in placed) == expected
    sequences = defaultdict(list)
    for r in placed:
        sequences[r.sequence_id].append(r)
    for own in sequences.values():
        end = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= 2048
    assert packing.pack(empty).count() == 0


def test_packing_word_ids_match_the_tokenizer():
    from tokenizers import Tokenizer
    path = packing.default_tokenizer()
    tokenizer, own = Tokenizer.from_file(path), packing.WordIds(path)
    texts = ["It's we'll they've 12,345 <|endoftext|> a<|startoftext|>b", "Ünḯ \x1c\x85\u00a0x ΣΑΣ İ ﬁ e\u0301 \u0301x", "", " \t\n\x0b\x0c\r ", "日本語 テスト 한국어 😀👍🏽", "a_b-c  (d)!!"]
    texts += [f"{a}{b} {b}'{a}, {a}.{b}" for a in "àÀßÿöØIi×÷µªşŞ" for b in "abÉñ9_'%"]
    (chunk,) = words_of(pa.array(texts))
    ids, ends = own.of(chunk)
    begin = 0
    for t, end in zip(texts, ends.tolist(), strict=True):
        assert ids[begin:end].tolist() == tokenizer.encode(t, add_special_tokens=False).ids + [1]
        begin = end


def test_cutting_stock_is_near_its_bound():
    import numpy as np
    rng = np.random.default_rng(3)
    sizes = np.arange(1, 65)
    demand = rng.integers(0, 300, 64).astype(float)
    patterns = packing.cutting_stock(demand, sizes, 64)
    held = sum(n * c for n, c in patterns)
    assert (held == demand).all() and all((c * sizes).sum() <= 64 for _, c in patterns)
    greedy = sum(n for n, _ in packing.first_fit(demand.astype(np.int64), sizes, 64))
    assert (demand * sizes).sum() / 64 <= sum(n for n, _ in patterns) <= greedy


def test_language_id(spark, empty):
    import random
    rng = random.Random(5)
    syllables = {"en": ["the", "and", "ing", "tion", "ha"], "de": ["der", "und", "sch", "ung", "ö"], "fr": ["que", "eau", "les", "é", "ment"]}
    rows = [(i, " ".join(rng.choice(syllables[lang]) + rng.choice(syllables[lang]) for _ in range(30)), lang, "x")
            for i in range(300) for lang in [rng.choice(list(syllables))]]
    extra = [(1000, None, "en", "x"), (1001, "12 - !", "de", "x"), (None, "der und", "de", "x"), (1002, "THE AND", None, "x"), (0, rows[0][1], rows[0][2], "x")]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string, lang_pred string").repartition(3)
    got = language_id.identify(docs).collect()
    truth = {i: lang for i, _, lang, _ in rows}
    assert len(got) == len(rows) + len(extra)
    held = [r for r in got if r.doc_id in truth and r.held_out]
    assert held and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1000].lang_pred == by_id[1001].lang_pred == "und" and by_id[1002].lang_pred == "en"
    assert language_id.identify(empty).count() == 0
    unlabelled = language_id.identify(docs.filter("lang is null")).collect()
    assert [r.lang_pred for r in unlabelled] == ["und"]


def _kept_by_quality(rows):
    """The base rule and the threshold table, from the words alone."""
    kept = []
    for d, t in rows:
        w, seen = words(t), defaultdict(list)
        lines = [x for x in (t or "").split("\n") if words(x)]
        for j in range(len(w) - 7):
            seen[tuple(w[j:j + 8])].append(j)
        again = {p for at in seen.values() if len(at) > 1 for j in at for p in range(j, j + 8)}
        if len(w) < 20 or 100 * len(again) > 30 * len(w):
            continue
        stop = sum(lower(x) in quality_rules.STOP_WORDS or x.lower() in quality_rules.STOP_WORDS for x in w)
        if (1.5 <= sum(map(len, w)) / len(w) <= 25 and sum(c in "#*$%&|<>" for c in t) / len(w) <= 0.5 and stop / len(w) >= 0.02
                and (len(lines) - len(set(lines))) / len(lines) <= 0.5):
            kept.append((d, t))
    return kept


def _one_of_each_component(rows):
    sets, root, _ = _components(rows)
    chosen = {}
    for i, (d, _) in enumerate(rows):
        if sets[i]:
            order = -(2**63) if d is None else d
            if root[i] not in chosen or order < chosen[root[i]][0]:
                chosen[root[i]] = (order, i)  # of rows of one id only exact copies share a component here
    return [r for i, r in enumerate(rows) if not sets[i] or chosen[root[i]][1] == i]


def _clean_of(rows, items):
    windows = {tuple(w[j:j + 10]) for _, t in items for w in [words(lower(t), ALNUM)] for j in range(max(0, len(w) - 9) if len(w) >= 10 else bool(w))}
    sizes = {len(k) for k in windows}

    def hit(t):
        w = words(lower(t), ALNUM)
        return any(tuple(w[j:j + n]) in windows for n in sizes for j in range(len(w) - n + 1))
    return [r for r in rows if not hit(r[1])]


def test_pipeline_equals_the_brute_force_chain(spark, rows, tmp_path):
    """Texts, pieces and ids of run(), not only which documents are left; copies under null and shared ids as well."""
    import os
    import sys

    from tokenizers import Tokenizer
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    import corpus_pipeline as pipeline
    good = [r for r in rows if len(words(r[1])) > 150]
    header = " ".join(f"the head{i}" for i in range(40))
    every = rows + [(None, good[0][1])] * 3 + [(None, good[1][1])] * 2 + [(901, good[2][1])] * 2 + [(None, f"{header} and body{i} of the text") for i in range(3)] \
        + [(903, f"{header} and other{i} words of it") for i in range(2)]
    items = [(1, " ".join((rows[12][1] or "").split()[:40])), (None, "no such passage anywhere"), (3, None)]
    sf_dir = str(tmp_path)
    spark.createDataFrame([(i, t, "en", "s", None) for i, t in every], "doc_id long, text string, lang string, source string, n_chars long").repartition(5).write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    left = _one_of_each_component(_kept_by_quality(every))
    texts, _, later = repeated(left, 50)
    cut = [(d, " ".join(x for i, x in enumerate(w) if i not in gone) if gone else t) for (d, t), w, gone in zip(left, texts, later)]
    assert any(later) and len(cut) < len(every)
    clean = _clean_of(cut, items)
    assert len(clean) < len(cut)
    tokenizer, expected = Tokenizer.from_file(packing.default_tokenizer()), Counter()
    for d, t in clean:
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [1]
        for a in range(0, len(ids), 2048):
            own = ids[a:a + 2048]
            expected[(d, a, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own)), len(ids))] += 1
    assert Counter(tuple(r)[:5] for r in pipeline.run(spark, sf_dir).collect()) == expected


def test_packing_spreads_equal_rows(spark):
    """Rows of no id and one text fall into many blocks, so none ranks them alone."""
    docs = spark.createDataFrame([(None, "")] * 1500 + [(None, "same text")] * 500, "doc_id long, text string").repartition(2)
    blocks = packing.dealt(packing.pieces(docs, packing.default_tokenizer())).groupBy("kind", "salt").count().collect()
    assert max(r["count"] for r in blocks) <= 2 * 1500 / packing.SALTS + 2
    placed = packing.pack(docs).collect()
    assert len(placed) == 2000 and len({(r.sequence_id, r.offset) for r in placed}) == 2000
