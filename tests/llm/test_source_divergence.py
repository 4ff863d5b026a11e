"""Source divergence audit against brute force."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from wagelens.llm import source_divergence as sd

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))) for text, lang, source in rows]
    groups, df, counts = defaultdict(set), Counter(), Counter()
    for lang, source, words in docs:
        groups[lang].add(source)
        df.update((lang, w) for w in set(words))
        counts.update((lang, source, w) for w in words)
    out = []

    def ranked(lang, source, part, values, top):
        values.sort(key=lambda x: (-x[1], x[0].encode()))
        out.extend((lang, source, part, item, v, i) for i, (item, v) in enumerate(values[:top], 1))

    for lang, sources in groups.items():
        kept = [w for (x, w), n in df.items() if x == lang and n >= 3]
        total = {s: sum(counts[lang, s, w] for w in kept) for s in sources}
        p = {s: {w: 1 + 10**9 * (counts[lang, s, w] + 1) // (total[s] + len(kept)) for w in kept} for s in sources}
        everywhere = {w: sum(counts[lang, s, w] for s in sources) for w in kept}
        q = {w: 1 + 10**9 * (everywhere[w] + 1) // (sum(total.values()) + len(kept)) for w in kept}
        for s in sources:
            ranked(lang, s, "pair", [(h, sum((p[s][w] - p[h][w]) ** 2 // p[h][w] for w in kept)) for h in sources if h != s], None)
            ranked(lang, s, "term", [(w, (p[s][w] - q[w]) ** 2 // q[w]) for w in kept if counts[lang, s, w] and p[s][w] > q[w]], 200)
    return Counter(out)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    words = [f"{a}{b}" for a in "abcdefghij" for b in ("x", "yé", "Zß", "ñ")] + ["The", "the", "tHE"]
    rows = []
    for _ in range(150):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["s0"] * 6 + ["s1", "s2", None, "É"])
        rows.append((" ".join(rng.choices(words, k=rng.randint(0, 60))) + rng.choice(["", "1x-y_z", "\n\t"]), lang, source))
    rows += [(None, "en", "s0"), ("", "en", "empty"), ("only once here", "xx", "a"), ("", "xx", "b"), (None, "one", None)]
    rows += [("huge " * 40_000, "en", "s2")] + [("same same words", "en", "s1")] * 3
    rows += [(" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}q" for i in range(300)), "en", "many")] * 3
    return rows


def test_audit_equals_brute_force(spark, texts):
    docs = spark.createDataFrame([(*r, "clash", 1) for r in texts], "text string, lang string, source string, term string, rank int").repartition(7)
    got = sd.audit(docs).collect()
    assert Counter(tuple(r) for r in got) == brute(texts)
    assert max(r.rank for r in got if r.part == "term") == 200
    assert {r.value for r in got if r.lang == "xx"} == {0}


def test_empty_table(spark):
    out = sd.audit(spark.createDataFrame([], "doc_id long, text string, lang string, source string"))
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"] and out.count() == 0


def test_scatter_does_not_depend_on_its_cuts(monkeypatch):
    rng = random.Random(5)
    n_groups, counts = 9, [{g: rng.randint(1, 50) for g in rng.sample(range(9), rng.randint(1, 9))} for _ in range(60)]
    total = [sum(c.get(g, 0) for c in counts) + len(counts) for g in range(n_groups)]
    block = pa.table({"postings": pa.array([[{"source": f"s{g}", "n": n} for g, n in c.items()] for c in counts], pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())])))})
    p = [[1 + 10**9 * (c.get(g, 0) + 1) // total[g] for c in counts] for g in range(n_groups)]
    expected = {(g, h): sum((a - b) ** 2 // b for a, b in zip(p[g], p[h])) for g in range(n_groups) for h in range(n_groups)}
    for rows, gather in ((500, 10**6), (2, 7), (1, 1)):
        monkeypatch.setattr(sd, "ROW_GROUPS", rows)
        monkeypatch.setattr(sd, "GATHER", gather)
        found = Counter()
        for part in range(-(-n_groups // rows)):
            groups = pa.table({"lang": ["en"] * n_groups, "slice": [part] * n_groups, "source": [f"s{g}" for g in range(n_groups)], "g": range(n_groups), "total": total})
            for r in sd._scatter(block, groups).to_pylist():
                found[r["g"], r["h"]] += r["part"]
        z = [1 + 10**9 // t for t in total]
        for g, h in expected:
            assert len(counts) * ((z[g] - z[h]) ** 2 // z[h]) + found[g, h] == expected[g, h]


def test_shares_are_exact_beyond_64_bits():
    import numpy as np
    big = np.array([9_000_000_001, 5], dtype=np.int64)
    assert sd._shares(big, np.array([10**10, 10**10])).tolist() == [1 + 10**9 * 9_000_000_002 // 10**10, 1]
