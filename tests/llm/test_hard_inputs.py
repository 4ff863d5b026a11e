"""Inputs made to break an operator: texts that defeat polynomial hashes, shared urls, rows without ids, extreme turns."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from wagelens.llm import decontamination, jaccard_join, packing, quote_links, substring_dedup, suffix_dedup, url_filters
from wagelens.llm.text_kernel import window_hashes, words_of

DOCS = "doc_id long, text string"


def thue_morse(a, b, n=1024):
    """The word of length n over a, b and its complement: equal under every polynomial hash modulo 2^64."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return [(a, b)[x] for x in bits], [(b, a)[x] for x in bits]


WORDS = ["".join(w) for w in thue_morse("a", "b")]
WINDOWS = [" ".join(w) for w in thue_morse("ab", "ba")]


def test_hashes_tell_thue_morse_apart():
    (words,) = words_of(pa.array([f"{WORDS[0]} {WORDS[1]}"]))
    h = words.word_hashes()
    assert h[0] != h[1]
    (words,) = words_of(pa.array([f"{WINDOWS[0]} {WINDOWS[1]}"]))
    one, two = window_hashes(words.word_hashes(), np.array([0, 1024]), np.array([1024, 2048]))
    assert one[0] != one[1] and two[0] != two[1] and one[0] != two[0]


def test_operators_tell_thue_morse_apart(spark):
    def docs(*texts):
        return spark.createDataFrame(list(enumerate(texts, 1)), DOCS)
    assert [r.component_id for r in sorted(jaccard_join.linked(docs(*WORDS)).collect())] == [1, 2]
    assert {r.component_id for r in jaccard_join.linked(docs(WORDS[0], WORDS[0], WORDS[1])).collect()} == {1, 3}
    # 41 words each, no window of 35 shared but by a false equality of the long words
    pair = [" ".join([f"{x}{i}" for i in range(20)] + [w] + [f"{x}{i}" for i in range(20, 40)]) for x, w in zip("xx", WORDS)]
    assert {r.n_removed for r in substring_dedup.remove_repeats(docs(*pair)).collect()} == {0}
    long_ = suffix_dedup.report(docs(" ".join(f"l{i}" for i in range(30)) + f" {WORDS[0]} " + " ".join(f"r{i}" for i in range(30)),
                                     " ".join(f"l{i}" for i in range(30)) + f" {WORDS[1]} " + " ".join(f"r{i}" for i in range(30))))
    assert {r.n_repeated for r in long_.collect()} == {0}
    bench = spark.createDataFrame([("item", WORDS[0])], "item_id string, text string")
    assert [r.contaminated for r in sorted(decontamination.report(docs(*WORDS), bench).collect())] == [True, False]


def test_packing_takes_words_by_their_bytes(monkeypatch):
    """Even where all hashes are equal."""
    import public_tokenizers

    from wagelens.llm.text_kernel import Words
    encoder = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    texts = [f"{WORDS[0]} {WORDS[1]} alpha beta", "gamma alpha", ""]
    expected = [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, packing.END_ID] for t in texts]
    for patched in (False, True):
        if patched:
            monkeypatch.setattr(Words, "word_hashes", lambda self: np.zeros(len(self.start), dtype=np.uint64))
        (words,) = words_of(pa.array(texts))
        ids, ends = encoder.of(words)
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == expected


def test_rows_without_an_id_lose_their_copies(spark):
    """Different rows of no id, or of one id, with one header at the same place: one copy stays."""
    header = " ".join(f"head{i}" for i in range(60))
    for ids in ((None, None, None), (7, 7, 7), (None, 1, 2)):
        docs = spark.createDataFrame([(i, f"{header} body{n} of its own") for n, i in enumerate(ids)], DOCS)
        got = suffix_dedup.report(docs).collect()
        assert sorted(r.n_removed for r in got) == [0, 60, 60] and {r.n_repeated for r in got} == {60}
        texts = sorted(r.text for r in suffix_dedup.drop_repeats(docs).collect())
        assert [t.startswith("body") for t in texts] == [True, True, False]
    same = spark.createDataFrame([(None, header), (None, header)], DOCS)
    assert {r.n_removed for r in suffix_dedup.report(same).collect()} == {0}  # identical rows: the same place


# ------------------------------------------------------------------ operator 8


def brute_verdicts(pages, labels):
    """Block by any combination of tokens whose Wilson interval reaches the threshold, over all subsets."""
    def tokens(url):
        host, _, rest = url.partition("://")[2].partition("/")
        path, _, query = rest.partition("?")
        return frozenset([f"h:{x}" for x in host.split(".") if x] + [f"p:{x}" for x in path.split("/") if x] + [f"q:{x.split('=')[0]}" for x in query.split("&") if x.split("=")[0]])

    by_id, z = dict(labels), url_filters.Z
    seen = [(tokens(u), by_id[i]) for i, u in pages if i in by_id]
    subsets = {frozenset(c) for t, bad in seen if bad for n in range(1, len(t) + 1) for c in itertools.combinations(sorted(t), n)}
    rules = []
    for s in subsets:
        n, bad = sum(s <= t for t, _ in seen), sum(s <= t for t, b in seen if b)
        p = bad / n
        low = (p + z * z / (2 * n) - z * (p * (1 - p) / n + z * z / (4 * n * n)) ** 0.5) / (1 + z * z / n)
        if low >= url_filters.MIN_CONFIDENCE:
            rules.append(s)
    return {i: "block" if any(r <= tokens(u) for r in rules) else "allow" for i, u in pages}, rules


def verdicts(spark, pages, labels):
    got = url_filters.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame([(i, 1, b) for i, b in labels], "doc_id long, quality int, toxic int"), rules=())
    return {r.page_id: r.verdict for r in got.collect()}


def test_mined_rules_equal_brute_force(spark):
    rng = random.Random(4)
    pages, labels = [], []
    for i in range(700):
        parts = rng.sample(["a", "b", "c", "d"], 2)
        bad = parts == ["a", "b"] or (parts[0] == "c" and i % 3 == 0)
        key = "k=1" if parts[0] == "c" and i % 3 == 0 else "m=1"
        extra = "/twin1/twin2" if i % 2 else ""
        pages.append((i, f"http://h{i % 3}.example.com/{parts[0]}/{parts[1]}{extra}?{key}"))
        if i < 600:
            labels.append((i, int(bad and rng.random() < 0.97)))
    pages += [(1000, "http://x.example.com/a/b"), (1001, "http://x.example.com/twin1"), (1002, "http://h0.example.com/c?k=2"), (1003, "http://new.org/")]
    expected, rules = brute_verdicts(pages, labels)
    assert len(rules) > 2 and min(map(len, rules)) >= 1 and any(len(r) == 2 for r in rules)
    assert verdicts(spark, pages, labels) == expected
    assert set(expected.values()) == {"block", "allow"}


@pytest.mark.parametrize("good", [0, 60])
def test_pages_that_share_a_long_url(spark, good):
    """30 tokens that always come together are one; half of them on good pages as well are two."""
    url = "http://a.b.example.com/" + "/".join(f"s{i}" for i in range(25)) + "?key=1"
    pages = [(i, url) for i in range(40)] + [(100 + i, "http://a.b.example.com/" + "/".join(f"s{i}" for i in range(12))) for i in range(good)]
    pages += [(900, url), (901, "http://z.org/s24"), (902, "http://z.org/s0/s1")]
    labels = [(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(good)]
    got = verdicts(spark, pages, labels)
    assert got[0] == got[900] == got[901] == "block" and got[902] == ("allow" if good else "block")
    assert all(got[100 + i] == "allow" for i in range(good))


# ------------------------------------------------------------------ operator 7


@pytest.mark.parametrize("kind, most", [("int", 2**31 - 1), ("long", 2**63 - 1), ("short", 2**15 - 1)])
def test_largest_turn_and_gaps(spark, kind, most):
    turns = [0, 1, 3, 1023, 1024, 5000, most - 1, most]
    rows = [(1, t, "u", "x") for t in turns] + [(2, -most, "u", "x"), (2, most, "u", "x"), (3, most, "u", "x")]
    got = {(r.conv_id, r.turn): r for r in quote_links.link(spark.createDataFrame(rows, f"conv_id long, turn {kind}, role string, text string")).collect()}
    assert [got[1, t].reply_to for t in turns] == [None, *turns[:-1]] and [got[1, t].depth for t in turns] == list(range(len(turns)))
    assert got[2, most].reply_to == -most and got[3, most].reply_to is None


def test_crc_is_of_the_tokenizers_ids(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = f"{WORDS[0]} {WORDS[1]}"
    ids = [*tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID]
    (row,) = packing.pack(spark.createDataFrame([(1, text)], DOCS)).collect()
    assert row.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes()) and row.doc_tokens == len(ids)


def test_quote_links_equal_their_sql(spark):
    """The recursive SQL of the query, on conversations made to quote one another in every way."""
    import duckdb

    from wagelens.llm.oracle import ORACLE_SQL
    rng = random.Random(9)
    said = [f"Line {i} of what was said" for i in range(12)] + ["fine.", "  FINE. ", "Straße Ñ"]
    rows = []
    for conv in [None, 1, 2, 3, 4]:
        for turn in [None, *sorted(rng.sample(range(40), 12))]:
            lines = [rng.choice(["", "", "> ", ">> ", "> > ", " >"]) + rng.choice(said) for _ in range(rng.randint(0, 5))]
            if rng.random() < 0.3:
                lines.insert(0, rng.choice(["Bob wrote:", "Ana escribió :", "wrote:"]))
            rows.append((conv, turn, rng.choice(["user", None]), rng.choice([None, "", "\n".join(lines), "\n\n" + "\n".join(lines) + "\n"]) if rng.random() < 0.2 else "\n".join(lines)))
    rows += rows[5:8]
    schema = "conv_id long, turn int, role string, text string"
    got = quote_links.link(spark.createDataFrame(rows, schema).repartition(3))
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn INTEGER, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    sql = con.sql(ORACLE_SQL["op7_quote_links"])
    assert sorted(sql.columns) == sorted(got.columns)
    at = sql.columns.index("sources")
    expected = sorted((tuple([tuple(s.values()) for s in v] if i == at and v else v for i, v in enumerate(r)) for r in sql.fetchall()), key=str)
    found = sorted((tuple([tuple(s) for s in r[c]] if c == "sources" and r[c] else r[c] for c in sql.columns) for r in got.collect()), key=str)
    assert found == expected and any(r[at] for r in found)
