"""WARC archives, URL filters, quotation linking, components and the pipeline."""

import base64
import hashlib
import os
import sys
from collections import Counter

import pytest

from wagelens.llm import quote_links, url_filters, warc_zstd
from wagelens.llm.components import components

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


def test_warc_round_trip(spark):
    same = "same payload\r\n\r\nwith a gap"
    rows = [(i, f"http://h{i}/", f"<p>{i} é</p>" * (i % 50)) for i in range(120)]
    rows += [(500, "u", same), (499, None, same), (501, "bad\r\nurl", same), (499, "u", same), (None, None, None), (None, "u", same), (502, "big", "x" * 3_000_000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, first string").repartition(4)
    first = {}
    for p, _, html in rows:
        if p is not None:
            x = (html or "").encode()
            first[x] = min(first.get(x, p), p)
    expected = Counter()
    for p, _, html in rows:
        x = (html or "").encode()
        refers = None if p == first.get(x, p) else first[x]
        expected[(p, len(x), base64.b32encode(hashlib.sha1(x).digest()).decode(), "response" if refers is None else "revisit", refers)] += 1
    got = warc_zstd.round_trip(pages).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected
    assert warc_zstd.round_trip(pages.limit(0)).count() == 0


def _archive(records, dictionary=b""):
    import zstandard
    own = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    c = zstandard.ZstdCompressor(dict_data=own, write_checksum=True)
    return warc_zstd.skippable(warc_zstd.DICTIONARY_MAGIC, dictionary) + b"".join(c.compress(r) + warc_zstd.SEPARATOR.encode() for r in records)


def test_warc_reader_validates():
    good = warc_zstd.record(1, "http://a/", b"payload", None)
    dictionary = warc_zstd.train_dictionary([warc_zstd.record(i, f"http://h{i}/{i * i}", b"<p>%d text %d</p>" % (i, i * 7) * 40, None) for i in range(300)])
    assert dictionary
    for own in (b"", dictionary):
        content = _archive([good, warc_zstd.record(2, None, b"", 1)], own)
        assert [h["WARC-Type"] for h, _ in warc_zstd.read_archive(content)] == ["response", "revisit"]
        with pytest.raises(ValueError):
            list(warc_zstd.read_archive(content[:-20]))
    for bad in (good.replace(b"WARC/1.1", b"WARC/9.9"), good.replace(b"Content-Length: ", b"Content-Length: 9"), good.replace(b"WARC-Date", b"X-Date"),
                good.replace(b"WARC-Type: response", b"WARC-Type: nonsense"), good + b"x"):
        with pytest.raises(ValueError):
            list(warc_zstd.read_archive(_archive([bad])))
    with pytest.raises(ValueError):
        list(warc_zstd.read_archive(b"not an archive at all"))


def test_url_parts_and_rules(spark):
    urls = {None: ("", "", None, "allow"), "no scheme/net/": ("", "", None, "allow"), "HTTP://A.NET/x?y": ("a.net", "/x", "net/", "block"),
            "http://net": ("net", "", None, "allow"), "http://notnet/": ("notnet", "/", None, "allow"),
            "https://m.Example.net/en/1#t": ("m.example.net", "/en/1", "example.net/en/", "allow"),
            "https://example.net/de/1": ("example.net", "/de/1", "net/", "block"), "http://x.example.com/de/": ("x.example.com", "/de/", "example.com/de/", "block"),
            "http://a.org/fr/#x": ("a.org", "/fr/", "org/fr/", "allow"), "http://É.ORG?q=/fr/": ("É.org", "", None, "allow"),
            "a://b://c/d": ("b:", "//c/d", None, "allow")}
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(None, "http://q.net/")], "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters.judge(pages, labels).collect()}
    assert [got[i] for i in range(len(urls))] == list(urls.values()) and got[None][3] == "block"
    assert url_filters.judge(pages.limit(0), labels).count() == 0


def test_url_rules_mined_from_labels(spark):
    pages = [(i, f"http://{'spam' if i % 4 == 0 else 'good'}{i % 3}.example.com/{'win' if i % 4 == 0 else 'news'}/{i}") for i in range(400)]
    pages += [(400, "http://new.example.com/win/zz"), (401, "http://new.example.com/news/zz"), (401, "http://new.example.com/news/zz")]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(300)] + [(None, 0, 1), (5, None, None)]
    got = url_filters.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(pages)
    assert all(r.verdict == ("block" if "/win" in r.path else "allow") for r in got)


def test_url_rules_rest_on_pages_not_on_the_table_size(spark):
    def verdicts(n_bad, n_good):
        pages = [(i, f"http://evil.example.com/a{i}") for i in range(n_bad)] + [(1000 + i, f"http://h{i}.example.com/b{i}") for i in range(n_good)]
        labels = [(i, 1, int(i < 1000)) for i, _ in pages]
        got = url_filters.judge(spark.createDataFrame(pages + [(99999, "http://evil.example.com/new")], "page_id long, url string"),
                                spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
        return {r.host: r.verdict for r in got}
    few, enough = verdicts(3, 100), verdicts(18, 12000)
    assert set(few.values()) == {"allow"}
    assert enough.pop("evil.example.com") == "block" and set(enough.values()) == {"allow"}


def test_quote_links_find_another_conversation_than_their_own(spark):
    rows = [(3, 0, "u", "> Fine."), (3, 4, "a", "Fine."), (7, 1, "u", "Fine."), (9, 2, "u", "Fine."), (9, 0, "u", "> Fine.\nno"), (5, 0, "u", "> Mine"), (5, 1, "u", "Mine")]
    got = {(r.conv_id, r.turn): r for r in quote_links.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    sources = {k: [tuple(s) for s in r.sources or []] for k, r in got.items() if r.n_quoted}
    assert sources == {(3, 0): [(7, 1, 1)], (9, 0): [(3, 4, 1)], (5, 0): []}


def test_quote_links(spark):
    rows = [(1, 0, "u", "Hello there\nHow are you?"), (1, 1, "a", "> How are you?\nFine."), (1, 2, "u", "Bob wrote:\n> > How are you?\n> Fine.\nGood"),
            (1, 3, "x", ">  hello   THERE\nback to first"), (2, 0, "u", "> Fine.\nquoting elsewhere"), (2, 5, "u", "after a gap"), (None, 1, "u", "> a"),
            (3, None, "u", "t"), (3, 0, None, None), (1, 1, "a", "> How are you?\nFine."), (4, 0, "u", "> nobody wrote this")]
    messages = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, level int")
    got = quote_links.link(messages).collect()
    assert Counter((r.conv_id, r.turn, r.reply_to, r.thread_root, r.depth, r.n_quoted, r.n_linked, r.clean_text) for r in got) == Counter([
        (1, 0, None, 0, 0, 0, 0, "Hello there\nHow are you?"), (1, 1, 0, 0, 1, 1, 1, "Fine."), (1, 1, 0, 0, 1, 1, 1, "Fine."), (1, 2, 1, 0, 2, 2, 2, "Good"),
        (1, 3, 0, 0, 1, 1, 1, "back to first"), (2, 0, None, 0, 0, 1, 1, "quoting elsewhere"), (2, 5, 0, 0, 1, 0, 0, "after a gap"),
        (None, 1, None, None, 0, 0, 0, ""), (3, None, None, None, 0, 0, 0, "t"), (3, 0, None, 0, 0, 0, 0, ""), (4, 0, None, 0, 0, 1, 0, "")])
    assert quote_links.link(messages.limit(0)).count() == 0


def test_quote_links_of_a_long_chain(spark):
    messages = spark.createDataFrame([(1, i, "u", f"line {i}" + (f"\n> line {i - 1}" if i else "")) for i in range(200)], "conv_id long, turn long, role string, text string")
    got = {r.turn: r for r in quote_links.link(messages).collect()}
    assert all(got[i].depth == i and got[i].thread_root == 0 and got[i].reply_to == (i - 1 if i else None) for i in range(200))


def test_components(spark):
    import random
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_stages(spark, docs, rows, tmp_path):
    import corpus_pipeline as pipeline
    sf_dir = str(tmp_path)
    plain = docs.withColumnRenamed("row", "source")
    plain.write.parquet(f"{sf_dir}/documents.parquet")
    leaked = " ".join((rows[12][1] or "").split()[:40])
    spark.createDataFrame([(1, leaked)], "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    now, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, now, sf_dir)
        assert out.columns == plain.columns
        ids = Counter(r.doc_id for r in out.select("doc_id").collect())
        assert ids <= (seen[-1] if seen else Counter(i for i, _ in rows))
        seen.append(ids)
        now = out
    pieces = pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in pieces.collect()} == set(seen[-1])
    assert seen[0] != seen[1] and seen[2] == seen[1]
