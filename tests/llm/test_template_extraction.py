"""HTML extraction: the page reader, equivalence classes against brute force, and hand-made sites."""

from collections import Counter, defaultdict

import pytest

from wagelens.llm import template_extraction as te


def text(html, template=None):
    return te.main_text(te.Page(html), template)


@pytest.mark.parametrize("html, expected", [
    ("", ""),
    ("plain  words\nonly", "plain words only"),
    ("<article><h1>A &amp; B</h1><p><b>one<br>two<p>three</b></p></article>", "A & B\none two\nthree"),
    ("<nav><a href=x>menu</a></nav><article>text<footer>foot</footer></article><footer>f</footer>", "text"),
    ('<article><p>a &lt;b&gt; &#233;&nbsp; c &copy &unknown; 1 < 2 & 3</p></article>', "a <b> é c © &unknown; 1 < 2 & 3"),
    ('<script>var t="</p><article>no</article>";</script><article>yes<script>x</script><style>y</style></article>', "yes"),
    ("<article>kept<!-- <p>gone</p> --><p>too", "kept\ntoo"),
    ("<article>a<!-- never closed <p>b</p>", "a"),
    ("<article>a<script>never closed</p> b", "a"),
    ("<article><p>post</p><section class='comments'><article>c</article></section><article>nested</article></article>", "post"),
    ("<main><p>m</p><aside>s</aside></main><p>outside</p>", "m"),
    ("<main><article></article><p>m</p></main><p>outside</p>", "m"),
    ("<body class='no-sidebar has-ads'><div id=cookieNotice>c</div><div class='main-content'>text</div><div class='ad'>buy</div></body>", "text"),
    ("<div class='header'>logo</div><div>story</div><div role=contentinfo>imprint</div><form>f<p>g</form>", "story"),
    ("<article><header><h1>title</h1></header><div class=share>tweet</div>body<ul><li>x<li>y</ul></article>", "title\nbody\nx\ny"),
    ("<ul><li><a href=a>one</a></li><li><a href=b>two</a></li></ul><p>story with a <a href=c>link</a> in it</p>", "story with a link in it"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ('<article><p title="a > b" class=\'x\'>in</p></article>', "in"),
    ('<article><p title="never closed>in</p><p>next</p></article>', "in\nnext"),
    ("<article>" + "<b>" * 3000 + "deep</article>", "deep"),
    ("</p></div></article>stray</b>", "stray"),
    ("<article><p>a <button>x</button>b <span class=ad>y</span>c</p></article>", "a b c"),
    ("out<span itemprop=articleBody>in <b>bold</b></span>out", "in bold"),
    ("one<p>two</p>three<div>four</div>", "one\ntwo\nthree\nfour"),
    ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
])
def test_page_reader(html, expected):
    assert text(html) == expected


def test_long_text_is_kept_whole():
    words = " ".join(f"w{i}" for i in range(300_000))
    assert text(f"<article><p>{words}</p></article>") == words
    assert text("<article>" + "<p>x</p>" * 20_000 + "</article>") == "\n".join(["x"] * 20_000)


def test_walk_finds_order_and_nesting():
    class Fake:
        def __init__(self, tokens):
            self.tokens, self.blocks = tokens, []
    template = te.Template([[1, 2, 3], [10, 11], [20, 21]])
    assert template.walk(Fake([1, 10, 11, 10, 20, 21, 11, 2, 20, 21, 3]))[0] == set()
    assert template.walk(Fake([1, 3, 2]))[0] == {0}
    assert template.walk(Fake([1, 10, 2, 11, 3]))[0] == {1}
    assert template.walk(Fake([1, 2, 3, 10]))[0] == {1}
    assert template.walk(Fake([1, 20, 2, 3, 21]))[0] == {2}


def site(i, article, menu=("Home", "About", "Contact")):
    """A page without any telling element or class name."""
    links = "".join(f"<li><a href='/{m}/{i}'>{m} {i}</a></li>" for m in menu)
    return (f"<html><body><div id=c1><ul>{links}</ul></div><div id=c2>Welcome to our site</div><div id=c3>{article}</div>"
            f"<div id=c4>All rights reserved by Us</div></body></html>")


def test_a_site_without_telling_names(spark):
    rows = [(i, f"http://Site.example/{i}", site(i, f"<h2>Story {i}</h2><p>It is about {i * 7} things.</p>" + "<p>More.</p>" * (i % 3)), "x") for i in range(12)]
    rows += [(100 + i, f"http://other.example/{i}", site(i, f"<p>Lone {i}</p>"), "x") for i in range(2)]
    rows += [(200 + i, "http://copies.example/", site(0, "<p>The same page again.</p>"), "x") for i in range(9)]
    rows += [(300, None, None, "x"), (301, "no host", "<p>kept</p>", "x"), (None, "http://site.example/null", site(40, "<p>No id.</p>"), "x"), (302, "http://e.example/", "", "x")]
    rows += [rows[3]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(4)
    got = Counter((r.page_id, r.url, r.text, r.n_chars) for r in te.extract(pages).collect())
    expected = Counter()
    for page_id, url, html, _ in rows:
        if page_id is None:
            out = "No id."
        elif page_id < 100:
            out = "\n".join([f"Story {page_id}", f"It is about {page_id * 7} things."] + ["More."] * (page_id % 3))
        elif page_id < 200:
            out = f"Welcome to our site\nLone {page_id - 100}\nAll rights reserved by Us"
        elif page_id < 300:
            out = "Welcome to our site\nThe same page again.\nAll rights reserved by Us"
        else:
            out = "kept" if page_id == 301 else ""
        expected[page_id, url, out, len(out)] += 1
    assert got == expected


def test_classes_equal_brute_force(spark):
    rows = [(i, f"http://h{i % 2}.example/", site(i, "".join(f"<p>{'abc'[j % 3]} word{i}</p>" + ("<hr><i>note</i>" if i % 4 else "") for j in range(i % 5 + 1)))) for i in range(30)]
    rows.append((90, "http://h0.example/x", rows[4][2]))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", te.host_of(te.F.col("url")))
    found = {r.host: {tuple(t % 2**64 for t in c) for c in r.classes if c} for r in te.templates(pages).collect()}
    for h in range(2):
        different = {html: te.Page(html) for i, url, html in rows if url.startswith(f"http://h{h}.")}
        vectors, at = defaultdict(list), Counter()
        for n, page in enumerate(different.values()):
            for token, times in Counter(page.tokens).items():
                vectors[token].append((n, times))
                at[token] += page.tokens.index(token)
        classes = defaultdict(list)
        for token, vector in vectors.items():
            if len(vector) >= te.SUPPORT * len(different):
                classes[tuple(vector)].append(token)
        frequent = {tuple(sorted(c, key=lambda t: at[t])) for c in classes.values() if len(c) > 1}

        def instances(c, page):
            return list(zip(*([i for i, t in enumerate(page.tokens) if t == token] for token in c)))

        def flat(c, page):
            return [x for instance in instances(c, page) for x in instance]

        def crossed(c, page):
            """Does a token of an instance begun earlier stand within an instance of c?"""
            return any(d != c and other[0] < mine[0] and any(mine[0] < x < mine[-1] for x in other)
                       for mine in instances(c, page) for d in ordered for other in instances(d, page))

        ordered = {c for c in frequent if all(flat(c, p) == sorted(flat(c, p)) for p in different.values())}
        expected = {c for c in ordered if not any(crossed(c, p) for p in different.values())}
        assert found[f"h{h}.example"] == expected and len(expected) > 1


def test_every_page_goes_through_the_template(monkeypatch):
    """A page with an article is walked as any other, and its text comes from the slots."""
    walked = []
    walk = te.Template.walk
    monkeypatch.setattr(te.Template, "walk", lambda self, page, *a: walked.append(page) or walk(self, page, *a))
    template = te.Template([te.Page("<body><article></article><p></p></body>").tokens])
    assert text("<body><article><h1>Title</h1></article><p>else</p></body>", template) == "Title"
    assert text("<body><article></article><p>else</p></body>", template) == "else"
    assert len(walked) == 2


def test_menus_are_found_under_the_classes_that_stay(spark):
    """A class that one page breaks is no class: its menu is one of the slot around it, on all pages, those with an article included."""
    def page(i, article):
        entry = ("<i></i>{}<b></b>" if i else "<b></b>{}<i></i>").format(f"<p><a href=x>{f'link {i}' if i else ''}</a></p>")
        return f"<html><body><div id=m>{2 * entry}</div><div id=s>{article}</div></body></html>"
    rows = [(i, f"http://a.example/{i}", page(i, f"<article>Marked {i}</article>" if i % 2 else f"<p>Plain {i}</p>")) for i in range(10)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    (found,) = te.templates(pages.withColumn("host", te.host_of(te.F.col("url")))).collect()
    assert [] in found.classes and [m["class"] for m in found.menus] == [next(i for i, c in enumerate(found.classes) if c)]
    got = {r.page_id: r.text for r in te.extract(pages).collect()}
    assert got == {i: f"Marked {i}" if i % 2 else f"Plain {i}" for i in range(10)}


def test_empty_table(spark):
    out = te.extract(spark.createDataFrame([], "page_id long, url string, html string"))
    assert out.columns == ["page_id", "url", "text", "n_chars"] and out.count() == 0
