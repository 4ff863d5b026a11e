"""HTML extraction (operator 12): the pages of a host share a template; what is left in its slots is the page's own text.

1. *Tokens.*  A page is read into tags (with class and id) and the words of its text, each told apart by the path of
   open elements that it stands in; a run of more than ``RUN_WORDS`` words is one token.
2. *Occurrence vectors.*  For every (host, token) Spark adds up how many pages have it and a fingerprint of
   (page, times it occurs there) over all of them.  Tokens of equal vectors form an equivalence class; kept are those of
   ``CLASS_TOKENS`` tokens and more, on ``SUPPORT`` of the host's different pages and more, put in order by the sum of
   their first positions.
3. *Validity.*  A class is valid if on every page its tokens come in order, instance by instance, and each instance lies
   within one gap of every class around it.  One walk with a stack checks both and gives the nesting: the template.
4. *Slots.*  A slot is a gap of a valid class (and the path and zone in it).  Spark adds up each slot's characters and
   link characters over all pages of the host: a slot that is mostly links is a menu.  The first walk can't know yet
   which classes fail on other pages, so a block is counted under all classes open around it, and the innermost of
   them that is valid on every page is its slot.
5. *Extraction.*  The walk is done again with the valid classes on every page, and each slot's blocks are kept or dropped:
   * chrome goes: ``nav``, ``footer``, ``aside``, forms, scripts and the like, the equal ``role``s, and elements whose
     class or id says so (adverts, notices, menus, comments ...); ``header`` as well, outside of an article;
   * menu slots and blocks made of template tokens only go, unless they are in an ``article`` or ``main``, whose text is
     kept whole;
   * if the slots left hold text of an ``article``, that is the page's text (an article within an article is a comment or
     a teaser and goes), else that of ``main``, else all of it.

Words inside an article or main element get no token: nothing of an article is template.  A host with fewer than
``MIN_PAGES`` different pages, or no host, has no template; there a path of mostly links on the page is a menu.

Defined results: null html is empty; a page without text has text '' and 0 characters; unclosed and crossing elements
are closed as HTML parsers do, a raw element or comment that is never closed runs to the end; equal pages of a host
(under different ids) count once for its template; repeated rows give repeated rows; other columns are not read; an empty table gives an
empty result.  ``br`` is white space; so is every character that Unicode calls so.
"""

from __future__ import annotations

import html as html_entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagelens.llm.shared import written
from wagelens.llm.text_kernel import mix

SUPPORT = 0.8
MIN_PAGES = 3
CLASS_TOKENS = 2
RUN_WORDS = 16
#: Templates of at most this many tokens in all are sent to every executor (8 bytes each), larger ones are shuffled.
BROADCAST_TOKENS = 2_000_000
#: Hosts whose opened template a task remembers.
HELD_HOSTS = 1000

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary "
                  "table tbody td tfoot th thead title tr ul".split())
CHROME_TAGS = frozenset("aside audio button canvas dialog fieldset footer form head iframe label legend menu nav noembed noframes noscript object "
                        "optgroup option script search select style svg template textarea title video".split())
CHROME_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: An element opened closes the nearest of the first set, unless one of the second stands between.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
# Words of class and id names that mark what is not the article, whole or as the beginning of a word.
CHROME_WORDS = frozenset("ad ads adsense aside alert banner consent footer gdpr legal login menu modal nav notice notices notification overlay "
                         "pager popup promo promotion rail related recommended reply replies respond search share sharing signup skip social "
                         "toolbar widget widgets".split())
CHROME_STARTS = ("advert", "breadcrumb", "comment", "cookie", "copyright", "disqus", "navbar", "navig", "newsletter", "pagina", "sidebar", "sponsor", "subscri")
OUTER_WORDS = frozenset("header masthead topbar".split())
LAYOUT_WORDS = frozenset("has layout no with without".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|</[^a-zA-Z>][^>]*+(?:>|\Z)|</>
                        |<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}

#: What a block stands in; of those after the first, the text is that of the first found.
CHROME, ARTICLE, MAIN, BODY = range(4)


def _marked(names: str) -> tuple[bool, bool]:
    """Do class or id names speak of chrome, and of a page header?"""
    chrome = outer = False
    for name in names.split():
        words = {w.lower() for w in _NAME_WORD.findall(name)}
        if not words & LAYOUT_WORDS:
            chrome = chrome or bool(words & CHROME_WORDS) or any(w.startswith(CHROME_STARTS) for w in words)
            outer = outer or bool(words & OUTER_WORDS)
    return chrome, outer


class Page:
    """tokens: 64-bit names in page order; blocks: (first token, one beyond the last, text, link characters, zone, path)."""

    def __init__(self, source: str):
        self.tokens: list[int] = []
        self.blocks: list[tuple[int, int, str, int, int, int]] = []
        # Open elements: name, path, zone, and the place in the stack of the block that their text belongs to.
        self._stack: list[tuple[str, int, int, int]] = [("", 0, BODY, 0)]
        self._open: Counter = Counter()
        self._names: dict[str, tuple[bool, bool]] = {}
        self._pieces: list[str] = []
        self._link = 0
        self._read(source)

    def _read(self, source: str) -> None:
        at, pieces, end = 0, self._pieces, len(source)
        while at < end:
            m = _TOKEN.search(source, at)
            if m is None:
                self._text(source[at:])
                break
            if m.start() > at:
                self._text(source[at: m.start()])
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            name = name.lower()
            if m[1] or m[4]:
                self._close(name)
                continue
            attributes = m[3] or m[6] or ""
            if name == "br":
                pieces.append(" ")
            elif name in VOID:
                if name == "hr":
                    self._flush()
            else:
                self._opened(name, attributes)
                if name in RAW:
                    stop = _RAW_END[name].search(source, at)
                    at = stop.start() if stop else end
        self._flush()

    def _text(self, text: str) -> None:
        _, _, zone, block = self._stack[-1]
        if zone == CHROME and self._stack[block][2] != CHROME:  # a button, say, within a paragraph
            return
        text = html_entities.unescape(text) if "&" in text else text
        self._pieces.append(text)
        if self._open["a"]:
            self._link += len(text.strip())

    def _flush(self) -> None:
        """What was read since the last block boundary is a block."""
        if not self._pieces:
            return
        words = "".join(self._pieces).split()
        if words:
            _, path, zone, _ = self._stack[self._stack[-1][3]]
            first, text = len(self.tokens), " ".join(words)
            if zone in (CHROME, BODY):
                self.tokens += [xxhash.xxh64_intdigest(w, path) for w in (words if len(words) <= RUN_WORDS else [text])]
            self.blocks.append((first, len(self.tokens), text, min(self._link, len(text)), zone, path))
        self._pieces.clear()
        self._link = 0

    def _opened(self, name: str, attributes: str) -> None:
        if name in BLOCK:
            if self._open["p"]:
                i = len(self._stack) - 1
                while i and self._stack[i][0] not in BLOCK:
                    i -= 1
                if self._stack[i][0] == "p":
                    self._drop_to(i)
            if name in CLOSES:
                ends, bars = CLOSES[name]
                if any(self._open[x] for x in ends):
                    i = len(self._stack) - 1
                    while i and self._stack[i][0] not in ends and self._stack[i][0] not in bars:
                        i -= 1
                    if self._stack[i][0] in ends:
                        self._drop_to(i)
        elif name == "a" and self._open["a"]:
            self._close("a")
        found = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)} if "=" in attributes else {}
        kind = f"{name} {found.get('class', '')} {found.get('id', '')}"
        _, above, outer, block = self._stack[-1]
        path = xxhash.xxh64_intdigest(kind, above)
        zone = self._zone(name, kind[len(name):], found, outer)
        if name in BLOCK or (zone != outer and zone != CHROME):
            self._flush()
            block = len(self._stack)
        self.tokens.append(path)
        self._stack.append((name, path, zone, block))
        self._open[name] += 1

    def _zone(self, name: str, names: str, found: dict[str, str], zone: int) -> int:
        if zone == CHROME or name in CHROME_TAGS:
            return CHROME
        role = found.get("role", "").lower()
        if name in ("html", "body", "main") or role == "main":
            return MAIN if (name == "main" or role == "main") and zone == BODY else zone
        if role in CHROME_ROLES and not (role == "banner" and zone != BODY):
            return CHROME
        if names not in self._names:
            self._names[names] = _marked(names)
        chrome, outer = self._names[names]
        if name == "article" or found.get("itemprop", "").lower() == "articlebody":
            inside = zone == ARTICLE and name == "article"
            return CHROME if inside or any(w.lower().startswith("comment") for w in _NAME_WORD.findall(names)) else ARTICLE
        return CHROME if chrome or (zone == BODY and (outer or name == "header")) else zone

    def _drop_to(self, i: int) -> None:
        """Elements from place i of the stack on are closed."""
        if self._stack[-1][3] >= i:
            self._flush()
        for name, *_ in self._stack[i:]:
            self._open[name] -= 1
        del self._stack[i:]

    def _close(self, name: str) -> None:
        if not self._open[name]:
            if name in BLOCK:
                self._flush()
            return
        i = len(self._stack) - 1
        while self._stack[i][0] != name:
            if name not in BLOCK and self._stack[i][0] in BLOCK:
                return
            i -= 1
        path = self._stack[i][1]
        self._drop_to(i)
        self.tokens.append(xxhash.xxh64_intdigest("/", path))


#: Class and gap of what stands in no instance of a class.
OUTSIDE = (-1, 0)


class Template:
    """A host's classes, each a list of tokens in order, and its menu slots (class, gap, path, zone)."""

    def __init__(self, classes: list[list[int]], menus: list[tuple[int, int, int, int]] = ()):
        self.sizes = [len(c) for c in classes]
        self.place = {t: (i, j) for i, c in enumerate(classes) for j, t in enumerate(c)}
        self.menus = frozenset(menus)

    def walk(self, page: Page, without: frozenset[int] = frozenset()) -> tuple[set[int], list[tuple[tuple[int, int], ...]]]:
        """Classes that are out of order or not nested on this page, and the open classes and gaps around each block, outer ones first."""
        bad = set(without)
        stack: list[list[int]] = []  # class, tokens seen of this instance
        around, blocks, b = [], page.blocks, 0
        for at, token in enumerate(page.tokens):
            while b < len(blocks) and blocks[b][0] == at:
                around.append(tuple(map(tuple, stack)))
                b += 1
            place = self.place.get(token)
            if place is None or place[0] in bad:
                continue
            kind, nth = place
            if nth == 0 and (not stack or all(s[0] != kind for s in stack)):
                stack.append([kind, 1])
            else:
                depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == kind), None)
                if depth is None or stack[depth][1] != nth:
                    bad.add(kind)
                    if depth is not None:
                        del stack[depth]
                    continue
                bad.update(s[0] for s in stack[depth + 1:])  # begun inside this gap and not ended in it
                del stack[depth + 1:]
                stack[depth][1] += 1
            if stack[-1][1] == self.sizes[kind]:
                stack.pop()
        bad.update(s[0] for s in stack)
        around += [tuple(map(tuple, stack))] * (len(blocks) - b)
        return bad, around


def main_text(page: Page, template: Template | None) -> str:
    """The text that the page's slots hold."""
    around = template.walk(page)[1] if template else [()] * len(page.blocks)
    slots = [(*(gaps[-1] if gaps else OUTSIDE), b[5] >> 1, b[4]) for gaps, b in zip(around, page.blocks, strict=True)]
    if template:
        menus, place = template.menus, template.place
    else:
        chars, links = Counter(), Counter()
        for (_, _, text, link, _, _), slot in zip(page.blocks, slots, strict=True):
            chars[slot] += len(text)
            links[slot] += link
        menus, place = {slot for slot in slots if 2 * links[slot] >= chars[slot]}, {}
    kept = [(zone, text) for (first, end, text, _, zone, _), slot in zip(page.blocks, slots, strict=True)
            if zone in (ARTICLE, MAIN) or zone == BODY and slot not in menus and not all(t in place for t in page.tokens[first: end])]
    best = min((zone for zone, _ in kept), default=None)
    return "\n".join(text for zone, text in kept if zone == best)


# ------------------------------------------------------------------ Spark


def host_of(url: Column) -> Column:
    """Between the first '://' and '/', '?', '#' or the end, A-Z lower-cased; '' if null or without '://'."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


_VECTORS = "host string, token long, pages long, times long, vector long, position long"


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, id, html -> per host and token of the batch: pages, times, fingerprint, sum of first positions.  Token 0 stands for the page."""
    for batch in batches:
        hosts = batch.column("host").dictionary_encode()
        parts: list[np.ndarray] = []
        for host, ident, source in zip(hosts.indices.to_pylist(), batch.column("id").to_pylist(), batch.column("html").to_pylist(), strict=True):
            token, first, times = np.unique(np.array([0, *Page(source).tokens], dtype=np.uint64), return_index=True, return_counts=True)
            vector = mix(np.uint64(ident % 2**64) + mix(times.astype(np.uint64)))
            parts.append(np.stack([np.full(len(token), host, dtype=np.uint64), token, times.astype(np.uint64), vector, first.astype(np.uint64)]))
        if not parts:
            continue
        rows = np.concatenate(parts, axis=1)
        host, token, times, vector, first = rows[:, np.lexsort((rows[1], rows[0]))]
        new = np.flatnonzero(np.r_[True, (host[1:] != host[:-1]) | (token[1:] != token[:-1])])
        yield pa.RecordBatch.from_arrays([
            hosts.dictionary.take(pa.array(host[new].astype(np.int64))), pa.array(token[new].view(np.int64)), pa.array(np.diff(np.r_[new, len(host)])),
            pa.array(np.add.reduceat(times, new).astype(np.int64)), pa.array(np.bitwise_xor.reduceat(vector, new).view(np.int64)),
            pa.array(np.add.reduceat(first, new).astype(np.int64))], names=["host", "token", "pages", "times", "vector", "position"])


def _classes(pages: DataFrame) -> DataFrame:
    """host, class, tokens (in order) of the host's frequent equivalence classes."""
    counted = pages.mapInArrow(_vectors, _VECTORS).groupBy("host", "token").agg(
        F.sum("pages").alias("pages"), F.sum("times").alias("times"), F.bit_xor("vector").alias("vector"), F.sum("position").alias("position"))
    counted = written(counted.filter(f"pages >= {MIN_PAGES}"), "tokens")
    hosts = counted.filter("token = 0").select("host", F.col("pages").alias("of"))
    grouped = (counted.filter("token <> 0").join(hosts, "host").filter(F.col("pages") >= SUPPORT * F.col("of"))
               .groupBy("host", "pages", "times", "vector").agg(F.sort_array(F.collect_list(F.struct("position", "token"))).alias("found")))
    # Classes of a host are numbered by where they begin on its pages, outer ones first.
    return (grouped.filter(F.size("found") >= CLASS_TOKENS)
            .groupBy("host").agg(F.sort_array(F.collect_list(F.struct((F.col("found")[0]["position"] / F.col("pages")).alias("begin"), "vector", F.col("found")["token"].alias("tokens")))).alias("all"))
            .select("host", F.transform("all", lambda c: c["tokens"]).alias("classes")))


def _with_templates(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """Each page with its host's template: sent to all executors where it is small, else joined by shuffle."""
    size = templates.agg(F.sum(F.aggregate("classes", F.lit(0), lambda n, c: n + F.size(c)) + 20)).first()[0] or 0
    return pages.join(F.broadcast(templates) if size <= BROADCAST_TOKENS else templates, "host", "left")


class _Opened:
    """Templates of the hosts seen last, opened once each."""

    def __init__(self):
        self._held: dict[str, Template] = {}

    def __call__(self, host: str, classes: pa.Scalar, menus: pa.Scalar | None = None) -> Template | None:
        if not classes.is_valid:
            return None
        if host not in self._held:
            if len(self._held) >= HELD_HOSTS:
                self._held.clear()
            self._held[host] = Template([[t % 2**64 for t in c] for c in classes.as_py()],
                                        [(m["class"], m["gap"], m["path"], BODY) for m in menus.as_py()] if menus is not None and menus.is_valid else [])
        return self._held[host]


_VERDICTS = "host string, class int, bad long, around array<struct<class:int,gap:int>>, path long, chars long, links long"


def _verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, html, classes -> per host: pages on which a class is not valid; characters and link characters by open classes and path."""
    opened = _Opened()
    gaps = pa.list_(pa.struct([("class", pa.int32()), ("gap", pa.int32())]))
    schema = pa.schema([("host", pa.string()), ("class", pa.int32()), ("bad", pa.int64()), ("around", gaps), ("path", pa.int64()), ("chars", pa.int64()), ("links", pa.int64())])
    for batch in batches:
        bad, chars, links = Counter(), Counter(), Counter()
        for host, source, classes in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), batch.column("classes"), strict=True):
            template = opened(host, classes)
            if template is None:
                continue
            page = Page(source)
            broken, around = template.walk(page)
            bad.update((host, c) for c in broken)
            if broken and any(b[4] == BODY for b in page.blocks):
                around = template.walk(page, frozenset(broken))[1]
            for (_, _, text, link, zone, path), where in zip(page.blocks, around, strict=True):
                if zone == BODY:
                    chars[host, where, path >> 1] += len(text)
                    links[host, where, path >> 1] += link
        rows = [(h, c, n, None, None, 0, 0) for (h, c), n in bad.items()]
        rows += [(h, None, 0, [{"class": c, "gap": g} for c, g in where], path, n, links[h, where, path]) for (h, where, path), n in chars.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    opened = _Opened()
    for batch in batches:
        texts = [main_text(Page(source), opened(host, classes, menus)) for host, source, classes, menus in
                 zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), batch.column("classes"), batch.column("menus"), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def _different(pages: DataFrame) -> DataFrame:
    """Of equal pages of a host the first; pages without a host go.  Only names of pages are shuffled, and rows of copies."""
    named = pages.filter("host <> ''").withColumn("id", F.xxhash64("html"))
    again = named.groupBy("host", "id").agg(F.count("*").alias("n"), F.min("page_id").alias("first")).filter("n > 1").drop("n")
    return named.join(again, ["host", "id"], "left").filter("first IS NULL OR first <=> page_id").select("host", "id", "html")


def templates(pages: DataFrame) -> DataFrame:
    """host, classes (valid ones: array of token arrays), menus (class, gap and path of slots that are mostly links)."""
    different = _different(pages)
    found = written(_classes(different), "classes")
    judged = _with_templates(different, found).filter("classes IS NOT NULL").select("host", "html", "classes").mapInArrow(_verdicts, _VERDICTS)
    judged = written(judged.groupBy("host", "class", "around", "path").agg(F.sum("bad").alias("bad"), F.sum("chars").alias("chars"), F.sum("links").alias("links")), "verdicts")
    none = F.array().cast("array<int>")
    broken = judged.filter("bad > 0").groupBy("host").agg(F.collect_list("class").alias("broken"))
    valid = F.filter("around", lambda x: ~F.array_contains(F.coalesce("broken", none), x["class"]))
    slots = (judged.filter("chars > 0").join(broken, "host", "left")
             .withColumn("slot", F.coalesce(F.try_element_at(valid, F.lit(-1)), F.struct(F.lit(OUTSIDE[0]).alias("class"), F.lit(OUTSIDE[1]).alias("gap"))))
             .groupBy("host", "slot", "path").agg(F.sum("chars").alias("chars"), F.sum("links").alias("links")))
    menus = slots.filter("2 * links >= chars").groupBy("host").agg(F.collect_list(F.struct("slot.class", "slot.gap", "path")).alias("menus"))
    return (found.join(broken, "host", "left").join(menus, "host", "left")
            .select("host", F.transform("classes", lambda c, i: F.when(F.array_contains(F.coalesce("broken", none), i), F.array().cast("array<bigint>")).otherwise(c)).alias("classes"),
                    F.coalesce("menus", F.array().cast("array<struct<class:int,gap:int,path:bigint>>")).alias("menus")))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    read = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    found = written(templates(read), "templates")
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"
    return _with_templates(read, found).select("page_id", "url", "host", "html", "classes", "menus").mapInArrow(_extract, schema)
