"""DuckDB SQL of the operator queries that SQL can express, over whole tables.

Without SQL: op3 (a trained classifier), op8 (mined rules), op9 (tokenizer ids), op11 (eigenvectors) and the pipeline;
tests/llm compares those with brute force, round trips and held-out accuracy.
"""

from __future__ import annotations

from wagelens.llm.quality_rules import STOP_WORDS

_SPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _docs(words: str) -> str:
    return f"d AS (SELECT row_number() OVER () AS r, doc_id, text, {words} AS ws FROM documents)"


def _windows(name: str, source: str, length: int) -> str:
    return (f"{name} AS (SELECT r, doc_id, i, array_to_string(ws[i:i + {length - 1}], ' ') AS win "
            f"FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - {length - 2})) AS i FROM {source} WHERE len(ws) >= {length}))")


_OP1 = f"""
WITH {_docs(_ALNUM)},
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_ALNUM} AS ws FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(ws), 10) AS n, array_to_string(ws[i:i + 9], ' ') AS win
       FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 8, 2))) AS i FROM b WHERE len(ws) > 0)),
dw AS (SELECT r, i, n, array_to_string(ws[i:i + n - 1], ' ') AS win
       FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(ws) >= n)),
m AS (SELECT dw.r, dw.i, dw.n, bw.item FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM m) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN it USING (r)"""

_NIBBLES = "['" + "', '".join(format(i, "04b") for i in range(16)) + "']"
_OP2 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT payload, min(page_id) AS first FROM p GROUP BY payload),
x AS (SELECT p.*, f.first, array_to_string(list_transform(string_split(hex, ''), lambda c: ({_NIBBLES})[strpos('0123456789abcdef', c)]), '') AS bits
      FROM p JOIN f USING (payload))
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda g: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST(list_sum(list_transform(range(5), lambda k: CAST(substr(bits, CAST(g * 5 + k + 1 AS BIGINT), 1) AS INTEGER) * CAST(power(2, 4 - k) AS INTEGER))) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS NULL OR page_id = first THEN NULL ELSE first END AS refers_to, url
FROM x JOIN (SELECT page_id, coalesce(url, '') AS url FROM pages) USING (page_id)"""

_OP4 = f"""
WITH {_docs(_SPACED)},
{_windows("w", "d", 8)},
rep AS (SELECT r, win FROM w GROUP BY r, win HAVING count(*) > 1),
cov AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM w JOIN rep USING (r, win)) GROUP BY r),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
        coalesce(cov.n, 0) AS n_repeat_words,
        len(list_filter(ws, lambda x: list_contains({[*dict.fromkeys(STOP_WORDS)]!r}, lower(x)))) AS n_stop
      FROM d LEFT JOIN cov USING (r)),
n AS (SELECT *, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(word_chars / n_words BETWEEN 1.5 AND 25.0 AND n_symbols / n_words <= 0.5
         AND n_stop / n_words >= 0.02 AND n_dup_lines / nullif(len(lines), 0) <= 0.5, false) AS kept
FROM n"""


#: The order of rows of one doc_id: the first 64 bits of the md5 of id and text, as a signed number.
_KEY = "CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || coalesce(text, 'null')), 1, 16) AS UBIGINT)"
_PLACE = "(coalesce(doc_id, -9223372036854775808), k, i)"


def _repeats(length: int) -> str:
    return f"""
WITH {_docs(_SPACED)},
o AS (SELECT r, CAST(CASE WHEN u >= 9223372036854775808 THEN CAST(u AS HUGEINT) - 18446744073709551616 ELSE u END AS BIGINT) AS k FROM (SELECT r, {_KEY} AS u FROM d)),
{_windows("w", "d", length)},
again AS (SELECT win, min({_PLACE}) AS first FROM w JOIN o USING (r) GROUP BY win HAVING count(*) > 1),
m AS (SELECT r, i, {_PLACE} <> first AS later FROM w JOIN o USING (r) JOIN again USING (win)),
c AS (SELECT r, p, bool_or(later) AS later FROM (SELECT r, later, unnest(range(i, i + {length})) AS p FROM m) GROUP BY r, p)"""


def _kept(flag: str) -> str:
    return (f"k AS (SELECT d.r, string_agg(word, ' ' ORDER BY q) AS kept FROM (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS q FROM d) d "
            f"WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.r = d.r AND c.p = d.q{flag}) GROUP BY d.r)")


_OP5 = f"""{_repeats(35)},
{_kept("")},
n AS (SELECT r, count(*) AS n FROM c GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN k USING (r)"""

_OP6 = rf"""
WITH RECURSIVE {_docs(rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')")},
s AS (SELECT DISTINCT r, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)
      UNION ALL SELECT r, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND 4),
z AS (SELECT r, count(*) AS n FROM s GROUP BY r),
o AS (SELECT a.r AS a, b.r AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r),
e AS (SELECT a, b FROM o JOIN z x ON x.r = a JOIN z y ON y.r = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
reach(a, b) AS (SELECT r, r FROM d UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, min(t.doc_id) AS component_id
FROM d LEFT JOIN z USING (r) JOIN reach ON reach.a = d.r JOIN d t ON t.r = reach.b GROUP BY d.r, d.doc_id, z.n"""

_OP6_LINKS = rf"""
WITH RECURSIVE {_docs(rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')")},
s AS (SELECT DISTINCT r, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)
      UNION ALL SELECT r, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND 4),
z AS (SELECT r, count(*) AS n, string_agg(g, chr(10) ORDER BY g) AS cls FROM s GROUP BY r),
o AS (SELECT a.r AS a, b.r AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r),
e AS (SELECT a, b, x.cls <> y.cls AS other, y.cls AS cls FROM o JOIN z x ON x.r = a JOIN z y ON y.r = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
l AS (SELECT a, count(DISTINCT cls) AS n FROM e WHERE other GROUP BY a),
reach(a, b) AS (SELECT r, r FROM d UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, min(t.doc_id) AS component_id, coalesce(l.n, 0) AS n_links
FROM d LEFT JOIN z USING (r) LEFT JOIN l ON l.a = d.r JOIN reach ON reach.a = d.r JOIN d t ON t.r = reach.b GROUP BY d.r, d.doc_id, z.n, l.n"""

_MARKS = r"'^((?:[ \t]*>)+)'"
_OP7 = rf"""
WITH RECURSIVE m AS (SELECT row_number() OVER () AS r, conv_id, turn, role, string_split(coalesce(text, ''), chr(10)) AS parts FROM conversations),
l0 AS (SELECT r, conv_id, turn, unnest(parts) AS raw, unnest(range(len(parts))) AS i FROM m),
l1 AS (SELECT *, regexp_extract(raw, {_MARKS}, 1) AS marks FROM l0),
l2 AS (SELECT *, length(marks) - length(replace(marks, '>', '')) AS marked,
         lower(trim(regexp_replace(regexp_replace(raw, {_MARKS}, ''), '[\x20\x09-\x0D]+', ' ', 'g'))) AS body FROM l1),
l AS (SELECT *, CASE WHEN marked = 0 AND coalesce(lead(marked) OVER (PARTITION BY r ORDER BY i), 0) > 0
                      AND regexp_matches(raw, '(?i)(wrote|schrieb|a écrit|escribió)[ \t]*:[ \t\r]*$') THEN -1 ELSE marked END AS level FROM l2),
p AS (SELECT DISTINCT conv_id, turn, level, body FROM l WHERE conv_id IS NOT NULL AND turn IS NOT NULL AND level >= 0 AND body <> ''),
own AS (SELECT conv_id, turn, body FROM p WHERE level = 0),
inn AS (SELECT q.conv_id, q.turn, q.level, q.body, max(own.turn) AS from_turn
        FROM p q LEFT JOIN own ON own.conv_id = q.conv_id AND own.body = q.body AND own.turn < q.turn WHERE q.level > 0 GROUP BY q.conv_id, q.turn, q.level, q.body),
w AS (SELECT body, conv_id, min(turn) AS turn FROM own GROUP BY body, conv_id),
els AS (SELECT inn.conv_id, inn.turn, inn.level, inn.body, min({{'c': w.conv_id, 't': w.turn}}) AS place
        FROM inn JOIN w ON w.body = inn.body AND w.conv_id <> inn.conv_id WHERE inn.from_turn IS NULL GROUP BY inn.conv_id, inn.turn, inn.level, inn.body),
s AS (SELECT inn.conv_id, inn.turn, inn.level, CASE WHEN inn.from_turn IS NOT NULL THEN inn.conv_id ELSE els.place.c END AS from_conv,
        coalesce(inn.from_turn, els.place.t) AS from_turn FROM inn LEFT JOIN els USING (conv_id, turn, level, body)),
nodes AS (SELECT DISTINCT conv_id, turn FROM m WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
ins AS (SELECT conv_id, turn, level, from_turn, count(*) AS n FROM s WHERE from_conv = conv_id GROUP BY conv_id, turn, level, from_turn),
best AS (SELECT conv_id, turn, max({{'l': -level, 'n': n, 'f': from_turn}}).f AS quoted FROM ins GROUP BY conv_id, turn),
rep AS (SELECT conv_id, turn, coalesce(quoted, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn)) AS reply_to FROM nodes LEFT JOIN best USING (conv_id, turn)),
tree(conv_id, turn, root, depth) AS (SELECT conv_id, turn, turn, 0 FROM rep WHERE reply_to IS NULL
  UNION ALL SELECT rep.conv_id, rep.turn, tree.root, tree.depth + 1 FROM rep JOIN tree ON rep.conv_id = tree.conv_id AND rep.reply_to = tree.turn),
a AS (SELECT conv_id, turn, count(*) AS n_quoted, count(from_turn) AS n_linked, max(level) AS deepest FROM s GROUP BY conv_id, turn),
o1 AS (SELECT conv_id, turn, from_conv, from_turn, count(*) AS n FROM s WHERE from_turn IS NOT NULL GROUP BY conv_id, turn, from_conv, from_turn),
o AS (SELECT conv_id, turn, list({{'from_conv': from_conv, 'from_turn': from_turn, 'n': n}} ORDER BY from_conv, from_turn) AS sources FROM o1 GROUP BY conv_id, turn),
c AS (SELECT r, regexp_replace(coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (WHERE level = 0), ''), '^\n+|\n+$', '', 'g') AS clean_text FROM l GROUP BY r)
SELECT m.conv_id, m.turn, m.role, rep.reply_to, tree.root AS thread_root, coalesce(tree.depth, 0) AS depth, coalesce(a.n_quoted, 0) AS n_quoted,
       coalesce(a.n_linked, 0) AS n_linked, coalesce(a.deepest, 0) AS deepest, o.sources, c.clean_text
FROM m JOIN c USING (r) LEFT JOIN rep ON rep.conv_id = m.conv_id AND rep.turn = m.turn LEFT JOIN tree ON tree.conv_id = m.conv_id AND tree.turn = m.turn
LEFT JOIN a ON a.conv_id = m.conv_id AND a.turn = m.turn LEFT JOIN o ON o.conv_id = m.conv_id AND o.turn = m.turn"""

_OP10 = f"""{_repeats(50)},
{_kept(" AND c.later")},
n AS (SELECT r, count(*) AS n_repeated, count(*) FILTER (WHERE later) AS n_removed FROM c GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_repeated, 0) AS n_repeated, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN k USING (r)"""

# The given pages mark their text by one article of h1 and p blocks with few character references; on these the template method and this SQL agree.
_OP12 = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS body FROM pages),
b AS (SELECT page_id, url, list_transform(regexp_split_to_array(body, '</?(?:p|h1)>'), lambda x: trim(regexp_replace(
        replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'), '&lt;', '<', 'g'), '&gt;', '>', 'g'), '&quot;?', '"', 'g'), '&amp;', '&'),
        '\s+', ' ', 'g'))) AS blocks FROM a),
t AS (SELECT page_id, url, coalesce(array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10)), '') AS text FROM b)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM t"""

_OP13 = rf"""
WITH t AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM t),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM t),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY lang, source, term),
n AS (SELECT lang, source, term, coalesce(n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT lang, source, term, n, 1 + 1000000000 * (CAST(n AS HUGEINT) + 1) // (sum(n) OVER (PARTITION BY lang, source) + v) AS p FROM n JOIN v USING (lang)),
m AS (SELECT lang, term, sum(n) AS n FROM n GROUP BY lang, term),
q AS (SELECT lang, term, 1 + 1000000000 * (CAST(n AS HUGEINT) + 1) // (sum(n) OVER (PARTITION BY lang) + v) AS q FROM m JOIN v USING (lang)),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
f AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM f WHERE part = 'pair' OR rank <= 200"""

ORACLE_SQL = {
    "op1_decontamination": _OP1,
    "op2_warc_zstd": _OP2,
    "op4_quality_rules": _OP4,
    "op5_substring_dedup": _OP5,
    "op6_jaccard_join": _OP6,
    "op6_jaccard_links": _OP6_LINKS,
    "op7_quote_links": _OP7,
    "op10_suffix_dedup": _OP10,
    "op12_template_extraction": _OP12,
    "op13_source_divergence": _OP13,
}
