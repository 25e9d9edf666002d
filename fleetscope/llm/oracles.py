"""DuckDB SQL of the operators that SQL can express, over the whole tables."""

from __future__ import annotations

# Lines to template leaves, constant words, templates, texts, with the votes of line_dedup.
OP1 = r"""
WITH txt AS (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL),
raw AS (SELECT text, unnest(string_split(text, chr(10))) AS raw, unnest(range(len(string_split(text, chr(10))))) AS place FROM txt),
l0 AS (
  SELECT text, place, trim(regexp_replace(raw, '[ \t\x0B\f\r]+', ' ', 'g'), ' ') AS line
  FROM raw WHERE regexp_matches(raw, '[^ \t\x0B\f\r]')),
l1 AS (
  SELECT *, list_transform(string_split(line, ' '), lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS w,
         substr(md5(line), 1, 16) AS k0, substr(md5(line), 9, 16) AS k1, substr(md5(line), 17, 16) AS k2 FROM l0),
low AS (SELECT text, min(k0) AS m0, min(k1) AS m1, min(k2) AS m2 FROM l1 GROUP BY text),
nxt AS (
  SELECT text, min(k0) FILTER (k0 > m0) AS x0, min(k1) FILTER (k1 > m1) AS x1, min(k2) FILTER (k2 > m2) AS x2
  FROM l1 JOIN low USING (text) GROUP BY text),
l AS (
  SELECT text, place, line, w, [len(w)::varchar, w[1], coalesce(w[2], '')] AS leaf,
         CASE WHEN k0 = m0 THEN coalesce(x0, k0) ELSE m0 END AS s0, CASE WHEN k1 = m1 THEN coalesce(x1, k1) ELSE m1 END AS s1,
         CASE WHEN k2 = m2 THEN coalesce(x2, k2) ELSE m2 END AS s2
  FROM l1 JOIN low USING (text) JOIN nxt USING (text)),
same AS (
  SELECT line FROM l WHERE len(w) >= 4 GROUP BY line
  HAVING greatest(count(DISTINCT s0), count(DISTINCT s1), count(DISTINCT s2)) >= greatest(3, 0.5 * count(DISTINCT text))),
wide AS (SELECT leaf FROM l GROUP BY leaf HAVING count(DISTINCT text) >= 20),
kept AS (SELECT l.* FROM l JOIN wide USING (leaf)),
form AS (SELECT leaf, w, greatest(count(DISTINCT s0), count(DISTINCT s1), count(DISTINCT s2)) AS n FROM kept GROUP BY leaf, w),
word AS (SELECT leaf, w, n, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM form),
total AS (SELECT leaf, sum(n) AS total FROM form GROUP BY leaf),
known AS (
  SELECT leaf, pos, word, sum(n) >= 0.5 * any_value(total) AS common FROM word JOIN total USING (leaf) WHERE word <> '<*>'
  GROUP BY leaf, pos, word HAVING sum(n) >= 20),
tmpl AS (
  SELECT leaf, w, leaf || list(CASE WHEN k.word IS NULL THEN '<*>' ELSE k.word END ORDER BY pos) AS template,
         count(*) FILTER (k.word IS NULL) AS open, count(*) FILTER (k.word IS NULL AND word <> '<*>') AS vary,
         count(*) FILTER (word = '<*>' OR letter) AS n_of, count(*) FILTER (k.word IS NOT NULL AND letter) AS n_have,
         count(*) FILTER (pos > 2 AND (word = '<*>' OR letter)) AS b_of, count(*) FILTER (pos > 2 AND common AND letter) AS b_have
  FROM (SELECT *, regexp_matches(word, '\p{L}') AS letter FROM word) LEFT JOIN known k USING (leaf, pos, word) GROUP BY leaf, w),
ok AS (
  SELECT leaf, w, template FROM tmpl
  WHERE open = 0 OR (vary = 0 AND n_of > 0 AND n_have >= 0.5 * n_of) OR (b_of > 0 AND b_have >= 0.5 * b_of)),
met AS (SELECT k.text, k.place, s0, s1, s2, template FROM kept k JOIN ok USING (leaf, w)),
many AS (
  SELECT template FROM met GROUP BY template
  HAVING greatest(count(DISTINCT s0), count(DISTINCT s1), count(DISTINCT s2)) >= greatest(20, 0.5 * count(DISTINCT text))),
gone AS (
  SELECT text, place FROM met JOIN many USING (template)
  UNION SELECT text, place FROM l JOIN same USING (line)),
body AS (
  SELECT raw.text, count(*) AS n_lines, count(g.place) AS n_dropped,
         coalesce(string_agg(raw, chr(10) ORDER BY raw.place) FILTER (g.place IS NULL), '') AS left_
  FROM raw LEFT JOIN gone g ON raw.text = g.text AND raw.place = g.place GROUP BY raw.text)
SELECT d.doc_id, coalesce(b.n_lines, 0)::bigint AS n_lines, coalesce(b.n_dropped, 0)::bigint AS n_dropped, b.left_ AS text
FROM documents d LEFT JOIN body b ON d.text = b.text
"""

# All pairs that share a shingle, and the components by label propagation.
OP4 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5
      THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM w),
n AS (SELECT doc_id, coalesce(len(s), 0) AS n FROM s),
x AS (SELECT doc_id, unnest(s) AS x FROM s),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM x a JOIN x b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * i >= 85 * (na.n + nb.n - i)),
both_ AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (SELECT a, b FROM both_ UNION SELECT r.a, t.b FROM reach r JOIN both_ t ON r.b = t.a),
low AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT n.doc_id, n.n::bigint AS n_shingles, least(n.doc_id, coalesce(low.low, n.doc_id)) AS component_id,
       n.doc_id = least(n.doc_id, coalesce(low.low, n.doc_id)) AS kept
FROM n LEFT JOIN low ON low.a = n.doc_id
"""

_URL = r"""regexp_replace(lower(url), '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"""
_HOST = rf"""regexp_replace(regexp_replace(regexp_replace(regexp_extract({_URL}, '^[a-z][a-z0-9+.-]*://([^/?#]*)', 1),
  '^.*@', ''), ':[0-9]*$', ''), '\.$', '')"""

OP6 = rf"""
WITH cap AS (
  SELECT page_id, url, DATE '2024-01-01' + (((page_id % 366) + 366) % 366)::int AS fetched, {_HOST} AS host,
         {_HOST} || regexp_replace(regexp_extract({_URL}, '^[a-z][a-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/$', '') AS page
  FROM pages),
k AS (
  SELECT page_id, url, fetched, 'host' AS kind, host AS value FROM cap WHERE host <> ''
  UNION SELECT page_id, url, fetched, 'page', page FROM cap WHERE host <> ''
  UNION SELECT page_id, url, fetched, 'domain', unnest(list_transform(
        range(1, CASE WHEN regexp_matches(host, '^[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}$') THEN 2 ELSE len(string_split(host, '.')) + 1 END),
        lambda i: array_to_string(string_split(host, '.')[i:], '.'))) FROM cap WHERE host <> ''),
name AS (SELECT DISTINCT kind, value FROM k WHERE kind <> 'domain' OR len(string_split(value, '.')) >= 2),
v AS (
  SELECT kind, value, ('0x' || substr(md5(kind || ':' || value), 1, 4))::int AS v FROM name
  WHERE ('0x' || substr(md5(kind || ':' || value), 1, 4))::int % (CASE kind WHEN 'page' THEN 7 ELSE 3 END) = 0),
log AS (
  SELECT kind, value, 'add' AS action, DATE '2024-01-01' + (v % 200)::int AS day FROM v
  UNION SELECT kind, value, 'remove', DATE '2024-01-01' + (v % 200 + 30 + v % 60)::int FROM v WHERE v % 2 = 0
  UNION SELECT kind, value, 'add', DATE '2024-01-01' + (v % 200 + 120)::int FROM v WHERE v % 5 = 0),
one AS (SELECT kind, value, day, max(action) AS action FROM log GROUP BY ALL),
span AS (
  SELECT * FROM (SELECT kind, value, action, day AS valid_from,
                        lead(day) OVER (PARTITION BY kind, value ORDER BY day) AS valid_to FROM one)
  WHERE action = 'add'),
hit AS (
  SELECT page_id, url, fetched, count(*) AS n, min(kind || ':' || value) AS entry
  FROM k JOIN span USING (kind, value) WHERE fetched >= valid_from AND (valid_to IS NULL OR fetched < valid_to) GROUP BY ALL)
SELECT c.page_id, c.url, c.fetched, coalesce(h.n, 0)::bigint AS n_active, h.entry, coalesce(h.n, 0) > 0 AS blocked
FROM cap c LEFT JOIN hit h ON h.page_id = c.page_id AND h.url = c.url AND h.fetched = c.fetched
"""

# Every run of words as long as a phrase, joined to the phrases.
OP9 = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
phrase AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2),
         lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS p
  FROM iw WHERE len(w) > 0),
runs AS (
  SELECT doc_id, n, pos, array_to_string(w[pos:pos + n - 1], ' ') AS p
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS pos FROM dw, (SELECT DISTINCT n FROM phrase) WHERE len(w) >= n)),
met AS (SELECT doc_id, pos, r.n, item_id FROM runs r JOIN phrase USING (n, p)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS k FROM met) GROUP BY 1),
item AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, item_id::varchar AS i FROM met) GROUP BY 1)
SELECT dw.doc_id, coalesce(len(w), 0)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit,
       coalesce(n_items, 0)::bigint AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit ON hit.doc_id = dw.doc_id LEFT JOIN item ON item.doc_id = dw.doc_id
"""



def _crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, bit by bit; 3988292384 is its polynomial."""
    codes = f"list_transform(range(strlen({text})), lambda i: ('0x' || substr(hex({text}), 2 * i::int + 1, 2))::bigint)"
    return (f"(4294967295 - list_reduce([4294967295::BIGINT] || {codes}, lambda a, b: list_reduce("
            "[xor(a, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))")


# All pairs of equal words a quarter of the text apart at most; stretches of them for each distance.
OP11 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
         {_crc32('doc_id::varchar')} AS h FROM documents),
v AS (SELECT *, len(w) AS n, coalesce(h % 10 = 0 AND len(w) > 0, false) AS made, h // 10 AS g FROM d),
u AS (SELECT *, CASE WHEN made THEN g % n ELSE n END AS a FROM v),
t AS (SELECT *, CASE WHEN made THEN 1 + (n - a) // (3 + g % 8) ELSE 1 END AS p FROM u),
word AS (
  SELECT r, n, i, w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM t)),
eq AS (
  SELECT x.r, x.i, y.i - x.i AS q FROM word x JOIN word y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
isle AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS g FROM eq),
stretch AS (SELECT r, q, min(i) AS s, max(i) + q + 1 AS e FROM isle GROUP BY r, q, g HAVING count(*) + q >= greatest(6, 4 * q)),
run AS (SELECT r, s, e, min(q) AS q FROM stretch GROUP BY r, s, e),
sums AS (
  SELECT r, count(*) AS n_runs, string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q) AS listed,
         min_by({{'start': s, 'length': e - s, 'period': q}}, (-(e - s) / q, s, q)) AS b
  FROM run GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(s + q, e)) AS i FROM run),
body AS (SELECT word.r, string_agg(word, ' ' ORDER BY word.i) AS body FROM word ANTI JOIN gone USING (r, i) GROUP BY word.r)
SELECT doc_id, coalesce(n_runs, 0)::bigint AS n_runs, b.start::bigint AS start, b.length::bigint AS length, b.period::bigint AS period,
       (1000 * b.length // b.period)::bigint AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM d LEFT JOIN sums ON sums.r = d.r LEFT JOIN body ON body.r = d.r
"""

# Words that agree once a code point is deleted from both, or from the longer one.
OP12 = rf"""
WITH RECURSIVE run AS (
  SELECT doc_id, word, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS word
    FROM documents)
  GROUP BY doc_id, word),
h AS (SELECT word, n, {_crc32("(doc_id || ':' || word)")} AS h FROM run WHERE length(word) >= 6),
v AS (
  SELECT word, sum(n)::bigint AS n FROM (
    SELECT n, CASE WHEN coalesce(h % 199 = 0, false) THEN substr(word, 1, h % length(word)) || substr(word, h % length(word) + 2)
                   ELSE word END AS word FROM h)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
del AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS short FROM (SELECT *, unnest(range(length(word))) AS i FROM v)),
pair AS (
  SELECT a.word AS a, b.word AS b, b.n AS m FROM del a JOIN del b ON a.i = b.i AND a.short = b.short AND a.word <> b.word
  UNION SELECT d.word, v.word, v.n FROM del d JOIN v ON d.short = v.word
  UNION SELECT v.word, d.word, d.n FROM del d JOIN v ON d.short = v.word),
best AS (SELECT a AS word, count(*) AS n_near, min_by(b, (-m, b)) AS form, max(m) AS m FROM pair GROUP BY a),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0)::bigint AS n_near, CASE WHEN m >= 5 * n THEN form END AS form,
         CASE WHEN m >= 5 * n THEN m END::bigint AS form_n
  FROM v LEFT JOIN best USING (word)),
up(word, last) AS (SELECT word, form FROM f WHERE form IS NOT NULL
  UNION ALL SELECT up.word, f.form FROM up JOIN f ON f.word = up.last WHERE f.form IS NOT NULL),
root AS (SELECT up.word, up.last AS root FROM up JOIN f ON f.word = up.last WHERE f.form IS NULL)
SELECT f.word, n, form, form_n, coalesce(root, f.word) AS root, n_near FROM f LEFT JOIN root ON root.word = f.word
"""

_PII_RULES = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "list_max(list_transform(string_split(v, '.'), lambda x: x::hugeint)) <= 255"),
    ("card", r"[0-9]([\x20-]?[0-9])+", """length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(range(length(digits)), lambda i:
        CASE WHEN i % 2 = 0 THEN digits[length(digits) - i]::int
             ELSE translate(digits[length(digits) - i], '0123456789', '0246813579')::int END)) % 10 = 0"""),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(digits) BETWEEN 9 AND 15"),
    ("token", r"[^\x20\x09-\x0D0-9@]*[0-9@][^\x20\x09-\x0D]*", "true"))


def _pii() -> str:
    """The base rules by position, then five rounds of the pattern scores, written out."""
    found, rounds = [], []
    for k, (_, rule, test) in enumerate(_PII_RULES):
        found.append(f"""
m{k} AS (SELECT r, {k} AS kind, text, i, z[1] AS gap, z[2] AS v FROM (
  SELECT r, text, unnest(list_transform(list_zip(regexp_split_to_array(text, '{rule}'), regexp_extract_all(text, '{rule}')), lambda z: [z[1], z[2]])) AS z,
         generate_subscripts(regexp_split_to_array(text, '{rule}'), 1) AS i FROM d WHERE text IS NOT NULL)),
s{k} AS (
  SELECT r, kind, v, stop - length(v) AS s, stop, gap FROM (
    SELECT *, sum(length(gap) + length(v)) OVER (PARTITION BY r ORDER BY i) AS stop, regexp_replace(v, '[^0-9]', '', 'g') AS digits
    FROM m{k} WHERE v IS NOT NULL) WHERE {test})""")
    got = "SELECT NULL::varchar AS value, NULL::int AS kind WHERE false"
    for i in range(5):
        rounds.append(f"""
sure{i} AS (SELECT p, kind, n FROM edge WHERE kind < 4 UNION ALL SELECT p, g.kind, n FROM edge JOIN ({got}) g ON g.value = edge.v WHERE edge.kind = 4),
strong{i} AS (SELECT p, kind FROM sure{i} JOIN total USING (p) GROUP BY p, kind, total HAVING sum(n) >= 0.8::double * (total + 1)),
behind{i} AS (
  SELECT v, kind, sum(n) AS have FROM (
    SELECT DISTINCT v, l1, l2, n, k.kind FROM (SELECT v, l1, l2, n, unnest([l1, l2]) AS p FROM ctx WHERE kind = 4) x JOIN strong{i} k USING (p))
  GROUP BY v, kind),
got{i} AS (
  SELECT v AS value, arg_max(kind, (have, -kind)) AS kind FROM behind{i} JOIN (SELECT v, sum(n) AS size FROM ctx WHERE kind = 4 GROUP BY v) USING (v)
  GROUP BY v HAVING 2 * max(have) >= any_value(size))""")
        got = f"SELECT * FROM got{i}"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),{','.join(found)},
base AS (SELECT * FROM s0 UNION ALL SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3),
trim_ AS (
  SELECT r, kind, regexp_replace(regexp_replace(v, '^[^\p{{L}}\p{{N}}@+]+', ''), '[^\p{{L}}\p{{N}}@+]+$', '') AS v,
         s + length(v) - length(regexp_replace(v, '^[^\p{{L}}\p{{N}}@+]+', '')) AS s, gap FROM s4),
token AS (
  SELECT t.r, t.kind, t.v, t.s, t.s + length(t.v) AS stop, t.gap FROM trim_ t WHERE length(t.v) BETWEEN 4 AND 64
  AND NOT EXISTS (SELECT 1 FROM base b WHERE b.r = t.r AND b.s < t.s + length(t.v) AND b.stop > t.s)),
men AS (
  SELECT r, kind, v, s, stop, l[-1] AS l1, l[-2] || ' ' || l[-1] AS l2 FROM (
    SELECT *, regexp_extract_all(lower(right(gap, 200)), '\p{{L}}+') AS l FROM (SELECT * FROM base UNION ALL SELECT * FROM token))),
ctx AS (SELECT kind, v, l1, l2, count(*) AS n FROM men WHERE l1 IS NOT NULL GROUP BY kind, v, l1, l2),
edge AS (SELECT kind, v, n, unnest([l1, l2]) AS p FROM ctx),
pattern AS (SELECT p FROM edge WHERE p IS NOT NULL GROUP BY p HAVING count(DISTINCT v) >= 5),
w AS (SELECT r, unnest(l) AS w, unnest([''] || l) AS v FROM (SELECT r, regexp_extract_all(lower(text), '\p{{L}}+') AS l FROM d)),
total AS (SELECT p, count(*) AS total FROM (SELECT w AS p FROM w UNION ALL SELECT v || ' ' || w FROM w) SEMI JOIN pattern USING (p) GROUP BY p),{','.join(rounds)},
kind AS (SELECT unnest(['email', 'ip', 'card', 'phone']) AS name, unnest([0, 1, 2, 3]) AS k),
span AS (
  SELECT r, kind AS nr, s, stop, name FROM base JOIN kind ON k = kind
  UNION ALL SELECT r, 4 + g.kind, s, stop, name || '_like' FROM token JOIN got4 g ON g.value = token.v JOIN kind ON k = g.kind),
sums AS (
  SELECT r, string_agg(name || ':' || s || ':' || stop, ',' ORDER BY s, nr) FILTER (nr < 4) AS b,
         string_agg(name || ':' || s || ':' || stop, ',' ORDER BY s, nr) AS spans,
         {', '.join(f"count(*) FILTER (nr = {k}) AS n_{n}" for k, n in enumerate(("email", "ip", "card", "phone")))}
  FROM span GROUP BY r)
SELECT doc_id, {', '.join(f"coalesce(n_{n}, 0)::bigint AS n_{n}" for n in ("email", "ip", "card", "phone"))},
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN sums ON sums.r = d.r
"""


OP13 = _pii()

ORACLES = {"op1_line_dedup": OP1, "op4_near_duplicates": OP4, "op6_url_filter": OP6, "op9_decontamination": OP9,
           "op11_periodic_runs": OP11, "op12_spelling_variants": OP12, "op13_personal_data": OP13}
