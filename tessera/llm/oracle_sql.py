"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations


from tessera.llm.registry import BLOCKED_NAMES, URL_RULES


def _url_filter() -> str:
    rules = ", ".join(f"('{r}', '{v}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}')" for r, v in URL_RULES)
    return f"""
WITH parts AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS rn FROM parts),
rules(rule, verdict, rhost, rpath) AS (VALUES {rules}),
fits AS (
  SELECT s.rn, r.rule, r.verdict, row_number() OVER (PARTITION BY s.rn ORDER BY length(r.rule) DESC) AS k
  FROM split s JOIN rules r ON (s.host = r.rhost OR ends_with(s.host, '.' || r.rhost)) AND starts_with(s.path, r.rpath))
SELECT s.page_id, s.host, s.path, f.rule,
       coalesce(f.verdict, CASE WHEN regexp_matches(s.host, '(^|\\.)({"|".join(BLOCKED_NAMES)})(\\.|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM split s LEFT JOIN fits f ON f.rn = s.rn AND f.k = 1"""


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# crc32 (reflected, polynomial 0xEDB88320) over a list of byte values
CRC_TABLE = """crc_table AS (SELECT list_transform(range(0, 256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def _crc32(byte_list: str) -> str:
    return (f"xor(list_reduce(list_concat([4294967295], {byte_list}), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)")


def _components(percent: int, more: str) -> str:
    """Documents linked by their 3-word shingle sets, all pairs that share one."""
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
sized AS (SELECT doc_id, n, s FROM shingles JOIN sizes USING (doc_id)),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM sized a JOIN sized b
    ON a.s = b.s AND a.doc_id <> b.doc_id AND 100 * a.n >= {percent} * b.n AND 100 * b.n >= {percent} * a.n
  GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
component AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, c.component_id{more}
FROM documents d JOIN component c USING (doc_id) LEFT JOIN sizes z USING (doc_id)"""


def _spelling() -> str:
    # characters up to U+00FF: one byte, or 0xC3 and a second one
    byte_list = ("flatten(list_transform(string_split(k, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] "
                 "ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)]::BIGINT[] END))")
    return f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT doc_id, {LOWER.format('r')} AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS r FROM documents) GROUP BY 1, 2),
keyed AS (SELECT run, n, {_crc32(byte_list)} AS h FROM (SELECT *, doc_id || ':' || run AS k FROM runs), crc_table),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word FROM keyed)
  WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3),
less AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS v FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other FROM less a JOIN less b ON a.i = b.i AND a.v = b.v AND a.word <> b.word
  UNION SELECT a.word, b.word FROM less a JOIN words b ON a.v = b.word
  UNION SELECT b.word, a.word FROM less a JOIN words b ON a.v = b.word),
best AS (
  SELECT x.word, count(*) AS n_near, first(x.other ORDER BY o.n DESC, x.other) AS other, max(o.n) AS other_n
  FROM near x JOIN words o ON o.word = x.other GROUP BY 1),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= 2 * w.n THEN b.other END AS form,
         CASE WHEN b.other_n >= 2 * w.n THEN b.other_n END AS form_n FROM words w LEFT JOIN best b USING (word)),
chain(word, top) AS (SELECT word, word FROM forms UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.top WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.top AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word JOIN forms e ON e.word = c.top AND e.form IS NULL"""


def _conversations() -> str:
    byte_list = "list_transform(string_split(conv_id::VARCHAR, ''), lambda c: unicode(c)::BIGINT)"
    return f"""
WITH {CRC_TABLE},
turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p FROM conversations),
convs AS (SELECT conv_id, {_crc32(byte_list)} % 6 AS h FROM (SELECT DISTINCT conv_id FROM conversations), crc_table),
rebuilt AS (
  SELECT c.conv_id, 0 AS src, t.p, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.p <= c.h
  UNION ALL SELECT c.conv_id, 1, t.p, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.p > c.h),
prefixes AS (
  SELECT conv_id, text, row_number() OVER o AS d, list({{'role': role, 'text': text}}) OVER o AS pre FROM rebuilt
  WINDOW o AS (PARTITION BY conv_id ORDER BY src, p)),
members AS (
  SELECT conv_id, d, text, min(conv_id) OVER (PARTITION BY d, pre) AS rep FROM prefixes
  UNION ALL SELECT conv_id, 0, '', min(conv_id) OVER () FROM convs),
lens AS (SELECT conv_id, max(d) AS len FROM members GROUP BY 1),
nodes AS (
  SELECT m.rep, m.d, count(*) AS n_convs, (count(*) - 1) * any_value(length(m.text)) AS saved,
         sha256(coalesce(string_agg(m.conv_id::VARCHAR, ',' ORDER BY m.conv_id) FILTER (WHERE l.len = m.d), '')) AS ends
  FROM members m JOIN lens l USING (conv_id) GROUP BY 1, 2),
parents AS (SELECT n.*, m.rep AS parent FROM nodes n LEFT JOIN members m ON m.conv_id = n.rep AND m.d = n.d - 1),
children AS (SELECT parent AS rep, d - 1 AS d, count(*) AS n_children FROM parents WHERE d > 0 GROUP BY 1, 2),
full_nodes AS (SELECT p.*, coalesce(c.n_children, 0) AS n_children FROM parents p LEFT JOIN children c USING (rep, d)),
above AS (
  SELECT m.rep, m.d, sum(n.saved)::BIGINT AS saved_tokens, count(*) FILTER (WHERE n.n_children = 0) AS n_leaves
  FROM full_nodes n JOIN members m ON m.conv_id = n.rep AND m.d <= n.d GROUP BY 1, 2)
SELECT f.rep AS conv_id, f.d AS depth, f.parent AS parent_conv_id, f.n_convs, f.n_children, a.n_leaves, a.saved_tokens, f.ends AS ends_sha256
FROM full_nodes f JOIN above a USING (rep, d)"""


def oracle_queries() -> dict[str, str]:
    return {"op1_url_filter": _url_filter(), "op4_jaccard_join": _components(90, ""), "op11_spelling_variants": _spelling(),
            "op12_lsh_forest": _components(85, ", d.doc_id = c.component_id AS kept"), "op13_conversation_trie": _conversations()}
