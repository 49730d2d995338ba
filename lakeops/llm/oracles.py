"""DuckDB SQL that computes the queries' results in another way."""

from __future__ import annotations


def secrets_sql(rules) -> str:
    """Matches with their places: what a pattern splits a text into gives the offsets."""
    parts = [f"""
  SELECT doc_id, {order} AS o, '{rule.kind}' AS kind, {str(rule.base).lower()} AS base, {rule.least} AS least,
         unnest(m) AS m, unnest(g) AS g, unnest(p[1:len(m)]) AS before, unnest(range(len(m))) AS i
  FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {rule.group}) AS g,
               string_split_regex(t, '{pattern}') AS p FROM d)""" for order, rule in enumerate(rules)
             for pattern in [rule.pattern.replace("'", "''")]]
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
hits AS ({" UNION ALL ".join(parts)}),
placed AS (SELECT *, sum(length(before) + length(m)) OVER (PARTITION BY doc_id, o ORDER BY i) AS stop FROM hits),
spans AS (SELECT doc_id, o, kind, base, CAST(stop - length(m) AS BIGINT) AS start,
                 kind || ':' || CAST(stop - length(m) AS BIGINT) || ':' || CAST(stop AS BIGINT) AS told
          FROM placed WHERE length(g) >= least),
found AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                 count(*) FILTER (kind = 'hex') AS n_hex,
                 string_agg(told, ',' ORDER BY start, o) FILTER (base) AS base_spans,
                 string_agg(told, ',' ORDER BY start, o) AS spans
          FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN found USING (doc_id)
"""


def licenses_sql(templates, words_of, word: str, k: int, coverage: float = 0.8, slack: int = 3) -> str:
    grams = []
    for x in templates:
        words = words_of(x.text)
        grams += [f"('{x.name}', '{x.label}', {str(x.base).lower()}, {len(words)}, {t}, '{' '.join(words[t:t + k])}')"
                  for t in range(len(words) - k + 1)]
    gram = " || ' ' || ".join(f"ws[i + {j + 1}]" for j in range(k))
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '{word}') AS ws FROM documents),
g AS (SELECT doc_id, {gram} AS gram, i AS p
      FROM (SELECT doc_id, ws, unnest(range(len(ws) - {k - 1})) AS i FROM w)),
tg(name, label, base, m, t, gram) AS (VALUES {", ".join(grams)}),
h AS (SELECT doc_id, name, label, base, m, t, p - t AS diagonal FROM g JOIN tg USING (gram)),
d AS (SELECT *, CASE WHEN base OR diagonal - lag(diagonal) OVER s > {slack} OR lag(diagonal) OVER s IS NULL
                     THEN 1 ELSE 0 END AS fresh
      FROM (SELECT DISTINCT doc_id, name, base, diagonal FROM h) WINDOW s AS (PARTITION BY doc_id, name ORDER BY diagonal)),
n AS (SELECT doc_id, name, diagonal, sum(fresh) OVER (PARTITION BY doc_id, name ORDER BY diagonal) AS span FROM d),
c AS (SELECT doc_id, name, label, base, m, span, min(diagonal + t) AS start,
             count(DISTINCT t + j) AS words
      FROM h JOIN n USING (doc_id, name, diagonal), (SELECT unnest(range({k})) AS j)
      GROUP BY doc_id, name, label, base, m, span),
v AS (SELECT *, words / CAST(m AS DOUBLE) AS covered FROM c
      WHERE words / CAST(m AS DOUBLE) >= CASE WHEN base THEN 1.0 ELSE {coverage} END),
f AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
             max(start) FILTER (base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS b,
             string_agg(DISTINCT label, ',' ORDER BY label) AS a, max(covered) AS score
      FROM v GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(b, '') AS base_labels, coalesce(a, '') AS labels, coalesce(score, 0.0) AS score
FROM w LEFT JOIN f USING (doc_id)
"""


def mixture_ctes(docs: str = "documents", block: int = 32) -> str:
    return f"""
r AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM {docs}),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid
       FROM r GROUP BY source),
s1 AS (SELECT *, 1 + sid % 3 AS weight, sum(size) OVER () AS total FROM s0),
s2 AS (SELECT *, coalesce(sum(3 * size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
              sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
       FROM s1 WINDOW o AS (ORDER BY size / CAST(weight AS DOUBLE), sid)),
s3 AS (SELECT *, 3 * size * rest < (total - capped) * weight AS filled FROM s2),
s4 AS (SELECT source, sid, size, total, CASE WHEN filled THEN CAST(3 * size AS DOUBLE) ELSE
              CAST(weight * (total - coalesce(sum(3 * size) FILTER (filled) OVER (), 0)) AS DOUBLE)
              / CAST(sum(weight) FILTER (NOT filled) OVER () AS DOUBLE) END AS target FROM s3),
b AS (SELECT CAST({block} AS BIGINT) AS block, CAST(max(total) AS BIGINT) AS total FROM s4),
p AS (SELECT sid, CAST(floor(target / CAST(total AS DOUBLE) * 4294967296) AS BIGINT) AS part FROM s4),
h AS (SELECT sid, sum(part) OVER (ORDER BY sid) - part AS low,
             CASE WHEN sid = max(sid) OVER () THEN 4294967296 ELSE sum(part) OVER (ORDER BY sid) END AS high FROM p),
t AS (SELECT slot, (slot * 2654435769 + 2147483648) % 4294967296 AS point
      FROM (SELECT unnest(range(CAST((total + block - 1) // block AS BIGINT))) AS slot FROM b)),
k AS (SELECT sid, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS rank
      FROM t JOIN h ON point >= low AND point < high),
n AS (SELECT sid, rank % ((size + block - 1) // block) AS blk, count(*) AS times
      FROM k JOIN s4 USING (sid), b WHERE size > 0 AND rank < 3 * ((size + block - 1) // block) GROUP BY ALL),
l AS (SELECT r.*, sid, s4.size AS source_size, target, CAST(sum(r.size) OVER
             (PARTITION BY sid ORDER BY md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) - r.size AS BIGINT) AS start
      FROM r JOIN s4 ON r.source IS NOT DISTINCT FROM s4.source),
u AS (SELECT *, unnest(range(start // block, (start + size - 1) // block + 1)) AS blk FROM l, b WHERE size > 0),
mixed AS (SELECT l.*, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM l LEFT JOIN (
      SELECT doc_id, sum((least(start + size, (blk + 1) * block) - greatest(start, blk * block)) * times) AS taken
      FROM u JOIN n USING (sid, blk) GROUP BY doc_id) USING (doc_id))"""


def mixture_sql() -> str:
    return f"""
WITH {mixture_ctes()}
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, taken FROM mixed
"""


def _crc32_table() -> list[int]:
    """The byte table of the reflected polynomial 0xEDB88320 (fixed value)."""
    table = []
    for n in range(256):
        for _ in range(8):
            n = (n >> 1) ^ (0xEDB88320 if n & 1 else 0)
        table.append(n)
    return table


def spelling_sql(least_length: int = 5, least_count: int = 3, ratio: int = 2) -> str:
    """Near words meet by what is left of them without one letter; roots by recursion."""
    letters = "[A-Za-z\u00C0-\u00FF]+"
    return f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '{letters}')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
table_of AS (SELECT {_crc32_table()}::UBIGINT[] AS t),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(
           string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
           lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::UBIGINT]
                          ELSE [(192 + unicode(c) // 64)::UBIGINT, (128 + unicode(c) % 64)::UBIGINT] END))),
           lambda h, b: xor(h // 256, t[(xor(h % 256, b) + 1)::BIGINT])), 4294967295::UBIGINT) AS h
  FROM counted, table_of),
typed AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
              ELSE run END AS word, n FROM hashed),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= {least_length} GROUP BY word HAVING sum(n) >= {least_count}),
cut AS (
  SELECT word, n, i, left(word, i::BIGINT - 1) || substr(word, i::BIGINT + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
  UNION
  SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word),
best AS (
  SELECT word, count(*) AS n_near, min(struct_pack(k := -other_n, w := other)) AS b FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.k >= {ratio} * w.n THEN b.w END AS form,
         CASE WHEN -b.k >= {ratio} * w.n THEN -b.k END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS at FROM formed
  UNION ALL
  SELECT chain.word, formed.form FROM chain JOIN formed ON formed.word = chain.at WHERE formed.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n
FROM formed f JOIN chain c USING (word) JOIN formed g ON g.word = c.at WHERE g.form IS NULL"""
