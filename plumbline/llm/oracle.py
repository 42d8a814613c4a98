"""DuckDB statements of the operators that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP5 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents
), b AS (
  SELECT item_id, {_WORDS} AS w FROM benchmark
), grams AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), windows AS (
  SELECT rid, i, k, array_to_string(w[i : i + k - 1], ' ') AS gram
  FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM d, (SELECT DISTINCT k FROM grams) WHERE len(w) >= k)
), found AS (
  SELECT rid, i, k, item_id FROM windows JOIN grams USING (k, gram)
), hit AS (
  SELECT rid, count(DISTINCT p) AS n
  FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT rid, i, k FROM found)) GROUP BY rid
), items AS (
  SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit,
  coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(list, '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)
"""

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"

OP11 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_TERMS} AS w
  FROM documents
), t AS (
  SELECT rid, lang, source, unnest(w) AS term FROM d
), kept AS (
  SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= 10
), kc AS (
  SELECT lang, source, term, count(*) AS cnt FROM t JOIN kept USING (lang, term) GROUP BY ALL
), gs AS (
  SELECT g.lang, g.source, coalesce(s.n, 0) AS n, coalesce(v.v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN (SELECT lang, source, sum(cnt) AS n FROM kc GROUP BY ALL) s USING (lang, source)
  LEFT JOIN (SELECT lang, count(*) AS v FROM kept GROUP BY lang) v USING (lang)
), lt AS (
  SELECT lang, sum(n) AS n, max(v) AS v FROM gs GROUP BY lang
), lc AS (
  SELECT lang, term, sum(cnt) AS cnt FROM kc GROUP BY ALL
), pr AS (
  SELECT a.lang, a.source, b.source AS item, a.n AS na, b.n AS nb, a.v
  FROM gs a JOIN gs b ON a.lang = b.lang AND a.source <> b.source
), dense AS (
  SELECT pr.lang, pr.source, pr.item,
    1 + (coalesce(x.cnt, 0) + 2)::HUGEINT * 1000000000 // (pr.na + 2 * pr.v) AS p,
    1 + (coalesce(y.cnt, 0) + 2)::HUGEINT * 1000000000 // (pr.nb + 2 * pr.v) AS q
  FROM pr JOIN kept k ON k.lang = pr.lang
  LEFT JOIN kc x ON x.lang = pr.lang AND x.source = pr.source AND x.term = k.term
  LEFT JOIN kc y ON y.lang = pr.lang AND y.source = pr.item AND y.term = k.term
), pairs AS (
  SELECT pr.lang, pr.source, 'pair' AS part, pr.item, coalesce(s.value, 0) AS value
  FROM pr LEFT JOIN (
    SELECT lang, source, item, sum((p - q) * (p - q) // (p + q)) AS value FROM dense GROUP BY ALL
  ) s USING (lang, source, item)
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM (
    SELECT kc.lang, kc.source, kc.term,
      1 + (kc.cnt + 2)::HUGEINT * 1000000000 // (gs.n + 2 * gs.v) AS p,
      1 + (lc.cnt + 2)::HUGEINT * 1000000000 // (lt.n + 2 * lt.v) AS q
    FROM kc JOIN gs USING (lang, source) JOIN lc USING (lang, term) JOIN lt USING (lang)
  ) WHERE p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item ASC) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""
