"""SQL for those operators that SQL can state. The others are tested against brute force."""

from __future__ import annotations

_TOP_K = """WITH valid AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS c FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id,
    list_sum(list_transform(list_zip(q.c, v.c), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM valid q JOIN valid v ON q.vec_id % 100 = 0 AND v.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""

_URLS = r"""WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw,
  regexp_extract(coalesce(rest, ''), '^[^?#]*') AS whole FROM cut),
parts AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  substr(whole, length(raw) + 1) AS path FROM split),
rules(verdict, rule) AS (VALUES ('allow', 'com/'), ('block', 'example.com/en/'), ('allow', 'www.example.com/en/'),
  ('block', 'net/es/'), ('block', 'net/fr/')),
named AS (SELECT verdict, rule, split_part(rule, '/', 1) AS rule_host, substr(rule, strpos(rule, '/')) AS rule_path FROM rules),
fits AS (SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM parts JOIN named ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f USING (page_id)"""

_MIX = r"""WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY source),
levels(round, level) AS (
  SELECT 0, 0::DOUBLE
  UNION ALL
  SELECT round + 1, (1.5 * (SELECT sum(source_size) FROM sources)
      - coalesce((SELECT sum(2.0 * source_size) FROM sources WHERE weight * level >= 2.0 * source_size), 0))
    / (SELECT sum(weight) FROM sources WHERE weight * level < 2.0 * source_size)
  FROM levels WHERE round < 60 AND EXISTS (SELECT 1 FROM sources WHERE weight * level < 2.0 * source_size)),
targets AS (SELECT source, source_size, least(2.0 * source_size, weight * (SELECT max(level) FROM levels)) AS target FROM sources)
SELECT doc_id, size, source_size, target FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source"""

# The sizes and targets of op2; which documents are taken follows from a hash that SQL does not share.
MIX_TARGETS = _MIX

# crc32 of a text in column `h` as hexadecimal digits: the first element is the start value, then each
# byte comes with seven zeros, for the eight shifts that it takes.
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(length(h) // 2),
    lambda k: [('0x' || substr(h, 2 * k + 1, 2))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295)"""

_SPELLING = rf"""WITH RECURSIVE found AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (SELECT word, n, {_CRC} AS crc FROM (
  SELECT word, n, hex(encode(concat(doc_id, ':', word))) AS h FROM found WHERE length(word) >= 7)),
edited AS (SELECT CASE WHEN crc % 31 = 0 THEN concat(substr(word, 1, crc % length(word)), substr(word, crc % length(word) + 2))
  ELSE word END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM edited WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
shorter AS (SELECT word, n, i, concat(substr(word, 1, i), substr(word, i + 2)) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b USING (rest, i) WHERE a.word <> b.word
  UNION SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.rest = w.word
  UNION SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.rest = w.word),
near AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS best, max(other_n) AS best_n FROM pairs GROUP BY word),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form,
  CASE WHEN best_n >= 10 * n THEN best_n END AS form_n FROM words LEFT JOIN near USING (word)),
way AS (SELECT word, word AS root, form AS further FROM forms
  UNION ALL SELECT way.word, f.word, f.form FROM way JOIN forms f ON f.word = way.further)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, root FROM way WHERE further IS NULL) USING (word)"""

_PERIODS = rf"""WITH cut AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    hex(encode(doc_id::VARCHAR)) AS h FROM documents),
seeds AS (SELECT doc_id, w, len(w) AS n, {_CRC} AS crc FROM cut),
places AS (SELECT *, (crc // 10) % greatest(n, 1) AS a FROM seeds),
stretches AS (SELECT *, 1 + (n - a) // (3 + (crc // 10) % 8) AS p FROM places),
texts AS (SELECT doc_id, n, list_transform(range(n), lambda i: w[CASE WHEN crc % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END + 1]) AS w
  FROM stretches),
words AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM texts),
same AS (SELECT x.doc_id, x.i, y.i - x.i AS period FROM words x JOIN words y
  ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT doc_id, period, i, i - row_number() OVER (PARTITION BY doc_id, period ORDER BY i) AS island FROM same),
stretched AS (SELECT doc_id, min(i) AS start, count(*) + period AS length, period FROM islands GROUP BY doc_id, period, island
  HAVING count(*) + period >= greatest(6, 4 * period)),
runs AS (SELECT doc_id, start, length, min(period) AS period FROM stretched GROUP BY ALL),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines,
  first({{'start': start, 'length': length, 'period': period}} ORDER BY length::DOUBLE / period DESC, start, period) AS best
  FROM runs GROUP BY doc_id),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS line FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
  1000 * best.length // best.period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(coalesce(line, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)"""

ORACLE: dict[str, str] = {
    "op11_spelling": _SPELLING,
    "op12_periods": _PERIODS,
    "op4_topk": _TOP_K,
    "op7_url_rules": _URLS,
}
