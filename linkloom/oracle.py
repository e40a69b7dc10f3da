"""Plain SQL for the registered queries, for comparison on another engine.

The SQL states each result the direct way, over all pairs where that is its meaning.
"""

from __future__ import annotations

from linkloom.functions.stopwords import STOPWORDS
from linkloom.queries import HASHES

_STOP = "stop(token) AS (VALUES " + ", ".join(f"('{w}')" for w in STOPWORDS) + ")"
_WORDS = r"list_filter(regexp_split_to_array(lower({0}), '\W+'), lambda x: x <> '')"

_DOCUMENTS = "recs AS (SELECT 'r' AS src, doc_id AS id, text FROM documents)"
_PASSAGES = """recs AS (SELECT 'l' AS src, item_id AS id, text FROM benchmark
  UNION ALL SELECT 'r' AS src, doc_id AS id, text FROM documents)"""
_FEEDS = """recs AS (SELECT CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'l' ELSE 'r' END AS src,
  doc_id AS id, text FROM documents)"""

_TOKENS = f"""{_STOP},
words AS (SELECT src, id, unnest({_WORDS.format('text')}) AS token FROM recs),
kept AS (SELECT * FROM words WHERE token NOT IN (SELECT token FROM stop)),
counts AS (SELECT src, id, token, count(*) AS n FROM kept GROUP BY ALL),
lens AS (SELECT src, id, sum(n)::BIGINT AS len FROM counts GROUP BY ALL)"""

_WEIGHTS = f"""{_TOKENS},
idf AS (SELECT token, count(*) AS df, (SELECT count(*) FROM recs)::DOUBLE / count(*) AS idf
  FROM counts GROUP BY token),
w AS (SELECT src, id, token, n::DOUBLE / len * idf AS w
  FROM counts JOIN lens USING (src, id) JOIN idf USING (token)),
norms AS (SELECT src, id, sqrt(sum(w * w)) AS norm FROM w GROUP BY ALL)"""

_SIMS = f"""{_WEIGHTS},
dots AS (SELECT l.id AS l_id, r.id AS r_id, count(*) AS n_common, sum(l.w * r.w) AS dot
  FROM w l JOIN w r ON l.token = r.token AND l.src = 'l' AND r.src = 'r' GROUP BY ALL),
sims AS (SELECT l_id, r_id, n_common, round(dot / (nl.norm * nr.norm), 12) AS sim FROM dots
  JOIN norms nl ON nl.src = 'l' AND nl.id = l_id JOIN norms nr ON nr.src = 'r' AND nr.id = r_id)"""

_ALL_PAIRS = f"""{_SIMS},
every AS (SELECT l.id AS l_id, r.id AS r_id,
    CASE WHEN nl.norm > 0 AND nr.norm > 0 THEN coalesce(s.sim, 0.0) END AS sim
  FROM (SELECT id FROM recs WHERE src = 'l') l CROSS JOIN (SELECT id FROM recs WHERE src = 'r') r
  LEFT JOIN norms nl ON nl.src = 'l' AND nl.id = l.id
  LEFT JOIN norms nr ON nr.src = 'r' AND nr.id = r.id
  LEFT JOIN sims s ON s.l_id = l.id AND s.r_id = r.id)"""

_PASSAGE_GOLD = f"""gold AS (SELECT item_id AS l_id, doc_id AS r_id, 1::BIGINT AS n_pairs
  FROM (SELECT item_id, array_to_string({_WORDS.format('text')}, ' ') AS words FROM benchmark) b
  JOIN (SELECT doc_id, array_to_string({_WORDS.format('text')}, ' ') AS words FROM documents) d
  ON contains(concat(' ', d.words, ' '), concat(' ', b.words, ' ')) WHERE b.words <> '')"""

# Every pair of equal texts, and the same as one row per text.
_FEED_GOLD = """every_gold AS (SELECT l.id AS l_id, r.id AS r_id, l.text FROM recs l JOIN recs r
    ON l.text = r.text AND l.src = 'l' AND r.src = 'r'),
gold AS (SELECT min(l_id) AS l_id, min(r_id) AS r_id, count(*) AS n_pairs FROM every_gold GROUP BY text)"""
_EVERY_GOLD = """gold_rows AS (SELECT l_id, r_id FROM every_gold)"""

_PASSAGE_ROWS = "gold_rows AS (SELECT l_id, r_id FROM gold)"

_GROUPS = """keyed AS (SELECT src, id, coalesce((SELECT string_agg(token, ' ' ORDER BY token)
    FROM kept k WHERE k.src = recs.src AND k.id = recs.id), '') AS bag FROM recs),
groups AS (SELECT src, id, min(id) OVER (PARTITION BY src, bag) AS rep,
  count(*) OVER (PARTITION BY src, bag) AS n_records FROM keyed)"""

_GOLD_SIMS = """gold_sims AS (SELECT l_id, r_id, coalesce(sim, 0.0) AS sim FROM gold LEFT JOIN sims USING (l_id, r_id))"""

_MODEL = """SELECT count(g.l_id) AS n_dup,
  round(avg(sim) FILTER (g.l_id IS NOT NULL), 9) AS avg_dup,
  round(avg(sim) FILTER (g.l_id IS NULL), 9) AS avg_nondup
FROM every LEFT JOIN gold_rows g USING (l_id, r_id)"""

_CURVE = """gold_sims AS (SELECT l_id, r_id, coalesce(sim, 0.0) AS sim FROM gold_rows LEFT JOIN sims USING (l_id, r_id)),
steps AS (SELECT range AS step, range::DOUBLE / 100::DOUBLE AS threshold FROM range(1, 101)),
bins AS (SELECT floor(sim * 100)::INTEGER AS bin, 1 AS n FROM sims
  UNION ALL SELECT floor(sim * 100)::INTEGER, -1 FROM gold_sims),
level AS (SELECT bin, sum(n)::BIGINT AS n FROM bins WHERE bin BETWEEN 1 AND 100 GROUP BY bin),
tallies AS (SELECT threshold,
    coalesce((SELECT sum(n) FROM level WHERE bin >= step), 0)::BIGINT AS fp,
    (SELECT count(*) FROM gold_sims WHERE sim < threshold) AS fn,
    (SELECT count(*) FROM gold_sims WHERE sim >= threshold) AS tp FROM steps),
ratios AS (SELECT *, CASE WHEN tp + fp <> 0 THEN tp::DOUBLE / (tp + fp) END AS p,
    CASE WHEN tp + fn <> 0 THEN tp::DOUBLE / (tp + fn) END AS r FROM tallies)
SELECT threshold, tp, fp, fn, round(p, 9) AS precision, round(r, 9) AS recall,
  round(CASE WHEN r + p <> 0 THEN 2 * r * p / (r + p) END, 9) AS f FROM ratios"""

# The bins as the curve has them, the first one included; the lower edge of a bin counts.
_RATES = """gold_sims AS (SELECT l_id, r_id, floor(coalesce(sim, 0.0) * 1e9 + 0.5) / 1e9 AS sim FROM gold LEFT JOIN sims USING (l_id, r_id)),
met AS (SELECT sim AS threshold FROM gold_sims WHERE sim > 0),
thresholds AS (SELECT threshold FROM met UNION SELECT threshold / 7 FROM met UNION SELECT (threshold + 6) / 7 FROM met
  UNION SELECT range / 7.0::DOUBLE FROM range(1, 8)),
bins AS (SELECT floor(sim * 100)::INTEGER AS bin, 1 AS n FROM every WHERE sim IS NOT NULL
  UNION ALL SELECT floor(sim * 100)::INTEGER, -1 FROM gold_sims),
tallies AS (SELECT threshold,
    (SELECT coalesce(sum(n), 0) FROM bins WHERE bin::DOUBLE / 100 >= threshold)::BIGINT AS fp,
    (SELECT count(*) FROM gold_sims WHERE sim < threshold) AS fn,
    (SELECT count(*) FROM gold_sims WHERE sim >= threshold) AS tp FROM thresholds),
ratios AS (SELECT *, CASE WHEN tp + fp <> 0 THEN tp::DOUBLE / (tp + fp) END AS p,
    CASE WHEN tp + fn <> 0 THEN tp::DOUBLE / (tp + fn) END AS r FROM tallies)
SELECT round(threshold, 9) AS threshold, tp, fp, fn, round(p, 9) AS precision, round(r, 9) AS recall,
  round(CASE WHEN r + p <> 0 THEN 2 * r * p / (r + p) END, 9) AS f FROM ratios"""

# Java and RE2 agree on these patterns; \z keeps a line with a trailing line break from passing.
_RECORD = r"""'^(.+),"(.+)",(.*),(.*),(.*)\z'"""
_GOLD_LINE = r"""'^(.+),"(.+)\z'"""
_LINES = f"""lines AS (SELECT '"id","title","description","manufacturer","price"' AS value
  UNION ALL SELECT CASE
    WHEN p_size > 45 THEN concat('"', p_partkey, '",', p_name, ',,"', p_brand, '",', p_retailprice)
    WHEN p_size > 40 THEN concat('"', p_partkey, '","', p_name, '","a, b, c","', p_brand, '",', p_retailprice)
    WHEN p_size > 35 THEN concat('"', p_partkey, '","', p_name, '","a "", x","', p_brand, '",', p_retailprice)
    WHEN p_size > 30 THEN concat('"', p_partkey, '","ti, ', p_name, '","desc","m,', p_brand, '",', p_retailprice)
    ELSE concat('"', p_partkey, '","', p_name, '",,"', p_brand, '",', p_retailprice) END FROM part),
parsed AS (SELECT value, CASE WHEN NOT regexp_matches(value, {_RECORD}) THEN 'failed'
    WHEN regexp_extract(value, {_RECORD}, 1) = '"id"' THEN 'header' ELSE 'ok' END AS status FROM lines)"""

_PAIR_COUNTS = f"""turns AS (SELECT concat(a.conv_id, '-', a.turn) AS pair_id, a.text AS text_l, b.text AS text_r
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
sides AS (SELECT pair_id, 'l' AS s, unnest({_WORDS.format('text_l')}) AS token FROM turns
  UNION ALL SELECT pair_id, 'r', unnest({_WORDS.format('text_r')}) FROM turns),
pair_counts AS (SELECT pair_id, token, count(*) FILTER (s = 'l') AS nl, count(*) FILTER (s = 'r') AS nr
  FROM sides WHERE token NOT IN (SELECT token FROM stop) GROUP BY ALL),
pair_lens AS (SELECT pair_id, sum(nl)::DOUBLE AS ll, sum(nr)::DOUBLE AS lr FROM pair_counts GROUP BY ALL)"""

_HASHES = f"""hashes(hash_no, m, b, p) AS (VALUES {
    ", ".join(f"({i}, {m}::BIGINT, {b}::BIGINT, {p}::BIGINT)" for i, m, b, p in HASHES)
})"""

_SIGNATURES = (
    f"""{_TOKENS},
{_HASHES},
"""
    + """elements AS (SELECT src, id, ('0x' || substr(md5(token), 1, 15))::BIGINT % 2147483647 AS element FROM counts),
signatures AS (SELECT src, id, hash_no::INTEGER AS hash_no, min((m * element + b) % p) AS minhash
  FROM elements CROSS JOIN hashes GROUP BY ALL)"""
)


def _sql(body: str, *ctes: str) -> str:
    return f"WITH {', '.join(ctes)}\n{body}"


ORACLE: dict[str, str] = {
    "parse_record_lines": _sql(
        f"""SELECT replace(regexp_extract(value, {_RECORD}, 1), '"', '') AS id,
  concat(regexp_extract(value, {_RECORD}, 2), ' ', regexp_extract(value, {_RECORD}, 3), ' ',
    regexp_extract(value, {_RECORD}, 4)) AS text FROM parsed WHERE status = 'ok'""",
        _LINES,
    ),
    "parse_status_counts": _sql("SELECT status, count(*) AS n FROM parsed GROUP BY status", _LINES),
    "parse_rejects": _sql("SELECT value FROM parsed WHERE status = 'failed'", _LINES),
    "parse_gold_lines": _sql(
        f"""SELECT DISTINCT replace(regexp_extract(value, {_GOLD_LINE}, 1), '"', '') AS l_id,
  replace(regexp_extract(value, {_GOLD_LINE}, 2), '"', '') AS r_id FROM lines
WHERE regexp_matches(value, {_GOLD_LINE}) AND regexp_extract(value, {_GOLD_LINE}, 1) <> '"idAmazon"'""",
        _FEEDS,
        _FEED_GOLD,
        """lines AS (SELECT '"idAmazon","idGoogleBase"' AS value
  UNION ALL SELECT concat('"', l_id, '","', r_id, '"') FROM gold
  UNION ALL SELECT concat(l_id, ';', r_id) FROM gold WHERE l_id > r_id)""",
    ),
    "scan_records": _sql(
        f"""SELECT replace(regexp_extract(value, {_RECORD}, 1), '"', '') AS id,
  concat(regexp_extract(value, {_RECORD}, 2), ' ', regexp_extract(value, {_RECORD}, 3), ' ',
    regexp_extract(value, {_RECORD}, 4)) AS text FROM parsed WHERE status = 'ok'""",
        _LINES,
    ),
    "scan_counts": _sql("SELECT status, count(*) AS n FROM parsed GROUP BY status", _LINES),
    "scan_rejects": _sql("SELECT value FROM parsed WHERE status = 'failed'", _LINES),
    "scan_gold": _sql(
        f"""SELECT DISTINCT replace(regexp_extract(value, {_GOLD_LINE}, 1), '"', '') AS l_id,
  replace(regexp_extract(value, {_GOLD_LINE}, 2), '"', '') AS r_id FROM lines
WHERE regexp_matches(value, {_GOLD_LINE}) AND regexp_extract(value, {_GOLD_LINE}, 1) <> '"idAmazon"'""",
        _FEEDS,
        _FEED_GOLD,
        """lines AS (SELECT '"idAmazon","idGoogleBase"' AS value
  UNION ALL SELECT concat('"', l_id, '","', r_id, '"') FROM gold
  UNION ALL SELECT concat(l_id, ';', r_id) FROM gold WHERE l_id > r_id)""",
    ),
    # What the fields are that the lines were made of, and the lines that were made with other numbers of them.
    "csv_records": """SELECT p_partkey::VARCHAR AS id, CASE
    WHEN p_size > 45 THEN concat(p_name, '  ', p_brand) WHEN p_size > 40 THEN concat(p_name, ' a, b, c ', p_brand)
    WHEN p_size > 35 THEN concat(p_name, ' a ", x ', p_brand) WHEN p_size > 30 THEN concat('ti, ', p_name, ' desc m,', p_brand)
    ELSE concat(p_name, '  ', p_brand) END AS text, NULL::VARCHAR AS value FROM part
UNION ALL SELECT NULL, NULL, CASE WHEN p_size <= 2 THEN concat('"', p_partkey, '","', p_name, '"')
    ELSE concat('"', p_partkey, '","', p_name, '",,,1,2') END FROM part WHERE p_size <= 4""",
    "kept_postings": _sql("SELECT id, token, n FROM counts", _DOCUMENTS, _TOKENS),
    "stopword_hits": _sql(
        "SELECT token, count(*) AS n FROM words WHERE token IN (SELECT token FROM stop) GROUP BY token",
        _DOCUMENTS,
        _TOKENS,
    ),
    "doc_token_counts": _sql(
        """SELECT id, (SELECT count(*) FROM words w WHERE w.id = recs.id) AS n_all,
  (SELECT count(*) FROM kept k WHERE k.id = recs.id) AS n_kept FROM recs""",
        _DOCUMENTS,
        _TOKENS,
    ),
    "token_total": _sql("SELECT src, count(*) AS n_tokens FROM kept GROUP BY src", _PASSAGES, _TOKENS),
    "biggest_record": _sql(
        "SELECT id, len AS n_tokens FROM lens ORDER BY len DESC, id, src LIMIT 1", _PASSAGES, _TOKENS
    ),
    "duplicate_ids": _sql("SELECT src, id, count(*) AS n FROM recs GROUP BY ALL HAVING count(*) > 1", _PASSAGES),
    "corpus_vocabulary": _sql("SELECT token, count(*) AS n_docs FROM counts GROUP BY token", _PASSAGES, _TOKENS),
    "term_frequency": _sql(
        "SELECT id, token, round(n::DOUBLE / len, 9) AS tf FROM counts JOIN lens USING (src, id)", _DOCUMENTS, _TOKENS
    ),
    "idf_table": _sql("SELECT token, df, round(idf, 9) AS idf FROM idf", _PASSAGES, _WEIGHTS),
    "tfidf_weights": _sql("SELECT src, id, token, round(w, 6) AS w FROM w", _PASSAGES, _WEIGHTS),
    "doc_norms": _sql(
        "SELECT src, id, round(coalesce(norm, 0.0), 6) AS norm FROM recs LEFT JOIN norms USING (src, id)",
        _PASSAGES,
        _WEIGHTS,
    ),
    "idf_histogram": _sql(
        """SELECT bucket, round(count(*)::DOUBLE / (SELECT count(*) FROM idf), 9) AS rel_freq
FROM (SELECT least(floor((idf - lo) * 50 / (hi - lo)) + 1, 50)::INTEGER AS bucket FROM idf,
  (SELECT min(idf) AS lo, max(idf) AS hi FROM idf)) GROUP BY bucket""",
        _PASSAGES,
        _WEIGHTS,
    ),
    "inverted_index": _sql(
        """SELECT token, count(*) FILTER (src = 'l') AS n_left, count(*) FILTER (src = 'r') AS n_right
FROM counts GROUP BY token""",
        _PASSAGES,
        _TOKENS,
    ),
    "inverted_index_rows": _sql("SELECT token, src, id FROM counts", _PASSAGES, _TOKENS),
    "adhoc_similarity": _sql(
        """SELECT pair_id, floor(round(CASE WHEN nn > 0 THEN dot / nn END, 12) * 1e9 + 0.5) / 1e9 AS sim
FROM turns LEFT JOIN pair_sums USING (pair_id)""",
        _PASSAGES,
        _WEIGHTS,
        _PAIR_COUNTS,
        """pair_w AS (SELECT pair_id, coalesce(nl / nullif(ll, 0) * idf, 0.0) AS wl,
    coalesce(nr / nullif(lr, 0) * idf, 0.0) AS wr
  FROM pair_counts JOIN pair_lens USING (pair_id) LEFT JOIN idf USING (token)),
pair_sums AS (SELECT pair_id, sum(wl * wr) AS dot, sqrt(sum(wl * wl)) * sqrt(sum(wr * wr)) AS nn
  FROM pair_w GROUP BY ALL)""",
    ),
    "all_pairs_similarity": _sql(
        """SELECT l_id, count(*) AS n_pairs, count(sim) AS n_scored, round(avg(sim), 9) AS avg_sim
FROM every GROUP BY l_id""",
        _PASSAGES,
        _ALL_PAIRS,
    ),
    "similarity_lookup": _sql(
        "SELECT l_id, r_id, floor(sim * 1e9 + 0.5) / 1e9 AS sim FROM every JOIN gold USING (l_id, r_id)",
        _PASSAGES,
        _ALL_PAIRS,
        _PASSAGE_GOLD,
    ),
    "common_tokens": _sql(
        """SELECT l_id, r_id, count(token) AS n_common, coalesce(string_agg(token, ' ' ORDER BY token), '') AS tokens
FROM gold LEFT JOIN (SELECT l.id AS l_id, r.id AS r_id, l.token FROM counts l JOIN counts r
  ON l.token = r.token AND l.src = 'l' AND r.src = 'r') USING (l_id, r_id) GROUP BY ALL""",
        _PASSAGES,
        _TOKENS,
        _PASSAGE_GOLD,
    ),
    "cosine_linkage": _sql(
        "SELECT l_id, r_id, floor(sim * 1e9 + 0.5) / 1e9 AS sim FROM sims WHERE sim >= 0.01", _PASSAGES, _SIMS
    ),
    "cosine_matches": _sql("SELECT l_id, r_id, floor(sim * 1e9 + 0.5) / 1e9 AS sim FROM sims WHERE sim >= 0.05", _PASSAGES, _SIMS),
    "cosine_group_matches": _sql(
        """SELECT l.id AS l_rep, r.id AS r_rep, floor(sim * 1e9 + 0.5) / 1e9 AS sim, l.n_records * r.n_records AS n_pairs
FROM sims JOIN groups l ON l.src = 'l' AND l.id = l_id AND l.id = l.rep
JOIN groups r ON r.src = 'r' AND r.id = r_id AND r.id = r.rep WHERE sim >= 0.1""",
        _FEEDS,
        _SIMS,
        _GROUPS,
    ),
    "copy_groups": _sql("SELECT src, id, rep, n_records FROM groups", _FEEDS, _TOKENS, _GROUPS),
    "gold_duplicates": _sql(
        "SELECT l_id, r_id, n_pairs, floor(sim * 1e9 + 0.5) / 1e9 AS sim FROM every JOIN gold USING (l_id, r_id)",
        _FEEDS,
        _ALL_PAIRS,
        _FEED_GOLD,
    ),
    "non_duplicates": _sql(
        """SELECT l_id, r_id, floor(sim * 1e9 + 0.5) / 1e9 AS sim FROM sims
WHERE sim >= 0.01 AND NOT EXISTS (SELECT 1 FROM gold g WHERE g.l_id = sims.l_id AND g.r_id = sims.r_id)""",
        _PASSAGES,
        _SIMS,
        _PASSAGE_GOLD,
    ),
    "evaluate_model": _sql(_MODEL, _PASSAGES, _ALL_PAIRS, _PASSAGE_GOLD, _PASSAGE_ROWS),
    "evaluate_model_feeds": _sql(_MODEL, _FEEDS, _ALL_PAIRS, _FEED_GOLD, _EVERY_GOLD),
    "similarity_histogram": _sql(
        "SELECT floor(sim * 100)::INTEGER AS bin, count(*) AS n FROM every WHERE sim IS NOT NULL GROUP BY ALL",
        _PASSAGES,
        _ALL_PAIRS,
    ),
    "gold_similarity": _sql(
        "SELECT l_id, r_id, floor(sim * 1e9 + 0.5) / 1e9 AS sim FROM gold_sims", _PASSAGES, _SIMS, _PASSAGE_GOLD, _GOLD_SIMS
    ),
    "fp_bins": _sql(
        """SELECT floor(sim * 100)::INTEGER AS bin, count(*) AS n FROM every
WHERE sim IS NOT NULL AND NOT EXISTS (SELECT 1 FROM gold g WHERE g.l_id = every.l_id AND g.r_id = every.r_id) GROUP BY ALL""",
        _PASSAGES,
        _ALL_PAIRS,
        _PASSAGE_GOLD,
    ),
    "threshold_curve": "WITH " + ", ".join([_PASSAGES, _SIMS, _PASSAGE_GOLD, _PASSAGE_ROWS, _CURVE]),
    "threshold_rates": "WITH " + ", ".join([_PASSAGES, _ALL_PAIRS, _PASSAGE_GOLD, _RATES]),
    "threshold_curve_feeds": "WITH " + ", ".join([_FEEDS, _SIMS, _FEED_GOLD, _EVERY_GOLD, _CURVE]),
    "jaccard_set": _sql(
        """SELECT pair_id, round(count(*) FILTER (nl > 0 AND nr > 0)::DOUBLE / nullif(count(token), 0), 9) AS jaccard
FROM turns LEFT JOIN pair_counts USING (pair_id) GROUP BY pair_id""",
        _STOP,
        _PAIR_COUNTS,
    ),
    "jaccard_bag": _sql(
        """SELECT pair_id, round(coalesce(sum(nl) FILTER (nl > 0 AND nr > 0), 0)::DOUBLE
  / nullif(sum(nl) + sum(nr), 0), 9) AS jaccard
FROM turns LEFT JOIN pair_counts USING (pair_id) GROUP BY pair_id""",
        _STOP,
        _PAIR_COUNTS,
    ),
    "element_matrix": _sql(
        """SELECT element, place // 64 AS block,
  array_to_string(list_transform(range(64), lambda i: CASE WHEN list_contains(list(place % 64), i) THEN '1' ELSE '0' END), '') AS v
FROM elements JOIN (SELECT id, row_number() OVER (ORDER BY id) - 1 AS place FROM recs) USING (id) GROUP BY ALL""",
        _DOCUMENTS,
        _SIGNATURES,
    ),
    "minhash_signatures": _sql("SELECT id, hash_no, minhash FROM signatures", _DOCUMENTS, _SIGNATURES),
    "signature_rows": _sql(
        "SELECT id, string_agg(minhash, ' ' ORDER BY hash_no) AS signature FROM signatures GROUP BY id",
        _DOCUMENTS,
        _SIGNATURES,
    ),
    "minhash_estimate": _sql(
        f"""SELECT l_id, r_id, count(*) FILTER (l.minhash = r.minhash) AS n_equal,
  round(count(*) FILTER (l.minhash = r.minhash)::DOUBLE / {len(HASHES)}, 9) AS estimate
FROM gold JOIN signatures l ON l.src = 'l' AND l.id = l_id
JOIN signatures r ON r.src = 'r' AND r.id = r_id AND r.hash_no = l.hash_no GROUP BY ALL""",
        _FEEDS,
        _SIGNATURES,
        _FEED_GOLD,
    ),
    "minhash_error": _sql(
        f"""SELECT pair_id, round(jaccard, 9) AS jaccard, n_equal, round(n_equal::DOUBLE / {len(HASHES)}, 9) AS estimate,
  round(abs(n_equal::DOUBLE / {len(HASHES)} - jaccard), 9) AS error
FROM (SELECT DISTINCT pair_id FROM turns) LEFT JOIN exact USING (pair_id) LEFT JOIN agreed USING (pair_id)""",
        _STOP,
        _PAIR_COUNTS,
        _HASHES,
        """exact AS (SELECT pair_id, count(*) FILTER (nl > 0 AND nr > 0)::DOUBLE / count(*) AS jaccard FROM pair_counts GROUP BY ALL),
minima AS (SELECT pair_id, hash_no, min((m * element + b) % p) FILTER (nl > 0) AS hl, min((m * element + b) % p) FILTER (nr > 0) AS hr
  FROM (SELECT pair_id, nl, nr, ('0x' || substr(md5(token), 1, 15))::BIGINT % 2147483647 AS element FROM pair_counts)
  CROSS JOIN hashes GROUP BY ALL),
agreed AS (SELECT pair_id, count(*) FILTER (hl = hr) AS n_equal FROM minima GROUP BY pair_id
  HAVING count(hl) > 0 AND count(hr) > 0)""",
    ),
    "indicator_to_set": _sql(
        """SELECT DISTINCT id, element FROM words JOIN (SELECT token, row_number() OVER () - 1 AS element FROM stop)
USING (token)""",
        _DOCUMENTS,
        _TOKENS,
    ),
}
