"""DuckDB SQL for the corpus queries that SQL can express.

Limits, rules and word lists are written out here, not imported, so a wrong
value in the operators shows as a difference.
"""

OP2 = r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), rules(verdict, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), globs(place, wild, pattern) AS (
  VALUES (1, '*spam*', '%spam%'), (2, '*cheap-pills*', '%cheap-pills%'), (3, '*casino*/*', '%casino%/%'),
         (4, '*/login*', '%/login%'), (5, '*.exe', '%.exe'), (6, '*.zip', '%.zip')
), judged AS (
  SELECT p.*,
    (SELECT arg_max(struct_pack(r := rhost || rpath, v := verdict), (length(rhost || rpath), verdict, rhost)) FROM rules
     WHERE (p.host = rhost OR ends_with(p.host, '.' || rhost)) AND starts_with(p.path, rpath)) AS best,
    (SELECT arg_min(wild, place) FROM globs WHERE p.host || p.path LIKE pattern) AS hit
  FROM parts p
)
SELECT page_id, host, path, best.r AS rule,
       coalesce(best.v, CASE WHEN hit IS NOT NULL OR host = '' THEN 'block' ELSE 'allow' END) AS verdict,
       CASE WHEN best IS NULL THEN hit END AS "glob"
FROM judged
"""

OP3 = r"""
WITH base AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT row, unnest(range(1, len(words) - 6)) AS i, words FROM base WHERE len(words) >= 8
), counted AS (
  SELECT row, i, count(*) OVER (PARTITION BY row, array_to_string(words[i:i + 7], ' ')) AS times FROM windows
), repeated AS (
  SELECT row, i, i - lag(i, 1, -100) OVER (PARTITION BY row ORDER BY i) AS gap FROM counted WHERE times > 1
), covered AS (
  SELECT row, sum(least(8, gap))::BIGINT AS n FROM repeated GROUP BY row
), stops AS (
  SELECT unnest([w, upper(w[1]) || w[2:], upper(w)]) AS form FROM (SELECT unnest([
    'the','of','and','to','in','is','that','for','it','was','on','as','with','by','be','are','or','an','at','this',
    'der','die','das','und','den','von','zu','mit','des','auf','ein','im','dem','nicht','ist','eine','für','sich',
    'de','la','le','et','les','des','en','un','du','une','est','pour','qui','dans','que','par','sur','avec',
    'el','los','y','del','se','las','una','con','no','su','para','es','al','lo','como']) AS w)
), stopped AS (
  SELECT row, count(*) AS n FROM (SELECT row, unnest(words) AS w FROM base) WHERE w IN (SELECT form FROM stops) GROUP BY row
), figures AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(lines)::BIGINT AS n_lines,
         coalesce(s.n, 0)::BIGINT AS n_stop_words,
         len(regexp_extract_all(t, '[A-ZÀ-ÖØ-Þ]'))::BIGINT AS n_upper
  FROM base LEFT JOIN covered c USING (row) LEFT JOIN stopped s USING (row)
), verdicts AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         array_to_string(list_filter([
           CASE WHEN word_chars < 2.0 * n_words OR word_chars > 14.0 * n_words THEN 'word_length' END,
           CASE WHEN n_symbols > 0.5 * n_words THEN 'symbols' END,
           CASE WHEN n_upper > 0.5 * word_chars THEN 'shouted' END,
           CASE WHEN n_stop_words < 0.02::DOUBLE * n_words THEN 'stop_words' END,
           CASE WHEN n_dup_lines > 0.5 * n_lines THEN 'repeated_lines' END], lambda x: x IS NOT NULL), ',') AS failed_rules
  FROM figures
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, n_lines, n_stop_words, n_upper, failed_rules
FROM verdicts
"""

OP7 = r"""
WITH signed AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256,
         length(coalesce(text, '')) AS points
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER best = 1 AS kept, text_sha256
FROM signed
WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
"""

OP1 = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens,
         md5(coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))) AS identity
  FROM documents
), totals AS (
  SELECT source, sum(n_tokens)::BIGINT AS tokens, count(*) AS n_docs FROM docs GROUP BY source
), sizes AS (
  SELECT list(tokens::DOUBLE ORDER BY tokens) FILTER (WHERE tokens > 0) AS l, max(tokens)::DOUBLE AS largest FROM totals
), bisect(step, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN fine THEN low ELSE mid END, CASE WHEN fine THEN mid ELSE high END
  FROM (SELECT step, low, high, (low + high) / 2 AS mid,
               list_max(list_transform(l, lambda t: pow(t / largest, (low + high) / 2) / t))
               / list_min(list_transform(l, lambda t: pow(t / largest, (low + high) / 2) / t)) <= 1.5 AS fine
        FROM bisect, sizes WHERE step < 60)
), solved AS (
  SELECT largest, l, round(CASE WHEN list_max(list_transform(l, lambda t: 1.0::DOUBLE / t))
    / list_min(list_transform(l, lambda t: 1.0::DOUBLE / t)) <= 1.5 THEN 0.0 ELSE high END, 9) AS x
  FROM bisect, sizes WHERE step = 60
), weighted AS (
  SELECT t.*, CASE WHEN tokens = 0 THEN 1.0 ELSE round(pow(tokens / largest, x)
    * list_max(list_transform(l, lambda s: s / pow(s / largest, x))) / tokens, 6) END AS passes
  FROM totals t, solved
), plan AS (
  SELECT source, floor(passes)::INTEGER AS whole, round((passes - floor(passes)) * tokens)::BIGINT AS rest,
         ceil(sqrt(n_docs))::BIGINT AS n_blocks
  FROM weighted
), dealt AS (
  SELECT d.*, p.whole, p.rest, ('0x' || substr(md5('42:deal:' || identity), 1, 13))::BIGINT % n_blocks AS block
  FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
), keyed AS (
  SELECT *, ('0x' || substr(md5('42:block:' || whole || ':' || coalesce(source, 'null') || ':' || block), 1, 13))::BIGINT AS last_block_key,
         ('0x' || substr(md5('42:doc:' || whole || ':' || identity), 1, 13))::BIGINT AS last_doc_key
  FROM dealt
), spent AS (  -- tokens of the last pass up to the block, and up to the document inside its block
  SELECT *, sum(n_tokens) OVER (PARTITION BY source ORDER BY last_block_key, block) AS upto_block,
         sum(n_tokens) OVER (PARTITION BY source, block) AS in_block,
         sum(n_tokens) OVER (PARTITION BY source, block ORDER BY last_doc_key) AS upto_doc
  FROM keyed
), ends AS (
  SELECT source, min(last_doc_key) AS cut_doc_key, min(block) AS cut_block, min(last_block_key) AS cut_block_key
  FROM spent WHERE rest > 0 AND upto_block >= rest AND upto_block - in_block < rest AND upto_doc >= rest - (upto_block - in_block)
  GROUP BY source
), taken AS (
  SELECT s.*, unnest(range(whole + CASE WHEN rest > 0 AND (
      (last_block_key, s.block) < (cut_block_key, cut_block) OR (s.block = cut_block AND last_doc_key <= cut_doc_key)) THEN 1 ELSE 0 END)) AS e
  FROM spent s LEFT JOIN ends ON s.source IS NOT DISTINCT FROM ends.source
)
SELECT doc_id, source, n_tokens, e::INTEGER AS epoch, block,
       ('0x' || substr(md5('42:block:' || e || ':' || coalesce(source, 'null') || ':' || block), 1, 13))::BIGINT AS block_key,
       ('0x' || substr(md5('42:doc:' || e || ':' || identity), 1, 13))::BIGINT AS doc_key
FROM taken
"""

OP6 = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM split WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * k >= 85 * (a.n + b.n - k)
), ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach(x, y) AS (
  SELECT x, y FROM ways UNION SELECT r.x, b.y FROM reach r JOIN ways b ON r.y = b.x
), least_reached AS (
  SELECT x, min(y) AS y FROM reach GROUP BY x
), classes AS (
  SELECT doc_id, string_agg(g, chr(10) ORDER BY g) AS whole FROM grams GROUP BY doc_id
), same AS (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY whole) AS class_id, count(*) OVER (PARTITION BY whole) AS class_size FROM classes
)
SELECT s.doc_id, coalesce(z.n, 0) AS n_shingles, least(s.doc_id, coalesce(l.y, s.doc_id)) AS component_id,
       coalesce(c.class_id, s.doc_id) AS class_id, coalesce(c.class_size, 1) AS class_size
FROM split s LEFT JOIN sizes z USING (doc_id) LEFT JOIN least_reached l ON l.x = s.doc_id LEFT JOIN same c ON c.doc_id = s.doc_id
"""

OP11 = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), scored AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id, c.rid AS crid, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.rid <> c.rid WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER best::INTEGER AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST, crid)
QUALIFY row_number() OVER best <= 20
"""

OP12 = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), scored AS (
  SELECT a.rid, a.vec_id AS anchor_id, c.vec_id, c.rid AS crid, a.label = c.label AS alike, list_dot_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.rid <> c.rid WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT rid, anchor_id, crid, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST, crid) <= 5
)
SELECT p.anchor_id, p.positive_id, row_number() OVER best::INTEGER AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.rid = p.rid AND NOT s.alike AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW best AS (PARTITION BY p.rid, p.crid ORDER BY s.score DESC, s.vec_id NULLS LAST, s.crid)
QUALIFY row_number() OVER best <= 3
"""

ORACLE_SQL: dict[str, str] = {
    "op1_mixing": OP1,
    "op2_url_filters": OP2,
    "op3_quality_rules": OP3,
    "op6_jaccard_join": OP6,
    "op7_exact_dedup": OP7,
    "op11_maxscore": OP11,
    "op12_hard_negatives": OP12,
}
