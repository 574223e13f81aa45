"""SQL for DuckDB that gives the rows of the registered queries."""

ORACLES: dict[str, str] = {}

ORACLES["op2_mix_sources"] = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
own AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS turn FROM sizes GROUP BY source),
weighed AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((turn - 1) % 3 + 1)::INTEGER] AS weight FROM own),
lev AS (
  SELECT *, source_size * 2 / weight AS "full",
    (1.5::DOUBLE * sum(source_size) OVER () - 2 * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW o AS (ORDER BY source_size * 2 / weight, turn)),
targets AS (
  SELECT source, source_size, CASE WHEN "full" <= level THEN (2 * source_size)::DOUBLE
    ELSE max(CASE WHEN "full" > level THEN level END) OVER () * weight END AS target FROM lev),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM targets)
SELECT doc_id, size, source_size, target, (size * (floor(rate)::BIGINT + CASE WHEN
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT / 281474976710656.0::DOUBLE < rate - floor(rate)
  THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sizes JOIN rates ON sizes.source IS NOT DISTINCT FROM rates.source
"""

ORACLES["op5_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.keeper AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLES["op6_substring_dedup"] = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
wins AS (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS key
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) >= 50)),
firsts AS (SELECT key, min(doc_id) AS source FROM wins GROUP BY key),
cut AS (SELECT w.doc_id, w.i FROM wins w JOIN firsts f ON w.key = f.key WHERE w.doc_id > f.source),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos FROM cut),
word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM docs),
kept AS (
  SELECT x.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY x.pos) AS text
  FROM word x LEFT JOIN gone g ON x.doc_id = g.doc_id AND x.pos = g.pos WHERE g.pos IS NULL GROUP BY x.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

_FEATURES = {
    "symbol_share": ("n_symbols::DOUBLE / nullif(word_chars, 0)", 0.02),
    "dup_line_share": ("n_dup_lines::DOUBLE / n_lines", 0.1),
    "repeat_share": ("n_repeat_words::DOUBLE / nullif(n_words, 0)", 0.15),
    "word_length": ("word_chars::DOUBLE / nullif(n_words, 0)", 0.5),
}
_CELLS = " UNION ALL ".join(
    f"SELECT doc_id, lang, source, base_failed, '{name}' AS feature, coalesce({sql}, 0.0::DOUBLE) AS value, {least}::DOUBLE AS least FROM base"
    for name, (sql, least) in _FEATURES.items()
)


ORACLES["op1_quality_rules"] = rf"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
per_line AS (SELECT doc_id, line, count(*) AS n FROM lines GROUP BY doc_id, line),
dup AS (SELECT doc_id, sum(n) AS n_lines, sum(CASE WHEN regexp_matches(line, '[^\x20\x09-\x0D]') THEN n - 1 ELSE 0 END) AS n_dup FROM per_line GROUP BY doc_id),
wins AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
rep AS (SELECT DISTINCT doc_id, unnest(range(i, i + 8)) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM wins) WHERE c > 1),
nrep AS (SELECT doc_id, count(*) AS n FROM rep GROUP BY doc_id),
counted AS (SELECT d.doc_id, lang, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, n_dup::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, n_lines
  FROM d JOIN dup USING (doc_id) LEFT JOIN nrep USING (doc_id)),
base AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted),
cells AS ({_CELLS}),
sketch AS (SELECT lang, source, feature, CASE WHEN value > 0 THEN ceil(ln(value) / ln(1.02::DOUBLE)) END AS bucket, count(*) AS n
  FROM cells WHERE NOT base_failed GROUP BY ALL),
every AS (SELECT feature, bucket, n::DOUBLE / sum(n) OVER (PARTITION BY feature) AS p, sum(n) OVER (PARTITION BY feature) AS documents FROM (SELECT feature, bucket, sum(n)::BIGINT AS n FROM sketch GROUP BY ALL)),
langs AS (SELECT lang, feature, sum(n)::BIGINT AS total FROM sketch GROUP BY ALL),
lan AS (
  SELECT l.lang, l.feature, e.bucket, (coalesce(s.n, 0) + 50.0::DOUBLE * e.p) / (l.total + 50.0::DOUBLE) AS p,
    floor(50000000.0::DOUBLE * ((1 + 50.0::DOUBLE * (1.0::DOUBLE / e.documents)) / (l.total + 50.0::DOUBLE)))::BIGINT + 1000001 AS one
  FROM langs l JOIN every e ON l.feature = e.feature
  LEFT JOIN (SELECT lang, feature, bucket, sum(n)::BIGINT AS n FROM sketch GROUP BY ALL) s
    ON s.feature = e.feature AND s.lang IS NOT DISTINCT FROM l.lang AND s.bucket IS NOT DISTINCT FROM e.bucket),
weights AS (
  SELECT lang, source, feature, bucket, sum(w)::BIGINT AS w, max(one) AS one FROM (
    SELECT lang, source, feature, bucket, n * 1000000 AS w, 0 AS one FROM sketch
    UNION ALL
    SELECT g.lang, g.source, g.feature, l.bucket, floor(50000000.0::DOUBLE * l.p)::BIGINT AS w, one
    FROM (SELECT DISTINCT lang, source, feature FROM sketch) g JOIN lan l ON l.feature = g.feature AND l.lang IS NOT DISTINCT FROM g.lang) GROUP BY ALL),
ranked AS (
  SELECT *, sum(w) OVER (PARTITION BY lang, source, feature ORDER BY bucket NULLS FIRST) AS upto, sum(w) OVER (PARTITION BY lang, source, feature) AS total,
    coalesce(sum(w) FILTER (bucket IS NULL) OVER (PARTITION BY lang, source, feature), 0) AS zeros, max(one) OVER (PARTITION BY lang, source, feature) AS single,
    power(1.02::DOUBLE, bucket) AS edge, CASE WHEN bucket IS NULL THEN 0.0::DOUBLE ELSE 2 * power(1.02::DOUBLE, bucket) / 2.02::DOUBLE END AS mid FROM weights),
picked AS (
  SELECT lang, source, feature, min(mid) FILTER (upto * 4 >= total) AS q25, min(mid) FILTER (upto * 4 >= total * 3) AS q75,
    min(edge) FILTER (bucket IS NOT NULL AND total - zeros > greatest((total - zeros) // 100, single)
      AND upto - zeros >= total - zeros - greatest((total - zeros) // 100, single)) AS upper
  FROM ranked GROUP BY ALL),
verdict AS (SELECT c.doc_id, bool_and(coalesce(CASE WHEN c.feature = 'word_length'
    THEN value <= q75 + greatest(q75 - q25, least) * 4 AND value >= q25 - greatest(q75 - q25, least) * 4
    ELSE value <= greatest(coalesce(upper * 1.5::DOUBLE, 0), least) END, TRUE)) AS inside
  FROM cells c LEFT JOIN picked p ON c.feature = p.feature AND c.lang IS NOT DISTINCT FROM p.lang AND c.source IS NOT DISTINCT FROM p.source GROUP BY c.doc_id)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND inside AS kept
FROM base b JOIN verdict v ON b.doc_id = v.doc_id
"""

ORACLES["op7_near_dedup"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.k = y.k AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id WHERE 100 * c >= 85 * (p.n + q.n - c)),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, w.b FROM reach r JOIN ways w ON r.b = w.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN least USING (doc_id) LEFT JOIN n ON d.doc_id = n.doc_id
"""

ORACLES["op11_warc"] = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex, coalesce(html, '') AS payload FROM pages),
five AS (SELECT *, list_transform(range(0, 4), lambda k: ('0x' || substr(hex, 1 + 10 * k, 10))::BIGINT) AS v FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((v[(i // 8 + 1)::INTEGER] >> (35 - 5 * (i % 8))) & 31) + 1)::INTEGER, 1)), '') AS payload_digest,
  CASE WHEN page_id = max(page_id) OVER (PARTITION BY payload) THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> max(page_id) OVER (PARTITION BY payload) THEN max(page_id) OVER (PARTITION BY payload) END AS refers_to
FROM five
"""

ORACLES["op12_hard_negatives"] = r"""
WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), FALSE))) = len(embedding)),
anchor AS (SELECT * FROM given WHERE vec_id % 100 = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same, list_inner_product(a.v, x.v)::BIGINT AS score
  FROM anchor a JOIN given x ON a.vec_id <> x.vec_id),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INTEGER AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 10
"""

ORACLES["op13_prefix_trie"] = r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, sha256(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS words
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'digest': digest, 'words': words} ORDER BY turn NULLS FIRST, digest) AS turns FROM raw GROUP BY conv_id),
heads AS (
  SELECT *, (4294967295 - list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda c, zero: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END))) % 4 AS h FROM own),
conv AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
  FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
steps AS (
  SELECT conv_id, len(turns) AS n, d AS depth, coalesce(array_to_string(list_transform(turns[1:d], lambda t: t.digest), ''), '') AS prefix,
    CASE WHEN d > 0 THEN turns[d::INTEGER].words ELSE 0 END AS words
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM conv)),
node AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '') AS ends
  FROM steps GROUP BY prefix, depth),
linked AS (
  SELECT c.*, p.conv_id AS parent_conv_id, p.prefix AS parent FROM node c LEFT JOIN node p ON c.depth = p.depth + 1 AND left(c.prefix, 64 * p.depth) = p.prefix),
children AS (SELECT parent AS prefix, count(*) AS n FROM linked WHERE parent IS NOT NULL GROUP BY parent),
up AS (
  SELECT prefix AS top, prefix, parent FROM linked
  UNION ALL SELECT l.prefix, up.prefix, l.parent FROM up JOIN linked l ON l.prefix = up.parent),
under AS (
  SELECT up.top, count(*) FILTER (c.n IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved
  FROM up JOIN node n ON n.prefix = up.prefix LEFT JOIN children c ON c.prefix = up.prefix GROUP BY up.top)
SELECT l.conv_id::BIGINT AS conv_id, l.depth::BIGINT AS depth, l.parent_conv_id::BIGINT AS parent_conv_id, l.n_convs::BIGINT AS n_convs, coalesce(c.n, 0)::BIGINT AS n_children,
  u.n_leaves::BIGINT AS n_leaves, u.saved::BIGINT AS saved_tokens, sha256(l.ends) AS ends_sha256
FROM linked l JOIN under u ON u.top = l.prefix LEFT JOIN children c ON c.prefix = l.prefix
"""
