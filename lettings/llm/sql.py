"""SQL twins for DuckDB, over whole tables."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

CONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item, least(13, len(w)) AS width, array_to_string(w[s:s + 12], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS s FROM i WHERE len(w) > 0)
),
widths AS (SELECT DISTINCT width FROM iw),
dw AS (
  SELECT r, width, s, array_to_string(w[s:s + width - 1], ' ') AS win
  FROM (
    SELECT r, w, width, unnest(range(1, len(w) - width + 2)) AS s
    FROM d JOIN widths ON len(w) >= width
  )
),
hits AS (SELECT r, s, width, item FROM dw JOIN iw USING (width, win)),
places AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + width)) AS p FROM hits) GROUP BY r),
words AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d),
counted AS (SELECT word, count(*) AS n FROM words GROUP BY word),
ranked AS (
  SELECT win, word, coalesce(n, 0) AS n, row_number() OVER (PARTITION BY win, width ORDER BY coalesce(n, 0), pos) AS k, width
  FROM (SELECT width, win, unnest(string_split(win, ' ')) AS word, unnest(range(width)) AS pos
    FROM (SELECT DISTINCT width, win FROM iw)) LEFT JOIN counted USING (word)
),
rarest AS (
  SELECT win, width, list_sort(list(DISTINCT word)) AS terms, min_by(word, k) AS anchor
  FROM ranked WHERE k <= 4 GROUP BY win, width HAVING min(n) > 0
),
sets AS (SELECT terms, min(anchor) AS anchor FROM rarest GROUP BY terms),
around AS (
  SELECT terms, r, pos, word
  FROM (SELECT DISTINCT terms, r FROM sets JOIN words ON word = anchor) c
    JOIN (SELECT terms, unnest(terms) AS word FROM sets) t USING (terms) JOIN words USING (r, word)
),
close AS (
  SELECT DISTINCT terms, r FROM (
    SELECT a.terms, a.r, a.pos FROM around a JOIN around b
      ON a.terms = b.terms AND a.r = b.r AND b.pos BETWEEN a.pos AND a.pos + 38
    GROUP BY a.terms, a.r, a.pos HAVING count(DISTINCT b.word) = len(a.terms)
  )
),
near AS (
  SELECT r, count(*) AS n_near, string_agg(item, ',' ORDER BY item) AS near
  FROM (SELECT DISTINCT r, item FROM close JOIN rarest USING (terms) JOIN iw USING (win, width)) GROUP BY r
),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
  coalesce(n_near, 0) AS n_near, sha256(coalesce(near, '')) AS near_sha256
FROM d LEFT JOIN places USING (r) LEFT JOIN named USING (r) LEFT JOIN near USING (r)
"""

_BYTES = "list_transform(range(0, CAST(length(hex(word)) / 2 AS BIGINT)), lambda i: (instr('0123456789ABCDEF', substr(hex(word), 2 * i + 1, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(hex(word), 2 * i + 2, 1)) - 1)"

RESAMPLING = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
steps AS (
  SELECT list(c ORDER BY i) AS step FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) t(i)
  )
),
dw AS (SELECT r, unnest(w) AS word FROM d),
bw AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
crc AS (
  SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {_BYTES}),
      lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT word FROM dw UNION SELECT word FROM bw), steps
),
s AS (SELECT bucket, CAST(count(*) AS DOUBLE) AS s FROM dw JOIN crc USING (word) GROUP BY bucket),
t AS (SELECT bucket, CAST(count(*) AS DOUBLE) AS t FROM bw JOIN crc USING (word) GROUP BY bucket),
total AS (
  SELECT coalesce((SELECT sum(s) FROM s), 0) + 10000 AS s_all, coalesce((SELECT sum(t) FROM t), 0) + 10000 AS t_all
),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * s_all / ((s + 1) * t_all))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket), total
),
weights AS (
  SELECT r, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
  FROM dw JOIN crc USING (word) JOIN gain USING (bucket) GROUP BY r
),
drawn AS (
  SELECT r, doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight,
    CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM d LEFT JOIN weights USING (r)
),
scored AS (
  SELECT r, doc_id, n_features, weight,
    weight + CAST(floor(-1000 * ln(-ln((CAST(h AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM drawn
),
ranks AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS rank,
    count(*) OVER () AS n
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranks USING (r)
"""


def _assigned(vectors: str, centroids: str) -> str:
    apart = "list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    return f"""
  SELECT r, vec_id, x, arg_min(k, (apart, k)) AS k, min(apart) AS apart
  FROM (SELECT r, vec_id, x, k, CAST({apart} AS BIGINT) AS apart FROM {vectors}, {centroids})
  GROUP BY r, vec_id, x"""


def _moved(assigned: str, centroids: str) -> str:
    return f"""
  SELECT k, coalesce(m.c, o.c) AS c FROM {centroids} o LEFT JOIN (
    SELECT k, list(mean ORDER BY i) AS c FROM (
      SELECT k, i, CAST(floor(sum(value) / count(*)) AS BIGINT) AS mean
      FROM (SELECT k, unnest(x) AS value, unnest(range(64)) AS i FROM {assigned}) GROUP BY k, i
    ) GROUP BY k
  ) m USING (k)"""


CENTROIDS = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64
),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, r) - 1 AS k, x AS c
  FROM (SELECT r, x, sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM v)
  ORDER BY h, r LIMIT 16
),
a0 AS MATERIALIZED ({_assigned("v", "c0")}),
c1 AS MATERIALIZED ({_moved("a0", "c0")}),
a1 AS MATERIALIZED ({_assigned("v", "c1")}),
c2 AS MATERIALIZED ({_moved("a1", "c1")}),
a2 AS MATERIALIZED ({_assigned("v", "c2")}),
c3 AS MATERIALIZED ({_moved("a2", "c2")}),
a3 AS MATERIALIZED ({_assigned("v", "c3")})
SELECT vec_id, CAST(k AS INTEGER) AS cluster, apart AS distance,
  CAST(sum(apart) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
  CAST(sum(apart) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a3 JOIN c3 USING (k)
"""

_FITS = "(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"

URLS = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS host FROM cut),
parts AS (
  SELECT page_id, regexp_extract(substr(rest, length(host) + 1), '^[^?#]*') AS path,
    translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
  FROM hosts
)
SELECT page_id, host, path,
  CASE WHEN {_FITS.format(host="example.net", path="/en/")} THEN 'example.net/en/'
    WHEN {_FITS.format(host="example.com", path="/de/")} THEN 'example.com/de/'
    WHEN {_FITS.format(host="org", path="/fr/")} THEN 'org/fr/'
    WHEN {_FITS.format(host="net", path="/")} THEN 'net/' END AS rule,
  CASE WHEN {_FITS.format(host="example.net", path="/en/")} THEN 'allow'
    WHEN {_FITS.format(host="example.com", path="/de/")} THEN 'block'
    WHEN {_FITS.format(host="org", path="/fr/")} THEN 'allow'
    WHEN {_FITS.format(host="net", path="/")} THEN 'block'
    WHEN regexp_matches(host, '(^|\\.)(adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm)\\.example\\.(com|net|org)$')
      THEN 'block' ELSE 'allow' END AS verdict
FROM parts
"""
