"""DuckDB SQL for the rows of the queries that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP7 = rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM d),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS g FROM starts),
first AS (SELECT g, min(doc_id) AS f FROM win GROUP BY g),
gone AS (
  SELECT doc_id, list(DISTINCT p) AS gone
  FROM (SELECT win.doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN first USING (g) WHERE f < win.doc_id)
  GROUP BY doc_id
),
kept AS (
  SELECT d.doc_id, w, coalesce(gone, []) AS gone FROM d LEFT JOIN gone ON d.doc_id = gone.doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed,
  sha256(array_to_string(
    CASE WHEN len(gone) = 0 THEN w
    ELSE [w[p] FOR p IN range(1, len(w) + 1) IF NOT list_contains(gone, p)] END, ' ')) AS kept_sha256
FROM kept
"""

TEXT_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

# an item of fewer than five words is one shingle, and is looked for among shingles of its length
OP8 = rf"""
WITH b AS (
  SELECT item_id, w, least(5, len(w)) AS n, len(list_distinct([array_to_string(w[i:i + least(5, len(w)) - 1], ' ')
    FOR i IN range(1, len(w) - least(5, len(w)) + 2)])) AS shingles, row_number() OVER () AS r
  FROM (SELECT item_id, {TEXT_WORDS} AS w FROM benchmark) WHERE len(w) > 0
),
q AS (SELECT DISTINCT r, item_id, n, shingles, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
d AS (SELECT DISTINCT e, doc_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT e, doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
    FROM (SELECT row_number() OVER () AS e, doc_id, {TEXT_WORDS} AS w FROM documents), (SELECT DISTINCT n FROM b)))
SELECT doc_id, item_id, count(*) AS shared, shingles
FROM d JOIN q USING (n, s) GROUP BY e, r, doc_id, item_id, shingles HAVING count(*) >= 0.8 * shingles
"""

OP3 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT *, [('0x' || substr(md5(t), 1, 8))::BIGINT FOR t IN l] AS x FROM d),
rolled AS (
  SELECT r, doc_id, l, [CASE WHEN regexp_full_match(l[i] || l[i + 1], '[ \t\r\n\x0B\x0C]*') THEN 4294967296
    ELSE (x[i] * 1000003 + x[i + 1]) % 4294967296 END FOR i IN range(1, len(l))] AS v FROM x
),
marked AS (
  SELECT r, doc_id, l, list_sort(list_distinct([m FOR m IN
    CASE WHEN len(v) = 1 THEN [1] ELSE [CASE WHEN v[i] <= v[i + 1] THEN i ELSE i + 1 END FOR i IN range(1, len(v))] END
    IF v[m] < 4294967296])) AS m
  FROM rolled
),
chunk AS (
  SELECT r, doc_id, l, m[n] AS a, l[m[n]] || chr(10) || l[m[n] + 1] AS body,
    CASE WHEN n > 1 THEN l[m[n - 1]:m[n] - 1] ELSE l[1:m[n] - 1] END AS before,
    CASE WHEN n < len(m) THEN l[m[n] + 2:m[n + 1] + 1] ELSE l[m[n] + 2:] END AS behind
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS n FROM marked)
),
first AS (
  SELECT body, doc_id AS f_doc, a AS f_at, before, behind FROM chunk
  QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, a,
    array_to_string([t || chr(10) FOR t IN before], ''), array_to_string([t || chr(10) FOR t IN behind], '')) = 1
),
hit AS (
  SELECT r, a,
    [l[a - j] = f.before[len(f.before) + 1 - j] FOR j IN range(1, least(len(f.before), a - 1) + 1)] AS back,
    [l[a + 1 + j] = f.behind[j] FOR j IN range(1, least(len(f.behind), len(l) - a - 1) + 1)] AS on_
  FROM chunk c JOIN first f USING (body) WHERE f_doc < doc_id OR (f_doc = doc_id AND f_at < a)
),
gone AS (
  SELECT r, list(DISTINCT p) AS gone FROM (
    SELECT r, unnest(range(a - coalesce(nullif(list_position(back, false), 0) - 1, len(back)),
      a + 2 + coalesce(nullif(list_position(on_, false), 0) - 1, len(on_)))) AS p FROM hit
  ) GROUP BY r
)
SELECT doc_id, len(l)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string([l[i] FOR i IN range(1, len(l) + 1) IF gone IS NULL OR NOT list_contains(gone, i)], chr(10))) AS kept_sha256
FROM d LEFT JOIN gone USING (r)
"""

OP4 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_append({WORDS}, chr(10)) AS w FROM documents  -- no word has a line feed
),
good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
pair AS (
  SELECT r, g.doc_id IS NOT NULL AS g, CASE WHEN i > 1 THEN w[i - 1] ELSE chr(10) END AS u, w[i] AS v
  FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM d) d LEFT JOIN good g ON g.doc_id = d.doc_id
),
pairs AS (SELECT u, v, count(*) FILTER (g)::DOUBLE AS t, count(*)::DOUBLE AS k FROM pair GROUP BY u, v),
words AS (SELECT v AS w, count(*) FILTER (g)::DOUBLE AS t, count(*)::DOUBLE AS k FROM pair GROUP BY v),
total AS (
  SELECT sum(t) AS t, CASE WHEN sum(t) > 0 THEN sum(t) ELSE sum(k) END AS k, count(*) AS words,
    CASE WHEN sum(t) > 0 THEN sum(t) / sum(k) ELSE 1 END AS f FROM words
),
loss AS (
  SELECT p.u, p.v,
    -log2((p.t + (o.t + 1.0 / words) / (total.t + 1)) / (c.t + 1)) AS target,
    -log2((p.k * f + (o.k * f + 1.0 / words) / (total.k + 1)) / (c.k * f + 1)) AS background
  FROM pairs p JOIN words o ON o.w = p.v JOIN words c ON c.w = p.u, total
)
SELECT doc_id, count(*) AS n_tokens, round(avg(target), 6) AS target_loss,
  round(avg(background), 6) AS background_loss, round(avg(target) - avg(background), 6) AS difference
FROM pair JOIN loss USING (u, v) JOIN d USING (r) GROUP BY r, doc_id
"""

OP5 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
starts AS (SELECT r, b, unnest(range(1, octet_length(b) - 198)) AS s FROM d),
windows AS (SELECT r, s, md5(b[s:s + 199]) AS h FROM starts),
hit AS (SELECT r, s FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
cut AS (
  SELECT r, s, CASE WHEN s > coalesce(lag(s) OVER w, -1000) + 200 THEN 1 ELSE 0 END AS opens
  FROM hit WINDOW w AS (PARTITION BY r ORDER BY s)
),
runs AS (
  SELECT r, min(s) AS first, max(s) + 200 AS past
  FROM (SELECT r, s, sum(opens) OVER (PARTITION BY r ORDER BY s) AS run FROM cut) GROUP BY r, run
),
kept AS (
  SELECT r, coalesce(lag(past) OVER w, 1) AS a, first - 1 AS z FROM runs WINDOW w AS (PARTITION BY r ORDER BY first)
  UNION ALL SELECT d.r, coalesce(max(past), 1), octet_length(any_value(b)) FROM d LEFT JOIN runs ON runs.r = d.r GROUP BY d.r
),
bytes AS (
  SELECT kept.r, string_agg(CASE WHEN z >= a THEN hex(b[a:z]) ELSE '' END, '' ORDER BY a) AS x
  FROM kept JOIN d ON d.r = kept.r GROUP BY kept.r
),
gone AS (SELECT r, sum(past - first) AS n, count(*) AS spans FROM runs GROUP BY r)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed,
  coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(x)) AS kept_sha256
FROM d JOIN bytes ON bytes.r = d.r LEFT JOIN gone ON gone.r = d.r
"""

OP11 = """
WITH ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
bits AS (  -- crc32 of the decimal id, bit by bit
  SELECT conv_id, list_reduce([4294967295::BIGINT] || flatten([[((b >> i) & 1)::BIGINT FOR i IN range(0, 8)]
      FOR b IN [unicode(ch) FOR ch IN string_split(conv_id::VARCHAR, '')]]),
    lambda acc, bit: CASE WHEN (acc & 1) <> bit THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END) AS reg
  FROM ids
),
h AS (SELECT conv_id, xor(reg, 4294967295) % 6 AS h, conv_id - conv_id % 100 AS base FROM bits),
t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL
),
n AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id),
rebuilt AS (
  SELECT h.conv_id, i AS d, role, text FROM h JOIN t ON t.conv_id = h.base AND i <= h
  UNION ALL
  SELECT h.conv_id, least(h, coalesce(n, 0)) + i - h AS d, role, text
  FROM h JOIN t ON t.conv_id = h.conv_id AND i > h LEFT JOIN n ON n.conv_id = h.base
),
whole AS (
  SELECT conv_id, max(d) AS len, list(md5(length(role)::VARCHAR || ':' || role || text) ORDER BY d) AS seq,
    list(length(text) ORDER BY d) AS sizes
  FROM rebuilt GROUP BY conv_id
),
every AS (SELECT ids.conv_id, coalesce(len, 0) AS len, coalesce(seq, []) AS seq, coalesce(sizes, []) AS sizes
  FROM ids LEFT JOIN whole USING (conv_id)),
p AS (
  SELECT conv_id, len, d, md5(array_to_string(seq[1:d], ',')) AS k, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size,
    CASE WHEN d > 0 THEN md5(array_to_string(seq[1:d - 1], ',')) END AS above
  FROM (SELECT *, unnest(range(0, len + 1)) AS d FROM every)
),
node AS (
  SELECT d, k, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * any_value(size) AS own,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len = d), '')) AS ends_sha256
  FROM p GROUP BY d, k
),
kids AS (SELECT d - 1 AS d, above AS k, count(*) AS c FROM node WHERE d > 0 GROUP BY ALL),
full_node AS (SELECT node.*, coalesce(c, 0) AS c FROM node LEFT JOIN kids USING (d, k)),
sums AS (
  SELECT p.d, p.k, count(*) FILTER (c = 0) AS leaves, sum(own) AS saved
  FROM full_node x JOIN p ON p.conv_id = x.conv_id AND p.d <= x.d GROUP BY p.d, p.k
)
SELECT x.conv_id, x.d AS depth, up.conv_id AS parent_conv_id, x.n_convs, x.c AS n_children,
  leaves AS n_leaves, saved::BIGINT AS saved_tokens, x.ends_sha256
FROM full_node x JOIN sums USING (d, k) LEFT JOIN node up ON up.d = x.d - 1 AND up.k = x.above
"""

OP12 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP13 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) FOR x IN embedding] AS c, row_number() OVER () AS r
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
  SELECT a.r, a.vec_id AS anchor_id, o.vec_id, o.label = a.label AS same,
    CAST(list_inner_product(a.c, o.c) AS BIGINT) AS score
  FROM v a JOIN v o ON o.r <> a.r WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT r, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS p
  FROM scored WHERE same QUALIFY p <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id AS negative_id,
  positive_score, score AS negative_score
FROM positives JOIN scored USING (r)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW best AS (PARTITION BY r, p ORDER BY score DESC, vec_id)
QUALIFY rank <= 5
"""

SQL = {
    "op3_line_chunks": OP3,
    "op4_entropy_difference": OP4,
    "op5_run_length_index": OP5,
    "op7_level_doubling": OP7,
    "op8_minhash_containment": OP8,
    "op11_euler_tour": OP11,
    "op12_stateful_stream": OP12,
    "op13_shared_lists": OP13,
}


def statements() -> dict[str, str]:
    return dict(SQL)
