"""DuckDB SQL for the operators that SQL can express, stated on its own and over whole tables."""

URL_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN url IS NULL OR position('://' IN url) = 0 THEN '' ELSE substr(url, position('://' IN url) + 3) END AS rest FROM pages
), parts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), p AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path,
         try_cast(nullif(regexp_extract(path, '/([0-9]{1,18})[^/]*/?$', 1), '') AS BIGINT) AS doc_id
  FROM parts
), rules(verdict, rule, h, pre) AS (
  VALUES ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
         ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')
), hit AS (
  SELECT page_id, host, path, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre) GROUP BY ALL
), lab AS (
  SELECT doc_id, min(CASE WHEN quality = 1 AND toxic = 0 THEN 1 WHEN quality IS NULL AND toxic = 0 OR toxic IS NULL AND quality = 1 OR quality IS NULL AND toxic IS NULL THEN NULL ELSE 0 END) AS good
  FROM labels GROUP BY doc_id
), named AS (SELECT *, regexp_replace(host, ':[0-9]*$', '') AS nm FROM p), labels_of AS (SELECT *, string_split(nm, '.') AS ls FROM named), lh AS (
  SELECT page_id, host, array_to_string(ls[-2:], '.') AS two, array_to_string(ls[-3:], '.') AS three, ls[-1] AS one, good
  FROM labels_of JOIN lab USING (doc_id) WHERE good IS NOT NULL
), keyed AS (
  SELECT host, good, CASE WHEN two IN ('co.uk','org.uk','ac.uk','com.au','co.jp','com.br','co.nz','co.za') THEN two ELSE one END AS suffix,
         CASE WHEN two IN ('co.uk','org.uk','ac.uk','com.au','co.jp','com.br','co.nz','co.za') THEN three ELSE two END AS dom FROM lh
), o AS (SELECT (coalesce(sum(good), 0) + 1) / (count(*) + 2) AS p FROM keyed),
s0 AS (SELECT suffix, count(*)::DOUBLE AS n, sum(good)::DOUBLE AS good, (SELECT p FROM o) AS prior FROM keyed GROUP BY 1),
k1 AS (SELECT sum(n * power(good / n - prior, 2)) - sum(prior * (1 - prior)) AS a, sum(n * prior * (1 - prior)) - sum(prior * (1 - prior)) AS b FROM s0),
m1 AS (SELECT CASE WHEN a IS NULL OR b = 0 OR a / b <= 0 THEN 1000.0 ELSE greatest(least(b / a - 1, 1000.0), 2.0) END AS s FROM k1),
s1 AS (SELECT suffix, (good + s * prior) / (n + s) AS rate FROM s0, m1),
d0 AS (SELECT suffix, dom, count(*)::DOUBLE AS n, sum(good)::DOUBLE AS good, any_value(rate) AS prior FROM keyed JOIN s1 USING (suffix) GROUP BY 1, 2),
k2 AS (SELECT sum(n * power(good / n - prior, 2)) - sum(prior * (1 - prior)) AS a, sum(n * prior * (1 - prior)) - sum(prior * (1 - prior)) AS b FROM d0),
m2 AS (SELECT CASE WHEN a IS NULL OR b = 0 OR a / b <= 0 THEN 1000.0 ELSE greatest(least(b / a - 1, 1000.0), 2.0) END AS s FROM k2),
d1 AS (SELECT suffix, dom, (good + s * prior) / (n + s) AS rate FROM d0, m2),
h0 AS (SELECT host, count(*)::DOUBLE AS n, sum(good)::DOUBLE AS good, any_value(rate) AS prior FROM keyed JOIN d1 USING (suffix, dom) GROUP BY 1),
k3 AS (SELECT sum(n * power(good / n - prior, 2)) - sum(prior * (1 - prior)) AS a, sum(n * prior * (1 - prior)) - sum(prior * (1 - prior)) AS b FROM h0),
m3 AS (SELECT CASE WHEN a IS NULL OR b = 0 OR a / b <= 0 THEN 1000.0 ELSE greatest(least(b / a - 1, 1000.0), 2.0) END AS s FROM k3),
h1 AS (SELECT host, (good + s * prior) / (n + s) AS rate, n + s AS size FROM h0, m3),
up AS (SELECT host, least(rate + 1.96 * sqrt(rate * (1 - rate) / (size + 1)), 1.0) AS upper FROM h1),
none AS (SELECT least(p + 1.96 * sqrt(p * (1 - p) / 3), 1.0) AS upper FROM o)
SELECT p.page_id, p.host, p.path, hit.rule AS rule,
       coalesce(hit.verdict, CASE WHEN coalesce(up.upper, none.upper) >= 0.8 THEN 'allow' ELSE 'block' END) AS verdict
FROM p LEFT JOIN (SELECT DISTINCT page_id, rule, verdict FROM hit) hit ON hit.page_id = p.page_id LEFT JOIN up ON up.host = p.host, none
"""

LINE_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), s AS (
  SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), f AS (SELECT k.*, coalesce(k.doc_id > s.owner, false) AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""

# Windows are compared as word sequences; list positions are 1-based.
SUBSTRING_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS p, w FROM d WHERE len(w) >= 13),
h AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 12], ' ')) AS k FROM x),
o AS (SELECT k, min(doc_id) AS owner FROM h GROUP BY k),
g AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS p FROM h JOIN o USING (k) WHERE owner < doc_id),
a AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
r AS (
  SELECT a.doc_id, count(*) AS n_words, count(g.p) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY a.p) FILTER (WHERE g.p IS NULL), '') AS kept
  FROM a LEFT JOIN g ON g.doc_id = a.doc_id AND g.p = a.p GROUP BY a.doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)
"""

# Windows by the word sequences themselves; an item shorter than 13 words is one window.
BENCHMARK_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS k
  FROM (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM b WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
), m AS (SELECT doc_id, p, n, item_id FROM dw JOIN bw USING (n, k)),
h AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS q FROM m) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""

TOP_K_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM (SELECT DISTINCT ON (vec_id) * FROM v WHERE vec_id % 100 = 0) q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

# Prefixes as whole lists of turns; the checksum bit by bit. Turns that tie go by the hash of role and text.
TRIE_SQL = r"""
WITH t AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) AS l
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id
), c AS (
  SELECT conv_id, l, conv_id - conv_id % 5 AS elder,
         xor(list_reduce(list_transform(range(1, len(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT),
             lambda a, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)), xor(a, b)), 4294967295), 4294967295) % 9 AS h
  FROM t
), s AS (
  SELECT c.conv_id, list_concat(coalesce(t.l, [])[1:h], c.l[h + 1:]) AS l FROM c LEFT JOIN t ON t.conv_id = c.elder
), m AS (
  SELECT conv_id, len(l) AS n, unnest(range(0, len(l) + 1)) AS d, l FROM s
), p AS (
  SELECT l[1:d] AS k, d, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d) AS ends FROM m GROUP BY ALL
), q AS (
  SELECT p.*, coalesce(n_children, 0) AS n_children, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * strlen(k[-1].t) END AS own
  FROM p LEFT JOIN (SELECT k[1:d - 1] AS k, count(*) AS n_children FROM p WHERE d > 0 GROUP BY ALL) USING (k)
), a AS (
  SELECT k[1:e] AS k, sum(own)::BIGINT AS saved_tokens, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM q) GROUP BY ALL
)
SELECT q.conv_id, q.d AS depth, u.conv_id AS parent_conv_id, q.n_convs, q.n_children, n_leaves, saved_tokens, sha256(coalesce(q.ends, '')) AS ends_sha256
FROM q JOIN a ON a.k = q.k LEFT JOIN p u ON q.d > 0 AND u.k = q.k[1:q.d - 1]
"""

# Borders from the digest of the number; the restored text is put together from the lines themselves.
MIDDLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents
), h AS (
  SELECT *, ('0x' || substr(x, 1, 8))::BIGINT % (len(u) + 1) AS b1, ('0x' || substr(x, 9, 8))::BIGINT % (len(u) + 1) AS b2,
         CASE WHEN text = '' OR text LIKE '%<P>%' OR text LIKE '%<S>%' OR text LIKE '%<M>%' OR ('0x' || substr(x, 17, 8))::BIGINT % 100 >= 100 THEN 'plain'
              WHEN ('0x' || substr(x, 25, 8))::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), s AS (
  SELECT *, array_to_string(u[1:least(b1, b2)], '') AS p, array_to_string(u[least(b1, b2) + 1:greatest(b1, b2)], '') AS m, array_to_string(u[greatest(b1, b2) + 1:], '') AS e FROM h
)
SELECT doc_id, len(u)::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || e || '<P>' || p || '<M>' || m ELSE '<P>' || p || '<S>' || e || '<M>' || m END) AS output_sha256,
       sha256(p || m || e) AS restored_sha256
FROM s
"""

ORACLE = {
    "op1_url_filters": URL_SQL,
    "op2_substring_dedup": SUBSTRING_SQL,
    "op4_line_dedup": LINE_SQL,
    "op6_benchmark_decontamination": BENCHMARK_SQL,
    "op9_pivot_top_k": TOP_K_SQL,
    "op11_conversation_trie": TRIE_SQL,
    "op13_fill_in_middle": MIDDLE_SQL,
}
