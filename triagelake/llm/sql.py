"""SQL counterparts of the registered queries that SQL can express. Values are stated here anew, not imported."""

from __future__ import annotations

SQL: dict[str, str] = {}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SQL["op6_url_rules"] = r"""
WITH rules(v, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
b AS (SELECT *, (SELECT arg_max({'r': h || p, 'v': v}, length(h || p)) FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best FROM u)
SELECT page_id, host, path, best.r AS rule, coalesce(best.v, 'allow') AS verdict FROM b"""

_FENCES = """
m_{name} AS (SELECT {keys} metric, bucket, sum(n) AS n FROM sketch GROUP BY ALL),
r_{name} AS (SELECT *, sum(n) OVER (PARTITION BY {keys} metric) AS total, sum(n) OVER (PARTITION BY {keys} metric ORDER BY bucket) AS upto FROM m_{name}),
q_{name} AS (SELECT {keys} metric, max(total) AS size, min(bucket) FILTER (upto * 100 >= total * 25) AS q25, min(bucket) FILTER (upto * 100 >= total * 50) AS q50,
  min(bucket) FILTER (upto * 100 >= total * 75) AS q75 FROM r_{name} GROUP BY ALL),
f_{name} AS (SELECT {keys} max(size) AS size, max(greatest(q50 + 8 * (q75 - q50), 300)) FILTER (metric = 'symbols') AS hi_symbols,
  max(greatest(q50 + 8 * (q75 - q50), 300)) FILTER (metric = 'dup_lines') AS hi_dup_lines, max(greatest(q50 + 8 * (q75 - q50), 300)) FILTER (metric = 'repeats') AS hi_repeats,
  max(greatest(q50 + 8 * (q75 - q50), 1500)) FILTER (metric = 'word_length') AS hi_word_length, max(least(q50 - 8 * (q50 - q25), 200)) FILTER (metric = 'word_length') AS lo_word_length
  FROM q_{name} {group})"""
_PICK = "CASE WHEN a.size >= 200 THEN a.{c} WHEN b.size >= 200 THEN b.{c} ELSE c.{c} END AS {c}"

SQL["op10_adaptive_quality"] = rf"""
WITH d AS (SELECT row_number() OVER () AS i, doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
t AS (SELECT i, unnest(range(1, len(w) - 1)) AS p, w FROM d WHERE len(w) >= 3),
k AS (SELECT i, p, count(*) OVER (PARTITION BY i, w[p], w[p + 1], w[p + 2]) AS n FROM t),
rep AS (SELECT i, count(DISTINCT p + o) AS n_repeat_words FROM k, range(0, 3) r(o) WHERE n > 1 GROUP BY i),
l AS (SELECT i, unnest(string_split(text, chr(10))) AS line FROM d),
lines AS (SELECT i, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY i),
c AS (SELECT doc_id, lang, source, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, n_lines
  FROM d LEFT JOIN rep USING (i) LEFT JOIN lines USING (i)),
v AS (SELECT *, n_symbols * 1000 // n_words AS symbols, n_dup_lines * 1000 // n_lines AS dup_lines, n_repeat_words * 1000 // n_words AS repeats, word_chars * 100 // n_words AS word_length FROM c),
x AS (SELECT lang, source, unnest([{{'m': 'symbols', 'v': symbols}}, {{'m': 'dup_lines', 'v': dup_lines}}, {{'m': 'repeats', 'v': repeats}}, {{'m': 'word_length', 'v': word_length}}]) AS s FROM v WHERE n_words > 0),
sketch AS (SELECT lang, source, s.m AS metric, (s.v >> greatest(length(bin(s.v)) - 6, 0)) << greatest(length(bin(s.v)) - 6, 0) AS bucket, count(*) AS n FROM x GROUP BY ALL),
{_FENCES.format(name='own', keys='lang, source,', group='GROUP BY lang, source')},
{_FENCES.format(name='lang', keys='lang,', group='GROUP BY lang')},
{_FENCES.format(name='every', keys='', group='')},
lim AS (SELECT a.lang, a.source, {', '.join(_PICK.format(c=c) for c in ('hi_symbols', 'hi_dup_lines', 'hi_repeats', 'hi_word_length', 'lo_word_length'))}
  FROM f_own a JOIN f_lang b ON a.lang IS NOT DISTINCT FROM b.lang CROSS JOIN f_every c),
j AS (SELECT v.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  symbols <= hi_symbols AND dup_lines <= hi_dup_lines AND repeats <= hi_repeats AND word_length <= hi_word_length AND word_length >= lo_word_length AS inside
  FROM v LEFT JOIN lim ON v.lang IS NOT DISTINCT FROM lim.lang AND v.source IS NOT DISTINCT FROM lim.source)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, n_dup_lines, n_repeat_words, base_failed,
  CASE WHEN base_failed THEN false ELSE inside END AS kept FROM j"""

SQL["op8_weighted_mix"] = rf"""
WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, length(coalesce(text, '')) AS n, length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>!]', '', 'g')) AS junk,
  md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS tie FROM documents),
k AS (SELECT *, -ln((CAST(('0x' || substring(tie, 1, 13)) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
  / (CASE WHEN n > 0 THEN greatest(ceil((n - junk) * 20 / n), 1) ELSE 1 END / 20.0::DOUBLE) AS draw FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, ([3.0::DOUBLE, 1.0, 2.0])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM k GROUP BY source),
f AS (SELECT *, 2 * source_size::DOUBLE AS cap, 2 * source_size::DOUBLE / w AS ratio, 1.5::DOUBLE * sum(source_size) OVER () AS total, sum(w) OVER () AS all_w FROM s),
g AS (SELECT *, (total - coalesce(sum(cap) OVER before, 0)) / (all_w - coalesce(sum(w) OVER before, 0)) AS level, row_number() OVER (ORDER BY ratio, source NULLS LAST) AS place FROM f
  WINDOW before AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
h AS (SELECT *, coalesce(least(cap, (SELECT arg_min(level, place) FROM g WHERE level < ratio) * w), cap) AS target FROM g),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM h),
o AS (SELECT doc_id, size, source_size, target, epochs, CAST(round(target - epochs * source_size) AS BIGINT) AS rest,
  coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY draw, tie, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k JOIN p ON k.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(least(rest - before, size), 0) AS BIGINT) AS taken FROM o"""

SQL["op3_group_join"] = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS i, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT i, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p, w FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT i, array_to_string(w[p:p + 4], ' ') AS g FROM p),
n AS (SELECT i, count(*) AS n FROM s GROUP BY i),
m AS (SELECT a.i AS a, b.i AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.i < b.i GROUP BY ALL),
k AS (SELECT a, b FROM m JOIN n x ON x.i = a JOIN n y ON y.i = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM k UNION ALL SELECT b, a FROM k),
r AS (SELECT i, i AS j FROM d UNION SELECT r.i, e.b FROM r JOIN e ON e.a = r.j)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(o.doc_id) AS component_id FROM d LEFT JOIN n USING (i) JOIN r ON r.i = d.i JOIN d o ON o.i = r.j GROUP BY d.i, d.doc_id"""

SQL["op7_suffix_merge"] = """
WITH d AS (SELECT row_number() OVER () AS i, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT i, unnest(range(0, len(x) // 2 - 199)) AS p FROM d WHERE len(x) >= 400),
h AS (SELECT w.i, p, md5(substring(x, 2 * p + 1, 400)) AS k FROM w JOIN d USING (i)),
u AS (SELECT i, p, count(*) OVER (PARTITION BY k) AS c FROM h),
g AS (SELECT i, p, CASE WHEN p - lag(p) OVER (PARTITION BY i ORDER BY p) <= 200 THEN 0 ELSE 1 END AS new FROM u WHERE c > 1),
b AS (SELECT i, p, sum(new) OVER (PARTITION BY i ORDER BY p) AS span FROM g),
s AS (SELECT i, span, min(p) AS a, max(p) + 200 AS z FROM b GROUP BY ALL),
q AS (SELECT i, a, z, lag(z, 1, 0) OVER (PARTITION BY i ORDER BY a) AS last FROM s),
t AS (SELECT i, count(*) AS n_spans, CAST(sum(z - a) AS BIGINT) AS n_removed, max(z) AS tail, string_agg(substring(d.x, 2 * last + 1, 2 * (a - last)), '' ORDER BY a) AS kept FROM q JOIN d USING (i) GROUP BY i)
SELECT doc_id, len(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substring(x, 2 * coalesce(tail, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN t USING (i)"""

SQL["op1_legacy_archive"] = """
WITH p AS (SELECT row_number() OVER () AS i, page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT i, page_id, payload_bytes, list_transform([1, 11, 21, 31], lambda s: ('0x' || substring(h, s, 10))::BIGINT) AS parts FROM p),
d AS (SELECT i, page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda j: substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((parts[j // 8 + 1] >> (35 - 5 * (j % 8))) & 31) + 1 AS INTEGER), 1)), '') AS payload_digest FROM b),
r AS (SELECT *, row_number() OVER w AS n, first_value(page_id) OVER w AS low FROM d WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, i))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN n = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN n > 1 THEN low END AS refers_to FROM r"""

_TEMPLATES = """('mit', 'released under the mit license', 'mit license', 3), ('mit', 'permission is hereby granted free of charge to any person obtaining a copy of this software', 'hereby granted free of charge', 2),
  ('apache', 'licensed under the apache license version 2 0', 'apache license', 3), ('gpl', 'licensed under the gnu general public license version 3', 'general public license', 4),
  ('lgpl', 'licensed under the gnu lesser general public license', 'lesser general public license', 4), ('agpl', 'licensed under the gnu affero general public license', 'affero general public license', 4),
  ('mpl', 'subject to the terms of the mozilla public license', 'mozilla public license', 6), ('bsd', 'redistribution and use in source and binary forms with or without modification are permitted', 'redistribution and use in source and binary forms', 0),
  ('bsd', 'released under the bsd license', 'bsd license', 3), ('isc', 'permission to use copy modify and or distribute this software for any purpose', 'distribute this software for any purpose', 7),
  ('unlicense', 'free and unencumbered software released into the public domain', 'unencumbered software', 2), ('cc-by', 'licensed under cc by 4 0', 'cc by 4', 2), ('cc-by-sa', 'licensed under cc by sa 4 0', 'cc by sa', 2),
  ('cc-by-nc', 'licensed under cc by nc 4 0', 'cc by nc', 2), ('cc-by-nd', 'licensed under cc by nd 4 0', 'cc by nd', 2)"""

#: Tries every place of every template's phrase: equal while a text holds no more different licence words than are looked up.
SQL["op5_license_scan"] = rf"""
WITH d AS (SELECT row_number() OVER () AS i, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
x AS (SELECT i, w, unnest(range(1, len(w) + 1)) AS p FROM d WHERE list_has_any(w, ['license', 'hereby', 'redistribution', 'unencumbered', 'distribute', 'cc'])),
b AS (SELECT i, p - 2 AS start, w[p - 1] AS label FROM x WHERE w[p] = 'license' AND p > 1 AND w[p - 1] IN ('mit', 'apache')
  UNION ALL SELECT i, p - 3, 'gpl' FROM x WHERE w[p] = 'license' AND p > 2 AND w[p - 1] = 'public' AND w[p - 2] = 'general'),
t(label, words, phrase, place) AS (SELECT c0, string_split(c1, ' '), string_split(c2, ' '), c3 FROM (VALUES {_TEMPLATES}) v(c0, c1, c2, c3)),
f AS (SELECT i, label, len(list_filter(range(1, len(words) + 1), lambda j: p - place + j - 1 > 0 AND w[p - place + j - 1] = words[j])) / len(words) AS score
  FROM x JOIN t ON x.w[p] = phrase[1] AND x.w[p:p + len(phrase) - 1] = phrase),
m AS (SELECT * FROM f WHERE score >= 0.5),
bb AS (SELECT i, count(*) AS n, min(start) AS lo, max(start) AS hi, list(DISTINCT label) AS l FROM b GROUP BY i),
mm AS (SELECT i, max(score) AS score, list(DISTINCT label) AS l FROM m GROUP BY i)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(bb.n, 0) AS n_base, CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word, array_to_string(list_sort(coalesce(bb.l, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(bb.l, []), coalesce(mm.l, [])))), ',') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN bb USING (i) LEFT JOIN mm USING (i)"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SQL["op11_lexical_rank"] = rf"""
WITH d AS (SELECT row_number() OVER () AS i, doc_id, {_TERMS} AS w FROM documents),
c AS (SELECT i, doc_id, CAST(len(w) AS BIGINT) AS n, w FROM d WHERE len(w) > 0),
s AS (SELECT count(*) AS total, CAST(sum(n) AS BIGINT) AS words FROM c),
p AS (SELECT i, t, count(*) AS tf FROM (SELECT i, unnest(w) AS t FROM c) GROUP BY ALL),
f AS (SELECT t, count(*) AS df FROM p GROUP BY t),
q AS (SELECT row_number() OVER () AS j, item_id, {_TERMS} AS w FROM benchmark),
k AS (SELECT j, t, count(*) AS often FROM (SELECT j, unnest(w) AS t FROM q) GROUP BY ALL),
g AS (SELECT j, t, often, CAST(floor(1000 * ln((2 * total + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS weight FROM k JOIN f USING (t), s),
v AS (SELECT j, i, CAST(sum(often * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * total) // words)))) AS BIGINT) AS score
  FROM g JOIN p USING (t) JOIN c USING (i), s GROUP BY ALL),
r AS (SELECT j, doc_id, score, row_number() OVER (PARTITION BY j ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM v JOIN c USING (i) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r JOIN q USING (j) WHERE rank <= 20"""

SQL["op12_residue_negatives"] = """
WITH e AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.*, vec_id AS negative_id, score AS negative_score, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5"""
