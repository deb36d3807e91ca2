"""DuckDB SQL of the queries that SQL can express: the same results by plain means."""

_SPACE = r"[\x20\x09-\x0D]"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({text}, ''), '{_SPACE}+'), lambda w: w <> '')"


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD_JOIN = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_words(_LOWER.format('text'))} AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
k AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT k.a, k.b FROM k JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * n_both >= 80 * (x.n + y.n - n_both)),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON c.a = d.doc_id
"""

#: (measure, numerator, denominator, least quartile distance, low values rejected too)
_MEASURES = [("word_length", "word_chars", "n_words", 500, True), ("symbols", "n_symbols", "n_words", 30, False),
             ("dup_lines", "n_dup_lines", "n_lines", 120, False), ("repeats", "n_repeat_words", "n_words", 120, False),
             ("capitals", "n_capitals", "word_chars", 80, False)]

QUALITY_RULES = f"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, {_words('text')} AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) AS g FROM w WHERE len(w) >= 3),
d AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM d) GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM w),
b AS (
  SELECT w.doc_id, lang, source, len(w) AS n_words, length(regexp_replace(t, '{_SPACE}+', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_capitals,
    len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM w JOIN l USING (doc_id) LEFT JOIN rep USING (doc_id)),
m AS ({" UNION ALL ".join(f"SELECT doc_id, lang, source, '{m}' AS m, {s} AS least, {str(both).lower()} AS low_too, 1000 * {a} // greatest({n}, 1) AS v FROM b WHERE n_words > 0" for m, a, n, s, both in _MEASURES)}),
h AS (SELECT *, CASE WHEN v < 2048 THEN v ELSE (v >> (length(bin(v)) - 11)) << (length(bin(v)) - 11) END AS bin FROM m),
c AS (SELECT lang, source, m, bin, sum(count(*)) OVER (PARTITION BY lang, source, m ORDER BY bin) AS upto,
        sum(count(*)) OVER (PARTITION BY lang, source, m) AS total FROM h GROUP BY lang, source, m, bin),
q AS (SELECT lang, source, m, min(bin) FILTER (upto * 4 >= total) AS q1, min(bin) FILTER (upto * 4 >= total * 3) AS q3 FROM c GROUP BY ALL),
x AS (
  SELECT DISTINCT h.doc_id FROM h JOIN q ON h.lang IS NOT DISTINCT FROM q.lang AND h.source IS NOT DISTINCT FROM q.source AND h.m = q.m
  WHERE v > q3 + 3 * greatest(q3 - q1, least) OR (low_too AND v < q1 - 3 * greatest(q3 - q1, least))),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM x) AS kept
FROM f
"""

_HOST = "regexp_extract(regexp_extract({0}, '(?s)^.*?://[^/?#]*'), '://([^/?#]*)$', 1)"
_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
_TAGS = ("regexp_extract_all(html, '(?is)<link\\b[^>]*\\brel\\s*=\\s*[\"'']?canonical\\b[^>]*>')", "regexp_extract_all(html, '(?is)<meta\\b[^>]*\\bhttp-equiv\\s*=\\s*[\"'']?refresh\\b[^>]*>')")
_TARGET = "regexp_replace(regexp_extract(tag, '(?is)\\b{0}\\s*=\\s*[\"'']?([^\"''\\s>]+)', 1), '(?i)&(?:amp|#0*38|#x0*26);', '&', 'g')"
_DOTS = [f"'{p}(/|$)'" for p in (r"/\.", r"^/\.\.", r"/[^/]*/\.\.")]

URL_FILTER = f"""
WITH RECURSIVE t AS (SELECT url, {_TARGET.format('href')} AS t FROM (SELECT url, unnest({_TAGS[0]}) AS tag FROM pages)
      UNION SELECT url, {_TARGET.format('url')} FROM (SELECT url, unnest({_TAGS[1]}) AS tag FROM pages)),
o AS (SELECT url, t AS link, regexp_replace(t, '(?s)#.*', '') AS t, regexp_extract(url, '(?s)^.*?://[^/?#]*') AS origin, regexp_extract(url, '(?s)^.*?://[^?#]*') AS page
      FROM t WHERE t <> '' AND contains(url, '://')),
p AS (SELECT *, regexp_extract(substr(page, length(origin) + 1), '(?s)^.*/') AS folder, regexp_extract(t, '(?s)^[^?]*') AS path FROM o),
d AS (SELECT url, link, CASE WHEN starts_with(path, '/') THEN path WHEN folder = '' THEN '/' || path ELSE folder || path END AS path FROM p
      UNION SELECT url, link, CASE {" ".join(f"WHEN regexp_matches(path, {x}) THEN regexp_replace(path, {x}, '/')" for x in _DOTS)} END
      FROM d WHERE {" OR ".join(f"regexp_matches(path, {x})" for x in _DOTS)}),
k AS (SELECT p.url, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
        WHEN starts_with(t, '//') THEN regexp_extract(p.url, '(?s)^(.*?)://', 1) || ':' || t WHEN t = '' THEN regexp_replace(p.url, '(?s)#.*', '')
        WHEN starts_with(t, '?') THEN page || t ELSE origin || d.path || substr(t, length(p.path) + 1) END AS "to"
      FROM p JOIN d ON d.url = p.url AND d.link = p.link WHERE {" AND ".join(f"NOT regexp_matches(d.path, {x})" for x in _DOTS)}),
u AS (SELECT DISTINCT url FROM pages UNION SELECT "to" FROM k),
h AS (SELECT url, coalesce({_LOWER.format(_HOST.format('url'))}, '') AS host,
        coalesce(regexp_extract(regexp_extract(url, '(?s)^.*?://[^?#]*'), '://[^/?#]*([^?#]*)$', 1), '') AS path,
        regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS rest FROM u),
rules(verdict, rh, rp) AS (VALUES {", ".join(f"('{v}', '{a}', '{b}')" for v, a, b in _RULES)}),
j AS (SELECT h.*, CASE WHEN contains(url, '://') THEN host || ' ' || rest END AS node, best.rule, best.verdict FROM h LEFT JOIN (
        SELECT x.url AS at, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rules.verdict, length(rh || rp)) AS verdict FROM h x JOIN rules
          ON (x.host = rh OR suffix(x.host, '.' || rh)) AND starts_with(x.path, rp) GROUP BY x.url) best ON best.at = h.url),
e AS (SELECT x.node AS a, y.node AS b FROM k JOIN j x ON x.url = k.url JOIN j y ON y.url = k."to" WHERE x.node IS NOT NULL AND y.node IS NOT NULL),
s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(a, b) AS (SELECT a, a FROM s UNION SELECT r.a, s.b FROM r JOIN s ON r.b = s.a),
v AS (SELECT r.a AS node, bool_or(j.verdict = 'block') AND NOT bool_or(j.verdict = 'allow') AS blocked FROM r JOIN j ON j.node = r.b WHERE j.verdict IS NOT NULL GROUP BY r.a)
SELECT p.page_id, coalesce(j.host, '') AS host, coalesce(j.path, '') AS path, j.rule,
  coalesce(j.verdict, CASE WHEN v.blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM pages p LEFT JOIN j ON j.url = p.url LEFT JOIN v ON v.node = j.node
"""

#: The registered query's notices (fixed values).
_NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-grant", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
]
_TOKENS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"

LICENSE_SCAN = f"""
WITH t(template, text) AS (VALUES {", ".join(f"('{a}', '{b}')" for a, b in _NOTICES)}),
tw AS (SELECT template, {_TOKENS} AS w FROM t),
ts AS (SELECT DISTINCT template, CAST(2 ** ceil(log2(len(w))) AS BIGINT) AS l,
         unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS s FROM tw),
n AS (SELECT template, count(*) AS n FROM ts GROUP BY template),
w AS (SELECT doc_id, {_TOKENS} AS w FROM documents),
ds AS (SELECT doc_id, unnest(range(0, len(w) - 2)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS s
       FROM w WHERE len(w) >= 3),
h AS (SELECT doc_id, template, l, s, unnest(CASE WHEN i < l THEN [0] ELSE [i // l - 1, i // l] END) AS k FROM ds JOIN ts USING (s)),
c AS (SELECT doc_id, h.template, l * k AS place, count(DISTINCT s) / n.n AS containment FROM h JOIN n ON n.template = h.template
      GROUP BY doc_id, h.template, l, k, n.n),
b AS (SELECT doc_id, template, max(containment) AS containment FROM c WHERE containment >= 0.8 GROUP BY doc_id, template)
SELECT b.doc_id, b.template, b.containment, min(c.place) AS place
FROM b JOIN c ON c.doc_id = b.doc_id AND c.template = b.template AND c.containment = b.containment GROUP BY ALL
"""

_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

IMPORTANCE_RESAMPLING = f"""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}')) AS w FROM documents),
bw AS (SELECT unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}')) AS w FROM benchmark),
crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
d AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM w UNION SELECT w FROM bw)),
k AS (SELECT w, xor(list_reduce(list_transform(range(0, strlen(w)), lambda i: CAST('0x' || substr(x, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS b FROM d, crc),
s AS (SELECT b, count(*) AS s FROM w JOIN k USING (w) GROUP BY b), t AS (SELECT b, count(*) AS t FROM bw JOIN k USING (w) GROUP BY b),
n AS (SELECT (SELECT count(*) FROM w) AS s_all, (SELECT count(*) FROM bw) AS t_all),
g AS (SELECT b, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * (s_all + 10000) / (CAST(s + 1 AS DOUBLE) * (t_all + 10000)))) AS BIGINT) AS g
      FROM s LEFT JOIN t USING (b), n),
x AS (SELECT doc_id, count(*) AS n_features, CAST(sum(g) AS BIGINT) AS total FROM w JOIN k USING (w) JOIN g USING (b) GROUP BY doc_id),
y AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, CAST(coalesce(floor(total / n_features), 0) AS BIGINT) AS weight,
        CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h FROM documents LEFT JOIN x USING (doc_id)),
z AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM y),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM z WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM z LEFT JOIN r USING (doc_id)
"""

COLLOCATIONS = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM p),
o AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
      FROM w, (SELECT unnest([1, 2, 3]) AS m) WHERE len(w) >= m),
f AS (SELECT lang, m, phrase, count(*) AS f FROM o GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 10),
k AS (SELECT c.*, unnest(range(1, m)) AS k FROM c),
s AS (SELECT k.lang, k.phrase, a, k, x.f AS l, y.f AS r, CAST(1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f) AS BIGINT) AS score FROM k
      JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(w[1:k], ' ') JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(w[k + 1:k.m], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a AS longer FROM c WHERE m = 3),
d AS (SELECT lang, phrase, max(longer) AS longer FROM i GROUP BY ALL),
r AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
      FROM b LEFT JOIN d ON d.lang = b.lang AND d.phrase = b.phrase WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM r JOIN n USING (lang) WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op5_license_scan": LICENSE_SCAN,
    "op8_url_filter": URL_FILTER,
    "op9_jaccard_join": JACCARD_JOIN,
    "op10_quality_rules": QUALITY_RULES,
    "op12_collocations": COLLOCATIONS,
    "op13_importance_resampling": IMPORTANCE_RESAMPLING,
}
