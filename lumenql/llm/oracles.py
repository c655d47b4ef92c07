"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

from math import log

from . import quality, secret_scan, url_reputation
from .queries import ARRIVALS, URL_RULES

_SPACES = r"[\x20\x09-\x0D]+"


def _secrets() -> str:
    rules = secret_scan.Rules()
    w = rules.window
    either = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    kinds = "|".join([*map(either, ("password", "passwd", "secret", "token")), f"{either('api')}_?{either('key')}"])
    assign = rf"""({kinds})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
    patterns = [(0, assign, 2, 12), (1, "AKIA[A-Z0-9]+", 0, 18), (2, "[0-9a-f]+", 0, 16), (3, f"[{secret_scan.CLASS}]+", 0, w)]
    parts = " UNION ALL ".join(f"SELECT rid, text, {k} AS kind, {least} AS least, string_split_regex(text, '{p}') AS gaps, regexp_extract_all(text, '{p}', 0) AS hits, regexp_extract_all(text, '{p}', {g}) AS vals FROM d" for k, p, g, least in patterns)
    allowed = " OR ".join(f"regexp_matches(c, '{p}')" for p in rules.allowed)
    name = "CASE kind WHEN 0 THEN 'assign' WHEN 1 THEN 'access' WHEN 2 THEN 'hex' ELSE 'entropy' END || ':' || s || ':' || e"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
raw AS ({parts}),
each_hit AS (SELECT rid, text, kind, least, gaps, hits, vals, unnest(range(1, len(hits) + 1)) AS i FROM raw),
lens AS (SELECT rid, text, kind, i, length(hits[i]) AS n, length(gaps[i]) AS g, length(vals[i]) >= least AS good FROM each_hit),
placed AS (SELECT rid, text, kind, n, good, sum(g + n) OVER (PARTITION BY rid, kind ORDER BY i) - n AS s FROM lens),
spans AS (SELECT rid, text, kind, CAST(s AS BIGINT) AS s, CAST(s + n AS BIGINT) AS e FROM placed WHERE good),
cand AS (SELECT rid, s, substr(text, s + 1, e - s) AS c FROM spans x WHERE kind = 3 AND NOT EXISTS (SELECT 1 FROM spans b WHERE b.rid = x.rid AND b.kind < 3 AND b.s <= x.s AND x.e <= b.e)),
classed AS (SELECT rid, s, c, CASE WHEN regexp_matches(c, '^([0-9a-f]+|[0-9A-F]+)$') THEN {rules.most(rules.hex_bits)} WHEN regexp_matches(c, '[a-z]') AND regexp_matches(c, '[A-Z]') THEN CASE WHEN regexp_matches(c, '^[A-Za-z0-9]+$') THEN {rules.most(rules.alnum_bits)} ELSE {rules.most(rules.base64_bits)} END WHEN regexp_matches(c, '{secret_scan.SINGLE_CASE}') AND regexp_matches(c, '{secret_scan.TWO_RUNS}') AND {secret_scan.DIGIT_EVERY} * length(regexp_replace(c, '[^0-9]', '', 'g')) >= length(c) THEN {rules.most(rules.single_bits)} ELSE -1 END AS most FROM cand WHERE regexp_matches(c, '[0-9]') AND NOT ({allowed})),
win AS (SELECT rid, s, most, unnest(range(0, length(c) - {w} + 1)) AS k, c FROM classed WHERE most >= 0),
chars AS (SELECT rid, s, most, k, substr(c, k + j, 1) AS ch FROM win, unnest(range(1, {w + 1})) AS u(j)),
counts AS (SELECT rid, s, most, k, ch, count(*) AS n FROM chars GROUP BY ALL),
sums AS (SELECT rid, s, most, k, sum(CAST(round(n * log2(n) * 1000000) AS BIGINT)) AS t FROM counts GROUP BY ALL),
hot AS (SELECT rid, 3 AS kind, s + min(k) AS s, s + max(k) + {w} AS e FROM sums WHERE t <= most GROUP BY rid, sums.s),
found AS (SELECT rid, kind, s, e FROM spans WHERE kind < 3 UNION ALL SELECT rid, kind, s, e FROM hot),
told AS (SELECT rid, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS k, count(*) FILTER (kind = 2) AS h,
 string_agg({name}, ',' ORDER BY s, kind, e) FILTER (kind < 3) AS base, string_agg({name}, ',' ORDER BY s, kind, e) AS every FROM found GROUP BY rid)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans FROM d LEFT JOIN told USING (rid)
"""


def _urls() -> str:
    p = url_reputation.Prior()
    host = r"""translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""
    path = r"""coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '')"""
    two = ", ".join(f"'{s}'" for s in url_reputation.TWO_LABEL_SUFFIXES)
    cases = [(r.name, r.verdict, f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')") for r in sorted(URL_RULES, key=lambda r: -len(r.name))]
    pick = lambda k: "CASE " + " ".join(f"WHEN {c[2]} THEN '{c[k]}'" for c in cases) + " END"
    weight = f"CASE WHEN nn > 0 AND k > 0 AND k < n THEN 1 / least(greatest((kk / nn - (k / n) * (k / n)) / ((k / n) * (1 - k / n)), {1 / (p.strongest + 1)!r}), {1 / (p.weakest + 1)!r}) - 1 ELSE 1 / {1 / (p.strongest + 1)!r} - 1 END"
    sums = "sum(n)::DOUBLE AS n, sum(k)::DOUBLE AS k, sum(n * (n - 1))::DOUBLE AS nn, sum(k * (k - 1))::DOUBLE AS kk"
    level = r"""list_aggregate(parts[greatest(len(parts) - {n} + 1, 1):], 'string_agg', '.')"""
    names = f"CASE WHEN {level.format(n=2)} IN ({two}) THEN {level.format(n=3)} ELSE {level.format(n=2)} END AS domain, CASE WHEN {level.format(n=2)} IN ({two}) THEN {level.format(n=2)} ELSE {level.format(n=1)} END AS suffix"
    return f"""
WITH p AS (SELECT page_id, {host} AS host, {path} AS path FROM pages),
o AS (SELECT host, CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END AS good FROM p JOIN labels ON page_id = doc_id WHERE host <> ''),
names AS (SELECT host, {names} FROM (SELECT DISTINCT host, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS parts FROM p)),
h AS (SELECT host, count(*)::DOUBLE AS n, sum(good)::DOUBLE AS k FROM o GROUP BY host),
d AS (SELECT domain, suffix, {sums} FROM h JOIN names USING (host) GROUP BY ALL),
s AS (SELECT suffix, {sums} FROM d GROUP BY ALL),
a AS (SELECT k / n AS mean, {weight} AS down FROM (SELECT {sums} FROM s) WHERE n > 0),
s2 AS (SELECT suffix, (k + a.down * a.mean) / (n + a.down) AS mean, {weight} AS down FROM s, a),
d2 AS (SELECT domain, (k + s2.down * s2.mean) / (n + s2.down) AS mean, {weight} AS down FROM d JOIN s2 USING (suffix)),
h2 AS (SELECT host, (k + d2.down * d2.mean) / (n + d2.down) AS mean, n + d2.down AS weight FROM h JOIN names USING (host) JOIN d2 USING (domain)),
b AS (SELECT host, m * w AS a, (1 - m) * w AS b FROM (SELECT host, coalesce(h2.mean, d2.mean, s2.mean, a.mean) AS m, coalesce(weight, d2.down, s2.down, a.down) AS w FROM names LEFT JOIN h2 USING (host) LEFT JOIN d2 USING (domain) LEFT JOIN s2 USING (suffix) LEFT JOIN a ON true) WHERE m IS NOT NULL),
-- The posterior's distribution function by the midpoint rule, over the rate or, where its density has a pole, over a power of it.
c AS (SELECT host, CASE WHEN any_value(a) <= 0 THEN 1 WHEN any_value(b) <= 0 THEN 0 ELSE sum(CASE WHEN a >= 1 THEN exp((a - 1) * ln({p.least} * u) + (b - 1) * ln(1 - {p.least} * u) + ln({p.least}) - lbeta) ELSE exp((b - 1) * ln(1 - {p.least} * pow(u, 1 / a)) + a * ln({p.least}) - ln(a) - lbeta) END) / 20000 END AS bad
 FROM (SELECT *, CASE WHEN a > 0 AND b > 0 THEN lgamma(a) + lgamma(b) - lgamma(a + b) END AS lbeta FROM b), (SELECT (range + 0.5) / 20000 AS u FROM range(20000)) GROUP BY host)
SELECT page_id, host, path, {pick(0)} AS rule, coalesce({pick(1)}, CASE WHEN host <> '' AND bad >= {p.certainty} THEN 'block' ELSE 'allow' END) AS verdict FROM p LEFT JOIN c USING (host)
"""


WARC = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS n, sha1(coalesce(html, '')) AS digest FROM pages),
k AS (SELECT digest, max(page_id) AS keeper FROM p WHERE n >= 1000 GROUP BY digest)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN keeper <> page_id THEN keeper END AS refers_to FROM p LEFT JOIN k USING (digest)
"""

#: For arrivals that stay in the lowest tier when merged: the first four make a merge, then each three more with its result.
#: Each arrival and each merge commits a version.
SHARDS = f"""
WITH d AS (SELECT doc_id, text, CAST(((doc_id % {ARRIVALS}) + {ARRIVALS}) % {ARRIVALS} AS INTEGER) AS arrival FROM documents),
a AS (SELECT arrival, row_number() OVER (ORDER BY arrival) AS p, count(*) OVER () AS n FROM (SELECT DISTINCT arrival FROM d))
SELECT doc_id, arrival, octet_length(encode(text))::BIGINT AS n_bytes, sha256(text) AS text_sha256, CAST(CASE WHEN p <= (n - 1) // 3 * 3 + 1 THEN (n - 1) // 3 ELSE 0 END AS INTEGER) AS n_merges, CAST(n + (n - 1) // 3 AS INTEGER) AS version FROM d JOIN a USING (arrival)
"""


def _quality() -> str:
    risk = quality.Risk()
    levels = risk.levels()
    ks = ", ".join(f"count(*) FILTER ({' OR '.join(f'{r} > {c}' for r, c in cuts.items())}) AS k{i}" for i, cuts in enumerate(levels))
    a = risk.rejected
    tail = lambda k: f"(SELECT sum(exp(lgamma(n + 1) - CASE WHEN j > 0 THEN lgamma(j + 1) ELSE 0 END - CASE WHEN n > j THEN lgamma(n - j + 1) ELSE 0 END + j * {log(a)!r} + (n - j) * {log(1 - a)!r})) FROM unnest(range(0, {k} + 1)) AS u(j))"
    level = f"greatest({', '.join(f'CASE WHEN {tail(f'k{i}')} <= {risk.error!r} / strata THEN {i} END' for i in range(len(levels)))})"
    cuts = ", ".join(f"[{', '.join(map(str, grid))}][level + 1] AS cut_{r}" for r, grid in risk.grids.items())
    above = " OR ".join(f"coalesce({r} > cut_{r}, false)" for r in risk.grids)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents),
t AS (SELECT rid, doc_id, stratum, text, list_filter(string_split_regex(text, '{_SPACES}'), lambda x: x <> '') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
win AS (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS g FROM t, unnest(range(1, len(w) - 3)) AS u(i)),
twice AS (SELECT rid, i FROM win JOIN (SELECT rid, g FROM win GROUP BY rid, g HAVING count(*) > 1) USING (rid, g)),
cover AS (SELECT rid, count(DISTINCT i + j) AS n FROM twice, unnest(range(0, 5)) AS u(j) GROUP BY rid),
m AS (SELECT doc_id, stratum, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
 length(text) - length(replace(text, '!', '')) AS n_marks, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(cover.n, 0) AS n_repeat_words FROM t LEFT JOIN cover USING (rid)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, 1000 * n_symbols // greatest(word_chars, 1) AS m_symbols, 1000 * n_dup_lines // greatest(n_lines, 1) AS m_lines, 1000 * n_repeat_words // greatest(n_words, 1) AS m_repeat, 1000 * n_marks // greatest(word_chars, 1) AS m_marks FROM m),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1),
c AS (SELECT stratum, count(*) AS n, {ks} FROM f JOIN good USING (doc_id) WHERE NOT base_failed GROUP BY stratum),
cut AS (SELECT stratum, {cuts} FROM (SELECT stratum, {level} AS level FROM c, (SELECT greatest(count(*), 1) AS strata FROM c)))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND NOT ({above}) AS kept FROM f LEFT JOIN cut USING (stratum)
"""


ORACLES = {"op2_secrets": _secrets(), "op3_shards": SHARDS, "op4_urls": _urls(), "op5_warc": WARC, "op9_quality": _quality()}
