"""DuckDB SQL of the queries that SQL can express. The others are tested against brute-force versions (tests/llm)."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

MIXING = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text,''), '{WORD}'))::BIGINT AS size, length(coalesce(text,'')) - length(translate(coalesce(text,''), '#*$%&|<>', '')) AS symbols,
 (('0x' || substr(md5(coalesce(doc_id::VARCHAR,'')),1,13))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, ([5,2,1])[((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3)::INT + 1]::DOUBLE AS w, 2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE AS budget FROM s),
c AS (SELECT *, (budget - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * w >= cap * sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS capped FROM r WINDOW o AS (ORDER BY cap / w, encode(source) NULLS LAST)),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap ELSE (budget - coalesce(sum(cap) FILTER (capped) OVER (), 0)) / sum(w) FILTER (NOT capped) OVER () * w END AS target FROM c),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs FROM t),
k AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, floor(e.target)::BIGINT - e.epochs * e.source_size AS rest,
 coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY -ln(u) / ((d.size + 1.0::DOUBLE) / (d.size + 1.0::DOUBLE + symbols)), d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM k"""

#: A paragraph: at most eight words, closed early by the end of a sentence or a line; a section of leaves of 16 digits.
PARAGRAPH = r"(?:[^.!?\n\x20]*\x20){0,7}[^.!?\n\x20]*(?:[.!?\n]+|\x20|$)"
SECTION = "(?:[2-9a-f][0-9a-f]{15}){0,31}[0-9a-f]{16}"
FINGERPRINTS = rf"""
WITH d AS (SELECT doc_id, coalesce(text,'') AS t FROM documents),
n AS (SELECT doc_id, t, coalesce(lead(t) OVER (ORDER BY doc_id DESC), first_value(t) OVER (ORDER BY doc_id DESC)) AS nt FROM d),
e AS (SELECT doc_id, t, nt, concat(left(t, (length(t) - length(t) // 3)::INT), left(nt, (length(t) // 3)::INT)) AS x FROM n),
texts AS (SELECT t FROM d UNION SELECT x FROM e),
sections AS (SELECT t, regexp_extract_all(array_to_string(list_transform(list_filter(regexp_extract_all(t, '{PARAGRAPH}'), lambda p: p <> ''), lambda p: substr(md5(p),1,16)), ''), '{SECTION}') AS s FROM texts),
tree AS (SELECT t, substr(sha256(array_to_string(list_transform(s, lambda y: md5(y)), '')),1,32) AS root,
 list_transform(s, lambda y: concat(substr(md5(y),1,8), ':', regexp_replace(y, '([0-9a-f]{{8}})[0-9a-f]{{8}}', '\1', 'g'))) AS s,
 flatten(list_transform(s, lambda y: list_transform(regexp_extract_all(y, '[0-9a-f]{{16}}'), lambda z: substr(z,1,8)))) AS leaves FROM sections),
sides AS (SELECT doc_id, 'e' AS k, t AS a, x AS b FROM e UNION ALL SELECT doc_id, 'n', t, nt FROM e),
pairs AS (SELECT doc_id, k, p.root AS ra, q.root AS rb, p.s AS sa, q.s AS sb, p.leaves AS la, q.leaves AS lb,
 list_distinct(list_filter(p.s, lambda y: list_contains(q.s, y))) AS shared, list_filter(p.s, lambda y: NOT list_contains(q.s, y)) AS ma, list_filter(q.s, lambda y: NOT list_contains(p.s, y)) AS mb FROM sides JOIN tree p ON p.t = a JOIN tree q ON q.t = b),
parts AS (SELECT *, coalesce(list_sum(list_transform(shared, lambda y: (length(y) - 9) // 8)), 0) AS n,
 list_distinct(flatten(list_transform(ma, lambda y: regexp_extract_all(substr(y, 10), '[0-9a-f]{{8}}')))) AS da, list_distinct(flatten(list_transform(mb, lambda y: regexp_extract_all(substr(y, 10), '[0-9a-f]{{8}}')))) AS db,
 coalesce(list_position(list_transform(range(1, greatest(len(sa), len(sb)) + 1), lambda i: sa[i] IS DISTINCT FROM sb[i]), true) - 1, 0) AS same_s,
 coalesce(list_position(list_transform(range(1, greatest(len(la), len(lb)) + 1), lambda i: la[i] IS DISTINCT FROM lb[i]), true) - 1, 0) AS same_l FROM pairs),
near AS (SELECT doc_id, k, CASE WHEN ra = rb THEN 1.0::DOUBLE ELSE least(greatest(2.0::DOUBLE * (n + len(list_intersect(da, db))) / greatest(2 * n + len(da) + len(db), 1), 2.0::DOUBLE * same_l / greatest(len(la) + len(lb), 1)), 1 - 1.0::DOUBLE / greatest(len(la) + len(lb), 1)) END AS near,
 CASE WHEN ra <> rb THEN same_s END AS same_s, CASE WHEN ra <> rb THEN same_l END AS same_l FROM parts)
SELECT doc_id, length(e.t)::BIGINT AS n_chars, sha256(x) AS edited_sha256, concat(p.root, array_to_string(list_transform(p.s, lambda y: concat(' ', y)), '')) AS fingerprint, concat(q.root, array_to_string(list_transform(q.s, lambda y: concat(' ', y)), '')) AS edited_fingerprint,
 a.near AS near_edited, b.near AS near_next, a.same_s::BIGINT AS same_sections, a.same_l::BIGINT AS same_paragraphs
FROM e JOIN tree p ON p.t = e.t JOIN tree q ON q.t = e.x JOIN near a USING (doc_id) JOIN near b USING (doc_id) WHERE a.k = 'e' AND b.k = 'n'"""

WARC = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html,''))) AS n, sha1(coalesce(html,'')) AS digest FROM pages),
m AS (SELECT digest, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY digest)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest, CASE WHEN top <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN top <> page_id THEN top END AS refers_to, true AS intact
FROM p LEFT JOIN m USING (digest)"""

#: Kinds in order, with their patterns and the group of the value; runs of access, hex and bare keys are long enough by their pattern.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
SECRET_KINDS = (("assign", ASSIGN, 2), ("access", "AKIA[A-Z0-9]{12,}", 0), ("hex", "[0-9a-f]{32,}", 0), ("bare", "[A-Za-z0-9+/_.=-]{8,}", 0))
MATCHES = " UNION ALL ".join(f"SELECT k, {n} AS kind, '{name}' AS name, unnest(regexp_extract_all(t, '{p}', 0)) AS m, unnest(regexp_extract_all(t, '{p}', {g})) AS v, unnest(string_split_regex(t, '{p}')) AS g, unnest(range(len(string_split_regex(t, '{p}')))) AS i FROM u" for n, (name, p, g) in enumerate(SECRET_KINDS))

SECRETS = f"""
WITH d AS (SELECT doc_id, source, lang, coalesce(text,'') AS t, md5(coalesce(text,'')) AS k FROM documents),
u AS (SELECT DISTINCT k, t FROM d),
placed AS (SELECT k, kind, name, length(m) AS n, rtrim(v, '.=-') AS v, length(v) AS long, sum(length(g) + coalesce(length(m), 0)) OVER (PARTITION BY k, kind ORDER BY i) AS e FROM ({MATCHES})),
found AS (SELECT k, kind, name, (e - n)::BIGINT AS s, e::BIGINT AS e, v FROM placed WHERE n > 0 AND long >= 8),
held AS (SELECT v, count(DISTINCT coalesce('x' || source, '')) AS owners, count(DISTINCT (coalesce('x' || source, ''), coalesce('x' || lang, ''))) AS repos FROM found JOIN d USING (k) WHERE kind < 3 GROUP BY v),
judged AS (SELECT f.*, owners, repos, owners <= 2 AND repos <= 4 AS live FROM found f JOIN held USING (v)),
kept AS (SELECT * FROM judged j WHERE kind < 3 OR (live AND NOT EXISTS (SELECT 1 FROM found b WHERE b.k = j.k AND b.kind < 3 AND b.s < j.e AND b.e > j.s))),
spans AS (SELECT k, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
 coalesce(string_agg(concat(name,':',s,':',e), ',' ORDER BY s, kind) FILTER (kind < 3), '') AS base, string_agg(concat(name,':',s,':',e), ',' ORDER BY s, kind) AS spans,
 count(*) FILTER (live AND kind < 3) AS n_live, count(*) FILTER (NOT live) AS n_example, max(owners) FILTER (kind < 3) AS owners, max(repos) FILTER (kind < 3) AS repos FROM kept GROUP BY k)
SELECT doc_id, coalesce(n_assign,0) AS n_assign, coalesce(n_access,0) AS n_access, coalesce(n_hex,0) AS n_hex, sha256(coalesce(base,'')) AS base_sha256, coalesce(spans,'') AS spans,
 coalesce(n_live,0) AS n_live, coalesce(n_example,0) AS n_example, coalesce(owners,0) AS owners, coalesce(repos,0) AS repos FROM d LEFT JOIN spans USING (k)"""

#: Bits of the failed filters by text; the orders of the five filters; and what each step of each order does to each set of bits.
AUDIT = rf"""
WITH d AS (SELECT doc_id, coalesce(source,'') AS part, coalesce(text,'') AS t, regexp_extract_all(coalesce(text,''), '{WORD}') AS w FROM documents),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
e AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
m AS (SELECT part, coalesce(good,false) AS good, coalesce(toxic,false) AS toxic, (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
 + 4 * (100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 5 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(d.doc_id > first, false)::INT AS mask
 FROM d JOIN e USING (t) LEFT JOIN l ON l.doc_id = d.doc_id),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY part, mask),
x AS (SELECT unnest(['A','B','C','D','E']) AS f, unnest([1,2,4,8,16]) AS bit),
o AS (SELECT concat(a.f,b.f,c.f,d.f,e.f) AS filter_order, [a.bit,b.bit,c.bit,d.bit,e.bit] AS bits FROM x a, x b, x c, x d, x e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step-1]), 0)::INT AS earlier FROM o, (SELECT unnest(range(1,6)) AS step))
SELECT part, filter_order, step::INT AS step, coalesce(sum(n) FILTER (mask & (bit | earlier) = 0), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (mask & bit > 0 AND mask & earlier = 0), 0)::BIGINT AS removed,
 coalesce(sum(n) FILTER (mask & bit > 0 AND mask & earlier > 0), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
 coalesce(sum(good) FILTER (mask & bit > 0 AND mask & earlier = 0), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (mask & bit > 0 AND mask & earlier = 0), 0)::BIGINT AS toxic_lost,
 coalesce(sum(n * (120 // greatest(bit_count(mask)::INT, 1))) FILTER (mask & bit > 0), 0)::BIGINT AS shapley
FROM c, s GROUP BY part, filter_order, step"""

LINES = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text,''), chr(10)) AS l FROM documents),
x AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM x),
n AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, coalesce(keeper <> doc_id, false) AS gone FROM k LEFT JOIN n USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id"""

ORACLE_SQL: dict[str, str] = {"op2_source_mixing": MIXING, "op3_secret_scans": SECRETS, "op5_warc": WARC, "op8_fingerprints": FINGERPRINTS, "op11_filter_audit": AUDIT, "op13_line_dedup": LINES}
