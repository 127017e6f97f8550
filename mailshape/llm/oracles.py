"""DuckDB SQL for the queries of the subpackage that SQL can express."""

from __future__ import annotations

QUALITY = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT r, i, hash(list_slice(w, i, i + 4)) AS h
        FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, h) AS n FROM win) WHERE n > 1),
cov AS (SELECT r, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS n FROM
        (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM rep) GROUP BY r),
c AS (SELECT w.doc_id, w.source, len(w.w)::BIGINT AS n_words,
             length(array_to_string(w.w, ''))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(cov.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN cov USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c),
h AS (SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS f FROM b GROUP BY source),
m AS (SELECT sum(n) AS n, count(*)::DOUBLE AS k, sum(f) / sum(n) AS mean, sum(f * f / n) / sum(n) AS q FROM h),
s AS (SELECT *, mean * (1 - mean) AS noise FROM m),
p AS (SELECT *, greatest(noise / greatest(greatest(0, q - mean * mean) - noise * k / n, noise / (n + 1)) - 1, 0.001) AS g FROM s),
a AS (SELECT CASE WHEN noise = 0 THEN mean * n + 1 ELSE mean * g END AS a,
             CASE WHEN noise = 0 THEN (1 - mean) * n + 1 ELSE (1 - mean) * g END AS b FROM p),
v AS (SELECT h.source, (h.f + a.a) / (h.n + a.a + a.b) AS host_rate FROM h CROSS JOIN a)
SELECT b.*, round(v.host_rate, 6) AS host_rate, v.host_rate > 0.5 AS host_failed, NOT b.base_failed AND NOT v.host_rate > 0.5 AS kept
FROM b JOIN v ON b.source IS NOT DISTINCT FROM v.source
"""

URLS = r"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(h, x, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
k AS (SELECT *, regexp_replace(host, '^(www|m)\.', '') || ' =' || regexp_replace(path, '(/|\.html?)$', '') AS key FROM p),
l AS (SELECT DISTINCT key FROM k WHERE regexp_matches(host, 'ads|adult|bets|casino|pills|spam')),
j AS (SELECT k.page_id, k.host, k.path, k.key, r.h || r.x AS rule, r.verdict,
             row_number() OVER (PARTITION BY k.page_id, k.host, k.path ORDER BY length(r.h || r.x) DESC NULLS LAST) AS o
      FROM k LEFT JOIN r ON (k.host = r.h OR ends_with(k.host, '.' || r.h)) AND starts_with(k.path, r.x))
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN l.key IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       l.key IS NOT NULL AS listed
FROM j LEFT JOIN l USING (key) WHERE o = 1
"""

REVISITS = r"""
WITH u AS (SELECT page_id, '"' || substr(md5(html), 1, 12) || '"' AS tag, length(html) AS size, url,
                  regexp_replace(substr(url, instr(url, '://') + 3), '#.*$', '') AS rest FROM pages),
p AS (SELECT *, regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^www\.|:(80|443)$', '', 'g')
             || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '(/|\.html?)$', '') AS head,
             array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
               lambda f: f <> '' AND NOT regexp_matches(f, '^(utm_[a-z]+|ref|fbclid|gclid)='))), '&') AS q FROM u),
k AS (SELECT *, head || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS key FROM p),
f AS (SELECT key, 2 * page_id AS id, 2 * page_id AS t, tag, size FROM k),
r AS (SELECT key, 2 * page_id + 1 AS id, 2 * page_id + 1 + 2 * (37 * page_id % 100) AS t, tag FROM k),
j AS (SELECT r.*, f.id AS fid, f.t AS ft, f.tag AS ftag, f.size,
             row_number() OVER (PARTITION BY r.id ORDER BY f.t DESC NULLS LAST, f.id DESC) AS o
      FROM r LEFT JOIN f ON r.key = f.key AND (f.t, f.id) < (r.t, r.id))
SELECT id AS record_id, key AS url_key, t AS time, fid AS response_id, ft AS response_time,
       CASE WHEN fid IS NULL THEN 'no_response' WHEN tag = ftag THEN 'resolved' ELSE 'changed' END AS verdict,
       CASE WHEN tag = ftag THEN 'cache-control: max-age=60' || chr(10) || 'content-length: ' || size || chr(10) ||
              'content-type: text/html' || chr(10) || 'date: ' || t || chr(10) || 'etag: W/' || tag
            ELSE 'cache-control: max-age=60' || chr(10) || 'content-length: 0' || chr(10) || 'date: ' || t || chr(10) ||
              'etag: W/' || tag END AS headers
FROM j WHERE o = 1
"""

# Tree levels written out: 3^24 leaves per source, and sources, at most.
_HEIGHT = 24


def _manifest() -> str:
    """Leaves, crc32 from its table (built by rule from the reflected polynomial 0xEDB88320), levels
    per source and over sources, then every leaf's walk up both trees gathering siblings and folding."""
    field = lambda v: f"coalesce(strlen({v}) || ':' || {v}, '-')"
    ctes = [r"""tab(b, c, k) AS (
    SELECT b::UBIGINT, b::UBIGINT, 0 FROM range(256) t(b)
    UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1
    FROM tab WHERE k < 8),
crct AS (SELECT b, c FROM tab WHERE k = 8),
ids AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS s FROM documents WHERE doc_id IS NOT NULL),
cr(s, pos, c) AS (
    SELECT s, 0, 4294967295::UBIGINT FROM ids
    UNION ALL SELECT cr.s, pos + 1, xor(crct.c, cr.c >> 8) FROM cr JOIN crct
    ON crct.b = (xor(cr.c, ascii(substr(cr.s, pos + 1, 1))::UBIGINT) & 255::UBIGINT) WHERE pos < length(cr.s)),
crc AS (SELECT s, xor(c, 4294967295::UBIGINT) AS crc FROM cr WHERE pos = length(s))""",
            f"""f AS (
    SELECT doc_id, source, {field('CAST(doc_id AS VARCHAR)')} || {field('source')} || {field('lang')}
               || {field('CAST(n_chars AS VARCHAR)')} AS head, text,
           CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS ttext
    FROM documents LEFT JOIN crc ON crc.s = CAST(doc_id AS VARCHAR))""",
            f"""lf AS (SELECT doc_id, source, sha256(head || {field('text')}) AS leaf,
           sha256(head || {field('ttext')}) AS tleaf FROM f)""",
            """L0 AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1
           AS idx, leaf AS h, count(*) OVER (PARTITION BY source) AS cnt, doc_id, leaf, tleaf FROM lf)"""]
    for k in range(_HEIGHT):
        ctes.append(f"""G{k} AS (SELECT source, idx // 3 AS grp, string_agg(h, '' ORDER BY idx) AS cat, any_value(cnt) AS cnt
    FROM L{k} WHERE cnt > 1 GROUP BY source, idx // 3),
L{k + 1} AS (SELECT source, grp AS idx, sha256(cat) AS h, (cnt + 2) // 3 AS cnt FROM G{k})""")
    tops = " UNION ALL ".join(f"SELECT source, h FROM L{k} WHERE cnt = 1" for k in range(_HEIGHT + 1))
    ctes.append(f"""S AS ({tops}),
T0 AS (SELECT 0 AS source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, h,
           count(*) OVER () AS cnt, source AS of FROM S)""")
    for k in range(_HEIGHT):
        ctes.append(f"""TG{k} AS (SELECT source, idx // 3 AS grp, string_agg(h, '' ORDER BY idx) AS cat, any_value(cnt) AS cnt
    FROM T{k} WHERE cnt > 1 GROUP BY source, idx // 3),
T{k + 1} AS (SELECT source, grp AS idx, sha256(cat) AS h, (cnt + 2) // 3 AS cnt FROM TG{k})""")
    root = " UNION ALL ".join(f"SELECT h FROM T{k} WHERE cnt = 1" for k in range(_HEIGHT + 1))
    ctes.append(f"R AS ({root})")

    def walk(prefix: str, groups: str, start: str, key: str) -> None:
        ctes.append(f"{prefix}0 AS ({start})")
        for k in range(_HEIGHT):
            at = "(w.idx % 3) * 64"
            ctes.append(f"""{prefix}{k + 1} AS (
    SELECT w.doc_id, w.source, w.idx // 3 AS idx, w.leaf, w.sub,
           w.proof || coalesce(substr(g.cat, 1, {at}) || substr(g.cat, {at} + 65), '') AS proof,
           CASE WHEN g.cat IS NULL THEN w.fold
                ELSE sha256(substr(g.cat, 1, {at}) || w.fold || substr(g.cat, {at} + 65)) END AS fold
    FROM {prefix}{k} w LEFT JOIN {groups}{k} g ON {key} AND g.grp = w.idx // 3)""")

    walk("W", "G", "SELECT doc_id, source, idx, leaf, '' AS sub, '' AS proof, tleaf AS fold FROM L0",
         "g.source IS NOT DISTINCT FROM w.source")
    walk("V", "TG", f"""SELECT w.doc_id, 0 AS source, t.idx, w.leaf, s.h AS sub, w.proof, w.fold
    FROM W{_HEIGHT} w JOIN T0 t ON t.of IS NOT DISTINCT FROM w.source
    JOIN S s ON s.source IS NOT DISTINCT FROM w.source""", "g.source = w.source")
    return "WITH RECURSIVE " + ",\n".join(ctes) + f"""
SELECT v.doc_id, v.leaf, v.sub AS subroot, R.h AS root, sha256(v.proof) AS proof_sha256, v.fold AS folded_root,
       v.fold = R.h AS verified
FROM V{_HEIGHT} v, R"""


ORACLES = {"op4_revisits": REVISITS, "op9_quality_rules": QUALITY, "op10_url_filters": URLS,
           "op13_merkle_manifest": _manifest()}
