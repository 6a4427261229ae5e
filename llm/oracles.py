"""DuckDB SQL of the queries whose whole result SQL can express."""

from __future__ import annotations

UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def substrings(window: int = 35) -> str:
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, k, md5(array_to_string(list_slice(w, k, k + {window - 1}), ' ')) AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - {window - 2})) AS k FROM d WHERE len(w) >= {window})),
rep AS (SELECT g FROM win GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, k + o AS p FROM win JOIN rep USING (g), range({window}) t(o)),
kept AS (SELECT x.r, string_agg(x.word, ' ' ORDER BY x.p) AS s, count(*) AS n
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) x ANTI JOIN gone ON gone.r = x.r AND gone.p = x.p GROUP BY x.r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)"""


def suffixes(length: int = 50) -> str:
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, {(1 << 63) - 1}) AS o, hex(encode(coalesce(text, ''))) AS h FROM documents),
blocks AS (SELECT r, o, j, least(length(h) // 2 - {length - 1} - 500 * j, 500) AS n, substr(h, 1000 * j + 1, {1000 + 2 * length}) AS piece
  FROM (SELECT r, o, h, unnest(range(0, (length(h) // 2 - {length - 1} + 499) // 500)) AS j FROM d WHERE length(h) >= {2 * length})),
win AS (SELECT r, o, 500 * j + i AS k, md5(substr(piece, 2 * i + 1, {2 * length})) AS g FROM (SELECT *, unnest(range(0, n)) AS i FROM blocks)),
first AS (SELECT g, min(o) AS o FROM win GROUP BY g HAVING min(o) < max(o)),
gone AS (SELECT DISTINCT r, k + b AS p FROM win JOIN first USING (g), range({length}) t(b) WHERE win.o > first.o),
spans AS (SELECT r, count(*) AS n, count(*) FILTER (WHERE before IS NULL OR before < p - 1) AS spans
  FROM (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM gone) GROUP BY r),
kept AS (SELECT x.r, string_agg(x.b, '' ORDER BY x.p) AS s
  FROM (SELECT r, unnest(range(0, length(h) // 2)) AS p, unnest(regexp_extract_all(h, '..')) AS b FROM d WHERE r IN (SELECT r FROM spans)) x
  ANTI JOIN gone ON gone.r = x.r AND gone.p = x.p GROUP BY x.r)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n, 0) AS n_removed, coalesce(spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN n IS NULL THEN h ELSE coalesce(s, '') END)) AS kept_sha256
FROM d LEFT JOIN spans USING (r) LEFT JOIN kept USING (r)"""


def decontaminate(window: int = 10) -> str:
    found = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{SMALL}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {found} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {found} AS w FROM benchmark),
phrases AS (SELECT DISTINCT item, least(len(w), {window}) AS n, array_to_string(list_slice(w, k, k + {window - 1}), ' ') AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {window - 1}, 1) + 1)) AS k FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM phrases),
win AS (SELECT r, n, k, array_to_string(list_slice(w, k, k + n - 1), ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT r, k, win.n, item FROM win JOIN phrases p ON p.g = win.g AND p.n = win.n),
words AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, k + o AS p FROM hits, range({window}) t(o) WHERE o < n) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""


def warc(least: int = 0) -> str:
    group = lambda k: f"CAST('0x' || substr(digest, {k}, 10) AS BIGINT)"
    letters = [f"substr('{BASE32}', 1 + CAST(({group(1 + 10 * g)} >> {5 * (7 - i)}) & 31 AS INTEGER), 1)" for g in range(4) for i in range(8)]
    uri = "replace(replace(replace(replace(coalesce(url, ''), ' ', '%20'), chr(13), '%0D'), chr(10), '%0A'), chr(9), '%09')"
    return f"""
SELECT page_id, size AS payload_bytes, {' || '.join(letters)} AS payload_digest,
  CASE WHEN keeper <> page_id AND size >= {least} THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN keeper <> page_id AND size >= {least} THEN keeper END AS refers_to, 1 AS requests, {uri} AS target_uri
FROM (SELECT *, max(page_id) OVER (PARTITION BY digest) AS keeper
  FROM (SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS size, sha1(coalesce(html, '')) AS digest FROM pages))"""


ORACLES = {"op2_substrings": substrings(), "op5_suffixes": suffixes(), "op8_decontaminate": decontaminate(), "op10_warc": warc()}
