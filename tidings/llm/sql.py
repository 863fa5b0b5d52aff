"""DuckDB SQL for the resampling, codebook and repeat queries."""

from __future__ import annotations

#: Features with their crc32 (byte by byte through its table), gains, scores, draw.
RESAMPLE = r"""
WITH RECURSIVE
tab AS MATERIALIZED (
  SELECT n AS k, list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
                             CAST(n AS BIGINT)) AS v FROM range(256) t(n)),
texts AS (SELECT 'd' AS kind, row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
          UNION ALL SELECT 'b', row_number() OVER (), NULL, coalesce(text, '') FROM benchmark),
w AS MATERIALIZED (
  SELECT kind, row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
u AS (SELECT kind, row, words, unnest(range(1, len(words) + 1)) AS i FROM w),
f AS MATERIALIZED (
  SELECT kind, row, words[i] AS feature FROM u
  UNION ALL SELECT kind, row, words[i] || ' ' || words[i + 1] FROM u WHERE i < len(words)),
names AS MATERIALIZED (SELECT DISTINCT feature, hex(encode(feature)) AS h FROM f),
crc AS (SELECT feature, h, 0 AS i, CAST(4294967295 AS BIGINT) AS c FROM names
        UNION ALL
        SELECT feature, h, i + 1, xor(c >> 8, tab.v) FROM crc
        JOIN tab ON tab.k = xor(c, CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)) & 255 WHERE 2 * i < len(h)),
b AS (SELECT feature, xor(c, CAST(4294967295 AS BIGINT)) % 10000 AS bucket FROM crc WHERE 2 * i = len(h)),
fb AS MATERIALIZED (SELECT kind, row, bucket FROM f JOIN b USING (feature)),
n AS (SELECT bucket, count(*) FILTER (WHERE kind = 'd') AS s, count(*) FILTER (WHERE kind = 'b') AS t FROM fb GROUP BY bucket),
tot AS (SELECT CAST(coalesce(sum(s), 0) AS DOUBLE) AS s_all, CAST(coalesce(sum(t), 0) AS DOUBLE) AS t_all FROM n),
g AS (SELECT bucket, CAST(floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000)))) AS BIGINT) AS gain
      FROM n, tot),
d AS (SELECT row, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS total FROM fb JOIN g USING (bucket)
      WHERE kind = 'd' GROUP BY row),
s AS (SELECT w.doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features,
             coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight,
             CAST('0x' || substr(sha256('7:' || CAST(w.doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS h
      FROM w LEFT JOIN d ON w.row = d.row WHERE w.kind = 'd'),
r AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM s),
k AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
             count(*) FILTER (WHERE n_words >= 20) OVER () AS able FROM r)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
       CASE WHEN n_words >= 20 AND place <= 25 * able // 100 THEN CAST(place AS BIGINT) END AS rank
FROM k"""


def codebooks(rounds: int = 4) -> str:
    """Rounds of brute-force nearest entries over whole numbers."""
    sql = r"""
WITH k AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label, embedding FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
i AS (SELECT row, len(embedding) // 4 AS width, unnest(range(0, len(embedding))) AS place, unnest(embedding) AS e FROM k),
x AS MATERIALIZED (SELECT row, place // width AS part, place % width AS pos, CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT) AS x FROM i),
e0 AS MATERIALIZED (SELECT part, row - 1 AS entry, pos, x AS e FROM x WHERE row <= 256)"""
    for r in range(rounds + 1):
        sql += f""",
a{r} AS MATERIALIZED (
  SELECT row, part, min(d * 256 + entry) AS m
  FROM (SELECT row, part, entry, CAST(sum((x - e) * (x - e)) AS BIGINT) AS d FROM x JOIN e{r} USING (part, pos)
        GROUP BY row, part, entry) GROUP BY row, part)"""
        if r < rounds:
            sql += f""",
m{r} AS (SELECT part, m % 256 AS entry, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM a{r} JOIN x USING (row, part)
       GROUP BY part, m % 256, pos),
e{r + 1} AS MATERIALIZED (SELECT part, entry, pos, coalesce((s - ((s % n) + n) % n) // n, e) AS e
                        FROM e{r} LEFT JOIN m{r} USING (part, entry, pos))"""
    return sql + f""",
c AS (SELECT row, string_agg(lower(lpad(hex(m % 256), 2, '0')), '' ORDER BY part) AS code, CAST(sum(m // 256) AS BIGINT) AS error
      FROM a{rounds} GROUP BY row),
l AS (SELECT vec_id, label, code, error FROM k JOIN c USING (row))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(e AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM e{rounds}) AS codebooks_sha256
FROM l"""


#: Every 200-byte window by its md5, cut out of pieces of 1000 bytes.
REPEATS = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT row, 1000 * q AS base, substr(h, 2000 * q + 1, 2398) AS piece
      FROM (SELECT *, unnest(range(0, (len(h) + 1999) // 2000)) AS q FROM d)),
w AS MATERIALIZED (SELECT row, base + i AS start, md5(substr(piece, 2 * i + 1, 400)) AS key
      FROM (SELECT *, unnest(range(0, least(1000, len(piece) // 2 - 199))) AS i FROM p WHERE len(piece) >= 400)),
often AS (SELECT key FROM w GROUP BY key HAVING count(*) > 1),
s AS (SELECT row, start, lag(start) OVER (PARTITION BY row ORDER BY start) AS prev FROM w WHERE key IN (SELECT key FROM often)),
g AS (SELECT *, sum(CASE WHEN prev IS NULL OR start > prev + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY row ORDER BY start) AS run
      FROM s),
r AS MATERIALIZED (SELECT row, run, min(start) AS a, max(start) + 200 AS b FROM g GROUP BY row, run),
e AS (SELECT row, a, b, coalesce(lag(b) OVER (PARTITION BY row ORDER BY a), 0) AS before FROM r),
z AS (SELECT row, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans, max(b) AS last FROM r GROUP BY row),
t AS (SELECT d.row, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
      FROM e JOIN d USING (row) GROUP BY d.row)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN z USING (row) LEFT JOIN t USING (row)"""

ORACLE: dict[str, str] = {"op11_column_bwt": REPEATS, "op12_importance_draw": RESAMPLE, "op13_metric_codebooks": codebooks()}
