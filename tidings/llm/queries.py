"""The corpus operators over their whole test tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidings.llm import (chunkprints, codebooks, hostpaths, langid, linefreq, mixing, multiindex, packing, pfor, resample,
                         sql, suffixes, tokencount, weightedhash)
from tidings.sources.standins import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hyperdimensional profiles, learned from what is not held out."""
    docs = table(spark, sf_dir, "documents")
    prototypes = langid.train(docs.where(~langid.held_out()))
    found = langid.identify(docs.select("doc_id", "text"), prototypes)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op2_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patched frame-of-reference shards, written and read back."""
    return pfor.token_shards(table(spark, sf_dir, "documents"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sainte-Lague quotas of equal blocks per source and shard."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heap and linked-list byte-pair merging, counted."""
    return tokencount.count_tokens(table(spark, sf_dir, "documents"))


def op5_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.9 and more through the inverted multi-index."""
    return multiindex.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of weighted Jaccard similarity 0.8 and more."""
    return weightedhash.near_documents(table(spark, sf_dir, "documents"))


def op7_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounded-space online best fit into sequences of 1024 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_chunk_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content-defined chunks, against the edited text and the next document."""
    return chunkprints.compare_following(table(spark, sf_dir, "documents"))


def op9_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text by the consensus paths of each host."""
    return hostpaths.extract_text(table(spark, sf_dir, "pages"))


def op10_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines above a tenth of a source's documents dropped there; the source
    plays the host."""
    d = linefreq.drop_boilerplate(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "source", "n_lines", "n_dropped", "text")


def op11_column_bwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of repeated 200-byte strings, removed."""
    d = suffixes.drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), with_text=False)
    return d.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op12_importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents, drawn towards the benchmark's features."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_metric_codebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of four parts of 256 entries, fitted in four rounds."""
    return codebooks.compress(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_token_shards, op3_source_mix, op4_token_counts, op5_multi_index, op6_weighted_minhash,
                                 op7_best_fit, op8_chunk_prints, op9_host_paths, op10_line_frequency, op11_column_bwt, op12_importance_draw,
                                 op13_metric_codebooks)}

#: The mix as SQL: closed-form targets, highest quotients per shard, seeded order.
_MIX = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
keyed AS (SELECT *, md5(concat_ws(':', 'mix', CAST(doc_id AS VARCHAR), CAST(size AS VARCHAR))) AS key FROM sized),
s AS (SELECT source, count(*) AS rows, CAST(sum(size) AS BIGINT) AS source_size FROM keyed GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS source_no FROM s),
w AS (SELECT *, (source_no - 1) % 3 + 1 AS weight, 3 * source_size / ((source_no - 1) % 3 + 1) AS room FROM n),
lev AS (SELECT *, row_number() OVER o AS pos, (sum(source_size) OVER ()
          - coalesce(sum(3 * source_size) OVER (ORDER BY room, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
          / (sum(weight) OVER (ORDER BY room, source_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level
        FROM w WINDOW o AS (ORDER BY room, source_no)),
t AS (SELECT source, source_no, rows, source_size,
        least(CAST(3 * source_size AS DOUBLE),
              (SELECT level FROM lev WHERE level * weight <= 3 * source_size ORDER BY pos LIMIT 1) * weight) AS target
      FROM lev),
d AS (SELECT k.doc_id, k.size, k.key, t.source_no, t.source_size, t.target,
        CAST('0x' || substr(key, 1, 12) AS BIGINT) % CAST(ceil(t.rows / 2000) AS BIGINT) AS shard
      FROM keyed k JOIN t ON k.source IS NOT DISTINCT FROM t.source),
g AS (SELECT shard, source_no, CAST(sum(size) AS BIGINT) AS words,
        CAST(CASE WHEN max(source_size) > 0 THEN floor(16 * max(target) * sum(size) / max(source_size) + 0.5) ELSE 0 END
             AS BIGINT) AS want
      FROM d GROUP BY shard, source_no),
q0 AS (SELECT *, CAST(sum(want) OVER p AS BIGINT) AS all_want, count(*) OVER p AS n_src FROM g WINDOW p AS (PARTITION BY shard)),
q1 AS (SELECT *, CAST(floor(all_want / 512 + 0.5) AS BIGINT) AS seats FROM q0),
q2 AS (SELECT *, CAST(CASE WHEN all_want > 0 THEN floor(want * greatest(0.0, seats - n_src / 2) / all_want + 0.5) ELSE 0 END
                      AS BIGINT) AS sure FROM q1),
q3 AS (SELECT *, CAST(seats - sum(sure) OVER (PARTITION BY shard) AS BIGINT) AS remaining FROM q2),
c AS (SELECT shard, source_no, remaining, want, sure + unnest(range(remaining)) AS seat FROM q3 WHERE remaining > 0 AND want > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY want / (2 * seat + 1) DESC, source_no, seat) AS k FROM c),
m AS (SELECT shard, source_no, count(*) AS more FROM r WHERE k <= remaining GROUP BY 1, 2),
take AS (SELECT q3.shard, q3.source_no, words, least((sure + coalesce(more, 0)) * 32, 3 * words) AS take
         FROM q3 LEFT JOIN m ON q3.shard = m.shard AND q3.source_no = m.source_no),
a AS (SELECT d.*, words, take, coalesce(sum(size) OVER (PARTITION BY d.shard, d.source_no ORDER BY key, doc_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
      FROM d JOIN take ON d.shard = take.shard AND d.source_no = take.source_no)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN words > 0 THEN (take // words) * size + greatest(0, least(size, take % words - ahead)) ELSE 0 END
            AS BIGINT) AS taken
FROM a"""

_LINES = r"""
WITH d AS (SELECT row_number() OVER () AS row, * FROM documents),
l AS (SELECT row, doc_id, source, i, string_split(text, chr(10))[i] AS line
      FROM (SELECT *, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM d)),
p AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
f AS (SELECT l.source, trim(line) AS line FROM l JOIN p ON l.source IS NOT DISTINCT FROM p.source
      WHERE trim(line) <> '' GROUP BY l.source, trim(line)
      HAVING count(DISTINCT row) >= 5 AND max(pages) >= 20 AND count(DISTINCT row) / max(pages) > 0.1),
k AS (SELECT l.*, f.line IS NOT NULL AS dropped
      FROM l LEFT JOIN f ON l.source IS NOT DISTINCT FROM f.source AND trim(l.line) = f.line),
t AS (SELECT row, CAST(count(*) AS INTEGER) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS INTEGER) AS n_dropped,
             coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '') AS text
      FROM k GROUP BY row)
SELECT d.doc_id, d.source, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
       CASE WHEN d.text IS NULL THEN NULL ELSE t.text END AS text
FROM d LEFT JOIN t ON d.row = t.row"""

ORACLE: dict[str, str] = {"op3_source_mix": _MIX, "op10_line_frequency": _LINES} | sql.ORACLE
