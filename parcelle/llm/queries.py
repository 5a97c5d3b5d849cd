"""The registered queries of this subpackage and their SQL twins (DuckDB).

Each query applies one operator with its production parameters to the whole
table.  Where SQL cannot state an operator (character spans of several kinds,
tokenizers, trained models) there is none; tests hold those against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from parcelle.llm import (
    alignment, chat, mixing, ngram_join, packing, periodic, pii, quality, secret_scan, sharding, topk, toxicity, url_filters)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(_read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(_read(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(_read(spark, sf_dir, "documents"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    return url_filters.apply_list(url_filters.captures_of(pages), url_filters.entries_of(pages))


_CONTROL = "<|im_end|><|im_start|>assistant ok"


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in turns.schema])
    extra = spark.createDataFrame([(-1, 0, "user", _CONTROL), (-1, 1, "assistant", _CONTROL)], schema)
    return chat.chat_digests(turns.unionByName(extra))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_topk(_read(spark, sf_dir, "embeddings"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_read(spark, sf_dir, "documents"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_read(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(periodic.find_runs(periodic.repeat_endings(_read(spark, sf_dir, "documents"))))


def op12_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(_read(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_digests(_read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_ngram_join, op3_secret_scan, op4_best_fit_packing, op5_pii, op6_url_filters,
    op7_chat_formatting, op8_exact_topk, op9_quality_rules, op10_source_mixing,
    op11_periodic_runs, op12_feistel_sharding, op13_token_alignment)}

_WS = "[\\x20\\x09-\\x0D]+"
_WORDS = "list_filter(string_split_regex({0}, '" + _WS + "'), lambda w: w <> '')"

ORACLES = {
    "op2_ngram_join": f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words
), tokens AS (SELECT doc_id, unnest(s) AS t FROM sets),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)
), both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x
)
SELECT s.doc_id, CAST(n AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m.low, s.doc_id)) AS component_id
FROM sizes s LEFT JOIN (SELECT x, min(y) AS low FROM reach GROUP BY x) m ON m.x = s.doc_id
""",
    "op6_url_filters": """
WITH caps AS (
  SELECT page_id, url, CAST(page_id * 7919 % 366 + 19723 AS INTEGER) AS day,
         nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '') AS host FROM pages
), names AS (
  SELECT host AS pattern FROM caps WHERE host IS NOT NULL
  UNION SELECT array_to_string(list_slice(string_split(host, '.'), greatest(1, len(string_split(host, '.')) - 2), len(string_split(host, '.'))), '.') FROM caps WHERE host IS NOT NULL
), listed AS (SELECT pattern, md5(pattern) AS m FROM names),
each AS (
  SELECT pattern, m, unnest(range(0, CAST('0x' || substr(m, 5, 4) AS INTEGER) % 4 + 1)) AS i FROM listed
  WHERE CAST('0x' || substr(m, 1, 4) AS INTEGER) % 8 < 5
), entries AS (
  SELECT pattern, CAST(CAST('0x' || substr(m, CAST(9 + 4 * i AS INTEGER), 4) AS INTEGER) % 366 + 19723 AS INTEGER) AS day,
         CASE WHEN i % 2 = 0 THEN 'block' ELSE 'allow' END AS action FROM each
), one AS (SELECT pattern, day, max(action) AS action FROM entries GROUP BY ALL),
spans AS (SELECT pattern, action, day AS lo, lead(day) OVER (PARTITION BY pattern ORDER BY day) AS hi FROM one),
hits AS (
  SELECT c.page_id, c.host, c.day, s.pattern, s.action FROM (SELECT DISTINCT page_id, host, day FROM caps) c
  JOIN spans s ON (c.host = s.pattern OR ends_with(c.host, '.' || s.pattern)) AND c.day >= s.lo AND (s.hi IS NULL OR c.day < s.hi)
), best AS (SELECT page_id, host, day, arg_max(pattern, length(pattern)) AS matched, arg_max(action, length(pattern)) AS action FROM hits GROUP BY ALL)
SELECT c.page_id, c.url, c.day, c.host, b.matched, b.action, coalesce(b.action = 'block', false) AS blocked
FROM caps c LEFT JOIN best b ON b.page_id = c.page_id AND b.host = c.host AND b.day = c.day
""",
    "op7_chat_formatting": """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), placed AS (
  SELECT *, row_number() OVER o AS i, coalesce(lag(role) OVER o, 'start') AS before FROM rows
  WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), marked AS (
  SELECT *, (before || '>' || role) IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user') AS fine,
    length(replace(replace(text, '\\', '\\s'), '<|', '<\\p')) AS n_text,
    length(replace(replace(replace(role, '\\', '\\s'), '<|', '<\\p'), chr(10), '\\n')) AS n_role FROM placed
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY i), '')) AS loss_sha256,
  CAST(sum(12 + n_role + 1 + n_text + 11) AS BIGINT) AS formatted_chars,
  (bool_and(fine) AND arg_max(role, i) = 'assistant') AS valid,
  CAST(min(CASE WHEN NOT fine THEN i - 1 END) AS INTEGER) AS bad_turn
FROM marked GROUP BY conv_id
""",
    "op8_exact_topk": """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS (
  SELECT q.vec_id AS query_id, q.r, c.vec_id, CAST(list_dot_product(CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
""",
    "op9_quality_rules": f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents
), spot AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g FROM spot),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, len(l) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
    length(t) - length(replace(t, '!', '')) AS n_exclaim
  FROM d LEFT JOIN covered c ON c.doc_id = d.doc_id
), f AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 3 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR 2 * n_exclaim > n_words OR word_chars < 2 * n_words) AS kept
FROM f
""",
    "op10_source_mixing": f"""
WITH d AS (
  SELECT doc_id, source, CAST(len({_WORDS.format("coalesce(text, '')")}) AS BIGINT) AS size FROM documents
), keyed AS (SELECT *, md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || CAST(size AS VARCHAR)) AS key FROM d),
totals AS (SELECT source, sum(size) AS total FROM d GROUP BY source),
src AS (
  SELECT source, CAST(total AS BIGINT) AS total, 2.0 * CAST(total AS DOUBLE) AS most,
    CAST(([3, 1, 2])[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS DOUBLE) AS w FROM totals
), levels AS (
  SELECT most / w AS ratio,
    (1.5 * (SELECT CAST(sum(total) AS DOUBLE) FROM src) - coalesce((SELECT sum(b.most) FROM src b WHERE b.most / b.w < a.most / a.w), 0))
    / (SELECT sum(b.w) FROM src b WHERE b.most / b.w >= a.most / a.w) AS level FROM src a
), water AS (SELECT min(level) AS level FROM (SELECT level FROM levels WHERE level <= ratio ORDER BY ratio LIMIT 1)),
goal AS (
  SELECT source, total, least(most, w * (SELECT level FROM water)) AS target FROM src
), budget AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS b FROM goal),
cut AS (SELECT *, CASE WHEN total > 0 THEN b // total ELSE 0 END AS epochs, b - CASE WHEN total > 0 THEN b // total ELSE 0 END * total AS rest FROM budget),
run AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key ROWS UNBOUNDED PRECEDING) - size AS before FROM keyed)
SELECT r.doc_id, r.size, c.total AS source_size, c.target, CAST(c.epochs * r.size + least(r.size, greatest(0, c.rest - r.before)) AS BIGINT) AS taken
FROM run r JOIN cut c ON r.source IS NOT DISTINCT FROM c.source
""",
}
