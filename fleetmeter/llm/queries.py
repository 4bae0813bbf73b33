"""Named queries of this subpackage; each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmeter.llm import (
    language,
    line_dedup,
    multiprobe,
    near_duplicates,
    packing,
    prefix_trie,
    quality,
    recompression,
    sentence_pieces,
    sql,
    suffix_dedup,
    suffix_tree,
    topk,
    walsh_codes,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.summary(_table(spark, sf_dir, "documents"))


def op2_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.encoded(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.classes(_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(_table(spark, sf_dir, "documents")).drop("rejected_by")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.scored(_table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path
    files = path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return packing.pack_documents(_table(spark, sf_dir, "documents"), *files)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.remove_repeats(_table(spark, sf_dir, "documents"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_copies(_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.numbered(_table(spark, sf_dir, "conversations"))))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return walsh_codes.compress(_table(spark, sf_dir, "embeddings"))


def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiprobe.search(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_sentence_pieces": op2_sentence_pieces,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_language_id": op4_language_id,
    "op5_quality_rules": op5_quality_rules,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_vector_codes": op12_vector_codes,
    "op13_near_vectors": op13_near_vectors,
}

_QUALITY = """
WITH tokens AS (
  SELECT doc_id, unnest(t) AS w, unnest(range(1, len(t) + 1)) AS i
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS t FROM documents)
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w, w2, w3) AS c
  FROM (SELECT doc_id, i, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM tokens
        WINDOW o AS (PARTITION BY doc_id ORDER BY i))
  WHERE w3 IS NOT NULL
), again AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE c > 1 GROUP BY doc_id
), per_word AS (
  SELECT doc_id, count(*) AS n, sum(length(w)) AS chars FROM tokens GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT l) AS dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents)
  WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
), base AS (
  SELECT d.doc_id, coalesce(p.n, 0)::BIGINT AS n_words, coalesce(p.chars, 0)::BIGINT AS word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(l.dup, 0)::BIGINT AS n_dup_lines, coalesce(a.n, 0)::BIGINT AS n_repeat_words,
    coalesce(l.n, 0) AS n_lines, length(regexp_replace(coalesce(text, ''), '[^!?]', '', 'g')) AS n_shouts,
    length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g')) AS n_upper,
    length(regexp_replace(coalesce(text, ''), '[^a-z]', '', 'g')) AS n_lower
  FROM documents d LEFT JOIN per_word p USING (doc_id) LEFT JOIN lines l USING (doc_id) LEFT JOIN again a USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 5 * n_lines
    OR 2 * n_upper > n_upper + n_lower OR 4 * n_shouts > n_words OR word_chars < 2 * n_words
    OR word_chars > 20 * n_words) AS kept
FROM base
"""

_TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

_LINES = """
WITH l AS (
  SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), h AS (
  SELECT doc_id, i, ls[i] AS line, ('0x' || substr(md5(ls[i]), 1, 8))::BIGINT AS h FROM l
), b AS (
  SELECT *, (h + 31 * coalesce(lag(h, 1) OVER w, 0) + 961 * coalesce(lag(h, 2) OVER w, 0)) % 4 = 0 AS ends
  FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), c AS (
  SELECT doc_id, i, line, coalesce(sum(ends::INTEGER) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM b
), k AS (
  SELECT doc_id, pos, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS t FROM c GROUP BY doc_id, pos
), r AS (
  SELECT *, n > 1 AND row_number() OVER (PARTITION BY n > 1, t ORDER BY doc_id, pos) > 1 AS gone FROM k
)
SELECT r.doc_id, CASE WHEN any_value(coalesce(d.text, '')) = '' THEN 0 ELSE sum(n) END::BIGINT AS n_lines,
  CASE WHEN any_value(coalesce(d.text, '')) = '' THEN 0 ELSE count(*) END::BIGINT AS n_chunks,
  coalesce(sum(n) FILTER (gone), 0)::BIGINT AS n_removed,
  sha256(coalesce(string_agg(t, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM r JOIN documents d USING (doc_id) GROUP BY r.doc_id
"""

ORACLES: dict[str, str] = {
    "op1_line_dedup": _LINES,
    "op5_quality_rules": _QUALITY,
    "op9_exact_top_k": _TOP_K,
    "op11_prefix_trie": sql.TRIE,
    "op12_vector_codes": sql.codes(),
}
