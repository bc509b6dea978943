"""The registered queries of the training-data operators, and their SQL where SQL can say them."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm import automaton, darts, packing, pages, quality, substrings, topk, toxicity, unigram, vectors
from quillstone.llm.common import table

WORD_BPE, BYTE_BPE, PIECES = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"


def tokenizer_json(name: str) -> str:
    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = automaton.bpe_encode(table(spark, sf_dir, "documents"), tokenizer_json(WORD_BPE))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("offending").alias("n_offending"))


def op4_vector_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.vector_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


OP4_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98
), reach(a, b) AS (
  SELECT a, a FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), parts AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN parts ON parts.a = vec_id
"""


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces, unknown = unigram.read_pieces(public_tokenizers.path(PIECES))
    return unigram.token_counts(table(spark, sf_dir, "documents"), pieces, unknown)


def op6_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pages.extract_text(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(table(spark, sf_dir, "documents"), n=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP7_SQL = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
r AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13),
win AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') AS k FROM r),
m AS (SELECT k, min(doc_id) AS first FROM win GROUP BY k HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM win JOIN m USING (k), (SELECT unnest(range(0, 13)) AS j) WHERE doc_id > first),
words AS (SELECT doc_id, generate_subscripts(ws, 1) AS p, unnest(ws) AS word FROM w),
kept AS (SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.p) AS t, count(*) AS n FROM words ANTI JOIN gone ON gone.doc_id = words.doc_id AND gone.p = words.p GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_json(BYTE_BPE), capacity=2048, end_id=1)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = darts.near_duplicates(table(spark, sf_dir, "documents"), words=5, threshold=0.8)
    return out.select("doc_id", "component_id", "n_words", "kept")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = quality.score_quality(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", "score", (F.col("score") >= 0.5).alias("kept"))


QUERIES = {f.__name__: f for f in (op1_topk, op2_bpe, op3_toxicity, op4_vector_dups, op5_token_counts, op6_page_text, op7_substring_dedup, op8_packing, op9_near_dups, op10_quality)}
ORACLE_SQL = {"op1_topk": OP1_SQL, "op4_vector_dups": OP4_SQL, "op7_substring_dedup": OP7_SQL}
