"""The corpus pipeline: filters, near-duplicate removal, repeated passages, packing.

STAGES are applied in order; each stage's rows are written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm import darts, packing, quality, substrings, toxicity
from quillstone.llm.common import staged, table
from quillstone.llm.queries import BYTE_BPE, tokenizer_json

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; the model learns from the documents given."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs.select(*COLUMNS), model, carry=COLUMNS[1:])
    return scored.where("score < 0.5").select(*COLUMNS)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least one half."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs.select(*COLUMNS), model, carry=COLUMNS[1:])
    return scored.where("score >= 0.5").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one of smallest id. Rows of null id stay; a repeated row stays once."""
    found = darts.near_duplicates(docs)
    keep = found.where("kept AND doc_id IS NOT NULL").select("doc_id", "mark").distinct()
    docs = docs.select(*COLUMNS).withColumn("mark", F.xxhash64("text"))
    kept = docs.join(keep, ["doc_id", "mark"], "left_semi").dropDuplicates(["doc_id", "mark"])
    return kept.unionByName(docs.where("doc_id IS NULL")).select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the windows of 13 words that also start in an earlier document; n_chars follows the text.

    A text that loses no word stays as it is, blanks included.
    """
    out = substrings.remove_repeats(docs.withColumn("whole", F.col("text")), n=13, carry=["whole", "lang", "source"])
    text = F.when(F.col("n_removed") == 0, F.col("whole")).otherwise(F.col("text"))
    return out.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of at most 2048 tokens."""
    out = packing.pack_documents(docs, tokenizer_json(BYTE_BPE), capacity=2048, end_id=1)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("packing", pack),
]

#: Learned filters and hashed signatures can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"stage-{name}")
    return docs
