"""The driver's tables as inputs of the engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import text as T
from quillstone.operators import topics
from quillstone.operators.barrier import settled
from quillstone.operators.units import parse_units

MAPPING = {"latin": ["fr", "es"], "germanic": ["en"]}
ORDER = topics.TOPIC_ORDER


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def markdown() -> Column:
    """A document as one unit of Markdown; every fourth has no label."""
    text = F.coalesce("text", F.lit(""))
    number = F.col("doc_id").cast("string")
    labelled = F.concat(F.lit("## ["), "lang", F.lit("][P"), (F.col("doc_id") % 3).cast("string"), F.lit("] doc "), number, F.lit("\n"), text)
    return F.when(F.col("doc_id") % 4 != 3, labelled).otherwise(F.concat(F.lit("## doc "), number, F.lit("\n"), text))


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of all documents; a source is a file, a document a part of it."""
    files = table(spark, sf_dir, "documents").select(F.col("source").alias("file_name"), "doc_id", markdown().alias("text"))
    return parse_units(files, part="doc_id")


def topic_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units with topic, the order columns and is_new (every fifth document was seen before)."""
    u = topics.apply_mapping(units(spark, sf_dir), topics.mapping_table(spark, MAPPING))
    return topics.with_first_seen(u).withColumn("is_new", F.col("part") % 5 != 0)


def unit_keys(spark: SparkSession, sf_dir: str, **extra: Column) -> DataFrame:
    """topic_units without their bodies, and what is worked out from these; settled, so that joins of units with
    one another read a few columns instead of parsing all texts again."""
    return settled(topic_units(spark, sf_dir).withColumns(extra).drop("body") if extra else topic_units(spark, sf_dir).drop("body"))


def known(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units(spark, sf_dir).where("part % 5 = 0").select("fingerprint")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").where("embedding IS NOT NULL AND label IS NOT NULL")
    return e.select("vec_id", "label", "embedding", (F.col("vec_id") % 5 != 0).alias("is_new"))


def judgments(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    """Judgments over neighbouring documents that hold a merge, a chain onto it, a duplicate and a kept pair.

    of: all units, where they are at hand.
    """
    u = (units(spark, sf_dir) if of is None else of).select("part", "fingerprint")
    pairs = u.join(u.select((F.col("part") - 1).alias("part"), F.col("fingerprint").alias("other")), "part")
    kind = F.col("part") % 10
    verdict = F.when(kind.isin(1, 6), "MERGE").when(kind.isin(2, 4), "DUPLICATE").when(kind == 8, "KEEP_BOTH")
    dup = verdict == "DUPLICATE"
    return pairs.where(kind.isin(1, 2, 4, 6, 8)).select(
        T.pair_key(F.col("fingerprint"), F.col("other")).alias("pair_key"),
        verdict.alias("verdict"),
        F.when(dup, F.col("fingerprint")).alias("keep_fp"),
        F.when(dup, F.col("other")).alias("drop_fp"),
        F.when(kind == 1, F.concat(F.lit("## merged "), F.col("part").cast("string"))).alias("merged_text"),
        F.col("part").alias("ord"),
    )
