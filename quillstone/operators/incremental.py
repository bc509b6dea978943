"""State between runs: what is new, what is known, what may be skipped."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_units(units: DataFrame, known: DataFrame, key: str = "fingerprint") -> DataFrame:
    """Units whose key no earlier run has seen."""
    return units.join(known.select(key).distinct(), key, "left_anti")


def with_is_new(units: DataFrame, known: DataFrame, key: str = "fingerprint") -> DataFrame:
    marked = known.select(key).distinct().withColumn("known", F.lit(True))
    return units.join(marked, key, "left").withColumn("is_new", F.col("known").isNull()).drop("known")


def unit_counts(units: DataFrame, known: DataFrame, key: str = "fingerprint") -> DataFrame:
    """One row: total, new and known distinct fingerprints."""
    marked = with_is_new(units.select(key).distinct(), known, key)
    seen = known.agg(F.count_distinct(key).alias("known"))
    return marked.agg(F.count("*").alias("total"), F.count_if("is_new").alias("new")).join(seen, F.lit(True))  # a row each


def pending(items: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """Items that the manifest of finished work doesn't name."""
    return items.join(manifest.select(key).distinct(), key, "left_anti")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of both, the new one where both have a key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def merge_signature(**settings) -> str:
    """Digest of everything that a synthesis result depends on; caches of another signature don't count."""
    return hashlib.sha256(json.dumps(settings, sort_keys=True, ensure_ascii=False).encode()).hexdigest()[:16]


def cached(table: DataFrame, signature: str, full_resync: bool = False) -> DataFrame:
    """A cache table's rows of this signature (a partition column); none on a full resync."""
    return table.where(F.lit(not full_resync) & (F.col("merge_sig") == signature))


def changed_topics(now: DataFrame, before: DataFrame) -> DataFrame:
    """Topics whose fingerprint is not the one written last."""
    return now.join(before.select("topic", "fingerprint"), ["topic", "fingerprint"], "left_anti")


def best_cached(fps: DataFrame, known: DataFrame, least: float = 0.5) -> DataFrame:
    """(name, best, overlap): per set of fingerprints the known set that shares most of the larger one's members."""
    a = fps.select("name", F.explode(F.array_distinct("fps")).alias("fp"), F.size(F.array_distinct("fps")).alias("n"))
    b = known.select(F.col("name").alias("best"), F.explode(F.array_distinct("fps")).alias("fp"), F.size(F.array_distinct("fps")).alias("m"))
    both = a.join(b, "fp").groupBy("name", "best", "n", "m").agg(F.count("*").alias("both"))
    both = both.withColumn("overlap", F.col("both") / F.greatest("n", "m")).where(F.col("overlap") >= least)
    top = both.groupBy("name").agg(F.min_by(F.struct("best", "overlap"), F.struct(-F.col("overlap"), "best")).alias("t"))
    return top.select("name", "t.best", "t.overlap")
