"""Applying judgments to units."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.functions import text as T
from quillstone.operators.graph import components


def _merges(judgments: DataFrame) -> DataFrame:
    """(lo, hi, merged_text, ord) of MERGE judgments that have a text; lo is the smaller fingerprint."""
    m = judgments.where("verdict = 'MERGE' AND coalesce(merged_text, '') <> ''")
    fps = F.split("pair_key", "_")
    return m.where(F.size(fps) == 2).select(F.get(fps, F.lit(0)).alias("lo"), F.get(fps, F.lit(1)).alias("hi"), "merged_text", "ord")


def resolve_reference(units: DataFrame, judgments: DataFrame, order: list[str]) -> DataFrame:
    """Units after the judgments, with the upstream rules: a unit dropped by one judgment is gone for all.

    A merge replaces the unit of the smaller fingerprint (tag, priority and title from the side of smaller
    priority number, the last judgment winning) and drops the other. A DUPLICATE drops its fingerprint unless
    that one took part in a merge; merges are read first, whatever the order of judgments. Units may come without
    bodies where nobody wants them.
    """
    merges = _merges(judgments)
    sides = merges.select("lo", "hi", "ord", "merged_text", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("fingerprint"))
    best = sides.join(units.select("fingerprint", F.struct("priority", *order, "tag", "title").alias("m")), "fingerprint").groupBy("lo", "hi", "ord", "merged_text").agg(F.min("m").alias("m"))
    applied = best.groupBy("lo").agg(F.max_by(F.struct("m", "merged_text"), "ord").alias("r")).select(F.col("lo").alias("fingerprint"), "r.m", "r.merged_text")
    involved = sides.select("fingerprint").distinct()
    dropped = best.select(F.col("hi").alias("fingerprint")).unionByName(judgments.where("verdict = 'DUPLICATE' AND drop_fp IS NOT NULL").select(F.col("drop_fp").alias("fingerprint")).join(involved, "fingerprint", "left_anti")).distinct()
    left = units.join(dropped, "fingerprint", "left_anti").join(applied, "fingerprint", "left")
    new = F.col("merged_text").isNotNull()
    return left.select(
        *[c for c in units.columns if c not in ("tag", "priority", "title", "body", "fingerprint")],
        F.when(new, F.col("m.tag")).otherwise(F.col("tag")).alias("tag"),
        F.when(new, F.col("m.priority")).otherwise(F.col("priority")).alias("priority"),
        F.when(new, F.col("m.title")).otherwise(F.col("title")).alias("title"),
        *([F.coalesce("merged_text", "body").alias("body")] if "body" in units.columns else []),
        F.when(new, T.fingerprint(F.col("merged_text"))).otherwise(F.col("fingerprint")).alias("fingerprint"),
    )


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """(fp, root) over edges (a, b): the smallest fingerprint reachable."""
    return components(edges).select(F.col("id").alias("fp"), F.col("component").alias("root"))


def resolve_safe(units: DataFrame, judgments: DataFrame, order: list[str]) -> DataFrame:
    """One survivor a connected component of DUPLICATE and MERGE judgments, so no content vanishes in chains.

    The survivor is the unit of smallest (priority, place). It takes the last merged text of its component.
    """
    fps = F.split("pair_key", "_")
    edges = judgments.where("verdict IN ('DUPLICATE', 'MERGE')").select(F.get(fps, F.lit(0)).alias("a"), F.get(fps, F.lit(1)).alias("b")).where("a <> b")
    parts = smallest_reachable(edges)
    member = units.join(parts, units["fingerprint"] == parts["fp"], "left").drop("fp").withColumn("root", F.coalesce("root", "fingerprint"))
    keep = member.groupBy("root").agg(F.min_by("fingerprint", F.struct("priority", *order)).alias("fingerprint"))
    texts = _merges(judgments).join(parts, F.col("lo") == F.col("fp")).groupBy("root").agg(F.max_by("merged_text", "ord").alias("merged_text"))
    out = member.join(keep, ["root", "fingerprint"], "left_semi").join(texts, "root", "left")
    new = F.col("merged_text").isNotNull()
    out = out.withColumn("fingerprint", F.when(new, T.fingerprint(F.col("merged_text"))).otherwise(F.col("fingerprint")))
    return (out.withColumn("body", F.coalesce("merged_text", "body")) if "body" in units.columns else out).select(*units.columns)
