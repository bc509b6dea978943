"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.operators.barrier import settled

#: Ids that a partition's forest holds before it is given back.
HELD = 2_000_000


class Forest:
    """Union-find over the ids of one task; the root is the smallest id."""

    def __init__(self):
        self.up: dict = {}

    def root(self, x):
        up, top = self.up, x
        while (p := up.get(top, top)) != top:
            top = p
        while x != top:
            x, up[x] = up.get(x, x), top
        return top

    def join(self, a, b) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def pairs(self) -> list[tuple]:
        """(root, id) of every id that is no root: as many edges as joins that mattered."""
        return [(r, x) for x in list(self.up) if (r := self.root(x)) != x]


def _thinned(batches):
    """A partition's edges, fewer, with the same connections."""
    f = Forest()
    for pdf in batches:
        for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist(), strict=True):
            f.join(a, b)
        if len(f.up) > HELD:
            yield pd.DataFrame(f.pairs(), columns=["a", "b"])
            f = Forest()
    if f.up:
        yield pd.DataFrame(f.pairs(), columns=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id on an edge (a, b); component is the smallest id reachable.

    Each round is two shuffles by id whose sums are combined before they travel; the rows of a hub meet in joins
    only, which adaptive execution may split. Rounds grow with the logarithm of the longest path; lineage is cut
    each round. Nulls and self-loops must be absent.
    """
    kind = edges.schema["a"].dataType.simpleString()
    now = settled(edges.select("a", "b").mapInPandas(_thinned, f"a {kind}, b {kind}").distinct())
    before = None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == before or not mark["n"]:
            break
        before = mark
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").where("b <> m").select(F.col("m").alias("a"), "b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b")
        pairs = small.select(F.col("m").alias("x"), F.col("b").alias("y")).unionByName(small.select(F.col("m").alias("x"), F.col("a").alias("y")))
        now = settled(pairs.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    roots = now.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    return now.groupBy("b").agg(F.min("a").alias("component")).select(F.col("b").alias("id"), "component").unionByName(roots)
