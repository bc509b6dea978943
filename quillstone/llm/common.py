"""Shared helpers of the training-data operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from quillstone.operators.barrier import settled as staged

__all__ = ["U64", "Memo", "mix64", "shuffle_partitions", "staged", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


U64 = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply), elementwise."""
    x = x.astype(U64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> U64(30)
        x *= U64(0xBF58476D1CE4E5B9)
        x ^= x >> U64(27)
        x *= U64(0x94D049BB133111EB)
        x ^= x >> U64(31)
    return x


class Memo(dict):
    """Values worked out when first asked for; when `most` are held they become the older generation, and the
    generation before is forgotten. Bounds memory, never results."""

    def __init__(self, work, most: int):
        super().__init__()
        self.work, self.most, self.older = work, most, {}

    def __missing__(self, key):
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.work(key)
        self[key] = value
        return value
