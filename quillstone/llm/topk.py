"""Exact top-k inner-product search by the threshold algorithm over sorted per-dimension lists.

Rows are cut into blocks. A block keeps one list of its rows per dimension, sorted by that component; a query
walks the lists of its non-zero dimensions together, from the top where its weight is positive and from the
bottom where it is negative. Every row met is scored, and the walk stops when the sum of the list heads (no
unseen row can score more) is below the kth score held so far.

All queries of a query block walk a block's lists at once, both ends of each list: which rows are met down to a
depth is then the same for all, so a block stores its rows in the order in which they are met, and the heads of
its lists at each depth. One step is a matrix product for the queries that still walk. Query blocks and lanes of
row blocks meet by an equi-join, a bounded number of row blocks a task: no cross join.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROW_BLOCK, QUERY_BLOCK, FIRST_DEPTH = 4096, 4096, 32
#: Row blocks of a lane: what a task holds of the rows.
LANE = 8
LONGEST = (-(1 << 63), (1 << 63) - 1)


def whole(v: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles: doubles that are whole numbers, or Python integers where doubles overflow."""
    with np.errstate(over="ignore"):
        out = np.floor(v * scale)
    if np.isfinite(out).all():
        return out
    return np.array([math.floor(x * scale) if math.isfinite(x * scale) else int(x) * scale for x in v.ravel().tolist()], object).reshape(v.shape)


def integers(v: np.ndarray) -> np.ndarray:
    """Whole doubles as Python integers, exactly."""
    return np.array([int(x) for x in v.ravel().tolist()], object).reshape(v.shape)


def exact(q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Doubles where every partial sum stays below 2^53, else Python integers."""
    if q.dtype != object and v.dtype != object:
        top = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * q.shape[-1]
        if top < 2.0**53:
            return q, v
    return integers(q), integers(v)


def depths(n: int) -> list[int]:
    """Depths at which a walk of n rows pauses; the last is n."""
    out, step = [], FIRST_DEPTH
    while not out or out[-1] < n:
        out.append(min(n, (out[-1] if out else 0) + step))
        step *= 2
    return out


class Lists:
    """A block's rows in the order in which walks from both ends of its sorted lists meet them."""

    def __init__(self, ids: np.ndarray, v: np.ndarray):
        n = len(ids)
        order = np.argsort(v, axis=0, kind="stable")
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(n)[:, None], axis=0)
        met = np.minimum(rank, n - 1 - rank).min(axis=1)  # the depth before the one at which a row is met
        by = np.lexsort((ids, met))
        self.ids, self.v, self.depths = ids[by], v[by], depths(n)
        self.until = np.searchsorted(met[by], self.depths)
        self.heads = [(np.take_along_axis(v, order[n - d : n - d + 1], 0)[0], np.take_along_axis(v, order[d - 1 : d], 0)[0]) for d in self.depths]


    @classmethod
    def read(cls, ids: bytes, v: bytes, until: bytes, heads: bytes, dim: int, scale: int) -> Lists:
        """A stored block, its components made whole; floor keeps the order of the lists."""
        self = cls.__new__(cls)
        self.ids = np.frombuffer(ids, np.int64)
        self.v = whole(np.frombuffer(v, np.float64).reshape(len(self.ids), dim), scale)
        self.depths, self.until = depths(len(self.ids)), np.frombuffer(until, np.int64)
        self.heads = list(whole(np.frombuffer(heads, np.float64).reshape(-1, 2, dim), scale))
        return self


class Best:
    """The k best (score, id) of each query, the best first; ties to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.held: list[list[tuple]] = [[] for _ in range(queries)]

    def kth(self, i: int):
        """The score that a row must reach to be held; None while fewer than k are."""
        return -self.held[i][-1][0] if len(self.held[i]) == self.k else None

    def take(self, which: np.ndarray, score: np.ndarray, ids: np.ndarray, none) -> None:
        """Scores of rows (columns) for some queries (rows); `none` marks a row that is left out."""
        m, peak = len(ids), score.max(axis=1)
        kths = [self.kth(i) for i in which.tolist()]
        news = np.flatnonzero([p > none and (t is None or p >= t) for p, t in zip(peak.tolist(), kths, strict=True)])
        if not len(news):
            return
        top = np.partition(score[news], m - self.k, axis=1)[:, m - self.k] if m > self.k else score[news].min(axis=1)
        for r, least in zip(news.tolist(), top.tolist(), strict=True):
            i, kth = int(which[r]), kths[r]
            some = np.flatnonzero((score[r] >= (least if kth is None else max(least, kth))) & (score[r] > none))
            self.held[i] = sorted([*self.held[i], *((-int(score[r, c]), int(ids[c])) for c in some)])[: self.k]


def threshold_search(qids: np.ndarray, q: np.ndarray, lists: Lists, best: Best) -> None:
    """Walk a block's lists for all queries, who give their best so far; a query's own row is left out."""
    q, v = exact(q, lists.v)
    low_score = -np.inf if q.dtype != object else -(1 << 4096)
    up, down = np.where(q > 0, q, 0), np.where(q < 0, q, 0)
    walking, at = np.arange(len(q)), 0
    for d, to, (high, low) in zip(lists.depths, lists.until.tolist(), lists.heads, strict=True):
        if to > at:
            ids = lists.ids[at:to]
            score = q[walking] @ v[at:to].T
            for c in np.flatnonzero(np.isin(ids, qids)):
                score[qids[walking] == ids[c], c] = low_score
            best.take(walking, score, ids, low_score)
            at = to
        if d == len(lists.ids):
            return
        if q.dtype == object:
            high, low = integers(high), integers(low)
        bound = up[walking] @ high + down[walking] @ low
        kth = [best.kth(i) for i in walking.tolist()]
        walking = walking[[t is None or b >= t for b, t in zip(bound.tolist(), kth, strict=True)]]
        if not len(walking):
            return


def vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, dim, v): only whole, finite vectors, as doubles."""
    v = F.col(vector_col).cast("array<double>")
    ok = F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(ok).select(F.col(id_col).cast("long").alias("vec_id"), F.size(v).alias("dim"), v.alias("v"))


def top_k(df: DataFrame, k: int = 5, every: int = 50, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by `every`, its k best other rows.

    Components become floor(scale * x). Vectors that are null or empty, hold null or non-finite components, or
    have a null id take no part. Vectors of different lengths are not compared. Ids are whole numbers and an id
    names its row: rows that repeat the query's id count as its own; a query id that repeats is answered once,
    for its smallest vector; other repeated rows are each a candidate. All ties are broken by smaller id; fewer
    than k rows give fewer ranks. Scores are exact integers while ranking, whatever their size; one beyond a long
    is given as the nearest long. An empty table gives no rows. Other columns are not read.
    """
    spark = df.sparkSession
    rows = vectors(df, id_col, vector_col)
    queries = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id", "dim").agg(F.min("v").alias("v"))
    # rows and queries of a length set the numbers of lanes and of query blocks; only counts come to the driver
    sizes = rows.groupBy("dim").agg(F.count("*").alias("rows"), F.count_if(F.col("vec_id") % every == 0).alias("queries")).where("queries > 0").collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shape = spark.createDataFrame([(r["dim"], -(-r["rows"] // (ROW_BLOCK * LANE)), -(-r["queries"] // QUERY_BLOCK)) for r in sizes], "dim int, lanes int, blocks int")

    def row_blocks(batches):
        """Blocks within a lane's sorted rows: one row of (lane, lists) each."""
        held: list[pd.DataFrame] = []
        for pdf in batches:
            for key, part in pdf.groupby(["dim", "lane"], sort=False):
                for at in range(0, len(part), ROW_BLOCK):
                    if held and (key != (held[0]["dim"].iat[0], held[0]["lane"].iat[0]) or sum(map(len, held)) >= ROW_BLOCK):
                        yield packed(held)
                        held = []
                    held.append(part.iloc[at : at + ROW_BLOCK])
        if held:
            yield packed(held)

    def packed(held):
        pdf = pd.concat(held)
        v = np.stack(pdf["v"].to_numpy()).astype(np.float64)
        lists = Lists(pdf["vec_id"].to_numpy(np.int64), v)
        heads = np.array(lists.heads)
        blob = [np.ascontiguousarray(x).tobytes() for x in (lists.ids, lists.v, lists.until, heads)]
        return pd.DataFrame({"dim": pdf["dim"].iat[0], "lane": pdf["lane"].iat[0], "ids": [blob[0]], "v": [blob[1]], "until": [blob[2]], "heads": [blob[3]]})

    lane = F.pmod(F.xxhash64("vec_id", "v"), F.col("lanes")).cast("int")
    dealt = rows.join(shape, "dim").select("dim", lane.alias("lane"), "vec_id", "v").repartition("dim", "lane").sortWithinPartitions("dim", "lane")
    lists = dealt.mapInPandas(row_blocks, "dim int, lane int, ids binary, v binary, until binary, heads binary")
    blocks = lists.join(shape, "dim").withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("lanes", "blocks")
    asked = queries.join(shape, "dim").withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")).withColumn("lane", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)))

    def search(key, qs, vs):
        dim = int(key[0])
        if not len(qs) or not len(vs):
            return pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0, object)})
        qids, q = qs["vec_id"].to_numpy(np.int64), whole(np.stack(qs["v"].to_numpy()).astype(np.float64), scale)
        best = Best(len(qids), k)
        for ids, v, until, heads in zip(vs["ids"], vs["v"], vs["until"], vs["heads"], strict=True):
            threshold_search(qids, q, Lists.read(ids, v, until, heads, dim, scale), best)
        out = [(i, -s, c) for i, held in zip(qids.tolist(), best.held, strict=True) for s, c in held]
        return pd.DataFrame({"query_id": [x[0] for x in out], "vec_id": [x[2] for x in out], "score": [str(x[1]) for x in out]})

    key = ["dim", "qb", "lane"]
    found = asked.select(*key, "vec_id", "v").groupBy(*key).cogroup(blocks.groupBy(*key)).applyInPandas(search, "query_id long, vec_id long, score string")
    # integers of any size in order: sign, number of digits, digits
    minus, digits = F.col("score").startswith("-"), F.ltrim(F.col("score"), F.lit("-"))
    size = F.when(minus, -F.length(digits)).otherwise(F.length(digits))
    value = F.coalesce(F.expr("try_cast(score AS long)"), F.when(minus, F.lit(LONGEST[0])).otherwise(F.lit(LONGEST[1])))
    by = Window.partitionBy("query_id").orderBy(F.desc("size"), F.desc("value"), F.desc("up"), "down", "vec_id")
    ranked = found.select("query_id", "vec_id", size.alias("size"), value.alias("value"), F.when(~minus, digits).alias("up"), F.when(minus, digits).alias("down"))
    return ranked.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", F.col("value").alias("score"))
