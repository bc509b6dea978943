"""Near-duplicate vectors by sorted projection passes.

Each pass has its own random hyperplanes; a vector's key is the concatenation of their sign bits. Vectors of
one label are put in the order of their keys and each is compared with the next `window` vectors. Pairs that
reach the threshold are united over all passes. Where vectors share a direction, sign bits hardly separate them
and windows miss links; so vectors of one label that the passes left in different components are then compared
exactly, in blocks of bounded size, and links found join the components. The links of each vector are counted
exactly inside its component, in blocks too, that give back counts, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import shuffle_partitions, staged
from quillstone.llm.components import Forest, components
from quillstone.llm.tiles import by_key

BITS, CHUNK = 48, 1024
#: A block of a tile holds about so many vectors, and components.
BLOCK, BLOCK_COMPONENTS = 8192, 1 << 22


def hyperplanes(dim: int, index: int) -> np.ndarray:
    return np.random.RandomState(7919 * index + dim).standard_normal((dim, BITS))


def projection_keys(v: np.ndarray, index: int) -> np.ndarray:
    bits = (v @ hyperplanes(v.shape[1], index) > 0).astype(np.int64)
    return bits @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def unit(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled down first, so that squares neither overflow nor vanish."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def window_links(u: np.ndarray, window: int, threshold: float, first: int = 1) -> Iterator[tuple[int, int]]:
    """Positions (i, j), i < j <= i + window, j >= first, whose cosine reaches the threshold."""
    for a in range(0, len(u), CHUNK):
        b = min(len(u), a + CHUNK)
        s = u[a:b] @ u[a : b + window].T >= threshold
        for i, j in zip(*np.nonzero(s), strict=True):
            if 0 < j - i <= window and a + j >= first:
                yield a + int(i), a + int(j)


def _stack(blobs: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)


def vector_duplicates(df: DataFrame, threshold: float = 0.98, passes: int = 12, window: int = 64, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    Rows link if their labels are equal and not null, their vectors have one length, and their cosine in double
    precision is at least the threshold. A vector that is null, empty or zero or holds null or non-finite
    components, a null label or a null id links with nothing: n_links 0, its own component, kept. Equal vectors
    of one label are one class while searching and count as links of one another. n_links counts other (id,
    vector) pairs: rows of one id and different vectors are told apart, repeated rows count once and give equal
    answers. Ids are whole numbers. An empty table gives no rows; other columns are not read. No link is missed,
    whatever the passes bring together: they only save the exact comparison links to give back.
    """
    spark = df.sparkSession
    v = F.col(vector_col).cast("array<double>")
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    able = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0)
    src = src.withColumn("able", F.coalesce(able, F.lit(False))).withColumn("h1", F.xxhash64("label", "v")).withColumn("h2", F.hash("v", "label"))
    label = src.schema["label"].dataType.simpleString()

    def pack(batches):
        for pdf in batches:
            pdf["v"] = [np.asarray(x, np.float64).tobytes() for x in pdf["v"]]
            yield pdf

    grouped = src.where("able").groupBy("label", "h1", "h2").agg(F.min("id").alias("id"), F.count_distinct("id").alias("copies"), F.min("v").alias("v"))
    packed = grouped.select("h1", "h2", "id", "copies", "label", F.size("v").alias("dim"), "v").mapInPandas(pack, f"h1 long, h2 int, id long, copies long, label {label}, dim int, v binary")
    classes = staged(packed.withColumn("node", F.monotonically_increasing_id()), "vectors")

    def keys(batches):
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                u = unit(_stack(part["v"]))
                blobs = [x.tobytes() for x in u]
                for p in range(passes):
                    yield pd.DataFrame({"pass": p, "label": part["label"].to_numpy(), "dim": dim, "key": projection_keys(u, p), "id": part["id"].to_numpy(), "v": blobs})

    shape = f"pass int, label {label}, dim int, key long, id long, v binary"
    order = ["pass", "label", "dim", "key", "id"]
    runs = classes.select(F.col("node").alias("id"), "label", "dim", "v").mapInPandas(keys, shape).repartitionByRange(4 * shuffle_partitions(spark), *order).sortWithinPartitions(*order)

    def compare(batches):
        """Links inside a run; its first and last rows come out too, to be compared across the border."""
        run, found, tail, head = TaskContext.get().partitionId(), Forest(), None, 0
        for pdf in batches:
            if not len(pdf):
                continue
            if head < window:
                yield _border(pdf.iloc[: window - head], run, 0)
                head += len(pdf.iloc[: window - head])
            both = pdf if tail is None else pd.concat([tail, pdf], ignore_index=True)
            _sweep(both, 0 if tail is None else len(tail), window, threshold, found)
            tail = both.iloc[-window:]
        if tail is not None:
            yield _border(tail, run, 1)
        links = found.edges()
        if len(links):
            yield pd.DataFrame({"run": run, "side": -1, "pass": -1, "label": None, "dim": 0, "key": 0, "id": links["a"], "v": None, "b": links["b"]})

    found = staged(runs.mapInPandas(compare, f"run long, side int, {shape}, b long"), "windows")
    borders = found.where("side >= 0")
    numbers = sorted(r["run"] for r in borders.select("run").distinct().collect())  # one number a partition
    before = spark.createDataFrame([(b, a) for a, b in zip(numbers, numbers[1:], strict=False)], "run long, prior long")

    def across(pdf):
        pdf, links = pdf.sort_values(["side", *order], ascending=[False, *[True] * 5], ignore_index=True), Forest()
        _sweep(pdf, 0, window, threshold, links)
        return links.edges()

    # a run's last rows stand under its own number, the next run's first rows under the same
    met = borders.where("side = 1").withColumn("prior", F.col("run")).unionByName(borders.where("side = 0").join(before, "run"))
    joined = met.groupBy("prior").applyInPandas(across, "a long, b long")
    edges = found.where("side = -1").select(F.col("id").alias("a"), "b").unionByName(joined)
    parts = staged(components(edges), "parts")
    missed = staged(_missed_links(classes, parts, threshold), "missed")
    if not missed.isEmpty():
        parts = components(parts.where("id <> component").select(F.col("component").alias("a"), F.col("id").alias("b")).unionByName(missed))
    named = classes.select("node", "h1", "h2", "id", "copies", "dim", "v").join(parts.withColumnRenamed("id", "node"), "node", "left")
    homes = named.where("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("home"))
    counts = _link_counts(named, threshold)
    joined = named.drop("v").join(homes, "component", "left").join(counts, "node", "left")
    answers = joined.select("h1", "h2", F.coalesce("home", "id").alias("component"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    rows = src.select("id", F.when(F.col("able"), F.col("h1")).alias("h1"), F.when(F.col("able"), F.col("h2")).alias("h2"))
    out = rows.join(answers, ["h1", "h2"], "left").select("id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))).withColumnRenamed("id", id_col)


def _border(rows: pd.DataFrame, run: int, side: int) -> pd.DataFrame:
    out = rows.copy()
    out["run"], out["side"], out["b"] = run, side, 0
    return out[["run", "side", "pass", "label", "dim", "key", "id", "v", "b"]]


def _sweep(pdf: pd.DataFrame, first: int, window: int, threshold: float, found: Forest) -> None:
    """Unite linked rows of a sorted frame, group by group; only pairs that end at `first` or later."""
    if not len(pdf):
        return
    kinds, ids = pdf[["pass", "label", "dim"]], pdf["id"].to_numpy()
    change = (kinds != kinds.shift()).any(axis=1).to_numpy()
    cuts = [*np.flatnonzero(change), len(pdf)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b - a > 1 and b > first:
            for i, j in window_links(_stack(pdf["v"].iloc[a:b]), window, threshold, max(1, first - a)):
                found.join(int(ids[a + i]), int(ids[a + j]))


def _blocks(rows, dim):
    """Blocks that hold so many vectors."""
    most = F.least(F.lit(BLOCK), F.greatest(F.floor(F.lit(BLOCK_COMPONENTS) / dim), F.lit(256)))
    return F.ceil(rows / most).cast("int")


def _tiles(members: DataFrame) -> DataFrame:
    """Rows of a group dealt to its tiles (group, lo, hi): every pair of blocks, a block with itself too."""
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lo, hi = F.least("own", "other"), F.greatest("own", "other")
    out = rows.select("group", lo.alias("lo"), hi.alias("hi"), (F.col("own") > lo).alias("second"), "node", "part", "copies", "v")
    return out.repartition("group", "lo", "hi").sortWithinPartitions("group", "lo", "hi")


def _sides(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Unit vectors of a tile, the places of both sides (the same twice for a block with itself), other columns."""
    u = unit(_stack(t.column("v").to_pylist()))
    second = t.column("second").to_numpy()
    left = right = np.arange(len(u))
    if t.column("lo")[0] != t.column("hi")[0]:
        left, right = np.flatnonzero(~second), np.flatnonzero(second)
    return u, left, right, {c: t.column(c).to_numpy() for c in ("node", "part", "copies")}


def _missed_links(classes: DataFrame, parts: DataFrame, threshold: float) -> DataFrame:
    """(a, b): pairs of components that a link between their members joins; all vectors of a label are compared."""
    groups = classes.groupBy("label", "dim").agg(F.min("node").alias("group"), F.count("*").alias("n"))
    groups = groups.select("label", "dim", "group", _blocks(F.col("n"), F.col("dim")).alias("blocks"))
    members = classes.join(parts.withColumnRenamed("id", "node"), "node", "left").join(groups, ["label", "dim"]).withColumn("part", F.coalesce("component", "node"))

    def compare(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        u, left, right, c = _sides(t)
        part, found = c["part"], Forest()
        for k in range(0, len(left), CHUNK):
            some = left[k : k + CHUNK]
            near = (u[some] @ u[right].T >= threshold) & (part[some][:, None] != part[right][None, :])
            i, j = np.nonzero(near)
            for a, b in np.unique(np.stack([part[some[i]], part[right[j]]], axis=1), axis=0).tolist():
                found.join(a, b)
        pairs = found.edges()
        return pairs["a"].to_numpy(), pairs["b"].to_numpy()

    return _tiles(members).mapInArrow(by_key(3, compare, ("a", "b")), "a long, b long").distinct()


def _link_counts(named: DataFrame, threshold: float) -> DataFrame:
    """(node, links): per class, the rows of other classes of its component whose cosine reaches the threshold."""
    members = named.where("component IS NOT NULL")
    sizes = members.groupBy("component").agg(F.count("*").alias("n"), F.max("dim").alias("dim"))
    sizes = sizes.select("component", _blocks(F.col("n"), F.col("dim")).alias("blocks"))
    members = members.join(sizes, "component").withColumn("group", F.col("component")).withColumn("part", F.col("component"))

    def count(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        u, left, right, c = _sides(t)
        copies, links = c["copies"], np.zeros(len(u), np.int64)
        for k in range(0, len(left), CHUNK):
            some = left[k : k + CHUNK]
            near = u[some] @ u[right].T >= threshold
            near &= some[:, None] != right[None, :]
            links[some] += near @ copies[right]
            if left is not right:
                links[right] += copies[some] @ near
        return c["node"], links

    return _tiles(members).mapInArrow(by_key(3, count, ("node", "links")), "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))
