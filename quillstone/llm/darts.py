"""Near-duplicate documents by DartMinHash signatures and a banded join.

A document is a weighted set: its five-word shingles with their counts. Every (shingle, weight cell) owns a
strip of the plane (weight cell x rank axis), and every unit cell of the strip holds a Poisson number of
darts whose coordinate and rank come from hashes alone. A document catches the darts under its weights; per
signature coordinate the dart of least rank stays. Two documents agree in a coordinate with a probability of
their weighted Jaccard similarity. Cells are opened in order of rank until every coordinate is hit, so work
is the larger of the number of shingles and k log k, and nothing depends on other documents.

Coordinates are hashed in bands. Copies of one text are one class first; in a bucket, each class is compared
with the bucket's least. Buckets that then still hold several components are cut into tiles, a block of classes
against another, and a tile works its intersections out as matrix products and gives back links only: no pair
that shares a band goes untested, and no pair becomes a row. A bucket's largest component is not compared with
itself. Links are verified on the whole shingle sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import U64, mix64, staged
from quillstone.llm.components import Forest, components
from quillstone.llm.tiles import by_key
from quillstone.llm.wordhash import run_hashes, run_rows, word_hashes

CELLS = 1 << 20  # hash cells worked on at once
POISSON = np.array([2**64 * sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(12)]).clip(0, 2**64 - 2**12).astype(U64)
GOLD = U64(0x9E3779B97F4A7C15)
#: A block of a tile holds about so many classes and set elements; columns multiplied at once.
BLOCK, BLOCK_ELEMENTS, COLUMNS = 512, 1 << 20, 4096


def elements(per_row: np.ndarray, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, element) of every shingle copy: the kth copy of a shingle is an element of its own.

    A row of 1 to n - 1 words has one shingle, all its words; a row without words has none.
    """
    row, place = run_rows(per_row, n)
    first = np.cumsum(per_row) - per_row
    shingle = run_hashes(words, n)[first[row] + place] if len(row) else np.zeros(0, U64)
    short = np.flatnonzero((per_row > 0) & (per_row < n))
    if len(short):
        extra = np.array([run_hashes(words[first[r] : first[r] + per_row[r]], int(per_row[r]), 1)[0] for r in short], U64)
        row, shingle = np.concatenate([row, short]), np.concatenate([shingle, extra])
    order = np.lexsort((shingle, row))
    row, shingle = row[order], shingle[order]
    new = np.append([True], (np.diff(row) != 0) | (np.diff(shingle) != 0)) if len(row) else np.zeros(0, bool)
    copy = np.arange(len(row)) - np.flatnonzero(new)[np.cumsum(new) - 1] if len(row) else np.zeros(0, int)
    with np.errstate(over="ignore"):
        return row, mix64(shingle + copy.astype(U64) * GOLD)


def _throw(out: np.ndarray, row: np.ndarray, element: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
    """Darts of cells lo to hi of each element's strip; keeps the least rank per (row, coordinate) in out."""
    k = out.shape[1]
    flat, times = out.reshape(-1), hi - lo
    at, done = 0, np.cumsum(times)
    while at < len(element):
        to = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + CELLS, "right")))
        t = times[at:to]
        which = np.repeat(np.arange(at, to), t)
        cell = (np.arange(len(which)) - np.repeat(np.cumsum(t) - t, t) + lo[which]).astype(U64)
        with np.errstate(over="ignore"):
            u = mix64(element[which] + (cell + U64(1)) * GOLD)
            darts = np.searchsorted(POISSON, u, "right")
            hit = np.repeat(np.arange(len(u)), darts)
            number = np.arange(len(hit)) - np.repeat(np.cumsum(darts) - darts, darts)
            g = mix64(u[hit] + (number.astype(U64) + U64(1)) * U64(0xC2B2AE3D27D4EB4F))
        coordinate = ((g & U64(0xFFFFFF)) * U64(k)) >> U64(24)
        rank = (cell[hit] << U64(40)) | (g >> U64(24))
        np.minimum.at(flat, row[which[hit]] * k + coordinate.astype(np.int64), rank)
        at = to


def signatures(rows: int, row: np.ndarray, element: np.ndarray, k: int) -> np.ndarray:
    """rows x k least ranks; a row without elements stays at the largest value."""
    none = np.iinfo(U64).max
    out = np.full((rows, k), none, U64)
    size = np.bincount(row, minlength=rows)
    enough = np.maximum(1, np.ceil(k * (math.log(k) + 3) / np.maximum(size, 1))).astype(np.int64)
    lo, hi = np.zeros(rows, np.int64), enough
    while len(row):
        _throw(out, row, element, lo[row], hi[row])
        open_rows = (out == none).any(axis=1)
        keep = open_rows[row]
        row, element = row[keep], element[keep]
        lo, hi = hi, hi + enough
    return out


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    """rows x bands 64-bit keys; a band's number is part of its key."""
    rows, k = sig.shape
    parts = sig.reshape(rows, bands, k // bands)
    with np.errstate(over="ignore"):
        h = np.broadcast_to(np.arange(1, bands + 1, dtype=U64) * GOLD, (rows, bands))
        for i in range(k // bands):
            h = mix64(h ^ parts[:, :, i])
    return h


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (i in left, j in right) of the sets whose Jaccard similarity reaches the threshold.

    A set is an array of distinct elements. Elements of one set alone only count in its size; the others
    become columns of a 0-1 matrix, some at a time.
    """
    size = np.array([len(x) for x in sets], np.int64)
    element = np.concatenate(sets) if len(sets) else np.zeros(0, U64)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(element, kind="stable")
    element, owner = element[order], owner[order]
    new = np.append([True], element[1:] != element[:-1]) if len(element) else np.zeros(0, bool)
    again = np.zeros(len(element), bool)
    again[1:] = ~new[1:]
    again[:-1] |= ~new[1:]
    column, owner = (np.cumsum(new) - 1)[again], owner[again]
    column = np.cumsum(np.append([0], np.diff(column) != 0)) if len(column) else column
    both = np.zeros((len(left), len(right)))
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (first, first + COLUMNS))
        has = np.zeros((len(sets), int(column[b - 1]) - first + 1), np.float32)
        has[owner[a:b], column[a:b] - first] = 1
        both += has[left] @ has[right].T
    near = both >= threshold * (size[left][:, None] + size[right][None, :] - both)
    near &= both > 0
    return np.nonzero(near)


def near_duplicates(df: DataFrame, words: int = 5, threshold: float = 0.8, bands: int = 25, rows: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, mark, component_id, n_words, kept) of every row: component_id is the smallest id linked to it.

    Documents link if the weighted Jaccard similarity of their shingles (words runs without \\x20, \\x09-\\x0D,
    taken as they are) is at least the threshold; equal texts always do, unless they hold no word. A row
    without words, or of null id, is linked to nothing and kept. mark is a digest of the text: rows of one id
    and different texts are told apart by it when compared, but share the id's component; repeated rows get
    equal answers. Ids are whole numbers. An empty table gives no rows; other columns are not read. A pair at
    the threshold shares no band with a probability below 1 in 20,000; nothing caps a bucket.
    """
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    src = src.select("id", F.xxhash64("text").alias("mark"), F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("digest"), "text")

    def sign(batches):
        for b in batches:
            for row, per_row, w in word_hashes(b.column(3)):
                sig = signatures(len(per_row), *elements(per_row, w, words), bands * rows)
                keys = band_keys(sig, bands).astype(U64).view(np.int64)
                some = per_row > 0
                part = b.slice(row, len(per_row))
                flat = pa.array(keys[some].ravel())
                off = np.concatenate([[0], np.cumsum(some * bands)])
                lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(per_row.astype(np.int64)), lists], ["id", "mark", "digest", "n_words", "keys"])

    signed = staged(src.mapInArrow(sign, "id long, mark long, digest string, n_words long, keys array<long>"), "signed")
    able = signed.where("id IS NOT NULL AND n_words > 0")
    size = F.greatest(F.first("n_words") - (words - 1), F.lit(1)).alias("n")
    classes = staged(able.groupBy("digest").agg(F.min("id").alias("class"), size, F.first("keys").alias("keys")), "classes")
    cells = classes.select(F.col("class").alias("doc"), "n", F.explode("keys").alias("key"))
    # a class with the same id as another (one id, two texts) is one document in the graph
    crowd = cells.groupBy("key").agg(F.min(F.struct("doc", "n")).alias("head"), F.max("doc").alias("last")).where("head.doc < last")
    shared = staged(cells.join(crowd.select("key", F.col("head.doc").alias("head"), F.col("head.n").alias("m")), "key"), "buckets")
    sets = staged(_sets(src, shared.select(F.col("doc").alias("id")).distinct(), words), "sets")
    # the sizes alone rule a pair out
    tight = F.least("n", "m") >= F.greatest("n", "m") * (threshold - 1e-9)
    stars = shared.where("doc > head").where(tight).groupBy("head", "doc").agg(F.max("n").alias("n"))
    links = staged(_links(_star_tiles(staged(stars, "stars")), sets, threshold), "links")
    found = staged(components(links), "parts")
    named = shared.select("key", "doc", "n").join(found.withColumnRenamed("id", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    more = staged(_links(_bucket_tiles(staged(named, "named")), sets, threshold), "across")
    tops = components(more).select(F.col("id").alias("own"), F.col("component").alias("top"))
    joined = signed.select("id", "mark", "digest", "n_words").join(classes.select("digest", "class"), "digest", "left").join(found.withColumnRenamed("id", "class"), "class", "left")
    joined = joined.withColumn("own", F.coalesce("component", "class")).join(tops, "own", "left")
    home = F.when(F.col("id").isNull() | (F.col("n_words") == 0), F.col("id")).otherwise(F.coalesce("top", "own"))
    out = joined.select(F.col("id"), "mark", home.alias("component_id"), "n_words")
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))).withColumnRenamed("id", id_col)


TILE = ["key", "lo", "hi"]


def _blocks(count, elements):
    """Blocks that hold so many classes of so many elements in all."""
    return F.greatest(F.ceil(count / BLOCK), F.ceil(elements / BLOCK_ELEMENTS), F.lit(1)).cast("int")


def _star_tiles(stars: DataFrame) -> DataFrame:
    """(key, lo, hi, side, part, doc): each head against its members, a block of members a tile."""
    heads = stars.groupBy("head").agg(_blocks(F.count("*"), F.sum("n")).alias("blocks"))
    members = stars.join(heads, "head").select(F.col("head").alias("key"), F.lit(0).alias("lo"), F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int").alias("hi"), F.lit(1).alias("side"), F.col("doc").alias("part"), "doc")
    own = heads.select(F.col("head").alias("key"), F.lit(0).alias("lo"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("hi"), F.lit(0).alias("side"), F.col("head").alias("part"), F.col("head").alias("doc"))
    return members.unionByName(own)


def _bucket_tiles(named: DataFrame) -> DataFrame:
    """(key, lo, hi, side, part, doc): the buckets (key, doc, n, component) that hold several components.

    Buckets of the same members are taken once. Classes outside the largest component are compared with one
    another and with that component's; a bucket that fits in a block is one tile.
    """
    digest = F.xxhash64("doc")
    parts = named.groupBy("key", "component").agg(F.count("*").alias("c"), F.sum("n").alias("e"), F.sum(digest.cast("decimal(38,0)")).alias("s"), F.bit_xor(digest).alias("x"))
    largest = F.max(F.struct("c", "e", "component"))
    buckets = parts.groupBy("key").agg(F.count("*").alias("parts"), F.sum("c").alias("c"), F.sum("e").alias("e"), F.sum("s").alias("s"), F.bit_xor("x").alias("x"), largest.alias("most")).where("parts > 1")
    # equal members stand in equal components, so that equal buckets agree in all but the key
    buckets = buckets.groupBy("c", "e", "s", "x", "most").agg(F.min("key").alias("key"))
    small = (F.col("c") <= BLOCK) & (F.col("e") <= BLOCK_ELEMENTS)
    rest = F.when(small, 1).otherwise(_blocks(F.col("c") - F.col("most.c"), F.col("e") - F.col("most.e"))).alias("rest")
    main = F.when(small, 0).otherwise(_blocks(F.col("most.c"), F.col("most.e"))).alias("main")
    rows = named.join(buckets.select("key", rest, main, F.col("most.component").alias("largest")), "key")
    of_main = (F.col("component") == F.col("largest")) & (F.col("main") > 0)
    own = F.when(of_main, F.col("rest") + F.pmod(F.xxhash64("doc"), F.greatest("main", F.lit(1)))).otherwise(F.pmod(F.xxhash64("doc"), F.col("rest"))).cast("int")
    last = F.when(of_main, F.col("rest") - 1).otherwise(F.col("rest") + F.col("main") - 1)
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    lo = F.least("own", "other")
    return rows.select("key", lo.alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("own") > lo).cast("int").alias("side"), F.col("component").alias("part"), "doc")


def _links(tiles: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b): pairs of parts joined by a link between their classes, at most one less than a tile's parts.

    A tile's classes of side 0 are compared with those of side 1, or with one another where there are none.
    """

    def compare(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        side, part = t.column("side").to_numpy(), t.column("part").to_numpy()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(right):
            right = left
        each = [np.frombuffer(x.as_py(), U64) for x in t.column("set")]
        i, j = linked(each, left, right, threshold)
        forest = Forest()
        for a, b in np.unique(np.stack([part[left[i]], part[right[j]]], axis=1), axis=0).tolist():
            if a != b:
                forest.join(a, b)
        pairs = forest.edges()
        return pairs["a"].to_numpy(), pairs["b"].to_numpy()

    rows = tiles.join(sets.withColumnRenamed("id", "doc"), "doc").select(*TILE, "side", "part", "set")
    dealt = rows.repartition(*TILE).sortWithinPartitions(*TILE)
    return dealt.mapInArrow(by_key(len(TILE), compare, ("a", "b")), "a long, b long").distinct()


def _sets(src: DataFrame, needed: DataFrame, words: int) -> DataFrame:
    """(id, set): the sorted elements of every distinct text of the ids asked for."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, per_row, w in word_hashes(b.column(2)):
                row, e = elements(per_row, w, words)
                each = np.split(e, np.cumsum(np.bincount(row, minlength=len(per_row)))[:-1])
                part = b.slice(first, len(per_row))
                for k in range(0, len(each), 500):
                    yield pa.RecordBatch.from_arrays([part.column(0).slice(k, 500), part.column(1).slice(k, 500), pa.array([np.sort(x).tobytes() for x in each[k : k + 500]], pa.binary())], ["id", "digest", "set"])

    texts = src.join(needed, "id", "left_semi").select("id", "digest", "text").mapInArrow(run, "id long, digest string, set binary")
    return texts.dropDuplicates(["id", "digest"]).drop("digest")
