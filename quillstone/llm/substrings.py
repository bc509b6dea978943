"""Removal of word windows that also start in an earlier document.

1. Every partition sketches its windows in a count-min table (two rows of cells, a cell knows 0, 1 or "2 and
   more"). Only the cells that were hit travel, as gaps between sorted cell numbers, and they are merged by
   cell range, streaming. Its width follows the text's bytes, up to 2 * 2^width_bits bits for any larger input.
2. A window whose smallest cell says "once" is unique: an estimate is never too low, so none is lost. The rest
   are grouped by a 128-bit digest of their words (made of the words' own 128-bit digests): a block settles what it can by itself and sends one document per key.
3. Answers go back by block, become one row a document, and are joined to the texts.

The table is broadcast; its size is the parameter, not the data. On an input much larger than 2^width_bits
windows more unique windows reach step 2; results stay the same.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import U64, mix64, shuffle_partitions
from quillstone.llm.wordhash import run_hashes, run_rows, word_hashes

#: The table is cut into at least this many ranges of cells, a merging task each and row.
RANGES = 32
#: A block is full when it holds so many windows, or the documents of so many rows.
BLOCK_WINDOWS, BLOCK_DOCUMENTS = 2_000_000, 500_000
WORD = re.compile("[^ \t-\r]+")


def squeeze(a: np.ndarray) -> bytes:
    """Compress an array byte plane by byte plane; an empty array is no bytes."""
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(len(a), -1).T.tobytes()) if len(a) else b""


def expand(data: bytes, kind) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=1 << 31), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def squeeze_sorted(a: np.ndarray) -> bytes:
    return squeeze(np.diff(a.astype(np.uint32), prepend=np.uint32(0)))


def expand_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(expand(data, np.uint32), dtype=np.uint32)


class Windows:
    """Windows of a block of documents: the keys of all of them, or all that is known of those that `table` lets pass."""

    def __init__(self, n: int, table: Table | None = None):
        self.n, self.table = n, table
        self.clear()

    def clear(self) -> None:
        self.ids: list = []
        self.marks: list = []
        self.doc, self.place, self.key, self.key2 = [], [], [], []
        self.size = 0

    def add(self, batch: pa.RecordBatch) -> Iterator[None]:
        """Take a batch of (id, mark, text), pausing whenever the block is full."""
        ids, marks = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
        for row, per_row, words in word_hashes(batch.column(2)):
            base = len(self.ids)
            r, place = run_rows(per_row, self.n)
            at = (np.cumsum(per_row) - per_row)[r] + place
            key = run_hashes(words, self.n, 0)[at] if len(at) else np.zeros(0, U64)
            if self.table:
                self.ids.extend(ids[row : row + len(per_row)].tolist())
                self.marks.extend(marks[row : row + len(per_row)].tolist())
                some = np.flatnonzero(self.table.repeated(key))
                r, place, at, key = r[some], place[some], at[some], key[some]
                if len(at):
                    self.doc.append((r + base).astype(np.uint32))
                    self.place.append(place.astype(np.uint32))
                    self.key2.append(run_hashes(words, self.n, 1)[at])
            if len(key):
                self.key.append(key)
                self.size += len(key)
            if self.size >= BLOCK_WINDOWS or len(self.ids) >= BLOCK_DOCUMENTS:
                yield
                self.clear()


def _cells(key: np.ndarray, row: int, bits: int) -> np.ndarray:
    return ((key >> U64(32 * row)) & U64((1 << bits) - 1)).astype(np.uint32)


def table_shape(src: DataFrame, width_bits: int) -> tuple[int, int]:
    """(bits, ranges): twice the cells that the text's bytes can hold windows of common length, at most
    2^width_bits, and so many ranges that a merging task takes some 2^23 windows."""
    octets = src.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    wanted = math.ceil(math.log2(octets / 4 + 1)) if octets else 0
    bits = min(width_bits, max(20, wanted))
    return bits, RANGES << max(0, min(wanted - 28, 7, bits - 8))


def sketch(src: DataFrame, n: int, bits: int, ranges: int) -> list[bytes]:
    """The merged table: per row and cell range, a compressed bitmap of the cells hit more than once."""
    span = bits - ranges.bit_length() + 1

    def out(w: Windows):
        if not w.size:
            return
        key, rows = np.concatenate(w.key), []
        for row in (0, 1):
            c = np.sort(_cells(key, row, bits))
            c = c[np.append([True, True], c[2:] != c[:-2])] if len(c) > 2 else c  # two hits say as much as more
            cut = np.searchsorted(c >> np.uint32(span), np.arange(ranges + 1))
            rows += [(row * ranges + k, squeeze_sorted(c[a:b])) for k, (a, b) in enumerate(zip(cut, cut[1:], strict=False)) if b > a]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["part", "data"])

    def local(batches):
        w = Windows(n)
        for b in batches:
            for _ in w.add(b):
                yield from out(w)
        yield from out(w)

    def merge(batches):
        now, once, more = None, None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([zstandard.ZstdCompressor(level=1).compress(np.packbits(more).tobytes())], pa.binary())], ["part", "data"])

        for b in batches:
            for part, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if part != now:
                    if now is not None:
                        yield done()
                    now, once, more = part, np.zeros(1 << span, bool), np.zeros(1 << span, bool)
                c = expand_sorted(data.as_py()) & np.uint32((1 << span) - 1)
                again = np.append([False], c[1:] == c[:-1])
                more[c[again]] = True
                c = c[~again]
                more[c[once[c]]] = True
                once[c] = True
        if now is not None:
            yield done()

    hit = src.mapInArrow(local, "part int, data binary").repartition(2 * ranges, "part").sortWithinPartitions("part")
    table = [b""] * (2 * ranges)
    for r in hit.mapInArrow(merge, "part int, data binary").collect():  # bounded by the table's size
        table[r["part"]] = bytes(r["data"])
    return table


class Table:
    def __init__(self, parts: list[bytes], bits: int, ranges: int):
        self.bits = bits
        size = (1 << bits) // ranges // 8
        self.rows = [np.concatenate([np.frombuffer(zstandard.ZstdDecompressor().decompress(p, max_output_size=size), np.uint8) if p else np.zeros(size, np.uint8) for p in parts[r * ranges : (r + 1) * ranges]]) for r in (0, 1)]

    def repeated(self, key: np.ndarray) -> np.ndarray:
        """Windows whose smallest counter is two or more."""
        ok = np.ones(len(key), bool)
        for row, bitmap in enumerate(self.rows):
            c = _cells(key, row, self.bits)
            ok &= (bitmap[c >> np.uint32(3)] >> (np.uint8(7) - (c & np.uint32(7)).astype(np.uint8))) & np.uint8(1) == 1
        return ok


FOUND = "shard int, block long, ids binary, marks binary, doc binary, place binary, key binary, key2 binary"
NAMES = [x.split()[0] for x in FOUND.split(", ")]


def _found_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 6]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], NAMES)


def _spans(doc: np.ndarray, place: np.ndarray) -> tuple[bytes, bytes]:
    """Documents ascending and places ascending within each, packed as gaps."""
    gap = np.diff(place.astype(np.int64), prepend=0)
    new = np.diff(doc, prepend=np.uint32(0xFFFFFFFF)) != 0
    gap[new] = place[new]
    return squeeze_sorted(doc), squeeze(gap.astype(np.uint32))


def _unspan(doc: bytes, gap: bytes) -> tuple[np.ndarray, np.ndarray]:
    d, g = expand_sorted(doc), expand(gap, np.uint32).astype(np.int64)
    total = np.cumsum(g)
    first = np.flatnonzero(np.diff(d, prepend=np.uint32(0xFFFFFFFF)) != 0)
    return d, (total - np.repeat((total - g)[first], np.diff(np.append(first, len(d))))).astype(np.uint32)


def later(ids: np.ndarray, key: np.ndarray, key2: np.ndarray) -> np.ndarray:
    """Which windows stand in a document of larger id than another window of their two keys."""
    order = np.lexsort((ids, key2, key))
    new = np.ones(len(ids), bool)
    new[1:] = (np.diff(key[order]) != 0) | (np.diff(key2[order]) != 0)
    ids = ids[order]
    gone = np.zeros(len(ids), bool)
    gone[order] = ids > ids[np.flatnonzero(new)][np.cumsum(new) - 1]
    return gone


def repeated_places(src: DataFrame, n: int, width_bits: int) -> DataFrame:
    """(id, mark, places): per document the window places that also start in a document of smaller id."""
    spark = src.sparkSession
    shape = table_shape(src, width_bits)
    table = spark.sparkContext.broadcast((sketch(src, n, *shape), *shape))
    shards = max(shuffle_partitions(spark), 2 * src.rdd.getNumPartitions())

    def ask(batches):
        w, block = Windows(n, Table(*table.value)), TaskContext.get().partitionId() << 24

        def out():
            nonlocal block
            if not w.size:
                return
            key, key2, doc, place = (np.concatenate(x) for x in (w.key, w.key2, w.doc, w.place))
            w.key, w.key2, w.doc, w.place = [], [], [], []
            ids = np.array(w.ids, np.int64)
            gone = later(ids[doc], key, key2)  # settled here
            rows = [(-1, block, ids.tobytes(), np.array(w.marks, np.int64).tobytes(), *_spans(doc[gone], place[gone]), b"", b"")]
            left = np.flatnonzero(~gone)
            shard = (mix64(key[left]) % U64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            left, cut = left[order], np.searchsorted(shard[order], np.arange(shards + 1))
            for s in range(shards):
                x = left[cut[s] : cut[s + 1]]
                if len(x):
                    used, small = np.unique(doc[x], return_inverse=True)
                    rows.append((s, block, ids[used].tobytes(), squeeze(used), *_spans(small.astype(np.uint32), place[x]), key[x].tobytes(), key2[x].tobytes()))
            for k in range(0, len(rows), 64):
                yield _found_rows(rows[k : k + 64])
            block += 1

        for b in batches:
            for _ in w.add(b):
                yield from out()
        yield from out()

    def settle(batches):
        for rows in _by_shard(batches):
            asked = [r for r in rows if r[0] >= 0]
            yield from (_found_rows([r]) for r in rows if r[0] < 0)
            if not asked:
                continue
            got = [_unspan(r[4], r[5]) for r in asked]
            docs = [np.frombuffer(r[2], np.int64)[d] for r, (d, _) in zip(asked, got, strict=True)]
            doc, key, key2 = np.concatenate(docs), np.concatenate([np.frombuffer(r[6], U64) for r in asked]), np.concatenate([np.frombuffer(r[7], U64) for r in asked])
            gone = later(doc, key, key2)
            at = 0
            for r, (d, place) in zip(asked, got, strict=True):
                x = gone[at : at + len(d)]
                at += len(d)
                if x.any():
                    yield _found_rows([(r[0], r[1], b"", b"", *_spans(expand(r[3], np.uint32)[d[x]], place[x]), b"", b"")])

    def answer(batches):
        for rows in _by_block(batches):
            own = next(r for r in rows if r[0] < 0)
            ids, marks = np.frombuffer(own[2], np.int64), np.frombuffer(own[3], np.int64)
            got = [_unspan(r[4], r[5]) for r in rows if r[4]]
            if not got:
                continue
            doc, place = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
            order = np.lexsort((place, doc))
            doc, place = doc[order], place[order]
            first = np.flatnonzero(np.diff(doc, prepend=np.uint32(0xFFFFFFFF)) != 0)
            each = np.split(place, first[1:]) if len(first) else []
            for k in range(0, len(first), 1000):
                d = doc[first[k : k + 1000]]
                yield pa.RecordBatch.from_arrays([pa.array(ids[d]), pa.array(marks[d]), pa.array([squeeze_sorted(p) for p in each[k : k + 1000]], pa.binary())], ["id", "mark", "places"])

    asked = src.mapInArrow(ask, FOUND)
    spread = F.when(F.col("shard") >= 0, F.col("shard")).otherwise(F.pmod(F.col("block"), F.lit(shards)).cast("int"))
    settled = asked.withColumn("to", spread).repartition(shards, "to").sortWithinPartitions("shard").drop("to").mapInArrow(settle, FOUND)
    answers = settled.repartition(shards, "block").sortWithinPartitions("block").mapInArrow(answer, "id long, mark long, places binary")
    return answers.dropDuplicates(["id", "mark"])


def _by(column: int):
    def group(batches) -> Iterator[list[tuple]]:
        now, rows = None, []
        for b in batches:
            cols = [b.column(k).to_pylist() for k in range(8)]
            for r in zip(*cols, strict=True):
                if rows and r[column] != now:
                    yield rows
                    rows = []
                now = r[column]
                rows.append(r)
        if rows:
            yield rows

    return group


_by_shard, _by_block = _by(0), _by(1)


def cut_words(text: str | None, places: bytes | None, n: int) -> tuple[str, int, int]:
    """(kept words joined by a space, number of words, number removed)."""
    words = WORD.findall(text or "")
    if places is None:
        return " ".join(words), len(words), 0
    edge = np.zeros(len(words) + 1, np.int32)
    at = expand_sorted(places)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + np.uint32(n), -1)
    keep = np.cumsum(edge[:-1]) == 0
    return " ".join([words[k] for k in np.flatnonzero(keep)]), len(words), int(len(words) - keep.sum())


def remove_repeats(df: DataFrame, n: int = 13, width_bits: int = 28, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """(id, text, n_words, n_removed, carried columns): texts without the words covered by a repeated window.

    A window is n consecutive words (runs without \\x20, \\x09-\\x0D) of one row. It counts as repeated if its
    words also start in a row of smaller id; windows are judged on the input. Kept words are joined by one
    space. Null and empty texts give "" and 0 words; a row of null id is neither source nor cut; rows of one id
    are never repeats of one another, and repeated rows are cut alike. An empty table gives no rows. Columns
    other than `carry` are not read.
    """
    carried = [F.col(c).alias(f"c{k}") for k, c in enumerate(carry)]
    src = df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("mark"), F.col(text_col).cast("string").alias("text"), *carried)
    found = repeated_places(src.where("id IS NOT NULL").select("id", "mark", "text"), n, width_bits)
    joined = src.join(found, ["id", "mark"], "left").select("id", "text", "places", *[f"c{k}" for k in range(len(carry))])

    def run(batches):
        for b in batches:
            out = [cut_words(t, p, n) for t, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            arrays = [b.column(0), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.int64()), *b.columns[3:]]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "text", "n_words", "n_removed", *b.schema.names[3:]])

    more = "".join(f", c{k} {joined.schema[f'c{k}'].dataType.simpleString()}" for k in range(len(carry)))
    out = joined.mapInArrow(run, f"id long, text string, n_words long, n_removed long{more}")
    return out.select(F.col("id").alias(id_col), F.col("text").alias(text_col), "n_words", "n_removed", *[F.col(f"c{k}").alias(c) for k, c in enumerate(carry)])
