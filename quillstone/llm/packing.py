"""Packing documents into fixed windows by minimum bin slack.

A document's ids are cut into full windows and one remainder. The remainders of a block form a multiset of
lengths; for each window a bitset of reachable sums (bit s is set if some sub-multiset adds up to s) grows
length by length until the capacity, or else the closest sum, is known, and a walk back over the kept
bitsets gives the counts taken of each length. A window that no multiset fills is topped up by cutting one
more remainder; what is left at a block's end, less than a window, becomes windows of power-of-two length,
which need no padding. Blocks lie within input partitions: no shuffle, no state beyond one block.
"""

from __future__ import annotations

import json
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillstone.llm.automaton import byte_letters

#: Remainder bytes held before a block is packed.
BLOCK_BYTES = 32 << 20
# Word pattern of the byte-level files, and how such a file names it; fixed values.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}


class ByteBpe:
    """Little-endian uint32 ids of texts, as the tokenizers library gives them for a byte-level BPE file.

    The file's vocabulary is read as ranks, for the other library, which gives the same ids several times
    faster; that needs ids in merge order. A file that is otherwise goes to the tokenizers library itself.
    """

    def __init__(self, spec: str):
        d = json.loads(spec)
        m = d["model"]
        self.special = {x["content"]: x["id"] for x in d["added_tokens"]}
        self.cut = re.compile("(" + "|".join(re.escape(x) for x in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        joined = [m["vocab"]["".join(x) if isinstance(x, list) else x.replace(" ", "")] for x in m["merges"]]
        if d["pre_tokenizer"] == BYTE_LEVEL and d["normalizer"] is None and joined == sorted(joined) and joined[0] == 256:
            value = {c: i for i, c in enumerate(byte_letters())}
            ranks = {bytes([value[c] for c in t]): i for t, i in m["vocab"].items()}
            self.ordinary = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            tok = Tokenizer.from_str(spec)
            tok.no_truncation()
            tok.no_padding()
            self.cut, self.ordinary = None, lambda text: tok.encode(text, add_special_tokens=False).ids

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text; null is empty. A special token's string in a text is that token."""
        if not text:
            return b""
        if self.cut is None or not self.cut.search(text):
            return array("I", self.ordinary(text)).tobytes()
        ids: list[int] = []
        for piece in self.cut.split(text):
            ids += [self.special[piece]] if piece in self.special else self.ordinary(piece)
        return array("I", ids).tobytes()


_kept: dict[int, ByteBpe] = {}


def byte_bpe(spec: str) -> ByteBpe:
    """The worker's encoder; tasks of one worker share it."""
    key = hash(spec)
    if key not in _kept:
        _kept.clear()
        _kept[key] = ByteBpe(spec)
    return _kept[key]


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Counts per length of a sub-multiset whose sum is the largest that fits the capacity."""
    mask, bits, steps = (1 << (capacity + 1)) - 1, 1, []
    for length in sorted(counts, reverse=True):
        for _ in range(min(counts[length], capacity // length)):
            grown = bits | (bits << length) & mask
            if grown == bits:
                break
            steps.append((length, bits))
            bits = grown
        if bits >> capacity & 1:
            break
    at, taken = bits.bit_length() - 1, defaultdict(int)
    for length, before in reversed(steps):
        if not before >> at & 1:
            taken[length] += 1
            at -= length
    return dict(taken)


def plan(lengths: dict[int, int], capacity: int) -> Iterator[list[int]]:
    """Windows as lists of remainder lengths; all but the last reach the capacity or take all that is left.

    A negative last entry -n asks for n ids cut off one more remainder, the longest left.
    """
    counts = {k: v for k, v in lengths.items() if v}
    total = sum(k * v for k, v in counts.items())
    while counts:
        if total < capacity:
            yield [k for k, v in counts.items() for _ in range(v)]
            return
        taken = fill(counts, capacity)
        slack = capacity - sum(k * v for k, v in taken.items())
        times = 1 if slack else min(counts[k] // v for k, v in taken.items())
        window = [k for k, v in taken.items() for _ in range(v)]
        total -= capacity * times  # a window that has slack is topped up
        for k, v in taken.items():
            counts[k] -= v * times
            if not counts[k]:
                del counts[k]
        for _ in range(times - 1):
            yield window
        if slack:
            longest = max(counts)
            counts[longest] -= 1
            if not counts[longest]:
                del counts[longest]
            counts[longest - slack] = counts.get(longest - slack, 0) + 1
            window = [*window, -slack]
        yield window


class Packer:
    """Pieces (doc, start, ids, doc_tokens, sequence, offset) of one partition."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.sequence = capacity, first_sequence
        self.rest: dict[int, list[tuple]] = defaultdict(list)
        self.held = 0

    def add(self, doc, ids: bytes) -> Iterator[tuple]:
        n, size = len(ids) // 4, self.capacity
        for start in range(0, n - size + 1, size):
            yield doc, start, ids[4 * start : 4 * (start + size)], n, self.sequence, 0
            self.sequence += 1
        if r := n % size:
            self.rest[r].append((doc, n - r, ids[4 * (n - r) :], n))
            self.held += 4 * r
        if self.held >= BLOCK_BYTES:
            yield from self.flush(False)

    def _cut(self, n: int, longest: int) -> tuple:
        doc, start, ids, total = self.rest[longest].pop()
        self.rest[longest - n].append((doc, start + n, ids[4 * n :], total))
        return doc, start, ids[: 4 * n], total

    def flush(self, last: bool) -> Iterator[tuple]:
        """Pack what is held; unless last, a final window that isn't full waits for the next block."""
        waiting: list[tuple] = []
        for window in plan({k: len(v) for k, v in self.rest.items()}, self.capacity):
            pieces = [self.rest[k].pop() for k in window if k > 0]
            if window[-1] < 0:
                pieces.append(self._cut(-window[-1], max(k for k, v in self.rest.items() if v)))
            if sum(len(p[2]) for p in pieces) == 4 * self.capacity:
                yield from self._place(pieces)
            else:
                waiting = pieces
        self.rest.clear()
        self.held = 0
        if last:
            yield from self._powers(waiting)
            return
        for p in waiting:
            self.rest[len(p[2]) // 4].append(p)
            self.held += len(p[2])

    def _powers(self, pieces: list[tuple]) -> Iterator[tuple]:
        left = sum(len(p[2]) for p in pieces) // 4
        while left:
            room, window = 1 << (left.bit_length() - 1), []
            left -= room
            while room:
                doc, start, ids, total = pieces.pop()
                n = min(room, len(ids) // 4)
                window.append((doc, start, ids[: 4 * n], total))
                if 4 * n < len(ids):
                    pieces.append((doc, start + n, ids[4 * n :], total))
                room -= n
            yield from self._place(window)

    def _place(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids, total in pieces:
            yield doc, start, ids, total, self.sequence, offset
            offset += len(ids) // 4
        self.sequence += 1


def pack_documents(df: DataFrame, tokenizer_json: str, capacity: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents: id, start, length, ids (binary, little-endian uint32), doc_tokens, sequence_id, offset.

    Each document is its ids and then end_id; a null or empty text is end_id alone. Nulls and repeats in
    the id column pass through, each row being a document of its own; other columns are not read. An empty
    table gives no rows. sequence_id is the input partition's number times 2^40 plus a count, so a task that
    runs again names the same windows; capacity must be a power of two.
    """
    spec = df.sparkSession.sparkContext.broadcast(tokenizer_json)
    end = end_id.to_bytes(4, "little")
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        bpe, packer, kind = byte_bpe(spec.value), Packer(capacity, TaskContext.get().partitionId() << 40), None

        def rows(pieces):
            doc, start, ids, total, seq, off = zip(*pieces, strict=True)
            long = pa.int64()
            return pa.RecordBatch.from_arrays([pa.array(doc, kind), pa.array(start, long), pa.array([len(i) // 4 for i in ids], long), pa.array(ids, pa.binary()), pa.array(total, long), pa.array(seq, long), pa.array(off, long)], names)

        def pieces():
            nonlocal kind
            for b in batches:
                kind = b.schema.field(0).type
                for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    yield from packer.add(i, bpe.encode(t) + end)
            yield from packer.flush(True)

        held, size = [], 0
        for p in pieces():
            held.append(p)
            size += len(p[2])
            if size >= 8 << 20:
                yield rows(held)
                held, size = [], 0
        if held:
            yield rows(held)

    kind = src.schema["id"].dataType.simpleString()
    out = src.mapInArrow(run, f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)
