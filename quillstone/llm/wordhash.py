"""Word digests and word-run hashes over Arrow string columns."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

from quillstone.llm.common import U64, mix64

#: Bytes are worked on in slices of about this many, so that work arrays stay small.
SLICE_BYTES = 1 << 20
#: Words of more bytes are digested one by one.
LONG = 64
BLANKS = b" \t\n\v\f\r"  # \x20 and \x09-\x0D

_rng = np.random.RandomState(20240601)
COEFFICIENTS = (_rng.randint(0, 1 << 62, (2, 256)).astype(U64) << U64(2)) | U64(1)
#: A random 128-bit number (two lanes) for every place and byte; a word's digest is the sum of its letters'.
#: Any two words differ in a place, so for random numbers their digests are equal with probability 2^-128.
LETTERS = np.frombuffer(_rng.bytes(2 * 8 * LONG * 256), U64).reshape(2, LONG * 256).copy()
_blank = np.zeros(256, bool)
_blank[list(BLANKS)] = True
LETTERS.reshape(2, LONG, 256)[:, :, _blank] = 0


def word_hashes(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, words per row, digest lanes) slice by slice; words are runs without \\x20, \\x09-\\x0D.

    lanes has a row of two 64-bit numbers a word.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    texts = pa.concat_arrays([texts])
    off = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None and off[-1] else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        to = max(row + 1, int(np.searchsorted(off, off[row] + SLICE_BYTES, "right")) - 1)
        to = min(to, len(texts))
        if off[to] - off[row] <= SLICE_BYTES:
            yield row, *_slice(raw[off[row] : off[to]], off[row : to + 1] - off[row])
        else:  # one long text
            parts = [_slice(x, np.array([0, len(x)]))[1] for x in _pieces(raw[off[row] : off[to]])]
            yield row, np.array([sum(map(len, parts))]), np.concatenate(parts)
        row = to


def _pieces(b: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in slices that end at a blank or at the text's end."""
    at = 0
    while at < len(b):
        to = at + SLICE_BYTES
        while to < len(b) and not (gap := _blank[b[to : to + SLICE_BYTES]]).any():
            to += SLICE_BYTES
        to = to + int(gap.argmax()) if to < len(b) else len(b)
        yield b[at:to]
        at = to


def _slice(b: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(b)
    full = ~_blank[b]
    begin = full.copy()
    begin[1:] &= ~full[:-1]
    edge = off[:-1][off[:-1] < n]
    begin[edge] = full[edge]
    starts = np.flatnonzero(begin).astype(np.int32)
    per_row = np.diff(np.searchsorted(starts, off))
    lanes = np.zeros((len(starts), 2), U64)
    if not len(starts):
        return per_row, lanes
    place = np.arange(starts[0], n, dtype=np.int32)
    place -= np.repeat(starts, np.diff(np.append(starts, np.int32(n))))
    long = np.flatnonzero(full[starts[0] :] & (place >= LONG))
    np.minimum(place, LONG - 1, out=place)
    place <<= 8
    place |= b[starts[0] :]
    for k in (0, 1):  # blanks count nothing, so a word's sum may run on to the next word
        lanes[:, k] = np.add.reduceat(LETTERS[k].take(place), starts - starts[0])
    for w in np.unique(np.searchsorted(starts, long + starts[0], "right") - 1) if len(long) else ():
        end = int(starts[w + 1]) if w + 1 < len(starts) else n
        lanes[w] = np.frombuffer(blake2b(b[starts[w] : end].tobytes().rstrip(BLANKS), digest_size=16).digest(), U64)
    return per_row, lanes


def run_hashes(lanes: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """64-bit hash of each run of n consecutive words from one lane of their digests; runs are not cut at rows.

    The two lanes give independent hashes, so both together are a 128-bit digest of a run's words.
    """
    words = np.ascontiguousarray(lanes[:, which])
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        out = np.zeros(m, U64)
        for k in range(n):
            out += words[k : k + m] * COEFFICIENTS[which, k]
    return mix64(out)


def run_rows(per_row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, place in row) of each run of n words that lies in one row, in run order."""
    runs = np.maximum(per_row - n + 1, 0)
    row = np.repeat(np.arange(len(per_row)), runs)
    place = np.arange(len(row)) - np.repeat(np.cumsum(runs) - runs, runs)
    return row, place
