"""Comparing groups of any size in tiles of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Pairs of numbers gathered before they are sent as one batch.
GATHERED = 4096


def by_key(keys: int, work: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]], names: tuple[str, str]):
    """For mapInArrow: work on the rows of each key (the first columns, integers without nulls) in turn.

    Batches come sorted by the key. work gives two columns of longs; only one key's rows are held.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        out: list[tuple[np.ndarray, np.ndarray]] = []
        last = None

        def sent() -> pa.RecordBatch:
            cols = [np.concatenate([x[k] for x in out]).astype(np.int64) for k in (0, 1)]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], list(names))

        for b in batches:
            if not len(b):
                continue
            cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
            cuts = [0, *(np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1), len(b)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if held and (s or tuple(c[0] for c in cols) != last):
                    out.append(work(pa.Table.from_batches(held)))
                    held = []
                    if sum(len(x[0]) for x in out) >= GATHERED or len(out) >= GATHERED:
                        yield sent()
                held.append(b.slice(s, e - s))
            last = tuple(c[-1] for c in cols)
        if held:
            out.append(work(pa.Table.from_batches(held)))
        if out:
            yield sent()

    return run
