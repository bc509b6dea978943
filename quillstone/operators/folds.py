"""Ordered folds: greedy packing and splitting whose next step depends on the state so far.

A fold streams rows of a group in order with a few numbers of state; nothing of a group is gathered. Only
sizes and keys travel, never texts. Groups run side by side; within one group the rule itself is sequential.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions.text import SPACE


def fold(df: DataFrame, group: list[str], order: list, start: Callable[[], object], step: Callable[[object, dict], object], fields: dict[str, str], names: list[str]) -> DataFrame:
    """Adds the columns `names` (typed by `fields`): step(state, row) gives their values row by row, in order."""
    schema = df.schema
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields] + [f"`{n}` {fields[n]}" for n in names])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                key = tuple(row[g] for g in group)
                if state is None or key != now:
                    now, state = key, start()
                out.append(step(state, row))
            yield pdf.assign(**{n: [o[k] for o in out] for k, n in enumerate(names)})

    # the group columns come first in the sort, so a group is one run of rows
    dealt = df.repartition(*[F.col(g) for g in group]) if group else df.repartition(1)  # sizes and keys of all rows pass one task; what made them does not
    return dealt.sortWithinPartitions(*group, *order).mapInPandas(run, ddl)


def assign_batches(items: DataFrame, max_items: int, max_kb: float, order: list[str], size: str = "size_kb", group: list[str] | None = None) -> DataFrame:
    """Adds batch: items in order fill a batch up to max_items and max_kb; a larger item is a batch alone."""

    def start():
        return {"batch": -1, "n": 0, "kb": 0.0, "open": False}

    def step(s, row):
        kb = row[size]
        if kb > max_kb:
            s.update(batch=s["batch"] + 1, n=0, kb=0.0, open=False)
        else:
            if not s["open"] or s["n"] >= max_items or s["kb"] + kb > max_kb:
                s.update(batch=s["batch"] + 1, n=0, kb=0.0, open=True)
            s["n"] += 1
            s["kb"] += kb
        return (s["batch"],)

    return fold(items, group or [], order, start, step, {"batch": "long"}, ["batch"])


def assign_volumes(units: DataFrame, max_bytes: int, order: list[str], size: str = "bytes", group: str = "topic") -> DataFrame:
    """Adds volume (from 1): a topic of at most max_bytes, joined by blank lines, is one; else units fill volumes in order."""
    total = units.groupBy(group).agg((F.sum(size) + 2 * (F.count("*") - 1)).alias("whole"))

    def start():
        return {"volume": 1, "bytes": 0, "n": 0}

    def step(s, row):
        if row["whole"] > max_bytes:
            if s["n"] and s["bytes"] + row[size] + 2 > max_bytes:
                s.update(volume=s["volume"] + 1, bytes=0, n=0)
            s["n"] += 1
            s["bytes"] += row[size] + 2
        return (s["volume"],)

    return fold(units.join(total, group), [group], order, start, step, {"volume": "int"}, ["volume"]).drop("whole")


#: Kinds of pieces: a paragraph, the first line of an over-long paragraph, a later line.
PARAGRAPH, FIRST, LINE = 0, 1, 2


def chunk_starts(sizes: Iterable[int], kinds: Iterable[int], max_bytes: int) -> list[int]:
    """Which pieces of a text, counted from 1, begin a chunk; a paragraph counts 2 bytes more, a line 1."""
    starts: list[int] = []
    held, used = False, 0
    for k, (size, kind) in enumerate(zip(sizes, kinds, strict=True), 1):
        alone = kind != PARAGRAPH and size > max_bytes
        over = used + size + (2 if kind == PARAGRAPH else 1) > max_bytes
        if not held or alone or kind == FIRST or over:
            starts.append(k)
            used = 0
        held = not alone
        if held:
            used += size + (2 if kind == PARAGRAPH else 1)
    return starts


def split_text(text: str, max_bytes: int) -> list[str]:
    """Chunks of a text at blank lines, over-long paragraphs at line feeds; an over-long line is a chunk alone.

    All pieces of a chunk are joined by blank lines, lines too.
    """
    import re

    if len(text.encode()) <= max_bytes:
        return [text]
    pieces: list[tuple[str, int]] = []
    for paragraph in re.split(r"\n\s*\n", text):
        if len(paragraph.encode()) <= max_bytes:
            pieces.append((paragraph, PARAGRAPH))
        else:
            pieces += [(line, LINE if k else FIRST) for k, line in enumerate(paragraph.split("\n"))]
    starts = chunk_starts([len(t.encode()) for t, _ in pieces], [kind for _, kind in pieces], max_bytes)
    return ["\n\n".join(t for t, _ in pieces[a - 1 : b - 1]) for a, b in zip(starts, [*starts[1:], len(pieces) + 1], strict=True)]


def split_large(texts: DataFrame, key: str, text: str, max_kb: float) -> DataFrame:
    """(key, chunk_index, chunk_total, chunk) as split_text cuts them; rows at or under the limit are one chunk.

    Texts never leave the JVM: Python is sent the sizes of a text's pieces (four times the size, plus the kind).
    """
    limit = int(max_kb * 1024)

    @F.pandas_udf("array<int>")
    def starts(c: pd.Series) -> pd.Series:
        return c.map(lambda x: chunk_starts((x >> 2).tolist(), (x & 3).tolist(), limit))

    src = texts.select(key, F.coalesce(F.col(text), F.lit("")).alias("t"))
    small = src.where(F.octet_length("t") <= limit).select(key, F.lit(1).alias("chunk_index"), F.lit(1).alias("chunk_total"), F.col("t").alias("chunk"))

    def piece(t: Column, kind: Column | int) -> Column:
        return F.struct(t.alias("t"), (F.octet_length(t).cast("long") * 4 + kind).alias("size"))

    def pieces(t: Column) -> Column:
        lines = F.transform(F.split(t, "\n"), lambda x, k: piece(x, F.when(k == 0, FIRST).otherwise(LINE)))
        return F.when(F.octet_length(t) <= limit, F.array(piece(t, F.lit(PARAGRAPH)))).otherwise(lines)

    large = src.where(F.octet_length("t") > limit).select(key, F.flatten(F.transform(F.split("t", rf"\n{SPACE}*\n"), pieces)).alias("p"))
    large = large.withColumn("s", starts(F.col("p.size")))
    end = lambda k: F.coalesce(F.get("s", k + 1), F.size("p") + 1)
    chunks = F.transform("s", lambda s, k: F.array_join(F.slice(F.col("p.t"), s, end(k) - s), "\n\n"))
    large = large.select(key, F.size("s").alias("chunk_total"), F.posexplode(chunks).alias("i", "chunk")).select(key, (F.col("i") + 1).alias("chunk_index"), "chunk_total", "chunk")
    return small.unionByName(large)


def merge_adjacent(sizes: list[float], limit: float) -> list[list[int]]:
    """Rounds of merging neighbours while two together stay in the limit; groups of positions, in order."""
    items = [([i], s) for i, s in enumerate(sizes)]
    while len(items) > 1:
        out, merged, i = [], False, 0
        while i < len(items):
            if i + 1 < len(items) and items[i][1] + items[i + 1][1] <= limit:
                out.append((items[i][0] + items[i + 1][0], items[i][1] + items[i + 1][1]))
                merged, i = True, i + 2
            else:
                out.append(items[i])
                i += 1
        items = out
        if not merged:
            break
    return [g for g, _ in items]


def merge_reduce(parts: DataFrame, group: str, order: list[str], size: str, limit: float) -> DataFrame:
    """(group, merged, position...): which neighbours a pairwise merge-reduce of a group's parts joins.

    A group is one topic's model answers, a handful of rows; Python is sent their sizes alone, many groups at once.
    """

    @F.pandas_udf("array<int>")
    def merged(sizes: pd.Series) -> pd.Series:
        def one(x):
            groups = merge_adjacent(x.tolist(), limit)
            return [k for k, members in enumerate(groups) for _ in members]

        return sizes.map(one)

    rest = [c for c in parts.columns if c != group]
    gathered = parts.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(*[x for c in order for x in (F.col(c).isNull().alias(f"{c} last"), F.col(c))], *[c for c in rest if c not in order]))).alias("rows"))
    found = gathered.withColumn("merged", merged(F.col(f"rows.{size}")))
    each = found.select(group, F.explode(F.arrays_zip("rows", "merged")).alias("z"))
    return each.select(*[F.col(group) if c == group else F.col(f"z.rows.{c}").alias(c) for c in parts.columns], F.col("z.merged").alias("merged"))
