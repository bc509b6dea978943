"""Prompts, judges and verdicts for pairs of similar units."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions import text as T


def batches(pairs: DataFrame, size: int, order: list[str], scope: list[str]) -> DataFrame:
    """Adds batch and slot: runs of `size` pairs inside each scope, in order."""
    at = F.row_number().over(Window.partitionBy(*scope).orderBy(*order)) - 1
    return pairs.withColumn("at", at).withColumn("batch", F.floor(F.col("at") / size).cast("long")).withColumn("slot", (F.col("at") % size + 1).cast("int")).drop("at")


def _side(name: str, p: str) -> list[Column]:
    body = F.col(f"{p}_body")
    cut = F.concat(F.substring(body, 1, 2000), F.when(F.length(body) > 2000, "...").otherwise(""))
    return [F.concat(F.lit(f"{name} (P"), F.col(f"{p}_priority").cast("string"), F.lit("): ["), F.col(f"{p}_tag"), F.lit("] "), F.col(f"{p}_title")), cut]


# What the verdict prompt says; fixed text.
VERDICT_HEAD = (
    "请判断以下知识单元对是否重复。\n"
    "- DUPLICATE：完全重复，指出保留 A 还是 B（优先保留 P0）\n"
    "- MERGE：部分重复有互补内容，需要后续合并\n"
    "- KEEP_BOTH：不重复，各有独特价值\n"
    "\n请严格按以下格式输出，每对一行，不要输出其他内容：\n"
    "对号|判定|保留侧\n"
    "示例：\n"
    "1|KEEP_BOTH\n"
    "2|DUPLICATE|A\n"
    "3|MERGE\n"
)


def pair_prompt() -> Column:
    """One pair's lines in the verdict prompt; the share is rounded half to even, as Python formats it."""
    percent = F.bround(F.col("sim") * 100, 0).cast("int").cast("string")
    a, b = _side("A", "a"), _side("B", "b")
    return F.concat_ws("\n", F.concat(F.lit("\n【对"), F.col("slot").cast("string"), F.lit("】（相似度: "), percent, F.lit("%）")), a[0], a[1], F.concat(F.lit("\n"), b[0]), b[1])


def verdict_prompts(numbered: DataFrame, scope: list[str]) -> DataFrame:
    """One prompt a batch; a batch is at most its size long, so the gathered list is bounded."""
    lines = numbered.select(*scope, "batch", "slot", pair_prompt().alias("lines"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("slot", "lines"))), lambda x: x["lines"]), "\n")
    return lines.groupBy(*scope, "batch").agg(F.count("*").alias("num_pairs"), F.concat(F.lit(VERDICT_HEAD + "\n"), joined).alias("prompt"))


def merge_prompt() -> Column:
    """The prompt that asks for one unit out of two; fixed text around the units."""

    def side(name: str, p: str) -> Column:
        return F.concat(F.lit(f"\n【{name}】(P"), F.col(f"{p}_priority").cast("string"), F.lit("): ["), F.col(f"{p}_tag"), F.lit("] "), F.col(f"{p}_title"), F.lit("\n"), F.col(f"{p}_body"), F.lit("\n"))

    head = (
        "请将以下两条知识单元合并为一条，保留双方独特内容，消除重复部分。\n"
        "输出要求：直接输出合并后的完整 Markdown 文本（以 ## 开头），不要加任何包裹或说明。\n"
        f"输出完成后，必须在最后单独一行写 {T.END_MARKER} 作为结束标记。\n"
    )
    return F.concat(F.lit(head), side("A", "a"), side("B", "b"))


def parse_verdicts(answers: DataFrame, batch: str, raw: str, num_pairs: str) -> DataFrame:
    """(batch, pair, verdict, keep): the last usable line of a pair counts, a pair without one is KEEP_BOTH."""
    entries = answers.select(batch, F.explode(T.verdict_lines(F.col(raw))).alias("e")).select(batch, "e.*").where("pair IS NOT NULL")
    last = entries.groupBy(batch, "pair").agg(F.max_by(F.struct("verdict", "keep"), "line").alias("v"))
    wanted = answers.where(F.col(num_pairs) > 0).select(batch, F.explode(F.sequence(F.lit(1), F.col(num_pairs).cast("int"))).alias("pair"))
    out = wanted.join(last, [batch, "pair"], "left")
    return out.select(batch, "pair", F.coalesce("v.verdict", F.lit("KEEP_BOTH")).alias("verdict"), F.col("v.keep").alias("keep"))


def to_judgments(pairs: DataFrame) -> DataFrame:
    """(pair_key, verdict, keep_fp, drop_fp) of judged pairs (a, b, verdict, keep); a DUPLICATE keeps A unless told B."""
    dup, b = F.col("verdict") == "DUPLICATE", F.col("keep") == "B"
    return pairs.select(
        T.pair_key(F.col("a"), F.col("b")).alias("pair_key"),
        "verdict",
        F.when(dup, F.when(b, F.col("b")).otherwise(F.col("a"))).alias("keep_fp"),
        F.when(dup, F.when(b, F.col("a")).otherwise(F.col("b"))).alias("drop_fp"),
    )


class Judge(Protocol):
    """Adds verdict, keep and merged_text to pairs (a, b, sim, a_*, b_*)."""

    def __call__(self, pairs: DataFrame) -> DataFrame: ...


def rule_judge(pairs: DataFrame, duplicate: float = 0.95, merge: float = 0.8) -> DataFrame:
    """The offline judge: by similarity alone, the smaller priority number is kept, A on a tie.

    A merge is the first body and then the lines of the second that it lacks.
    """
    s = F.col("sim")
    verdict = F.when(s >= duplicate, "DUPLICATE").when(s >= merge, "MERGE").otherwise("KEEP_BOTH")
    lines = F.filter(F.split("b_body", "\n"), lambda x: ~F.array_contains(F.split("a_body", "\n"), x))
    return pairs.withColumn("verdict", verdict).withColumn("keep", F.when(F.col("b_priority") < F.col("a_priority"), "B").otherwise("A")).withColumn("merged_text", F.when(F.col("verdict") == "MERGE", F.array_join(F.concat(F.split("a_body", "\n"), lines), "\n")))


def merge_pending(judgments: DataFrame) -> DataFrame:
    """MERGE judgments that still lack their text."""
    return judgments.where("verdict = 'MERGE' AND coalesce(merged_text, '') = ''")


def histogram(judgments: DataFrame) -> DataFrame:
    """One row: duplicate, merge_done, merge_pending, keep_both."""
    v, text = F.col("verdict"), F.coalesce("merged_text", F.lit(""))
    return judgments.agg(
        F.count_if(v == "DUPLICATE").alias("duplicate"),
        F.count_if((v == "MERGE") & (text != "")).alias("merge_done"),
        F.count_if((v == "MERGE") & (text == "")).alias("merge_pending"),
        F.count_if(v == "KEEP_BOTH").alias("keep_both"),
    )
