"""Reports over units, pairs and runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.functions import text as T
from quillstone.schema import UNCATEGORISED


def cross_topic_report(pairs: DataFrame, limit: int = 50, keep: Sequence[str] = ()) -> DataFrame:
    """The most similar pairs across topics, highest first; the limit is the report's."""
    return pairs.orderBy(F.desc("sim"), "a", "b").limit(limit).select(
        "topic_a", "topic_b", "a", "b", "sim", T.preview(F.col("a_body")).alias("preview_a"), T.preview(F.col("b_body")).alias("preview_b"), *keep
    )


def changelog(new_units: DataFrame, files: DataFrame, order: list[str]) -> DataFrame:
    """(topic, fingerprint, line) of new units that were written to a file this time."""
    rows = new_units.join(files.select("fingerprint", "file"), "fingerprint")
    link = F.concat(F.lit("- ["), "file", F.lit("](../topics/"), "file", F.lit(") — ["), "tag", F.lit("][P"), F.col("priority").cast("string"), F.lit("] "), "title")
    return rows.select(F.coalesce("topic", F.lit(UNCATEGORISED)).alias("topic"), "fingerprint", link.alias("line"), *order)


def changelog_counts(new_units: DataFrame) -> DataFrame:
    return new_units.groupBy("topic").agg(F.count("*").alias("added"))


def index_markdown(index: DataFrame, unmapped: DataFrame, title: str, intro: str = "") -> str:
    """The index page; topics and unmapped tags come from a configuration, so the driver may hold them."""
    lines = [f"# {title}\n", f"> {intro}\n", "## 目录\n", "| 序号 | 主题 | 知识单元 | P0 | P1 | P2 | 包含标签 |", "|:--|:--|:--|:--|:--|:--|:--|"]
    lines += [f"| {r['seq']} | {r['topic']} | {r['units']} 条 | {r['p0']} | {r['p1']} | {r['p2']} | {r['tags']} |" for r in index.orderBy("topic").toLocalIterator()]
    rest = [f"- {r['tag']}（{r['units']} 条知识单元）" for r in unmapped.orderBy("tag").toLocalIterator()]
    return "\n".join([*lines, *(["", "## 未分类标签\n", *rest] if rest else [])])


def run_log(records: DataFrame) -> DataFrame:
    """(status, n, seconds) of a run's work units."""
    return records.groupBy("status").agg(F.count("*").alias("n"), F.round(F.sum("duration_s"), 6).alias("seconds"))


def question_pairs(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, question, answer): a user turn and the assistant turn right after it."""
    ask = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    reply = turns.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return ask.join(reply, ["conv_id", "turn"])
