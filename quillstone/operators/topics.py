"""Tags to topics, and statistics by topic."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import sha256
from quillstone.operators.barrier import settled
from quillstone.schema import UNCATEGORISED, UNIT_ORDER


def mapping_table(spark: SparkSession, mapping: dict[str, list[str]]) -> DataFrame:
    """(tag, topic, topic_ord): a tag listed twice belongs to the first topic that names it."""
    seen: dict[str, tuple[str, int]] = {}
    for k, (topic, tags) in enumerate(mapping.items()):
        for tag in tags:
            if tag.strip():
                seen.setdefault(tag.strip(), (topic, k))
    return spark.createDataFrame([(t, *v) for t, v in seen.items()], "tag string, topic string, topic_ord int")


def apply_mapping(units: DataFrame, mapping: DataFrame) -> DataFrame:
    """Units with their topic; unmapped tags go to the uncategorised topic.

    The mapping comes from a configuration file on the driver, so it is small enough to broadcast; dealt out by
    tag, all texts of a frequent tag would meet in one task.
    """
    return units.join(F.broadcast(mapping.select("tag", "topic")), "tag", "left").withColumn("topic", F.coalesce("topic", F.lit(UNCATEGORISED)))


def unmapped_tags(units: DataFrame, mapping: DataFrame) -> DataFrame:
    """(tag, units) of tags without a topic."""
    return units.groupBy("tag").agg(F.count("*").alias("units")).join(mapping, "tag", "left_anti")


def with_first_seen(units: DataFrame) -> DataFrame:
    """Adds tag_first, the place where the tag first occurs, part of the order of units in a topic.

    The places are settled, so the planner knows their size and broadcasts a table of few tags.
    """
    first = settled(units.groupBy("tag").agg(F.min(F.struct(*UNIT_ORDER)).alias("tag_first")))
    return units.join(first, "tag")


#: Order of units inside a topic: priority, then tags as first seen, then place.
TOPIC_ORDER = ["priority", "tag_first", *UNIT_ORDER]


def topic_stats(units: DataFrame) -> DataFrame:
    """(topic, units, kb, p0, p1, p2): here P2 is the label P2 alone."""
    return units.groupBy("topic").agg(
        F.count("*").alias("units"),
        F.round(F.sum(F.octet_length("body")) / 1024.0, 6).alias("kb"),
        *[F.count_if(F.col("priority") == p).alias(f"p{p}") for p in (0, 1, 2)],
    )


def topic_index(units: DataFrame, mapping: dict[str, list[str]]) -> DataFrame:
    """(topic, seq, units, p0, p1, p2, tags): here P2 counts everything from P2 down, unlabelled ones too."""
    spark = units.sparkSession
    shown = [(t, "、".join(x[:6]) + ("..." if len(x) > 6 else "")) for t, x in mapping.items()]
    tags = spark.createDataFrame(shown, "topic string, tags string")
    stats = units.where(F.col("topic") != UNCATEGORISED).groupBy("topic").agg(
        F.count("*").alias("units"),
        F.count_if(F.col("priority") == 0).alias("p0"),
        F.count_if(F.col("priority") == 1).alias("p1"),
        F.count_if(F.col("priority") >= 2).alias("p2"),
    )
    seq = F.when(F.col("topic").contains("-"), F.substring_index("topic", "-", 1)).otherwise("?")
    return stats.join(tags, "topic", "left").select("topic", seq.alias("seq"), "units", "p0", "p1", "p2", F.coalesce("tags", F.lit("")).alias("tags"))


def tree_digests(rows: DataFrame, group: list[str], content: str) -> DataFrame:
    """(group, n, h): digest of the sorted digests of a group's contents, whatever the order of rows.

    Digests that begin with the same three hex digits are folded first, so that no task holds more than a
    4,096th of a group's digests, or any text.
    """
    one = rows.select(*group, F.sha2(content, 256).alias("h"))
    part = one.groupBy(*group, F.substring("h", 1, 3).alias("slot")).agg(F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("h"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("slot", "h"))), lambda x: x["h"]), "")
    return part.groupBy(*group).agg(F.sum("n").alias("n"), F.sha2(joined, 256).alias("h"))


def topic_fingerprints(units: DataFrame, digits: int = 16) -> DataFrame:
    """(topic, units, fingerprint): order-insensitive digest of a topic's bodies, from their own digests."""
    return tree_digests(units, ["topic"], "body").select("topic", F.col("n").alias("units"), F.substring("h", 1, digits).alias("fingerprint"))


#: Bytes of bodies that a task of joined_digests reads and hashes, on average.
SLICE = 32 << 20

#: Letters of a body by which slices are told apart where bodies are sorted: the driver samples these.
HEAD = 256


def joined_digests(units: DataFrame, order: list[str], digits: int = 16, group: str = "topic", body: str = "body") -> DataFrame:
    """(group, units, fingerprint): digest of a group's bodies joined in order.

    Equal to hashing the joined text, which is sequential in time, but not in place: rows are dealt into sorted
    slices of like size, and a slice goes on with the digest that the one before it has begun. All slices are read
    once side by side; then those that a group runs into from the slice before are read again, one after the other
    in a group, groups side by side. The driver sees digests and heads of bodies. Rows of one key of `order` share a slice;
    where that is the body, so do those of one head.
    """
    spark = units.sparkSession
    names = list(dict.fromkeys([group, body, *order]))
    rows = units.select(*names).withColumn(body, F.coalesce(body, F.lit("")))
    total = rows.agg(F.sum(F.octet_length(body).cast("long"))).first()[0] or 0
    # a head sorts as its body does, but for bodies of the same head: what follows it in the order tells slices apart no more
    key = [*order[: order.index(body)], F.substring(body, 1, HEAD)] if body in order else order
    dealt = rows.repartitionByRange(total // SLICE + 1, group, *key).sortWithinPartitions(group, *order).select(group, body)
    slices = dealt.rdd  # keeps what was dealt out: each job below reads it again

    def digested(numbers: list[int], begun: dict[int, tuple]) -> dict[int, list[tuple]]:
        """(group, units, state) of all groups of these slices, in order; of the first alone where it is given as begun."""

        def run(number: int, found: Iterator[tuple]) -> Iterator[tuple[int, list[tuple]]]:
            out, now, n, digest = [], None, 0, None
            if number in begun:
                now, n, state = begun[number]
                digest = sha256.resumed(state)
            for key, text in found:
                if digest is None or key != now:
                    if digest is not None:
                        out.append((now, n, digest.state()))
                        if number in begun:
                            digest = None
                            break
                    now, n, digest = key, 0, sha256.resumed(sha256.start())
                digest.update(text.encode())
                n += 1
            if digest is not None:
                out.append((now, n, digest.state()))
            yield number, out

        return dict(spark.sparkContext.runJob(slices.mapPartitionsWithIndex(run), lambda found: found, numbers))

    count = slices.getNumPartitions()
    of = {k: v for k, v in digested(list(range(count)), {}).items() if v}
    filled = sorted(of)
    before = {b: a for a, b in zip(filled, filled[1:], strict=False) if of[a][-1][0] == of[b][0][0]}
    waiting = set(before)
    while waiting:
        # a slice's last group is settled if it begins there, or once the slice has been gone on with
        ready = [k for k in sorted(waiting) if before[k] not in waiting or len(of[before[k]]) > 1]
        for k, v in digested(ready, {k: of[before[k]][-1] for k in ready}).items():
            of[k][0] = v[0]
        waiting.difference_update(ready)
    open_ended = set(before.values())
    whole = [x for k in filled for x in (of[k][:-1] if k in open_ended else of[k])]
    kind = units.schema[group].dataType.simpleString()
    return spark.createDataFrame([(g, n, sha256.hexdigest(state)[:digits]) for g, n, state in whole], f"`{group}` {kind}, units long, fingerprint string")
