"""The product end to end: texts to extracts by a model, extracts to de-duplicated topic volumes, and state between runs.

Tables are DataFrames throughout; the driver holds names of files and topics, and one document of output at a time.
"""

from __future__ import annotations

import datetime as dt
import logging
import time
import traceback
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.config import Endpoint, PipelineConfig, RuntimeConfig, StageConfig
from quillstone.functions import text as T
from quillstone.model import client
from quillstone.model.breaker import EndpointState, run_summary, summary_line
from quillstone.model.runner import Answerer, ask, batch_prompt, retry_singly, single_prompt
from quillstone.operators import folds, incremental, reports, resolve, similarity, topics, units, verdicts
from quillstone.operators.barrier import settled
from quillstone.schema import JUDGMENT, UNCATEGORISED, UNIT_ORDER
from quillstone.sources import files, sinks

log = logging.getLogger("quillstone.stages")

EXTRACTS, INTERMEDIATE, TOPICS, LOGS = "_intermediate/extract", "_intermediate", "topics", "_logs"
MANIFEST, INDEX = "_manifest.txt", "00-目录与导读.md"
#: Failed verdict or merge calls in a row that end a round; fixed value.
GIVE_UP = 3
#: Order of units in a topic, in columns that sort in Python too.
FIRST = {f"first_{c}": f"tag_first.{c}" for c in UNIT_ORDER}
ORDER = ["priority", *FIRST, *UNIT_ORDER]


class StageError(RuntimeError):
    """A stage that can't go on."""


Embedder = Callable[[list[str]], list[list[float]]]


@dataclass
class Models:
    """What answers prompts and embeds texts: functions without arguments, called once a task on executors."""

    extract: Callable[[], Answerer]
    verdict: Callable[[], Answerer]
    merge: Callable[[], Answerer]
    embed: Callable[[], Embedder]


def answerer(stage: StageConfig, runtime: RuntimeConfig, retried: bool) -> Callable[[], Answerer]:
    def build() -> Answerer:
        states = [EndpointState(e, log=lambda said: log.warning("endpoint cools down: %s", said)) for e in stage.endpoints]

        def answer(prompt: str) -> str:
            def one() -> str:
                return client.with_continuation(stage, states, prompt, runtime)

            return client.with_unit_retry(one) if retried else one()

        return answer

    return build


def embedder(config: PipelineConfig) -> Callable[[], Embedder]:
    """The embedding endpoint of the settings, or else the endpoints of the synthesis stage."""
    own, stage = config.similarity, config.stages.get("synthesize")

    def build() -> Embedder:
        points = (Endpoint("embedding", own.embedding_api_url, own.embedding_api_key),) if own.embedding_api_url else stage.endpoints
        states = [EndpointState(e) for e in points]
        return lambda texts: client.embed(texts, states, own.embedding_model, config.runtime, own.embedding_batch_size)

    return build


def models(config: PipelineConfig) -> Models:
    first, second = config.stages.get("extract"), config.stages.get("synthesize")
    return Models(answerer(first, config.runtime, True), answerer(second, config.runtime, False), answerer(second, config.runtime, False), embedder(config))


# --- extraction


def extract_units(todo: DataFrame, config: PipelineConfig) -> DataFrame:
    """(unit, kind, names, file, prompt, items): single files, batches of small ones, chunks of large ones."""
    b = config.batching
    limit = T.effective_limit_kb(b.max_batch_kb, config.stages["extract"].provider, b.providers.table())
    tasks = files.corpus_tasks(todo, limit)
    whole = tasks.where("type = 'normal'").select("source_name", "text", "size_kb")
    sized = whole.select("source_name", "size_kb", T.payload_kb(F.col("source_name"), F.col("text")).alias("payload_kb"))
    dealt = folds.assign_batches(sized, b.max_files_per_batch, limit, ["size_kb", "source_name"], "payload_kb").select("source_name", "batch")
    # a batch is at most max_files_per_batch files of at most the limit together
    items = F.transform(F.array_sort(F.collect_list(F.struct("size_kb", F.col("source_name").alias("name"), "text"))), lambda x: F.struct(x["name"].alias("name"), x["text"].alias("text")))
    batches = whole.join(dealt, "source_name").groupBy("batch").agg(items.alias("items")).withColumn("names", F.col("items.name"))
    one, alone = F.size("items") == 1, F.get("items", F.lit(0))
    batches = batches.select(
        F.concat(F.lit("batch "), F.col("batch").cast("string")).alias("unit"),
        F.when(one, "single").otherwise("batch").alias("kind"),
        "names",
        F.when(one, F.concat(T.safe_filename(alone["name"]), F.lit(".md"))).otherwise(T.batch_name(F.col("names"))).alias("file"),
        F.when(one, single_prompt(alone["name"], alone["text"])).otherwise(batch_prompt(F.col("items"))).alias("prompt"),
        "items",
    )
    part = F.col("chunk_index").cast("string")
    label = F.concat("source_name", F.lit(" (块 "), part, F.lit("/"), F.col("chunk_total").cast("string"), F.lit(")"))
    chunks = tasks.where("type = 'chunk'").select(
        label.alias("unit"),
        F.lit("chunk").alias("kind"),
        F.array("source_name").alias("names"),
        F.concat(T.safe_filename(F.col("source_name")), F.lit("_part"), part, F.lit(".md")).alias("file"),
        single_prompt(label, F.col("text")).alias("prompt"),
        F.array(F.struct(label.alias("name"), F.col("text").alias("text"))).alias("items"),
    )
    return batches.unionByName(chunks)


def run_extract(spark: SparkSession, config: PipelineConfig, answer: Callable[[], Answerer]) -> str:
    """Ask the model for an extract of every new file; returns the folder of extracts.

    A file is named in the manifest when all of its answers are written. A batch without an answer is asked
    again file by file, unless no endpoint is left.
    """
    began = time.monotonic()
    folder = f"{config.output_dir}/{EXTRACTS}"
    found = files.read_corpus(spark, config.input_dir, exclude=config.output_dir)
    if found.isEmpty():
        raise StageError(f"no .txt file in {config.input_dir}")
    todo = settled(incremental.pending(found, files.read_manifest(spark, f"{folder}/{MANIFEST}"), "source_name"))
    if todo.isEmpty():
        log.info("extract: all files are done")
        return folder
    workers = config.concurrency.max_workers
    work = settled(extract_units(todo, config))
    asked = settled(ask(work, "unit", "prompt", answer, workers))
    done, records = work.join(asked.where("status = 'ok'").select("unit", "answer"), "unit"), asked
    failed = work.where("kind = 'batch'").join(asked.where("status = 'error'").select("unit"), "unit", "left_semi")
    if asked.where("status = 'skip'").isEmpty() and not failed.isEmpty():
        single = retry_singly(failed, asked, "unit", "items")
        single = settled(single.select(F.col("name").alias("unit"), F.lit("single").alias("kind"), F.array("name").alias("names"), F.concat(T.safe_filename(F.col("name")), F.lit(".md")).alias("file"), single_prompt(F.col("name"), F.col("text")).alias("prompt"), F.array(F.struct("name", "text")).alias("items")))
        again = settled(ask(single, "unit", "prompt", answer, workers))
        done = done.unionByName(single.join(again.where("status = 'ok'").select("unit", "answer"), "unit"))
        records = records.unionByName(again)
    sinks.write_text_files(spark, done.select("file", T.strip_fences(F.col("answer")).alias("text")), folder)
    wanted = work.select("unit", F.explode("names").alias("name")).groupBy("name").agg(F.count("*").alias("wanted"))
    got = done.select("unit", F.explode("names").alias("name")).groupBy("name").agg(F.count("*").alias("got"))
    names = [r["name"] for r in wanted.join(got, "name").where("got >= wanted").orderBy("name").toLocalIterator()]
    sinks.append_lines(spark, names, folder, MANIFEST)
    write_run_log(spark, config, "extract", records, began)
    return folder


def write_run_log(spark: SparkSession, config: PipelineConfig, stage: str, records: DataFrame, began: float) -> dict:
    """The run's work units as a JSON file, and the calls that found no endpoint left as a text file."""
    rows = [{"worker": stage, "unit": r["unit"], "status": r["status"], "duration_s": round(r["duration_s"], 3)} | ({"error": r["error"]} if r["error"] else {}) for r in records.select("unit", "status", "duration_s", "error").orderBy("unit").toLocalIterator()]
    said = run_summary(stage, config.concurrency.max_workers, len(rows), time.monotonic() - began, rows)
    stamp = dt.datetime.now().strftime("%Y%m%d_%H%M%S_%f")
    sinks.dump_json(spark, said, config.output_dir, LOGS, f"concurrent_{stage}_{stamp}.json")
    if lost := [r for r in rows if r["status"] == "skip" and "error" in r]:
        sinks.write_text(spark, "\n".join(f"{r['unit']}: {r['error']}" for r in lost), config.output_dir, LOGS, f"circuit_break_{stage}_{stamp}.log")
    log.info(summary_line(said))
    return said


# --- synthesis


def _cache(spark: SparkSession, path: str, signature: str, full: bool, schema: str) -> DataFrame:
    """A cache table's rows of this signature, cut off from its files, which are about to be replaced."""
    if full or not sinks.exists(spark, path):
        return spark.createDataFrame([], schema)
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    return settled(incremental.cached(spark.read.parquet(path), signature).select(*names))


def _sides(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """Pairs (topic, a, b, sim) with priority, tag, title and body of both sides."""
    for side in ("a", "b"):
        pairs = pairs.join(bodies.select(F.col("fingerprint").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("priority", "tag", "title", "body")]), side)
    return pairs


def with_embeddings(todo: DataFrame, embed: Callable[[], Embedder], batch: int) -> DataFrame:
    """(fingerprint, embedding) of bodies, some at a time."""

    def run(batches):
        vectors = embed()
        for pdf in batches:
            for k in range(0, len(pdf), batch):
                part = pdf.iloc[k : k + batch]
                yield part[["fingerprint"]].assign(embedding=vectors(part["body"].tolist()))

    return todo.select("fingerprint", "body").mapInPandas(run, "fingerprint string, embedding array<double>")


def similar_pairs(spark: SparkSession, config: PipelineConfig, member: DataFrame, embed: Callable[[], Embedder], full: bool) -> tuple[DataFrame, DataFrame]:
    """(pairs inside topics, pairs across topics) that hold a new unit."""
    s = config.similarity
    if s.method == "ngram":
        inside = similarity.jaccard_intra(member, s.threshold, ORDER, None, s.ngram_size)
        return inside, similarity.jaccard_cross(member, s.threshold, ORDER, UNIT_ORDER, s.ngram_size)
    path = f"{config.output_dir}/{INTERMEDIATE}/embedding_cache"
    known = _cache(spark, path, s.embedding_model, full, "fingerprint string, embedding array<double>")
    todo = incremental.pending(member, known, "fingerprint")
    if not todo.isEmpty():
        known = settled(known.unionByName(with_embeddings(todo, embed, s.embedding_batch_size)))
        sinks.write_cache(known, path, s.embedding_model)
    able = member.join(known, "fingerprint").where(F.size("embedding") > 0)
    return similarity.cosine_intra(able, s.threshold, "fingerprint", "topic", "embedding"), similarity.cosine_cross(able, s.threshold, "fingerprint", "topic", "embedding")


def judged(pairs: DataFrame, config: PipelineConfig, answer: Callable[[], Answerer]) -> tuple[DataFrame, DataFrame]:
    """(judgments, call records) of pairs (topic, a, b, sim, a_*, b_*); merged texts are still missing."""
    numbered = verdicts.batches(pairs, config.similarity.llm_batch_size, ["a", "b"], ["topic"]).withColumn("unit", F.concat_ws("#", "topic", F.col("batch").cast("string")))
    prompts = verdicts.verdict_prompts(numbered, ["topic"]).withColumn("unit", F.concat_ws("#", "topic", F.col("batch").cast("string")))
    asked = settled(ask(settled(prompts.select("unit", "num_pairs", "prompt")), "unit", "prompt", answer, config.concurrency.max_workers, GIVE_UP))
    answers = prompts.select("unit", "num_pairs").join(asked.where("status = 'ok'").select("unit", "answer"), "unit")
    said = verdicts.parse_verdicts(answers, "unit", "answer", "num_pairs").withColumnRenamed("pair", "slot")
    rows = verdicts.to_judgments(numbered.select("unit", "slot", "a", "b").join(said, ["unit", "slot"]))
    return rows.withColumn("merged_text", F.lit(None).cast("string")), asked


def merged(pairs: DataFrame, judgments: DataFrame, config: PipelineConfig, answer: Callable[[], Answerer]) -> tuple[DataFrame, DataFrame]:
    """(judgments, call records): MERGE judgments of these pairs get the texts they lack."""
    key = T.pair_key(F.col("a"), F.col("b"))
    lacking = verdicts.merge_pending(judgments).select(F.col("pair_key").alias("unit"))
    prompts = settled(pairs.withColumn("unit", key).join(lacking, "unit", "left_semi").select("unit", verdicts.merge_prompt().alias("prompt")).dropDuplicates(["unit"]))
    asked = settled(ask(prompts, "unit", "prompt", answer, config.concurrency.max_workers, GIVE_UP))
    texts = asked.where("status = 'ok'").select(F.col("unit").alias("pair_key"), T.strip(T.strip_fences(F.col("answer"))).alias("new")).where("new <> ''")
    out = judgments.join(texts, "pair_key", "left").withColumn("merged_text", F.coalesce("new", "merged_text")).drop("new")
    return out, asked


def topic_sort(topic: str) -> tuple[bool, str]:
    """Topics by name, the uncategorised one last."""
    return topic == UNCATEGORISED, topic


def write_topics(spark: SparkSession, config: PipelineConfig, member: DataFrame, before: dict[str, dict]) -> tuple[dict[str, dict], DataFrame]:
    """Write the volumes of changed topics; (topic: fingerprint and files of all topics, (fingerprint, file) written)."""
    folder = f"{config.output_dir}/{TOPICS}"
    prints = {r["topic"]: r["fingerprint"] for r in topics.joined_digests(member, ORDER).toLocalIterator()}
    there = set(sinks.markdown_files(spark, folder))
    same = {t for t, fp in prints.items() if (b := before.get(t)) and b["fingerprint"] == fp and b["files"] and there.issuperset(b["files"])}
    changed = spark.createDataFrame([(t,) for t in prints if t not in same], "topic string")
    rows = member.join(changed, "topic", "left_semi")
    keys = rows.select("topic", "fingerprint", *ORDER, F.octet_length("body").cast("long").alias("bytes"))
    placed = settled(sinks.placed(keys, config.similarity.max_file_size_kb, ORDER))
    state = {t: before[t] for t in same}
    for r in placed.groupBy("topic").agg(F.array_sort(F.collect_set(F.struct("volume", "file"))).alias("v")).toLocalIterator():
        state[r["topic"]] = {"fingerprint": prints[r["topic"]], "files": [v["file"] for v in r["v"]]}
    sinks.remove_stale(spark, folder, [INDEX, *(f for t in state.values() for f in t["files"])])
    sinks.write_text_files(spark, sinks.volume_texts(placed.join(rows.select("topic", *UNIT_ORDER, "body"), ["topic", *UNIT_ORDER]), ORDER), folder)
    return {t: state[t] for t in sorted(state, key=topic_sort)}, placed.select("fingerprint", "file")


def cross_report(pairs: DataFrame, bodies: DataFrame, threshold: float) -> str:
    """The report's text: at most its 50 pairs."""
    top = reports.cross_topic_report(_sides(pairs, bodies).select("topic_a", "topic_b", "a", "b", "sim", "a_body", "b_body", "a_tag", "b_tag", "a_priority", "b_priority"), keep=["a_tag", "b_tag", "a_priority", "b_priority"])
    lines = [f"跨主题相似度报告（阈值: {threshold:.0%}）\n"]
    for r in top.collect():  # the report's limit
        lines.append(f"[{r['sim']:.0%}] ⚠ 跨主题:")
        lines += [f'  主题{x}: {r[f"topic_{y}"]} | 标签: {r[f"{y}_tag"]} | P{r[f"{y}_priority"]} | "{r[f"preview_{y}"]}"' for x, y in (("A", "a"), ("B", "b"))]
        lines += ["  → 建议检查 mapping 是否需要调整", ""]
    return "\n".join(lines)


def changelog_text(lines: DataFrame) -> str:
    now = dt.datetime.now()
    rows = list(lines.orderBy("topic", *UNIT_ORDER).toLocalIterator())
    out = ["# Synthesize 变更报告\n", f"> 生成时间: {now:%Y-%m-%d %H:%M:%S}", f"> 新增知识单元: {len(rows)} 条\n"]
    by_topic: dict[str, list[str]] = {}
    for r in rows:
        by_topic.setdefault(r["topic"], []).append(r["line"])
    for topic, items in by_topic.items():
        out += [f"## {topic} (+{len(items)})\n", *items, ""]
    return "\n".join(out)


def run_synthesize(spark: SparkSession, config: PipelineConfig, extracts: str, own: Models, full: bool = False) -> dict:
    """Extracts to topic volumes, index and reports; returns the run's summary, or the last one if nothing changed.

    Known units, judgments, embeddings and topic digests are kept under a signature of all settings they depend
    on. Only pairs that hold a new unit are compared, only unjudged pairs asked, only changed topics written.
    """
    began, s = time.monotonic(), config.similarity
    work, folder = f"{config.output_dir}/{INTERMEDIATE}", f"{config.output_dir}/{TOPICS}"
    signature = incremental.merge_signature(mapping=config.mapping, threshold=s.threshold, ngram_size=s.ngram_size, method=s.method, embedding_model=s.embedding_model)
    texts = files.read_extracts(spark, extracts)
    whole = topics.tree_digests(texts.withColumn("content", F.concat_ws("\n", "file_name", "text")), [], "content").first()
    fingerprint = f"{whole['h'][:16]}_{signature}"
    last = sinks.read_json(spark, work, "synthesize_manifest.json") or {}
    if not full and last.get("fingerprint") == fingerprint and last["topic_files"] and set(last["topic_files"]) <= set(sinks.markdown_files(spark, folder)):
        log.info("synthesize: nothing changed")
        return sinks.read_json(spark, work, "run_summary.json")

    found = settled(units.distinct_units(units.parse_units(texts), UNIT_ORDER))
    mapping = topics.mapping_table(spark, config.mapping)
    member = topics.apply_mapping(found, mapping) if config.mapping else found.withColumn("topic", F.col("tag"))
    known = _cache(spark, f"{work}/unit_fingerprints", signature, full, "fingerprint string")
    member = incremental.with_is_new(topics.with_first_seen(member), known)
    member = settled(member.select("*", *[F.col(c).alias(n) for n, c in FIRST.items()]).drop("tag_first"))
    n_all, n_new, n_known = (incremental.unit_counts(member, known).first()[c] for c in ("total", "new", "known"))
    log.info("synthesize: %s units, %s new, %s known", n_all, n_new, n_known)

    old = _cache(spark, f"{work}/dedup_judgments", signature, full, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in JUDGMENT.fields))
    judgments, calls = old, None
    inside = across = None
    if n_new:
        inside, across = (settled(p) for p in similar_pairs(spark, config, member, own.embed, full))
        unjudged = inside.withColumn("pair_key", T.pair_key(F.col("a"), F.col("b"))).join(old.select("pair_key"), "pair_key", "left_anti").drop("pair_key")
        new, calls = judged(settled(_sides(unjudged, member)), config, own.verdict)
        top = old.agg(F.coalesce(F.max("ord"), F.lit(-1)).alias("n")).first()["n"]
        new = settled(new.withColumn("ord", F.monotonically_increasing_id() + top + 1))
        judgments, more = merged(_sides(inside, member), incremental.upsert(old, new, "pair_key"), config, own.merge)
        judgments, calls = settled(judgments), calls.unionByName(more)
    sinks.write_cache(member.select("fingerprint", "tag", "topic", "priority"), f"{work}/unit_fingerprints", signature)
    sinks.write_cache(judgments, f"{work}/dedup_judgments", signature)

    left = settled(resolve.resolve_reference(member, judgments, ORDER[1:]))
    before = {} if full else (sinks.read_json(spark, work, "topic_fingerprints.json") or {})
    state, written = write_topics(spark, config, left, before.get("topics", {}) if before.get("merge_sig") == signature else {})
    sinks.dump_json(spark, {"merge_sig": signature, "topics": state}, work, "topic_fingerprints.json")
    sinks.write_text(spark, reports.index_markdown(topics.topic_index(left, config.mapping), topics.unmapped_tags(found, mapping) if config.mapping else spark.createDataFrame([], "tag string, units long"), "目录与导读", "知识单元按主题汇总"), folder, INDEX)
    n_across = 0
    if across is not None and (n_across := across.count()):
        sinks.write_text(spark, cross_report(across, member, s.threshold), work, "cross_topic_similarity.txt")
    if n_known and n_new:
        lines = reports.changelog(member.where("is_new").select("topic", "fingerprint", "tag", "priority", "title", *UNIT_ORDER), written, UNIT_ORDER)
        if not lines.isEmpty():
            sinks.write_text(spark, changelog_text(lines), work, f"changelog_{dt.datetime.now():%Y%m%d_%H%M%S}.md")
    if calls is not None:
        write_run_log(spark, config, "synthesize", calls, began)
    names = sorted(f for t in state.values() for f in t["files"])
    counts = verdicts.histogram(judgments).first().asDict()
    summary = {"topic_count": len(names), "topics_dir": folder, "topic_files": names, "dedup_stats": {"total_before": n_all, "total_after": left.count(), "new": n_new, "duplicate": counts["duplicate"], "merge": counts["merge_done"], "merge_pending": counts["merge_pending"], "keep_both": counts["keep_both"], "cross_topic_pairs": n_across}}
    sinks.dump_json(spark, summary, work, "run_summary.json")
    sinks.dump_json(spark, {"fingerprint": fingerprint, "topic_count": len(names), "topics_dir": folder, "topic_files": names, "mapping": config.mapping}, work, "synthesize_manifest.json")
    return summary


# --- both


def run_pipeline(spark: SparkSession, config: PipelineConfig, only: str = "all", full: bool = False, own: Models | None = None) -> dict | None:
    """Both stages, or one; the summary of the synthesis."""
    own = own or models(config)
    extracts = f"{config.output_dir}/{EXTRACTS}"
    if only in ("all", "extract"):
        run_extract(spark, config, own.extract)
    return run_synthesize(spark, config, extracts, own, full) if only in ("all", "synthesize") else None


def write_error_log(spark: SparkSession, folder: str, settings: str, only: str, error: BaseException) -> str:
    """What went wrong, as a file; returns its name."""
    name = f"pipeline_error_{dt.datetime.now():%Y%m%d_%H%M%S}.log"
    lines = [f"time: {dt.datetime.now().isoformat(timespec='seconds')}", f"settings: {settings}", f"stage: {only}", f"error: {type(error).__name__}: {error}", "", *traceback.format_exception(error)]
    sinks.write_text(spark, "\n".join(lines), folder, name)
    return name
