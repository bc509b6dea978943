"""Writing results: unit extracts, topic volumes, caches, summaries."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import text as T
from quillstone.operators.folds import assign_volumes
from quillstone.sources import files


def placed(sized: DataFrame, max_kb: int, order: list[str]) -> DataFrame:
    """Rows (topic, bytes, ...) with volume and file: base.md, then base-002.md and on. Keys and sizes are enough."""
    out = assign_volumes(sized, max_kb * 1024, order)
    base = T.safe_filename(F.col("topic"))
    number = F.lpad(F.col("volume").cast("string"), 3, "0")
    return out.withColumn("file", F.when(F.col("volume") == 1, F.concat(base, F.lit(".md"))).otherwise(F.concat(base, F.lit("-"), number, F.lit(".md"))))


def volumes(units: DataFrame, max_kb: int, order: list[str]) -> DataFrame:
    """Units with bytes, volume and file."""
    return placed(units.withColumn("bytes", F.octet_length("body").cast("long")), max_kb, order)


def volume_texts(placed: DataFrame, order: list[str]) -> DataFrame:
    """(topic, volume, file, text): a volume is at most its size limit, or one unit, so it fits a row."""
    parts = F.array_sort(F.collect_list(F.struct(*order, "body")))
    return placed.groupBy("topic", "volume", "file").agg(F.array_join(F.transform(parts, lambda x: x["body"]), "\n\n").alias("text"))


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(p.rstrip("/") for p in parts))


def _fs(spark: SparkSession, path):
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, *parts: str) -> bool:
    path = _path(spark, *parts)
    return _fs(spark, path).exists(path)


def write_text(spark: SparkSession, text: str, *parts: str) -> None:
    """One file, written under another name and renamed over the old one: readers see the old text or the new."""
    final = _path(spark, *parts)
    part = final.suffix(".part")
    fs = _fs(spark, final)
    fs.mkdirs(final.getParent())
    local = fs.getUri().getScheme() == "file"
    if local:
        fs.setWriteChecksum(False)  # readers may edit these files; a checksum beside them would then be wrong
    try:
        out = fs.create(part, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
    finally:
        if local:
            fs.setWriteChecksum(True)
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(part), fs.makeQualified(final), how)


def read_text(spark: SparkSession, *parts: str) -> str | None:
    """A small file's text; None if it is missing."""
    return files.read_text(spark, "/".join(p.rstrip("/") for p in parts))


def write_text_files(spark: SparkSession, texts: DataFrame, folder: str) -> list[str]:
    """One file a row of (file, text); returns the names, sorted. Any file system.

    Rows come to the driver one at a time: the output is a folder of documents for readers, of bounded size each.
    """
    _fs(spark, _path(spark, folder)).mkdirs(_path(spark, folder))
    names = []
    for r in texts.select("file", "text").toLocalIterator():
        write_text(spark, r["text"], folder, r["file"])
        names.append(r["file"])
    return sorted(names)


def read_json(spark: SparkSession, *parts: str):
    """A small JSON file's value; None if it is missing or broken."""
    try:
        return json.loads(read_text(spark, *parts) or "null")
    except json.JSONDecodeError:
        return None


def dump_json(spark: SparkSession, value: object, *parts: str) -> None:
    write_text(spark, json.dumps(value, ensure_ascii=False, indent=2), *parts)


_appending = threading.Lock()


def append_lines(spark: SparkSession, lines: list[str], *parts: str) -> None:
    """A manifest with more names: the old lines and the new ones once each, replaced as a whole.

    Threads of one driver take turns; a manifest has one driver at a time.
    """
    with _appending:
        old = [x for x in (read_text(spark, *parts) or "").splitlines() if x.strip()]
        write_text(spark, "".join(f"{x}\n" for x in dict.fromkeys([*old, *lines])), *parts)


def markdown_files(spark: SparkSession, folder: str) -> list[str]:
    top = _path(spark, folder)
    fs = _fs(spark, top)
    return sorted(n for f in (fs.listStatus(top) if fs.exists(top) else []) if (n := f.getPath().getName()).endswith(".md"))


def remove_stale(spark: SparkSession, folder: str, keep: list[str]) -> list[str]:
    """Delete .md files that are not in `keep`; returns their names."""
    gone = [n for n in markdown_files(spark, folder) if n not in set(keep)]
    for name in gone:
        path = _path(spark, folder, name)
        _fs(spark, path).delete(path, False)
    return gone


def append_table(df: DataFrame, path: str) -> None:
    """Extracts, embeddings, manifests: tables that grow by whole files, so a lost task leaves no half line."""
    df.write.mode("append").parquet(path)


def write_cache(df: DataFrame, path: str, signature: str) -> None:
    """Replace one signature's partition of a cache table; others stay."""
    df.withColumn("merge_sig", F.lit(signature)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("merge_sig").parquet(path)


def write_summary(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)
