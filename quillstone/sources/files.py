"""Corpus files: listing, decoding, unit Markdown, manifests, caches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import text as T

#: Folders that are never sources; fixed values.
IGNORED = [".venv", "venv", "__pycache__", ".git"]
#: Encodings tried in this order for bytes without a mark, with and without preferring mojibake-safe order.
REFERENCE_ORDER = ["utf-8", "utf-8-sig", "utf-16", "utf-16-le", "utf-16-be", "gb18030", "gbk", "big5"]
SAFE_ORDER = ["utf-8", "gb18030", "gbk", "big5", "utf-16", "utf-16-le", "utf-16-be"]


def list_files(spark: SparkSession, root: str, suffix: str = ".txt", exclude: str | None = None) -> DataFrame:
    """(path, source_name, length) of the files under a folder, empty ones too; any file system Spark reads.

    Spark's own file reader skips empty files and names that start with _ or ., so the listing goes through
    the file system; contents are read by Spark.
    """
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(top) or not fs.getFileStatus(top).isDirectory():
        raise FileNotFoundError(f"no such folder: {root}")
    base = fs.getFileStatus(top).getPath().toUri().getPath().rstrip("/")
    skip = exclude and fs.makeQualified(jvm.org.apache.hadoop.fs.Path(exclude)).toUri().getPath().rstrip("/")
    found, files = [], fs.listFiles(top, True)
    while files.hasNext():
        f = files.next()
        path = f.getPath().toUri().getPath()
        if skip and (path == skip or path.startswith(skip + "/")):
            continue
        if path.endswith(suffix) and not {p.lower() for p in path.split("/")} & set(IGNORED):
            found.append((f.getPath().toString(), path[len(base) + 1 :], f.getLen()))
    return spark.createDataFrame(found, "path string, source_name string, length long")


def decode(data: bytes, order: list[str]) -> tuple[str, str]:
    """(text, encoding): by byte-order mark, else the first of `order` that fits, else gb18030 with replacements."""
    if not data:
        return "", "utf-8"
    marks = ((b"\xef\xbb\xbf", "utf-8-sig", "utf-8-sig"), (b"\xff\xfe", "utf-16", "utf-16-le(bom)"), (b"\xfe\xff", "utf-16", "utf-16-be(bom)"))
    for mark, codec, name in marks:
        if data.startswith(mark):
            return data.decode(codec), name
    for codec in order:
        try:
            return data.decode(codec), codec
        except UnicodeDecodeError:
            continue
    return data.decode("gb18030", errors="replace"), "gb18030(replace)"


def decode_files(files: DataFrame, order: list[str] | None = None, content: str = "content") -> DataFrame:
    """Adds text, detected_encoding and size_kb to rows of bytes; valid UTF-8 without a mark stays in the JVM."""
    order = order or SAFE_ORDER

    @F.pandas_udf("text string, encoding string")
    def guess(c: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([decode(bytes(x or b""), order) for x in c], columns=["text", "encoding"])

    raw = F.coalesce(F.col(content), F.lit(b""))
    plain = F.is_valid_utf8(raw.cast("string")) & ~F.hex(F.substring(raw, 1, 3)).startswith("EFBBBF") & ~F.hex(F.substring(raw, 1, 2)).isin("FFFE", "FEFF")
    easy = files.where(plain).withColumn("text", raw.cast("string")).withColumn("detected_encoding", F.lit("utf-8"))
    hard = files.where(~plain).withColumn("d", guess(raw)).withColumn("text", F.col("d.text")).withColumn("detected_encoding", F.col("d.encoding")).drop("d")
    return easy.unionByName(hard).withColumn("size_kb", F.octet_length("text") / F.lit(1024.0))


def read_corpus(spark: SparkSession, root: str, exclude: str | None = None, order: list[str] | None = None) -> DataFrame:
    """(source_name, text, detected_encoding, size_kb) of every .txt file under a folder."""
    listed = list_files(spark, root, ".txt", exclude)
    content = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(root).select("path", "content")
    return decode_files(listed.join(content, "path", "left").select("source_name", "content"), order).drop("content")


def read_extracts(spark: SparkSession, root: str) -> DataFrame:
    """(file_name, text) of a folder's .md files, line ends made \\n; units sort by lower-cased name."""
    df = spark.read.option("pathGlobFilter", "*.md").text(root, wholetext=True)
    return df.select(F.lower(F.col("_metadata.file_name")).alias("file_name"), F.regexp_replace("value", "\r\n?", "\n").alias("text"))


def joined_extracts(files: DataFrame, separator: str = "\n\n---\n\n") -> DataFrame:
    """One row, all non-blank extracts in name order; for folders whose joined text is meant to be one document."""
    kept = files.withColumn("text", T.strip(F.col("text"))).where("text <> ''")
    return kept.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("file_name", "text"))), lambda x: x["text"]), separator).alias("text"))


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, whatever its name; None if it is missing. Spark's readers pass over names with a leading _."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(source_name) of finished work, from a text file of names; a missing file is an empty manifest."""
    names = {x.strip() for x in (read_text(spark, path) or "").splitlines()} - {""}
    return spark.createDataFrame([(x,) for x in sorted(names)], "source_name string")


def read_embedding_json(texts: DataFrame, column: str = "value") -> DataFrame:
    """(fingerprint, embedding) from JSON objects of vectors; text that doesn't parse gives no rows."""
    return texts.select(F.explode(F.from_json(column, "map<string,array<float>>")).alias("fingerprint", "embedding"))


def corpus_tasks(files: DataFrame, limit_kb: float) -> DataFrame:
    """Files as tasks: whole under the limit, else chunks (type, source_name, text, size_kb, chunk_index, chunk_total)."""
    from quillstone.operators.folds import split_large

    whole = files.where(F.col("size_kb") < limit_kb).select(F.lit("normal").alias("type"), "source_name", "text", "size_kb", F.lit(None).cast("int").alias("chunk_index"), F.lit(None).cast("int").alias("chunk_total"))
    cut = split_large(files.where(F.col("size_kb") >= limit_kb), "source_name", "text", limit_kb)
    chunks = cut.select(F.lit("chunk").alias("type"), "source_name", F.col("chunk").alias("text"), (F.octet_length("chunk") / F.lit(1024.0)).alias("size_kb"), "chunk_index", "chunk_total")
    return whole.unionByName(chunks)
