"""Markdown to knowledge units."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions import text as T

#: A line feed before a second-level heading, and what each begins with.
BOUNDARY, OPENING = r"\n(?=## (?!#))", "\n## "


def parse_units(files: DataFrame, name: str = "file_name", text: str = "text", part: str | None = None) -> DataFrame:
    """Units of tagged Markdown (columns of schema.UNIT). Text before a file's first heading is dropped.

    A large file may come as several rows cut at headings; `part` numbers them. Narrow: no shuffle.
    """
    src = files.select(F.col(name).alias("file_name"), (F.col(part).cast("long") if part else F.lit(0).cast("long")).alias("part"), F.col(text).alias("text"))
    # plain searches first: most texts have one heading, and a regular expression reads a text letter by letter
    lines = src.withColumn("text", F.when(F.contains("text", F.lit("\r")), F.replace(F.replace("text", F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))).otherwise(F.col("text")))
    cut = F.when(F.contains("text", F.lit(OPENING)), F.split("text", BOUNDARY)).otherwise(F.array("text"))
    pieces = lines.select("file_name", "part", F.posexplode(cut).alias("unit_pos", "body"))
    pieces = pieces.withColumn("body", T.strip(F.col("body"))).where(F.col("body").startswith("## "))
    head = pieces.withColumn("h", T.unit_header(T.first_line(F.col("body"))))
    return head.select("file_name", "part", "unit_pos", "h.tag", "h.priority", "h.title", "body", T.fingerprint(F.col("body")).alias("fingerprint"))


def scan_units(files: DataFrame, name: str = "file_name", text: str = "text") -> DataFrame:
    """(file_name, unit_no, title, content): the line scanner, for which any line that starts "## " opens a unit."""
    pieces = files.select(F.col(name).alias("file_name"), F.posexplode(F.split(F.concat(F.lit("\n"), F.col(text)), r"\n(?=## )")).alias("unit_no", "raw"))
    pieces = pieces.where(F.col("unit_no") > 0)
    return pieces.select("file_name", "unit_no", T.strip(F.substring(T.first_line(F.col("raw")), 4, 1 << 30)).alias("title"), T.strip(F.col("raw")).alias("content"))


def split_topics(texts: DataFrame, name: str, text: str) -> DataFrame:
    """(name, file_name, content): parts at first-level headings; a blank part still uses up a number."""
    pieces = texts.select(name, F.posexplode(F.split(F.regexp_replace(F.col(text), "^\n+", ""), r"\n(?=# )")).alias("i", "content"))
    pieces = pieces.withColumn("content", T.strip(F.col("content"))).where("content <> ''")
    title = T.strip(F.regexp_replace(T.first_line(F.col("content")), rf"^#+{T.SPACE}*", ""))
    number = F.lpad((F.col("i") + 1).cast("string"), 2, "0")
    wide = F.when(F.col("i") + 1 > 99, (F.col("i") + 1).cast("string")).otherwise(number)
    return pieces.select(name, F.concat(wide, F.lit("_"), T.safe_filename(title), F.lit(".md")).alias("file_name"), "content")


def distinct_units(units: DataFrame, order: list[str], key: str = "fingerprint") -> DataFrame:
    """The first unit, by `order`, of each fingerprint. Equal fingerprints pre-aggregate map-side."""
    rest = [c for c in units.columns if c != key]
    first = units.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("u"))
    return first.select(key, "u.*").select(*units.columns)


def numbered(units: DataFrame, by: list[str], order: list, name: str) -> DataFrame:
    return units.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
