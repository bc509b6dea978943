"""Unit Markdown arriving as files, taken in by micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillstone.operators.units import parse_units


def watch_extracts(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of (file_name, text) of new .md files."""
    df = spark.readStream.option("pathGlobFilter", "*.md").text(folder, wholetext=True)
    return df.select(F.lower(F.col("_metadata.file_name")).alias("file_name"), F.regexp_replace("value", "\r\n?", "\n").alias("text"))


def ingest(spark: SparkSession, folder: str, units_path: str, checkpoint: str) -> StreamingQuery:
    """Append units whose fingerprint the table doesn't have yet; runs until the folder is read, then stops.

    A batch is keyed by its number: one that runs again after a failure replaces its own partition.
    """

    def take(batch: DataFrame, number: int) -> None:
        units = parse_units(batch).dropDuplicates(["fingerprint"])
        try:
            known = spark.read.parquet(units_path).where(F.col("batch") != number).select("fingerprint")
            units = units.join(known, "fingerprint", "left_anti")
        except Exception as e:  # the table isn't there before the first batch
            if "PATH_NOT_FOUND" not in str(e):
                raise
        units.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(units_path)

    return watch_extracts(spark, folder).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
