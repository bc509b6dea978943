"""Row shapes and ordering keys of the knowledge-unit tables."""

from __future__ import annotations

from pyspark.sql import types as T

UNCATEGORISED = "未分类"
UNLABELLED = 3

UNIT = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("part", T.LongType()),
        T.StructField("unit_pos", T.IntegerType()),
        T.StructField("tag", T.StringType()),
        T.StructField("priority", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
    ]
)
#: Where a unit stands in the corpus. A struct of these columns sorts units; no global row number is needed.
UNIT_ORDER = ["file_name", "part", "unit_pos"]

JUDGMENT = T.StructType(
    [
        T.StructField("pair_key", T.StringType()),
        T.StructField("verdict", T.StringType()),
        T.StructField("keep_fp", T.StringType()),
        T.StructField("drop_fp", T.StringType()),
        T.StructField("merged_text", T.StringType()),
        T.StructField("ord", T.LongType()),
    ]
)
VERDICTS = ("DUPLICATE", "MERGE", "KEEP_BOTH")
