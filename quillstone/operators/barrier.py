"""Cutting lineage where a result is read several times."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dir: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where it is unset, a fresh one, in local mode only (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if "dir" not in _own_dir:
        _own_dir["dir"] = tempfile.mkdtemp(prefix="quillstone-")
        atexit.register(shutil.rmtree, _own_dir["dir"], ignore_errors=True)
    return _own_dir["dir"]


def settled(df: DataFrame, name: str = "settled") -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends at files that every executor can
    see, so a lost executor costs no earlier work, no column is worked out again for each of its uses, and the
    planner knows its size. The files go when the application ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)
