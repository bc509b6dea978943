"""Session defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "quillstone", **conf: str) -> SparkSession:
    """A session with adaptive execution, skew joins and ANSI arithmetic on; the cluster's own settings win."""
    b = SparkSession.builder.appName(name)
    defaults = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.ansi.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.speculation": "false"}
    for k, v in (defaults | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()
