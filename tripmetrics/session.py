"""Session settings the results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(app_name: str, settings: dict[str, str] | None = None) -> SparkSession:
    """Session with UTC as its zone and adaptive execution on.

    A generated method of more than 8000 bytes is never compiled by the JVM; with the limit
    set to that, Spark splits such a stage into smaller ones instead of interpreting it.

    Master, memory, shuffle partitions and object-store credentials come from spark-submit
    or the cluster's defaults; ``settings`` is for callers that have neither.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
