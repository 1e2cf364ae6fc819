"""This package on the executors, for operators that run Python there."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import tripmetrics

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver found it; once a session.

    The archive lies on the driver, and Spark serves it to every executor that joins.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(tripmetrics.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="tripmetrics-code-")) / "tripmetrics.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
