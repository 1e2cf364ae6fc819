"""Intermediate tables in the storage that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

_roots: dict[str, tuple[str, Callable[[], None]]] = {}


def shared_root(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``; deleted when Python ends.

    Only a local session without that setting uses a temporary folder; a cluster needs it.
    """
    app = spark.sparkContext.applicationId
    if app not in _roots:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
            shared = tempfile.mkdtemp(prefix="tripmetrics-")
        root = f"{shared.rstrip('/')}/{app}-{uuid.uuid4().hex[:8]}"
        _roots[app] = root, _deleter(spark, root)
        atexit.register(_roots[app][1])
    return _roots[app][0]


def _deleter(spark: SparkSession, root: str) -> Callable[[], None]:
    """What deletes ``root``, also after the session has stopped."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def delete() -> None:
        try:
            system.delete(path, True)
        except (Py4JError, OSError):  # the JVM has ended before Python
            print(f"intermediate files stay in {root}")

    return delete


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``shared_root``."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as parquet to shared storage and read back.

    What follows starts from files that outlive any executor, and sees values that no longer
    change (row numbers, for instance).
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cleanup(spark: SparkSession) -> None:
    """Delete all intermediate files of this application now."""
    _, delete = _roots.pop(spark.sparkContext.applicationId, ("", lambda: None))
    atexit.unregister(delete)
    delete()
