"""Parquet output and table registration."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as f
from pyspark.sql.types import StructType

from tripmetrics.schemas import CLEAN
from tripmetrics.sources.folders import delete, qualified, refuse_inputs, replacing, subfolders
from tripmetrics.sources.reading import data_files, layouts

#: Partitions of a table: the values of its partition columns.
Partitions = list[dict[str, Any]]


#: From the rows as they move to what is written.
Derive = Callable[[DataFrame], DataFrame]

#: Folders that a task writes to at once; Spark sorts what a task has for further ones.
OPEN_FOLDERS = 100
_AT_ONCE = "spark.sql.maxConcurrentOutputFileWriters"


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    derive: Derive | None = None,
) -> int:
    """Replace ``path`` by ``df`` and return the number of rows written.

    Without ``partition_by`` the rows are written where they are, with no shuffle. With it
    they are rebalanced on those columns first: a folder then gets few large files, and
    adaptive execution splits a folder that holds much of the data over several tasks. A task
    keeps a file open for each of its folders, so nothing is sorted and nothing spills; a session
    that sets ``spark.sql.maxConcurrentOutputFileWriters`` decides itself how many, and with 0 has
    rows sorted.

    ``derive`` is applied to the rows where they are written, so columns that follow from
    others of their row are neither moved nor sorted. It keeps the columns of ``partition_by``.

    The old files go when the new ones are complete, so a failed write changes nothing. A frame
    that reads from ``path`` is an error.
    """
    return write_observed(df, path, partition_by, derive)["rows"]


def write_observed(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    derive: Derive | None = None,
    **measures: Column,
) -> dict[str, Any]:
    """``write_table`` that also returns aggregates of the rows, with ``rows`` among them, and with
    ``partition_by`` the ``partitions``.

    They are observed right at the write, so they cost no second pass.
    """
    refuse_inputs(df, path)
    with replacing(df.sparkSession, path) as fresh:
        return _write(df, fresh, partition_by, derive=derive, **measures)


def _write(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
    derive: Derive | None = None,
    **measures: Column,
) -> dict[str, Any]:
    aggregates = [measure.alias(name) for name, measure in measures.items()]
    if partition_by:
        # as many as folders are written
        aggregates.append(f.collect_set(f.struct(*partition_by)).alias("partitions"))
    written = Observation()
    with _open_folders(df.sparkSession):
        df = _arranged(df, partition_by, derive)
        writer = df.observe(written, f.count("*").alias("rows"), *aggregates).write.mode(mode)
        if partition_by:
            # only the folders that get rows are replaced
            writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
        writer.parquet(path)
    found = dict(written.get)
    if partition_by:
        found["partitions"] = [row.asDict() for row in found["partitions"]]
    return found


@contextmanager
def _open_folders(spark: SparkSession) -> Iterator[None]:
    """Writes in the block keep up to ``OPEN_FOLDERS`` files open, unless the session says else."""
    if spark.conf.get(_AT_ONCE, None) is not None:
        yield
        return
    spark.conf.set(_AT_ONCE, str(OPEN_FOLDERS))
    try:
        yield
    finally:
        spark.conf.unset(_AT_ONCE)


def _arranged(
    df: DataFrame, partition_by: list[str] | None, derive: Derive | None = None
) -> DataFrame:
    """The rows as they are written, moved to their folders."""
    if partition_by:
        df = df.hint("rebalance", *[f.col(name) for name in partition_by])
    if derive and partition_by and int(df.sparkSession.conf.get(_AT_ONCE, "0")) <= 0:
        # sorted for the folders before they widen; the write then finds them in order
        df = df.sortWithinPartitions(*partition_by)
    return derive(df) if derive else df


def write_partitions(df: DataFrame, path: str, partition_by: list[str]) -> dict[str, Any]:
    """Replace the folders that ``df`` has rows for; returns ``rows`` and ``partitions``.

    All other folders stay. A frame that reads from ``path`` is an error.
    """
    refuse_inputs(df, path)
    return _write(df, path, partition_by)


def copy_parquet(spark: SparkSession, source: str, target: str) -> int:
    """Copy a parquet file or folder and return its row count.

    Files whose schemas merge are one layout and are copied together, each layout by itself: a
    column that only some files have arrives, and so do types that differ between files
    (``read_months`` reads such a copy). Partition folders become columns. ``target`` changes
    when all is copied.
    """
    rows = 0
    with replacing(spark, target) as fresh:
        for found, members in layouts(spark, data_files(spark, [source])):
            for base, files in _by_base(members, qualified(spark, source)).items():
                part = _with_folder_columns(spark, found, base, files)
                refuse_inputs(part, target)
                rows += _write(part, fresh, mode="append")["rows"]
    return rows


def _by_base(files: list[str], source: str) -> dict[str, list[str]]:
    """Files by the folder that holds their first ``name=value`` folder; "" if they have none."""
    groups: dict[str, list[str]] = {}
    for file in files:
        folders = file.split(urlsplit(source).path, 1)[-1].split("/")[:-1]
        first = next((n for n, folder in enumerate(folders) if "=" in folder), None)
        base = "" if first is None else source + "/".join(folders[:first])
        groups.setdefault(base, []).append(file)
    return groups


def _with_folder_columns(
    spark: SparkSession, schema: StructType, base: str, files: list[str]
) -> DataFrame:
    """The files of one layout; folders below ``base`` are columns, typed by all that are there."""
    if not base:
        return spark.read.schema(schema).parquet(*files)
    probe = StructType().add("__column_of_no_file", "string")
    folders = list(spark.read.schema(probe).parquet(base).schema)[1:]
    known = {field.name.lower() for field in folders}
    own = [field for field in schema if field.name.lower() not in known]
    return spark.read.option("basePath", base).schema(StructType(own + folders)).parquet(*files)


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    partition_by: list[str] | None = None,
    schema: StructType = CLEAN,
    replace: bool = False,
    partitions: Partitions | None = None,
) -> None:
    """Make the parquet files at ``path`` a SQL table.

    The columns are declared, so no footer is read and the files may come later. Registering
    again after an overwrite makes the new files visible. A table of that name with another
    location, other columns or other partitions would show old rows or none: it is an error,
    or with ``replace`` its definition is dropped (the files are external and stay).

    ``partitions`` are those there are, as a write returns them; without them the folders are
    listed.
    """
    partition_by = partition_by or []
    if check_table(spark, name, path, partition_by, schema, replace):
        spark.sql("DROP TABLE IDENTIFIER(:name)", {"name": name})
    columns = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in schema)
    folders = ", ".join(f"`{column}`" for column in partition_by)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({columns}) USING PARQUET "
        + (f"PARTITIONED BY ({folders}) " if folders else "")
        + "LOCATION :path",
        {"name": name, "path": path},
    )
    if folders and partitions is None:
        spark.catalog.recoverPartitions(name)
    elif folders:
        wanted = {_folder(spec, partition_by) for spec in partitions}
        known = spark.sql("SHOW PARTITIONS IDENTIFIER(:name)", {"name": name}).collect()
        gone = [row[0] for row in known if row[0] not in wanted]
        drop_partitions(spark, name, [_named(folder) for folder in gone])
        add_partitions(spark, name, partitions)
    spark.catalog.refreshTable(name)


def check_table(
    spark: SparkSession,
    name: str,
    path: str,
    partition_by: list[str] | None = None,
    schema: StructType = CLEAN,
    replace: bool = False,
) -> list[str]:
    """In what an existing table differs from the wanted one; an error without ``replace``."""
    if not spark.catalog.tableExists(name):
        return []
    differing = _differences(spark, name, path, partition_by or [], schema)
    if differing and not replace:
        raise ValueError(f"table {name} exists with other {', '.join(differing)}")
    return differing


def drop_partitions(spark: SparkSession, name: str, partitions: Partitions) -> None:
    """Forget these partitions; their files stay."""
    _alter(spark, name, "DROP IF EXISTS", partitions)
    spark.catalog.refreshTable(name)


def add_partitions(spark: SparkSession, name: str, partitions: Partitions) -> None:
    """Make the folders of these partitions visible; no other folder is looked at."""
    _alter(spark, name, "ADD IF NOT EXISTS", partitions)
    spark.catalog.refreshTable(name)


_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _folder(spec: dict[str, Any], partition_by: list[str]) -> str:
    """The catalog's name of a partition."""
    values = {name: _NO_VALUE if spec[name] is None else spec[name] for name in partition_by}
    return "/".join(f"{name}={value}" for name, value in values.items())


def _named(folder: str) -> dict[str, Any]:
    pairs = (part.split("=", 1) for part in folder.split("/"))
    return {name: None if value == _NO_VALUE else unquote(value) for name, value in pairs}


def _alter(spark: SparkSession, name: str, action: str, partitions: Partitions) -> None:
    separator = ", " if action.startswith("DROP") else " "
    for at in range(0, len(partitions), 500):
        specs = separator.join(f"PARTITION ({_values(s)})" for s in partitions[at : at + 500])
        spark.sql(f"ALTER TABLE IDENTIFIER(:name) {action} {specs}", {"name": name})


def _values(spec: dict[str, Any]) -> str:
    def literal(value: Any) -> str:
        if value is None:
            return "null"
        escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"

    return ", ".join(f"`{name}` = {literal(value)}" for name, value in spec.items())


def publish_table(
    df: DataFrame,
    name: str,
    root: str,
    partition_by: list[str] | None = None,
    schema: StructType = CLEAN,
    keep: int = 2,
) -> dict[str, Any]:
    """Write ``df`` as a new version below ``root``, then point the table ``name`` at it.

    Returns ``rows``, the ``version`` (its path) and with ``partition_by`` the ``partitions``. The
    table shows the old version until the new one is complete, and for good if the write fails.
    Nothing is renamed, so this suits object stores. ``df`` may read the table itself. The
    newest ``keep`` versions (two at least, so that running readers finish) stay, older ones go.
    """
    spark = df.sparkSession
    version = f"{root.rstrip('/')}/v{time.time_ns():020d}-{uuid.uuid4().hex[:6]}"
    try:
        found = _write(df.select(*schema.names), version, partition_by)
    except BaseException:
        delete(spark, version)
        raise
    differing: list[str] = []
    exists = spark.catalog.tableExists(name)
    if exists:
        differing = _differences(spark, name, version, partition_by or [], schema)
    if exists and differing == ["location"] and not partition_by:
        escaped = version.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE IDENTIFIER(:name) SET LOCATION '{escaped}'", {"name": name})
        spark.catalog.refreshTable(name)
    else:
        # folders of partitions have places of their own in the catalog, so these move together
        register_table(
            spark, name, version, partition_by, schema, True, found.get("partitions")
        )
    versions = [folder for folder in subfolders(spark, root) if folder.startswith("v")]
    for folder in versions[: -max(keep, 2)]:
        delete(spark, f"{root.rstrip('/')}/{folder}")
    return found | {"version": version}


def _differences(
    spark: SparkSession, name: str, path: str, partition_by: list[str], schema: StructType
) -> list[str]:
    """In what an existing table differs from the wanted one."""
    described = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:name)", {"name": name}).collect()
    location = next((row.data_type for row in described if row.col_name == "Location"), "")
    catalog = spark.catalog.listColumns(name)
    found = {
        "location": qualified(spark, location),
        "columns": sorted((c.name, c.dataType) for c in catalog),
        "partitions": [c.name for c in catalog if c.isPartition],
    }
    wanted = {
        "location": qualified(spark, path),
        "columns": sorted((c.name, c.dataType.simpleString()) for c in schema),
        "partitions": partition_by,
    }
    return [what for what in wanted if wanted[what] != found[what]]
