"""Output folders that change only when what replaces them is complete."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote, urlsplit

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as the catalog keeps it."""
    _, place = _located(spark, path)
    return place.toString().rstrip("/")


def refuse_inputs(df: DataFrame, path: str) -> None:
    """Raise if ``df`` reads files at or below ``path``: writing there would delete its input."""
    spark = df.sparkSession
    place = _located(spark, path)[1].toUri()
    target = (place.getScheme() or "", place.getAuthority() or "", place.getPath().rstrip("/"))
    for file in df.inputFiles():
        parts = urlsplit(file)
        found = (parts.scheme, parts.netloc, unquote(parts.path))
        if found[:2] == target[:2] and f"{found[2]}/".startswith(f"{target[2]}/"):
            raise ValueError(f"{path} holds input of what is to be written there: {file}")


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """A fresh folder beside ``path`` to write to; it takes the place of ``path`` at the end.

    Until then ``path`` stays as it is, and for good if the block raises. The change is two renames;
    if a driver dies between them, the old folder waits under its other name and the next use puts
    it back. Names begin with an underscore, so scans of the parent folder skip them. Object stores
    rename by copying; ``publish_table`` needs no rename.
    """
    system, place = _located(spark, path)
    parent, name = place.getParent().toString().rstrip("/"), place.getName()
    turn = uuid.uuid4().hex[:12]
    fresh, former = f"{parent}/_{name}.{turn}.new", f"{parent}/_{name}.{turn}.old"
    new, old = _path(spark, fresh), _path(spark, former)
    _put_back(spark, system, place)
    try:
        yield fresh
        existed = system.exists(place)
        if existed and not system.rename(place, old):
            raise OSError(f"{path} could not be renamed")
        if not system.rename(new, place):
            if existed:
                system.rename(old, place)
            raise OSError(f"{fresh} could not take the place of {path}")
        if existed:
            system.delete(old, True)
    except BaseException:
        system.delete(new, True)
        raise


def _put_back(spark: SparkSession, system: JavaObject, place: JavaObject) -> None:
    """If ``place`` is missing, give it the folder that an interrupted change moved away."""
    if system.exists(place):
        return
    parent = place.getParent()
    if not system.exists(parent):
        return
    start = f"_{place.getName()}."
    for status in system.listStatus(parent):
        name = status.getPath().getName()
        if name.startswith(start) and name.endswith(".old"):
            system.rename(status.getPath(), place)
            return


def delete(spark: SparkSession, path: str) -> None:
    system, place = _located(spark, path)
    system.delete(place, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, sorted; none if it does not exist."""
    system, place = _located(spark, path)
    if not system.exists(place):
        return []
    found = system.listStatus(place)
    return sorted(status.getPath().getName() for status in found if status.isDirectory())


def _path(spark: SparkSession, path: str) -> JavaObject:
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _located(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """File system and qualified path."""
    place = _path(spark, path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system, system.makeQualified(place)
