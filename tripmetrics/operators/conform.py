"""Bring frames with drifting schemas to one schema, and union them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as f
from pyspark.sql.types import StructField, StructType

from tripmetrics.functions import fitting_cast


def _columns_by_lower_name(df: DataFrame) -> dict[str, StructField]:
    found: dict[str, StructField] = {}
    for field in df.schema.fields:
        other = found.setdefault(field.name.lower(), field)
        if other is not field:
            raise ValueError(f"columns {other.name!r} and {field.name!r} differ only by case")
    return found


def _source(field: StructField) -> Column:
    return f.col(f"`{field.name}`")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``: names, types and order.

    One projection. Names match ignoring case, so legacy spellings of a column are picked
    up; columns the target lacks are dropped; columns the source lacks become typed nulls.
    A value its target type cannot hold becomes null instead of failing the job.
    """
    found = _columns_by_lower_name(df)

    def target(field: StructField) -> Column:
        source = found.get(field.name.lower())
        if source is None:
            value = f.lit(None).cast(field.dataType)
        else:
            value = fitting_cast(_source(source), source.dataType, field.dataType)
        return value.alias(field.name)

    return df.select(*[target(field) for field in schema.fields])


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, duplicates kept; the schemas must be equal."""

    def shape(df: DataFrame) -> list[tuple[str, str]]:
        return [(field.name, field.dataType.simpleString()) for field in df.schema.fields]

    first = shape(frames[0])
    for number, df in enumerate(frames[1:], start=1):
        if shape(df) != first:
            raise ValueError(f"schema of frame {number} differs: {shape(df)} against {first}")
    return reduce(DataFrame.unionByName, frames)


def conform_profile(groups: dict[str, DataFrame], schema: StructType) -> DataFrame:
    """What conforming does to each group of raw files, one row per group and column.

    Columns: ``source_group, column_name, source_type, target_type, row_count, null_count,
    lost_count``; the last counts values the target type cannot hold. Each group is read
    once and aggregated to a single row before it is turned into rows.
    """
    return union_all([_profile(name, df, schema) for name, df in groups.items()])


def _profile(group: str, df: DataFrame, schema: StructType) -> DataFrame:
    found = _columns_by_lower_name(df)
    counts = [f.count("*").alias("rows")]
    for position, field in enumerate(schema.fields):
        source = found.get(field.name.lower())
        if source is not None:
            value = _source(source)
            fitted = fitting_cast(value, source.dataType, field.dataType)
            counts.append(f.count(value).alias(f"filled_{position}"))
            counts.append(f.count(fitted).alias(f"fitted_{position}"))
    totals = df.agg(*counts)

    def row(position: int, field: StructField) -> Column:
        source = found.get(field.name.lower())
        if source is None:
            filled = fitted = f.lit(0).cast("bigint")
        else:
            filled, fitted = f.col(f"filled_{position}"), f.col(f"fitted_{position}")
        return f.struct(
            f.lit(group).alias("source_group"),
            f.lit(field.name).alias("column_name"),
            f.lit(source.dataType.simpleString() if source else "absent").alias("source_type"),
            f.lit(field.dataType.simpleString()).alias("target_type"),
            f.col("rows").alias("row_count"),
            (f.col("rows") - filled).alias("null_count"),
            (filled - fitted).alias("lost_count"),
        )

    rows = f.array(*[row(position, field) for position, field in enumerate(schema.fields)])
    return totals.select(f.inline(rows))
