"""Left joins to a dimension table."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as f
from pyspark.sql.types import AtomicType, BinaryType, StringType, StructField

ROLES = ("Pickup", "Dropoff")

BROADCAST_BYTES = 32 * 1024 * 1024
ROW_BYTES = 32  # what a row costs in a hash table besides its fields
FIELD_BYTES = 16  # the widest field of fixed size


def broadcast_if_small(
    dim: DataFrame, max_bytes: int = BROADCAST_BYTES, key: str | None = None
) -> DataFrame:
    """``dim`` with a broadcast hint if its measured size is at most ``max_bytes``.

    With ``key`` the same aggregate checks that the key is unique and never null: a doubled key
    would double facts, so it is an error.

    Meant for a dimension that is itself the result of a query, whose size the optimizer
    can only guess; for a plain file its own threshold on the file size is enough. The
    measurement is one aggregate over ``dim`` (an action). Above the limit ``dim`` comes
    back unhinted and the join shuffles; adaptive execution then splits hot keys. So does a
    dimension with nested columns, whose size is not measured.
    """
    flat = all(isinstance(field.dataType, AtomicType) for field in dim.schema)
    if not flat and key is None:
        return dim
    fields = dim.schema if flat else []
    row_bytes = reduce(add, [_width(field) for field in fields], f.lit(ROW_BYTES))
    measures = [f.coalesce(f.sum(row_bytes), f.lit(0)).alias("bytes")]
    if key is not None:
        measures += [f.count("*").alias("rows"), f.count_distinct(f.col(key)).alias("keys")]
    found = dim.agg(*measures).first()
    if key is not None and found["rows"] != found["keys"]:
        raise ValueError(f"{key} has {found['keys']} different values in {found['rows']} rows")
    return f.broadcast(dim) if flat and found["bytes"] <= max_bytes else dim


def _width(field: StructField) -> Column:
    if isinstance(field.dataType, (StringType, BinaryType)):
        return f.coalesce(f.octet_length(f.col(f"`{field.name}`")), f.lit(0))
    return f.lit(FIELD_BYTES)


def left_join_dimension(facts: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Every fact row with the dimension's other columns, null where the key is unknown."""
    return facts.join(dim, facts[key] == dim[dim_key], "left").drop(dim[dim_key])


def enrich(trips: DataFrame, zones: DataFrame, roles: tuple[str, ...] = ROLES) -> DataFrame:
    """Borough, zone and service zone of each role's location.

    The dimension is projected to its own column names per role, so both uses of it stay
    apart; with a broadcast the two roles share one exchange.
    """
    for role in roles:
        named = zones.select(
            f.col("LocationID").alias(f"{role}_Key"),
            f.col("Borough").alias(f"{role}_Borough"),
            f.col("Zone").alias(f"{role}_Zone"),
            f.col("service_zone").alias(f"{role}_Service_Zone"),
        )
        trips = left_join_dimension(trips, named, f"{role}_Location_ID", f"{role}_Key")
    return trips
