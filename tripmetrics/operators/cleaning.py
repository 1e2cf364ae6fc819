"""Renames, null handling and derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as f

from tripmetrics.functions import (
    code_label,
    duration_minutes,
    exact_mean,
    kilometres,
    month_label,
    without_nan,
)
from tripmetrics.schemas import ANALYST_NAMES, DEFAULTS, PAYMENT_TYPES, RATE_CODES, VENDORS


def rename(df: DataFrame) -> DataFrame:
    """Standard names to analyst names."""
    return df.withColumnsRenamed(ANALYST_NAMES)


def with_duration(df: DataFrame) -> DataFrame:
    minutes = duration_minutes("Trip_Pickup_DateTime", "Trip_Dropoff_DateTime")
    return df.withColumn("trip_duration_min", minutes)


def fill_defaults(df: DataFrame) -> DataFrame:
    """Constant per column for nulls (and NaN in double columns)."""
    return df.fillna({name: value for name, value in DEFAULTS.items() if name in df.columns})


def impute_mean(df: DataFrame, column: str, mean: float | None = None) -> DataFrame:
    """Missing values of ``column`` become its mean over all rows of ``df``.

    Without a known ``mean`` it is a scalar subquery: it stays part of the lazy plan, reads that
    one column, and reaches the row side as a constant, so there is no join. Call it before
    filtering.
    """
    value = df.agg(exact_mean(column)).scalar() if mean is None else f.lit(mean)
    return df.withColumn(column, f.coalesce(without_nan(column), value))


def derive(df: DataFrame) -> DataFrame:
    """Labels, kilometres, year and month; the distance is then named by its unit."""
    return df.withColumns(
        {
            "Vendor_Name": code_label("Vendor_ID", VENDORS),
            "Ratecode_Description": code_label("Ratecode_ID", RATE_CODES),
            "Payment_Method": code_label("payment_type", PAYMENT_TYPES),
            "Trip_Distance_Km": kilometres("trip_distance"),
            "Year": f.year("Trip_Pickup_DateTime"),
            "Month": month_label("Trip_Pickup_DateTime"),
        }
    ).withColumnRenamed("trip_distance", "trip_distance_miles")
