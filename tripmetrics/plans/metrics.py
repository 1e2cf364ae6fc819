"""Questions on the cleaned table.

Every grouping key is a label, a zone name or a part of the date, so there are few groups
and each task shuffles one partial row per group, however many trips share a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as f

from tripmetrics.functions import exact_mean

SURCHARGES = (
    "extra_charges",
    "mta_tax",
    "improvement_surcharge",
    "congestion_surcharge",
    "Airport_fee",
    "cbd_congestion_fee",
)


def _trips() -> Column:
    return f.count("*").alias("trip_count")


def _revenue() -> Column:
    return f.sum("total_amount").alias("revenue")


def _trip_means() -> list[Column]:
    return [
        f.avg("Trip_Distance_Km").alias("avg_km"),
        f.avg("trip_duration_min").alias("avg_minutes"),
        f.avg("tip_amount").alias("avg_tip"),
    ]


def _busiest_first(df: DataFrame, *keys: str) -> DataFrame:
    ties = [f.col(key).asc_nulls_last() for key in keys]
    return df.orderBy(f.col("trip_count").desc_nulls_last(), *ties)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(f.count("*").alias("row_count"))


def global_mean(df: DataFrame, column: str) -> DataFrame:
    """The mean of a column; missing values and NaN do not count, as in the imputation."""
    return df.agg(exact_mean(column).alias(f"mean_{column}"))


def share(df: DataFrame, key: str, *measures: Column) -> DataFrame:
    """Trips per key and their percentage of all trips.

    The total is a scalar over the aggregated rows, which both read from one exchange; they are
    never gathered, however many keys there are.
    """
    counts = df.groupBy(key).agg(_trips(), *measures)
    everything = counts.agg(f.sum("trip_count")).scalar()
    percent = f.lit(100.0) * f.col("trip_count") / everything
    return _busiest_first(counts.withColumn("share_pct", percent), key)


def top_k(df: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` values of ``key`` with most trips; equal counts go by name."""
    return _busiest_first(df.groupBy(key).agg(_trips()), key).limit(k)


def preview(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows in the order of all columns, left to right."""
    return df.orderBy(*[f.col(name).asc_nulls_last() for name in df.columns]).limit(n)


def borough_summary(cleaned: DataFrame) -> DataFrame:
    means = f.avg("trip_distance_miles").alias("avg_distance")
    return _busiest_first(cleaned.groupBy("Pickup_Borough").agg(_trips(), means), "Pickup_Borough")


def monthly_revenue(cleaned: DataFrame) -> DataFrame:
    """Revenue per year and month, months in alphabetical order."""
    return (
        cleaned.groupBy("Year", "Month")
        .agg(_revenue())
        .orderBy(f.col("Year").asc_nulls_last(), f.col("Month").asc_nulls_last())
    )


def kpi_totals(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(_trips(), _revenue(), *_trip_means())


def trips_by_hour(cleaned: DataFrame) -> DataFrame:
    hour = f.hour("Trip_Pickup_DateTime").alias("pickup_hour")
    return cleaned.groupBy(hour).agg(_trips()).orderBy(f.col("pickup_hour").asc_nulls_last())


def trips_by_month(cleaned: DataFrame) -> DataFrame:
    """Trips and their means per month, in calendar order."""
    number = f.month("Trip_Pickup_DateTime").alias("month_number")
    return (
        cleaned.groupBy("Year", number, "Month")
        .agg(_trips(), *_trip_means())
        .orderBy(f.col("Year").asc_nulls_last(), f.col("month_number").asc_nulls_last())
    )


def pickup_borough_share(cleaned: DataFrame) -> DataFrame:
    return share(cleaned, "Pickup_Borough")


def dropoff_borough_share(cleaned: DataFrame) -> DataFrame:
    return share(cleaned, "Dropoff_Borough")


def top_pickup_zones(cleaned: DataFrame, k: int = 10) -> DataFrame:
    return top_k(cleaned, "Pickup_Zone", k)


def top_dropoff_zones(cleaned: DataFrame, k: int = 10) -> DataFrame:
    return top_k(cleaned, "Dropoff_Zone", k)


def borough_service_zone(cleaned: DataFrame) -> DataFrame:
    """Trips per borough and service zone, which shows the airports' part of a borough."""
    keys = ("Pickup_Borough", "Pickup_Service_Zone")
    return _busiest_first(cleaned.groupBy(*keys).agg(_trips()), *keys)


def vendor_summary(cleaned: DataFrame) -> DataFrame:
    return share(cleaned, "Vendor_Name", _revenue())


def payment_summary(cleaned: DataFrame) -> DataFrame:
    return share(cleaned, "Payment_Method")


def ratecode_revenue(cleaned: DataFrame) -> DataFrame:
    return (
        cleaned.groupBy("Ratecode_Description")
        .agg(_trips(), _revenue())
        .orderBy(f.col("revenue").desc_nulls_last(), "Ratecode_Description")
    )


def surcharge_by_year(cleaned: DataFrame) -> DataFrame:
    return (
        cleaned.groupBy("Year")
        .agg(*[f.sum(name).alias(name) for name in SURCHARGES])
        .orderBy(f.col("Year").asc_nulls_last())
    )
