"""Trips, zones and drifting raw months derived from the driver's tables.

One trip per ``lineitem`` row and nothing else, so deriving trips is one scan without a
shuffle: a query on them costs what it would cost on a trip file. Zones are nations with
their region; trips also go to two locations that no nation has.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as f

from tripmetrics.operators import broadcast_if_small
from tripmetrics.schemas import STANDARD
from tripmetrics.sources import month_paths, shared_path, write_table

DRIFT_YEAR = 1999
T = TypeVar("T")

# Kept short: filters on trips are evaluated on these expressions, and generated methods past
# a certain size are not compiled by the JVM.
_TRIP_COLUMNS = {
    "VendorID": "nullif(l_linenumber, 5)",
    "tpep_pickup_datetime": "timestampadd(SECOND, CAST(l_extendedprice AS BIGINT), l_shipdate)",
    "tpep_dropoff_datetime": (
        "timestampadd(SECOND, CAST(l_extendedprice * 1.08D - 100 AS BIGINT), l_shipdate)"
    ),
    "passenger_count": "l_partkey % 9",
    "trip_distance": "l_quantity * 4.07D",
    "RatecodeID": "nullif(l_suppkey % 9, 0)",
    "store_and_fwd_flag": "nullif(l_returnflag, 'R')",
    "PULocationID": "l_orderkey % 27",
    "DOLocationID": "l_partkey % 27",
    "payment_type": "l_partkey % 8",
    "fare_amount": "CASE WHEN l_linenumber <> 7 THEN l_extendedprice - 5000 END",
    "extra": "0.09D - nullif(l_discount, 0.05D)",
    "mta_tax": "l_tax - 0.01D",
    "tip_amount": "nullif(l_quantity, 13) - 2",
    "tolls_amount": "l_linenumber - 2D",
    "improvement_surcharge": "l_suppkey % 13 - 1D",
    "total_amount": "CASE WHEN l_linenumber <> 4 THEN l_extendedprice - l_discount * 200000 END",
    "congestion_surcharge": "nullif(l_linenumber, 6) - 3D",
    "Airport_fee": "nullif(l_discount, 0.07D) - 0.01D",
    "cbd_congestion_fee": f"CASE WHEN year(l_shipdate) >= {DRIFT_YEAR} THEN 0.07D - l_tax END",
}


#: The columns that trips are derived from.
_LINEITEM = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_shipdate",
)


def _trip_column(name: str) -> Column:
    return f.expr(_TRIP_COLUMNS[name]).cast(STANDARD[name].dataType).alias(name)


def _as_trips(lineitem: DataFrame, *further: str) -> DataFrame:
    return lineitem.select(*[_trip_column(name) for name in STANDARD.names], *further)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20-column standard trip frame."""
    return _as_trips(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone dimension, with a broadcast hint if it is small (measured once)."""

    def build() -> DataFrame:
        nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
        region = spark.read.parquet(f"{sf_dir}/region.parquet")
        service = f.when(f.col("n_nationkey") % 3 == 0, "Yellow Zone")
        service = service.when(f.col("n_nationkey") % 3 == 1, "Boro Zone").otherwise("Airports")
        return broadcast_if_small(
            nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select(
                f.col("n_nationkey").alias("LocationID"),
                f.col("r_name").alias("Borough"),
                f.col("n_name").alias("Zone"),
                service.alias("service_zone"),
            ),
            key="LocationID",
        )

    return once(spark, sf_dir, "zones", build)


def is_legacy() -> Column:
    """Whether a standard trip belongs to the years with the older layout; false if unknown."""
    return f.coalesce(f.year("tpep_pickup_datetime") < DRIFT_YEAR, f.lit(False))


def legacy_layout(standard: DataFrame) -> DataFrame:
    """Standard trips in the older layout: wide ids, fractional counts, other fee spelling.

    Ids that do not fit the target, NaN and fractions are put where conforming gives back
    the standard value.
    """
    wide = {
        "VendorID": f.coalesce(f.col("VendorID").cast("bigint"), f.lit(3000000000)),
        "passenger_count": f.col("passenger_count") + f.lit(0.9).cast("double"),
        "RatecodeID": f.coalesce(f.col("RatecodeID").cast("double"), f.lit(float("nan"))),
        "PULocationID": f.col("PULocationID").cast("bigint"),
        "DOLocationID": f.col("DOLocationID").cast("bigint"),
    }
    return (
        standard.withColumns(wide)
        .drop("cbd_congestion_fee")
        .withColumnRenamed("Airport_fee", "airport_fee")
    )


def raw_root(spark: SparkSession, sf_dir: str) -> str:
    """A folder of monthly parquet files in their drifting layouts, written once a session.

    Rows move to their months as the ten columns of ``lineitem`` that trips come from, half as
    wide as trips, which are derived where they are written.
    """

    def build() -> str:
        pickup = _trip_column("tpep_pickup_datetime")
        months = (
            spark.read.parquet(f"{sf_dir}/lineitem.parquet")
            .select(*_LINEITEM)
            .withColumns({"file_year": f.year(pickup), "file_month": f.month(pickup)})
        )
        folders = ["file_year", "file_month"]
        legacy = f.coalesce(f.col("file_year") < DRIFT_YEAR, f.lit(False))
        root = shared_path(spark, "raw")
        write_table(
            months.filter(legacy),
            f"{root}/legacy",
            folders,
            derive=lambda rows: legacy_layout(_as_trips(rows, *folders)),
        )
        write_table(
            months.filter(~legacy),
            f"{root}/current",
            folders,
            derive=lambda rows: _as_trips(rows, *folders),
        )
        return root

    return once(spark, sf_dir, "raw_root", build)


def year_template(spark: SparkSession, sf_dir: str, year: int) -> str:
    """The months of one year under the names that a template of year and month gives."""

    def build() -> str:
        template = shared_path(spark, "by_month") + "/{year}/trips_{year}-{month:02d}.parquet"
        one_year = trips(spark, sf_dir).filter(f.year("tpep_pickup_datetime") == year)
        for month, path in enumerate(month_paths(template, year, 12), 1):
            write_table(one_year.filter(f.month("tpep_pickup_datetime") == month), path)
        return template

    return once(spark, sf_dir, f"template_{year}", build)


_built: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], T]) -> T:
    """``build()``, remembered for the running application and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        _built[key] = build()
    return _built[key]
