"""Every query by name: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as f
from pyspark.sql.types import DecimalType

from checks.trip_frame import (
    DRIFT_YEAR,
    is_legacy,
    legacy_layout,
    once,
    raw_root,
    trips,
    year_template,
    zones,
)
from tripmetrics import operators as op
from tripmetrics.functions import code_label, kilometres, month_label
from tripmetrics.plans import jobs, metrics
from tripmetrics.schemas import (
    BIGINT,
    CLEAN,
    DOUBLE,
    INT,
    PAYMENT_TYPES,
    RATE_CODES,
    STANDARD,
    VENDORS,
    columns,
)
from tripmetrics.sources import (
    copy_parquet,
    load_year,
    publish_table,
    read_months,
    read_table,
    read_zones,
    register_table,
    shared_path,
    write_table,
)

Query = Callable[[SparkSession, str], DataFrame]

LAST_MONTH = 10
PREVIEW_ROWS = 10
TOP_ZONES = 5

WIDE_CASTS = columns(VendorID=INT, passenger_count=BIGINT, trip_distance=DOUBLE)


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Sums and means of doubles depend on the order of rows in their last digits."""
    return df.withColumns({name: f.round(name, places) for name, places in digits.items()})


# The frames queries start from.


def _renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.rename(trips(spark, sf_dir))


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.with_duration(_renamed(spark, sf_dir))


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.prepare(trips(spark, sf_dir))


def _tidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.tidy(trips(spark, sf_dir))


def _with_zone(spark: SparkSession, sf_dir: str, *roles: str) -> DataFrame:
    return op.enrich(_tidy(spark, sf_dir), zones(spark, sf_dir), roles)


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.clean(trips(spark, sf_dir), zones(spark, sf_dir))


# Sources and sinks.


def scan_year_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_months(spark, [raw_root(spark, sf_dir)])


def scan_parquet_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = raw_root(spark, sf_dir)
    return read_months(spark, [f"{root}/current", f"{root}/legacy"])


def scan_year_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_year(spark, year_template(spark, sf_dir, DRIFT_YEAR), DRIFT_YEAR, LAST_MONTH)


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "staged")
    jobs.stage(spark, [raw_root(spark, sf_dir)], path)
    return read_table(spark, path)


def _zones_csv(spark: SparkSession, sf_dir: str) -> str:
    path = shared_path(spark, "zones")
    zones(spark, sf_dir).write.option("header", True).csv(path)
    return path


def scan_csv_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = read_zones(spark, _zones_csv(spark, sf_dir))
    pickups = trips(spark, sf_dir).groupBy("PULocationID").agg(f.count("*").alias("pickups"))
    return op.left_join_dimension(dim, pickups, "LocationID", "PULocationID")


def sink_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "cleaned")
    write_table(_cleaned(spark, sf_dir), path, ["Year"])
    return read_table(spark, path, CLEAN)


def write_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the writes report, next to what is then there."""
    staged, cleaned, copy = (shared_path(spark, name) for name in ("staged", "cleaned", "copy"))
    reported = {
        staged: ("staged", jobs.stage(spark, [raw_root(spark, sf_dir)], staged)),
        cleaned: ("cleaned", write_table(_cleaned(spark, sf_dir), cleaned, ["Year"])),
        copy: ("copied", copy_parquet(spark, f"{sf_dir}/lineitem.parquet", copy)),
    }
    return op.union_all(
        [
            read_table(spark, path).agg(
                f.lit(what).alias("output"),
                f.lit(rows).cast("bigint").alias("rows_reported"),
                f.count("*").alias("rows_stored"),
            )
            for path, (what, rows) in reported.items()
        ]
    )


def copy_parquet_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "copy")
    copy_parquet(spark, f"{sf_dir}/lineitem.parquet", path)
    return read_table(spark, path)


def copy_mixed_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw months of both layouts in one folder, copied and read again."""
    path = shared_path(spark, "mixed_copy")
    copy_parquet(spark, raw_root(spark, sf_dir), path)
    return read_months(spark, [path])


def published_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table published three times; it shows the last version, of which two are kept."""
    root, table = shared_path(spark, "versions"), _table_name()
    cleaned = _cleaned(spark, sf_dir)
    publish_table(cleaned.filter("Year < 1999"), table, root)
    publish_table(spark.table(table).filter("Year < 1995"), table, root)
    publish_table(cleaned, table, root)
    return spark.table(table)


def update_one_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some years cleaned again over a table with a folder per year, which had other rows."""
    staged, path, table = shared_path(spark, "staged"), shared_path(spark, "cleaned"), _table_name()
    jobs.stage(spark, [raw_root(spark, sf_dir)], staged)
    config = jobs.JobConfig([], _zones_csv(spark, sf_dir), staged, path, table, ["Year"])
    before = _cleaned(spark, sf_dir).filter(f.col("Year").isin(1993, 1995, 1996) & (f.col("payment_type") < 4))
    write_table(before, path, ["Year"])
    register_table(spark, table, path, ["Year"])
    jobs.clean_years(spark, config, [1995, 1997])
    return spark.table(table).select(*CLEAN.names)


def _table_name() -> str:
    return f"cleaned_{uuid.uuid4().hex}"


def _cleaned_table(spark: SparkSession, sf_dir: str) -> str:
    """Name of the cleaned table in the catalog, written once a session."""

    def build() -> str:
        path, table = shared_path(spark, "cleaned"), _table_name()
        write_table(_cleaned(spark, sf_dir), path)
        register_table(spark, table, path)
        return table

    return once(spark, sf_dir, "cleaned_table", build)


def _on_table(sql: str) -> Query:
    """A query written as SQL on the registered table."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(sql, {"cleaned": _cleaned_table(spark, sf_dir)})

    return query


external_table_sql = _on_table(
    """
    SELECT Pickup_Borough, count(*) AS trip_count,
           round(avg(trip_distance_miles), 8) AS avg_distance
    FROM IDENTIFIER(:cleaned)
    GROUP BY Pickup_Borough
    ORDER BY trip_count DESC, Pickup_Borough NULLS LAST
    """
)

external_table_revenue_sql = _on_table(
    """
    SELECT Year, Month, round(sum(total_amount), 2) AS revenue
    FROM IDENTIFIER(:cleaned)
    GROUP BY Year, Month
    ORDER BY Year, Month
    """
)

external_table_count_sql = _on_table("SELECT count(*) AS row_count FROM IDENTIFIER(:cleaned)")


def external_table_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered flat, written again in folders by year, registered again."""
    path, table = shared_path(spark, "cleaned"), _table_name()
    cleaned = _cleaned(spark, sf_dir)
    write_table(cleaned.filter("Year < 1999"), path)
    register_table(spark, table, path)
    write_table(cleaned, path, ["Year"])
    register_table(spark, table, path, ["Year"], replace=True)
    return spark.table(table).select(*CLEAN.names)


# Conforming and unions.


def standardize_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.conform(legacy_layout(trips(spark, sf_dir)), STANDARD)


def add_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.conform(trips(spark, sf_dir).drop("tolls_amount", "store_and_fwd_flag"), STANDARD)


def cast_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        (f.col("l_partkey") * 40000000).alias("vendorid"),
        (f.col("l_extendedprice") / 7 - 3000).alias("PASSENGER_COUNT"),
        f.col("l_linenumber").alias("trip_distance"),
    )
    return op.conform(lineitem, WIDE_CASTS)


def cast_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals from and to other numbers; what does not fit is null."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        f.col("l_partkey").alias("small"),
        (f.col("l_orderkey").cast("decimal(38,0)") * 4611686018427387904).alias("large"),
    )
    target = columns(small=DecimalType(5, 2), large=BIGINT)
    fitted = op.conform(lineitem, target)
    return fitted.withColumn("small", f.col("small").cast("double"))


def mean_without_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    holed = trips(spark, sf_dir).withColumn(
        "tip_amount", f.coalesce("tip_amount", f.lit(float("nan")))
    )
    return metrics.global_mean(holed, "tip_amount")


def _halves(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    standard = trips(spark, sf_dir)
    return {
        "legacy": legacy_layout(standard.filter(is_legacy())),
        "current": standard.filter(~is_legacy()),
    }


def conform_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.conform_profile(_halves(spark, sf_dir), STANDARD)


def standardize_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    halves = _halves(spark, sf_dir).values()
    return op.union_all([op.conform(half, STANDARD) for half in halves])


def union_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    pickup = "tpep_pickup_datetime"
    months = read_months(spark, [raw_root(spark, sf_dir)]).groupBy(
        f.year(pickup).alias("pickup_year"), f.month(pickup).alias("pickup_month")
    )
    return months.agg(
        f.count("*").alias("trip_count"), f.count("VendorID").alias("vendor_count")
    )


# Filters.


def _kept_by(*names: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rules = op.trip_rules()
        return op.apply_rules(_timed(spark, sf_dir), {name: rules[name] for name in names})

    return query


def filter_non_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {name: r for name, r in op.trip_rules().items() if name.endswith("_not_negative")}
    return op.apply_rules(_prepared(spark, sf_dir), rules)


def filter_clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.apply_rules(_prepared(spark, sf_dir), op.trip_rules())


def audit_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.spot_check(filter_clean_trips(spark, sf_dir))


def audit_violations_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.spot_check(_timed(spark, sf_dir))


def rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.violations(_prepared(spark, sf_dir), op.trip_rules())


# Scalar functions.


def trip_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed(spark, sf_dir).select(
        "Trip_Pickup_DateTime", "Trip_Dropoff_DateTime", "trip_duration_min"
    )


def distance_km(spark: SparkSession, sf_dir: str) -> DataFrame:
    km = kilometres("trip_distance").alias("Trip_Distance_Km")
    return trips(spark, sf_dir).select("trip_distance", km)


def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pickup = "tpep_pickup_datetime"
    return trips(spark, sf_dir).select(
        pickup, f.year(pickup).alias("Year"), month_label(pickup).alias("Month")
    )


def _labelled(code: str, labels: dict[int, str]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return trips(spark, sf_dir).select(code, code_label(code, labels).alias("label"))

    return query


# Jobs.


def stage_clean_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = jobs.JobConfig(
        raw_paths=[raw_root(spark, sf_dir)],
        zones_path=_zones_csv(spark, sf_dir),
        staged_path=shared_path(spark, "staged"),
        cleaned_path=shared_path(spark, "cleaned"),
        table_name=_table_name(),
    )
    jobs.run(spark, config)
    return spark.table(config.table_name).select(*CLEAN.names)


MEANS = {"avg_km": 8, "avg_minutes": 8, "avg_tip": 8}

QUERIES: dict[str, Query] = {
    "scan_parquet_months": scan_parquet_months,
    "scan_parquet": scan_parquet,
    "scan_year_folder": scan_year_folder,
    "scan_year_months": scan_year_months,
    "scan_csv_dimension": scan_csv_dimension,
    "sink_parquet_roundtrip": sink_parquet_roundtrip,
    "copy_parquet": copy_parquet_table,
    "copy_mixed_folder": copy_mixed_folder,
    "published_versions": published_versions,
    "update_one_year": update_one_year,
    "write_counts": write_counts,
    "external_table_sql": external_table_sql,
    "external_table_revenue_sql": external_table_revenue_sql,
    "external_table_count_sql": external_table_count_sql,
    "external_table_rerun": external_table_rerun,
    "standardize_schema": standardize_schema,
    "cast_decimals": cast_decimals,
    "add_missing_column": add_missing_column,
    "cast_columns": cast_columns,
    "conform_profile": conform_profile,
    "union_months": union_months,
    "standardize_union": standardize_union,
    "rename_columns": _renamed,
    "fill_defaults": lambda spark, d: op.fill_defaults(_renamed(spark, d)),
    "impute_mean": lambda spark, d: op.impute_mean(_renamed(spark, d), "tip_amount"),
    "trip_duration": trip_duration,
    "distance_km": distance_km,
    "date_parts": date_parts,
    "label_vendor": _labelled("VendorID", VENDORS),
    "label_ratecode": _labelled("RatecodeID", RATE_CODES),
    "label_payment": _labelled("payment_type", PAYMENT_TYPES),
    "derive_columns": lambda spark, d: op.derive(_renamed(spark, d)),
    "filter_passenger_range": _kept_by("passenger_count_range"),
    "filter_distance_range": _kept_by("trip_distance_range"),
    "filter_distinct_zones": _kept_by("distinct_zones"),
    "filter_duration_range": _kept_by("trip_duration_min_range"),
    "filter_non_negative": filter_non_negative,
    "filter_clean_trips": filter_clean_trips,
    "audit_violations": audit_violations,
    "audit_violations_before": audit_violations_before,
    "rule_violations": rule_violations,
    "left_join_dimension": lambda spark, d: op.enrich(
        _renamed(spark, d), zones(spark, d), ("Pickup",)
    ),
    "enrich_zones": lambda spark, d: op.enrich(_renamed(spark, d), zones(spark, d)),
    "cleaned_projection": lambda spark, d: op.enrich(
        op.derive(_prepared(spark, d)), zones(spark, d)
    ).select(*CLEAN.names),
    "cleaned_trips": _cleaned,
    "stage_clean_register": stage_clean_register,
    "global_mean": lambda spark, d: metrics.global_mean(trips(spark, d), "tip_amount"),
    "row_count": lambda spark, d: metrics.row_count(trips(spark, d)),
    "cleaning_report": lambda spark, d: op.cleaning_report(_prepared(spark, d), op.trip_rules()),
    "rule_rejects": lambda spark, d: op.rule_rejects(_prepared(spark, d), op.trip_rules()),
    "mean_without_nan": mean_without_nan,
    "preview_limit": lambda spark, d: metrics.preview(_cleaned(spark, d), PREVIEW_ROWS),
    "borough_summary": lambda spark, d: _rounded(
        metrics.borough_summary(_with_zone(spark, d, "Pickup")), avg_distance=8
    ),
    "monthly_revenue": lambda spark, d: _rounded(
        metrics.monthly_revenue(_tidy(spark, d)), revenue=2
    ),
    "kpi_totals": lambda spark, d: _rounded(
        metrics.kpi_totals(_tidy(spark, d)), revenue=2, **MEANS
    ),
    "trips_by_hour": lambda spark, d: metrics.trips_by_hour(_tidy(spark, d)),
    "trips_by_month": lambda spark, d: _rounded(metrics.trips_by_month(_tidy(spark, d)), **MEANS),
    "pickup_borough_share": lambda spark, d: metrics.pickup_borough_share(
        _with_zone(spark, d, "Pickup")
    ),
    "dropoff_borough_share": lambda spark, d: metrics.dropoff_borough_share(
        _with_zone(spark, d, "Dropoff")
    ),
    "top_pickup_zones": lambda spark, d: metrics.top_pickup_zones(
        _with_zone(spark, d, "Pickup"), TOP_ZONES
    ),
    "top_dropoff_zones": lambda spark, d: metrics.top_dropoff_zones(
        _with_zone(spark, d, "Dropoff"), TOP_ZONES
    ),
    "borough_service_zone": lambda spark, d: metrics.borough_service_zone(
        _with_zone(spark, d, "Pickup")
    ),
    "vendor_summary": lambda spark, d: _rounded(
        metrics.vendor_summary(_tidy(spark, d)), revenue=2
    ),
    "payment_summary": lambda spark, d: metrics.payment_summary(_tidy(spark, d)),
    "ratecode_revenue": lambda spark, d: _rounded(
        metrics.ratecode_revenue(_tidy(spark, d)), revenue=2
    ),
    "surcharge_by_year": lambda spark, d: _rounded(
        metrics.surcharge_by_year(_tidy(spark, d)), **{name: 2 for name in metrics.SURCHARGES}
    ),
}
