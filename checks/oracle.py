"""The same questions as SQL for an independent engine, written against the tables alone."""

from __future__ import annotations

from checks.registry import LAST_MONTH, PREVIEW_ROWS, TOP_ZONES
from checks.trip_frame import DRIFT_YEAR

# One trip per lineitem row.
_TRIPS = f"""
trips AS (
  SELECT
    NULLIF(l_linenumber, 5) AS VendorID,
    l_shipdate + to_seconds(trunc(l_extendedprice)) AS tpep_pickup_datetime,
    l_shipdate + to_seconds(trunc(l_extendedprice * 1.08::DOUBLE - 100))
      AS tpep_dropoff_datetime,
    l_partkey % 9 AS passenger_count,
    l_quantity * 4.07::DOUBLE AS trip_distance,
    NULLIF(l_suppkey % 9, 0) AS RatecodeID,
    NULLIF(l_returnflag, 'R') AS store_and_fwd_flag,
    CAST(l_orderkey % 27 AS INTEGER) AS PULocationID,
    CAST(l_partkey % 27 AS INTEGER) AS DOLocationID,
    l_partkey % 8 AS payment_type,
    CASE WHEN l_linenumber <> 7 THEN l_extendedprice - 5000 END AS fare_amount,
    0.09::DOUBLE - NULLIF(l_discount, 0.05::DOUBLE) AS extra,
    l_tax - 0.01::DOUBLE AS mta_tax,
    NULLIF(l_quantity, 13) - 2 AS tip_amount,
    CAST(l_linenumber - 2 AS DOUBLE) AS tolls_amount,
    CAST(l_suppkey % 13 - 1 AS DOUBLE) AS improvement_surcharge,
    CASE WHEN l_linenumber <> 4 THEN l_extendedprice - l_discount * 200000 END AS total_amount,
    CAST(NULLIF(l_linenumber, 6) - 3 AS DOUBLE) AS congestion_surcharge,
    NULLIF(l_discount, 0.07::DOUBLE) - 0.01::DOUBLE AS Airport_fee,
    CASE WHEN year(l_shipdate) >= {DRIFT_YEAR} THEN 0.07::DOUBLE - l_tax END AS cbd_congestion_fee
  FROM lineitem
)"""

_ZONES = """
zones AS (
  SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone,
         CASE n_nationkey % 3 WHEN 0 THEN 'Yellow Zone' WHEN 1 THEN 'Boro Zone'
              ELSE 'Airports' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

_RENAMED = """
renamed AS (
  SELECT * RENAME (
    VendorID AS Vendor_ID, RatecodeID AS Ratecode_ID, PULocationID AS Pickup_Location_ID,
    DOLocationID AS Dropoff_Location_ID, extra AS extra_charges,
    tpep_pickup_datetime AS Trip_Pickup_DateTime,
    tpep_dropoff_datetime AS Trip_Dropoff_DateTime)
  FROM trips
),
timed AS (
  SELECT *, round(CAST(date_diff('second', Trip_Pickup_DateTime, Trip_Dropoff_DateTime)
                       AS DOUBLE) / 60.0, 2) AS trip_duration_min
  FROM renamed
)"""

_FILLED_COLUMNS = """
    coalesce(Vendor_ID, 99) AS Vendor_ID,
    coalesce(Ratecode_ID, 99) AS Ratecode_ID,
    coalesce(store_and_fwd_flag, 'Unknown') AS store_and_fwd_flag,
    coalesce(fare_amount, 0) AS fare_amount,
    coalesce(extra_charges, 0) AS extra_charges,
    coalesce(mta_tax, 0) AS mta_tax,
    coalesce(cbd_congestion_fee, 0) AS cbd_congestion_fee"""

_PREPARED = f"""
mean_tip AS (SELECT avg(tip_amount) AS tip FROM trips),
prepared AS (
  SELECT timed.* REPLACE ({_FILLED_COLUMNS}, coalesce(tip_amount, mean_tip.tip) AS tip_amount)
  FROM timed CROSS JOIN mean_tip
)"""

_NON_NEGATIVE = """cbd_congestion_fee >= 0 AND Airport_fee >= 0 AND total_amount >= 0
    AND tip_amount >= 0 AND fare_amount >= 0 AND extra_charges >= 0
    AND improvement_surcharge >= 0 AND mta_tax >= 0"""

_RULES = f"""passenger_count BETWEEN 1 AND 6 AND trip_distance BETWEEN 0.1 AND 200
    AND Pickup_Location_ID <> Dropoff_Location_ID
    AND trip_duration_min BETWEEN 0.01 AND 120.1 AND {_NON_NEGATIVE}"""

_KEPT = f"kept AS (SELECT * FROM prepared WHERE {_RULES})"

_VENDOR = """CASE {0} WHEN 1 THEN 'Creative Mobile Technologies, LLC'
    WHEN 2 THEN 'Curb Mobility, LLC' WHEN 6 THEN 'Myle Technologies Inc' WHEN 7 THEN 'Helix'
    ELSE 'Unknown' END"""
_RATE = """CASE {0} WHEN 1 THEN 'Standard rate' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark'
    WHEN 4 THEN 'Nassau or Westchester' WHEN 5 THEN 'Negotiated fare' WHEN 6 THEN 'Group ride'
    ELSE 'Unknown' END"""
_PAYMENT = """CASE {0} WHEN 0 THEN 'Flex Fare trip' WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash'
    WHEN 3 THEN 'No Charge' WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip'
    ELSE 'Unknown' END"""


def _derived(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT * RENAME (trip_distance AS trip_distance_miles),
    {_VENDOR.format("Vendor_ID")} AS Vendor_Name,
    {_RATE.format("Ratecode_ID")} AS Ratecode_Description,
    {_PAYMENT.format("payment_type")} AS Payment_Method,
    round(trip_distance * 1.609::DOUBLE, 2) AS Trip_Distance_Km,
    CAST(year(Trip_Pickup_DateTime) AS INTEGER) AS Year,
    strftime(Trip_Pickup_DateTime, '%b') AS Month
  FROM {source}
)"""


_ZONE_COLUMNS = """{0}.Borough AS {1}_Borough, {0}.Zone AS {1}_Zone,
    {0}.service_zone AS {1}_Service_Zone"""
_PICKUP_COLUMNS = _ZONE_COLUMNS.format("pu", "Pickup")
_DROPOFF_COLUMNS = _ZONE_COLUMNS.format("dz", "Dropoff")
_PICKUP_JOIN = "LEFT JOIN zones pu ON Pickup_Location_ID = pu.LocationID"
_DROPOFF_JOIN = "LEFT JOIN zones dz ON Dropoff_Location_ID = dz.LocationID"


def _enriched(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT {source}.*, {_PICKUP_COLUMNS}, {_DROPOFF_COLUMNS}
  FROM {source} {_PICKUP_JOIN} {_DROPOFF_JOIN}
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


# The columns of a standard trip, with their types.
_STANDARD = {
    "VendorID": "int",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "bigint",
    "trip_distance": "double",
    "RatecodeID": "bigint",
    "store_and_fwd_flag": "string",
    "PULocationID": "int",
    "DOLocationID": "int",
    "payment_type": "bigint",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "Airport_fee": "double",
    "cbd_congestion_fee": "double",
}

_FROM_TRIPS = _with(_TRIPS)
_FROM_RENAMED = _with(_TRIPS, _ZONES, _RENAMED)
_FROM_PREPARED = _with(_TRIPS, _RENAMED, _PREPARED)
_FROM_KEPT = _with(_TRIPS, _RENAMED, _PREPARED, _KEPT)
_FROM_CLEANED = _with(
    _TRIPS,
    _ZONES,
    _RENAMED,
    _PREPARED,
    _KEPT,
    _derived("tidy", "kept"),
    _enriched("cleaned", "tidy"),
)
_CLEAN_LIST = """Vendor_ID, Vendor_Name, Trip_Pickup_DateTime, Trip_Dropoff_DateTime, passenger_count,
    Pickup_Location_ID, Pickup_Borough, Pickup_Zone, Pickup_Service_Zone, Dropoff_Location_ID,
    Dropoff_Borough, Dropoff_Zone, Dropoff_Service_Zone, Trip_Distance_Km, trip_distance_miles,
    Ratecode_ID, Ratecode_Description, payment_type, Payment_Method, trip_duration_min,
    fare_amount, extra_charges, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
    total_amount, congestion_surcharge, Airport_fee, cbd_congestion_fee, Year, Month"""
_CLEANED = f"{_FROM_CLEANED} SELECT {_CLEAN_LIST} FROM cleaned"


def _profile() -> str:
    """One SELECT per half and column; the legacy half differs in the columns named here."""
    legacy_types = {
        "VendorID": "bigint",
        "passenger_count": "double",
        "RatecodeID": "double",
        "PULocationID": "bigint",
        "DOLocationID": "bigint",
        "cbd_congestion_fee": "absent",
    }
    never_null = ("VendorID", "RatecodeID")  # the unfit values stand where nulls were
    selects = []
    for half, condition in (
        ("legacy", f"year(tpep_pickup_datetime) < {DRIFT_YEAR}"),
        ("current", f"year(tpep_pickup_datetime) >= {DRIFT_YEAR}"),
    ):
        for name, target in _STANDARD.items():
            source = legacy_types.get(name, target) if half == "legacy" else target
            nulls = f"count(*) - count({name})"
            unfit = half == "legacy" and name in never_null
            selects.append(
                f"SELECT '{half}' AS source_group, '{name}' AS column_name, "
                f"'{source}' AS source_type, '{target}' AS target_type, "
                f"count(*) AS row_count, {'0' if unfit else nulls} AS null_count, "
                f"{nulls if unfit else '0'} AS lost_count FROM trips WHERE {condition}"
            )
    return f"""{_FROM_TRIPS} SELECT source_group, column_name, source_type, target_type, row_count,
        CAST(null_count AS BIGINT) AS null_count, CAST(lost_count AS BIGINT) AS lost_count
        FROM ({" UNION ALL ".join(selects)})"""


_EACH_RULE = {
    "passenger_count_range": "passenger_count BETWEEN 1 AND 6",
    "trip_distance_range": "trip_distance BETWEEN 0.1 AND 200",
    "distinct_zones": "Pickup_Location_ID <> Dropoff_Location_ID",
    **{
        f"{name}_not_negative": f"{name} >= 0"
        for name in (
            "cbd_congestion_fee",
            "Airport_fee",
            "total_amount",
            "tip_amount",
            "fare_amount",
            "extra_charges",
            "improvement_surcharge",
            "mta_tax",
        )
    },
    "trip_duration_min_range": "trip_duration_min BETWEEN 0.01 AND 120.1",
}


def _rejects() -> str:
    fails = {name: f"(({rule}) IS NOT TRUE)::INT" for name, rule in _EACH_RULE.items()}
    total = " + ".join(fails.values())
    return f"""{_FROM_PREPARED} SELECT * FROM ({" UNION ALL ".join(
        f"SELECT '{name}' AS rule, CAST(sum({fail}) AS BIGINT) AS failing, "
        f"count(*) FILTER (WHERE {fail} = 1 AND {total} = 1) AS failing_only FROM prepared"
        for name, fail in fails.items()
    )})"""


def _share(key: str, extra: str = "") -> str:
    return f"""{_FROM_CLEANED} SELECT {key}, count(*) AS trip_count,
        100.0::DOUBLE * count(*) / (SELECT count(*) FROM cleaned) AS share_pct
        {extra} FROM cleaned GROUP BY {key}"""


def _top(key: str) -> str:
    return f"""{_FROM_CLEANED} SELECT {key}, count(*) AS trip_count FROM cleaned
        GROUP BY {key} ORDER BY trip_count DESC, {key} ASC NULLS LAST LIMIT {TOP_ZONES}"""


def _timed_where(condition: str) -> str:
    return f"{_FROM_RENAMED} SELECT * FROM timed WHERE {condition}"


def _label(code: str, case: str) -> str:
    return f"{_FROM_TRIPS} SELECT {code}, {case.format(code)} AS label FROM trips"


_MEANS = """round(avg(Trip_Distance_Km), 8) AS avg_km,
    round(avg(trip_duration_min), 8) AS avg_minutes, round(avg(tip_amount), 8) AS avg_tip"""
_SPOT = "passenger_count = 0 OR trip_distance > 200 OR trip_duration_min > 120.1"
_BOROUGHS = f"""{_FROM_CLEANED} SELECT Pickup_Borough, count(*) AS trip_count,
    round(avg(trip_distance_miles), 8) AS avg_distance FROM cleaned GROUP BY Pickup_Borough"""
_REVENUE = f"""{_FROM_CLEANED} SELECT Year, Month, round(sum(total_amount), 2) AS revenue
    FROM cleaned GROUP BY Year, Month"""
_ALL_TRIPS = f"{_FROM_TRIPS} SELECT * FROM trips"

ORACLE: dict[str, str] = {
    "scan_parquet_months": _ALL_TRIPS,
    "scan_parquet": _ALL_TRIPS,
    "scan_year_folder": _ALL_TRIPS,
    "scan_year_months": f"""{_ALL_TRIPS} WHERE year(tpep_pickup_datetime) = {DRIFT_YEAR}
        AND month(tpep_pickup_datetime) <= {LAST_MONTH}""",
    "write_counts": f"""{_FROM_CLEANED} SELECT output, n AS rows_reported, n AS rows_stored FROM (
        SELECT 'staged' AS output, count(*) AS n FROM trips
        UNION ALL SELECT 'cleaned', count(*) FROM cleaned
        UNION ALL SELECT 'copied', count(*) FROM lineitem)""",
    "external_table_rerun": _CLEANED,
    "cast_decimals": """SELECT CASE WHEN l_partkey < 1000 THEN CAST(l_partkey AS DOUBLE) END
        AS small, CASE WHEN l_orderkey < 2 THEN CAST(l_orderkey * 4611686018427387904::HUGEINT
        AS BIGINT) END AS large FROM lineitem""",
    "mean_without_nan": f"{_FROM_TRIPS} SELECT avg(tip_amount) AS mean_tip_amount FROM trips",
    "rule_rejects": _rejects(),
    "scan_csv_dimension": f"""{_with(_TRIPS, _ZONES)} SELECT zones.*, pickups FROM zones
        LEFT JOIN (SELECT PULocationID, count(*) AS pickups FROM trips GROUP BY PULocationID)
        ON LocationID = PULocationID""",
    "sink_parquet_roundtrip": _CLEANED,
    "copy_parquet": "SELECT * FROM lineitem",
    "copy_mixed_folder": _ALL_TRIPS,
    "published_versions": _CLEANED,
    "update_one_year": f"""{_CLEANED} WHERE Year IN (1995, 1997)
        OR (Year IN (1993, 1996) AND payment_type < 4)""",
    "external_table_sql": _BOROUGHS,
    "external_table_revenue_sql": _REVENUE,
    "external_table_count_sql": f"{_FROM_CLEANED} SELECT count(*) AS row_count FROM cleaned",
    "standardize_schema": f"""{_FROM_TRIPS} SELECT * REPLACE
        (CAST(NULL AS DOUBLE) AS cbd_congestion_fee) FROM trips""",
    "add_missing_column": f"""{_FROM_TRIPS} SELECT * REPLACE (CAST(NULL AS DOUBLE) AS tolls_amount,
        CAST(NULL AS VARCHAR) AS store_and_fwd_flag) FROM trips""",
    "cast_columns": """SELECT
        CAST(CASE WHEN l_partkey * 40000000 <= 2147483647 THEN l_partkey * 40000000 END
             AS INTEGER) AS VendorID,
        CAST(trunc(l_extendedprice / 7 - 3000) AS BIGINT) AS passenger_count,
        CAST(l_linenumber AS DOUBLE) AS trip_distance FROM lineitem""",
    "conform_profile": _profile(),
    "union_months": f"""{_FROM_TRIPS} SELECT
        CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
        CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
        count(*) AS trip_count, count(VendorID) AS vendor_count FROM trips GROUP BY 1, 2""",
    "standardize_union": _ALL_TRIPS,
    "rename_columns": f"{_FROM_RENAMED} SELECT * FROM renamed",
    "fill_defaults": f"{_FROM_RENAMED} SELECT * REPLACE ({_FILLED_COLUMNS}) FROM renamed",
    "impute_mean": f"""{_FROM_RENAMED} SELECT * REPLACE (coalesce(tip_amount,
        (SELECT avg(tip_amount) FROM trips)) AS tip_amount) FROM renamed""",
    "trip_duration": f"""{_FROM_RENAMED} SELECT Trip_Pickup_DateTime, Trip_Dropoff_DateTime,
        trip_duration_min FROM timed""",
    "distance_km": f"""{_FROM_TRIPS} SELECT trip_distance,
        round(trip_distance * 1.609::DOUBLE, 2) AS Trip_Distance_Km FROM trips""",
    "date_parts": f"""{_FROM_TRIPS} SELECT tpep_pickup_datetime,
        CAST(year(tpep_pickup_datetime) AS INTEGER) AS Year,
        strftime(tpep_pickup_datetime, '%b') AS Month FROM trips""",
    "label_vendor": _label("VendorID", _VENDOR),
    "label_ratecode": _label("RatecodeID", _RATE),
    "label_payment": _label("payment_type", _PAYMENT),
    "derive_columns": f"""{_with(_TRIPS, _RENAMED, _derived("derived", "renamed"))}
        SELECT * FROM derived""",
    "filter_passenger_range": _timed_where("passenger_count BETWEEN 1 AND 6"),
    "filter_distance_range": _timed_where("trip_distance BETWEEN 0.1 AND 200"),
    "filter_distinct_zones": _timed_where("Pickup_Location_ID <> Dropoff_Location_ID"),
    "filter_duration_range": _timed_where("trip_duration_min BETWEEN 0.01 AND 120.1"),
    "filter_non_negative": f"{_FROM_PREPARED} SELECT * FROM prepared WHERE {_NON_NEGATIVE}",
    "filter_clean_trips": f"{_FROM_KEPT} SELECT * FROM kept",
    "audit_violations": f"{_FROM_KEPT} SELECT * FROM kept WHERE {_SPOT}",
    "audit_violations_before": _timed_where(_SPOT),
    "rule_violations": f"{_FROM_PREPARED} SELECT * FROM prepared WHERE ({_RULES}) IS NOT TRUE",
    "left_join_dimension": f"""{_FROM_RENAMED} SELECT renamed.*, {_PICKUP_COLUMNS}
        FROM renamed {_PICKUP_JOIN}""",
    "enrich_zones": f"""{_with(_TRIPS, _ZONES, _RENAMED, _enriched("enriched", "renamed"))}
        SELECT * FROM enriched""",
    "cleaned_projection": f"""{_with(_TRIPS, _ZONES, _RENAMED, _PREPARED,
        _derived("derived", "prepared"), _enriched("enriched", "derived"))}
        SELECT {_CLEAN_LIST} FROM enriched""",
    "cleaned_trips": _CLEANED,
    "stage_clean_register": _CLEANED,
    "global_mean": f"{_FROM_TRIPS} SELECT avg(tip_amount) AS mean_tip_amount FROM trips",
    "row_count": f"{_FROM_TRIPS} SELECT count(*) AS row_count FROM trips",
    "cleaning_report": f"""{_FROM_PREPARED} SELECT count(*) AS original_count,
        count(*) FILTER (WHERE {_RULES}) AS kept_count,
        count(*) - count(*) FILTER (WHERE {_RULES}) AS dropped_count,
        round(100.0::DOUBLE * (count(*) - count(*) FILTER (WHERE {_RULES})) / count(*), 2)
          AS dropped_pct FROM prepared""",
    "preview_limit": f"""{_CLEANED} ORDER BY
        {", ".join(f"{name} ASC NULLS LAST" for name in _CLEAN_LIST.replace("\n", "").split(","))} LIMIT {PREVIEW_ROWS}""",
    "borough_summary": _BOROUGHS,
    "monthly_revenue": _REVENUE,
    "kpi_totals": f"""{_FROM_CLEANED} SELECT count(*) AS trip_count,
        round(sum(total_amount), 2) AS revenue, {_MEANS} FROM cleaned""",
    "trips_by_hour": f"""{_FROM_CLEANED} SELECT CAST(hour(Trip_Pickup_DateTime) AS INTEGER)
        AS pickup_hour, count(*) AS trip_count FROM cleaned GROUP BY 1""",
    "trips_by_month": f"""{_FROM_CLEANED} SELECT Year, CAST(month(Trip_Pickup_DateTime) AS INTEGER)
        AS month_number, Month, count(*) AS trip_count, {_MEANS} FROM cleaned GROUP BY 1, 2, 3""",
    "pickup_borough_share": _share("Pickup_Borough"),
    "dropoff_borough_share": _share("Dropoff_Borough"),
    "top_pickup_zones": _top("Pickup_Zone"),
    "top_dropoff_zones": _top("Dropoff_Zone"),
    "borough_service_zone": f"""{_FROM_CLEANED} SELECT Pickup_Borough, Pickup_Service_Zone,
        count(*) AS trip_count FROM cleaned GROUP BY 1, 2""",
    "vendor_summary": _share("Vendor_Name", ", round(sum(total_amount), 2) AS revenue"),
    "payment_summary": _share("Payment_Method"),
    "ratecode_revenue": f"""{_FROM_CLEANED} SELECT Ratecode_Description, count(*) AS trip_count,
        round(sum(total_amount), 2) AS revenue FROM cleaned GROUP BY 1""",
    "surcharge_by_year": f"""{_FROM_CLEANED} SELECT Year,
        round(sum(extra_charges), 2) AS extra_charges, round(sum(mta_tax), 2) AS mta_tax,
        round(sum(improvement_surcharge), 2) AS improvement_surcharge,
        round(sum(congestion_surcharge), 2) AS congestion_surcharge,
        round(sum(Airport_fee), 2) AS Airport_fee,
        round(sum(cbd_congestion_fee), 2) AS cbd_congestion_fee FROM cleaned GROUP BY Year""",
}
