import datetime as dt

import pytest
from pyspark.sql import functions as f

from tripmetrics.functions import duration_minutes
from tripmetrics.operators import (
    apply_rules,
    cleaning_report,
    derive,
    fill_defaults,
    impute_mean,
    rename,
    spot_check,
    trip_rules,
    violations,
    with_duration,
)
from tripmetrics.plans.jobs import prepare, tidy
from tripmetrics.schemas import CLEAN

START = dt.datetime(2024, 3, 5, 18, 0, 0)
NAN = float("nan")


def after(seconds):
    end = START + dt.timedelta(seconds=seconds)
    return {"tpep_pickup_datetime": START, "tpep_dropoff_datetime": end}


KEPT = [
    {"passenger_count": 1},
    {"passenger_count": 6},
    {"trip_distance": 0.1},
    {"trip_distance": 200.0},
    after(1),
    after(7206),
    {"fare_amount": None},
    {"fare_amount": NAN},
    {"extra": None},
    {"mta_tax": None},
    {"tip_amount": None},
    {"cbd_congestion_fee": None},
    {"VendorID": None},
    {"RatecodeID": None},
    {"payment_type": None},
    {"tolls_amount": None},
    {"tolls_amount": -1.0},
    {"congestion_surcharge": None},
    {"congestion_surcharge": -2.5},
    {"fare_amount": 0.0},
    {"PULocationID": 999},
    {"total_amount": NAN},
]

DROPPED = [
    {"passenger_count": 0},
    {"passenger_count": 7},
    {"passenger_count": None},
    {"trip_distance": 0.09},
    {"trip_distance": 200.01},
    {"trip_distance": NAN},
    {"trip_distance": None},
    after(0),
    after(-60),
    after(7207),
    {"tpep_dropoff_datetime": None},
    {"PULocationID": 2, "DOLocationID": 2},
    {"PULocationID": None},
    {"DOLocationID": None},
    {"Airport_fee": None},
    {"total_amount": None},
    {"improvement_surcharge": None},
    *[
        {name: -0.01}
        for name in (
            "cbd_congestion_fee",
            "Airport_fee",
            "total_amount",
            "tip_amount",
            "fare_amount",
            "extra",
            "improvement_surcharge",
            "mta_tax",
        )
    ],
]


def test_edge_rows(make_trips):
    trips = make_trips(*[{**change, "payment_type": i} for i, change in enumerate(KEPT + DROPPED)])
    kept = {row.payment_type for row in tidy(trips).collect()}
    assert kept == set(range(len(KEPT)))


def test_kept_and_dropped_make_up_all(make_trips):
    prepared = prepare(make_trips(*KEPT, *DROPPED))
    rules = trip_rules()
    assert apply_rules(prepared, rules).count() == len(KEPT)
    assert violations(prepared, rules).count() == len(DROPPED)
    report = cleaning_report(prepared, rules).first()
    total = len(KEPT) + len(DROPPED)
    assert tuple(report) == (total, len(KEPT), len(DROPPED), round(100 * len(DROPPED) / total, 2))


def test_report_of_nothing(make_trips):
    nothing = prepare(make_trips({})).filter("false")
    assert tuple(cleaning_report(nothing, trip_rules()).first()) == (0, 0, 0, None)


def test_spot_check_finds_only_bad_rows(make_trips):
    prepared = prepare(make_trips(*KEPT, *DROPPED))
    assert spot_check(prepared).count() == 4  # 0 passengers, 200.01, NaN and 120.12 min
    assert spot_check(apply_rules(prepared, trip_rules())).count() == 0


@pytest.mark.parametrize(
    ("start", "end", "minutes"),
    [
        (dt.datetime(2024, 3, 10, 1, 30), dt.datetime(2024, 3, 10, 3, 30), 120.0),
        (dt.datetime(2024, 1, 1, 0, 0, 0, 900000), dt.datetime(2024, 1, 1, 0, 1, 0, 100000), 1.0),
        (dt.datetime(2024, 1, 1), dt.datetime(2023, 12, 31, 23, 59), -1.0),
        (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 2, 0, 6), 120.1),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_duration_is_wall_clock_in_whole_seconds(spark, make_trips, start, end, minutes, zone):
    trips = make_trips({"tpep_pickup_datetime": start, "tpep_dropoff_datetime": end})
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert with_duration(rename(trips)).first().trip_duration_min == minutes
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_duration_is_the_rounded_quotient(spark):
    seconds = spark.range(-100000, 100000).selectExpr(
        "id",
        "TIMESTAMP_NTZ'2024-01-01' AS a",
        "timestampadd(SECOND, id, TIMESTAMP_NTZ'2024-01-01') AS b",
    )
    rounded = f.round(f.col("id") / 60, 2).alias("y")
    both = seconds.select(duration_minutes("a", "b").alias("x"), rounded)
    assert both.filter("x = y").count() == 200000


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "America/Sao_Paulo"])
def test_date_parts_do_not_depend_on_the_zone(spark, make_trips, zone):
    moments = [
        dt.datetime(2024, 3, 10, 2, 30),
        dt.datetime(2018, 11, 4, 0, 0),
        dt.datetime(2023, 12, 31, 23, 59, 59),
    ]
    trips = make_trips(*[{"tpep_pickup_datetime": moment} for moment in moments])
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = derive(rename(trips)).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [(row.Year, row.Month) for row in rows] == [(2024, "Mar"), (2018, "Nov"), (2023, "Dec")]


def test_mean_covers_all_rows_and_skips_nan(make_trips):
    trips = make_trips(
        {"tip_amount": 1.0},
        {"tip_amount": -4.0, "passenger_count": 0},
        {"tip_amount": NAN},
        {"tip_amount": None},
    )
    tips = [row.tip_amount for row in impute_mean(rename(trips), "tip_amount").collect()]
    assert tips == [1.0, -4.0, -1.5, -1.5]


def test_no_tip_at_all_leaves_nulls_and_keeps_nothing(make_trips):
    trips = make_trips({"tip_amount": None}, {"tip_amount": None})
    assert impute_mean(rename(trips), "tip_amount").filter("tip_amount is null").count() == 2
    assert tidy(trips).count() == 0


def test_defaults(make_trips):
    codes = ("VendorID", "RatecodeID", "store_and_fwd_flag")
    amounts = ("fare_amount", "extra", "mta_tax", "cbd_congestion_fee", "tolls_amount")
    nothing = dict.fromkeys(codes + amounts)
    row = fill_defaults(rename(make_trips(nothing))).first()
    assert (row.Vendor_ID, row.Ratecode_ID, row.store_and_fwd_flag) == (99, 99, "Unknown")
    assert (row.fare_amount, row.extra_charges, row.mta_tax, row.cbd_congestion_fee) == (0, 0, 0, 0)
    assert row.tolls_amount is None


@pytest.mark.parametrize(
    ("column", "label", "known"),
    [
        ("VendorID", "Vendor_Name", {1: "Creative Mobile Technologies, LLC", 7: "Helix"}),
        ("RatecodeID", "Ratecode_Description", {1: "Standard rate", 6: "Group ride"}),
        ("payment_type", "Payment_Method", {0: "Flex Fare trip", 5: "Unknown", 6: "Voided trip"}),
    ],
)
def test_labels(make_trips, column, label, known):
    codes = [*known, 99, -1, None]
    rows = derive(rename(make_trips(*[{column: code} for code in codes]))).collect()
    assert [row[label] for row in rows] == [*known.values(), "Unknown", "Unknown", "Unknown"]


def test_distance_is_converted_then_renamed(make_trips):
    row = derive(rename(make_trips({"trip_distance": 5.0}, {"trip_distance": 10.0}))).first()
    assert (row.trip_distance_miles, row.Trip_Distance_Km) == (5.0, 8.05)
    assert "trip_distance" not in row


def test_tidy_has_all_cleaned_columns_but_the_zones(make_trips):
    names = set(tidy(make_trips({})).columns)
    zone_columns = {name for name in CLEAN.names if "Borough" in name or "Zone" in name}
    assert set(CLEAN.names) - names == zone_columns and len(zone_columns) == 6
