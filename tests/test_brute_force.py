"""The whole cleaning against plain Python on random edge-heavy rows."""

import datetime as dt
import math
import random

import pytest

from tests.conftest import ZONE_ROWS
from tripmetrics.operators import conform
from tripmetrics.plans.jobs import clean
from tripmetrics.schemas import BIGINT, INT, STANDARD, columns

NAN = float("nan")
AMOUNTS = [None, NAN, -0.01, 0.0, 0.5, 2.5]
FILLED = ("fare_amount", "extra", "mta_tax", "cbd_congestion_fee")
UNFILLED = ("Airport_fee", "total_amount", "improvement_surcharge")
START = dt.datetime(2023, 12, 31, 23, 30)
ZONES = {key: rest for key, *rest in ZONE_ROWS}


def random_trip(rng, number):
    likely = rng.random() < 0.5  # half of the rows are mostly good
    amount = lambda: rng.choice([0.0, 1.25] if likely else AMOUNTS)
    return {
        "VendorID": rng.choice([None, 1, 2, 5, 6, 7]),
        "tpep_pickup_datetime": START + dt.timedelta(seconds=rng.randrange(10**6)),
        "tpep_dropoff_datetime": None,
        "passenger_count": rng.choice([1, 6] if likely else [None, 0, 1, 6, 7]),
        "trip_distance": rng.choice([0.1, 2.0, 200.0] if likely else [None, NAN, 0.09, 200.01]),
        "RatecodeID": rng.choice([None, 1, 2, 3, 4, 5, 6, 99]),
        "store_and_fwd_flag": None,
        "PULocationID": rng.choice([None, 1, 2, 3, 264, 999]),
        "DOLocationID": rng.choice([2, 3, 265]),
        "payment_type": rng.choice([None, 0, 1, 2, 5, 6, 9]),
        "fare_amount": amount(),
        "extra": amount(),
        "mta_tax": amount(),
        "tip_amount": rng.choice([None, NAN, -1.0, 0.0, 3.0]),
        "tolls_amount": rng.choice(AMOUNTS),
        "improvement_surcharge": amount(),
        "total_amount": amount(),
        "congestion_surcharge": float(number),  # passes through untouched, so it names the row
        "Airport_fee": amount(),
        "cbd_congestion_fee": amount(),
        "seconds": rng.choice([1, 60, 7206] if likely else [-5, 0, 7207]),
    }


def missing(value):
    return value is None or (isinstance(value, float) and math.isnan(value))


def at_least(value, low):
    """Spark's order: NaN is above everything."""
    return value is not None and (math.isnan(value) or value >= low)


def between(value, low, high):
    return value is not None and not math.isnan(value) and low <= value <= high


def expected(trips):
    tips = [t["tip_amount"] for t in trips if not missing(t["tip_amount"])]
    mean = sum(tips) / len(tips)
    kept = {}
    for t in trips:
        fill = {name: 0.0 if missing(t[name]) else t[name] for name in FILLED}
        tip = mean if missing(t["tip_amount"]) else t["tip_amount"]
        minutes = round(t["seconds"] / 60 + 1e-12, 2)
        amounts = [*fill.values(), tip, *[t[name] for name in UNFILLED]]
        pickup, dropoff = t["PULocationID"], t["DOLocationID"]
        if (
            between(t["passenger_count"], 1, 6)
            and between(t["trip_distance"], 0.1, 200)
            and None not in (pickup, dropoff)
            and pickup != dropoff
            and between(minutes, 0.01, 120.1)
            and all(at_least(amount, 0) for amount in amounts)
        ):
            vendor = {1: "Creative Mobile Technologies, LLC", 2: "Curb Mobility, LLC"}
            vendor |= {6: "Myle Technologies Inc", 7: "Helix"}
            kept[int(t["congestion_surcharge"])] = (
                99 if t["VendorID"] is None else t["VendorID"],
                vendor.get(t["VendorID"], "Unknown"),
                99 if t["RatecodeID"] is None else t["RatecodeID"],
                fill["fare_amount"],
                fill["extra"],
                tip,
                minutes,
                t["tpep_pickup_datetime"].year,
                t["tpep_pickup_datetime"].strftime("%b"),
                *ZONES.get(pickup, (None, None, None)),
                *ZONES.get(dropoff, (None, None, None)),
            )
    return kept


def test_clean_equals_plain_python(spark, zones):
    rng = random.Random(11)
    trips = [random_trip(rng, number) for number in range(4000)]
    for t in trips:
        t["tpep_dropoff_datetime"] = t["tpep_pickup_datetime"] + dt.timedelta(seconds=t["seconds"])
    frame = spark.createDataFrame([tuple(t[n] for n in STANDARD.names) for t in trips], STANDARD)
    found = {
        int(r.congestion_surcharge): (
            r.Vendor_ID,
            r.Vendor_Name,
            r.Ratecode_ID,
            r.fare_amount,
            r.extra_charges,
            pytest.approx(r.tip_amount),
            r.trip_duration_min,
            r.Year,
            r.Month,
            r.Pickup_Borough,
            r.Pickup_Zone,
            r.Pickup_Service_Zone,
            r.Dropoff_Borough,
            r.Dropoff_Zone,
            r.Dropoff_Service_Zone,
        )
        for r in clean(frame, zones).collect()
    }
    wanted = expected(trips)
    assert 200 < len(wanted) < 3500
    assert found == wanted


def test_casts_equal_plain_python(spark):
    rng = random.Random(12)
    edges = [2.0**31, 2.0**63, 1e300, 0.0]
    numbers = [rng.choice([-1, 1]) * rng.choice(edges) * rng.random() for _ in range(2000)]
    numbers += [side * edge for edge in edges for side in (-1, 1)] + [NAN, math.inf, -math.inf]
    raw = spark.createDataFrame([(n, n) for n in numbers], "a double, b double")
    found = conform(raw, columns(a=INT, b=BIGINT)).collect()

    def fit(value, bits):
        if not math.isfinite(value):
            return None
        whole = math.trunc(value)
        return whole if -(2 ** (bits - 1)) <= whole < 2 ** (bits - 1) else None

    assert [tuple(row) for row in found] == [(fit(n, 32), fit(n, 64)) for n in numbers]
