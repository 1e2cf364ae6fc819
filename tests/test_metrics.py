import datetime as dt

import pytest

from tests.conftest import plan_of
from tripmetrics.plans import metrics
from tripmetrics.plans.jobs import clean


def trip(pickup, dropoff, month=3, hour=18, **changes):
    start = dt.datetime(2024, month, 5, hour)
    return {
        "PULocationID": pickup,
        "DOLocationID": dropoff,
        "tpep_pickup_datetime": start,
        "tpep_dropoff_datetime": start + dt.timedelta(minutes=15),
        **changes,
    }


@pytest.fixture
def cleaned(make_trips, zones):
    return clean(
        make_trips(
            trip(1, 2, month=4),
            trip(1, 3, hour=7, payment_type=2),
            trip(2, 3, month=8, VendorID=1, total_amount=100.0),
            trip(999, 3, trip_distance=4.0),
            trip(2, 2),  # dropped
        ),
        zones,
    )


def rows(df):
    return [tuple(row) for row in df.collect()]


def test_row_count_and_mean(cleaned):
    assert rows(metrics.row_count(cleaned)) == [(4,)]
    assert rows(metrics.global_mean(cleaned, "trip_distance_miles")) == [(2.5,)]


def test_borough_summary_puts_ties_in_name_order_and_null_last(cleaned):
    assert rows(metrics.borough_summary(cleaned)) == [("EWR", 2, 2.0), ("Queens", 1, 2.0), (None, 1, 4.0)]


def test_months_sort_as_text_in_revenue_and_by_calendar_in_the_trend(cleaned):
    assert [r[1] for r in rows(metrics.monthly_revenue(cleaned))] == ["Apr", "Aug", "Mar"]
    assert [r[2] for r in rows(metrics.trips_by_month(cleaned))] == ["Mar", "Apr", "Aug"]


def test_kpis(cleaned):
    trips, revenue, km, minutes, tip = rows(metrics.kpi_totals(cleaned))[0]
    assert (trips, minutes, tip) == (4, 15.0, 2.0)
    assert revenue == pytest.approx(3 * 13.8 + 100) and km == pytest.approx((3 * 3.22 + 6.44) / 4)


def test_hours(cleaned):
    assert rows(metrics.trips_by_hour(cleaned)) == [(7, 1), (18, 3)]


def test_shares_add_up(cleaned):
    shares = rows(metrics.pickup_borough_share(cleaned))
    assert shares == [("EWR", 2, 50.0), ("Queens", 1, 25.0), (None, 1, 25.0)]
    assert rows(metrics.dropoff_borough_share(cleaned)) == [("Manhattan", 3, 75.0), ("Queens", 1, 25.0)]
    assert rows(metrics.payment_summary(cleaned)) == [("Credit Card", 3, 75.0), ("Cash", 1, 25.0)]


def test_vendor_summary(cleaned):
    (name, trips, revenue, share), other = rows(metrics.vendor_summary(cleaned))
    assert (name, trips, share) == ("Curb Mobility, LLC", 3, 75.0) and revenue == pytest.approx(41.4)
    assert other == ("Creative Mobile Technologies, LLC", 1, 100.0, 25.0)


def test_top_k(cleaned):
    assert rows(metrics.top_pickup_zones(cleaned, 2)) == [("Airport One", 2), ("Bay", 1)]
    assert rows(metrics.top_dropoff_zones(cleaned, 1)) == [("Center", 3)]


def test_service_zones(cleaned):
    assert rows(metrics.borough_service_zone(cleaned))[0] == ("EWR", "EWR", 2)


def test_ratecodes_and_surcharges(cleaned):
    assert rows(metrics.ratecode_revenue(cleaned))[0][:2] == ("Standard rate", 4)
    assert rows(metrics.surcharge_by_year(cleaned)) == [(2024, 4.0, 2.0, pytest.approx(1.2), 10.0, 0.0, 0.0)]


def test_preview(cleaned):
    shown = metrics.preview(cleaned, 2).collect()
    assert len(shown) == 2 and shown == cleaned.orderBy(*cleaned.columns).limit(2).collect()


def test_mean_skips_nan_and_null(spark):
    from tripmetrics.plans.metrics import global_mean

    tips = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,)], "tip double")
    assert global_mean(tips, "tip").first()[0] == 2.0


def test_rule_rejects(spark):
    from pyspark.sql import functions as f

    from tripmetrics.operators import rule_rejects

    rows = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (None, 1)], "a int, b int")
    found = rule_rejects(rows, {"a": f.col("a") > 0, "b": f.col("b") > 0}).collect()
    assert [tuple(row) for row in found] == [("a", 3, 2), ("b", 1, 0)]


def test_share_of_a_million_keys_stays_in_several_tasks(spark):
    from tripmetrics.plans.metrics import share

    rows = spark.range(0, 1_000_000, 1, 4).selectExpr("id AS k")
    result = share(rows, "k")
    plan = plan_of(result)
    assert "SinglePartition" not in plan.split("Subqueries")[0].split("Subquery")[0] and "Window" not in plan
    assert result.selectExpr("count(*) AS n", "round(sum(share_pct), 6) AS whole").first() == (1_000_000, 100.0)


def test_exact_mean_does_not_depend_on_the_order(spark):
    import math
    import random

    from tripmetrics.functions import exact_mean

    dice = random.Random(5)
    values = [dice.choice([-1, 1]) * dice.random() * 10 ** dice.randint(-6, 11) for _ in range(3000)]
    values += [0.1, 0.2, 0.3, -2.5, 1e11, -1e11, 0.0, None, float("nan")]
    real = [v for v in values if v is not None and v == v]
    found = set()
    for parts in (1, 3, 7):
        dice.shuffle(values)
        frame = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
        found.add(frame.agg(exact_mean("x")).first()[0])
    assert len(found) == 1
    assert found.pop() == pytest.approx(math.fsum(real) / len(real), rel=1e-15)
    large = spark.createDataFrame([(1e200,), (3.0,), (-1e200,)], "x double")
    assert abs(large.agg(exact_mean("x")).first()[0] - 1) < 1e185
    assert large.limit(0).agg(exact_mean("x")).first()[0] is None
