import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as f

from tripmetrics.operators import conform, conform_profile, union_all
from tripmetrics.schemas import BIGINT, DOUBLE, INT, STANDARD, STRING, columns

TARGET = columns(VendorID=INT, passenger_count=BIGINT, Airport_fee=DOUBLE, cbd_congestion_fee=DOUBLE)


def test_names_match_ignoring_case_and_values_are_kept(spark):
    raw = spark.createDataFrame([(7, 1.25)], "vendorid bigint, airport_fee double")
    row = conform(raw, TARGET).first()
    assert row.asDict() == {
        "VendorID": 7,
        "passenger_count": None,
        "Airport_fee": 1.25,
        "cbd_congestion_fee": None,
    }


def test_result_has_exactly_the_target_schema(spark):
    raw = spark.createDataFrame([("x", 1)], "unknown string, VendorID bigint")
    assert conform(raw, TARGET).schema == TARGET


def test_values_that_do_not_fit_become_null(spark):
    raw = spark.createDataFrame(
        [
            (3000000000, 1.9),
            (2147483647, -1.9),
            (-2147483648, float("nan")),
            (-2147483649, 1e30),
            (None, None),
        ],
        "VendorID bigint, passenger_count double",
    )
    rows = conform(raw, TARGET).select("VendorID", "passenger_count").collect()
    assert [tuple(row) for row in rows] == [
        (None, 1),
        (2147483647, -1),
        (-2147483648, None),
        (None, None),
        (None, None),
    ]


@pytest.mark.parametrize(
    ("source", "values", "expected"),
    [
        (
            "double",
            [2147483647.9, 2147483648.0, -2147483648.9, -2147483649.0],
            [2147483647, None, -2147483648, None],
        ),
        ("string", ["12", "x", None], [12, None, None]),
        ("decimal(20,2)", [Decimal("5.90"), Decimal("99999999999.00")], [5, None]),
    ],
)
def test_casts_to_int(spark, source, values, expected):
    raw = spark.createDataFrame([(value,) for value in values], f"VendorID {source}")
    assert [row.VendorID for row in conform(raw, TARGET).collect()] == expected


def test_largest_bigint_bounds(spark):
    raw = spark.createDataFrame([(2.0**63,), (-(2.0**63),), (2.0**62,)], "passenger_count double")
    got = [row.passenger_count for row in conform(raw, TARGET).collect()]
    assert got == [None, -(2**63), 2**62]


def test_columns_that_differ_only_by_case_are_refused(spark):
    raw = spark.range(1).select(f.lit(1).alias("Airport_fee"), f.lit(2).alias("airport_fee"))
    with pytest.raises(ValueError, match="differ only by case"):
        conform(raw, TARGET)


def test_conform_is_idempotent(make_trips):
    once = conform(make_trips({}, {"VendorID": None}), STANDARD)
    twice = conform(once, STANDARD)
    assert twice.schema == once.schema and twice.collect() == once.collect()


def test_union_keeps_duplicates(make_trips):
    trips = make_trips({}, {"VendorID": 1})
    union = union_all([trips, trips, trips])
    assert union.count() == 6 and union.distinct().count() == 2


def test_union_refuses_other_types_and_names(spark):
    ints = spark.createDataFrame([(1,)], "a int")
    for other in ("a bigint", "b int"):
        with pytest.raises(ValueError, match="schema of frame 1 differs"):
            union_all([ints, spark.createDataFrame([(1,)], other)])


def test_profile_counts_rows_nulls_and_lost_values(spark):
    schema = columns(VendorID=INT, note=STRING)
    old = spark.createDataFrame([(1,), (3000000000,), (None,)], "vendorID bigint")
    new = spark.createDataFrame([(1, "x")], "VendorID int, note string")
    rows = conform_profile({"old": old, "new": new}, schema).collect()
    assert sorted(tuple(row) for row in rows) == [
        ("new", "VendorID", "int", "int", 1, 0, 0),
        ("new", "note", "string", "string", 1, 0, 0),
        ("old", "VendorID", "bigint", "int", 3, 1, 1),
        ("old", "note", "absent", "string", 3, 3, 0),
    ]


def test_timestamps_without_zone_pass_unchanged(make_trips):
    at = dt.datetime(2024, 3, 10, 2, 30)
    row = conform(make_trips({"tpep_pickup_datetime": at}), STANDARD).first()
    assert row.tpep_pickup_datetime == at


def test_decimals_fit_or_become_null(spark):
    from pyspark.sql.types import DecimalType, LongType, StructField, StructType

    source = spark.sql(
        "SELECT 100000 AS small, CAST(9223372036854775807 AS DECIMAL(20,0)) AS large UNION ALL "
        "SELECT 12, CAST(9223372036854775808 AS DECIMAL(20,0))"
    )
    target = StructType(
        [StructField("small", DecimalType(5, 2)), StructField("large", LongType())]
    )
    rows = conform(source, target).collect()
    assert [None if r.small is None else float(r.small) for r in rows] == [None, 12.0]
    assert [r.large for r in rows] == [9223372036854775807, None]


SOURCES = ["decimal(5,2)", "decimal(10,0)", "decimal(20,3)", "decimal(38,0)", "decimal(38,38)", "decimal(38,10)", "int", "bigint", "double", "float", "string"]
TARGETS = ["decimal(3,0)", "decimal(5,2)", "decimal(18,4)", "decimal(38,0)", "decimal(38,2)", "smallint", "int", "bigint", "double"]


def edges(kind):
    """Values around every bound of the targets, as far as the source type holds them."""
    whole = [0, 1, 999, 1000, 2**15, 2**31, 2**63, 10**10, 10**14, 10**18, 10**36, 10**38 - 1]
    parts = ["0", "0.5", "0.4", "0.005", "0.0049", "0.99", "0.995", "0.99995", "0.99994999"]
    numbers = {Decimal(w) + Decimal(d) * s for w in whole for d in (-1, 0, 1) for s in map(Decimal, parts)}
    return [str(n * sign) for n in numbers for sign in (1, -1)] + ([] if "decimal" in kind else ["nan", "1e300", "-1e300"])


@pytest.mark.parametrize("kind", SOURCES)
def test_bounds_give_what_a_tried_cast_gives(spark, kind):
    from pyspark.sql import functions as f

    from tripmetrics.functions import fitting_cast

    text = spark.createDataFrame([(e,) for e in edges(kind)], "e string")
    values = text.select(f.col("e").try_cast(kind).alias("v")).filter("v is not null").distinct()
    source = values.schema["v"].dataType
    for target in TARGETS:
        wanted = spark.createDataFrame([], f"x {target}").schema["x"].dataType
        if source == wanted:
            continue
        found, tried = fitting_cast(f.col("v"), source, wanted), f.col("v").try_cast(wanted)
        differing = values.filter(~found.eqNullSafe(tried)).select("v", found.alias("found"), tried.alias("tried")).collect()
        # a tried cast takes the double 2 ** 63 for 2 ** 63 - 1
        differing = [row for row in differing if kind not in ("double", "float") or row.v != 2.0**63]
        assert not differing, (kind, target, differing[:3])
