"""Schemas and fixed values of the trip data model.

Everything here must equal the published data contract for results to be right; no other
module repeats these values.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

INT, BIGINT, DOUBLE = IntegerType(), LongType(), DoubleType()
STRING, TIMESTAMP_NTZ = StringType(), TimestampNTZType()


def columns(**types: DataType) -> StructType:
    """Schema of nullable columns in the order given."""
    return StructType([StructField(name, kind, True) for name, kind in types.items()])


# The 20-column schema every raw file is conformed to.
STANDARD = columns(
    VendorID=INT,
    tpep_pickup_datetime=TIMESTAMP_NTZ,
    tpep_dropoff_datetime=TIMESTAMP_NTZ,
    passenger_count=BIGINT,
    trip_distance=DOUBLE,
    RatecodeID=BIGINT,
    store_and_fwd_flag=STRING,
    PULocationID=INT,
    DOLocationID=INT,
    payment_type=BIGINT,
    fare_amount=DOUBLE,
    extra=DOUBLE,
    mta_tax=DOUBLE,
    tip_amount=DOUBLE,
    tolls_amount=DOUBLE,
    improvement_surcharge=DOUBLE,
    total_amount=DOUBLE,
    congestion_surcharge=DOUBLE,
    Airport_fee=DOUBLE,
    cbd_congestion_fee=DOUBLE,
)

# The 32-column cleaned table, in its published order.
CLEAN = columns(
    Vendor_ID=INT,
    Vendor_Name=STRING,
    Trip_Pickup_DateTime=TIMESTAMP_NTZ,
    Trip_Dropoff_DateTime=TIMESTAMP_NTZ,
    passenger_count=BIGINT,
    Pickup_Location_ID=INT,
    Pickup_Borough=STRING,
    Pickup_Zone=STRING,
    Pickup_Service_Zone=STRING,
    Dropoff_Location_ID=INT,
    Dropoff_Borough=STRING,
    Dropoff_Zone=STRING,
    Dropoff_Service_Zone=STRING,
    Trip_Distance_Km=DOUBLE,
    trip_distance_miles=DOUBLE,
    Ratecode_ID=BIGINT,
    Ratecode_Description=STRING,
    payment_type=BIGINT,
    Payment_Method=STRING,
    trip_duration_min=DOUBLE,
    fare_amount=DOUBLE,
    extra_charges=DOUBLE,
    mta_tax=DOUBLE,
    tip_amount=DOUBLE,
    tolls_amount=DOUBLE,
    improvement_surcharge=DOUBLE,
    total_amount=DOUBLE,
    congestion_surcharge=DOUBLE,
    Airport_fee=DOUBLE,
    cbd_congestion_fee=DOUBLE,
    Year=INT,
    Month=STRING,
)

# The zone dimension.
ZONES = columns(
    LocationID=INT,
    Borough=STRING,
    Zone=STRING,
    service_zone=STRING,
)

# Standard name -> analyst name.
ANALYST_NAMES = {
    "VendorID": "Vendor_ID",
    "RatecodeID": "Ratecode_ID",
    "PULocationID": "Pickup_Location_ID",
    "DOLocationID": "Dropoff_Location_ID",
    "extra": "extra_charges",
    "tpep_pickup_datetime": "Trip_Pickup_DateTime",
    "tpep_dropoff_datetime": "Trip_Dropoff_DateTime",
}

# What a missing value becomes, by analyst name.
DEFAULTS = {
    "Vendor_ID": 99,
    "Ratecode_ID": 99,
    "store_and_fwd_flag": "Unknown",
    "fare_amount": 0.0,
    "extra_charges": 0.0,
    "mta_tax": 0.0,
    "cbd_congestion_fee": 0.0,
}

# Inclusive ranges a kept trip lies in.
RANGES = {
    "passenger_count": (1, 6),
    "trip_distance": (0.1, 200),
    "trip_duration_min": (0.01, 120.1),
}

# Amounts that must not be negative. Tolls and the congestion surcharge are
# left untested on purpose.
NON_NEGATIVE = (
    "cbd_congestion_fee",
    "Airport_fee",
    "total_amount",
    "tip_amount",
    "fare_amount",
    "extra_charges",
    "improvement_surcharge",
    "mta_tax",
)

# Code labels; any other code, and null, is UNKNOWN.
UNKNOWN = "Unknown"

VENDORS = {
    1: "Creative Mobile Technologies, LLC",
    2: "Curb Mobility, LLC",
    6: "Myle Technologies Inc",
    7: "Helix",
}

RATE_CODES = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}

PAYMENT_TYPES = {
    0: "Flex Fare trip",
    1: "Credit Card",
    2: "Cash",
    3: "No Charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}

# Fixed value: kilometres per mile as published (three decimals).
KM_PER_MILE = 1.609
