"""Schemas and default parameters shared by the operators."""

from __future__ import annotations

from typing import NamedTuple

# The fields and types of one trip message.
TRIP_SCHEMA = """
    VendorID BIGINT,
    tpep_pickup_datetime STRING,
    tpep_dropoff_datetime STRING,
    passenger_count DOUBLE,
    trip_distance DOUBLE,
    RatecodeID DOUBLE,
    store_and_fwd_flag STRING,
    PULocationID BIGINT,
    DOLocationID BIGINT,
    payment_type BIGINT,
    fare_amount DOUBLE,
    extra DOUBLE,
    mta_tax DOUBLE,
    tip_amount DOUBLE,
    tolls_amount DOUBLE,
    improvement_surcharge DOUBLE,
    total_amount DOUBLE,
    congestion_surcharge DOUBLE,
    airport_fee INT
"""

# The columns of the two zone files.
ZONE_SCHEMA = "LocationID INT, Zone STRING, Borough STRING"
CENTROID_SCHEMA = "LocationID INT, latitude DOUBLE, longitude DOUBLE"

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
LOCATION = "PULocationID"


class Bounds(NamedTuple):
    """Inclusive latitude and longitude limits."""

    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


# City bounds, cleaning limits and clustering defaults.
CITY_BOUNDS = Bounds(40.4, 40.9, -74.3, -73.7)
MAX_TRIP_HOURS = 24
MAX_FARE = 500
HIGH_VALUE_QUANTILE = 0.75
ELBOW_KS = (5, 10, 15, 20, 25, 30, 40, 50)
CLUSTERS = 20
SEED = 42
MAX_ITER = 20
TOLERANCE = 1e-4
ELBOW_FRACTION = 0.1
TEST_FRACTION = 0.2
WEEKDAYS = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")
