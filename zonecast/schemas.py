"""Column names and table schemas."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

ZONE = "zone_id"
BIN = "bin"

# Service names, their target columns and derived column names.
SERVICES = ("yellow", "green", "hvfhv")
TARGETS = tuple(f"target_{service}" for service in SERVICES)
CITY_DEMAND = tuple(f"{target}_city_hour_pickups" for target in TARGETS)
NEIGHBOR_DEMAND = tuple(f"neighbor_pickups_{target}" for target in TARGETS)
LAG_SOURCES = TARGETS + CITY_DEMAND + NEIGHBOR_DEMAND
LAGS = (1, 24)


@dataclass(frozen=True)
class FeedLayout:
    """Column layout of one trip feed: its schema and the names it uses for the shared columns."""

    schema: T.StructType
    renames: dict[str, str] = field(default_factory=dict)
    duration_seconds: str | None = None


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in pairs])


def _metered(prefix: str) -> FeedLayout:
    pickup, dropoff = f"{prefix}_pickup_datetime", f"{prefix}_dropoff_datetime"
    return FeedLayout(
        _fields(
            (pickup, T.TimestampNTZType()),
            (dropoff, T.TimestampNTZType()),
            ("pulocationid", T.IntegerType()),
            ("dolocationid", T.IntegerType()),
            ("trip_distance", T.DoubleType()),
        ),
        {pickup: "pickup_datetime", dropoff: "dropoff_datetime", "trip_distance": "trip_miles"},
    )


FEEDS = {
    "yellow": _metered("tpep"),
    "green": _metered("lpep"),
    "hvfhv": FeedLayout(
        _fields(
            ("pickup_datetime", T.TimestampNTZType()),
            ("dropoff_datetime", T.TimestampNTZType()),
            ("pulocationid", T.IntegerType()),
            ("dolocationid", T.IntegerType()),
            ("trip_miles", T.DoubleType()),
            ("trip_time", T.LongType()),
        ),
        duration_seconds="trip_time",
    ),
}

# Numeric weather readings of one hour, in column order.
WEATHER_FIELDS = (
    "temp", "dew", "humidity", "precip", "snow", "windspeed", "feelslike", "snowdepth", "visibility",
)
CURRENT_FIELDS = ("humidity", "precip", "windspeed", "feelslike", "visibility")

HOURLY_WEATHER = _fields(
    ("datetime", T.StringType()),
    *[(name, T.DoubleType()) for name in WEATHER_FIELDS],
    ("day", T.StringType()),
)
_HOUR = T.StructType(HOURLY_WEATHER.fields[:-1])
WEATHER_DOCUMENT = _fields(
    ("days", T.ArrayType(_fields(("datetime", T.StringType()), ("hours", T.ArrayType(_HOUR))))),
)
CURRENT_WEATHER = _fields(
    ("datetime", T.StringType()), *[(name, T.DoubleType()) for name in CURRENT_FIELDS]
)
CURRENT_DOCUMENT = _fields(("currentConditions", CURRENT_WEATHER))

ZONE_LOOKUP = _fields(
    ("locationid", T.IntegerType()), ("zone", T.StringType()), ("borough", T.StringType())
)

PANEL = _fields(
    (BIN, T.TimestampNTZType()),
    (ZONE, T.IntegerType()),
    *[(target, T.LongType()) for target in TARGETS],
    ("city_avg_speed", T.DoubleType()),
    ("city_congestion_index", T.DoubleType()),
    ("zone_avg_speed", T.DoubleType()),
    ("zone_congestion_index", T.DoubleType()),
)

# Day partition of the prediction log.
DAY = "bin_date"
# Types of the prediction log.
PREDICTION_TYPES = {
    BIN: "timestamp_ntz",
    "is_rush_hour": "tinyint",
    "is_night_hour": "tinyint",
    "day_of_week": "smallint",
    "pickup_month": "smallint",
    "pickup_hour": "smallint",
    ZONE: "int",
    "zone_congestion_index": "float",
    "city_congestion_index": "float",
    **{name: "double" for name in CURRENT_FIELDS},
    **{target: "double" for target in TARGETS},
}

# Model inputs, and those treated as categories.
FEATURES = (
    "pickup_month", "city_congestion_index", "zone_congestion_index",
    *CURRENT_FIELDS,
    "pickup_hour", "day_of_week", "is_rush_hour", "is_night_hour",
    *[f"{target}_lag_{lag}h" for target in TARGETS for lag in LAGS],
    *[f"{name}_lag_1h" for name in CITY_DEMAND],
    *[f"{name}_lag_1h" for name in NEIGHBOR_DEMAND],
    ZONE,
)
CATEGORICAL = (
    "day_of_week", "is_night_hour", "pickup_hour", "is_rush_hour", ZONE, "pickup_month",
)
