"""Recent panel, current weather and road speeds to the next-hour forecast."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from zonecast.functions.times import naive, target_hour_of
from zonecast.operators.calendars import serving_calendar
from zonecast.operators.lags import city_demand, serving_lags
from zonecast.operators.scoring import (
    candidate_rows, history_fallback, history_window, latest_readings, scoring_frame,
    serving_congestion, zone_lookup, zone_road_speed,
)
from zonecast.operators.spatial import neighbor_demand
from zonecast.operators.weather import current_weather, current_weather_bin
from zonecast.schemas import CURRENT_FIELDS, DAY, TARGETS, ZONE
from zonecast.session import stage
from zonecast.sources.store import append_predictions, prediction_schema

# Columns read from the history.
HISTORY = (
    "pickup_month", *CURRENT_FIELDS, "pickup_hour", "day_of_week", "is_rush_hour", "is_night_hour",
    ZONE, "bin", *TARGETS, "zone_congestion_index", "city_congestion_index",
)


def scoring_rows(
    log: DataFrame,
    panel: DataFrame,
    weather: DataFrame,
    readings: DataFrame,
    lookup: DataFrame,
    edges: DataFrame,
    as_of: datetime,
    row_cutoff: int = 40,
    readings_limit: int | None = None,
) -> DataFrame:
    """Model inputs of the target hour for every zone seen in the last day.

    ``weather`` is the one-row document with current conditions. History comes from the prediction
    log, or from the panel a year back where the log has no recent rows. All road readings count,
    unless ``readings_limit`` names how many of the latest.
    """
    kept = lambda table: table.select(*HISTORY, *[name for name in (DAY,) if name in table.columns])
    recent = history_window(kept(log), as_of).select(*HISTORY)
    history = stage(history_fallback(recent, kept(panel), as_of), "history")
    now = serving_calendar(current_weather_bin(current_weather(weather), as_of.date()))
    candidates = candidate_rows(history, now)
    named = zone_lookup(candidates.select(ZONE), lookup)
    speeds = zone_road_speed(named, latest_readings(readings, readings_limit))
    candidates = serving_congestion(candidates.join(speeds, ZONE, "left"))
    history = neighbor_demand(city_demand(history), edges)
    target = target_hour_of(naive(as_of), row_cutoff)
    return scoring_frame(serving_lags(history, candidates), target)


def store_forecast(forecast: DataFrame, history: DataFrame, path: str) -> DataFrame:
    """Write forecasts to the prediction log, typed; the first run also writes the history."""
    kept = [name for name in HISTORY if name in forecast.columns]
    return append_predictions(
        prediction_schema(forecast.select(*kept)), prediction_schema(history.select(*kept)), path
    )
