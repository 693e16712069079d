"""Trips, weather and adjacency to the feature panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.functions.numeric import zero_filled
from zonecast.functions.times import Moment
from zonecast.operators.calendars import calendar_features
from zonecast.operators.lags import lag_features
from zonecast.operators.panel import densify, grid_of, grid_tasks, hour_table, trip_cells, with_zone_speed
from zonecast.operators.spatial import neighbor_sums
from zonecast.operators.trips import hour_bin, normalize_feed, union_feeds, valid_trips, window_filter
from zonecast.operators.weather import panel_weather
from zonecast.schemas import BIN, LAG_SOURCES, NEIGHBOR_DEMAND, TARGETS, ZONE
from zonecast.session import small, stage
from zonecast.sources.store import upsert_features


def clean_trips(feeds: dict[str, DataFrame], start: Moment | None = None, end: Moment | None = None) -> DataFrame:
    """Valid, binned trips of all feeds, optionally of the days from ``start`` to ``end``."""
    trips = union_feeds(*[normalize_feed(df, feed) for feed, df in feeds.items()])
    if start is not None and end is not None:
        trips = window_filter(trips, start, end)
    return hour_bin(valid_trips(trips))


def feature_panel(
    trips: DataFrame, weather: DataFrame, edges: DataFrame, carry_in: DataFrame | None = None
) -> DataFrame:
    """Dense panel with speeds, weather, calendar, city and neighbour sums and all lags.

    The trips are reduced to cells once. Everything that depends on the hour alone (city speed and
    demand, weather, calendar) is computed per hour. Own counts and neighbour sums are sparse; they
    are added to the grid rows in one shuffle by zone, which the lag window then reuses. Weather
    and calendar columns join after the window, so they are not sorted with it; the join is by hour
    row, as an hour with two weather readings makes two rows per zone. Such rows are numbered by
    their readings, so neither the join nor the lags depend on the order of the input.
    ``carry_in`` holds panel rows of earlier months that feed the first lags.
    """
    cells = stage(trip_cells(trips), "cells")
    city = hour_table(cells)
    hours = calendar_features(panel_weather(city, weather))
    readings = [name for name in hours.columns if name not in city.columns]
    turn = F.row_number().over(Window.partitionBy(BIN).orderBy(*readings))
    hours = stage(hours.withColumn("_turn", turn), "hours")
    thin = hours.select("_turn", *city.columns)
    wide = hours.select(BIN, "_turn", *readings)

    within = edges.join(cells.select(ZONE).distinct(), ZONE, "left_semi")
    width = grid_tasks(cells)
    sparse = cells.unionByName(neighbor_sums(cells, within, width=width), allowMissingColumns=True)
    dense = zero_filled(densify(sparse, grid_of(cells, hours, width=width), width), TARGETS + NEIGHBOR_DEMAND)
    panel = with_zone_speed(dense.join(small(thin, "hours"), BIN))
    if carry_in is not None:
        carry_in = carry_in.select(ZONE, BIN, *LAG_SOURCES).withColumn("_turn", F.lit(0))
    lagged = lag_features(panel, LAG_SOURCES, carry_in=carry_in, ties=("_turn",))
    return lagged.join(small(wide, "hours"), [BIN, "_turn"]).drop("_turn")


def save_feature_panel(panel: DataFrame, path: str) -> DataFrame:
    """Upsert the panel into the monthly partitioned feature table."""
    return upsert_features(panel, path)
