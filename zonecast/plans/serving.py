"""Forecast table to the dashboard's tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame

from zonecast.operators.serving import city_header, serving_rows, top_demand, top_profit, zone_board
from zonecast.session import stage


def forecast_hours(as_of: datetime, cutoff_minute: int = 35) -> tuple[datetime, datetime]:
    """The hour to serve, and the hour to fall back to."""
    this = as_of.replace(minute=0, second=0, microsecond=0)
    return (this if as_of.minute < cutoff_minute else this + timedelta(hours=1)), this


def dashboard(pred: DataFrame, zones: DataFrame, as_of: datetime) -> dict[str, DataFrame]:
    """Rows of the served hour, the zone board, both rankings and the city header."""
    hour, this = forecast_hours(as_of)
    rows = stage(serving_rows(pred, hour, this), "served")
    board = stage(zone_board(zones, rows), "board")
    return {
        "rows": rows,
        "board": board,
        "top_demand": top_demand(board),
        "top_profit": top_profit(board),
        "header": city_header(rows),
    }
