"""Trips to the zone x hour panel.

Trips are read once: ``trip_cells`` reduces them to one row per observed (zone, hour) with partial
aggregation before the shuffle, so a hot zone or hour sends one row per task. Every panel column
comes from those cells, whose number is bounded by zones x hours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.functions.numeric import inverse_speed, round_even, zero_filled
from zonecast.schemas import BIN, SERVICES, ZONE
from zonecast.session import small, stage, tasks_for


def trip_counts(trips: DataFrame, zone: str = "pulocationid") -> DataFrame:
    """Trips per (hour, zone, service)."""
    return trips.groupBy(BIN, F.col(zone).alias(ZONE), "service_type").agg(
        F.count(F.lit(1)).alias("trip_count")
    )


def trip_cells(trips: DataFrame, services: tuple[str, ...] = SERVICES, zone: str = "pulocationid") -> DataFrame:
    """One row per observed (zone, hour): trips per service, speed sum, trip count."""
    pivoted = [
        F.count_if(F.col("service_type") == service).alias(f"target_{service}") for service in services
    ]
    return (
        trips.where(F.col(BIN).isNotNull() & F.col(zone).isNotNull())
        .groupBy(F.col(zone).alias(ZONE), BIN)
        .agg(*pivoted, F.sum("mph").alias("mph_sum"), F.count("mph").alias("mph_count"))
    )


def _staged_cells(trips: DataFrame, services: tuple[str, ...] = SERVICES) -> DataFrame:
    return stage(trip_cells(trips, services), "cells")


def hour_table(cells: DataFrame) -> DataFrame:
    """Per observed hour: city speed and index, and city pickups per service."""
    targets = [name for name in cells.columns if name.startswith("target_")]
    mean = F.try_divide(F.sum("mph_sum"), F.sum("mph_count"))
    return with_city_index(
        cells.groupBy(BIN).agg(
            mean.alias("city_avg_speed"),
            *[F.sum(t).alias(f"{t}_city_hour_pickups") for t in targets],
        )
    )


def grid_tasks(cells: DataFrame, continuous: bool = False) -> int:
    """Tasks for the dense grid of staged cells, by its estimated number of rows."""
    span = F.timestamp_diff("HOUR", F.min(BIN), F.max(BIN)) + 1 if continuous else F.approx_count_distinct(BIN)
    rows = cells.agg((F.approx_count_distinct(ZONE) * F.coalesce(span, F.lit(0))).alias("rows")).first()["rows"]
    return tasks_for(cells.sparkSession, rows)


def grid_of(cells: DataFrame, hours: DataFrame, continuous: bool = False, width: int | None = None) -> DataFrame:
    """All zones at all hours: every hour of the span, or only those of ``hours``.

    The hours come from a sequence per zone, so no join multiplies rows; the observed hours are
    kept by an equi semi join. The zones are spread over ``width`` tasks before they grow, as many
    as the session's shuffles have without one.
    """
    width = width or int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = hours.agg(F.min(BIN)).scalar()
    last = hours.agg(F.max(BIN)).scalar()
    span = F.sequence(first, last, F.make_dt_interval(hours=F.lit(1)))
    zones = cells.select(ZONE).distinct().repartition(width, ZONE)
    grid = zones.select(F.explode(span).alias(BIN), ZONE)
    if continuous:
        return grid
    return grid.join(small(hours.select(BIN), "hours"), BIN, "left_semi")


def zone_hour_grid(trips: DataFrame, continuous: bool = False, zone: str = "pulocationid") -> DataFrame:
    keys = trips.where(F.col(BIN).isNotNull() & F.col(zone).isNotNull()).select(
        F.col(zone).alias(ZONE), BIN
    )
    keys = stage(keys.distinct(), "zone_hours")
    return grid_of(keys, keys.select(BIN).distinct(), continuous, grid_tasks(keys, continuous))


def densify(parts: DataFrame, grid: DataFrame, width: int | None = None) -> DataFrame:
    """Add the grid's missing (zone, hour) rows to sparse rows and sum each column per key.

    Stacked rows are partitioned by zone once; the grouping on (zone, hour) and later windows per
    zone reuse that partitioning. A zone has at most two rows per hour and source, so no zone is
    larger than the number of hours allows. ``width`` is the number of partitions where that of the
    session is too small for the rows.
    """
    measures = [name for name in parts.columns if name not in (ZONE, BIN)]
    stacked = grid.unionByName(parts, allowMissingColumns=True)
    more = width is not None and width > int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stacked.repartition(width, ZONE) if more else stacked.repartition(ZONE)
    return placed.groupBy(ZONE, BIN).agg(
        *[F.sum(name).alias(name) for name in measures]
    )


def hourly_targets(trips: DataFrame, services: tuple[str, ...] = SERVICES) -> DataFrame:
    """Trips per service on the dense grid of observed hours and zones, 0 where none."""
    targets = [f"target_{service}" for service in services]
    cells = _staged_cells(trips, services).select(ZONE, BIN, *targets)
    width = grid_tasks(cells)
    dense = densify(cells, grid_of(cells, cells.select(BIN).distinct(), width=width), width)
    return zero_filled(dense, targets).select(BIN, ZONE, *targets)


def city_speed(trips: DataFrame) -> DataFrame:
    """Mean trip speed and congestion index per hour; the mean weighs trips."""
    return with_city_index(trips.groupBy(BIN).agg(F.avg("mph").alias("city_avg_speed")))


def with_city_index(df: DataFrame) -> DataFrame:
    return df.withColumn("city_congestion_index", inverse_speed(F.col("city_avg_speed")))


def zone_mean() -> Column:
    return F.try_divide(F.col("mph_sum"), F.col("mph_count"))


def zone_speed(trips: DataFrame) -> DataFrame:
    """Mean speed per zone and hour of the whole span; falls back to the city, then the overall mean."""
    cells = _staged_cells(trips).select(ZONE, BIN, "mph_sum", "mph_count")
    city = stage(hour_table(cells).select(BIN, "city_avg_speed"), "hours")
    overall = city.agg(F.avg("city_avg_speed")).scalar()
    width = grid_tasks(cells, continuous=True)
    dense = densify(cells, grid_of(cells, city, continuous=True, width=width), width).join(small(city, "hours"), BIN, "left")
    speed = F.coalesce(F.nullif(F.coalesce(zone_mean(), "city_avg_speed"), F.lit(0.0)), overall)
    return dense.select(BIN, ZONE, speed.alias("zone_avg_speed")).withColumn(
        "zone_congestion_index", F.coalesce(inverse_speed(F.col("zone_avg_speed")), F.lit(0.0))
    )


def with_zone_speed(df: DataFrame) -> DataFrame:
    """Zone speed with the city's as fallback, indexes from unrounded speeds, then rounding.

    Kept trips run at 1 mph or more and every panel hour is an observed one, so the overall-mean
    fallback of ``zone_speed`` can never apply here.
    """
    speed = F.coalesce(zone_mean(), F.col("city_avg_speed"))
    index = F.coalesce(inverse_speed(speed), F.lit(0.0))
    return df.withColumns(
        {
            "zone_avg_speed": round_even(speed, 2),
            "zone_congestion_index": round_even(index, 3),
            "city_avg_speed": round_even(F.col("city_avg_speed"), 2),
            "city_congestion_index": round_even(F.col("city_congestion_index"), 3),
        }
    ).drop("mph_sum", "mph_count")


def panel_from_cells(cells: DataFrame) -> DataFrame:
    """The panel of ``panel_full`` from staged cells."""
    targets = [name for name in cells.columns if name.startswith("target_")]
    hours = stage(hour_table(cells), "hours")
    width = grid_tasks(cells)
    dense = zero_filled(densify(cells, grid_of(cells, hours, width=width), width), targets)
    return with_zone_speed(dense.join(small(hours, "hours"), BIN)).select(
        BIN, ZONE, *targets,
        "city_avg_speed", "city_congestion_index", "zone_avg_speed", "zone_congestion_index",
    )


def panel_full(trips: DataFrame, services: tuple[str, ...] = SERVICES) -> DataFrame:
    """Dense panel with demand per service, speeds and congestion indexes."""
    return panel_from_cells(_staged_cells(trips, services))
