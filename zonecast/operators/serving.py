"""Boards, rankings and documents for the dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.functions.numeric import round_up_half, zero_filled
from zonecast.functions.times import Moment, hour_text, naive
from zonecast.operators.scoring import in_days
from zonecast.schemas import BIN, CURRENT_FIELDS, TARGETS, ZONE

# Upper limits of the congestion levels and lower limits of the bands, high to low.
LOW_INDEX, MEDIUM_INDEX = 0.0270, 0.0421
DEMAND_LIMITS = (200, 120, 60, 20, 0)
PROFIT_LIMITS = (1500, 1000, 500, 200, 0)

SERVED = (*CURRENT_FIELDS, "zone_congestion_index", "city_congestion_index", *TARGETS)


def level_of(index: Column) -> Column:
    value = F.coalesce(index, F.lit(0.0))
    return (
        F.when(value <= LOW_INDEX, "Low").when(value <= MEDIUM_INDEX, "Medium").otherwise("High")
    )


def speed_of(index: Column) -> Column:
    value = F.lit(25.0) - F.coalesce(index, F.lit(0.0)) * F.lit(200.0)
    return round_up_half(F.greatest(F.lit(5.0), value), 1)


def band_of(value: Column, limits: tuple[int, ...]) -> Column:
    """5 above the highest limit, down to 0 at or below the lowest."""
    expr = F.when(value > limits[0], len(limits))
    for place, limit in enumerate(limits[1:], start=1):
        expr = expr.when(value > limit, len(limits) - place)
    return expr.otherwise(0)


def total_of() -> Column:
    yellow, green, hvfhv = [F.coalesce(t, F.lit(0)) for t in TARGETS]
    return yellow + green + hvfhv


def profit_of() -> Column:
    return total_of() / (F.coalesce("zone_congestion_index", F.lit(0.0)) + F.lit(0.1))


def congestion_level(df: DataFrame, index: str = "zone_congestion_index") -> DataFrame:
    return df.withColumn("congestion_level", level_of(F.col(index)))


def speed_estimate(df: DataFrame, index: str = "zone_congestion_index") -> DataFrame:
    return df.withColumn("speed_estimate", speed_of(F.col(index)))


def profit_score(df: DataFrame) -> DataFrame:
    """Raw profitability for colouring and the rounded score for ranking."""
    return df.withColumns({"profit": profit_of(), "profit_score": round_up_half(profit_of())})


def demand_bands(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "total_demand": total_of(),
            "demand_band": band_of(total_of(), DEMAND_LIMITS),
            "profit_band": band_of(profit_of(), PROFIT_LIMITS),
        }
    )


def _served(
    pred: DataFrame, hour: Moment, fallback_hour: Moment | None, bin: str, zone: str
) -> DataFrame:
    of = lambda moment: in_days(pred, naive(moment), naive(moment)).where(F.col(bin) == naive(moment)).select(
        hour_text(F.col(bin)).alias(bin), zone, *SERVED
    )
    wanted = of(hour)
    if fallback_hour is not None:
        none = wanted.limit(1).agg(F.count(F.lit(1))).scalar() == 0
        wanted = wanted.unionByName(of(fallback_hour).where(none))
    return wanted


def serving_rows(
    pred: DataFrame, hour: Moment, fallback_hour: Moment | None = None, bin: str = BIN, zone: str = ZONE
) -> DataFrame:
    """Forecast rows of ``hour`` by zone; where there are none, those of ``fallback_hour``."""
    return _served(pred, hour, fallback_hour, bin, zone).orderBy(zone)


def serving_document(
    pred: DataFrame,
    hour: Moment,
    generated_at: str,
    fallback_hour: Moment | None = None,
    zones_per_document: int = 1000,
    bin: str = BIN,
    zone: str = ZONE,
) -> DataFrame:
    """JSON ``{metadata, predictions: {zone: row}}`` with zones in order.

    Zone ids are cut into ranges of ``zones_per_document``, one document each, so that no document
    grows with the number of zones; up to that many zones it is a single one. ``total_zones``
    counts all zones.
    """
    rows = _served(pred, hour, fallback_hour, bin, zone)
    entry = F.struct(zone, F.struct(*[c for c in rows.columns if c != zone]).alias("row"))
    pages = (
        rows.groupBy(F.floor(F.col(zone) / F.lit(zones_per_document)).alias("page"))
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"), F.max(bin).alias("window"))
        .withColumn("total", rows.agg(F.count(F.lit(1))).scalar())
    )
    document = F.struct(
        F.struct(
            F.lit(generated_at).alias("generated_at"),
            F.col("total").alias("total_zones"),
            F.col("window").alias("prediction_window"),
        ).alias("metadata"),
        F.map_from_entries("entries").alias("predictions"),
    )
    return pages.select("page", F.to_json(document).alias("document"))


def zone_board(zones: DataFrame, pred: DataFrame, zone: str = ZONE) -> DataFrame:
    """Every zone with its forecast, zeros where it has none, and its derived figures."""
    figures = pred.select(zone, *TARGETS, "zone_congestion_index")
    board = zones.select(zone, "zone", "borough").join(figures, zone, "left")
    board = zero_filled(board, [*TARGETS, "zone_congestion_index"])
    for step in (demand_bands, profit_score, congestion_level, speed_estimate):
        board = step(board)
    return board


def zone_search(board: DataFrame, borough: str | None = None, text: str = "") -> DataFrame:
    """Zones of a borough (all without one) whose name contains ``text``, ignoring case."""
    found = board.where(F.contains(F.lower("zone"), F.lit(text.lower())))
    if borough is None or borough == "All":
        return found
    return found.where(F.col("borough") == borough)


def zone_detail(board: DataFrame, zone_id: int, zone: str = ZONE) -> DataFrame:
    return board.where(F.col(zone) == zone_id)


def top_demand(board: DataFrame, n: int = 20, zone: str = ZONE) -> DataFrame:
    return board.orderBy(F.col("total_demand").desc(), zone).limit(n)


def top_profit(board: DataFrame, n: int = 20, zone: str = ZONE) -> DataFrame:
    return board.orderBy(F.col("profit_score").desc(), zone).limit(n)


def city_header(pred: DataFrame, zone: str = ZONE) -> DataFrame:
    """City totals, with index and weather taken from the zone with the least id."""
    first = lambda name: F.min_by(F.struct(name), F.col(zone))[name]
    head = pred.agg(
        F.sum(total_of()).alias("total_demand"),
        F.coalesce(first("city_congestion_index"), F.lit(0.0)).alias("city_congestion_index"),
        first("feelslike").alias("feelslike"),
        first("humidity").alias("humidity"),
        F.count(F.lit(1)).alias("_zones"),
    ).where("_zones > 0").drop("_zones")
    index = F.col("city_congestion_index")
    return head.withColumns(
        {"congestion_level": level_of(index), "city_speed": speed_of(index)}
    )
