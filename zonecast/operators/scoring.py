"""Operators of the next-hour scoring job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.functions.numeric import inverse_speed
from zonecast.functions.times import Moment, naive, plus_hours, plus_years, target_hour_of
from zonecast.schemas import BIN, CITY_DEMAND, DAY, NEIGHBOR_DEMAND, TARGETS, ZONE
from zonecast.session import small, stage


def _window_end(as_of: Moment, cutoff_minute: int) -> Column:
    return target_hour_of(naive(as_of), cutoff_minute)


def history_window(
    panel: DataFrame, as_of: Moment, hours: int = 24, cutoff_minute: int = 35, bin: str = BIN
) -> DataFrame:
    """Rows of the ``hours`` before the target hour of ``as_of``; of a table by days only those days."""
    end = _window_end(as_of, cutoff_minute)
    return in_days(panel, plus_hours(end, -hours), end).where((F.col(bin) >= plus_hours(end, -hours)) & (F.col(bin) < end))


def in_days(table: DataFrame, start: Column, end: Column) -> DataFrame:
    """Where the table is kept by day, only the folders from ``start``'s to ``end``'s."""
    return table.where(F.col(DAY).between(F.to_date(start), F.to_date(end))) if DAY in table.columns else table


def history_fallback(
    recent: DataFrame,
    panel: DataFrame,
    as_of: Moment,
    always_shift: bool = False,
    hours: int = 24,
    cutoff_minute: int = 35,
    bin: str = BIN,
) -> DataFrame:
    """``recent``, or where it has no rows the panel's same window a year earlier, moved on a year.

    ``always_shift`` moves the recent rows as well.
    """
    start = plus_hours(_window_end(as_of, cutoff_minute), -hours) + F.make_ym_interval(
        years=F.lit(-1)
    )
    empty = recent.limit(1).agg(F.count(F.lit(1))).scalar() == 0
    shifted = plus_years(F.col(bin), 1)
    earlier = in_days(panel, start, plus_hours(start, hours)).where(
        (F.col(bin) >= start) & (F.col(bin) < plus_hours(start, hours)) & empty
    ).withColumn(bin, shifted)
    if always_shift:
        recent = recent.withColumn(bin, shifted)
    return recent.unionByName(earlier.select(*recent.columns))


def candidate_rows(history: DataFrame, weather: DataFrame, zone: str = ZONE) -> DataFrame:
    """One row per zone of the history with the columns of the one-row ``weather``; none without it."""
    row = weather.select(F.struct(*weather.columns)).scalar()
    return (
        history.select(zone).distinct().withColumn("_weather", row)
        .where(F.col("_weather").isNotNull())
        .select(zone, "_weather.*")
    )


def zone_lookup(df: DataFrame, lookup: DataFrame, zone: str = ZONE) -> DataFrame:
    """Attach zone and borough names."""
    names = lookup.select(F.col("locationid").alias(zone), "zone", "borough")
    return df.join(small(names, "lookup"), zone, "left")


def latest_readings(feed: DataFrame, n: int | None = None) -> DataFrame:
    """The ``n`` latest readings, all without a number; of one time those first by their columns."""
    if n is None:
        return feed
    return feed.orderBy(F.col("data_as_of").desc(), *[name for name in feed.columns if name != "data_as_of"]).limit(n)


def _speed(feed: DataFrame) -> DataFrame:
    return feed.withColumn("speed", F.col("speed").try_cast("double"))


def borough_speed(feed: DataFrame) -> DataFrame:
    """Mean road speed per borough; texts that are no numbers do not count."""
    return _speed(feed).groupBy("borough").agg(F.avg("speed").alias("borough_speed"))


# Lengths of the substrings that names are looked up by, each twice the one before.
GRAMS = (1, 2, 4, 8, 16, 32, 64)


def _grams(text: Column, size: Column) -> Column:
    """The distinct substrings of ``size`` letters."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
    return F.when(F.length(text) >= size, F.array_distinct(F.transform(starts, lambda at: F.substr(text, at, size))))


def _gram_size(name: Column) -> Column:
    """The longest of ``GRAMS`` that fits into a name: over half of its letters, for names below 128."""
    return F.greatest(*[F.when(F.length(name) >= size, size).otherwise(0) for size in GRAMS])


def zone_road_speed(zones: DataFrame, feed: DataFrame, zone: str = ZONE) -> DataFrame:
    """Mean speed of the road links whose name contains the zone name, ignoring case.

    Zones without a matching link, or without a name, take their borough's mean; a zone whose
    matching links have no readable speed stays null. The feed is summed once, per link and borough.
    Containment goes by an index of substrings: every zone name stands under that of its substrings of
    over half its length which the fewest links have, a link emits each of its substrings of these
    lengths once, and whole names are compared only where the two meet. The index has many times the
    links' size, which no plan knows, so it joins by shuffle.
    """
    sums = lambda: [F.sum(c).alias(c) for c in ("total", "readable", "matches")]
    read = stage(
        _speed(feed).groupBy(F.lower("link_name").alias("link"), "borough").agg(
            F.sum("speed").alias("total"), F.count("speed").alias("readable"), F.count(F.lit(1)).alias("matches")
        ),
        "road-sums",
    )
    boroughs = read.groupBy("borough").agg(F.try_divide(F.sum("total"), F.sum("readable")).alias("borough_speed"))
    links = read.where(F.col("link").isNotNull()).groupBy("link").agg(*sums())
    names = zones.select(F.lower("zone").alias("name")).where(F.length("name") > 0).distinct()
    names = names.withColumn("size", _gram_size(F.col("name")))
    used = names.agg(F.collect_set("size")).scalar()
    empty = F.array().cast("array<string>")
    parts = [F.when(F.array_contains(F.col("sizes"), size), F.coalesce(_grams(F.col("link"), F.lit(size)), empty)).otherwise(empty) for size in GRAMS]
    index = links.withColumn("sizes", used).select("link", "total", "readable", "matches", F.explode(F.concat(*parts)).alias("gram"))
    often = index.groupBy("gram").agg(F.count(F.lit(1)).alias("many"))
    own = names.select("name", F.explode(_grams(F.col("name"), F.col("size"))).alias("gram"))
    # A substring that no link has leaves its name without a match, whatever the others are.
    rarest = own.join(often.hint("merge"), "gram", "left").groupBy("name").agg(F.min_by("gram", F.struct(F.coalesce("many", F.lit(0)), "gram")).alias("gram"))
    by_name = index.hint("merge").join(rarest, "gram").where(F.contains("link", "name")).groupBy("name").agg(*sums())
    speed = F.when(F.col("matches") > 0, F.try_divide(F.col("total"), F.col("readable"))).otherwise(F.col("borough_speed"))
    return (
        zones.withColumn("name", F.lower("zone"))
        .join(by_name, "name", "left")
        .join(small(boroughs, "borough_speed"), "borough", "left")
        .select(zone, speed.alias("zone_avg_speed"))
    )


def serving_congestion(df: DataFrame, bin: str = BIN) -> DataFrame:
    """City and zone congestion indexes of scoring rows from ``zone_avg_speed``, which is dropped.

    The city mean weighs zones; missing zone speeds take the city's, missing city speeds the mean
    over rows, and an unusable speed the index of the mean speed. All means follow from one
    aggregate per hour.
    """
    hours = stage(
        df.groupBy(bin).agg(
            F.count(F.lit(1)).alias("_rows"),
            F.count("zone_avg_speed").alias("_known"),
            F.sum("zone_avg_speed").alias("_total"),
            F.avg("zone_avg_speed").alias("_city"),
        ),
        "hour_speed",
    )
    weighed = F.sum(F.col("_city") * F.col("_rows"))
    city_mean = F.try_divide(weighed, F.sum(F.when(F.col("_city").isNotNull(), F.col("_rows"))))
    hours = hours.withColumn("_overall", hours.agg(city_mean).scalar()).withColumn(
        "_city", F.coalesce("_city", "_overall")
    )
    filled = F.coalesce("_total", F.lit(0.0)) + F.coalesce(
        F.col("_city") * (F.col("_rows") - F.col("_known")), F.lit(0.0)
    )
    usable = F.sum(F.when(F.col("_city").isNotNull(), F.col("_rows")).otherwise(F.col("_known")))
    zone_overall = hours.agg(F.try_divide(F.sum(filled), usable)).scalar()
    one = F.lit(1.0)
    speed = F.coalesce("zone_avg_speed", "_city")
    return (
        df.join(hours.select(bin, "_city", "_overall"), bin, "left")
        .withColumn("_zone_overall", zone_overall)
        .withColumns(
            {
                "city_congestion_index": F.coalesce(
                    inverse_speed(F.col("_city")), F.try_divide(one, F.col("_overall"))
                ),
                "zone_congestion_index": F.coalesce(
                    inverse_speed(speed), F.try_divide(one, F.col("_zone_overall"))
                ),
            }
        )
        .drop("_city", "_overall", "_zone_overall", "zone_avg_speed")
    )


# Columns that a scoring frame must not hold.
NOT_SCORED = (
    *TARGETS, "pickup_datetime", *CITY_DEMAND, *NEIGHBOR_DEMAND, "zone_avg_speed", "city_avg_speed",
)


def scoring_frame(df: DataFrame, target: Moment | Column, bin: str = BIN) -> DataFrame:
    """Rows of the target hour without the columns that are unknown when scoring."""
    return df.withColumn(bin, F.col(bin).cast("timestamp_ntz")).where(
        F.col(bin) == naive(target)
    ).drop(*NOT_SCORED)


def clean_forecast(df: DataFrame, cols: Sequence[str] = TARGETS) -> DataFrame:
    """Whole, non-negative forecasts; halves go to the even number."""
    return df.withColumns(
        {name: F.bround(F.greatest(F.col(name), F.lit(0.0))).cast("int") for name in cols}
    )


def score_linear(df: DataFrame, coefs: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """Forecast each target as a weighted sum of columns (``intercept`` is the constant), cleaned."""
    sums = {}
    for target, weights in coefs.items():
        terms = [F.col(name) * F.lit(float(w)) for name, w in weights.items() if name != "intercept"]
        constant = F.lit(float(weights.get("intercept", 0.0)))
        sums[target] = reduce(lambda left, right: left + right, terms, constant)
    return clean_forecast(df.withColumns(sums), tuple(coefs))


def weather_before(docs: DataFrame, as_of: datetime | str, at: str = "observed_at") -> DataFrame:
    """The newest current-conditions row not later than ``as_of``."""
    return docs.where(F.col(at) <= naive(as_of)).orderBy(F.col(at).desc()).limit(1).drop(at)
