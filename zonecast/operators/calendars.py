"""Calendar columns of an hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions import calendar as rules
from zonecast.functions.times import Moment, hour_text, naive, target_hour_of
from zonecast.schemas import BIN


def calendar_parts(df: DataFrame, bin: str = BIN) -> DataFrame:
    ts = F.col(bin)
    return df.withColumns(
        {
            "pickup_year": F.year(ts),
            "pickup_month": F.month(ts),
            "day_of_month": F.dayofmonth(ts),
            "pickup_hour": F.hour(ts),
            "day_of_week": F.weekday(ts),
            "bin_str": hour_text(ts),
        }
    )


def calendar_flags(df: DataFrame, bin: str = BIN) -> DataFrame:
    hour, day = F.hour(bin), F.weekday(bin)
    return df.withColumns(
        {
            "is_weekend": rules.flag(day.isin(*rules.WEEKEND_DAYS)),
            "is_rush_hour": rules.flag(hour.isin(*rules.RUSH_HOURS)),
            "is_night_hour": rules.flag(hour.isin(*rules.NIGHT_HOURS)),
        }
    )


def season(df: DataFrame, bin: str = BIN) -> DataFrame:
    return df.withColumn("season_of_year", rules.season_of(F.month(bin)))


def holidays(df: DataFrame, bin: str = BIN) -> DataFrame:
    day = F.col(bin)
    hit = rules.on_dates(day, rules.FIXED_HOLIDAYS) | rules.on_movable(day, rules.MOVABLE_HOLIDAYS)
    return df.withColumn("is_holiday", rules.flag(hit, "int"))


def special_events(df: DataFrame, bin: str = BIN) -> DataFrame:
    day = F.col(bin)
    hit = rules.on_dates(day, rules.FIXED_EVENTS) | rules.on_movable(day, rules.MOVABLE_EVENTS)
    return df.withColumn("is_special_event", rules.flag(hit, "int"))


def payday(df: DataFrame, strict: bool = False, bin: str = BIN) -> DataFrame:
    return df.withColumn("is_payday", rules.flag(rules.is_payday(F.col(bin), strict), "int"))


def calendar_features(df: DataFrame, bin: str = BIN) -> DataFrame:
    """All training calendar columns."""
    for step in (calendar_parts, calendar_flags, season, holidays, special_events, payday):
        df = step(df, bin=bin)
    return df


def serving_calendar(df: DataFrame, bin: str = BIN) -> DataFrame:
    """Calendar columns used at scoring; here hour 20 is not night, unlike ``calendar_flags``."""
    hour = F.hour(bin)
    return df.withColumns(
        {
            "pickup_hour": hour,
            "is_rush_hour": rules.flag(hour.isin(*rules.RUSH_HOURS)),
            "pickup_month": F.month(bin),
            "day_of_week": F.weekday(bin),
            "is_night_hour": rules.flag(~hour.between(7, 20)),
        }
    )


def target_hour(df: DataFrame, cutoff_minute: int = 35, ts: str = "ts") -> DataFrame:
    return df.withColumn("target_hour", target_hour_of(F.col(ts), cutoff_minute))


def month_windows(df: DataFrame, as_of: str | Moment = "as_of") -> DataFrame:
    """Ingestion month and training window of a date.

    ``as_of`` names a column, or is a date for all rows. Ingestion covers the month 13 months
    back; training covers twelve months up to the first of the previous month, both ends included.
    """
    day = F.to_date(as_of if isinstance(as_of, str) and as_of in df.columns else naive(as_of))
    first = F.trunc(day, "MM")
    ingest = F.add_months(first, -13)
    train_end = F.add_months(first, -1)
    return df.withColumns(
        {
            "ingest_start": ingest,
            "ingest_end": F.last_day(ingest),
            "train_start": F.add_months(train_end, -12),
            "train_end": train_end,
            "days_in_month": F.dayofmonth(F.last_day(day)),
        }
    )
