"""Hour bins and naive-timestamp literals.

Timestamps are naive (``TIMESTAMP_NTZ``); sessions run with the UTC time zone.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

Moment = str | date | datetime


def naive(moment: Moment | Column) -> Column:
    """Literal of type ``TIMESTAMP_NTZ``; a column is passed through."""
    if isinstance(moment, Column):
        return moment
    text = moment if isinstance(moment, str) else moment.isoformat(sep=" ") if isinstance(
        moment, datetime
    ) else moment.isoformat()
    return F.lit(text).cast("timestamp_ntz")


def floor_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def hour_number(ts: Column) -> Column:
    """Hours since the epoch, as a long."""
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / F.lit(3600)).cast("long")


def plus_hours(ts: Column, hours: int) -> Column:
    return ts + F.make_dt_interval(hours=F.lit(hours))


def plus_years(ts: Column, years: int) -> Column:
    return ts + F.make_ym_interval(years=F.lit(years))


def hour_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def elapsed_hours(start: Column, end: Column) -> Column:
    """Hours between two naive timestamps, with fractions of a second."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(3.6e9)


def target_hour_of(ts: Column, cutoff_minute: int) -> Column:
    """This hour before the cut-off minute, the next hour from it on."""
    hour = floor_hour(ts)
    return F.when(F.minute(ts) < cutoff_minute, hour).otherwise(plus_hours(hour, 1))
