from __future__ import annotations

from datetime import date, datetime

import pytest

from zonecast.operators.calendars import (
    calendar_features, calendar_flags, calendar_parts, month_windows, payday, serving_calendar, target_hour,
)

# date, holiday, special event, payday
GOLDEN = [
    (date(1995, 11, 30), 1, 1, 1),
    (date(1995, 11, 23), 0, 0, 0),
    (date(2000, 11, 30), 1, 1, 1),
    (date(1996, 11, 28), 1, 1, 0),
    (date(1996, 5, 27), 1, 0, 0),
    (date(1996, 1, 15), 1, 0, 1),
    (date(1996, 11, 5), 1, 0, 0),
    (date(1997, 6, 29), 0, 1, 0),
    (date(1997, 7, 4), 1, 1, 0),
    (date(1997, 6, 16), 0, 0, 0),
    (date(1996, 2, 29), 0, 0, 1),
]


def hours(spark, *stamps):
    return spark.createDataFrame([(s,) for s in stamps], "bin timestamp_ntz")


@pytest.mark.parametrize("day,holiday,special,pay", GOLDEN)
def test_golden_days(spark, day, holiday, special, pay):
    row = calendar_features(hours(spark, datetime(day.year, day.month, day.day, 5))).first()
    assert (row["is_holiday"], row["is_special_event"], row["is_payday"]) == (holiday, special, pay)


def test_strict_payday_takes_weekdays_from_the_15th(spark):
    stamps = [datetime(1997, 6, d) for d in (14, 15, 16, 17, 18, 30)]
    got = {r["bin"].day: r["is_payday"] for r in payday(hours(spark, *stamps), strict=True).collect()}
    assert got == {14: 0, 15: 0, 16: 1, 17: 1, 18: 0, 30: 1}


def test_parts_start_the_week_on_monday(spark):
    row = calendar_parts(hours(spark, datetime(2024, 1, 7, 13))).first()
    assert (row["day_of_week"], row["pickup_hour"], row["bin_str"]) == (6, 13, "2024-01-07 13:00:00")


@pytest.mark.parametrize("hour,training,serving", [(6, 1, 1), (7, 0, 0), (19, 0, 0), (20, 1, 0), (21, 1, 1)])
def test_night_differs_at_hour_20(spark, hour, training, serving):
    df = hours(spark, datetime(2024, 1, 3, hour))
    assert calendar_flags(df).first()["is_night_hour"] == training
    assert serving_calendar(df).first()["is_night_hour"] == serving


@pytest.mark.parametrize("minute,cutoff,hour", [(10, 35, 12), (37, 35, 13), (37, 40, 12), (50, 40, 13)])
def test_target_hour(spark, minute, cutoff, hour):
    df = spark.createDataFrame([(datetime(2024, 1, 20, 12, minute),)], "ts timestamp_ntz")
    assert target_hour(df, cutoff).first()["target_hour"] == datetime(2024, 1, 20, hour)


def test_month_windows(spark):
    row = month_windows(spark.range(1), date(2025, 3, 18)).first()
    assert row["ingest_start"] == date(2024, 2, 1) and row["ingest_end"] == date(2024, 2, 29)
    assert row["train_start"] == date(2024, 2, 1) and row["train_end"] == date(2025, 2, 1)
    assert row["days_in_month"] == 31
