"""Calendar rules as boolean columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hours, dates (month, day) and months of the calendar flags.
RUSH_HOURS = (7, 8, 9, 16, 17, 18, 19)
NIGHT_HOURS = (0, 1, 2, 3, 4, 5, 6, 20, 21, 22, 23)
WEEKEND_DAYS = (5, 6)
FIXED_HOLIDAYS = ((1, 1), (6, 19), (7, 4), (11, 11), (12, 25))
FIXED_EVENTS = (
    (3, 17), (6, 4), (6, 5), (6, 6), (6, 7), (6, 8), (6, 9), (6, 10), (6, 11), (6, 12), (6, 13),
    (6, 14), (6, 15), (7, 4), (12, 31),
)
SEASON_MONTHS = {
    "winter": (12, 1, 2), "spring": (3, 4, 5), "summer": (6, 7, 8), "autumn": (9, 10, 11),
}
# Movable days as (month, weekday with Monday = 0, first day, last day).
MOVABLE_HOLIDAYS = (
    (1, 0, 15, 21), (5, 0, 25, 31), (9, 0, 1, 7), (10, 0, 8, 14), (11, 1, 1, 7), (11, 3, 24, 30),
)
MOVABLE_EVENTS = ((6, 6, 24, 30), (11, 3, 24, 30))


def on_dates(day: Column, dates: tuple[tuple[int, int], ...]) -> Column:
    return (F.month(day) * 100 + F.dayofmonth(day)).isin([m * 100 + d for m, d in dates])


def on_movable(day: Column, rules: tuple[tuple[int, int, int, int], ...]) -> Column:
    parts = [
        (F.month(day) == month)
        & (F.weekday(day) == weekday)
        & F.dayofmonth(day).between(first, last)
        for month, weekday, first, last in rules
    ]
    return reduce(lambda left, right: left | right, parts)


def season_of(month: Column) -> Column:
    expr = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, months in SEASON_MONTHS.items():
        expr = expr.when(month.isin(*months), F.lit(name))
    return expr


def is_payday(day: Column, strict: bool = False) -> Column:
    """Month end or the 15th; ``strict`` widens the 15th to weekdays from the 15th to the 17th."""
    number = F.dayofmonth(day)
    mid_month = number == 15
    if strict:
        mid_month = number.between(15, 17) & ~F.weekday(day).isin(*WEEKEND_DAYS)
    return (F.to_date(day) == F.last_day(day)) | mid_month


def flag(condition: Column, kind: str = "tinyint") -> Column:
    return condition.cast(kind)
