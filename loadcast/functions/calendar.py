"""Calendar features, the linear trend and US federal holidays as column expressions.

The holiday test is a rule expression evaluated per row inside whole-stage codegen, so
flagging holidays needs no lookup table, no join and no broadcast, for any date range.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import BUSINESS_HOURS, MORNING_HOURS, SECONDS_PER_YEAR
from .timegrid import epoch_seconds, ntz

# --------------------------------------------------------------------------------------
# The US federal holiday calendar.
# Fixed-date holidays move to the nearest weekday (Saturday -> Friday, Sunday -> Monday);
# only the observed date counts. (name, month, day, first observed date or None)
FIXED_DATE_HOLIDAYS = [
    ("New Year's Day", 1, 1, None),
    ("Juneteenth", 6, 19, "2021-06-18"),
    ("Independence Day", 7, 4, None),
    ("Veterans Day", 11, 11, None),
    ("Christmas Day", 12, 25, None),
]
# Floating holidays: (name, month, weekday with Monday=1 .. Sunday=7, n-th; -1 = last).
FLOATING_HOLIDAYS = [
    ("Martin Luther King Jr. Day", 1, 1, 3),
    ("Presidents Day", 2, 1, 3),
    ("Memorial Day", 5, 1, -1),
    ("Labor Day", 9, 1, 1),
    ("Columbus Day", 10, 1, 2),
    ("Thanksgiving Day", 11, 4, 4),
]
# --------------------------------------------------------------------------------------


def _iso_weekday(d: Column) -> Column:
    """Monday=1 .. Sunday=7 (Spark's dayofweek is Sunday=1 .. Saturday=7)."""
    return F.pmod(F.dayofweek(d) + 5, F.lit(7)) + 1


def _month_day(d: Column) -> Column:
    return F.month(d) * 100 + F.dayofmonth(d)


def is_federal_holiday(d: Column) -> Column:
    """True when date ``d`` is an observed US federal holiday (NULL date -> false).

    A fixed-date holiday is observed on its own date when that is a weekday, on the Friday
    before when it falls on a Saturday, and on the Monday after when it falls on a Sunday;
    so ``d`` is observed when it is a weekday holiday, a Friday before one, or a Monday
    after one. Compact on purpose: the test runs per row inside generated code.
    """
    wd, dom = _iso_weekday(d), F.dayofmonth(d)

    def fixed(md: Column, on: Column) -> Column:
        hits = []
        for _, month, day, first in FIXED_DATE_HOLIDAYS:
            t = md == month * 100 + day
            if first:
                t = t & (on >= F.lit(first).cast("date"))
            hits.append(t)
        out = hits[0]
        for h in hits[1:]:
            out = out | h
        return out

    tests = [
        (wd <= 5) & fixed(_month_day(d), d),
        (wd == 5) & fixed(_month_day(F.date_add(d, 1)), d),
        (wd == 1) & fixed(_month_day(F.date_sub(d, 1)), d),
    ]
    for _, month, weekday, nth in FLOATING_HOLIDAYS:
        in_week = (dom > F.dayofmonth(F.last_day(d)) - 7) if nth < 0 else (F.floor((dom - 1) / 7) == nth - 1)
        tests.append((F.month(d) == month) & (wd == weekday) & in_week)
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return F.coalesce(out, F.lit(False))


def holiday_flag(ts: Column) -> Column:
    return is_federal_holiday(F.to_date(ts)).cast("int")


def hour_flag(hour: Column, bounds: tuple[int, int]) -> Column:
    """1 when ``bounds[0] <= hour <= bounds[1]``, else 0 (NULL -> 0)."""
    return F.coalesce(hour.between(*bounds).cast("int"), F.lit(0))


def linear_trend(ts: Column, begin: str) -> Column:
    """Years (of 365.25 days) since ``begin``, as double; NULL -> 0."""
    secs = epoch_seconds(ts) - epoch_seconds(ntz(begin))
    return F.coalesce(secs / F.lit(SECONDS_PER_YEAR), F.lit(0.0))


def calendar_columns(ts: str, trend_begin: str) -> dict[str, Column]:
    """Calendar features of an hour column, in the order the feature table holds them."""
    t = F.col(ts)
    hour = F.hour(t)
    return {
        "year": F.year(t),
        "month": F.month(t),
        "weekofyear": F.weekofyear(t),
        "dayofmonth": F.dayofmonth(t),
        "hourofday": hour,
        "dayofweek": F.date_format(t, "EEEE"),
        "linearTrend": linear_trend(t, trend_begin),
        "date": F.to_date(t),
        "Holiday": holiday_flag(t),
        "BusinessHour": hour_flag(hour, BUSINESS_HOURS),
        "Morning": hour_flag(hour, MORNING_HOURS),
    }


def add_calendar(df, ts: str, trend_begin: str):
    return df.withColumns(calendar_columns(ts, trend_begin))
