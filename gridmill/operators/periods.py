"""Slices of a table by calendar period.

The requested periods are known from ``as_of``, so each slice is a range (or
a few ranges) on the bare time column: the table is read once and rows out of
range are skipped at the scan. ``period_key`` is the local day or hour.
"""

from __future__ import annotations

from calendar import isleap
from collections.abc import Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gridmill.functions.columns import quoted
from gridmill.functions.timecols import BERLIN, as_utc, between, local_midnight, local_now, to_local
from gridmill.operators.skew import keyed_join

DAY_KEY = "yyyy-MM-dd"
HOUR_KEY = "yyyy-MM-dd-HH"


def _keyed(df: DataFrame, col: str, days: Sequence[tuple[date, date]] | Column, tz: str, pattern: str) -> DataFrame:
    condition = days if isinstance(days, Column) else reduce(
        lambda a, b: a | b,
        [between(quoted(col), local_midnight(a, tz), local_midnight(b, tz)) for a, b in days],
        F.lit(False),
    )
    return df.filter(condition).withColumn("period_key", F.date_format(to_local(quoted(col), tz), pattern))


def slice_last_days(df: DataFrame, col: str, as_of: datetime, n: int = 5, tz: str = BERLIN) -> DataFrame:
    """The n local days before the as-of day."""
    today = local_now(as_of, tz).date()
    return _keyed(df, col, [(today - timedelta(days=n), today)], tz, DAY_KEY)


def slice_next_days(df: DataFrame, col: str, as_of: datetime, n: int, tz: str = BERLIN) -> DataFrame:
    """The n local days after the as-of day."""
    today = local_now(as_of, tz).date()
    return _keyed(df, col, [(today + timedelta(days=1), today + timedelta(days=n + 1))], tz, DAY_KEY)


def same_days(as_of: datetime, years: int = 5, tz: str = BERLIN) -> list[date]:
    """The as-of calendar day in this and earlier years; 29 February only where it exists."""
    today = local_now(as_of, tz).date()
    leap_day = (today.month, today.day) == (2, 29)
    return [today.replace(year=today.year - i) for i in range(years)
            if not leap_day or isleap(today.year - i)]


def slice_same_day(df: DataFrame, col: str, as_of: datetime, years: int = 5, tz: str = BERLIN) -> DataFrame:
    ranges = [(d, d + timedelta(days=1)) for d in same_days(as_of, years, tz)]
    return _keyed(df, col, ranges, tz, DAY_KEY)


def closed_hours_end(as_of: datetime, tz: str = BERLIN) -> datetime:
    return local_now(as_of, tz).replace(minute=0, second=0, microsecond=0)


def slice_closed_hours(df: DataFrame, col: str, as_of: datetime, tz: str = BERLIN) -> DataFrame:
    """The completed local hours of the as-of day."""
    end = closed_hours_end(as_of, tz)
    condition = between(quoted(col), local_midnight(end.date(), tz), as_utc(end))
    return _keyed(df, col, condition, tz, HOUR_KEY)


def trading_hours(as_of: datetime, tz: str = BERLIN) -> tuple[datetime, datetime]:
    """Start of the trading day and end of its completed hours: the as-of day, or Friday up to 23 o'clock at the weekend."""
    now = local_now(as_of, tz)
    back = {5: 1, 6: 2}.get(now.weekday(), 0)
    end = closed_hours_end(as_of, tz) if back == 0 else (now - timedelta(days=back)).replace(hour=23, minute=0, second=0, microsecond=0)
    return local_midnight(end.date(), tz), end


def slice_trading_hours(df: DataFrame, col: str, as_of: datetime, tz: str = BERLIN) -> DataFrame:
    """As closed hours; at the weekend, Friday's hours 0 to 22."""
    first, end = trading_hours(as_of, tz)
    return _keyed(df, col, between(quoted(col), as_utc(first), as_utc(end)), tz, HOUR_KEY)


def slice_by_period(df: DataFrame, keys: DataFrame, grain: str = "hour") -> DataFrame:
    """Rows whose calendar parts equal one of the requested (year, month, day[, hour]) keys."""
    cols = ["year", "month", "day"] + (["hour"] if grain == "hour" else [])
    wanted = keys.select(*[quoted(c).cast(df.schema[c].dataType).alias(c) for c in cols]).distinct()
    return keyed_join(df, wanted, cols, "left_semi")


def missing_periods(keys: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Requested periods without rows."""
    present = df.select(*[quoted(c).cast(keys.schema[c].dataType).alias(c) for c in cols]).distinct()
    return keys.join(present, list(cols), "left_anti")
