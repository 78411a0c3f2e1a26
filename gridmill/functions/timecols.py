"""Column functions on dates and times.

Two clocks run side by side: instants (``TIMESTAMP``, session zone UTC) and
local wall time (``TIMESTAMP_NTZ``). Every function takes an explicit
``as_of`` where "now" matters.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, functions as F

BERLIN = "Europe/Berlin"
BRUSSELS = "Europe/Brussels"

# part -> (extractor, narrow type)
_PARTS = {
    "day": (F.dayofmonth, "byte"),
    "month": (F.month, "byte"),
    "year": (F.year, "short"),
    "hour": (F.hour, "byte"),
    "minute": (F.minute, "byte"),
}


def as_utc(moment: datetime) -> datetime:
    """Read a naive ``as_of`` as UTC."""
    return moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment.astimezone(timezone.utc)


def instant(moment: datetime) -> Column:
    """A timestamp literal, independent of the driver's own time zone."""
    return F.lit(as_utc(moment))


def local_midnight(day: date, tz: str) -> datetime:
    """First instant of a local calendar day, in UTC."""
    return datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(tz)).astimezone(timezone.utc)


def local_now(as_of: datetime, tz: str = BERLIN) -> datetime:
    return as_utc(as_of).astimezone(ZoneInfo(tz))


def between(col: Column | str, start: datetime, end: datetime) -> Column:
    """Half-open range on the bare column, so it reaches the Parquet scan."""
    c = F.col(col) if isinstance(col, str) else col
    return (c >= instant(start)) & (c < instant(end))


def on_day(col: Column | str, as_of: datetime, tz: str = "UTC") -> Column:
    """Rows of the as-of calendar day in ``tz``."""
    day = local_now(as_of, tz).date()
    return between(col, local_midnight(day, tz), local_midnight(day + timedelta(days=1), tz))


def within_days(col: Column | str, as_of: datetime, n: int, tz: str = "UTC") -> Column:
    """Rows from the start of the as-of day up to ``n`` days later."""
    day = local_now(as_of, tz).date()
    return between(col, local_midnight(day, tz), local_midnight(day + timedelta(days=n), tz))


def in_month(col: Column | str, year: int, month: int, tz: str = BRUSSELS) -> Column:
    """The whole calendar month in local time, end excluded."""
    first = date(year, month, 1)
    following = date(year + month // 12, month % 12 + 1, 1)
    return between(col, local_midnight(first, tz), local_midnight(following, tz))


def parse_iso(col: Column | str) -> Column:
    """ISO-8601 text (any offset) to an instant; unparseable text gives null."""
    return F.try_to_timestamp(F.col(col) if isinstance(col, str) else col)


def wall_clock(col: Column | str) -> Column:
    """Wall time as written in ISO text, ignoring its offset."""
    c = F.col(col) if isinstance(col, str) else col
    return F.substring(c, 1, 19).try_cast("timestamp_ntz")


def parse_hour_stamp(col: Column | str) -> Column:
    """``yyyyMMddHH`` (longer stamps are cut to the hour) to a UTC instant."""
    c = (F.col(col) if isinstance(col, str) else col).cast("string")
    return F.to_timestamp(F.substring(F.trim(c), 1, 10), "yyyyMMddHH")


def parse_step(col: Column | str) -> Column:
    """Forecast step text to an instant; an undefined step is an error."""
    c = F.col(col) if isinstance(col, str) else col
    parsed = F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss.'000Z'"))
    problem = F.raise_error(F.concat(F.lit("cannot parse forecast step: "), F.coalesce(c, F.lit("undefined"))))
    return F.coalesce(parsed, problem.cast("timestamp"))


def to_local(col: Column | str, tz: str = BERLIN) -> Column:
    """Instant to wall time in ``tz``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_utc_timestamp(c, tz).cast("timestamp_ntz")


def with_calendar_parts(df: DataFrame, col: Column | str, parts=("day", "month", "year", "hour", "minute"),
                        narrow: dict[str, str] | None = None) -> DataFrame:
    """Add calendar parts of a wall-time column in one projection."""
    c = F.col(col) if isinstance(col, str) else col
    narrow = narrow or {}
    return df.withColumns({p: _PARTS[p][0](c).cast(narrow.get(p, _PARTS[p][1])) for p in parts})


def day_label(col: Column | str) -> Column:
    """``Jan 05`` style label."""
    return F.date_format(col, "MMM dd")


def iso_text(col: Column | str) -> Column:
    """Instant to message text: offset always numeric, fraction only when there is one."""
    c = F.col(col) if isinstance(col, str) else col
    whole = F.date_trunc("second", c) == c
    return F.when(whole, F.date_format(c, "yyyy-MM-dd HH:mm:ssxxx")) \
        .otherwise(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSSxxx"))


# Key text per feed; {station} and {category} are filled in.
_PERIOD_PREFIX = {
    "generation": ("electricity/generation/generation_", "dd_MM_yyyy"),
    "load": ("electricity/load/load_", "yyyy_MM_dd_HH"),
    "gas": ("others/gas/gas_price_", "yyyy_MM_dd_HH"),
    "weather_forecast": ("weather_forecast/{station}/", "dd_MM_yyyy"),
    "historical_weather": ("historical_weather/{category}/{station}/", "dd_MM_yyyy"),
}


def period_path(col: Column | str, feed: str, station: str | Column | None = None, category: str | None = None) -> Column:
    """Partition path text of a wall-time column for a feed."""
    prefix, pattern = _PERIOD_PREFIX[feed]
    stamp = F.date_format(col, pattern)
    if "{station}" not in prefix:
        return F.concat(F.lit(prefix), stamp)
    if station is None or ("{category}" in prefix and category is None):
        raise ValueError(f"feed {feed!r} needs a station" + (" and a category" if "{category}" in prefix else ""))
    head = prefix.replace("{category}", category or "").split("{station}")
    station_col = F.lit(station) if isinstance(station, str) else station
    return F.concat(F.lit(head[0]), station_col, F.lit(head[1]), stamp)
