"""Daily marts served to dashboards.

Each mart reads only the columns it needs, aggregates once and labels last:
groups are real dates, the text label never decides order or grouping.
``scale`` sums fixed-point values exactly where a feed has a fixed number of
decimals.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from gridmill.functions.columns import coerce_numeric, drop_null_dates, fixed2, quoted, row_mean, series_title
from gridmill.functions.timecols import between, day_label, local_midnight, local_now, to_local, within_days
from gridmill.operators.ordered import last_n, pct_change
from gridmill.operators.shape import exact_mean, means_by, sum_columns_by, to_long, total_by
from gridmill.schemas import GENERATION_COLUMNS


def mart_gas_prices(gas: DataFrame, days: int = 3, scale: int | None = None) -> DataFrame:
    """Mean prices of the last days and the change between them (the first has none).

    The days shown are found on the date column alone; prices are then read
    from the first of them on, which skips older partitions and row groups.
    """
    first = (last_n(gas.select(F.to_date("date").alias("day")).na.drop().distinct(), "day", days)
             .agg(F.min("day")).first()[0])
    recent = gas.filter(F.col("date") >= F.lit(first).cast(gas.schema["date"].dataType))
    daily = means_by(recent.select(F.to_date("date").alias("day"), "open_price", "close_price"), ["day"],
                     ["open_price", "close_price"], value=lambda c: exact_mean(c, scale))
    shown = last_n(daily, "day", days).withColumn("average_price", row_mean(["open_price", "close_price"]))
    changed = pct_change(shown, ["day"], "average_price", name="price_change_pct", group_bound=days)
    return changed.select("day", day_label("day").alias("day_label"), "open_price", "close_price", "average_price",
                          "price_change_pct", fixed2("price_change_pct", "%").alias("price_change_text"))


def mart_load_days(load: DataFrame, scale: int | None = None, last_days: int | None = None,
                   as_of: datetime | None = None) -> DataFrame:
    """Total load per date; all dates unless ``last_days`` before ``as_of`` are asked for."""
    rows = drop_null_dates(load, "date")
    if last_days is not None:
        if as_of is None:
            raise ValueError("last_days needs as_of")
        today = local_now(as_of, "UTC").date()
        first = date.fromordinal(today.toordinal() - last_days)
        rows = rows.filter(between("date", local_midnight(first, "UTC"), local_midnight(today, "UTC")))
    totals = total_by(rows.select(F.to_date("date").alias("day"), "load"), ["day"], "load", scale)
    return totals.select("day", day_label("day").alias("day_label"), "load")


def mart_generation_mix(generation: DataFrame, columns: Sequence[str] | None = None, calendar: bool = False,
                        scale: int | None = None, tz: str = "UTC") -> DataFrame:
    """Generation per day and type, long form with labels.

    ``calendar`` puts the same month and day of all years together.
    """
    cols = list(columns or GENERATION_COLUMNS)
    absent = [c for c in cols if c not in generation.columns]
    if absent:
        raise ValueError(f"generation types are missing: {', '.join(absent)}; name the types there are in columns")
    local = to_local("date", tz) if tz != "UTC" else F.col("date")
    if calendar:
        stored = {"month", "day"} <= set(generation.columns)
        month, day_of_month = (F.col("month"), F.col("day")) if stored else (F.month(local), F.dayofmonth(local))
        # A leap year is used for the label, so that 29 February has one.
        day = F.make_date(F.lit(2024), month.cast("int"), day_of_month.cast("int"))
    else:
        day = F.to_date(local)
    numbers = coerce_numeric(generation, cols).withColumn("day", day)
    daily = sum_columns_by(numbers.select("day", *[quoted(c) for c in cols]), ["day"], cols, scale)
    long = to_long(daily, ["day"], cols, "energy_type", "generated")
    return long.select("day", day_label("day").alias("day_label"), "energy_type",
                       series_title("energy_type").alias("energy_title"), "generated")


# Forecast columns shown in the weather outlook.
OUTLOOK = ["wind_speed", "global_irradiance", "sunshine_dur"]


def mart_weather_days(forecast: DataFrame, as_of: datetime, days: int = 3, scale: int | None = None) -> DataFrame:
    """Mean outlook per day from the as-of day on, with value texts."""
    chosen = forecast.filter(within_days("forecast_time", as_of, days))
    daily = means_by(chosen.select(F.to_date("forecast_time").alias("day"), *OUTLOOK), ["day"], OUTLOOK,
                     value=lambda c: exact_mean(c, scale))
    return daily.select("day", day_label("day").alias("day_label"), *OUTLOOK,
                        *[fixed2(c).alias(f"{c}_text") for c in OUTLOOK])
