"""Date and time-of-day features."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F


def clock(time: Column) -> Column:
    """Timestamp of an ``H:m:s`` string, null when it does not parse."""
    return F.try_to_timestamp(time, F.lit("H:m:s"))


def clock_hour(time: Column) -> Column:
    return F.hour(clock(time))


def moment(date: Column, time: Column) -> Column:
    """Date and time strings joined into one timestamp, null when the time is bad."""
    return F.try_to_timestamp(
        F.concat_ws(" ", F.date_format(date, "yyyy-MM-dd"), F.date_format(clock(time), "HH:mm:ss")),
        F.lit("yyyy-MM-dd HH:mm:ss"),
    )


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a value on a circle of the given period."""
    angle = value * F.lit(2 * math.pi) / F.lit(period)
    return F.sin(angle), F.cos(angle)


def meal_period(hour: Column) -> Column:
    """Right-closed bins: up to 11, 14, 17, 21 and 24; the first bin includes 0."""
    return (
        F.when((hour < 0) | (hour > 24), None)
        .when(hour <= 11, "Morning")
        .when(hour <= 14, "Lunch")
        .when(hour <= 17, "Afternoon")
        .when(hour <= 21, "Dinner")
        .when(hour <= 24, "Late Night")
    )


def payday_distance(day: Column) -> Column:
    return F.least(F.abs(day - 1), F.abs(day - 15), F.abs(day - 30))


def add_time_parts(df: DataFrame, date: str = "order_date", time: str = "order_time") -> DataFrame:
    """Calendar parts, weekend and month-edge flags, meal period, business hours and payday distance."""
    d = F.col(date)
    dated = df.withColumns(
        {
            "year": F.year(d),
            "month": F.month(d),
            "day": F.dayofmonth(d),
            "dayofweek": F.weekday(d),
            "day_name": F.date_format(d, "EEEE"),
            "week": F.weekofyear(d),
            "quarter": F.quarter(d),
            "hour": clock_hour(F.col(time)),
        }
    )
    return dated.withColumns(
        {
            "is_weekend": flag(F.col("dayofweek") >= 5),
            "is_month_start": flag(F.col("day") == 1),
            "is_month_end": flag(F.to_date(d) == F.last_day(d)),
            "meal_period": meal_period(F.col("hour")),
            "is_business_hours": flag(F.col("hour").between(9, 17)),
            "days_from_payday": payday_distance(F.col("day")),
            "is_payday_week": flag(payday_distance(F.col("day")) <= 3),
        }
    )


# column -> (period, output prefix); fixed values
CYCLES = {"hour": 24, "dayofweek": 7, "day": 30, "month": 12, "week": 52}


def add_cycles(df: DataFrame, cycles: dict[str, float] | None = None, names: dict[str, str] | None = None) -> DataFrame:
    """``<name>_sin`` and ``<name>_cos`` for each column; ``names`` renames the output prefix."""
    out = {}
    for column, period in (cycles or CYCLES).items():
        prefix = (names or {}).get(column, column)
        out[f"{prefix}_sin"], out[f"{prefix}_cos"] = cyclic(F.col(column), period)
    return df.withColumns(out)
