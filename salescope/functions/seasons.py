"""Holiday distance and regional season features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salescope.functions.times import flag

# Public holidays of the region, by rule.
# (name, month, weekday Monday=0, n-th in month, first year); n = -1 is the last one.
WEEKDAY_HOLIDAYS = [
    ("Dr. Martin Luther King Jr. / Civil Rights Day", 1, 0, 3, 1986),
    ("Lincoln/Washington Presidents' Day", 2, 0, 3, 1879),
    ("Memorial Day", 5, 0, -1, 1971),
    ("Labor Day", 9, 0, 1, 1894),
    ("Columbus Day", 10, 0, 2, 1970),
    ("Thanksgiving Day", 11, 3, 4, 1942),
]
# (name, month, day, first year); one that falls on a weekend is also observed on the nearest weekday.
DATE_HOLIDAYS = [
    ("New Year's Day", 1, 1, 1871),
    ("Juneteenth National Independence Day", 6, 19, 2021),
    ("Independence Day", 7, 4, 1871),
    ("Veterans Day", 11, 11, 1938),
    ("Christmas Day", 12, 25, 1871),
]
# Average temperature by month.
MONTH_TEMPERATURE = {1: 65, 2: 70, 3: 75, 4: 85, 5: 95, 6: 105, 7: 106, 8: 105, 9: 100, 10: 88, 11: 75, 12: 65}
NO_HOLIDAY_AHEAD = 30


def _nth_weekday(year: Column, month: int, weekday: int, n: int) -> Column:
    first = F.make_date(year, F.lit(month), F.lit(1))
    if n > 0:
        return F.date_add(first, F.pmod(F.lit(weekday) - F.weekday(first), F.lit(7)) + 7 * (n - 1))
    last = F.last_day(first)
    return F.date_sub(last, F.pmod(F.weekday(last) - F.lit(weekday), F.lit(7)))


def year_holidays(year: Column) -> Column:
    """Array of (date, name) structs of one calendar year, observed days included."""
    entries = []
    for name, month, weekday, n, since in WEEKDAY_HOLIDAYS:
        day = _nth_weekday(year, month, weekday, n)
        entries.append(F.struct(F.when(year >= since, day).alias("date"), F.lit(name).alias("name")))
    fixed = [(name, month, day, since, 0) for name, month, day, since in DATE_HOLIDAYS]
    # the next New Year's Day can be observed on 31 December of this year
    fixed.append((*DATE_HOLIDAYS[0], 1))
    for name, month, day, since, later in fixed:
        on = F.make_date(year + later, F.lit(month), F.lit(day))
        shifted = F.when(F.weekday(on) == 5, F.date_sub(on, 1)).when(F.weekday(on) == 6, F.date_add(on, 1))
        for date, label in ((on, name), (shifted, f"{name} (observed)")):
            keep = (year + later >= since) & (F.year(date) == year)
            entries.append(F.struct(F.when(keep, date).alias("date"), F.lit(label).alias("name")))
    return F.filter(F.array(*entries), lambda h: h["date"].isNotNull())


def holiday_columns(date: Column) -> dict[str, Column]:
    """Holiday flag, name and days to the next holiday of the same year."""
    holidays = year_holidays(F.year(date))
    today = F.filter(holidays, lambda h: h["date"] == date)
    ahead = F.transform(F.filter(holidays, lambda h: h["date"] >= date), lambda h: F.datediff(h["date"], date))
    return {
        "is_holiday": (F.size(today) > 0).cast("int"),
        "holiday_name": F.coalesce(F.get(today, F.lit(0))["name"], F.lit("None")),
        "days_to_holiday": F.coalesce(F.array_min(ahead), F.lit(NO_HOLIDAY_AHEAD)),
    }


def calendar(spark: SparkSession, first_year: int = 1980, last_year: int = 2049) -> DataFrame:
    """One row per day of the years given, with its holiday columns."""
    days = spark.range(1).select(
        F.explode(
            F.sequence(F.to_date(F.lit(f"{first_year}-01-01")), F.to_date(F.lit(f"{last_year}-12-31")))
        ).alias("calendar_date")
    )
    return days.select("calendar_date", *[c.alias(n) for n, c in holiday_columns(F.col("calendar_date")).items()])


def add_holidays(df: DataFrame, date: str = "order_date", first_year: int = 1980, last_year: int = 2049) -> DataFrame:
    """Attach the calendar (365 rows a year of the range, so safe to broadcast); other years are computed in place."""
    days = calendar(df.sparkSession, first_year, last_year)
    joined = df.join(F.broadcast(days), F.to_date(F.col(date)) == F.col("calendar_date"), "left")
    outside = F.col("calendar_date").isNull() & F.col(date).isNotNull()
    direct = holiday_columns(F.to_date(F.col(date)))
    return joined.select(
        *[df[c] for c in df.columns],
        *[F.when(outside, direct[n]).otherwise(F.col(n)).alias(n) for n in direct],
    )


def season(month: Column) -> Column:
    return (
        F.when(month.isin(6, 7, 8, 9), "Extreme Heat")
        .when(month.isin(3, 4, 10, 11), "Perfect Weather")
        .when(month.isin(1, 2, 12), "Snowbird Season")
        .otherwise("Transition")
    )


def add_seasons(df: DataFrame) -> DataFrame:
    """Month-driven flags; needs the ``month``, ``day`` and ``week`` columns of the time features."""
    month, day, week = F.col("month"), F.col("day"), F.col("week")
    temperatures = F.create_map(*[F.lit(v) for pair in MONTH_TEMPERATURE.items() for v in pair])
    temperature = F.element_at(temperatures, month)
    return df.withColumns(
        {
            "season": season(month),
            "is_extreme_heat": flag(month.isin(6, 7, 8, 9)),
            "is_perfect_weather": flag(month.isin(3, 4, 10, 11)),
            "is_snowbird_season": flag(month.isin(1, 2, 12)),
            "is_monsoon_season": flag(month.isin(7, 8)),
            "is_spring_training": flag((month == 3) | ((month == 2) & (day >= 15))),
            "is_golf_open": flag((month == 2) & (week == 5)),
            "avg_temp_estimate": temperature,
            "is_too_hot": flag(temperature >= 100),
            "is_summer_break": flag(month.between(6, 7)),
            "is_winter_break": flag((month == 12) & (day >= 20)),
            # ISO week 2 never falls in March: the column is constantly 0 and kept for its place in the layout
            "is_spring_break": flag((month == 3) & (week == 2)),
        }
    )
