"""Trend, seasonal forecast, staffing, pareto and quadrant views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from salescope.operators.ordered import one_row, running
from salescope.operators.series import head_rows, tail_rows
from salescope.operators.totals import median

HOURLY_WAGE = 15
ASSUMED_GROWTH = 0.05


def week_growth(daily: DataFrame, value: str = "revenue", days: int = 7) -> DataFrame:
    """Means of the first and last ``days`` rows and the relative growth between them, as one row."""
    first = head_rows(daily, "order_date", days).agg(F.avg(value).alias("m")).scalar()
    last = tail_rows(daily, "order_date", days).agg(F.avg(value).alias("m")).scalar()
    one = daily.agg(first.alias("first_mean"), last.alias("last_mean"), F.avg(value).alias("mean"))
    growth = F.try_divide(F.col("last_mean") - F.col("first_mean"), F.col("first_mean"))
    return one.withColumn("growth", growth)


def future_days(daily: DataFrame, days: int) -> DataFrame:
    """The ``days`` dates after the last one."""
    last = daily.agg(F.max("order_date").alias("last"))
    return last.select(
        F.explode(F.sequence(F.date_add("last", 1), F.date_add("last", days))).alias("order_date")
    )


def weekday_forecast(daily: DataFrame, days: int = 7, recent: int = 14) -> DataFrame:
    """Revenue and units for the coming days: weekday mean scaled by growth, with a one-deviation band."""
    growth = one_row(week_growth(daily))["growth"]
    last = one_row(
        tail_rows(daily, "order_date", recent).agg(
            F.avg("revenue").alias("revenue"), F.avg("units").alias("units"), F.stddev_samp("revenue").alias("std")
        )
    )
    by_weekday = daily.groupBy(F.weekday("order_date").alias("weekday")).agg(F.avg("revenue").alias("weekday_mean"))
    ahead = future_days(daily, days).withColumn("weekday", F.weekday("order_date"))
    # at most seven weekdays
    joined = ahead.join(F.broadcast(by_weekday), "weekday", "left")
    predicted = F.col("weekday_mean") * (1 + growth)
    return joined.select(
        "order_date",
        F.date_format("order_date", "EEEE").alias("day_name"),
        predicted.alias("predicted_revenue"),
        (F.col("weekday_mean") / (last["revenue"] / last["units"]) * (1 + growth)).alias("predicted_units"),
        (predicted - last["std"]).alias("low"),
        (predicted + last["std"]).alias("high"),
    )


def forecast_summary(daily: DataFrame, forecast: DataFrame) -> DataFrame:
    """Forecast total and mean, the plain next-week estimate and the trend in percent."""
    trend = one_row(week_growth(daily))
    return forecast.agg(
        F.sum("predicted_revenue").alias("total_revenue"),
        F.avg("predicted_revenue").alias("mean_revenue"),
        (trend["last_mean"] * 7).alias("next_week"),
        F.when(trend["first_mean"] > 0, trend["growth"] * 100).otherwise(0.0).alias("trend_pct"),
    )


def weekly_growth(daily: DataFrame, value: str = "revenue", weeks: int = 4) -> DataFrame:
    """Last ``weeks`` calendar weeks against the ``weeks`` before; a default when history is shorter.

    Weeks are ISO year and week together, so histories longer than a year compare the right weeks.
    """
    iso_year = F.year(F.date_add(F.date_trunc("week", "order_date").cast("date"), 3))
    weekly = daily.groupBy((iso_year * 100 + F.weekofyear("order_date")).alias("iso_week")).agg(
        F.sum(value).alias("v")
    )
    ranked = weekly.withColumn("r", F.row_number().over(W.orderBy(F.col("iso_week").desc())))
    sums = ranked.agg(
        F.count(F.lit(1)).alias("weeks"),
        (F.sum(F.when(F.col("r") <= weeks, F.col("v"))) / weeks).alias("recent"),
        (F.sum(F.when((F.col("r") > weeks) & (F.col("r") <= 2 * weeks), F.col("v"))) / weeks).alias("previous"),
    )
    growth = F.when(F.col("previous") > 0, (F.col("recent") - F.col("previous")) / F.col("previous")).otherwise(0.0)
    return sums.withColumn("growth", F.when(F.col("weeks") >= 2 * weeks, growth).otherwise(ASSUMED_GROWTH))


def staff_count(value: Column, mean: Column) -> Column:
    """8 people above 1.3 times the mean, 3 below 0.7 times, otherwise 5."""
    return F.when(value > mean * 1.3, 8).when(value < mean * 0.7, 3).otherwise(5)


def staff_label(value: Column, mean: Column) -> Column:
    return (
        F.when(value > mean * 1.3, "High Staffing").when(value < mean * 0.7, "Low Staffing").otherwise("Normal Staffing")
    )


def staffing_plan(cells: DataFrame, growth: Column) -> DataFrame:
    """Predicted revenue, units and staff for each weekday and hour; ``cells`` has at most 7 x 24 rows."""
    grown = cells.withColumns(
        {"predicted_revenue": F.col("revenue") * (1 + growth), "predicted_units": F.col("units") * (1 + growth)}
    )
    mean = F.avg("predicted_revenue").over(W.partitionBy())
    return grown.withColumns(
        {"predicted_staff": staff_count(F.col("predicted_revenue"), mean), "cell_mean": mean}
    )


def staffing_by_day(plan: DataFrame) -> DataFrame:
    return plan.groupBy("day_name").agg(
        F.sum("predicted_staff").alias("staff_hours"),
        F.sum("predicted_revenue").alias("predicted_revenue"),
        F.sum("predicted_units").alias("predicted_units"),
    )


def staffing_by_hour(plan: DataFrame) -> DataFrame:
    hourly = plan.groupBy("hour").agg(
        F.avg("predicted_staff").alias("mean_staff"),
        F.avg("predicted_revenue").alias("predicted_revenue"),
        F.avg("predicted_units").alias("predicted_units"),
        F.first("cell_mean").alias("cell_mean"),
    )
    return hourly.withColumn("staff_level", staff_label(F.col("predicted_revenue"), F.col("cell_mean"))).drop("cell_mean")


def staffing_budget(plan: DataFrame, growth: Column, days: int = 7) -> DataFrame:
    """Hours, wages, busiest day and extra people for a period of ``days`` days."""
    by_day = staffing_by_day(plan)
    week = by_day.agg(
        F.sum("predicted_revenue").alias("week_revenue"),
        F.sum("staff_hours").alias("week_hours"),
        F.min_by("day_name", F.struct(-F.col("staff_hours"), F.col("day_name"))).alias("busiest_day"),
        growth.alias("growth"),
    )
    scale = F.lit(days / 7.0)
    hours = F.col("week_hours") * scale
    extra = (F.col("week_hours") * F.col("growth") / 40).cast("int")
    advice = F.when(F.col("growth") > 0.1, "hire").when(F.col("growth") > -0.1, "maintain").otherwise("reduce")
    return week.select(
        (F.col("week_revenue") * scale).alias("period_revenue"),
        hours.alias("period_hours"),
        (hours * HOURLY_WAGE).alias("labor_cost"),
        "busiest_day",
        F.when(F.col("growth") > 0, extra).otherwise(0).alias("extra_people"),
        advice.alias("advice"),
    )


def demand_advice(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Staff, preparation, revenue and demand level for scored hours."""
    p = F.col(prediction)
    staff = F.greatest(F.lit(3), F.least(F.lit(10), (p / 8).cast("int") + 2))
    return scored.withColumns(
        {
            "staff_needed": staff,
            "prep_units": (p * 1.2).cast("int"),
            "revenue_estimate": p * 15,
            "demand_level": F.when(p > 40, "High").when(p > 25, "Moderate").otherwise("Low"),
        }
    )


def pareto(products: DataFrame, value: str = "revenue", key: str = "item_name") -> DataFrame:
    """Rank, running total and cumulative percent of products by falling revenue."""
    ranked = running(products, value, [value], descending=True, tie=[key], position="rank")
    whole = products.agg(F.sum(value).alias("t")).scalar()
    return ranked.withColumn("cumulative_pct", F.col(f"running_{value}") / whole * 100)


def pareto_head(ranked: DataFrame, percent: float = 80) -> DataFrame:
    """How many leading products stay within ``percent`` of revenue, and their share of all products."""
    return ranked.agg(
        F.count_if(F.col("cumulative_pct") <= percent).alias("head_products"), F.count(F.lit(1)).alias("products")
    ).withColumn("head_share", F.col("head_products") / F.col("products"))


def quadrants(products: DataFrame, price: str = "unit_price", units: str = "units") -> DataFrame:
    """Price and volume quadrant of each product against the medians (strictly above)."""
    dear = F.col(price) > median(products, price)
    busy = F.col(units) > median(products, units)
    return products.withColumn(
        "quadrant",
        F.when(dear & busy, "Premium Star").when(busy, "Value Star").when(dear, "Premium Niche").otherwise("Underperformer"),
    )


# Scenario, adoption rate, extra revenue per bundle.
BUNDLE_SCENARIOS = [("conservative", 0.10, 5.0), ("moderate", 0.20, 7.0), ("optimistic", 0.30, 10.0)]


def bundle_scenarios(lines: DataFrame, scenarios: Sequence[tuple[str, float, float]] = BUNDLE_SCENARIOS) -> DataFrame:
    """Quarterly and yearly gain per adoption scenario, scaled by the number of distinct orders."""
    orders = lines.agg(F.count_distinct("order_id").alias("orders"))
    options = F.array(
        *[F.struct(F.lit(s).alias("scenario"), F.lit(a).alias("adoption"), F.lit(u).alias("uplift")) for s, a, u in scenarios]
    )
    each = orders.select("orders", F.inline(options))
    bundles = F.col("orders") * F.col("adoption")
    return each.select(
        "scenario", "orders", bundles.alias("bundle_orders"),
        (bundles * F.col("uplift")).alias("quarter_gain"), (bundles * F.col("uplift") * 4).alias("year_gain"),
    )
