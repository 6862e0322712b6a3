"""Hourly demand features, forecasts and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescope.operators import series, totals
from salescope.operators.outlook import demand_advice
from salescope.plans.registry import DAILY, HOURLY, R, SALES, query, r, row_spread_sql, rounded, sql
from salescope.plans.profiles import SPLIT_CASE, SPLIT_KEYS
from salescope.session import cut_lineage
from salescope.sources.views import event_lines, order_sales, sales, table


def hourly(spark, d):
    return totals.hourly_demand(event_lines(spark, d))


LAGS = """
lags AS (
  SELECT *, lag(units) OVER (ORDER BY date, hour) AS prev_hour_units,
         lag(units) OVER (PARTITION BY hour ORDER BY date) AS same_hour_yesterday,
         avg(units) OVER (ORDER BY date, hour ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_3h_avg,
         avg(units) OVER (ORDER BY date, hour ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS rolling_24h_avg
  FROM hourly)"""


def _cycle(name: str, expr: str, period: int) -> str:
    angle = f"(({expr}) * (2 * pi()) / {period})"
    return f"{R(f'sin({angle})')} AS {name}_sin, {R(f'cos({angle})')} AS {name}_cos"


@query(
    "demand_features",
    sql(HOURLY, LAGS, select=f"""
        SELECT CAST(date AS VARCHAR) AS date, hour, units, num_orders, {R('revenue', 4)} AS revenue,
               isodow(date) - 1 AS day_of_week, month(date) AS month, day(date) AS day_of_month, weekofyear(date) AS week_of_year,
               CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend, {_cycle('hour', 'hour', 24)},
               {_cycle('day', 'isodow(date) - 1', 7)}, {_cycle('month', 'month(date)', 12)}, {_cycle('day_of_month', 'day(date)', 31)},
               prev_hour_units, same_hour_yesterday, {R('rolling_3h_avg')} AS rolling_3h_avg, {R('rolling_24h_avg')} AS rolling_24h_avg
        FROM lags WHERE prev_hour_units IS NOT NULL AND same_hour_yesterday IS NOT NULL"""),
)
def demand_features(spark, d):
    return rounded(series.demand_features(hourly(spark, d)).withColumn("revenue", F.round("revenue", 4)))


@query(
    "demand_lags_without_current",
    sql(HOURLY, select=f"""
        SELECT CAST(date AS VARCHAR) AS date, hour, units, lag(units) OVER (ORDER BY date, hour) AS prev_hour_units,
          {R('avg(units) OVER (ORDER BY date, hour ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)')} AS rolling_3h_avg,
          {R('avg(units) OVER (ORDER BY date, hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)')} AS rolling_24h_avg
        FROM hourly QUALIFY prev_hour_units IS NOT NULL"""),
)
def demand_lags_without_current(spark, d):
    lagged = series.add_lags(hourly(spark, d), include_current=False).dropna(subset=["prev_hour_units"])
    return rounded(lagged.select("date", "hour", "units", "prev_hour_units", "rolling_3h_avg", "rolling_24h_avg"))


@query(
    "demand_lags_by_type",
    sql("""h AS (SELECT CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour, event_type AS item_name, count(*) AS units FROM events GROUP BY 1, 2, 3)""",
        select=f"""
        SELECT item_name, CAST(date AS VARCHAR) AS date, hour, units,
          coalesce(lag(units) OVER (PARTITION BY item_name ORDER BY date, hour), 0) AS prev_hour_units,
          {R('avg(units) OVER (PARTITION BY item_name ORDER BY date, hour ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)')} AS rolling_3h_avg
        FROM h"""),
)
def demand_lags_by_type(spark, d):
    lagged = series.add_lags(totals.hourly_demand(event_lines(spark, d), ["item_name"]), keys=["item_name"])
    return rounded(lagged.fillna(0, ["prev_hour_units"]).select("item_name", "date", "hour", "units", "prev_hour_units", "rolling_3h_avg"))


def daily(spark, d):
    """Daily series, one row per calendar day; fixed in storage because forecasts read it several times."""
    return cut_lineage(totals.daily_sales_of_orders(order_sales(spark, d, "order_date")))


@query(
    "centred_week_mean",
    sql(SALES, DAILY, select=f"""
        SELECT CAST(order_date AS VARCHAR) AS order_date, {R('revenue', 2)} AS revenue,
          coalesce({R('''CASE WHEN count(*) OVER w = 7 THEN avg(revenue) OVER w END''', 4)}, -1) AS revenue_ma7
        FROM daily WINDOW w AS (ORDER BY order_date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)"""),
)
def centred_week_mean(spark, d):
    return daily(spark, d).select(
        F.col("order_date").cast("string").alias("order_date"), r("revenue", 2).alias("revenue"),
        F.coalesce(r(series.centred_mean("order_date", "revenue"), 4), F.lit(-1.0)).alias("revenue_ma7"),
    )


@query(
    "first_and_last_days",
    sql(SALES, DAILY, select=f"""
        (SELECT 'first' AS side, CAST(order_date AS VARCHAR) AS order_date, {R('revenue', 2)} AS revenue FROM daily ORDER BY daily.order_date LIMIT 7)
        UNION ALL (SELECT 'last', CAST(order_date AS VARCHAR), {R('revenue', 2)} FROM daily ORDER BY daily.order_date DESC LIMIT 14)"""),
)
def first_and_last_days(spark, d):
    days = daily(spark, d).select("order_date", "revenue")
    both = series.head_rows(days, "order_date", 7).select(F.lit("first").alias("side"), "*").unionByName(
        series.tail_rows(days, "order_date", 14).select(F.lit("last").alias("side"), "*")
    )
    return rounded(both, 2)


SPLIT = """
placed AS (SELECT *, row_number() OVER (ORDER BY date, hour) AS p, count(*) OVER () AS n FROM hourly),
split AS (SELECT *, CASE WHEN p <= floor(n * 0.7::DOUBLE) THEN 'train'
                         WHEN p <= floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM placed)"""


def split_hours(spark, d):
    return series.chronological_split(hourly(spark, d), ["date", "hour"])


@query(
    "chronological_split",
    sql(HOURLY, SPLIT, select="""
        SELECT split, count(*) AS hours, CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date,
               CAST(sum(units) AS BIGINT) AS units FROM split GROUP BY split"""),
)
def chronological_split(spark, d):
    return rounded(split_hours(spark, d).groupBy("split").agg(
        F.count(F.lit(1)).alias("hours"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.sum("units").alias("units")
    ))


@query(
    "simple_forecasts",
    sql(HOURLY, SPLIT, select=f"""
        SELECT (SELECT units FROM split WHERE split = 'train' ORDER BY date DESC, hour DESC LIMIT 1) AS last_value,
          {R("(SELECT avg(units) FROM (SELECT units FROM split WHERE split = 'train' ORDER BY date DESC, hour DESC LIMIT 7))")} AS moving_average,
          count(*) AS hours, {R("sqrt(avg(power(units - (SELECT units FROM split WHERE split = 'train' ORDER BY date DESC, hour DESC LIMIT 1), 2)))")} AS last_value_rmse
        FROM split WHERE split = 'test'"""),
)
def simple_forecasts(spark, d):
    hours = split_hours(spark, d)
    train, test = hours.where(F.col("split") == "train"), hours.where(F.col("split") == "test")
    last = series.last_value_forecast(train, ["date", "hour"], "units")
    mean = series.moving_average_forecast(train, ["date", "hour"], "units")
    scored = test.withColumns({"last_value": last, "moving_average": mean})
    return scored.groupBy("last_value", r("moving_average").alias("moving_average")).agg(
        F.count(F.lit(1)).alias("hours"), r(F.sqrt(F.avg(F.pow(F.col("units") - F.col("last_value"), 2)))).alias("last_value_rmse")
    )


@query(
    "demand_advice",
    sql(HOURLY, "p AS (SELECT date, hour, units * 1.5::DOUBLE AS prediction FROM hourly)", select=f"""
        SELECT CAST(date AS VARCHAR) AS date, hour, {R('prediction', 4)} AS prediction,
          greatest(3, least(10, CAST(floor(prediction / 8) AS INTEGER) + 2)) AS staff_needed,
          CAST(floor(prediction * 1.2::DOUBLE) AS INTEGER) AS prep_units, {R('prediction * 15', 4)} AS revenue_estimate,
          CASE WHEN prediction > 40 THEN 'High' WHEN prediction > 25 THEN 'Moderate' ELSE 'Low' END AS demand_level FROM p"""),
)
def demand_advice_query(spark, d):
    scored = hourly(spark, d).select("date", "hour", (F.col("units") * 1.5).alias("prediction"))
    return rounded(demand_advice(scored), 4)


@query(
    "random_split",
    sql(SALES, select=f"""
        SELECT {SPLIT_CASE} AS split, count(*) AS lines, {R('avg(total_price)', 4)} AS mean_price, min(total_price) AS low, max(total_price) AS high
        FROM sales GROUP BY 1"""),
)
def random_split(spark, d):
    split = series.random_split(sales(spark, d, *SPLIT_KEYS, "total_price"), SPLIT_KEYS)
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("lines"), r(F.avg("total_price"), 4).alias("mean_price"),
        F.min("total_price").alias("low"), F.max("total_price").alias("high"),
    )


@query(
    "split_statistics",
    sql(SALES, select=f"""
        SELECT {SPLIT_CASE} AS split, count(*) AS rows, {R('avg(quantity)')} AS mean, {R('stddev_samp(quantity)')} AS std,
          min(quantity) AS min, max(quantity) AS max, {R('median(quantity)')} AS median FROM sales GROUP BY 1"""),
)
def split_statistics(spark, d):
    split = series.random_split(sales(spark, d, *SPLIT_KEYS, "quantity"), SPLIT_KEYS)
    return rounded(totals.split_statistics(split, "quantity"))


@query(
    "ordered_split",
    sql(SALES, """p AS (SELECT *, row_number() OVER (ORDER BY order_date, order_id, line_no, item_id, quantity, total_price) - 1 AS p, count(*) OVER () AS n FROM sales)""",
        select=f"""SELECT CASE WHEN p < n - ceil(n * 0.2::DOUBLE) THEN 'train' ELSE 'test' END AS split, count(*) AS lines,
        CAST(min(order_date) AS VARCHAR) AS first_date, CAST(max(order_date) AS VARCHAR) AS last_date, {R('sum(total_price)', 2)} AS revenue FROM p GROUP BY 1"""),
)
def ordered_split(spark, d):
    columns = ["order_date", "order_id", "line_no", "item_id", "quantity", "total_price"]
    split = series.ordered_split(sales(spark, d, *columns), [F.col(c) for c in columns])
    return rounded(split.groupBy("split").agg(
        F.count(F.lit(1)).alias("lines"), F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date"),
        F.sum("total_price").alias("revenue"),
    ), 2)


@query(
    "stratified_split",
    sql(f"""h AS (SELECT o_orderstatus, o_orderkey, o_totalprice, {row_spread_sql('o_orderkey')} AS h FROM orders),
        c AS (SELECT o_orderstatus, count(*) AS n, floor(count(*) * 0.2::DOUBLE) AS low, round(count(*) * 0.2::DOUBLE - floor(count(*) * 0.2::DOUBLE), 9) AS rest FROM h GROUP BY 1),
        a AS (SELECT o_orderstatus, low + CASE WHEN row_number() OVER (ORDER BY rest DESC, n DESC, o_orderstatus)
                <= (SELECT ceil(sum(n) * 0.2::DOUBLE) - sum(low) FROM c) THEN 1 ELSE 0 END AS take FROM c),
        p AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY h, o_orderkey) AS p FROM h JOIN a USING (o_orderstatus))""",
        select=f"""SELECT o_orderstatus, CASE WHEN p <= take THEN 'test' ELSE 'train' END AS split, count(*) AS orders,
        {R('sum(o_totalprice)', 2)} AS total FROM p GROUP BY 1, 2"""),
)
def stratified_split(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    split = series.stratified_split(orders, "o_orderstatus", ["o_orderkey"])
    return split.groupBy("o_orderstatus", "split").agg(F.count(F.lit(1)).alias("orders"), r(F.sum("o_totalprice"), 2).alias("total"))


@query(
    "split_overlap",
    sql(SALES, f"s AS (SELECT order_id, {SPLIT_CASE} AS split FROM sales)",
        select="SELECT splits, count(*) AS orders FROM (SELECT order_id, count(DISTINCT split) AS splits FROM s GROUP BY 1) WHERE splits > 1 GROUP BY 1"),
)
def split_overlap(spark, d):
    split = series.random_split(sales(spark, d, *SPLIT_KEYS), SPLIT_KEYS)
    return series.shared_keys(split, ["order_id"]).groupBy("splits").agg(F.count(F.lit(1)).alias("orders"))
