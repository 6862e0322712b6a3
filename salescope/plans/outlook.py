"""Forecast, staffing, pareto and quadrant queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescope.operators import outlook
from salescope.operators.ordered import one_row
from salescope.operators.totals import date_hour_cells, value_counts, weekday_hour_means_of_cells
from salescope.plans.demand import daily
from salescope.plans.registry import CELLS, DAILY, IDENTITY, PRODUCTS, R, SALES, query, r, rounded, sql
from salescope.plans.totals import identity, item_base, products, sales_cells
from salescope.session import cut_lineage
from salescope.sources.views import event_lines, item_sales, sales, table

TREND = """
trend AS (
  SELECT f.m AS first_mean, l.m AS last_mean, (l.m - f.m) / f.m AS growth, (SELECT avg(revenue) FROM daily) AS mean
  FROM (SELECT avg(revenue) AS m FROM (SELECT revenue FROM daily ORDER BY order_date LIMIT 7)) f,
       (SELECT avg(revenue) AS m FROM (SELECT revenue FROM daily ORDER BY order_date DESC LIMIT 7)) l)"""
RECENT = """
recent AS (
  SELECT avg(revenue) AS revenue, avg(units) AS units, stddev_samp(revenue) AS std
  FROM (SELECT * FROM daily ORDER BY order_date DESC LIMIT 14))"""


def forecast_cte(days: int) -> str:
    return f"""
forecast AS (
  SELECT f.d AS order_date, dayname(f.d) AS day_name, w.m * (1 + t.growth) AS predicted_revenue,
         w.m / (r.revenue / r.units) * (1 + t.growth) AS predicted_units, w.m * (1 + t.growth) - r.std AS low, w.m * (1 + t.growth) + r.std AS high
  FROM (SELECT CAST((SELECT max(order_date) FROM daily) + CAST(i AS INTEGER) AS DATE) AS d FROM range(1, {days + 1}) x(i)) f
  LEFT JOIN (SELECT isodow(order_date) AS wd, avg(revenue) AS m FROM daily GROUP BY 1) w ON w.wd = isodow(f.d), trend t, recent r)"""


@query(
    "week_trend",
    sql(SALES, DAILY, TREND, select=f"SELECT {R('first_mean', 4)} AS first_mean, {R('last_mean', 4)} AS last_mean, {R('mean', 4)} AS mean, {R('growth', 8)} AS growth FROM trend"),
)
def week_trend(spark, d):
    got = outlook.week_growth(daily(spark, d))
    return got.select(*[r(c, 8 if c == "growth" else 4).alias(c) for c in got.columns])


@query(
    "future_days",
    """SELECT CAST(CAST((SELECT max(CAST(o_orderdate AS DATE)) FROM orders) + CAST(i AS INTEGER) AS DATE) AS VARCHAR) AS order_date
       FROM range(1, 31) t(i)""",
)
def future_days(spark, d):
    days = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("order_date"))
    return rounded(outlook.future_days(days, 30))



@query(
    "weekday_forecast",
    sql(SALES, DAILY, TREND, RECENT, forecast_cte(14), select=f"""
        SELECT CAST(order_date AS VARCHAR) AS order_date, day_name, {R('predicted_revenue', 4)} AS predicted_revenue,
               {R('predicted_units', 4)} AS predicted_units, {R('low', 4)} AS low, {R('high', 4)} AS high FROM forecast"""),
)
def weekday_forecast(spark, d):
    return rounded(outlook.weekday_forecast(daily(spark, d), 14), 4)


@query(
    "forecast_summary",
    sql(SALES, DAILY, TREND, RECENT, forecast_cte(7), select=f"""
        SELECT {R('sum(predicted_revenue)', 2)} AS total_revenue, {R('avg(predicted_revenue)', 2)} AS mean_revenue,
               {R('(SELECT last_mean * 7 FROM trend)', 2)} AS next_week, {R('(SELECT growth * 100 FROM trend)', 4)} AS trend_pct FROM forecast"""),
)
def forecast_summary(spark, d):
    days = daily(spark, d)
    got = outlook.forecast_summary(days, outlook.weekday_forecast(days, 7))
    return got.select(*[r(c, 4 if c == "trend_pct" else 2).alias(c) for c in got.columns])


WEEKS = """
weeks AS (SELECT isoyear(order_date) * 100 + weekofyear(order_date) AS iso_week, sum(revenue) AS v FROM daily GROUP BY 1),
numbered AS (SELECT *, row_number() OVER (ORDER BY iso_week DESC) AS r FROM weeks),
sums AS (SELECT count(*) AS weeks, sum(CASE WHEN r <= 4 THEN v END) / 4 AS recent, sum(CASE WHEN r BETWEEN 5 AND 8 THEN v END) / 4 AS previous FROM numbered),
growth AS (SELECT *, CASE WHEN weeks >= 8 THEN CASE WHEN previous > 0 THEN (recent - previous) / previous ELSE 0 END ELSE 0.05::DOUBLE END AS growth FROM sums)"""


@query(
    "weekly_growth",
    sql(SALES, DAILY, WEEKS, select=f"SELECT weeks, {R('recent', 2)} AS recent, {R('previous', 2)} AS previous, {R('growth', 8)} AS growth FROM growth"),
)
def weekly_growth(spark, d):
    got = outlook.weekly_growth(daily(spark, d))
    return got.select("weeks", r("recent", 2).alias("recent"), r("previous", 2).alias("previous"), r("growth", 8).alias("growth"))


PLAN = """
grown AS (SELECT day_name, hour, revenue * (1 + growth) AS predicted_revenue, units * (1 + growth) AS predicted_units FROM cells, growth),
plan AS (
  SELECT *, avg(predicted_revenue) OVER () AS cell_mean,
         CASE WHEN predicted_revenue > 1.3::DOUBLE * avg(predicted_revenue) OVER () THEN 8
              WHEN predicted_revenue < 0.7::DOUBLE * avg(predicted_revenue) OVER () THEN 3 ELSE 5 END AS predicted_staff FROM grown)
"""


def _plan(cells):
    cells = cut_lineage(cells)
    growth = one_row(outlook.weekly_growth(cells))["growth"]
    return outlook.staffing_plan(weekday_hour_means_of_cells(cells), growth), growth


def plan(spark, d):
    return _plan(sales_cells(spark, d))


@query(
    "staffing_plan",
    sql(SALES, DAILY, WEEKS, CELLS, PLAN, select=f"""
        SELECT day_name, hour, {R('predicted_revenue', 4)} AS predicted_revenue, {R('predicted_units', 4)} AS predicted_units, predicted_staff FROM plan"""),
)
def staffing_plan(spark, d):
    cells, _ = plan(spark, d)
    return rounded(cells.select("day_name", "hour", "predicted_revenue", "predicted_units", "predicted_staff"), 4)


# events differ more between hours than sales do, so all three staffing levels occur there
EVENT_CELLS = """
cells AS (
  SELECT dayname(ts) AS day_name, CAST(hour(ts) AS INTEGER) AS hour, avg(value) AS revenue, avg(1.0) AS units, count(*) AS lines FROM events GROUP BY 1, 2),
growth AS (SELECT 0.05::DOUBLE AS growth)"""


def event_plan(spark, d):
    """Five weeks of events are less than the eight the weekly growth needs, so its default applies."""
    return _plan(date_hour_cells(event_lines(spark, d).withColumnRenamed("date", "order_date")))


@query(
    "event_staffing_plan",
    sql(EVENT_CELLS, PLAN, select=f"SELECT day_name, hour, {R('predicted_revenue', 11)} AS predicted_revenue, predicted_staff FROM plan"),
)
def event_staffing_plan(spark, d):
    cells, _ = event_plan(spark, d)
    return rounded(cells.select("day_name", "hour", "predicted_revenue", "predicted_staff"), 11)


@query(
    "staffing_by_day",
    sql(EVENT_CELLS, PLAN, select=f"""
        SELECT day_name, CAST(sum(predicted_staff) AS BIGINT) AS staff_hours, {R('sum(predicted_revenue)', 9)} AS predicted_revenue,
               {R('sum(predicted_units)', 9)} AS predicted_units FROM plan GROUP BY 1"""),
)
def staffing_by_day(spark, d):
    return rounded(outlook.staffing_by_day(event_plan(spark, d)[0]), 9)


@query(
    "staffing_by_hour",
    sql(EVENT_CELLS, PLAN, "h AS (SELECT hour, avg(predicted_staff) AS s, avg(predicted_revenue) AS v, avg(predicted_units) AS u, max(cell_mean) AS m FROM plan GROUP BY 1)",
        select=f"""SELECT hour, {R('s')} AS mean_staff, {R('v', 9)} AS predicted_revenue, {R('u', 9)} AS predicted_units,
          CASE WHEN v > m * 1.3::DOUBLE THEN 'High Staffing' WHEN v < m * 0.7::DOUBLE THEN 'Low Staffing' ELSE 'Normal Staffing' END AS staff_level FROM h"""),
)
def staffing_by_hour(spark, d):
    got = outlook.staffing_by_hour(event_plan(spark, d)[0])
    return got.select("hour", r("mean_staff").alias("mean_staff"), r("predicted_revenue", 9).alias("predicted_revenue"),
                      r("predicted_units", 9).alias("predicted_units"), "staff_level")


@query(
    "staffing_budget",
    sql(SALES, DAILY, WEEKS, CELLS, PLAN, "byday AS (SELECT day_name, sum(predicted_staff) AS h, sum(predicted_revenue) AS v FROM plan GROUP BY 1)",
        select=f"""
        SELECT {R('sum(v) * 14 / 7', 4)} AS period_revenue, {R('sum(h) * 14 / 7', 4)} AS period_hours, {R('sum(h) * 14 / 7 * 15', 4)} AS labor_cost,
          (SELECT day_name FROM byday ORDER BY h DESC, day_name LIMIT 1) AS busiest_day,
          CAST(CASE WHEN max(growth) > 0 THEN trunc(sum(h) * max(growth) / 40) ELSE 0 END AS INTEGER) AS extra_people,
          CASE WHEN max(growth) > 0.1 THEN 'hire' WHEN max(growth) > -0.1 THEN 'maintain' ELSE 'reduce' END AS advice FROM byday, growth"""),
)
def staffing_budget(spark, d):
    cells, growth = plan(spark, d)
    return rounded(outlook.staffing_budget(cells, growth, 14), 4)


RANKED = """
ranked AS (
  SELECT *, row_number() OVER (ORDER BY revenue DESC, item_name) AS rank,
         sum(revenue) OVER (ORDER BY revenue DESC, item_name ROWS UNBOUNDED PRECEDING) AS running_revenue,
         sum(revenue) OVER () AS total FROM products)"""


@query(
    "pareto_table",
    sql(SALES, PRODUCTS, RANKED, select=f"""
        SELECT item_name, {R('revenue', 2)} AS revenue, units, rank, {R('running_revenue', 2)} AS running_revenue,
               {R('running_revenue / total * 100', 6)} AS cumulative_pct FROM ranked"""),
)
def pareto_table(spark, d):
    got = outlook.pareto(cut_lineage(products(item_sales(spark, d, "item_name")).select("item_name", "revenue", "units")))
    return got.select("item_name", r("revenue", 2).alias("revenue"), "units", "rank",
                      r("running_revenue", 2).alias("running_revenue"), r("cumulative_pct").alias("cumulative_pct"))


@query(
    "pareto_by_item_id",
    f"""WITH products AS (SELECT l_partkey AS item_name, sum(l_extendedprice) AS revenue FROM lineitem GROUP BY 1), {RANKED.strip()}
        SELECT item_name AS item_id, {R('revenue', 2)} AS revenue, rank, {R('running_revenue / total * 100', 6)} AS cumulative_pct FROM ranked""",
)
def pareto_by_item_id(spark, d):
    sold = sales(spark, d, "item_id", "total_price").groupBy("item_id").agg(F.sum("total_price").alias("revenue"))
    got = outlook.pareto(cut_lineage(sold), key="item_id")
    return got.select("item_id", r("revenue", 2).alias("revenue"), "rank", r("cumulative_pct").alias("cumulative_pct"))


@query(
    "pareto_head",
    sql(SALES, PRODUCTS, RANKED, select=f"""
        SELECT count(*) FILTER (running_revenue / total * 100 <= 80) AS head_products, count(*) AS products,
               {R('count(*) FILTER (running_revenue / total * 100 <= 80) / count(*)')} AS head_share FROM ranked"""),
)
def pareto_head(spark, d):
    return rounded(outlook.pareto_head(outlook.pareto(cut_lineage(products(item_sales(spark, d, "item_name")).select("item_name", "revenue")))))


QUADRANTS = """
pair AS (SELECT i.item_name, i.unit_price, coalesce(p.units, 0) AS units FROM identity i LEFT JOIN products p USING (item_name)),
quad AS (SELECT item_name, unit_price, units, unit_price > (SELECT median(unit_price) FROM pair) AS dear, units > (SELECT median(units) FROM pair) AS busy FROM pair),
named AS (SELECT *, CASE WHEN dear AND busy THEN 'Premium Star' WHEN busy THEN 'Value Star' WHEN dear THEN 'Premium Niche' ELSE 'Underperformer' END AS quadrant FROM quad)"""


def quadrants(spark, d):
    base = item_base(spark, d)
    both = identity(base).select("item_name", "unit_price").join(products(base).select("item_name", "units"), "item_name", "left")
    return outlook.quadrants(cut_lineage(both.fillna(0, ["units"])))


@query(
    "product_quadrants",
    sql(SALES, PRODUCTS, IDENTITY, QUADRANTS, select=f"SELECT item_name, {R('unit_price', 4)} AS unit_price, units, quadrant FROM named"),
)
def product_quadrants(spark, d):
    return rounded(quadrants(spark, d), 4)


@query("quadrant_counts", sql(SALES, PRODUCTS, IDENTITY, QUADRANTS, select="SELECT quadrant, count(*) AS rows FROM named GROUP BY 1"))
def quadrant_counts(spark, d):
    return value_counts(quadrants(spark, d), "quadrant")


@query(
    "bundle_scenarios",
    sql("o AS (SELECT count(DISTINCT l_orderkey) AS orders FROM lineitem)", select=f"""
        SELECT scenario, orders, {R('orders * a', 2)} AS bundle_orders, {R('orders * a * u', 2)} AS quarter_gain, {R('orders * a * u * 4', 2)} AS year_gain
        FROM o, (VALUES ('conservative', 0.1::DOUBLE, 5), ('moderate', 0.2::DOUBLE, 7), ('optimistic', 0.3::DOUBLE, 10)) s(scenario, a, u)"""),
)
def bundle_scenarios(spark, d):
    return rounded(outlook.bundle_scenarios(sales(spark, d, "order_id")), 2)
