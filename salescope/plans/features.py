"""Feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescope.functions import items, seasons, times
from salescope.functions.chain import add_all_features, by_prefix
from salescope.learn.models import impute_exact
from salescope.operators.ordered import quantiles
from salescope.operators.totals import daily_sales, keep
from salescope.plans.registry import MEAL, R, SALES, query, r, rounded, sql
from salescope.session import cut_lineage
from salescope.sources.views import item_sales, sales, table


def _dates(spark, d):
    """Distinct order dates with the number of lines; date features are computed once per date."""
    return sales(spark, d, "order_id", "order_date").groupBy("order_date").agg(F.count(F.lit(1)).alias("lines"))


DATES = "dates AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)"


@query(
    "date_parts",
    sql(DATES, select="""
        SELECT CAST(d AS VARCHAR) AS order_date, lines, year(d) AS year, month(d) AS month, day(d) AS day,
               isodow(d) - 1 AS dayofweek, dayname(d) AS day_name, weekofyear(d) AS week, quarter(d) AS quarter,
               CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend,
               CASE WHEN day(d) = 1 THEN 1 ELSE 0 END AS is_month_start,
               CASE WHEN d = last_day(d) THEN 1 ELSE 0 END AS is_month_end,
               least(abs(day(d) - 1), abs(day(d) - 15), abs(day(d) - 30)) AS days_from_payday,
               CASE WHEN least(abs(day(d) - 1), abs(day(d) - 15), abs(day(d) - 30)) <= 3 THEN 1 ELSE 0 END AS is_payday_week
        FROM dates"""),
)
def date_parts(spark, d):
    parts = times.add_time_parts(_dates(spark, d).withColumn("order_time", F.lit("00:00:00")))
    return rounded(parts.select("order_date", "lines", "year", "month", "day", "dayofweek", "day_name", "week", "quarter",
                                "is_weekend", "is_month_start", "is_month_end", "days_from_payday", "is_payday_week"))


@query(
    "clock_parts",
    sql(SALES, select=f"""
        SELECT hour, {MEAL} AS meal_period, CASE WHEN hour BETWEEN 9 AND 17 THEN 1 ELSE 0 END AS is_business_hours,
               count(*) AS lines FROM sales GROUP BY 1, 2, 3"""),
)
def clock_parts(spark, d):
    hour = times.clock_hour(F.col("order_time"))
    return sales(spark, d, "order_time").groupBy(
        hour.alias("hour"), times.meal_period(hour).alias("meal_period"), times.flag(hour.between(9, 17)).alias("is_business_hours")
    ).agg(F.count(F.lit(1)).alias("lines"))


def _cycle_sql(name: str, expr: str, period: int) -> str:
    angle = f"(({expr}) * (2 * pi()) / {period})"
    return f"{R(f'sin({angle})')} AS {name}_sin, {R(f'cos({angle})')} AS {name}_cos"


@query(
    "date_cycles",
    sql(DATES, select=f"""
        SELECT CAST(d AS VARCHAR) AS order_date, {_cycle_sql('dayofweek', 'isodow(d) - 1', 7)}, {_cycle_sql('day', 'day(d)', 30)},
               {_cycle_sql('month', 'month(d)', 12)}, {_cycle_sql('week', 'weekofyear(d)', 52)} FROM dates"""),
)
def date_cycles(spark, d):
    parts = times.add_time_parts(_dates(spark, d).withColumn("order_time", F.lit("00:00:00")))
    cycles = {k: v for k, v in times.CYCLES.items() if k != "hour"}
    out = times.add_cycles(parts, cycles)
    return rounded(out.select("order_date", *[f"{c}_{f}" for c in cycles for f in ("sin", "cos")]))


@query(
    "hour_cycles",
    sql(SALES, select=f"SELECT hour, {_cycle_sql('hour', 'hour', 24)}, count(*) AS lines FROM sales GROUP BY hour"),
)
def hour_cycles(spark, d):
    by_hour = sales(spark, d, "order_time").groupBy(times.clock_hour(F.col("order_time")).alias("hour")).agg(
        F.count(F.lit(1)).alias("lines")
    )
    return rounded(times.add_cycles(by_hour, {"hour": 24}))


@query(
    "order_moments",
    sql(SALES, select="""
        SELECT category, strftime(min(order_date + CAST(order_time AS TIME)), '%Y-%m-%d %H:%M:%S') AS first_moment,
               strftime(max(order_date + CAST(order_time AS TIME)), '%Y-%m-%d %H:%M:%S') AS last_moment FROM sales GROUP BY category"""),
)
def order_moments(spark, d):
    at = times.moment(F.col("order_date"), F.col("order_time"))
    return sales(spark, d, "order_date", "order_time", "category").groupBy("category").agg(
        F.date_format(F.min(at), "yyyy-MM-dd HH:mm:ss").alias("first_moment"),
        F.date_format(F.max(at), "yyyy-MM-dd HH:mm:ss").alias("last_moment"),
    )


def _nth(month: int, dow: int, n: int) -> str:
    if n > 0:
        first = f"make_date(y, {month}, 1)"
        return f"CAST({first} + CAST((({dow} - isodow({first}) + 7) % 7 + {7 * (n - 1)}) AS INTEGER) AS DATE)"
    last = f"last_day(make_date(y, {month}, 1))"
    return f"CAST({last} - CAST(((isodow({last}) - {dow} + 7) % 7) AS INTEGER) AS DATE)"


def _holiday_sql() -> str:
    parts = []
    text = lambda s: s.replace("'", "''")
    for name, month, weekday, n, since in seasons.WEEKDAY_HOLIDAYS:
        parts.append(f"SELECT {_nth(month, weekday + 1, n)} AS h, '{text(name)}' AS name FROM years WHERE y >= {since}")
    for name, month, day, since in seasons.DATE_HOLIDAYS:
        on = f"make_date(y, {month}, {day})"
        parts.append(f"SELECT {on}, '{text(name)}' FROM years WHERE y >= {since}")
        parts.append(
            f"SELECT CAST(CASE WHEN isodow({on}) = 6 THEN {on} - 1 ELSE {on} + 1 END AS DATE), '{text(name)} (observed)' "
            f"FROM years WHERE y >= {since} AND isodow({on}) >= 6"
        )
    return (
        "years AS (SELECT CAST(unnest(generate_series((SELECT min(year(d)) FROM dates), (SELECT max(year(d)) + 1 FROM dates))) AS INTEGER) AS y), "
        f"holidays AS ({' UNION ALL '.join(parts)})"
    )


@query(
    "holiday_features",
    sql(DATES, _holiday_sql(), select="""
        SELECT CAST(d AS VARCHAR) AS order_date, lines,
               CASE WHEN EXISTS (SELECT 1 FROM holidays WHERE h = d) THEN 1 ELSE 0 END AS is_holiday,
               coalesce((SELECT min(name) FROM holidays WHERE h = d), 'None') AS holiday_name,
               coalesce((SELECT min(date_diff('day', d, h)) FROM holidays WHERE h >= d AND year(h) = year(d)), 30) AS days_to_holiday
        FROM dates"""),
)
def holiday_features(spark, d):
    return rounded(seasons.add_holidays(_dates(spark, d)))


@query(
    "season_features",
    sql(DATES, select="""
        SELECT CAST(d AS VARCHAR) AS order_date,
               CASE WHEN month(d) IN (6,7,8,9) THEN 'Extreme Heat' WHEN month(d) IN (3,4,10,11) THEN 'Perfect Weather'
                    WHEN month(d) IN (1,2,12) THEN 'Snowbird Season' ELSE 'Transition' END AS season,
               CASE WHEN month(d) IN (6,7,8,9) THEN 1 ELSE 0 END AS is_extreme_heat,
               CASE WHEN month(d) IN (3,4,10,11) THEN 1 ELSE 0 END AS is_perfect_weather,
               CASE WHEN month(d) IN (1,2,12) THEN 1 ELSE 0 END AS is_snowbird_season,
               CASE WHEN month(d) IN (7,8) THEN 1 ELSE 0 END AS is_monsoon_season,
               CASE WHEN month(d) = 3 OR (month(d) = 2 AND day(d) >= 15) THEN 1 ELSE 0 END AS is_spring_training,
               CASE WHEN month(d) = 2 AND weekofyear(d) = 5 THEN 1 ELSE 0 END AS is_golf_open,
               [65,70,75,85,95,105,106,105,100,88,75,65][month(d)] AS avg_temp_estimate,
               CASE WHEN [65,70,75,85,95,105,106,105,100,88,75,65][month(d)] >= 100 THEN 1 ELSE 0 END AS is_too_hot,
               CASE WHEN month(d) IN (6,7) THEN 1 ELSE 0 END AS is_summer_break,
               CASE WHEN month(d) = 12 AND day(d) >= 20 THEN 1 ELSE 0 END AS is_winter_break,
               0 AS is_spring_break
        FROM dates"""),
)
def season_features(spark, d):
    parts = times.add_time_parts(_dates(spark, d).withColumn("order_time", F.lit("00:00:00")))
    return rounded(seasons.add_seasons(parts.select("order_date", "month", "day", "week")).drop("month", "day", "week"))


ORDER_VALUE = """CASE WHEN total_price <= 0 THEN NULL WHEN total_price <= 15 THEN 'Small' WHEN total_price <= 30 THEN 'Medium'
  WHEN total_price <= 50 THEN 'Large' WHEN total_price <= 100 THEN 'XLarge' WHEN total_price <= 1000 THEN 'Bulk' END"""
SIZE_CASE = "CASE item_size WHEN 'S' THEN 1 WHEN 'M' THEN 2 WHEN 'L' THEN 3 WHEN 'XL' THEN 4 WHEN 'XXL' THEN 5 END"


@query(
    "line_value_features",
    sql(SALES, f"t AS (SELECT *, {SIZE_CASE} AS size_numeric, CASE WHEN quantity >= 3 THEN 1 ELSE 0 END AS is_bulk_order, "
        f"coalesce({ORDER_VALUE.replace('total_price', '(total_price / 100)')}, 'None') AS order_value FROM sales)", select=f"""
        SELECT size_numeric, is_bulk_order, order_value, count(*) AS lines, {R('sum(total_price / quantity)', 4)} AS price_sum
        FROM t GROUP BY 1, 2, 3"""),
)
def line_value_features(spark, d):
    lines = sales(spark, d, "quantity", "total_price", "item_size")
    # the sample prices are about a hundred times those the bins are made for
    return lines.groupBy(
        items.size_rank(F.col("item_size")).alias("size_numeric"), times.flag(F.col("quantity") >= 3).alias("is_bulk_order"),
        F.coalesce(items.order_value(F.col("total_price") / 100), F.lit("None")).alias("order_value"),
    ).agg(
        F.count(F.lit(1)).alias("lines"),
        r(F.sum(items.price_per_unit(F.col("total_price"), F.col("quantity"))), 4).alias("price_sum"),
    )


KINDS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "category_one_hot",
    sql(SALES, select="SELECT item_size, " + ", ".join(
        f"CAST(sum(CASE WHEN category = '{k}' THEN 1 ELSE 0 END) AS BIGINT) AS \"category_{k}\"" for k in KINDS) + " FROM sales GROUP BY item_size"),
)
def category_one_hot(spark, d):
    wide = items.one_hot(sales(spark, d, "item_size", "category"), "category", "category",
                         items.levels(table(spark, d, "part"), "p_type"))
    return wide.groupBy("item_size").agg(*[F.sum(c).alias(c) for c in by_prefix(wide.columns, ["category_"])])


@query(
    "label_codes",
    sql(SALES, select="SELECT category, CAST(dense_rank() OVER (ORDER BY category) - 1 AS INTEGER) AS code, count(*) AS lines FROM sales GROUP BY category"),
)
def label_codes(spark, d):
    counted = cut_lineage(item_sales(spark, d, "category").groupBy("category").agg(F.sum("lines").alias("lines")))
    return items.add_label_code(counted, "category", "code")


EDGES = "e AS (SELECT quantile_cont(unit_price, [0.25, 0.5, 0.75]) AS q FROM sales)"


@query(
    "price_buckets",
    sql(SALES, EDGES, "t AS (SELECT *, CASE WHEN unit_price <= q[1] THEN 'Budget' WHEN unit_price <= q[2] THEN 'Standard' "
        "WHEN unit_price <= q[3] THEN 'Premium' ELSE 'Luxury' END AS price_bucket FROM sales, e)", select=f"""
        SELECT price_bucket, count(*) AS lines, {R('min(unit_price)')} AS low, {R('max(unit_price)')} AS high,
               {R('avg(unit_price)', 4)} AS mean_price FROM t GROUP BY 1"""),
)
def price_buckets(spark, d):
    lines = items.add_price_bucket(sales(spark, d, "unit_price"))
    return lines.groupBy("price_bucket").agg(
        F.count(F.lit(1)).alias("lines"), r(F.min("unit_price")).alias("low"), r(F.max("unit_price")).alias("high"),
        r(F.avg("unit_price"), 4).alias("mean_price"),
    )


@query(
    "price_quantiles",
    sql(SALES, "e AS (SELECT quantile_cont(unit_price, [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]) AS q FROM sales)",
        select="SELECT " + ", ".join(f"{R(f'q[{i + 1}]')} AS p{p}" for i, p in enumerate((0, 10, 25, 50, 75, 90, 100))) + " FROM e"),
)
def price_quantiles(spark, d):
    steps = (0, 10, 25, 50, 75, 90, 100)
    got = quantiles(sales(spark, d, "unit_price"), "unit_price", [p / 100 for p in steps])
    return got.select(*[r(F.col("q")[i]).alias(f"p{p}") for i, p in enumerate(steps)])


@query(
    "ingredient_counts",
    """WITH t AS (SELECT CASE WHEN p_size % 9 = 0 THEN NULL ELSE p_name || ' ' || p_type END AS words FROM part),
         u AS (SELECT CASE WHEN words IS NULL THEN 0 ELSE len(string_split(replace(words, ' ', ', '), ',')) END AS ingredient_count FROM t)
       SELECT CAST(ingredient_count AS INTEGER) AS ingredient_count, CASE WHEN ingredient_count >= 3 THEN 1 ELSE 0 END AS is_complex,
              count(*) AS items FROM u GROUP BY 1, 2""",
)
def ingredient_counts(spark, d):
    text = F.when(F.col("p_size") % 9 != 0, F.replace(F.concat_ws(" ", "p_name", "p_type"), F.lit(" "), F.lit(", ")))
    n = items.ingredient_count(text)
    return table(spark, d, "part").groupBy(n.alias("ingredient_count"), times.flag(n >= 3).alias("is_complex")).agg(
        F.count(F.lit(1)).alias("items")
    )


@query(
    "ingredient_vocabulary",
    sql(SALES, select="SELECT DISTINCT trim(unnest(string_split(ingredients, ','))) AS ingredient FROM sales"),
)
def ingredient_vocabulary(spark, d):
    return items.vocabulary(sales(spark, d, "ingredients"))


@query(
    "ingredient_flags",
    sql(SALES, select="""
        SELECT item_name, CASE WHEN contains(ingredients, 'bolt') THEN 1 ELSE 0 END AS has_bolt,
               CASE WHEN contains(ingredients, 'Red') THEN 1 ELSE 0 END AS has_red,
               CASE WHEN regexp_matches(ingredients, '(?i)GEAR|rod') THEN 0 ELSE 1 END AS is_vegetarian,
               CASE WHEN regexp_matches(ingredients, '(?i)GEAR|rod') THEN 1 ELSE 0 END AS has_meat,
               CASE WHEN regexp_matches(ingredients, '(?i)plate') THEN 1 ELSE 0 END AS has_seafood,
               CASE WHEN regexp_matches(ingredients, '(?i)Widget|ring') THEN 1 ELSE 0 END AS has_cheese,
               count(*) AS lines FROM sales GROUP BY ALL"""),
)
def ingredient_flags(spark, d):
    by_item = sales(spark, d, "item_name", "ingredients").groupBy("item_name", "ingredients").agg(F.count(F.lit(1)).alias("lines"))
    return items.add_ingredient_features(by_item, ["bolt", "Red"], "GEAR|rod", "plate", "Widget|ring").drop("ingredients")


@query(
    "feature_chain",
    sql(SALES, EDGES, f"""
        t AS (SELECT CASE WHEN month(order_date) IN (6,7,8,9) THEN 'Extreme Heat' WHEN month(order_date) IN (3,4,10,11) THEN 'Perfect Weather'
                     ELSE CASE WHEN month(order_date) IN (1,2,12) THEN 'Snowbird Season' ELSE 'Transition' END END AS season,
              {MEAL} AS meal_period, CASE WHEN unit_price <= q[1] THEN 'Budget' WHEN unit_price <= q[2] THEN 'Standard'
                WHEN unit_price <= q[3] THEN 'Premium' ELSE 'Luxury' END AS price_bucket,
              CASE WHEN isodow(order_date) >= 6 THEN 1 ELSE 0 END AS is_weekend, {SIZE_CASE} AS size_numeric,
              CASE WHEN category = 'PROMO' THEN 1 ELSE 0 END AS promo, sin(2 * pi() * hour / 24) AS s, total_price
              FROM sales, e)""", select=f"""
        SELECT season, meal_period, price_bucket, is_weekend, count(*) AS lines, {R('sum(total_price)', 2)} AS revenue,
               CAST(sum(size_numeric) AS BIGINT) AS size_sum, CAST(sum(promo) AS BIGINT) AS promo_lines, {R('sum(s)', 4)} AS hour_sin_sum
        FROM t GROUP BY 1, 2, 3, 4"""),
)
def feature_chain(spark, d):
    full = add_all_features(sales(spark, d), items.levels(table(spark, d, "part"), "p_type"), sales(spark, d, "unit_price"))
    return full.groupBy("season", "meal_period", "price_bucket", "is_weekend").agg(
        F.count(F.lit(1)).alias("lines"), r(F.sum("total_price"), 2).alias("revenue"),
        F.sum("size_numeric").cast("long").alias("size_sum"), F.sum("category_PROMO").alias("promo_lines"),
        r(F.sum("hour_sin"), 4).alias("hour_sin_sum"),
    )


@query(
    "tidy_names",
    sql(SALES, select="""
        SELECT item_name, replace(item_name, 'red ', '') AS short_name, substr(ingredients, 1, 8) || '...' AS clipped,
               count(*) AS lines FROM sales GROUP BY 1, 2, 3"""),
)
def tidy_names(spark, d):
    return sales(spark, d, "item_name", "ingredients").groupBy(
        "item_name", items.short_name(F.col("item_name"), "red ").alias("short_name"),
        items.clipped(F.col("ingredients"), 8).alias("clipped"),
    ).agg(F.count(F.lit(1)).alias("lines"))


@query(
    "filtered_daily_sales",
    sql(SALES, select=f"""
        SELECT CAST(order_date AS VARCHAR) AS order_date, {R('sum(total_price)', 2)} AS revenue, sum(quantity) AS units,
               count(DISTINCT order_id) AS num_orders FROM sales WHERE category = 'PROMO' GROUP BY order_date"""),
)
def filtered_daily_sales(spark, d):
    lines = sales(spark, d, "order_id", "order_date", "total_price", "quantity", "category", "item_size")
    return rounded(daily_sales(keep(lines, category="PROMO", item_size="All")), 2)


@query(
    "member_filter",
    sql(SALES, select=f"""
        SELECT item_size AS size, category AS kind, {R('avg(unit_price)', 4)} AS mean_price FROM sales
        WHERE category IN ('PROMO', 'SMALL') AND item_size <> 'XXL' AND quantity >= 10 GROUP BY 1, 2"""),
)
def member_filter(spark, d):
    lines = sales(spark, d, "category", "item_size", "quantity", "unit_price")
    kept = lines.where(F.col("category").isin("PROMO", "SMALL")).where(F.col("item_size") != "XXL").where(F.col("quantity") >= 10)
    named = kept.withColumnsRenamed({"item_size": "size", "category": "kind"})
    return named.groupBy("size", "kind").agg(r(F.avg("unit_price"), 4).alias("mean_price"))


@query(
    "prefixed_columns",
    sql(SALES, select="""
        SELECT category, CAST(sum(CASE WHEN item_size = 'S' THEN 1 ELSE 0 END + 2 * CASE WHEN item_size = 'L' THEN 1 ELSE 0 END) AS BIGINT) AS picked
        FROM sales GROUP BY category"""),
)
def prefixed_columns(spark, d):
    wide = items.one_hot(sales(spark, d, "category", "item_size"), "item_size", "Size", ["S", "M", "L"])
    chosen = by_prefix(wide.columns, ["Size_", "Size_L"], ["category", "absent"])
    weights = {"Size_S": 1, "Size_M": 0, "Size_L": 2}
    return wide.select(*chosen).groupBy("category").agg(
        F.sum(sum((F.col(c) * weights[c] for c in chosen if c in weights), F.lit(0))).alias("picked")
    )


@query(
    "median_imputation",
    sql(SALES, "t AS (SELECT category, CASE WHEN quantity > 5 THEN unit_price END AS price, CASE WHEN quantity > 10 THEN 1 END AS hot FROM sales)",
        "m AS (SELECT median(price) AS med FROM t)", select=f"""
        SELECT category, {R('avg(coalesce(price, med))', 4)} AS mean_price, CAST(sum(coalesce(hot, 0)) AS BIGINT) AS hot_lines FROM t, m GROUP BY 1"""),
)
def median_imputation(spark, d):
    lines = sales(spark, d, "category", "quantity", "unit_price")
    holed = lines.select(
        "category", F.when(F.col("quantity") > 5, F.col("unit_price")).alias("price"), F.when(F.col("quantity") > 10, 1).alias("hot")
    )
    return impute_exact(holed, ["price"], ["hot"]).groupBy("category").agg(
        r(F.avg("price"), 4).alias("mean_price"), F.sum("hot").alias("hot_lines")
    )
