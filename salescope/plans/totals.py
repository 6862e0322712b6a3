"""Total, ranking and join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescope.functions.items import add_label_code, ingredient_count
from salescope.functions.times import clock_hour
from salescope.operators import totals
from salescope.operators.ordered import first_row
from salescope.operators.series import best_rows, best_value
from salescope.plans.registry import CELLS, DAILY, HOURLY, IDENTITY, PRODUCTS, R, SALES, query, r, rounded, sql
from salescope.session import cut_lineage
from salescope.sources.views import ITEM, event_lines, item_sales, order_sales, sales, table


def item_base(spark, d):
    """Item subtotals with item attributes, read from the lines once and fixed for the summaries built on it."""
    return cut_lineage(item_sales(spark, d, "item_name", "item_size", "category", "ingredients"))


def products(base):
    return base.groupBy("item_name").agg(
        F.sum("total_price").alias("revenue"), F.sum("quantity").alias("units"), F.sum("lines").alias("lines"),
        F.sum("unit_price_sum").alias("unit_price_sum"),
    )


def identity(base):
    """Product identity from item subtotals; item attributes are constant per item id.

    The few cells are fixed, as the identity is made from them in three ways and each would read all items.
    """
    cells = base.groupBy("item_name", "item_size", "category").agg(
        F.sum("lines").alias("n"), F.sum("unit_price_sum").alias("price_sum"), F.sum("lines").alias("price_n"),
        F.min("ingredients").alias("ingredients"),
    )
    return totals.identity_from_cells(cut_lineage(cells), "item_name")


def segmented(spark, d):
    """Products with identity, totals and a cluster number (the category code less one, so the first one is noise)."""
    base = item_base(spark, d)
    described = cut_lineage(identity(base).withColumn("ingredient_count", ingredient_count(F.col("ingredients"))))
    coded = add_label_code(described, "category", "code").withColumn("cluster", (F.col("code") - 1).cast("int"))
    return cut_lineage(coded.join(products(base), "item_name", "left").fillna(0, ["revenue", "units"]))


def dated_cells(spark, d, *more):
    lines = sales(spark, d, "order_id", "order_date", "order_time", "total_price", "quantity", *more)
    return lines.withColumns({"day_name": F.date_format("order_date", "EEEE"), "hour": clock_hour(F.col("order_time"))})


def sales_cells(spark, d):
    """Revenue, units and lines by date and hour; the hour is a property of the order."""
    orders = order_sales(spark, d, "order_date", "order_time")
    return totals.date_hour_cells_of_orders(orders.withColumn("hour", clock_hour(F.col("order_time"))))


@query(
    "hourly_demand",
    sql(HOURLY, select=f"SELECT CAST(date AS VARCHAR) AS date, hour, units, num_orders, {R('revenue', 4)} AS revenue FROM hourly"),
)
def hourly_demand(spark, d):
    return rounded(totals.hourly_demand(event_lines(spark, d)), 4)


@query(
    "hourly_demand_by_type",
    f"""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, CAST(hour(ts) AS INTEGER) AS hour, event_type AS item_name, count(*) AS units,
        count(DISTINCT user_id) AS num_orders, {R('sum(value)', 4)} AS revenue FROM events GROUP BY 1, 2, 3""",
)
def hourly_demand_by_type(spark, d):
    return rounded(totals.hourly_demand(event_lines(spark, d), ["item_name"]), 4)


@query(
    "daily_sales",
    sql(SALES, DAILY, select=f"SELECT CAST(order_date AS VARCHAR) AS order_date, {R('revenue', 2)} AS revenue, units, num_orders FROM daily"),
)
def daily_sales(spark, d):
    return rounded(totals.daily_sales_of_orders(order_sales(spark, d, "order_date")), 2)


@query("product_sales", sql(SALES, PRODUCTS, select=f"SELECT item_name, {R('revenue', 2)} AS revenue, units FROM products"))
def product_sales(spark, d):
    return rounded(totals.product_sales(item_sales(spark, d, "item_name")), 2)


@query(
    "weekday_hour_means",
    sql(SALES, CELLS, select=f"SELECT day_name, hour, {R('revenue', 4)} AS revenue, {R('units', 4)} AS units, lines FROM cells"),
)
def weekday_hour_means(spark, d):
    return rounded(totals.weekday_hour_means_of_cells(sales_cells(spark, d)), 4)


LAST_WEEK = """
week AS (
  SELECT *, dayname(order_date) AS day_name FROM sales
  WHERE date_trunc('week', order_date) = (SELECT max(date_trunc('week', order_date)) FROM sales)),
week_cells AS (
  SELECT day_name, hour, sum(total_price) AS revenue, sum(quantity) AS units, count(DISTINCT order_id) AS num_orders
  FROM week GROUP BY 1, 2)"""


def last_week_cells(spark, d):
    newest = table(spark, d, "orders").agg(F.max(F.date_trunc("week", "o_orderdate")).cast("date").alias("w")).scalar()
    lines = dated_cells(spark, d).where((F.col("order_date") >= newest) & (F.col("order_date") < F.date_add(newest, 7)))
    return totals.weekday_hour_totals(lines)


@query(
    "line_means_by_type",
    f"""SELECT dayname(ts) AS day_name, CAST(hour(ts) AS INTEGER) AS hour, {R('avg(value)', 9)} AS revenue, 1.0::DOUBLE AS units, count(*) AS lines
        FROM events WHERE event_type = 'purchase' GROUP BY 1, 2""",
)
def line_means_by_type(spark, d):
    lines = totals.keep(event_lines(spark, d), item_name="purchase").withColumn("day_name", F.date_format("date", "EEEE"))
    return rounded(totals.weekday_hour_means(lines), 9)


@query(
    "last_week_cells",
    sql(SALES, LAST_WEEK, select=f"SELECT day_name, hour, {R('revenue', 2)} AS revenue, units, num_orders FROM week_cells"),
)
def last_week_cells_query(spark, d):
    return rounded(last_week_cells(spark, d), 2)


@query(
    "last_week_hour_means",
    sql(SALES, LAST_WEEK, select=f"""
        SELECT hour, {R('avg(revenue)', 4)} AS revenue, {R('avg(units)', 4)} AS units, {R('avg(num_orders)', 4)} AS num_orders
        FROM week_cells GROUP BY hour"""),
)
def last_week_hour_means(spark, d):
    return rounded(totals.hour_means(last_week_cells(spark, d), ["revenue", "units", "num_orders"]), 4)


@query(
    "headline_kpis",
    f"""SELECT {R('sum(l_extendedprice)', 2)} AS revenue, sum(l_quantity) AS units, count(DISTINCT l_orderkey) AS num_orders,
        count(DISTINCT l_partkey) AS items, {R('sum(l_extendedprice) / count(DISTINCT l_orderkey)', 4)} AS order_value FROM lineitem""",
)
def headline_kpis(spark, d):
    got = totals.headline(sales(spark, d, "order_id", "item_id", "total_price", "quantity"))
    return got.select(r("revenue", 2).alias("revenue"), "units", "num_orders", "items", r("order_value", 4).alias("order_value"))


@query(
    "product_identity",
    sql(SALES, IDENTITY, select=f"SELECT item_name, {R('unit_price', 4)} AS unit_price, item_size, category, ingredients FROM identity"),
)
def product_identity(spark, d):
    return rounded(identity(item_base(spark, d)), 4)


SEGMENTED = """
segmented AS (
  SELECT i.*, CAST(dense_rank() OVER (ORDER BY i.category) - 2 AS INTEGER) AS cluster,
         len(string_split(i.ingredients, ',')) AS ingredient_count, p.revenue, p.units
  FROM identity i LEFT JOIN products p USING (item_name)),
segments AS (
  SELECT cluster, count(*) AS products, round(avg(unit_price), 2) AS avg_price, round(sum(units), 2) AS total_units,
         round(sum(revenue), 2) AS total_revenue, round(avg(ingredient_count), 2) AS avg_ingredients
  FROM segmented GROUP BY cluster)"""


@query("segment_summary", sql(SALES, PRODUCTS, IDENTITY, SEGMENTED, select="SELECT * FROM segments"))
def segment_summary(spark, d):
    return totals.segment_summary(segmented(spark, d))


@query(
    "segment_names",
    sql(SALES, PRODUCTS, IDENTITY, SEGMENTED, select="""
        SELECT cluster, products, CASE WHEN avg_price > 2900 THEN 'Premium' WHEN avg_price > 2700 THEN 'Mid-Range' ELSE 'Value' END
          || ' ' || CASE WHEN avg_ingredients > 1.5 THEN 'Gourmet' ELSE 'Classic' END
          || ' (' || CASE WHEN total_units > (SELECT median(total_units) FROM segments) THEN 'High-Volume' ELSE 'Specialty' END || ')' AS segment
        FROM segments"""),
)
def segment_names(spark, d):
    segments = cut_lineage(totals.segment_summary(segmented(spark, d)))
    named = totals.name_segments(segments, premium=2900, mid=2700, gourmet=1.5)
    return named.select("cluster", "products", "segment")


@query(
    "cluster_overview",
    sql(SALES, PRODUCTS, IDENTITY, SEGMENTED, select="""
        SELECT cluster, (SELECT string_agg(item_name, ', ' ORDER BY item_name) FROM
                 (SELECT item_name FROM segmented s WHERE s.cluster = g.cluster ORDER BY item_name LIMIT 5))
               || CASE WHEN count(*) > 5 THEN '...' ELSE '' END AS items,
               count(*) AS products, round(avg(unit_price), 2) AS avg_price, round(sum(units), 2) AS units, round(sum(revenue), 2) AS revenue
        FROM segmented g GROUP BY cluster"""),
)
def cluster_overview(spark, d):
    return totals.cluster_overview(segmented(spark, d))


@query(
    "noise_revenue",
    sql(SALES, PRODUCTS, IDENTITY, SEGMENTED, select=f"""
        SELECT count(DISTINCT CASE WHEN cluster <> -1 THEN cluster END) AS core_clusters,
               count(*) FILTER (cluster = -1) AS outliers, {R('coalesce(sum(CASE WHEN cluster = -1 THEN revenue END), 0)', 2)} AS outlier_revenue
        FROM segmented"""),
)
def noise_revenue(spark, d):
    noise = F.col("cluster") == -1
    return segmented(spark, d).agg(
        F.count_distinct(F.when(~noise, F.col("cluster"))).alias("core_clusters"), F.count_if(noise).alias("outliers"),
        r(F.coalesce(F.sum(F.when(noise, F.col("revenue"))), F.lit(0.0)), 2).alias("outlier_revenue"),
    )


HOURS = list(range(24))


@query(
    "revenue_heatmap",
    sql(SALES, CELLS, select="SELECT CAST(isodow(min(order_date)) - 1 AS INTEGER) AS day_order, dayname(order_date) AS day_name, " + ", ".join(
        f"{R(f'coalesce(avg(CASE WHEN hour = {h} THEN total_price END), 0)', 4)} AS h{h}" for h in HOURS) + " FROM sales GROUP BY dayname(order_date)"),
)
def revenue_heatmap(spark, d):
    return rounded(totals.heatmap(totals.weekday_hour_means_of_cells(sales_cells(spark, d)), "revenue", HOURS), 4)


@query(
    "category_share",
    sql(SALES, select=f"""
        SELECT category, CAST(dense_rank() OVER (ORDER BY category) - 1 AS INTEGER) AS code, {R('sum(total_price)', 2)} AS total_price,
               {R('sum(total_price) / (SELECT sum(total_price) FROM sales)', 6)} AS share FROM sales GROUP BY category"""),
)
def category_share(spark, d):
    shares = cut_lineage(totals.share_of_total(item_sales(spark, d, "category"), "category", "total_price"))
    coded = add_label_code(shares, "category", "code")
    return coded.select("category", "code", r("total_price", 2).alias("total_price"), r("share").alias("share"))


@query(
    "price_histogram",
    """WITH e AS (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi, (max(p_retailprice) - min(p_retailprice)) / 20 AS w FROM part)
       SELECT CAST(least(floor((p_retailprice - lo) / w), 19) AS INTEGER) AS bin, round(min(lo) + min(w) *
              CAST(least(floor((p_retailprice - lo) / w), 19) AS INTEGER), 6) + 0.0 AS bin_start, count(*) AS rows FROM part, e GROUP BY 1""",
)
def price_histogram(spark, d):
    return rounded(totals.histogram(table(spark, d, "part"), "p_retailprice"))


@query(
    "peak_hours",
    sql(SALES, LAST_WEEK, select=f"""
        SELECT day_name, hour, {R('revenue', 2)} AS revenue FROM week_cells
        QUALIFY row_number() OVER (PARTITION BY day_name ORDER BY revenue DESC, hour) = 1"""),
)
def peak_hours(spark, d):
    best = best_value(last_week_cells(spark, d), ["day_name"], ["hour", "revenue"], -F.col("revenue"), F.col("hour"))
    return rounded(best, 2)


@query(
    "best_and_worst_hour",
    sql(SALES, CELLS, "h AS (SELECT hour, avg(revenue) AS revenue FROM cells GROUP BY hour)", select=f"""
        (SELECT 'best' AS kind, hour, {R('revenue', 4)} AS revenue FROM h ORDER BY h.revenue DESC, hour LIMIT 1)
        UNION ALL (SELECT 'worst', hour, {R('revenue', 4)} FROM h ORDER BY h.revenue, hour LIMIT 1)"""),
)
def best_and_worst_hour(spark, d):
    by_hour = cut_lineage(totals.hour_means(totals.weekday_hour_means_of_cells(sales_cells(spark, d)), ["revenue"]))
    best = first_row(by_hour, F.col("revenue").desc(), F.col("hour"))
    worst = first_row(by_hour, F.col("revenue").asc(), F.col("hour"))
    both = best.select(F.lit("best").alias("kind"), "*").unionByName(worst.select(F.lit("worst").alias("kind"), "*"))
    return rounded(both, 4)


@query(
    "top_products",
    sql(SALES, PRODUCTS, IDENTITY, select=f"""
        SELECT p.item_name, p.units, {R('i.unit_price', 4)} AS unit_price FROM (SELECT * FROM products ORDER BY units DESC, item_name LIMIT 10) p
        LEFT JOIN identity i USING (item_name)"""),
)
def top_products(spark, d):
    base = item_base(spark, d)
    best = first_row(products(base), F.col("units").desc(), F.col("item_name"), n=10).select("item_name", "units")
    return best.join(identity(base).select("item_name", r("unit_price", 4).alias("unit_price")), "item_name", "left")


@query(
    "least_sold_products",
    sql(SALES, PRODUCTS, select=f"SELECT item_name, {R('revenue', 2)} AS revenue FROM products ORDER BY products.revenue, item_name LIMIT 5"),
)
def least_sold_products(spark, d):
    return rounded(first_row(products(item_sales(spark, d, "item_name")), F.col("revenue"), F.col("item_name"), n=5).select("item_name", "revenue"), 2)


@query(
    "products_with_sales",
    sql(f"""s AS (SELECT l_partkey, sum(l_quantity) AS units, sum(l_extendedprice) AS revenue FROM lineitem GROUP BY 1)""",
        select=f"""SELECT p_partkey AS item_id, p_retailprice AS unit_price, coalesce(units, 0) AS units, {R('coalesce(revenue, 0)', 2)} AS revenue
        FROM part LEFT JOIN s ON p_partkey = l_partkey"""),
)
def products_with_sales(spark, d):
    sold = table(spark, d, "lineitem").groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("units"), F.sum("l_extendedprice").alias("revenue")
    )
    joined = table(spark, d, "part").join(sold, F.col("p_partkey") == F.col("l_partkey"), "left").fillna(0, ["units", "revenue"])
    return joined.select(F.col("p_partkey").alias("item_id"), F.col("p_retailprice").alias("unit_price"), "units", r("revenue", 2).alias("revenue"))


@query(
    "lines_of_top_brand_items",
    """WITH b AS (SELECT p_brand FROM part GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 1)
       SELECT l_returnflag, count(*) AS lines, sum(l_quantity) AS units FROM lineitem
       WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_brand IN (SELECT p_brand FROM b)) GROUP BY 1""",
)
def lines_of_top_brand_items(spark, d):
    part = table(spark, d, "part")
    brand = first_row(part.groupBy("p_brand").count(), F.col("count").desc(), F.col("p_brand")).select("p_brand")
    chosen = part.join(brand, "p_brand", "left_semi").select(F.col("p_partkey").alias("l_partkey"))
    lines = table(spark, d, "lineitem").join(chosen, "l_partkey", "left_semi")
    return lines.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("units"))


@query(
    "sorted_menu",
    sql(SALES, select="""
        SELECT category, item_name, CAST(row_number() OVER (ORDER BY category, item_name DESC) AS INTEGER) AS place FROM (SELECT DISTINCT category, item_name FROM sales)"""),
)
def sorted_menu(spark, d):
    from pyspark.sql import Window as W

    menu = cut_lineage(item_sales(spark, d, "category", "item_name").select("category", "item_name").distinct())
    # categories are few; their sizes give each one its first place, and items are numbered inside their category
    inside = F.row_number().over(W.partitionBy("category").orderBy(F.col("item_name").desc()))
    sizes = menu.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    before = W.orderBy("category").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("category", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    numbered = menu.withColumn("k", inside).join(starts, "category")
    return numbered.select("category", "item_name", (F.col("start") + F.col("k")).cast("int").alias("place"))


@query("distinct_categories", "SELECT DISTINCT p_type AS category FROM part ORDER BY 1")
def distinct_categories(spark, d):
    return table(spark, d, "part").select(ITEM["category"]().alias("category")).distinct().orderBy("category")


@query(
    "best_items_per_category",
    sql(SALES, select="""
        SELECT category, item_name, units FROM (SELECT category, item_name, sum(quantity) AS units FROM sales GROUP BY 1, 2)
        QUALIFY row_number() OVER (PARTITION BY category ORDER BY units DESC, item_name) <= 3"""),
)
def best_items_per_category(spark, d):
    sold = item_sales(spark, d, "category", "item_name").groupBy("category", "item_name").agg(F.sum("quantity").alias("units"))
    return best_rows(sold, ["category"], F.col("units").desc(), F.col("item_name"), n=3)
